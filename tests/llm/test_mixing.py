import hashlib
from collections import Counter, defaultdict

import pytest

from kerbside.llm import mixing
from kerbside.llm.common import ranked

SCHEMA = "doc_id long, text string, source string, size string, whole string, weight int, `odd name.x` string"


def brute(docs, cap=3):
    """Sources are capped one by one, the largest excess first."""
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len((text or "").encode().split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: float(i % 3 + 1) for i, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        free = float(total - cap * sum(sizes[s] for s in held))
        open_weight = sum(weight[s] for s in sizes if s not in held)
        target = {s: float(cap * sizes[s]) if s in held else free * weight[s] / open_weight for s in sizes}
        over = [s for s in sizes if target[s] > cap * sizes[s]]
        if not over:
            break
        held.add(max(over, key=lambda s: target[s] - cap * sizes[s]))
    out = []
    for i, text, source in docs:
        n, size = len((text or "").encode().split()), sizes[source]
        rate = 0.0 if not size else float(cap) if source in held else min(target[source] / size, cap)
        u = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 16 ** 13
        out.append((i, n, size, target[source], n * (int(rate) + (u < rate - int(rate)))))
    return sorted(out, key=str)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, s, "x", "y", 7, "z") for i, t, s in docs], SCHEMA)


def got(spark, docs):
    rows = mixing.copies(frame(spark, docs)).select("doc_id", "size", "source_size", "target", "taken").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_words_are_those_of_a_split(spark):
    texts = [None, "", " ", "a", " a", "a ", "\ta\x0b\x0cb\r\n", "a b", "a  b\n\nc", "\n", "x" * 50000 + " y" * 3]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select(
        "i", mixing.n_words(mixing.F.col("text")).alias("n")).collect()
    assert {r.i: r.n for r in rows} == {i: len((t or "").encode().split()) for i, t in enumerate(texts)}


def test_targets_are_reshared_until_none_is_over(spark):
    docs = [(i, "w " * (1 + i % 9), s) for i, s in enumerate("a" * 400 + "b" * 3 + "c" * 20 + "d" * 2 + "é" * 90 + "Z" * 50)]
    docs += [(1000, "one two", None), (1001, None, None), (1002, "", "empty"), (1003, None, "empty"), (None, "q q q", "a")]
    want = brute(docs)
    assert got(spark, docs) == want
    targets = {(s, t) for _, _, s, t, _ in want}
    assert sum(t for _, t in targets) == pytest.approx(sum(s for s, _ in targets)) and any(t == 3.0 * s for s, t in targets)
    assert all(k <= 3 * n for _, n, _, _, k in want)


def test_hot_source_copies_and_repeated_rows(spark):
    docs = [(i, "same text here", "hot") for i in range(3000)] + [(i, "u v " * (i % 5), f"s{i % 40}") for i in range(3000, 6000)]
    docs += [(7, "same text here", "hot")] * 5
    want = brute(docs)
    assert got(spark, docs) == want
    taken, spread, goal = Counter(), Counter(), {}
    for r in mixing.copies(frame(spark, docs)).collect():
        taken[r.source] += r.taken
        spread[r.source] += r["size"] ** 2 / 4
        goal[r.source] = r.target
    assert all(abs(taken[s] - goal[s]) <= 4 * spread[s] ** 0.5 for s in goal)


def test_mixed_emits_whole_rows(spark):
    docs = [(i, "a b c " * (i % 4), "xyz"[i % 3 if i < 90 else 0]) for i in range(300)]
    df = frame(spark, docs)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    times = Counter(r.doc_id for r in out.collect())
    assert {r.doc_id: r.copies for r in mixing.copies(df).collect() if r.copies} == dict(times)
    assert Counter(r.doc_id for r in mixing.mixed(df.repartition(7)).collect()) == times


def test_given_weights(spark):
    docs = [(i, "a b c d", "xyz"[i % 3]) for i in range(900)]
    weights = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", None), ("unknown", 5.0)], "source string, weight double")
    rows = {r.source: r.target for r in mixing.copies(frame(spark, docs), weights=weights, cap=2).collect()}
    assert rows == {"x": 2400.0, "y": 0.0, "z": 0.0}
    assert {r.source: r.target for r in mixing.copies(frame(spark, docs), weights=weights, cap=4).collect()} == {
        "x": 3600.0, "y": 0.0, "z": 0.0}
    assert mixing.copies(frame(spark, docs), weights=weights.limit(0)).agg({"taken": "sum"}).first()[0] == 0


def test_empty_tables(spark):
    assert got(spark, []) == []
    assert mixing.mixed(frame(spark, [])).count() == 0
    assert {r[4] for r in got(spark, [(1, None, None), (2, "", "a")])} == {0}


def test_main_path_is_native(spark):
    plan = mixing.copies(frame(spark, [(1, "a", "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ranks_are_gapless_with_a_common_key(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("id", "if(id % 3 = 0, 0, id) AS k")
    rows = ranked(df, [mixing.F.desc("k")], "ranks").collect()
    assert sorted(r["rank"] for r in rows) == list(range(5000))
    keys = [r.k for r in sorted(rows, key=lambda r: r["rank"])]
    assert keys == sorted(keys, reverse=True)
