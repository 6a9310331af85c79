import hashlib
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from kerbside.llm import periodic_runs
from kerbside.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words, exponent=4, min_length=6):
    """Every period: maximal stretches in which words that far apart agree."""
    n, best = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, exponent * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is None or not words or zlib.crc32(str(doc_id).encode()) % 10:
        return words
    n, g = len(words), zlib.crc32(str(doc_id).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def listed(texts, **options):
    whose, *found = periodic_runs.runs_of(texts, **options)
    out = [[] for _ in texts]
    for i, *r in zip(whose.tolist(), *(f.tolist() for f in found)):
        out[i].append(tuple(r))
    return out


def shapes(rng):
    """Texts of few letters, powers, runs inside runs, runs that touch."""
    for _ in range(150):
        yield rng.integers(0, rng.integers(1, 4), rng.integers(0, 60)).tolist()
    for _ in range(150):
        base = rng.integers(0, 4, rng.integers(1, 9)).tolist()
        text = rng.integers(0, 6, rng.integers(0, 20)).tolist() + base * int(rng.integers(1, 12)) + base[:int(rng.integers(0, len(base) + 1))]
        for i in rng.integers(0, len(text), rng.integers(0, 3)):
            text[i] = 9
        yield text + rng.integers(0, 6, rng.integers(0, 20)).tolist()
    inner = [1] * 7 + [2]
    yield inner * 6
    yield ([1, 2] * 5 + [3]) * 5 + [1, 2] * 9
    yield [0] * 400
    yield [0, 1] * 200 + [1, 0] * 200
    yield list(range(300)) * 5
    yield list(range(97)) * 4 + [5]


def test_runs_of_all_shapes():
    texts = list(shapes(np.random.default_rng(5)))
    want = [brute(t) for t in texts]
    assert listed(texts) == want
    assert [listed([t])[0] for t in texts] == want  # alone, or in any batch
    assert sum(map(len, want)) > 150


@pytest.mark.parametrize("exponent,min_length", [(2, 2), (2, 7), (3, 3), (5, 20)])
def test_other_thresholds(exponent, min_length):
    texts = list(shapes(np.random.default_rng(6)))
    assert listed(texts, exponent=exponent, min_length=min_length) == [brute(t, exponent, min_length) for t in texts]


def test_small_steps_change_nothing(monkeypatch):
    texts = list(shapes(np.random.default_rng(7)))
    want = listed(texts)
    monkeypatch.setattr(periodic_runs, "AT_ONCE", 13)
    assert listed(texts) == want


def test_extensions_agree_with_a_scan():
    rng = np.random.default_rng(8)
    letters = np.concatenate([[90], rng.integers(0, 2, 300), [91], np.tile([3, 3, 4, 3, 3, 3], 60), [92], np.zeros(200, int), [93]])
    part = np.concatenate([[0], *([k] * n for k, n in ((0, 301), (1, 361), (2, 201)))])
    grammar = periodic_runs.Grammar(letters, part)
    assert len(grammar.rounds) > 3
    x = rng.integers(1, len(letters), 20000)
    y = rng.integers(1, len(letters), 20000)
    x, y = x[(part[x] == part[y]) & (x < y)], y[(part[x] == part[y]) & (x < y)]
    for step in (1, -1):
        got = grammar.extend(x, y, step)
        for a, b, n in zip(x.tolist(), y.tolist(), got.tolist()):
            k = 0
            while letters[a + step * k] == letters[b + step * k]:
                k += 1
            assert n == k


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], "doc_id long, text string, `row` string, runs string, `odd name.x` int")


def test_operator(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 6), (4, "a " * 6), (None, "x y " * 8 + "z"), (5, "é ü " * 30 + "b c d"),
            (6, "one two three"), (7, ("long " * 20000) + "end " + "p q r " * 5000), (8, "\x0b".join(["u", "v"] * 4))]
    rows = periodic_runs.find_runs(frame(spark, docs)).collect()
    want = [(i, (t or "").encode().split()) for i, t in docs]
    for r in rows:
        words = next(w for i, w in want if i == r.doc_id)
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == brute(words)
        assert r.collapsed.encode() == kept(words, [tuple(x) for x in r.runs])
    assert len(rows) == len(docs)
    assert [tuple(x) for x in next(r.runs for r in rows if r.doc_id == 7)] == [(0, 20000, 1), (20001, 15000, 3)]
    assert periodic_runs.find_runs(frame(spark, [])).count() == 0
    assert periodic_runs.digests(periodic_runs.find_runs(frame(spark, []))).count() == 0


def test_planted_texts(spark):
    docs = [(i, " ".join(f"w{k}" for k in range(i % 37))) for i in range(400)] + [(None, "a b c"), (10, None), (20, " ")]
    rows = periodic_runs.with_planted_runs(frame(spark, docs)).collect()
    assert [((r.text or "").encode().split()) for r in rows] == [planted(i, t) for i, t in docs]


def test_query(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for d in docs:
        words = planted(d["doc_id"], d["text"])
        runs = brute(words)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        want.append((d["doc_id"], len(runs), start, length, period, 1000 * length // period if runs else None,
                     sha("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()), sha(kept(words, runs))))
    got = QUERIES["op12_periodic_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 10
