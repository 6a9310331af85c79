import random
import re

import xxhash

from kerbside.llm import simhash
from kerbside.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, component_id int"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, k):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in fps:
        for b in fps:
            if a < b and bin(a ^ b).count("1") <= k:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def expected(rows, k=2):
    fp = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(set(fp), k)
    least = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, format(f, "016x"), least.get(root[f])) for (i, _), f in zip(rows, fp)), key=str)


def corpus():
    rnd = random.Random(3)
    base = " ".join(rnd.choice("abcdefghij") * 3 + str(rnd.randint(0, 50)) for _ in range(400))
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Ünï ÇÖDÉ 你好"), (7, "Ünï ÇÖDÉ 你好"), (None, "one two")]
    for i in range(60):
        words = base.split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = "edit" + str(rnd.randint(0, 9))
        rows.append((100 + i, " ".join(words)))
    return rows + [(200 + i, " ".join(rnd.choice("xyz") + str(rnd.randint(0, 9)) for _ in range(rnd.randint(3, 80)))) for i in range(40)]


def test_components_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == expected(rows)


def test_links_find_every_close_pair(spark):
    rnd = random.Random(9)
    fps = set()
    for _ in range(12):
        a = rnd.getrandbits(64)
        fps.add(a)
        for _ in range(6):
            fps.add(a ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for k in (0, 1, 2):
        roots = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in connected_components(simhash.links(df, k)).collect()}
        groups = brute_components(fps, k)
        assert len({roots.get(f, f) for f in fps}) == len(set(groups.values()))
        assert all((roots.get(a, a) == roots.get(b, b)) == (groups[a] == groups[b]) for a in fps for b in fps)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


def test_drop_keeps_one_row_of_each_group(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    got = simhash.drop_near_duplicates(df)
    assert got.columns == df.columns
    want = {c for _, _, c in expected(rows)}
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.drop_near_duplicates(df).count() == 0
