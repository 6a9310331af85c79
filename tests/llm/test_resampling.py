import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from kerbside.llm import resampling
from kerbside.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i:i + k]).encode() for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=5, min_words=20, buckets=10000):
    bucket = lambda f: zlib.crc32(f) % buckets
    split = [(i, *features(t)) for i, t in docs]
    s = Counter(bucket(f) for _, _, fs in split for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    out = []
    for i, n, fs in split:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        out.append([i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[5] = k
    return sorted(map(tuple, out), key=str)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in docs],
                                 "doc_id long, text string, raw string, weight int, `odd name.x` string, `rank` int")


def targets(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def got(spark, docs, target, **options):
    return sorted((tuple(r) for r in resampling.resample(frame(spark, docs), targets(spark, target), **options).collect()), key=str)


def test_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    target = [b["text"] for b in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    rows = QUERIES["op11_importance_resampling"](spark, SF).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(((i, *r) for i, _, *r in brute(docs, target)), key=str)
    assert sum(r["rank"] is not None for r in rows) > 5


HARD = [None, "", " .,;", "one", "One two", "é ü x", "A-B_C[d]{e}`f@g\x7fh\x00i", "日本語 テキスト", "x" * 200 + " y " + "z" * 63 + " " + "q" * 62,
        "naïve Straße ÀÉ " * 30, "w" * 62 + " " + "w" * 63 + " a " + "w" * 64]


def test_nulls_ties_repeated_rows_and_odd_texts(spark):
    docs = [(i, t) for i, t in enumerate(HARD)] + [(i, "the same words again and again " * 5) for i in range(20, 60)]
    docs += [(30, "the same words again and again " * 5)] * 4 + [(None, "no id here but many words " * 6), (None, None)]
    docs += [(i, f"the cat {i} sat on a mat with {i % 3} hats " * 4) for i in range(100, 300)]
    for target in (["the cat sat on a mat", None, ""], []):
        assert got(spark, docs, target, percent=50) == brute(docs, target, percent=50)


def test_empty_tables(spark):
    assert got(spark, [], ["some text"]) == []
    assert got(spark, [], []) == []
    assert got(spark, [(1, "few words")], ["a b c"], percent=100)[0][5] is None


def test_a_head_of_any_size_gives_the_same_buckets():
    rng = np.random.default_rng(3)
    vocabulary = [("w%d" % i * (1 + i % 40)).encode() for i in range(300)]
    texts = [b" ".join(vocabulary[i] for i in rng.zipf(1.3, n) % 300) for n in (0, 1, 2, 3, 50, 4000)]
    want = Counter(zlib.crc32(f) % 997 for t in texts for f in features(t.decode())[1])
    for words, pairs in (([], []), (vocabulary[:50], [(i, j) for i in range(50) for j in range(50)]), (vocabulary[:3], [(0, 1)])):
        hasher, seen = resampling.Hasher([w for w in words if len(w) <= resampling.SHORT], []), Counter()
        if words:
            short = [w for w in words if len(w) <= resampling.SHORT]
            hasher = resampling.Hasher(short, [p for p in pairs if max(p) < len(short)])
        for block in resampling.blocks(texts):
            seen.update(hasher.features(*block, 997)[0].tolist())
        assert seen == want


def test_blocks_cut_long_texts_without_loss(monkeypatch):
    texts = [b"a b c " * 500, b"", b"x" * 300, None, b"p " + b"q" * 400 + b" r s", b"one", b"k l m n " * 300]
    want = Counter((d, f) for d, t in enumerate(texts) for f in features((t or b"").decode())[1])
    owners = Counter()
    for d, _ in want.elements():
        owners[d] += 1
    for piece, most in ((1, 1), (7, 3), (64, 10), (1 << 20, 100)):
        monkeypatch.setattr(resampling, "PIECE_BYTES", piece)
        monkeypatch.setattr(resampling, "BLOCK_WORDS", most)
        hasher = resampling.Hasher([b"a", b"b"], [(0, 1)])
        seen, found = Counter(), Counter()
        for words, owner, carried in resampling.blocks(texts):
            b, whose = hasher.features(words, owner, carried, 1 << 30)
            seen.update(b.tolist())
            found.update(whose.tolist())
        assert found == owners
        assert seen == Counter(zlib.crc32(f) % (1 << 30) for _, f in want.elements())


def test_the_head_holds_what_is_frequent(spark):
    docs = [(i, "alpha beta gamma " * 40 + f"rare{i}") for i in range(200)]
    words, pairs = resampling.head(frame(spark, docs), "text")
    assert set(words) == {b"alpha", b"beta", b"gamma"}
    assert {(words[a], words[b]) for a, b in pairs} == {(b"alpha", b"beta"), (b"beta", b"gamma"), (b"gamma", b"alpha")}


def test_draw_keeps_whole_rows(spark):
    docs = [(i, f"the cat {i} sat on a mat with {i % 3} hats " * 4) for i in range(100)]
    df = frame(spark, docs)
    out = resampling.draw(df, targets(spark, ["a cat on a mat"]), percent=10)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {r[0] for r in brute(docs, ["a cat on a mat"], percent=10) if r[5]}


def test_weights_follow_the_target(spark):
    docs = [(i, ("stars and planets move around the sun " if i % 2 else "cooking pasta with tomato sauce at home ") * 5 + f"n{i}") for i in range(400)]
    rows = got(spark, docs, ["planets move around stars", "the sun and stars"] * 5, percent=20)
    assert all(r[0] % 2 for r in rows if r[5])


@pytest.mark.parametrize("n", [1, 5, 62, 63])
def test_shift_tables(n):
    tables = resampling.shift_tables(n)
    state = zlib.crc32(b"some prefix")
    shifted = 0
    for k in range(4):
        shifted ^= int(tables[n, k, state >> 8 * k & 255])
    assert shifted ^ zlib.crc32(b"z" * n) == zlib.crc32(b"some prefix" + b"z" * n)
