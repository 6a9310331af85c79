import itertools
import random
import zlib

import numpy as np

from kerbside.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, curve string"


def test_curve_visits_every_cell_by_single_steps():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        index = sharding.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def rows():
    rnd = random.Random(6)
    out = []
    for i in range(300):
        text = rnd.choice([None, "", "copy " * 5, "ünï" * rnd.randint(1, 40), "x" * rnd.randint(0, 3000)])
        out.append((i if i % 50 else None, text, rnd.choice(["en", "en", "de", None]), rnd.choice(["hot"] * 5 + ["a", "b", None]),
                    rnd.choice([None, len(text or "")]), "s", "c"))
    return out + out[:20]


def test_law_holds(spark):
    data = rows()
    got = sharding.assign(spark.createDataFrame(data, SCHEMA).repartition(7), shards=40).collect()
    assert len(got) == len(data)
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in data), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == want
    by_shard = {}
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert set(by_shard) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    counts = [len(s) for s in by_shard.values()]
    assert max(counts) - min(counts) <= 1
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in got)


def test_fewer_rows_than_shards_and_empty(spark):
    few = sharding.assign(spark.createDataFrame(rows()[:5], SCHEMA), shards=40).collect()
    assert len(few) == 5 and all(r.slot == 0 and 0 <= r.shard < 40 for r in few) and len({r.shard for r in few}) == 5
    assert sharding.assign(spark.createDataFrame([], SCHEMA), shards=40).count() == 0


def test_shards_prune_several_dimensions(spark, tmp_path):
    rnd = random.Random(2)
    data = [(i, "t", rnd.choice("abcdefgh"), f"src{rnd.randrange(40):02d}", rnd.randrange(10000), "s", "c") for i in range(3000)]
    stats = sharding.write_shards(spark.createDataFrame(data, SCHEMA), str(tmp_path / "shards"), shards=64).collect()
    assert sum(s.n_rows for s in stats) == 3000
    # a filter on any one dimension reads a part of the shards
    hit = lambda c, lo, hi: sum(s[f"min_{c}"] <= hi and s[f"max_{c}"] >= lo for s in stats) / len(stats)
    assert hit("n_chars", 2000, 2400) < 0.75 and hit("source", "src10", "src11") < 0.75 and hit("lang", "c", "c") < 0.75
    back = spark.read.parquet(str(tmp_path / "shards")).select("row.*")
    assert sorted(tuple(r) for r in back.collect()) == sorted(data)
