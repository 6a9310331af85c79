"""The registered queries on the smallest tables, against brute force or SQL."""

import hashlib
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from kerbside.llm import bpe, decontaminate, quality_rules, secret_scan, simhash, token_counts  # noqa: E402
from kerbside.llm.oracle import ORACLE  # noqa: E402
from kerbside.llm.queries import QUERIES, tokenizer_path  # noqa: E402
from test_quality_rules import brute as brute_rules  # noqa: E402
from test_secret_scan import brute as brute_spans  # noqa: E402
from test_simhash import expected as brute_groups  # noqa: E402
from test_url_filter import brute as brute_rule  # noqa: E402

SF = "/root/testdata/sf0.001"


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return table("documents")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_a_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_op1(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    want = []
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        want.append((d["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(tuple(r) for r in rows(spark, "op1_bpe_codec")) == sorted(want)


def test_op2(spark):
    pages = {p["page_id"]: p["url"] for p in table("pages")}
    got = rows(spark, "op2_url_filter")
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = brute_rule(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ((verdict,) if rule else ("allow", "block"))


def test_op3(spark, docs):
    want = brute_groups([(d["doc_id"], d["text"]) for d in docs])
    assert sorted((tuple(r) for r in rows(spark, "op3_simhash_near_duplicates")), key=str) == want


def aligned(docs):
    """Every document against every item, whole."""
    items = [(b["item_id"], decontaminate.words_of((b["text"] or "").encode())) for b in table("benchmark")]
    numbers = {w: i for i, w in enumerate({w for _, ws in items for w in ws}, 1)}
    found = {}
    import numpy as np

    for d in docs:
        text = np.array([numbers.get(w, 0) for w in decontaminate.words_of((d["text"] or "").encode())])
        for i, words in items:
            item = np.array([numbers[w] for w in words])
            if len(item) >= 3 and np.isin(text, item).sum() >= 0.5 * len(item):
                score = decontaminate.smith_waterman(item, text)[0]
                if score >= 0.5 * len(item):
                    found[d["doc_id"], i] = score / len(item)
    return found


def test_op4(spark, docs):
    got = {(r.doc_id, r.item_id): r.score for r in rows(spark, "op4_decontaminate")}
    assert got == aligned(docs) and got


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_op6(spark, docs):
    got = rows(spark, "op6_hilbert_shards")
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == sorted(
        (d["doc_id"], len((d["text"] or "").encode()) + 16, zlib.crc32((d["text"] or "").encode())) for d in docs)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())


def test_op7(spark, docs):
    counter = token_counts.Counter(token_counts.zipf_pieces(tokenizer_path("piece_bpe_32k.model")))
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in rows(spark, "op7_token_counts")}
    for d in docs[:40]:  # each word by itself, in a trie of its own
        words = (d["text"] or "").encode().split()
        alone = 0
        for w in words:
            counter.counts = {}
            alone += counter.count([w])[0][1]
        assert got[d["doc_id"]] == (len(words), alone)
    assert len(got) == len(docs)


def test_op8(spark, docs):
    lang = {d["doc_id"]: d["lang"] for d in docs}
    got = rows(spark, "op8_language_id")
    out = [r for r in got if r.held_out and lang[r.doc_id] is not None]
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.9 * len(out)


def test_op10(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op10_secret_scan")}
    for d in docs:
        base = brute_spans(d["text"])
        listed = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[d["doc_id"]].base_sha256 == sha(listed)


def test_pipeline(spark, docs):
    """run() against the stages in plain Python, and each stage's schema."""
    judged = [(d, brute_rules(d["text"])[5]) for d in docs]
    hosts = Counter(d["source"] for d in docs)
    failed = Counter(d["source"] for d, f in judged if f)
    rates = [failed[h] / n for h, n in hosts.items()]
    mean = sum(rates) / len(rates)
    spread = sum((r - mean) ** 2 for r in rates) / (len(rates) - 1)
    weight = mean * (1 - mean) / spread - 1
    bad = {h for h, n in hosts.items() if (failed[h] + weight * mean) / (n + weight) > 0.5}
    kept = [d for d, f in judged if not f and d["source"] not in bad]
    first = {c for _, _, c in brute_groups([(d["doc_id"], d["text"]) for d in kept])}
    kept = [d for d in kept if d["doc_id"] in first]
    leaked = {d for d, _ in aligned(kept)}
    kept = [d for d in kept if d["doc_id"] not in leaked]
    codec = bpe.Codec(bpe.read_vocabulary(tokenizer_path()))
    want = {}
    for d in kept:
        text = secret_scan.masked(d["text"])
        assert not [k for _, k, _ in brute_spans(text) if k < 3]
        want[d["doc_id"]] = (codec.encode(text), sha(text))
    got = {r.doc_id: (r.token_ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < len(docs)


def test_stages_keep_the_columns_of_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, whole string, host string, fp int, raw binary, `odd name.x` string"
    some = spark.createDataFrame([(i if i else None, t, None, s, None, "w", "h", 1, b"r", "o") for i, (t, s) in enumerate(
        [(None, None), ("", "a"), ("word " * 3, "a"), (" ".join(map(str, range(40))), None), (" ".join(map(str, range(40))), "b"),
         (" ".join(map(str, range(50, 99))) + " password=abcdefghijkl99", "b"), ("x" * 100000 + " y" * 3, "c")])], schema)
    for df in (some, some.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == some.columns, name
            assert out.count() <= df.count()
        assert corpus_pipeline.STAGES[-1][1](spark, df, SF).count() == df.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "decontamination", "secret_scan", "bpe"]
    assert quality_rules and simhash
