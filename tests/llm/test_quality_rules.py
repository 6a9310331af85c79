import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbside.llm import quality_rules

SCHEMA = "doc_id long, text string, source string, n_words int, whole string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep,
            n < 10 or 100 * rep > 20 * n)


def texts():
    rnd = random.Random(5)
    fixed = [None, "", " \t\n", "one", "a b c d e", "a a a a a a a a a a a a", "x " * 30 + "end", "l1 a b\nl1 a b\n\n\nl1 a b",
             "ünï çödé 你好 😀 " * 4, "a\x0bb\x0cc\rd\x1ce\xa0f", "#*$%&|<> # plain words here to fill the ten words"]
    made = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    return fixed + made + made[:5] + [" ".join(str(i % 4000) for i in range(30000))]


def test_base_rules_match_brute_force(spark):
    rows = [(i, t, "h", 1, "x") for i, t in enumerate(texts())]
    got = (spark.createDataFrame(rows, SCHEMA).select("doc_id", quality_rules.base_rules(F.col("text")).alias("b"))
           .select("doc_id", "b.*").collect())
    assert {r[0]: tuple(r[1:]) for r in got} == {i: brute(t) for i, t, *_ in rows}


def host_rows():
    good, bad = " ".join(f"w{i}" for i in range(40)), "short"
    rows = [(i, good if i % 10 else bad, "fine", 0, "w") for i in range(50)]
    rows += [(100 + i, bad if i % 10 else good, "junk", 0, "w") for i in range(50)]
    rows += [(200, bad, "tiny", 0, "w"), (201, good, None, 0, "w"), (202, bad, None, 0, "w"), (None, good, "fine", 0, "w")]
    return rows + [(300 + h, good, f"other{h}", 0, "w") for h in range(6)]


def test_host_verdicts(spark):
    judged = quality_rules.judge_documents(spark.createDataFrame(host_rows(), SCHEMA)).collect()
    kept = {r.doc_id: r.kept for r in judged}
    assert len(judged) == len(host_rows())
    assert not any(kept[100 + i] for i in range(50))  # the host's few good documents go with it
    assert kept[1] and not kept[0] and kept[201] and not kept[202] and kept[300] and kept[None]


def test_prior_follows_moments(spark):
    rows = [("a", True)] * 8 + [("a", False)] * 2 + [("b", True)] * 1 + [("b", False)] * 9 + [("c", False)] * 4
    got = {r.host: r for r in quality_rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    rates = [0.8, 0.1, 0.0]
    mean = sum(rates) / 3
    spread = sum((r - mean) ** 2 for r in rates) / 2
    weight = mean * (1 - mean) / spread - 1
    for host, n, f in (("a", 10, 8), ("b", 10, 1), ("c", 4, 0)):
        assert got[host].shrunk_rate == pytest.approx((f + weight * mean) / (n + weight))


def test_keep_good_returns_whole_rows(spark):
    df = spark.createDataFrame(host_rows(), SCHEMA)
    kept = {r.doc_id for r in quality_rules.judge_documents(df).where("kept").collect()}
    got = quality_rules.keep_good(df)
    assert got.columns == df.columns
    assert {r.doc_id for r in got.collect()} == kept


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert quality_rules.judge_documents(df).count() == 0
    assert quality_rules.keep_good(df).count() == 0
