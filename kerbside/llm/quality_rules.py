"""Quality rules with host verdicts (operator 5), in DataFrame functions only.

Base rules judge each text by itself. Their failures are aggregated by host
(the ``source`` column); a host's rate is shrunk by a beta prior that is
fitted to all hosts by the method of moments, and documents of a host whose
shrunk rate is above ``max_rate`` go with it.

Cases: a NULL text has no words and fails like an empty one; a NULL host is
no host, so such documents are judged by the base rules alone; repeated rows
count as rows; with fewer than two hosts, or rates that do not differ, the
prior is uniform; an empty table gives no rows. Other columns pass unchanged
under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import SPACE_CLASS, settle

#: Characters that count as symbols (fixed value).
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def let(value: Column, body) -> Column:
    """``body`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside a window of ``window`` words that the text has twice or
    more, each word once. Windows are sorted by hash beside their position,
    so equal ones are neighbours; the positions of those, sorted, cover
    ``window`` words each less what the next one covers."""
    last = F.size(words) - window
    marks = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(
        F.xxhash64(*(F.get(words, i + k) for k in range(window))).alias("h"), i.alias("p"))))

    def covered(p):
        return F.aggregate(F.transform(p, lambda x, i: F.when(i == 0, window).otherwise(
            F.least(F.lit(window), x - F.get(p, i - 1)))), F.lit(0).cast("long"), lambda a, x: a + x)

    def doubled(s):
        return F.array_sort(F.transform(F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])),
                                        lambda x: x["p"]))

    return F.coalesce(let(F.sort_array(marks), lambda s: let(doubled(s), covered)), F.lit(0).cast("long"))


def base_rules(text: Column) -> Column:
    """Struct of the base counts of a text and ``base_failed``."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, f"[{SPACE_CLASS}]+"), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))

    def counted(w):
        n = F.size(w).cast("long")
        return F.struct(
            n.alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            F.char_length(F.regexp_replace(whole, SYMBOLS.replace("[", "[^") + "+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"))

    def judged(b):
        failed = (b["n_words"] < 10) | (100 * b["n_repeat_words"] > 20 * b["n_words"])
        return F.struct(*(b[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                        failed.alias("base_failed"))

    return let(let(words, counted), judged)


def host_verdicts(judged: DataFrame, host_col: str = "host", failed_col: str = "base_failed",
                  max_rate: float = 0.5) -> DataFrame:
    """Per host: ``n_docs``, ``n_failed``, ``shrunk_rate`` and
    ``host_rejected``. The prior's mean and weight are the hosts' mean rate and
    mean * (1 - mean) / variance - 1; it is one row, a scalar subquery."""
    hosts = (judged.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("host"))
             .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed_col).cast("long")).alias("n_failed")))
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(rate).alias("mean"), F.var_samp(rate).alias("spread"))
    weight = F.when((F.col("spread") > 0) & (F.col("spread") < F.col("mean") * (1 - F.col("mean"))),
                    F.col("mean") * (1 - F.col("mean")) / F.nullif("spread", F.lit(0.0)) - 1)
    prior = moments.select(F.struct(
        F.coalesce(weight * F.col("mean"), F.lit(1.0)).alias("alpha"),
        F.coalesce(weight * (1 - F.col("mean")), F.lit(1.0)).alias("beta"))).scalar()
    rated = hosts.withColumn("prior", prior)
    shrunk = (F.col("n_failed") + F.col("prior.alpha")) / (F.col("n_docs") + F.col("prior.alpha") + F.col("prior.beta"))
    return rated.select("host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"), (shrunk > max_rate).alias("host_rejected"))


def _rejected(judged: DataFrame, max_rate: float) -> DataFrame:
    return settle(host_verdicts(judged, max_rate=max_rate).where("host_rejected").select("host"), "rejected")


def judge_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    max_rate: float = 0.5) -> DataFrame:
    """Per row: id, base counts, ``base_failed`` and ``kept``. Only counts and
    hosts are written and joined. Rejected hosts are written first, so the join
    is planned by their real size: broadcast while they are few, otherwise one
    that adaptive execution can split at a host with very many documents."""
    judged = settle(df.select(F.col(id_col).alias("row_id"), F.col(host_col).cast("string").alias("host"),
                              base_rules(F.col(text_col)).alias("base")), "judged")
    judged = judged.select("row_id", "host", "base.*")
    joined = judged.join(_rejected(judged, max_rate).withColumn("host_rejected", F.lit(True)), "host", "left")
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.select(F.col("row_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", kept.alias("kept"))


def keep_good(df: DataFrame, text_col: str = "text", host_col: str = "source", max_rate: float = 0.5) -> DataFrame:
    """The rows that the rules and their host's verdict keep, with all their
    columns."""
    judged = settle(df.select(F.struct("*").alias("whole"), F.col(host_col).cast("string").alias("host"),
                              base_rules(F.col(text_col))["base_failed"].alias("base_failed")), "judged")
    bad = _rejected(judged.select("host", "base_failed"), max_rate)
    return judged.where("NOT base_failed").join(bad, "host", "left_anti").select("whole.*")
