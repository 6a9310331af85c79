"""Mixing sources to target weights (operator 13), in DataFrame functions only.

Tokens (words) are aggregated per source. Each source gets a target, its share
by weight of all words, but at most ``cap`` times its own words; what is over
goes to the other sources by weight until no target is above its cap. A
source's repetition rate is target / words, and a document of it is emitted
floor(rate) times plus one hash-seeded Bernoulli copy with probability equal
to the fraction: u, the first 13 hex digits of sha256("<seed>:<id>") over
16^13, is below it. Every decision follows from the id, the seed and the
source's totals, so reruns and recomputed tasks agree. A source's taken words
are its target in expectation, with a spread of at most half the root of the
sum of its squared document sizes.

Cases: a NULL text has no words; a NULL source is a source of its own, last in
order; a source without words has target 0 and emits nothing; sources that a
given weight table leaves out, or weighs 0 or less or NULL, have target 0, and
its rows for one source add up; a NULL id draws as an empty one; rows with one
id draw alike; if all weighted sources are at their caps, targets sum to less
than all words; an empty table gives no rows. Other columns are not read by
``copies``; ``mixed`` keeps them under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import SPACE_CLASS, ranked, settle

#: Weights of the sources in code point order, repeating (fixed values).
CYCLE = (1, 2, 3)
DIGITS = 13  # hex digits that a double holds exactly


def n_words(text: Column) -> Column:
    """Words between ASCII white space: pieces of a split, less the empty ones
    that white space at either end leaves."""
    def blank(character):
        return character.rlike(f"[{SPACE_CLASS}]").cast("long")

    pieces = F.size(F.split(text, f"[{SPACE_CLASS}]+")).cast("long")
    return F.when(F.length(text) > 0, pieces - blank(F.substring(text, 1, 1)) - blank(F.substring(text, -1, 1))).otherwise(
        F.lit(0).cast("long"))


def source_sizes(sized: DataFrame) -> DataFrame:
    """(source, source_size) per source, written once."""
    return settle(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")


def cycle_weights(sources: DataFrame, cycle: tuple = CYCLE) -> DataFrame:
    """(source, weight): the cycle's weights in code point order, NULL last."""
    place = ranked(sources.select("source"), [F.asc_nulls_last("source")], "source_order")
    weights = F.array(*(F.lit(float(w)) for w in cycle))
    return place.select("source", F.get(weights, F.col("rank") % len(cycle)).alias("weight"))


def targets(sources: DataFrame, weights: DataFrame, cap: int = 3) -> DataFrame:
    """(source, source_size, weight, target, rate) per source. Each round
    fixes the sources whose share is over their cap and shares the rest anew;
    shares only grow, so it ends when no more sources are over. A round is one
    aggregate over the table of sources; three sums reach the driver."""
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    known = weights.select(F.col("source").alias("w_source"), weight.alias("weight"))
    table = settle(sources.join(known, sources.source.eqNullSafe(known.w_source), "left").select(
        "source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"),
        (F.col("source_size") * cap).cast("double").alias("most")), "weighted")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    free, open_weight, fixed = float(total), None, -1
    share = F.lit(0.0)
    while True:
        if open_weight is not None:
            share = F.lit(free) * F.col("weight") / open_weight if open_weight else F.lit(float("inf")) * F.signum("weight")
        over = (F.col("weight") > 0) & (share > F.col("most"))
        row = table.agg(
            F.sum(F.when(over, 1).otherwise(0)).alias("n"), F.sum(F.when(over, F.col("most").cast("decimal(38,0)"))).alias("held"),
            F.sum(F.when(~over, F.col("weight").cast("decimal(38,9)"))).alias("weight")).first()
        if open_weight is not None and (row.n or 0) == fixed:
            break
        fixed, free, open_weight = row.n or 0, float(total - int(row.held or 0)), float(row.weight or 0)
    target = F.when(over, F.col("most")).when(F.col("weight") > 0, share).otherwise(0.0)
    rate = F.when(F.col("source_size") == 0, 0.0).when(over, float(cap)).otherwise(
        F.least(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(float(cap))))
    return table.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "weight", "target", "rate")


def draw(seed: int, row_id: Column) -> Column:
    """A number in [0, 1) from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / float(16 ** DIGITS)


def _with_copies(sized: DataFrame, weights: DataFrame | None, cap: int, seed: int) -> DataFrame:
    """``sized`` (row_id, source, size, ...) with its source's figures and the
    number of copies. The table of sources is joined by its real size:
    broadcast while it is small, otherwise by a join that adaptive execution
    can split at a source with very many documents."""
    sources = source_sizes(sized)
    if weights is None:
        weights = cycle_weights(sources)
    else:
        weights = weights.groupBy("source").agg(F.sum("weight").alias("weight"))
    goal = settle(targets(sources, weights, cap), "targets")
    goal = goal.withColumnRenamed("source", "t_source")
    whole = F.floor("rate")
    extra = (draw(seed, F.col("row_id")) < F.col("rate") - whole).cast("long")
    return sized.join(goal, sized.source.eqNullSafe(goal.t_source)).withColumn("copies", whole + extra)


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: DataFrame | None = None, cap: int = 3, seed: int = 42) -> DataFrame:
    """Per row: id, ``source``, ``size``, ``source_size``, ``target``, ``rate``,
    ``copies`` and ``taken`` (size times copies). ``weights`` (source, weight)
    replaces the cycle. Only ids, sources and sizes are written and joined."""
    sized = settle(df.select(F.col(id_col).alias("row_id"), F.col(source_col).cast("string").alias("source"),
                             n_words(F.col(text_col)).alias("size")), "sized")
    return _with_copies(sized, weights, cap, seed).select(
        F.col("row_id").alias(id_col), "source", "size", "source_size", "target", "rate", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: DataFrame | None = None, cap: int = 3, seed: int = 42) -> DataFrame:
    """The mix itself: each row as often as it is taken, with all its columns."""
    sized = df.select(F.struct("*").alias("whole"), F.col(id_col).alias("row_id"),
                      F.col(source_col).cast("string").alias("source"),
                      n_words(F.col(text_col)).alias("size"))
    taken = _with_copies(settle(sized, "sized"), weights, cap, seed).where("copies > 0")
    return taken.select("whole", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("whole.*")
