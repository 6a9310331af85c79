"""Silver as a base and a delta (I1 without rewriting Silver for every batch).

``refresh_silver`` ranks the stored state and a batch together, which moves and
rewrites all of Silver. Here the state is a ``base`` of all ids and a ``delta``
of the ids that have changed since: one row per id, at most ``compact_rows``
ids, so it can be broadcast. A batch costs its own dedup together with the
delta, one scan of the base's id and order columns, and writing the delta.
Readers see the base without the delta's ids, and the delta: an anti join with
a broadcast side, no shuffle. A delta that outgrows its bound is merged into a
new base by one shuffle.

A refresh writes new folders and then replaces the manifest, which names the
current ones; a refresh that fails leaves the old state. One writer at a time.
The first batch becomes the base. The order of rows is that of ``dedup_latest``,
so a late row does not replace a newer one, the NULL id is one row, and the
result after each batch equals a full refresh over all Bronze rows so far.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.dedup import dedup_latest
from kerbside.operators.silver import silver_candidates, silver_columns
from kerbside.session import scratch_path
from kerbside.sinks.layers import write_layer
from kerbside.sources.bronze import read_layer

# Most ids of a delta: what readers broadcast is bounded by it.
COMPACT_ROWS = 1_000_000
MANIFEST = "base string, delta string, n_delta long, version long"


def manifest(spark: SparkSession, root: str) -> Row | None:
    """The current version, None where there is none."""
    return read_layer(spark, f"{root}/manifest", spark.createDataFrame([], MANIFEST).schema).first()


def _order_of(df: DataFrame, order: Sequence[str]) -> Column:
    """A row's place in the dedup order, which compares as that does: field by
    field, NULL below all values."""
    return F.struct(*(df[c] for c in order))


def _publish(spark: SparkSession, root: str, base: str, delta: str, n_delta: int, version: int) -> Row:
    write_layer(spark.createDataFrame([(base, delta, n_delta, version)], MANIFEST).coalesce(1), f"{root}/manifest")
    return manifest(spark, root)


def refresh_store(spark: SparkSession, new_bronze: DataFrame, root: str, tie_breakers: Sequence[str] = (),
                  rule: str = "strict", stamp: bool = True, compact_rows: int = COMPACT_ROWS) -> Row:
    """Bring the store up to date with a batch of Bronze rows; the new manifest."""
    root = root.rstrip("/")
    fresh, order = silver_candidates(new_bronze, tie_breakers, rule, stamp)
    cols = [*silver_columns(stamp), *order]
    fresh = fresh.select(*cols)
    now = manifest(spark, root)
    version = now.version + 1 if now else 1
    stored = lambda name: spark.read.schema(fresh.schema).parquet(f"{root}/{name}")
    if now:
        fresh = stored(now.delta).unionByName(fresh)
    ranked = write_layer(dedup_latest(fresh, "id", order), scratch_path(spark, "batch"))
    names = {kind: f"{kind}-{version}-{uuid.uuid4().hex[:12]}" for kind in ("base", "delta")}
    n_delta = ranked.count()
    if now is None or n_delta > compact_rows:
        merged = ranked if now is None else dedup_latest(stored(now.base).unionByName(ranked), "id", order)
        merged.write.parquet(f"{root}/{names['base']}")
        ranked.limit(0).write.parquet(f"{root}/{names['delta']}")
        return _publish(spark, root, names["base"], names["delta"], 0, version)
    base = stored(now.base)
    ids = ranked.select(F.col("id").alias("__id"))
    rivals = base.join(F.broadcast(ids), base["id"].eqNullSafe(ids["__id"]), "left_semi")
    rivals = rivals.select(F.col("id").alias("__id"), _order_of(rivals, order).alias("__held"))
    held = ranked.join(rivals, ranked["id"].eqNullSafe(rivals["__id"]), "left")
    won = held.where(F.col("__held").isNull() | (_order_of(ranked, order) > F.col("__held"))).select(*cols)
    won.write.parquet(f"{root}/{names['delta']}")
    return _publish(spark, root, now.base, names["delta"], stored(names["delta"]).count(), version)


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """Silver as of the last refresh. The delta's ids are broadcast: their
    number, checked against the bound at every refresh, is in the manifest."""
    root = root.rstrip("/")
    now = manifest(spark, root)
    if now is None:
        raise FileNotFoundError(f"no Silver store in {root}")
    base = spark.read.parquet(f"{root}/{now.base}")
    out = [c for c in base.columns if not c.startswith("__tb_")]
    if not now.n_delta:
        return base.select(*out)
    delta = spark.read.schema(base.schema).parquet(f"{root}/{now.delta}")
    ids = delta.select(F.col("id").alias("__id"))
    kept = base.join(F.broadcast(ids), base["id"].eqNullSafe(ids["__id"]), "left_anti")
    return kept.select(*out).unionByName(delta.select(*out))


def drop_old_versions(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders that the manifest no longer names; their names. Call
    it when no reader of an older version is left."""
    now = manifest(spark, root)
    if now is None:
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(path)]
    old = [p for p in found if p.getName().startswith(("base-", "delta-")) and p.getName() not in (now.base, now.delta)]
    for p in old:
        fs.delete(p, True)
    return sorted(p.getName() for p in old)
