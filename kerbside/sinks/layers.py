"""Sinks and materialisation (K1, K2, K5, K6).

Writes are plain parquet datasets (or catalog tables). A layer is never
overwritten in place: it is written whole to a new folder beside its path, and
only then takes the old one's place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bronze(batch: DataFrame, path: str, partition_by: tuple[str, ...] = ("ingest_date",)) -> bool:
    """K1: append one raw batch; nothing is written for an empty batch.

    Bronze is partitioned by ingestion date (derived from the batch's
    ingestion_timestamp), so an incremental Silver run prunes to new days.
    Rows are rebalanced by the partition columns first: a day is one file, or
    as many as its size asks for, instead of one from every task that has rows
    of it. Returns whether anything was written."""
    if batch.isEmpty():
        return False
    out = batch
    if "ingest_date" in partition_by and "ingest_date" not in batch.columns:
        out = batch.withColumn("ingest_date", F.to_date("ingestion_timestamp"))
    out.hint("rebalance", *(F.col(c) for c in partition_by)).write.mode("append").partitionBy(*partition_by).parquet(path)
    return True


def swap_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put the folder ``staged`` in the place of ``path``; the old one stays
    until the new one is there, and comes back if that fails."""
    to = spark._jvm.org.apache.hadoop.fs.Path
    target, new, old = to(path), to(staged), to(f"{path}.__old-{uuid.uuid4().hex[:12]}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"could not move the previous layer at {path}")
    if not replaced:
        fs.mkdirs(target.getParent())
    if not fs.rename(new, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"could not publish the layer at {path}")
    if replaced:
        fs.delete(old, True)


def write_layer(df: DataFrame, path: str, read_back: bool = True) -> DataFrame | None:
    """K2: replace a Silver/Gold layer at ``path`` and, by default, return a
    DataFrame reading it back, which cuts the lineage for every later consumer.
    ``df`` may read the layer it replaces; a failed write leaves that as it is."""
    path = path.rstrip("/")
    staged = f"{path}.__new-{uuid.uuid4().hex[:12]}"
    df.write.parquet(staged)
    swap_folder(df.sparkSession, staged, path)
    return df.sparkSession.read.schema(df.schema).parquet(path) if read_back else None


def save_clusters_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """K5: overwrite the cluster mart as a catalog table, its files under
    ``path`` if given, else in the warehouse."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def materialize(df: DataFrame, name: str, kind: str, location: str) -> DataFrame:
    """K6: 'view' registers a temp view computed on read; 'table' writes a
    catalog table, its files under ``location``, and serves reads from it."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.sparkSession.catalog.dropTempView(name)
        df.sparkSession.sql(f"DROP TABLE IF EXISTS `{name}`")
        df.write.option("path", f"{location.rstrip('/')}/{name}").mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown materialisation {kind!r}")
    return df.sparkSession.table(name)
