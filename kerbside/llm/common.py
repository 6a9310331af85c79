"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (loads pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.session import scratch_path

#: ASCII white space 0x20, 0x09-0x0D as a Java character class.
SPACE_CLASS = r"\x20\x09-\x0D"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back: cuts
    the lineage, and a lost executor costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: Column | str) -> Column:
    """Text as raw UTF-8 bytes, so that Arrow passes any stored bytes through."""
    return (F.col(column) if isinstance(column, str) else column).cast("string").cast("binary")


def text_of(raw: bytes | None) -> str:
    return "" if raw is None else raw.decode("utf-8", "replace")


def slices(batches: Iterable[pa.RecordBatch], size_column: int, max_bytes: int = 4 << 20,
           max_rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of about ``max_bytes`` of the given binary
    column, so that a task's Python memory follows the longest text and not
    the number of rows in a batch."""
    for batch in batches:
        sizes = [0 if v is None else v for v in pa.compute.binary_length(batch.column(size_column)).to_pylist()]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > max_bytes or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``rank``, the row's place (from 0) in the whole order, and
    no task that sees all rows: a range partitioning, sorted within partitions
    and written once; a row's rank is its partition's offset, from one count
    per partition, plus its place in it. Rows that tie in ``order`` are ranked
    as they are stored, and a very common key is spread over partitions. Pass
    a settled table, whose stored order is fixed."""
    tied = df.withColumn("tie", F.monotonically_increasing_id())
    by = [*order, F.col("tie")]
    place = F.monotonically_increasing_id()
    placed = settle(tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie").withColumns(
        {"part": F.shiftright(place, 33), "place": place.bitwiseAND(F.lit((1 << 33) - 1))}), name)
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition of the sort: bounded by the partition count.
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    return (placed.join(F.broadcast(counts.select("part", before.alias("before"))), "part")
            .withColumn("rank", F.col("before") + F.col("place")).drop("part", "place", "before"))
