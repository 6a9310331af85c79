"""Bronze read with schema drift (S2, S3) and typed layer reads.

Files written at different times disagree on which optional columns exist, and
on types (a batch with a missing ``year`` lands as DOUBLE, another as BIGINT).
Files that differ only in columns are one scan with merged schemas. Where types
conflict, the same is tried folder by folder and, in a folder that still
conflicts, file by file; files with equal schemas are one scan. Each scan is
conformed to the canonical Bronze schema (cast, absent -> NULL) and the scans
are unioned by name. Everything is read through Spark's own file systems, so
any storage that Spark reads will do. A folder written by ``write_bronze``
has the canonical schema throughout and is always a single scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.warehouse import conform
from kerbside.schemas import BRONZE

EMPTY = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _scan(spark: SparkSession, paths: Sequence[str], merge: bool = True) -> DataFrame:
    """All parquet files under ``paths``, however deep and in whatever folders.
    Partition folders are not turned into columns, for which files beside such
    folders would be left out; nanosecond stamps are read as numbers."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", str(merge).lower())
    return reader.parquet(*paths)


def _merged(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """One scan with merged schemas, or None where types conflict."""
    try:
        return _scan(spark, paths)
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" in str(e):
            return None
        raise


def list_files(spark: SparkSession, root: str | Sequence[str]) -> list[str]:
    """Data files under ``root`` as plain paths, by Spark's file index."""
    roots = [root] if isinstance(root, str) else list(root)
    try:
        return sorted(unquote(f) for f in _scan(spark, roots, merge=False).inputFiles())
    except PySparkException as e:
        if any(x in str(e) for x in EMPTY):
            return []
        raise


def _scans(spark: SparkSession, files: Sequence[str]) -> list[DataFrame]:
    """The fewest scans that read files of conflicting types."""
    folders: dict[str, list[str]] = {}
    for f in files:
        folders.setdefault(f.rsplit("/", 1)[0], []).append(f)
    out, single = [], {}
    for members in folders.values():
        df = _merged(spark, members)
        if df is not None:
            out.append(df)
            continue
        for f in members:
            single.setdefault(_scan(spark, [f], merge=False).schema.json(), []).append(f)
    return out + [_scan(spark, group, merge=False) for group in single.values()]


PARTITION_DATE = re.compile(r"/ingest_date=(\d{4}-\d{2}-\d{2})/")


def prune_by_ingest_date(files: Sequence[str], since: str) -> list[str]:
    """Files that can hold rows from ``since`` (YYYY-MM-DD) on: those in
    ``ingest_date=`` folders of that day or later, and all undated ones."""
    dated = ((f, PARTITION_DATE.search(f)) for f in files)
    return [f for f, m in dated if m is None or m.group(1) >= since]


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Nanosecond stamps to timestamps, then the canonical columns."""
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampType) and f.name in df.columns and isinstance(df.schema[f.name].dataType, T.LongType):
            df = df.withColumn(f.name, F.expr(f"timestamp_micros(`{f.name}` div 1000)"))
    return conform(df, schema)


def read_bronze_union(spark: SparkSession, root: str | Sequence[str], schema: T.StructType = BRONZE,
                      keep_extra: Sequence[str] = (), since: str | None = None) -> DataFrame:
    """All Bronze files, columns matched by name, absent columns NULL,
    types cast to ``schema``. With ``since``, the rows ingested from that day
    on (the input of an incremental Silver run): older date folders are not
    read, undated files are read and filtered by their stamp. Raises
    FileNotFoundError when there are no files (Q6)."""
    roots = [root] if isinstance(root, str) else list(root)
    if since is not None:
        roots = prune_by_ingest_date(list_files(spark, roots), since)
    try:
        whole = _merged(spark, roots) if roots else None
        parts = [whole] if whole is not None else _scans(spark, list_files(spark, roots) if roots else [])
    except PySparkException as e:
        if not any(x in str(e) for x in EMPTY):
            raise
        parts = []
    if not parts:
        raise FileNotFoundError(f"no Bronze files to read in {root}")
    target = T.StructType(list(schema.fields) + [
        T.StructField(c, T.StringType(), True) for c in keep_extra if c not in schema.fieldNames()])
    out = []
    for df in parts:
        extra = {c: df.schema[c].dataType for c in keep_extra if c in df.columns}
        out.append(_typed(df, T.StructType([T.StructField(f.name, extra.get(f.name, f.dataType), True) for f in target.fields])))
    union = reduce(lambda a, b: a.unionByName(b), out)
    return union if since is None else union.where(F.col("ingestion_timestamp") >= F.lit(since).cast("timestamp"))


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A layer with a known schema; a missing path is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise
