"""Per-brand raw sources.

The warehouse declares one raw table per brand, documented as per-brand CSV
files. Laid out as ``root/brand=<name>/*.csv`` they are one scan with
partition discovery (the brand comes from the folder, and a brand filter
prunes folders); given as a mapping, each source is read with the declared
schema, tagged with its brand and the reads are unioned by name.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.warehouse import conform


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    if fmt == "csv":
        # Columns are taken by header, not by position. The header comes from
        # one file; a file whose header has another order or other names fails
        # the read (enforceSchema=false) rather than filling wrong columns.
        reader = spark.read.option("header", "true")
        names = reader.csv(path).schema
        return conform(reader.option("enforceSchema", "false").schema(names).csv(path), schema)
    return spark.read.schema(schema).format(fmt).load(path)


def brand_sources_union(spark: SparkSession, sources: str | Mapping[str, str | DataFrame],
                        schema: T.StructType, fmt: str = "csv", brand_col: str = "brand") -> DataFrame:
    """All brand sources as one table with a ``brand`` column."""
    if isinstance(sources, str):
        with_brand = T.StructType([*schema.fields, T.StructField(brand_col, T.StringType(), True)])
        return _read(spark, sources, with_brand, fmt)
    parts = []
    for brand, src in sources.items():
        df = src if isinstance(src, DataFrame) else _read(spark, src, schema, fmt)
        parts.append(df.withColumn(brand_col, F.lit(brand)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
