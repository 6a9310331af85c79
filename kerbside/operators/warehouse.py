"""Warehouse-version operators: staging, fact, change-feed projections,
backfill anti join, column-list append and schema evolution.

Fact columns: brand, model, year, price, transmission, mileage, fuel_type,
tax, mpg, engine_size, is_ulez_compliant, vehicle_age, price_per_mile.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.compliance import AS_OF_YEAR, compliance_flag, price_per_mile, vehicle_age
from kerbside.functions.listing import brand_from_title
from kerbside.functions.prices import parse_price
from kerbside.schemas import WAREHOUSE_FACT

# Change action kept by the feeds, and the literal brand of the
# Mercedes feed.
INSERT_ACTION = "INSERT"
MERCEDES = "MERCEDES"


def conform(df: DataFrame, schema: T.StructType, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """K4/K7: the canonical column list in order; an absent column is NULL of
    its type (or its default), present ones are cast."""
    defaults = dict(defaults or {})
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name).cast(f.dataType)
            if f.name in defaults:
                c = F.coalesce(c, defaults[f.name].cast(f.dataType))
        elif f.name in defaults:
            c = defaults[f.name].cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def append_with_column_list(df: DataFrame, schema: T.StructType = WAREHOUSE_FACT) -> DataFrame:
    """K4: rows shaped for an INSERT naming a subset of the fact's columns."""
    return conform(df, schema)


def evolve_schema(df: DataFrame, schema: T.StructType, stamp_col: str | None = None) -> DataFrame:
    """K7: add absent columns (ADD COLUMN IF NOT EXISTS) and default a
    timestamp column to the current time (DEFAULT CURRENT_TIMESTAMP())."""
    defaults = {stamp_col: F.current_timestamp()} if stamp_col else None
    return conform(df, schema, defaults)


def inserts_only(df: DataFrame, action_col: str = "action") -> DataFrame:
    """Keep change rows whose action is INSERT."""
    return df.filter(F.col(action_col) == INSERT_ACTION)


def stage_listings(raw: DataFrame, price_mode: str = "fail") -> DataFrame:
    """P13 (+P12, P2): the staging view over the API raw table: brand from the
    title's first word, model (absent -> title), text price hard-cast after
    dropping commas, tax and mpg constant 0."""
    model = F.col("model") if "model" in raw.columns else F.col("title")
    return raw.select(
        brand_from_title("title").alias("brand"),
        model.alias("model"),
        F.col("year"),
        parse_price("price", price_mode).alias("price"),
        F.col("transmission"),
        F.col("mileage"),
        F.col("fuelType").alias("fuel_type"),
        F.lit(0).alias("tax"),
        F.lit(0).alias("mpg"),
        F.col("engineSize").alias("engine_size"),
    )


def build_fact(staged: DataFrame, as_of_year: int = AS_OF_YEAR, zero: str = "zero") -> DataFrame:
    """dbt fact: staged columns + lenient flag (P8), age (P9), price per mile (P10)."""
    return staged.withColumns({
        "is_ulez_compliant": compliance_flag("fuel_type", "year", rule="lenient"),
        "vehicle_age": vehicle_age("year", as_of_year),
        "price_per_mile": price_per_mile("price", "mileage", zero=zero),
    })


def merc_feed_rows(changes: DataFrame, as_of_year: int = AS_OF_YEAR) -> DataFrame:
    """G1 body: INSERT rows of the Mercedes change feed -> fact rows."""
    rows = inserts_only(changes) if "action" in changes.columns else changes
    out = rows.select(
        F.lit(MERCEDES).alias("brand"),
        "model", "year", F.col("price").cast("double").alias("price"), "transmission", "mileage",
        F.col("fuelType").alias("fuel_type"), "tax", "mpg",
        F.col("engineSize").alias("engine_size"),
        compliance_flag("fuelType", "year", rule="lenient").alias("is_ulez_compliant"),
        vehicle_age("year", as_of_year).alias("vehicle_age"),
        price_per_mile("price", "mileage", zero="null").alias("price_per_mile"),
    )
    return append_with_column_list(out)


def listing_feed_rows(raw: DataFrame, as_of_year: int = AS_OF_YEAR, only_inserts: bool = True) -> DataFrame:
    """G2 body / J1 projection: API rows -> fact rows. The title becomes the
    model, text prices parse to whole pounds or NULL, tax and mpg stay NULL."""
    rows = inserts_only(raw) if only_inserts and "action" in raw.columns else raw
    rows = migrate_title_as_model(rows)
    price = parse_price("price", "null")
    out = rows.select(
        "brand", "model", "year",
        price.cast("double").alias("price"),
        "transmission", "mileage",
        F.col("fuelType").alias("fuel_type"),
        F.col("engineSize").alias("engine_size"),
        compliance_flag("fuelType", "year", rule="lenient").alias("is_ulez_compliant"),
        vehicle_age("year", as_of_year).alias("vehicle_age"),
        price_per_mile(price, "mileage", zero="null").alias("price_per_mile"),
    )
    return append_with_column_list(out)


def backfill_missing(raw: DataFrame, fact: DataFrame, as_of_year: int = AS_OF_YEAR) -> DataFrame:
    """Raw rows whose title is not yet a model in the fact (NOT EXISTS).

    A left anti equi join: a NULL title never matches, so it is kept; matches
    run across brands; no in-batch dedup. The fact side is reduced to its
    distinct models first (partial aggregation before the shuffle), and the
    join is left to AQE, which broadcasts it only if its measured size is
    small and splits skewed title partitions otherwise.
    """
    models = fact.select(F.col("model").alias("__fact_model")).distinct()
    missing = raw.join(models, raw["title"] == models["__fact_model"], "left_anti")
    return listing_feed_rows(missing, as_of_year, only_inserts=False)


def external_listing_view(silver: DataFrame) -> DataFrame:
    """Typed projection over lake parquet of Silver."""
    return silver.select(
        F.col("id").cast("string").alias("advert_id"),
        F.col("brand").cast("string").alias("brand"),
        F.col("fuel_type").cast("string").alias("fuel_type"),
        F.col("year").cast("int").alias("year"),
        F.col("is_ulez_compliant").cast("boolean").alias("is_ulez_compliant"),
        F.col("processed_at").cast("timestamp").alias("processed_at"),
    )


def migrate_title_as_model(raw: DataFrame) -> DataFrame:
    """The API feed's title stands in for the model."""
    return raw.withColumn("model", F.col("title"))
