"""Bronze -> Silver: fallbacks, typing, fuel normalisation, compliance, dedup.

Silver columns: id, brand, model, year, price DECIMAL(10,2), mileage,
fuel_type, engine_size, transmission, is_ulez_compliant, processed_at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.compliance import compliance_flag, normalize_fuel
from kerbside.functions.prices import cast_price
from kerbside.operators.dedup import dedup_latest

# Fixed value: fallback for missing brand / model.
UNKNOWN = "UNKNOWN"

SILVER_COLUMNS = ("id", "brand", "model", "year", "price", "mileage", "fuel_type",
                  "engine_size", "transmission", "is_ulez_compliant", "processed_at")

# Columns Silver cannot be built without (named directly, no fallback).
REQUIRED_BRONZE = ("id", "year", "price", "mileage", "fuelType", "engineSize",
                   "transmission", "ingestion_timestamp")


def detect_columns(df: DataFrame, optional: Sequence[str] = ("brand", "model", "title")) -> dict[str, bool]:
    """S3: which optional columns exist (schema metadata only, no job)."""
    present = set(df.columns)
    return {c: c in present for c in optional}


def fallback_columns(df: DataFrame) -> DataFrame:
    """Brand -> 'UNKNOWN'; model -> title -> 'UNKNOWN'. Absent columns
    count as NULL; an empty string is kept."""
    have = detect_columns(df)
    col = {c: (F.col(c) if ok else F.lit(None).cast("string")) for c, ok in have.items()}
    return df.withColumns({
        "brand": F.coalesce(col["brand"], F.lit(UNKNOWN)),
        "model": F.coalesce(col["model"], col["title"], F.lit(UNKNOWN)),
    })


def clean_listings(bronze: DataFrame, rule: str = "strict", stamp: bool = True) -> DataFrame:
    """P4-P7 and P14 on Bronze rows, keeping the columns dedup orders by."""
    missing = [c for c in REQUIRED_BRONZE if c not in bronze.columns]
    if missing:
        raise ValueError(f"Bronze is missing required columns: {missing}")
    df = fallback_columns(bronze)
    fuel = normalize_fuel("fuelType")
    out = df.withColumns({
        "price": cast_price("price"),
        "fuel_type": fuel,
        "engine_size": F.col("engineSize"),
        "is_ulez_compliant": compliance_flag(fuel, F.col("year"), rule),
    })
    return stamp_processed(out) if stamp else out


def stamp_processed(df: DataFrame) -> DataFrame:
    """Processing time of the run (one value per query)."""
    return df.withColumn("processed_at", F.current_timestamp())


def silver_candidates(bronze: DataFrame, tie_breakers: Sequence[str] = (), rule: str = "strict",
                      stamp: bool = True) -> tuple[DataFrame, list[str]]:
    """Cleaned Bronze rows (P4-P7, P14) with their dedup order columns, which
    are copies of the *raw* Bronze values (the raw price, not the cast one)."""
    order = ["ingestion_timestamp", *[c for c in tie_breakers if c != "ingestion_timestamp"]]
    renamed = {c: f"__tb_{c}" for c in order}
    staged = bronze.withColumns({v: F.col(k) for k, v in renamed.items()})
    return clean_listings(staged, rule=rule, stamp=stamp), list(renamed.values())


def silver_state(bronze: DataFrame, tie_breakers: Sequence[str] = (), rule: str = "strict", stamp: bool = True) -> DataFrame:
    """Silver with its dedup order columns (``__tb_*``) beside it: what a later
    batch is ranked against in an incremental run."""
    df, order = silver_candidates(bronze, tie_breakers, rule, stamp)
    return dedup_latest(df, "id", order).select(*silver_columns(stamp), *order)


def silver_columns(stamp: bool = True) -> list[str]:
    return [c for c in SILVER_COLUMNS if stamp or c != "processed_at"]


def build_silver(bronze: DataFrame, tie_breakers: Sequence[str] = (), rule: str = "strict",
                 stamp: bool = True) -> DataFrame:
    """P4-P7, P14, then W1: the newest row per id by ingestion_timestamp."""
    df, order = silver_candidates(bronze, tie_breakers, rule, stamp)
    return dedup_latest(df, "id", order).select(*silver_columns(stamp))


def guard_nonempty(df: DataFrame, what: str = "Silver") -> DataFrame:
    """Q6: abort when a layer came out empty (one cheap LIMIT 1 job)."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows; later layers are not built")
    return df
