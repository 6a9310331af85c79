"""Silver / warehouse fact -> Gold marts.

Every mart is one hash aggregate with a map-side partial step, so a hot
brand or model is pre-reduced per task before the shuffle; the top-10 marts
plan as ``TakeOrderedAndProject`` over the (small) grouped result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.compliance import exact_mean, exact_price, price_efficiency, vehicle_age


def _gap_percent(avg_compliant: Column, avg_non_compliant: Column) -> Column:
    return F.round((avg_non_compliant - avg_compliant) / F.nullif(avg_compliant, F.lit(0)) * 100, 1)


def _price_split(flag: Column, price: Column) -> tuple[Column, Column]:
    return (exact_mean(F.when(flag, price)).alias("avg_price_compliant"),
            exact_mean(F.when(~flag, price)).alias("avg_price_non_compliant"))


def market_impact(silver: DataFrame) -> DataFrame:
    """A1: per brand, mean price of compliant vs non-compliant listings and
    the gap in percent of the compliant mean (NULL when a side is missing)."""
    flag, price = F.col("is_ulez_compliant"), F.col("price")
    agg = silver.groupBy("brand").agg(*_price_split(flag, price))
    return agg.withColumn("percent_diff", _gap_percent(F.col("avg_price_compliant"),
                                                       F.col("avg_price_non_compliant")))


def diesel_devaluation(silver: DataFrame, top: int = 10) -> DataFrame:
    """A2: diesel models having both sides, top ``top`` by devaluation_percent
    DESCENDING (the local pipeline's order: the smallest drops come first;
    see ``diesel_devaluation_ranked`` for the ascending warehouse variant)."""
    flag, price = F.col("is_ulez_compliant"), F.col("price")
    agg = (silver.filter(F.col("fuel_type") == "diesel")
                 .groupBy("brand", "model").agg(*_price_split(flag, price))
                 .filter(F.col("avg_price_compliant").isNotNull()
                         & F.col("avg_price_non_compliant").isNotNull()))
    out = agg.withColumn("devaluation_percent", _gap_percent(F.col("avg_price_compliant"),
                                                             F.col("avg_price_non_compliant")))
    return out.orderBy(F.col("devaluation_percent").desc_nulls_last(),
                       F.col("brand").asc_nulls_last(), F.col("model").asc_nulls_last()).limit(top)


def diesel_devaluation_ranked(fact: DataFrame, top: int = 10) -> DataFrame:
    """A3 (warehouse): exact-case 'Diesel', at least one listing on each side,
    whole-pound rounded means, devaluation amount and percent, ASCENDING."""
    flag, price = F.col("is_ulez_compliant"), exact_price("price")
    stats = (fact.filter(F.col("fuel_type") == "Diesel")
                 .groupBy("brand", "model")
                 .agg(exact_mean(F.when(flag, price)).alias("c"),
                      exact_mean(F.when(~flag, price)).alias("nc"),
                      F.count(F.when(flag, F.lit(1))).alias("n_c"),
                      F.count(F.when(~flag, F.lit(1))).alias("n_nc"))
                 .filter((F.col("n_c") >= 1) & (F.col("n_nc") >= 1)))
    c, nc = F.col("c"), F.col("nc")
    out = stats.select(
        "brand", "model",
        F.round(c, 0).alias("avg_price_compliant"),
        F.round(nc, 0).alias("avg_price_non_compliant"),
        F.round(c - nc, 0).alias("devaluation_amount"),
        _gap_percent(c, nc).alias("devaluation_percent"))
    return out.orderBy(F.col("devaluation_percent").asc_nulls_last(),
                       F.col("brand").asc_nulls_last(), F.col("model").asc_nulls_last()).limit(top)


def impact_summary(fact: DataFrame) -> DataFrame:
    """A4 + P18: per brand, year, fuel and flag: count, rounded means of price,
    mileage and age, and price_efficiency from the *rounded* means."""
    age = F.col("vehicle_age") if "vehicle_age" in fact.columns else vehicle_age("year")
    agg = (fact.groupBy("brand", "year", "fuel_type", "is_ulez_compliant")
               .agg(F.count(F.lit(1)).alias("total_listings"),
                    F.round(exact_mean(exact_price("price")), 2).alias("avg_price"),
                    F.round(exact_mean(F.col("mileage")), 2).alias("avg_mileage"),
                    F.round(exact_mean(age), 1).alias("avg_age")))
    return agg.withColumn("price_efficiency", price_efficiency("avg_price", "avg_age"))


# Display names of the two average columns.
CATEGORY_NAMES = {"avg_price_compliant": "Compliant Price",
                  "avg_price_non_compliant": "Non-Compliant Price"}


def price_gap_long(impact: DataFrame) -> DataFrame:
    """Melt the two averages to (brand, category, average_price); NULLs kept."""
    long = impact.unpivot(["brand"], list(CATEGORY_NAMES), "category", "average_price")
    label = F.col("category")
    for code, name in CATEGORY_NAMES.items():
        label = F.when(F.col("category") == code, F.lit(name)).otherwise(label)
    return long.withColumn("category", label)
