"""Read-side tables behind the dashboard.

Each is a projection, a one-pass aggregate or a bounded top-k over a layer;
none brings more than its (fixed-size) result to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Display names and column lists of the dashboard tables.
AUDIT_DISPLAY = {"check_timestamp": "Timestamp", "layer": "Layer", "check_name": "Check Name",
                 "status": "Status", "error_count": "Failures"}
DIESEL_DISPLAY = {"brand": "Brand", "model": "Model", "avg_price_compliant": "Compliant Avg Price",
                  "avg_price_non_compliant": "Non-Compliant Avg Price",
                  "devaluation_percent": "Devaluation (%)"}
CLUSTER_SCATTER = ("MILEAGE", "PRICE", "CLUSTER_NAME", "BRAND", "MODEL", "YEAR")
TOP_LISTING_COLS = ("brand", "model", "year", "price", "fuel_type", "is_ulez_compliant")
ML_FEATURES = ("price", "mileage", "year")


def layer_counts(silver: DataFrame, required=ML_FEATURES) -> DataFrame:
    """A5: total rows and rows usable for ML (all of ``required`` non-NULL), one pass."""
    valid = F.lit(True)
    for c in required:
        valid = valid & F.col(c).isNotNull()
    return silver.agg(F.count(F.lit(1)).alias("total_rows"),
                      F.count(F.when(valid, F.lit(1))).alias("ml_valid_rows"))


def headline_metrics(silver: DataFrame, impact: DataFrame) -> DataFrame:
    """Listings processed and the unweighted mean of percent_diff over
    brands (NULL skipped). One aggregate over the union of both inputs, so
    no join; the mean comes from the exact decimal sum of the 1-dp values."""
    pd = F.col("percent_diff").cast("decimal(20,1)")
    both = (silver.select(F.lit(1).alias("_listing"), F.lit(None).cast("decimal(20,1)").alias("_pd"))
            .unionByName(impact.select(F.lit(None).cast("int").alias("_listing"), pd.alias("_pd"))))
    return both.agg(F.count("_listing").alias("listings_processed"),
                    (F.sum("_pd").cast("double") / F.nullif(F.count("_pd"), F.lit(0))).alias("avg_impact"))


def latest_audit(audit: DataFrame, n: int = 4, display: bool = True) -> DataFrame:
    """The ``n`` newest audit rows (ties by check name), display names."""
    top = audit.orderBy(F.col("check_timestamp").desc_nulls_last(), F.col("check_name").asc_nulls_last()).limit(n)
    if not display:
        return top
    return top.select(*[F.col(k).alias(v) for k, v in AUDIT_DISPLAY.items()])


def trust_score(audit: DataFrame, n: int = 4) -> DataFrame:
    """Share of PASS (in %) among the ``n`` newest audit rows."""
    top = latest_audit(audit, n, display=False)
    return top.agg((F.avg(F.when(F.col("status") == "PASS", F.lit(1)).otherwise(F.lit(0))) * 100)
                   .alias("trust_score"))


def top_listings(silver: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest-priced listings (id breaks ties), six columns."""
    return (silver.orderBy(F.col("price").desc_nulls_last(), F.col("id").asc_nulls_last())
                  .limit(n).select(*TOP_LISTING_COLS))


def impact_ranking(impact: DataFrame) -> DataFrame:
    """T4: brand and percent_diff, ascending, NULLs last."""
    return (impact.select("brand", "percent_diff")
                  .orderBy(F.col("percent_diff").asc_nulls_last(), F.col("brand").asc_nulls_last()))


def diesel_display(diesel: DataFrame) -> DataFrame:
    """The diesel mart with display column names."""
    return diesel.select(*[F.col(k).alias(v) for k, v in DIESEL_DISPLAY.items()])


def cluster_scatter(clusters: DataFrame) -> DataFrame:
    """The columns the cluster scatter plot reads."""
    return clusters.select(*CLUSTER_SCATTER)


def display_tables(diesel: DataFrame | None = None, clusters: DataFrame | None = None) -> dict[str, DataFrame]:
    """The renamed diesel mart and the cluster scatter columns."""
    out: dict[str, DataFrame] = {}
    if diesel is not None:
        out["diesel"] = diesel_display(diesel)
    if clusters is not None:
        out["clusters"] = cluster_scatter(clusters)
    return out
