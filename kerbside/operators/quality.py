"""Data-quality checks (Q1-Q6) and the bounded audit history (K3, T5).

Each check is a count computed on the cluster; Q1-Q3 share one pass over Silver.
``quality_results`` builds all audit rows as one small DataFrame (one row
per check); only those few rows are ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schemas import AUDIT

# Check names and layers as written to the audit history, and
# the history length.
CHECK_UNIQUE = ("Unique IDs", "SILVER")
CHECK_PRICE = ("Price Accuracy", "SILVER")
CHECK_LOGIC = ("ULEZ Logic Integrity", "SILVER")
CHECK_METRICS = ("Metrics Completeness", "GOLD")
AUDIT_KEEP = 100


def check_unique_ids(silver: DataFrame) -> DataFrame:
    """Q1: rows that share a non-NULL id with another row (0 when unique)."""
    dup = (silver.filter(F.col("id").isNotNull()).groupBy("id").count()
                 .filter(F.col("count") > 1))
    return dup.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("error_count"))


def _bad_price(c: Column) -> Column:
    return c <= 0


def _bad_logic() -> Column:
    return ((F.col("fuel_type") == "diesel") & (F.col("year") < 2015)
            & (F.col("is_ulez_compliant") == F.lit(True)))


def check_positive_price(silver: DataFrame) -> DataFrame:
    """Q2: rows with price <= 0 (NULL price not counted)."""
    return silver.agg(F.count(F.when(_bad_price(F.col("price")), F.lit(1))).cast("bigint").alias("error_count"))


def check_compliance_logic(silver: DataFrame) -> DataFrame:
    """Q3: diesel before 2015 flagged compliant (petrol is not checked)."""
    return silver.agg(F.count(F.when(_bad_logic(), F.lit(1))).cast("bigint").alias("error_count"))


def check_metrics_complete(impact: DataFrame) -> DataFrame:
    """Q4: Gold impact rows with NULL percent_diff."""
    return impact.agg(F.count(F.when(F.col("percent_diff").isNull(), F.lit(1))).cast("bigint").alias("error_count"))


def _named(df: DataFrame, check: tuple[str, str]) -> DataFrame:
    name, layer = check
    return df.select(F.lit(layer).alias("layer"), F.lit(name).alias("check_name"), "error_count")


def quality_results(silver: DataFrame, impact: DataFrame | None = None,
                    stamp: bool = True) -> DataFrame:
    """Q5: one audit row per check (Q4 skipped without a Gold mart).
    Columns: [check_timestamp,] layer, check_name, status, error_count."""
    # Q1-Q3 in one pass: per id (partial aggregation before the shuffle, so
    # a hot id arrives pre-reduced), then one global sum.
    per_id = silver.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(_bad_price(F.col("price")), F.lit(1))).alias("p"),
        F.count(F.when(_bad_logic(), F.lit(1))).alias("l"))
    totals = per_id.agg(
        F.coalesce(F.sum(F.when(F.col("id").isNotNull() & (F.col("n") > 1), F.col("n"))), F.lit(0)).cast("bigint").alias("u"),
        F.coalesce(F.sum("p"), F.lit(0)).cast("bigint").alias("p"),
        F.coalesce(F.sum("l"), F.lit(0)).cast("bigint").alias("l"))
    row = lambda check, c: F.struct(F.lit(check[1]).alias("layer"), F.lit(check[0]).alias("check_name"),
                                    F.col(c).alias("error_count"))
    out = totals.select(F.inline(F.array(row(CHECK_UNIQUE, "u"), row(CHECK_PRICE, "p"), row(CHECK_LOGIC, "l"))))
    if impact is not None:
        out = out.unionByName(_named(check_metrics_complete(impact), CHECK_METRICS))
    out = out.withColumn("status", F.when(F.col("error_count") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")))
    cols = ["layer", "check_name", "status", "error_count"]
    if stamp:
        out = out.withColumn("check_timestamp", F.current_timestamp())
        cols = ["check_timestamp", *cols]
    return out.select(*cols)


def run_quality_checks(spark: SparkSession, silver: DataFrame | None, impact: DataFrame | None = None,
                       audit: DataFrame | None = None) -> tuple[bool, DataFrame]:
    """Q5: run the checks, append them to the audit history (K3) and report
    whether all passed. A missing Silver layer fails without audit rows."""
    if silver is None:
        return False, audit if audit is not None else spark.createDataFrame([], AUDIT)
    rows = quality_results(silver, impact).collect()  # one row per check: at most four
    fresh = spark.createDataFrame(rows, AUDIT)
    passed = all(r["status"] == "PASS" for r in rows)
    return passed, append_audit(fresh, audit)


def record_audit(fresh: DataFrame, path: str, keep: int = AUDIT_KEEP) -> DataFrame:
    """K3 on storage: read the history, append, keep the newest, write it as a
    new version of the layer, which readers see only when it is whole."""
    from kerbside.sinks.layers import write_layer
    from kerbside.sources.bronze import read_layer

    history = read_layer(fresh.sparkSession, path, AUDIT)
    return write_layer(append_audit(fresh, history, keep), path)


def append_audit(fresh: DataFrame, history: DataFrame | None = None, keep: int = AUDIT_KEEP) -> DataFrame:
    """K3/T5: history + new records, newest ``keep`` rows kept."""
    both = fresh if history is None else history.unionByName(fresh)
    return both.orderBy(F.col("check_timestamp").desc_nulls_last(), F.col("check_name").asc_nulls_last()).limit(keep)
