"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver's tables (or data Spark derives from them) in full.
Keys match ``kerbside.oracle.ORACLE`` where a SQL oracle exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.ml.functions import vector_to_array

from kerbside.operators import gold, governance, pricing, quality, segments, serving
from kerbside.operators import warehouse as wh
from kerbside.plans import medallion, warehouse_models
from kerbside.operators.dedup import dedup_latest
from kerbside.operators.silver import build_silver, silver_columns, silver_state
from kerbside.functions.prices import parse_price
from kerbside.session import scratch_path
from kerbside.schemas import API_RAW, SILVER, WAREHOUSE_FACT
from kerbside.sinks.layers import save_clusters_table, write_layer
from kerbside.sources import bronze, documents
from kerbside.sources import warehouse as wsrc
from kerbside.sources import fixtures as fx
from kerbside.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def silver(spark: SparkSession, sf_dir: str, stamp: bool = False) -> DataFrame:
    return build_silver(fx.listings_raw(spark, sf_dir), tie_breakers=fx.LISTING_TIE_BREAKERS, stamp=stamp)


def shared_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver for queries that read it more than once (checks, marts, model
    fits): written once as parquet to the shared folder, so each reader scans
    only its columns and the dedup is not repeated."""
    return write_layer(silver(spark, sf_dir), scratch_path(spark, "silver"))


@register("silver_listings")
def q_silver_listings(spark, sf_dir):
    return silver(spark, sf_dir)


@register("market_impact")
def q_market_impact(spark, sf_dir):
    return gold.market_impact(silver(spark, sf_dir))


@register("diesel_devaluation")
def q_diesel_devaluation(spark, sf_dir):
    return gold.diesel_devaluation(silver(spark, sf_dir))


# --- warehouse version -------------------------------------------------------

def warehouse_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one warehouse fact: INSERT rows of the API feed (G2's body)."""
    return wh.listing_feed_rows(fx.api_raw(spark, sf_dir))


@register("warehouse_fact")
def q_warehouse_fact(spark, sf_dir):
    return warehouse_fact(spark, sf_dir)


@register("merc_feed")
def q_merc_feed(spark, sf_dir):
    return wh.merc_feed_rows(fx.merc_raw(spark, sf_dir))


@register("diesel_devaluation_ranked")
def q_diesel_devaluation_ranked(spark, sf_dir):
    return gold.diesel_devaluation_ranked(warehouse_fact(spark, sf_dir))


@register("impact_summary")
def q_impact_summary(spark, sf_dir):
    return gold.impact_summary(warehouse_fact(spark, sf_dir))


@register("stage_listings")
def q_stage_listings(spark, sf_dir):
    return wh.stage_listings(fx.stage_raw(spark, sf_dir))


@register("run_warehouse_models")
def q_run_warehouse_models(spark, sf_dir):
    return warehouse_models.run_warehouse_models(fx.stage_raw(spark, sf_dir))["mart_ulez_impact"]


@register("warehouse_fact_dbt")
def q_warehouse_fact_dbt(spark, sf_dir):
    return warehouse_models.run_warehouse_models(fx.stage_raw(spark, sf_dir))["fct_cars"]


@register("backfill_missing")
def q_backfill_missing(spark, sf_dir):
    fact_models = fx.listings_raw(spark, sf_dir).select("model").filter(F.col("model").isNotNull())
    return wh.backfill_missing(fx.api_raw(spark, sf_dir), fact_models)


@register("external_listing_view")
def q_external_listing_view(spark, sf_dir):
    return wh.external_listing_view(silver(spark, sf_dir, stamp=True)).drop("processed_at")


# --- serving tables ----------------------------------------------------------

@register("price_gap_long")
def q_price_gap_long(spark, sf_dir):
    return gold.price_gap_long(gold.market_impact(silver(spark, sf_dir)))


@register("top_listings")
def q_top_listings(spark, sf_dir):
    return serving.top_listings(silver(spark, sf_dir))


@register("impact_ranking")
def q_impact_ranking(spark, sf_dir):
    return serving.impact_ranking(gold.market_impact(silver(spark, sf_dir)))


@register("headline_metrics")
def q_headline_metrics(spark, sf_dir):
    s = shared_silver(spark, sf_dir)
    return serving.headline_metrics(s, gold.market_impact(s))


@register("layer_counts")
def q_layer_counts(spark, sf_dir):
    return serving.layer_counts(silver(spark, sf_dir))


@register("diesel_display")
def q_diesel_display(spark, sf_dir):
    return serving.diesel_display(gold.diesel_devaluation(silver(spark, sf_dir)))


# --- data quality -------------------------------------------------------------

@register("check_unique_ids")
def q_check_unique_ids(spark, sf_dir):
    # On Bronze-shaped rows (before dedup), where ids do repeat.
    return quality.check_unique_ids(fx.listings_raw(spark, sf_dir))


@register("check_positive_price")
def q_check_positive_price(spark, sf_dir):
    return quality.check_positive_price(silver(spark, sf_dir))


@register("check_compliance_logic")
def q_check_compliance_logic(spark, sf_dir):
    return quality.check_compliance_logic(silver(spark, sf_dir))


@register("check_metrics_complete")
def q_check_metrics_complete(spark, sf_dir):
    return quality.check_metrics_complete(gold.market_impact(silver(spark, sf_dir)))


@register("run_quality_checks")
def q_run_quality_checks(spark, sf_dir):
    s = shared_silver(spark, sf_dir)
    return quality.quality_results(s, gold.market_impact(s), stamp=False)


# --- governance ----------------------------------------------------------------

# Stand-ins for the developer role's two brands on the derived data.
FIXTURE_DEV_BRANDS = ("Brand#1", "Brand#2")
ROLES = {"admin": "ULEZ_ADMIN", "developer": "ULEZ_DEVELOPER", "auditor": "ULEZ_AUDITOR"}


def _governed_impact(role):
    def q(spark, sf_dir):
        impact = gold.market_impact(silver(spark, sf_dir))
        return governance.governed_view(impact, role, text_cols=(), developer_brands=FIXTURE_DEV_BRANDS)
    return q


def _masked_listings(role):
    def q(spark, sf_dir):
        return governance.mask_columns(silver(spark, sf_dir), role, price_cols=("price",), text_cols=("model",))
    return q


for _short, _role in ROLES.items():
    register(f"governed_impact_{_short}")(_governed_impact(_role))
    register(f"masked_listings_{_short}")(_masked_listings(_role))


@register("governed_diesel_developer")
def q_governed_diesel_developer(spark, sf_dir):
    diesel = gold.diesel_devaluation(silver(spark, sf_dir))
    return governance.governed_view(diesel, ROLES["developer"], developer_brands=FIXTURE_DEV_BRANDS)


# --- sources: documents, drifting Bronze, change streams ----------------------

def _extracted(listings: DataFrame) -> DataFrame:
    return documents.extract_listings(listings).withColumn("price", parse_price("price", "zero"))


@register("extract_listings")
def q_extract_listings(spark, sf_dir):
    docs = fx.listing_documents(spark, sf_dir)
    return _extracted(documents.explode_listings(docs, "response"))


@register("read_listing_documents")
def q_read_listing_documents(spark, sf_dir):
    # Save the responses as JSON lines in the shared folder, then read them back.
    path = scratch_path(spark, "documents")
    documents.save_documents(fx.listing_documents(spark, sf_dir), path)
    return _extracted(documents.read_listing_documents(spark, path, per_line=True))


@register("read_bronze_union")
def q_read_bronze_union(spark, sf_dir):
    # Two Bronze layouts: odd lines without `model` and `year` BIGINT, even
    # lines without `title` and `year` DOUBLE.
    raw = fx.listings_raw(spark, sf_dir)
    odd = F.col("tie_line") % 2 == 1
    a, b = scratch_path(spark, "bronze-a"), scratch_path(spark, "bronze-b")
    raw.filter(odd).drop("model").withColumn("year", F.col("year").cast("bigint")).write.parquet(a)
    raw.filter(~odd).drop("title").withColumn("year", F.col("year").cast("double")).write.parquet(b)
    ties = ("tie_line", "tie_part", "tie_supp")
    return bronze.read_bronze_union(spark, [a, b], keep_extra=ties).drop("ingestion_timestamp")


# The Mercedes feed's raw rows are a projection of lineitem here.
LINEITEM_FEED = {"glob": "lineitem.parquet", "raw": fx.project_merc}


@register("stream_brand_feed")
def q_stream_brand_feed(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "merc-feed"), scratch_path(spark, "merc-feed-ckpt")
    feeds.stream_brand_feed(spark, sf_dir, sink, ckpt, **LINEITEM_FEED)
    return spark.read.parquet(sink)


@register("stream_listing_feed")
def q_stream_listing_feed(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "listing-feed"), scratch_path(spark, "listing-feed-ckpt")
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    feeds.stream_listing_feed(spark, sf_dir, sink, ckpt, glob="lineitem.parquet", raw=lambda lines: fx.project_api_listing(
        lines.join(part, lines["l_partkey"] == part["p_partkey"])))
    return spark.read.parquet(sink)


# --- machine learning ---------------------------------------------------------

@register("feature_table")
def q_feature_table(spark, sf_dir):
    return segments.feature_table(silver(spark, sf_dir))


@register("scale_features")
def q_scale_features(spark, sf_dir):
    scaled, _ = segments.scale_features(segments.feature_table(silver(spark, sf_dir)))
    return scaled.select("ID", vector_to_array("scaled").alias("SCALED"))


@register("segment_market")
def q_segment_market(spark, sf_dir):
    return segments.segment_market(spark, shared_silver(spark, sf_dir)).clusters


@register("select_k")
def q_select_k(spark, sf_dir):
    seg = segments.segment_market(spark, shared_silver(spark, sf_dir))
    return seg.report if seg.report is not None else segments.k_report(spark, [])


@register("segment_market_fixed_k")
def q_segment_market_fixed_k(spark, sf_dir):
    s = shared_silver(spark, sf_dir).select("brand", "model", "year", "price", "mileage", "is_ulez_compliant")
    return segments.segment_market(spark, segments.drop_incomplete(s), k=3, name=False).clusters


@register("cluster_distribution")
def q_cluster_distribution(spark, sf_dir):
    return segments.cluster_distribution(segments.segment_market(spark, shared_silver(spark, sf_dir)).clusters)


@register("cluster_profile")
def q_cluster_profile(spark, sf_dir):
    return segments.cluster_profile(segments.segment_market(spark, shared_silver(spark, sf_dir)).clusters)


# Columns that name a listing; the split hashes them, so SQL can repeat it.
SPLIT_KEY = ("brand", "model", "year", "mileage", "transmission", "fuel_type")


def shared_fact(spark, sf_dir):
    """The warehouse fact, written once: the model and its scores read it again and again."""
    return write_layer(warehouse_fact(spark, sf_dir), scratch_path(spark, "fact"))


@register("split_train_test")
def q_split_train_test(spark, sf_dir):
    train, test = pricing.split_train_test(warehouse_fact(spark, sf_dir), key=SPLIT_KEY)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@register("price_model_metrics")
def q_price_model_metrics(spark, sf_dir):
    return pricing.run_price_model(shared_fact(spark, sf_dir), key=SPLIT_KEY).metrics


@register("price_attribution")
def q_price_attribution(spark, sf_dir):
    return pricing.run_price_model(shared_fact(spark, sf_dir), key=SPLIT_KEY).attributions


@register("price_attribution_totals")
def q_price_attribution_totals(spark, sf_dir):
    """Every test row, labelled or not, is attributed, and its contributions
    and base value add up to the prediction that the trees themselves give."""
    run = pricing.run_price_model(shared_fact(spark, sf_dir), key=SPLIT_KEY)
    total = F.col("base_value")
    for f in pricing.FEATURES:
        total = total + F.col(f"phi_{f}")
    scored = pricing.predict(run.model, pricing.price_attribution(run.model, run.test).withColumnRenamed("prediction", "explained"))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("price").alias("n_labelled"),
        F.count(F.when((F.abs(total - F.col("explained")) < 1e-6) & (F.abs(F.col("explained") - F.col("prediction")) < 1e-6), 1))
        .alias("n_additive"))


@register("score_regression")
def q_score_regression(spark, sf_dir):
    """M8 over predictions from a fixed formula."""
    fact = warehouse_fact(spark, sf_dir)
    predicted = fact.select(F.col("price").alias("__label"), (F.lit(90000.0) - 1000.0 * F.col("vehicle_age")).alias("prediction"))
    scored = pricing.score_regression(predicted)
    return scored.select("n", F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@register("scale_features_rounded")
def q_scale_features_rounded(spark, sf_dir):
    scaled, _ = segments.scale_features(segments.feature_table(silver(spark, sf_dir)))
    z = vector_to_array("scaled")
    return scaled.select("ID", *[F.round(z[i], 5).alias(f"{c}_Z") for i, c in enumerate(segments.FEATURES)])


def _segment_totals(clusters: DataFrame, cols) -> DataFrame:
    """What must hold of a real run: all rows, each id once, cluster ids 0..k-1 all used."""
    return clusters.agg(F.count(F.lit(1)).alias("n_rows"), *cols,
                        (F.max("CLUSTER_ID") - F.count_distinct("CLUSTER_ID") + 1).cast("bigint").alias("n_unused_ids"),
                        F.count(F.when(F.col("CLUSTER_ID").isNull() | (F.col("CLUSTER_ID") < 0), 1)).alias("n_bad_ids"))


@register("segment_market_totals")
def q_segment_market_totals(spark, sf_dir):
    clusters = segments.segment_market(spark, shared_silver(spark, sf_dir)).clusters
    ends = F.when(F.col("IS_ULEZ_COMPLIANT"), " (Compliant)").otherwise(" (Non-Compliant)")
    suffix = F.when(~F.col("CLUSTER_NAME").endswith(ends), 1)
    return _segment_totals(clusters, [
        F.count_distinct("ID").alias("n_ids"), F.count(suffix).alias("n_bad_suffixes"),
        F.count(F.when(F.col("CLUSTER_NAME").startswith("Unknown"), 1)).alias("n_unnamed")])


@register("segment_market_fixed_k_totals")
def q_segment_market_fixed_k_totals(spark, sf_dir):
    s = shared_silver(spark, sf_dir).select("brand", "model", "year", "price", "mileage", "is_ulez_compliant")
    clusters = segments.segment_market(spark, segments.drop_incomplete(s), k=3, name=False).clusters
    return _segment_totals(clusters, [F.count_distinct("CLUSTER_ID").alias("n_clusters"),
                                      F.count_distinct("CLUSTER_NAME").alias("n_names")])


@register("select_k_totals")
def q_select_k_totals(spark, sf_dir):
    """Each K of the range is scored once, and its score is a silhouette."""
    seg = segments.segment_market(spark, shared_silver(spark, sf_dir))
    return seg.report.agg(
        F.count(F.lit(1)).alias("n_ks"), F.sum("k").alias("sum_ks"),
        F.count(F.when((F.col("silhouette") < -1) | (F.col("silhouette") > 1) | (F.col("cost") < 0), 1)).alias("n_bad_scores"))


# --- pipelines ------------------------------------------------------------------

@register("run_medallion")
def q_run_medallion(spark, sf_dir):
    bronze_root = scratch_path(spark, "bronze")
    fx.listings_raw(spark, sf_dir).write.parquet(bronze_root)
    out = medallion.run_medallion(spark, bronze_root, scratch_path(spark, "lake"),
                                  tie_breakers=fx.LISTING_TIE_BREAKERS[1:])
    return out.market_impact


@register("ingest_documents")
def q_ingest_documents(spark, sf_dir):
    docs = scratch_path(spark, "pages")
    documents.save_documents(fx.listing_documents(spark, sf_dir), docs)
    bronze_root = scratch_path(spark, "bronze")
    medallion.ingest_documents(spark, docs, "BMW", "Diesel", bronze_root, per_line=True)
    return spark.read.parquet(bronze_root).drop("ingestion_timestamp", "ingest_date")


@register("incremental_silver")
def q_incremental_silver(spark, sf_dir):
    # The batch (every third line number) has late rows, older than rows that
    # the state holds, as well as newer ones.
    raw = fx.listings_raw(spark, sf_dir)
    late = F.col("tie_line") % 3 == 0
    ties = fx.LISTING_TIE_BREAKERS
    state = silver_state(raw.filter(~late), tie_breakers=ties, stamp=False)
    return medallion.incremental_silver(state, raw.filter(late), tie_breakers=ties).select(*silver_columns(False))


@register("refresh_silver")
def q_refresh_silver(spark, sf_dir):
    # I1's write path, batch after batch, from nothing.
    raw = fx.listings_raw(spark, sf_dir)
    root, ties = scratch_path(spark, "lake"), fx.LISTING_TIE_BREAKERS
    for part in (2, 0, 1):
        out = medallion.refresh_silver(spark, raw.filter(F.col("tie_line") % 3 == part), f"{root}/state", f"{root}/silver",
                                       tie_breakers=ties, stamp=False)
    return out


@register("brand_sources_union")
def q_brand_sources_union(spark, sf_dir):
    # The API-shaped rows saved as one CSV folder per brand, then read back as one table.
    root = scratch_path(spark, "brand-csv")
    cols = ["id", "brand", "title", "price", "year", "mileage", "fuelType", "engineSize", "transmission"]
    fx.stage_raw(spark, sf_dir).select(*cols).write.partitionBy("brand").option("header", "true").csv(root)
    schema = T.StructType([f for f in API_RAW.fields if f.name in cols and f.name != "brand"])
    return wsrc.brand_sources_union(spark, root, schema)


# --- inventory keys ---------------------------------------------------------------

@register("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    return dedup_latest(raw, "id", list(fx.LISTING_TIE_BREAKERS))


@register("listing_change_stream")
def q_listing_change_stream(spark, sf_dir):
    # Consume the API table's change stream as is (both actions) into a sink.
    sink, ckpt = scratch_path(spark, "changes"), scratch_path(spark, "changes-ckpt")
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    stream = feeds.listing_change_stream(spark, sf_dir, fx.table(spark, sf_dir, "lineitem").schema,
                                         glob="lineitem.parquet")
    raw = fx.project_api_listing(stream.join(part, stream["l_partkey"] == part["p_partkey"]))
    feeds.start_feed(raw, sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).drop("search_timestamp")


@register("append_with_column_list")
def q_append_with_column_list(spark, sf_dir):
    raw = fx.api_raw(spark, sf_dir)
    named = raw.select("brand", F.col("title").alias("model"), "year", "mileage")
    return wh.append_with_column_list(named)


@register("skip_when_no_data")
def q_skip_when_no_data(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "merc-feed"), scratch_path(spark, "merc-feed-ckpt")
    feeds.stream_brand_feed(spark, sf_dir, sink, ckpt, **LINEITEM_FEED)
    second = feeds.stream_brand_feed(spark, sf_dir, sink, ckpt, **LINEITEM_FEED)
    if not feeds.skip_when_no_data(second):
        raise RuntimeError("a rerun over unchanged input consumed rows")
    return spark.read.parquet(sink)


@register("trust_score")
def q_trust_score(spark, sf_dir):
    s = shared_silver(spark, sf_dir)
    return serving.trust_score(quality.quality_results(s, gold.market_impact(s)))


@register("mask_price")
def q_mask_price(spark, sf_dir):
    return governance.mask_columns(silver(spark, sf_dir), ROLES["developer"], price_cols=("price",))


@register("mask_text")
def q_mask_text(spark, sf_dir):
    return governance.mask_columns(silver(spark, sf_dir), ROLES["auditor"], text_cols=("model",))


@register("filter_rows")
def q_filter_rows(spark, sf_dir):
    return governance.filter_rows(silver(spark, sf_dir), ROLES["developer"], developer_brands=FIXTURE_DEV_BRANDS)


@register("governed_view")
def q_governed_view(spark, sf_dir):
    return q_governed_diesel_developer(spark, sf_dir)


@register("display_tables")
def q_display_tables(spark, sf_dir):
    return serving.display_tables(diesel=gold.diesel_devaluation(silver(spark, sf_dir)))["diesel"]


def fixed_clusters(spark, sf_dir):
    """Clustering input with cluster ids fixed by a rule (mileage band), so
    ranking and naming can be checked against SQL."""
    feats = segments.feature_table(silver(spark, sf_dir))
    return feats.withColumn("CLUSTER_ID", F.floor(F.col("MILEAGE") / 25000).cast("int"))


@register("rank_clusters")
def q_rank_clusters(spark, sf_dir):
    return segments.rank_clusters(segments.cluster_profile(fixed_clusters(spark, sf_dir)))


@register("name_clusters")
def q_name_clusters(spark, sf_dir):
    c = fixed_clusters(spark, sf_dir)
    named = segments.name_clusters(c, segments.rank_clusters(segments.cluster_profile(c)))
    return named.select("ID", "CLUSTER_ID", "CLUSTER_NAME")


@register("latest_audit")
def q_latest_audit(spark, sf_dir):
    # The four newest audit rows are this run's four checks; the run-time
    # timestamp is left out so the result is deterministic.
    s = shared_silver(spark, sf_dir)
    return serving.latest_audit(quality.quality_results(s, gold.market_impact(s))).drop("Timestamp")


# --- checks that can fail, audit history, layers --------------------------------

def seeded_silver(spark, sf_dir):
    """Silver with faults: negative prices, old diesels flagged compliant, and
    ids that occur twice."""
    s = silver(spark, sf_dir)
    price = F.when(F.col("mileage") % 14000 == 0, -F.col("price")).otherwise(F.col("price"))
    flag = F.col("is_ulez_compliant") | ((F.col("fuel_type") == "diesel") & (F.col("mileage") % 6000 == 0))
    faulty = s.withColumns({"price": price.cast("decimal(10,2)"), "is_ulez_compliant": flag})
    return faulty.unionByName(faulty.filter("mileage % 22000 = 0"))


@register("check_positive_price_seeded")
def q_check_positive_price_seeded(spark, sf_dir):
    return quality.check_positive_price(seeded_silver(spark, sf_dir))


@register("check_compliance_logic_seeded")
def q_check_compliance_logic_seeded(spark, sf_dir):
    return quality.check_compliance_logic(seeded_silver(spark, sf_dir))


def _seeded_results(spark, sf_dir):
    s = write_layer(seeded_silver(spark, sf_dir), scratch_path(spark, "seeded"))
    one_side = gold.market_impact(s.filter("brand <> 'UNKNOWN' OR is_ulez_compliant"))
    return quality.quality_results(s, one_side, stamp=False)


@register("run_quality_checks_seeded")
def q_run_quality_checks_seeded(spark, sf_dir):
    return _seeded_results(spark, sf_dir)


@register("record_audit")
def q_record_audit(spark, sf_dir):
    """The checks' records stored after each of 27 runs, more than the history
    keeps, and the history read back from storage."""
    results = write_layer(_seeded_results(spark, sf_dir), scratch_path(spark, "results"))
    path = scratch_path(spark, "audit")
    for day in range(27):
        stamp = F.date_add(F.lit("2024-01-01").cast("date"), day).cast("timestamp")
        history = quality.record_audit(results.select(stamp.alias("check_timestamp"), *results.columns), path)
    return history.select(F.date_format("check_timestamp", "yyyy-MM-dd").alias("day"), *results.columns)


@register("cluster_distribution_fixed")
def q_cluster_distribution_fixed(spark, sf_dir):
    c = fixed_clusters(spark, sf_dir)
    return segments.cluster_distribution(segments.name_clusters(c, segments.rank_clusters(segments.cluster_profile(c))))


@register("cluster_profile_fixed")
def q_cluster_profile_fixed(spark, sf_dir):
    p = segments.cluster_profile(fixed_clusters(spark, sf_dir))
    return p.select("CLUSTER_ID", "n", *[F.round(c, 4).alias(c) for c in ("mean_price", "mean_mileage", "mean_year")])


@register("cluster_scatter")
def q_cluster_scatter(spark, sf_dir):
    c = fixed_clusters(spark, sf_dir)
    named = segments.name_clusters(c, segments.rank_clusters(segments.cluster_profile(c)))
    return serving.display_tables(clusters=named)["clusters"]


@register("read_layer")
def q_read_layer(spark, sf_dir):
    # One layer that is there and one that is missing, read by Silver's schema.
    path = scratch_path(spark, "silver")
    write_layer(silver(spark, sf_dir, stamp=True), path, read_back=False)
    both = bronze.read_layer(spark, path, SILVER).unionByName(bronze.read_layer(spark, f"{path}-missing", SILVER))
    return both.drop("processed_at")


@register("save_clusters_table")
def q_save_clusters_table(spark, sf_dir):
    c = fixed_clusters(spark, sf_dir).select("ID", "CLUSTER_ID")
    spark.sql("DROP TABLE IF EXISTS kerbside_query_clusters")
    return save_clusters_table(c, "kerbside_query_clusters", scratch_path(spark, "clusters"))


@register("materialize")
def q_materialize(spark, sf_dir):
    out = warehouse_models.run_warehouse_models(
        fx.stage_raw(spark, sf_dir), materializations={"stg_cars": "view", "fct_cars": "table", "mart_ulez_impact": "table"},
        location=scratch_path(spark, "warehouse"))
    return spark.table("mart_ulez_impact").select(*out["mart_ulez_impact"].columns)


@register("evolve_schema")
def q_evolve_schema(spark, sf_dir):
    named = fx.merc_raw(spark, sf_dir).select("model", "year", F.col("price").cast("string").alias("price"), "mileage")
    return wh.evolve_schema(named, WAREHOUSE_FACT)


@register("run_segmentation")
def q_run_segmentation(spark, sf_dir):
    root = scratch_path(spark, "lake")
    write_layer(silver(spark, sf_dir, stamp=True), f"{root}/silver", read_back=False)
    out = medallion.run_segmentation(spark, f"{root}/silver", f"{root}/clusters")
    return out.select("ID", "BRAND", "PRICE", "IS_ULEZ_COMPLIANT", F.col("CLUSTER_NAME").isNotNull().alias("NAMED"))


@register("run_medallion_outputs")
def q_run_medallion_outputs(spark, sf_dir):
    """All three layers of the medallion run, rerun into the same folders."""
    bronze_root, root = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    fx.listings_raw(spark, sf_dir).write.parquet(bronze_root)
    for _ in range(2):
        out = medallion.run_medallion(spark, bronze_root, root, tie_breakers=fx.LISTING_TIE_BREAKERS[1:])
    none = F.lit(None).cast("string")
    return (out.silver.select(F.lit("silver").alias("layer"), F.col("id").alias("key"), "brand", F.col("price").cast("double").alias("value"))
            .unionByName(out.market_impact.select(F.lit("impact").alias("layer"), none.alias("key"), "brand",
                                                  F.col("percent_diff").alias("value")))
            .unionByName(out.diesel_devaluation.select(F.lit("diesel").alias("layer"), F.col("model").alias("key"), "brand",
                                                       F.col("devaluation_percent").alias("value"))))
