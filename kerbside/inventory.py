"""Queries of the single operators of the inventory that are otherwise only
run inside a larger one: each applies one operator to rows of the driver's
tables that take every branch of it, and has SQL in
``kerbside.inventory_oracle``.

Rows are told apart by order and line number.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.compliance import (compliance_flag, normalize_fuel, price_efficiency, price_per_mile, vehicle_age)
from kerbside.functions.listing import badge_mileage, brand_from_title, infer_engine_size, infer_fuel, infer_transmission
from kerbside.functions.prices import cast_price, parse_price
from kerbside.operators import gold, pricing, quality, segments
from kerbside.operators import warehouse as wh
from kerbside.operators.silver import build_silver, detect_columns, fallback_columns, guard_nonempty, stamp_processed
from kerbside.plans import silver_store
from kerbside.schemas import AUDIT
from kerbside.session import scratch_path
from kerbside.sinks.layers import write_bronze, write_layer
from kerbside.sources import documents
from kerbside.sources import fixtures as fx

INVENTORY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KEY = ("l_orderkey", "l_linenumber")
LINE = "l_linenumber"


def register(name: str):
    def deco(fn):
        INVENTORY[name] = fn
        return fn
    return deco


def lines(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    """Line items with their part's text and the given columns."""
    li, part = fx.table(spark, sf_dir, "lineitem"), fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).withColumns(columns)


def by_line(*values) -> Column:
    """One of the values by line number, the last for all further lines."""
    out = F.lit(values[-1]) if not isinstance(values[-1], Column) else values[-1]
    for i, v in reversed(list(enumerate(values[:-1], 1))):
        out = F.when(F.col(LINE) == i, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


# --- listing text -----------------------------------------------------------------

@register("badge_mileage")
def q_badge_mileage(spark, sf_dir):
    """No badge, a plain one, the last of two, an unparseable one after a good
    one and before one, one without text, and one of another kind."""
    badge = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.cast("string").alias("displayText"))
    miles = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(",500 miles"))
    bare = F.col("l_quantity").cast("int")
    none = F.array(badge("OTHER", F.lit(None))).cast("array<struct<type:string,displayText:string>>")
    badges = by_line(F.filter(none, lambda b: b["type"] == "MILEAGE"), F.array(badge("MILEAGE", miles)),
                     F.array(badge("MILEAGE", miles), badge("MILEAGE", bare)),
                     F.array(badge("MILEAGE", miles), badge("OTHER", F.lit("7 owners")), badge("MILEAGE", F.lit("n/a"))),
                     F.array(badge("MILEAGE", F.lit("n/a")), badge("MILEAGE", bare)),
                     F.array(badge("MILEAGE", miles), badge("MILEAGE", F.lit(None))), F.array(badge("OTHER", miles)))
    return lines(spark, sf_dir, badges=badges).select(*KEY, badge_mileage("badges").alias("mileage"))


def _texts(spark, sf_dir):
    """Subtitles and attention texts: fuel words in either, both or neither,
    in other letter case, and missing texts."""
    sub = by_line(F.concat(F.lit("2.0 Petrol "), F.col("p_name")), F.concat(F.lit("12.5 TDI "), F.col("p_type")), F.lit(None),
                  "1.6 Hybrid Automatic", F.concat(F.lit("petrol 3 "), F.col("p_name")), "Electric 1.25", "")
    grab = F.when(F.col("l_returnflag") == "A", "Great Diesel").when(F.col("l_linestatus") == "O", F.lit(None)).otherwise("semi Auto")
    return lines(spark, sf_dir, sub=sub.cast("string"), grab=grab.cast("string"))


@register("infer_fuel")
def q_infer_fuel(spark, sf_dir):
    asked = by_line(F.lit(None), F.lit(None), "", "", F.lit(None), F.lit(None), "Diesel").cast("string")
    return _texts(spark, sf_dir).select(*KEY, infer_fuel("sub", "grab").alias("fuel"), infer_fuel("sub", "grab", asked).alias("asked_fuel"),
                                        infer_fuel("sub", "grab", "Electric").alias("fixed_fuel"))


@register("infer_transmission")
def q_infer_transmission(spark, sf_dir):
    return _texts(spark, sf_dir).select(*KEY, infer_transmission("sub", "grab").alias("transmission"))


@register("infer_engine_size")
def q_infer_engine_size(spark, sf_dir):
    return _texts(spark, sf_dir).select(*KEY, infer_engine_size("sub").alias("engine_size"))


@register("brand_from_title")
def q_brand_from_title(spark, sf_dir):
    title = by_line(F.col("p_name"), F.col("p_type"), F.regexp_replace("p_name", " .*", ""), F.lit(None), "", " leading blank",
                    F.concat(F.col("p_name"), F.lit(" x")))
    return lines(spark, sf_dir, title=title.cast("string")).select(*KEY, brand_from_title("title").alias("brand"))


# --- documents and Bronze -----------------------------------------------------------

@register("concat_pages")
def q_concat_pages(spark, sf_dir):
    """Pages 1 to 3 of a search saved one after the other, the second empty,
    read in one go."""
    docs = fx.listing_documents(spark, sf_dir)
    number = F.col("response.data.searchResults.listings")[0]["advertId"].cast("long")
    pages = [scratch_path(spark, f"page-{i}") for i in (1, 2, 3)]
    for path, part in zip(pages, (number % 2 == 0, F.lit(False), number % 2 == 1)):
        documents.save_documents(docs.where(part), path)
    found = documents.extract_listings(documents.concat_pages(spark, pages, per_line=True))
    return found.select("id", "title", "brand", "model", "year", "mileage")


BATCH_TIME = dt.datetime(2025, 1, 2, 3, 4, 5)


@register("tag_batch")
def q_tag_batch(spark, sf_dir):
    """The requested brand replaces the listing's, one stamp for all rows."""
    found = fx.listings_raw(spark, sf_dir).select("id", "tie_line", "brand", "model", "price")
    tagged = documents.tag_batch(found, "Land-Rover", "Diesel", BATCH_TIME)
    return tagged.select("id", "tie_line", "brand", "model", "price", "fuel_type_raw",
                         F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@register("write_bronze")
def q_write_bronze(spark, sf_dir):
    """Three batches appended, one of them empty, by day of ingestion (the
    first of each month); the folder is read back by day."""
    root = scratch_path(spark, "bronze")
    raw = fx.listings_raw(spark, sf_dir).withColumn("ingestion_timestamp", F.date_trunc("month", "ingestion_timestamp"))
    wrote = [write_bronze(raw.where(part), root) for part in (F.col("tie_line") == 1, F.col("tie_line") < 0, F.col("tie_line") > 1)]
    if wrote != [True, False, True]:
        raise RuntimeError("an empty batch must write nothing, the others something")
    days = spark.read.parquet(root).groupBy(F.col("ingest_date").cast("string").alias("ingest_date"))
    return days.agg(F.count(F.lit(1)).alias("n_rows"), F.count("model").alias("n_models"), F.sum("mileage").alias("mileage"))


@register("detect_columns")
def q_detect_columns(spark, sf_dir):
    """Which optional columns a drifted table has, and what stands in for
    those it lacks."""
    raw = fx.listings_raw(spark, sf_dir)
    out = None
    for gone in ((), ("brand",), ("model",), ("model", "title"), ("brand", "model", "title")):
        df = raw.drop(*gone)
        have = detect_columns(df)
        counted = fallback_columns(df).agg(
            F.count(F.when(F.col("brand") == "UNKNOWN", 1)).alias("unknown_brands"),
            F.count(F.when(F.col("model") == "UNKNOWN", 1)).alias("unknown_models"))
        row = counted.select(F.lit(",".join(gone)).alias("dropped"), *(F.lit(have[c]).alias(f"has_{c}") for c in have),
                             "unknown_brands", "unknown_models")
        out = row if out is None else out.unionByName(row)
    return out


# --- prices, fuels, compliance, derived metrics ---------------------------------------

def _price_texts():
    whole = F.floor("l_extendedprice").cast("int").cast("string")
    return by_line("POA", F.concat(F.lit("£"), F.floor(F.col("l_extendedprice") / 1000).cast("int").cast("string"), F.lit(",500")),
                   F.concat(F.lit("£"), whole), F.concat(whole, F.lit(".5")), F.lit(None), "", whole).cast("string")


@register("parse_price_zero")
def q_parse_price_zero(spark, sf_dir):
    return lines(spark, sf_dir, text=_price_texts()).select(*KEY, parse_price("text", "zero").alias("price"))


@register("parse_price_null")
def q_parse_price_null(spark, sf_dir):
    return lines(spark, sf_dir, text=_price_texts()).select(*KEY, parse_price("text", "null").alias("price"))


@register("parse_price_fail")
def q_parse_price_fail(spark, sf_dir):
    """Thousands separators and missing prices; a pound sign raises."""
    text = F.when(F.col(LINE) == 5, F.lit(None)).otherwise(F.format_number(F.floor("l_extendedprice"), 0))
    return lines(spark, sf_dir, text=text.cast("string")).select(*KEY, parse_price("text", "fail").alias("price"))


@register("cast_price")
def q_cast_price(spark, sf_dir):
    return lines(spark, sf_dir).select(*KEY, cast_price("l_extendedprice").alias("price"))


@register("fallback_columns")
def q_fallback_columns(spark, sf_dir):
    """Missing brands, models and titles, and empty ones, which stay."""
    raw = fx.listings_raw(spark, sf_dir).withColumns({
        "title": F.when(F.col("tie_line") == 2, F.lit(None).cast("string")).otherwise(F.col("title")),
        "model": F.when(F.col("tie_line") == 3, "").otherwise(F.col("model"))})
    return fallback_columns(raw).select("id", "tie_line", "brand", "model")


def _fuels() -> Column:
    return by_line(" Petrol ", "DIESEL", "Diesel", "Petrol", "\tPetrol", F.lit(None), "Hybrid").cast("string")


def _years() -> Column:
    year = (F.lit(2000) + (F.year("l_shipdate") - 1992) * 3).cast("int")
    return F.when(F.col("l_quantity") == 7, F.lit(None).cast("int")).otherwise(year)


@register("normalize_fuel")
def q_normalize_fuel(spark, sf_dir):
    return lines(spark, sf_dir, fuel=_fuels()).select(*KEY, normalize_fuel("fuel").alias("fuel_type"))


@register("compliance_flag_strict")
def q_compliance_flag_strict(spark, sf_dir):
    df = lines(spark, sf_dir, fuel=normalize_fuel(_fuels()), year=_years())
    return df.select(*KEY, compliance_flag("fuel", "year", "strict").alias("compliant"))


@register("compliance_flag_lenient")
def q_compliance_flag_lenient(spark, sf_dir):
    df = lines(spark, sf_dir, fuel=_fuels(), year=_years())
    return df.select(*KEY, compliance_flag("fuel", "year", "lenient").alias("compliant"))


@register("vehicle_age")
def q_vehicle_age(spark, sf_dir):
    df = lines(spark, sf_dir, year=_years())
    return df.select(*KEY, vehicle_age("year").alias("age"), vehicle_age("year", 2030).alias("age_2030"))


def _mileages() -> Column:
    miles = ((F.floor("l_quantity") - 2) * 1000).cast("int")  # negative, zero and positive
    return F.when(F.col("l_quantity") == 9, F.lit(None).cast("int")).otherwise(miles)


@register("price_per_mile_zero")
def q_price_per_mile_zero(spark, sf_dir):
    return lines(spark, sf_dir, miles=_mileages()).select(*KEY, price_per_mile("l_extendedprice", "miles", "zero").alias("ratio"))


@register("price_per_mile_null")
def q_price_per_mile_null(spark, sf_dir):
    return lines(spark, sf_dir, miles=_mileages()).select(*KEY, price_per_mile("l_extendedprice", "miles", "null").alias("ratio"))


@register("price_efficiency")
def q_price_efficiency(spark, sf_dir):
    """On rounded averages, an average age of 0 giving NULL."""
    fact = wh.listing_feed_rows(fx.api_raw(spark, sf_dir)).withColumn("vehicle_age", F.col("vehicle_age") - 7)
    return gold.impact_summary(fact).select("brand", "year", "fuel_type", "is_ulez_compliant", "avg_price", "avg_age",
                                            price_efficiency("avg_price", "avg_age").alias("efficiency"))


# --- warehouse rows ---------------------------------------------------------------------

@register("inserts_only")
def q_inserts_only(spark, sf_dir):
    changes = fx.merc_raw(spark, sf_dir).withColumn("action", F.when(F.col("mileage") == 3000, F.lit(None).cast("string"))
                                                    .when(F.col("mileage") == 4000, "insert").otherwise(F.col("action")))
    return wh.inserts_only(changes)


@register("migrate_title_as_model")
def q_migrate_title_as_model(spark, sf_dir):
    raw = fx.api_raw(spark, sf_dir).withColumn("model", F.lit("old"))
    return wh.migrate_title_as_model(raw).select("id", "brand", "title", "model", "year")


# --- Silver, clustering input, layers -----------------------------------------------------

def _silver(spark, sf_dir):
    return build_silver(fx.listings_raw(spark, sf_dir), tie_breakers=fx.LISTING_TIE_BREAKERS, stamp=False)


@register("stamp_processed")
def q_stamp_processed(spark, sf_dir):
    """One stamp for all rows of a run, and no row without it."""
    return stamp_processed(_silver(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("processed_at").alias("n_stamped"),
        F.count_distinct("processed_at").alias("n_stamps"))


@register("drop_incomplete")
def q_drop_incomplete(spark, sf_dir):
    holes = fx.listings_raw(spark, sf_dir).withColumns({
        "price": F.when(F.col("tie_line") == 2, F.lit(None).cast("double")).otherwise(F.col("price")),
        "mileage": F.when(F.col("tie_line") == 3, F.lit(None).cast("int")).otherwise(F.col("mileage")),
        "year": F.when(F.col("tie_line") == 5, F.lit(None).cast("int")).otherwise(F.col("year"))})
    return segments.drop_incomplete(holes).select("id", "tie_line", "price", "mileage", "year")


@register("upper_columns")
def q_upper_columns(spark, sf_dir):
    return segments.upper_columns(_silver(spark, sf_dir))


@register("guard_nonempty")
def q_guard_nonempty(spark, sf_dir):
    """Passes Silver on, and stops at a layer without rows."""
    silver = _silver(spark, sf_dir)
    try:
        guard_nonempty(silver.where("price < 0"))
    except ValueError:
        return guard_nonempty(silver)
    raise RuntimeError("an empty layer was passed on")


@register("write_layer")
def q_write_layer(spark, sf_dir):
    """A layer replaced by rows computed from itself, twice."""
    path = f"{scratch_path(spark, 'lake')}/silver"
    layer = write_layer(_silver(spark, sf_dir), path)
    layer = write_layer(layer.where("year >= 2006"), path)
    return write_layer(layer.withColumn("mileage", F.col("mileage") + 1), path)


@register("silver_store")
def q_silver_store(spark, sf_dir):
    """Silver kept as a base and a delta, three batches in an order in which
    rows arrive late."""
    raw, root = fx.listings_raw(spark, sf_dir), scratch_path(spark, "store")
    for part in (2, 0, 1):
        silver_store.refresh_store(spark, raw.where(F.col("tie_line") % 3 == part), root,
                                   tie_breakers=fx.LISTING_TIE_BREAKERS, stamp=False)
    return silver_store.read_store(spark, root)


@register("append_audit")
def q_append_audit(spark, sf_dir):
    """A check's record per ship date, appended to those of the days before;
    the newest 100 stay."""
    days = fx.table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.when(F.col("l_quantity") < 2, 1)).alias("error_count"))
    records = days.select(
        F.col("day").cast("timestamp").alias("check_timestamp"), F.lit("SILVER").alias("layer"), F.lit("Price Accuracy").alias("check_name"),
        F.when(F.col("error_count") > 0, "FAIL").otherwise("PASS").alias("status"), "error_count")
    records = records.select(*(F.col(f.name).cast(f.dataType) for f in AUDIT.fields))
    early = F.col("check_timestamp") < F.lit("1998-06-01").cast("timestamp")
    kept = quality.append_audit(records.where(~early), quality.append_audit(records.where(early)))
    return kept.select(F.date_format("check_timestamp", "yyyy-MM-dd").alias("day"), "layer", "check_name", "status", "error_count")


@register("silhouette_fixed")
def q_silhouette_fixed(spark, sf_dir):
    """M2's score for clusters fixed by a rule (mileage band)."""
    feats = segments.feature_table(_silver(spark, sf_dir)).withColumn("band", F.floor(F.col("MILEAGE") / 25000).cast("int"))
    scaled, _ = segments.scale_features(feats)
    points = scaled.groupBy("band", *segments.FEATURES).agg(F.count(F.lit(1)).cast("double").alias("weight"), F.first("scaled").alias("scaled"))
    score = segments.silhouette(write_layer(points, scratch_path(spark, "points")), cluster_col="band")
    return feats.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("band").alias("n_clusters")).withColumn(
        "silhouette", F.round(F.lit(score), 6))


# --- price model ----------------------------------------------------------------------------

@register("train_price_model")
def q_train_price_model(spark, sf_dir):
    """What must hold of the fitted trees: their number, that each was grown
    on all labelled training rows, and the first one's root mean."""
    fact = wh.listing_feed_rows(fx.api_raw(spark, sf_dir))
    train, _ = pricing.split_train_test(fact, key=("brand", "model", "year", "mileage", "transmission", "fuel_type"))
    train = write_layer(train, scratch_path(spark, "train"))
    roots = [nodes[0] for nodes in pricing.train_price_model(train).nodes()]
    rows = [(i, int(r.impurityStats[0]), round(float(r.prediction), 3) if i == 0 else None) for i, r in enumerate(roots)]
    return spark.createDataFrame(rows, "tree int, n_rows long, root_mean double")


@register("training_cells")
def q_training_cells(spark, sf_dir):
    """Cells of the engine size, age and flag, all of whose values have a bin:
    rows and mean price."""
    features = ("vehicle_age", "engine_size", "is_ulez_compliant")
    fact = wh.listing_feed_rows(fx.api_raw(spark, sf_dir)).withColumn(
        "engine_size", F.when(F.col("engine_size") != 2.0, F.col("engine_size")))
    cuts = pricing.feature_cuts(pricing.labelled_input(fact, features), features)
    cells = pricing.training_cells(fact, cuts, features)
    return cells.select(*(F.col(f"__b_{c}").cast("int").alias(f"{c}_bin") for c in features),
                        F.col("__n").cast("long").alias("n"), F.round("__label", 4).alias("mean_price"))
