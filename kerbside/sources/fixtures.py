"""Listing-shaped views derived from the driver's TPC-H-style tables.

Every view is a narrow projection of ``lineitem`` (joined to ``part`` on its
key where listed), so its size grows with the tables and it carries no
shuffle of its own beyond that one equi join. The SQL text of each view, as
DuckDB runs it, is in ``kerbside.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_part(spark: SparkSession, sf_dir: str, part_cols: list[str], hashed: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", *part_cols)
    # Plain equi join: AQE turns it into a broadcast only when the measured
    # part side is under the threshold, otherwise it stays a shuffle join.
    # ``hashed``: a task hashes its parts instead of sorting (and spilling) its lines.
    return li.join(part.hint("shuffle_hash") if hashed else part, li.l_partkey == part.p_partkey)


def _model_year() -> Column:
    return (F.lit(2000) + (F.year("l_shipdate") - 1995) * 3).cast("int")


def _engine_size() -> Column:
    return (F.lit(1.0) + F.col("l_linenumber") * F.lit(0.5)).cast("double")


def _transmission() -> Column:
    return F.when(F.col("l_linestatus") == "O", "Automatic").otherwise("Manual")


def _fuel(petrol: str, other: str) -> Column:
    return (F.when(F.col("l_returnflag") == "A", petrol)
            .when(F.col("l_returnflag") == "N", "Diesel")
            .when(F.col("l_linestatus") == "O", "Hybrid")
            .otherwise(other))


def _action() -> Column:
    return F.when(F.col("l_suppkey") % 10 == 0, "DELETE").otherwise("INSERT")


def _int_text(c: Column) -> Column:
    return F.floor(c).cast("int").cast("string")


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped listings; ids repeat about four times."""
    j = _lineitem_part(spark, sf_dir, ["p_brand", "p_type", "p_name", "p_size"])
    return j.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.nullif(F.col("p_brand"), F.lit("Brand#13")).alias("brand"),
        F.when(F.col("p_size") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("model"),
        F.col("p_name").alias("title"),
        F.col("l_extendedprice").alias("price"),
        _model_year().alias("year"),
        (F.floor("l_quantity") * 2000).cast("int").alias("mileage"),
        _fuel(" Petrol ", "Electric").alias("fuelType"),
        _engine_size().alias("engineSize"),
        _transmission().alias("transmission"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
        F.col("l_linenumber").alias("tie_line"),
        F.col("l_partkey").alias("tie_part"),
        F.col("l_suppkey").alias("tie_supp"),
    )


LISTING_TIE_BREAKERS = ("ingestion_timestamp", "tie_line", "tie_part", "tie_supp", "price")


def api_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped raw table: text prices (plain, '£n,500', 'POA') and a change action."""
    j = _lineitem_part(spark, sf_dir, ["p_brand", "p_type", "p_name", "p_size"])
    return project_api_listing(j)


def project_api_listing(j: DataFrame, price_text: Column | None = None) -> DataFrame:
    price_text = price_text if price_text is not None else (F.when(F.col("l_linenumber") == 1, F.lit("POA"))
                  .when(F.col("l_linenumber") == 2,
                        F.concat(F.lit("£"), _int_text(F.col("l_extendedprice") / 1000), F.lit(",500")))
                  .otherwise(_int_text(F.col("l_extendedprice"))))
    return j.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("p_size") % 7 == 0, F.col("p_type")).otherwise(F.col("p_name")).alias("title"),
        price_text.alias("price"),
        _model_year().alias("year"),
        ((F.floor("l_quantity") - 1) * 1000).cast("int").alias("mileage"),
        _fuel("Petrol", "Other").alias("fuelType"),
        _engine_size().alias("engineSize"),
        _transmission().alias("transmission"),
        F.col("l_shipdate").alias("search_timestamp"),
        _action().alias("action"),
    )


def merc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mercedes raw feed with a change action; mileage 0 occurs (exercises NULLIF)."""
    return project_merc(table(spark, sf_dir, "lineitem"))


def project_merc(li: DataFrame) -> DataFrame:
    return li.select(
        F.concat(F.lit("M"), (F.col("l_partkey") % 40).cast("string")).alias("model"),
        _model_year().alias("year"),
        F.floor("l_extendedprice").cast("int").alias("price"),
        _transmission().alias("transmission"),
        ((F.floor("l_quantity") - 1) * 1000).cast("int").alias("mileage"),
        _fuel("Petrol", "Unknown").alias("fuelType"),
        F.lit(145).alias("tax"),
        (F.lit(30) + F.col("l_linenumber")).cast("double").alias("mpg"),
        _engine_size().alias("engineSize"),
        _action().alias("action"),
    )


def listing_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat inputs from which nested listing documents are assembled."""
    j = _lineitem_part(spark, sf_dir, ["p_name", "p_brand", "p_type"], hashed=True)
    sub_title = F.concat(
        (F.lit(1) + F.col("l_linenumber") % 4).cast("string"), F.lit("."),
        (F.col("l_linenumber") % 10).cast("string"), F.lit(" "), F.col("p_name"),
        F.when(F.col("l_linestatus") == "O", F.lit(" Auto")).otherwise(F.lit("")))
    grabber = (F.when(F.col("l_returnflag") == "A", F.lit("Great Petrol Hybrid car"))
               .when(F.col("l_returnflag") == "N", F.lit("Great Diesel car"))
               .when(F.col("l_linestatus") == "O", F.lit(None).cast("string"))
               .otherwise(F.lit("clean Electric")))
    return j.select(
        F.col("l_orderkey").cast("string").alias("advert_id"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "p_name", "p_brand", "p_type", _model_year().alias("year"),
        sub_title.alias("sub_title"),
        grabber.alias("grabber"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(",500 miles")).alias("mileage_badge"),
        F.when(F.col("l_suppkey") % 3 == 0, F.lit("n/a")).otherwise(F.lit(None).cast("string")).alias("later_bad_badge"),
    )


def stage_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped raw table whose text prices use thousands separators only
    ('68,423'), the input the staging model's comma-strip-and-cast expects.
    (Its '£' / 'POA' behaviour is covered by literal fixtures in the tests.)"""
    j = _lineitem_part(spark, sf_dir, ["p_brand", "p_type", "p_name", "p_size"])
    whole = F.floor("l_extendedprice").cast("int")
    price_text = F.concat((F.floor(F.col("l_extendedprice") / 1000)).cast("int").cast("string"), F.lit(","),
                          F.lpad((whole % 1000).cast("string"), 3, "0"))
    return project_api_listing(j, price_text).drop("action")


def listing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One saved API response per lineitem row (column ``response``), built
    from ``listing_texts``: a mileage badge, a second unparseable one on some
    rows, an unrelated badge, text context prices ('POA', '£n,500', plain);
    rows with ``l_suppkey % 7 = 0`` carry no tracking context."""
    t = listing_texts(spark, sf_dir)
    badge = lambda typ, text: F.struct(F.lit(typ).alias("type"), text.cast("string").alias("displayText"))
    first = [badge("MILEAGE", F.col("mileage_badge")), badge("PRIVATE_SELLER", F.lit("7 owners"))]
    badges = F.when(F.col("later_bad_badge").isNotNull(),
                    F.array(*first, badge("MILEAGE", F.col("later_bad_badge")))).otherwise(F.array(*first))
    ctx_price = (F.when(F.col("l_linenumber") == 1, F.lit("POA"))
                 .when(F.col("l_linenumber") == 2,
                       F.concat(F.lit("£"), _int_text(F.col("l_extendedprice") / 1000), F.lit(",500")))
                 .otherwise(_int_text(F.col("l_extendedprice"))))
    context = F.struct(F.struct(F.col("p_brand").alias("make"), F.col("p_type").alias("model"),
                                F.col("year").alias("year"), ctx_price.alias("price")).alias("advertContext"))
    listing = F.struct(
        F.col("advert_id").alias("advertId"), F.col("p_name").alias("title"),
        F.col("sub_title").alias("subTitle"), F.col("grabber").alias("attentionGrabber"),
        F.lit("£0").alias("price"), badges.alias("badges"),
        F.when(F.col("l_suppkey") % 7 == 0, F.lit(None).cast("struct<advertContext:struct<make:string,model:string,year:int,price:string>>"))
         .otherwise(context).alias("trackingContext"))
    response = F.struct(F.struct(F.struct(F.array(listing).alias("listings")).alias("searchResults")).alias("data"))
    return t.select(response.alias("response"))
