"""Saved search-API responses -> listing rows.

A response is a JSON array whose first element holds
``data.searchResults.listings[]``. Files are read either one document per
file (``wholetext``, as saved page by page) or one document per line (JSON
lines, the bulk layout, plain or compressed). Either way each document is parsed with
a fixed schema by ``from_json`` inside the scan's codegen stage; a missing
level or an error response yields no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.listing import badge_mileage, infer_engine_size, infer_fuel, infer_transmission
from kerbside.functions.prices import parse_price
from kerbside.schemas import DOCUMENT


def parse_documents(text: DataFrame, col: str = "value") -> DataFrame:
    """Raw JSON text -> one row per listing (the first response element only)."""
    doc = F.from_json(F.col(col), DOCUMENT)
    first = F.try_element_at(doc, F.lit(1))
    return explode_listings(text.select(first.alias("response")), "response")


def explode_listings(docs: DataFrame, col: str = "response") -> DataFrame:
    """``inline`` of response.data.searchResults.listings; NULL or empty
    arrays (missing levels, error bodies) produce no rows."""
    listings = F.col(col)["data"]["searchResults"]["listings"]
    return docs.select(F.explode(listings).alias("l")).select("l.*")


# Lines of a file: a compressed file is read by one task.
LINES_PER_FILE = 250_000


def save_documents(docs: DataFrame, path: str, col: str = "response") -> None:
    """Save responses as compressed JSON lines, the bulk layout that
    ``per_line`` reads back. Field names make up most of a line, so even the
    fastest compression leaves a small part of it."""
    lines = docs.select(F.to_json(F.array(col)).alias("value"))
    (lines.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", LINES_PER_FILE).text(path))


def read_listing_documents(spark: SparkSession, paths: str | Sequence[str], per_line: bool = False) -> DataFrame:
    """S1 + E7: read every saved page at once (a path list or glob is a
    union-all of pages; empty pages contribute nothing)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return parse_documents(spark.read.text(paths, wholetext=not per_line))


def concat_pages(spark: SparkSession, pages: Sequence[str], per_line: bool = False) -> DataFrame:
    """The listings of pages 1..n of one brand x fuel, in one read (a
    union-all of the pages; an empty page adds nothing)."""
    return read_listing_documents(spark, list(pages), per_line=per_line)


def extract_listings(listings: DataFrame, fuel_filter: str | Column | None = None) -> DataFrame:
    """Listings with a tracking context -> flat listing rows.

    The price is the context price as text (the display price is ignored);
    ``ingest_listings`` parses it."""
    ctx = F.col("trackingContext")["advertContext"]
    sub, grab = F.col("subTitle"), F.col("attentionGrabber")
    return listings.filter(F.col("trackingContext").isNotNull()).select(
        F.col("advertId").alias("id"),
        F.col("title"),
        ctx["make"].alias("brand"),
        ctx["model"].alias("model"),
        ctx["price"].alias("price"),
        ctx["year"].alias("year"),
        badge_mileage("badges").alias("mileage"),
        infer_fuel(sub, grab, fuel_filter).alias("fuelType"),
        infer_engine_size(sub).alias("engineSize"),
        infer_transmission(sub, grab).alias("transmission"),
    )


def tag_batch(listings: DataFrame, make: str, fuel_type: str, at: datetime | None = None) -> DataFrame:
    """One ingestion timestamp per batch, brand := requested make,
    fuel_type_raw := requested fuel."""
    stamp = F.lit(at).cast("timestamp") if at is not None else F.current_timestamp()
    return listings.withColumns({"ingestion_timestamp": stamp, "brand": F.lit(make),
                                 "fuel_type_raw": F.lit(fuel_type)})


def ingest_listings(listings: DataFrame, make: str, fuel_type: str, at: datetime | None = None) -> DataFrame:
    """L4 body: E1-E5 with the batch's fuel filter, P1 price, E6 tags;
    rows in the canonical Bronze column order."""
    flat = extract_listings(listings, fuel_filter=fuel_type)
    flat = flat.withColumn("price", parse_price("price", "zero"))
    tagged = tag_batch(flat, make, fuel_type, at)
    return tagged.select("id", "title", "brand", "model", "price", F.col("year").cast("int").alias("year"),
                         F.col("mileage").cast("int").alias("mileage"), "fuelType", "engineSize",
                         "transmission", "ingestion_timestamp", "fuel_type_raw")


def bronze_batch_name(make: str, fuel_type: str, at: datetime) -> str:
    """K1 naming: {make}_{fuel}_{YYYYmmdd_HHMMSS}, make lower-cased, '-' -> '_'."""
    return f"{make.lower().replace('-', '_')}_{fuel_type.lower()}_{at.strftime('%Y%m%d_%H%M%S')}"
