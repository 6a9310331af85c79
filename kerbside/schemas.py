"""Canonical schemas, one per layer. Drift is resolved once, at Bronze read."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
D, B, TS = T.DoubleType(), T.BooleanType(), T.TimestampType()


def struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Listing document as saved from the search API (one JSON document per file /
# line): an array holding one response object.
BADGE = struct(("type", S), ("displayText", S))
ADVERT_CONTEXT = struct(("make", S), ("model", S), ("year", I), ("price", S))
LISTING = struct(
    ("advertId", S), ("title", S), ("subTitle", S), ("attentionGrabber", S), ("price", S),
    ("badges", T.ArrayType(BADGE)),
    ("trackingContext", struct(("advertContext", ADVERT_CONTEXT))),
)
RESPONSE = struct(("data", struct(("searchResults", struct(("listings", T.ArrayType(LISTING)))))))
DOCUMENT = T.ArrayType(RESPONSE)

# Bronze: raw listings, one batch per brand x fuel x run.
BRONZE = struct(
    ("id", S), ("title", S), ("brand", S), ("model", S), ("price", D), ("year", I),
    ("mileage", I), ("fuelType", S), ("engineSize", D), ("transmission", S),
    ("ingestion_timestamp", TS), ("fuel_type_raw", S),
)

# Silver fct_cars: one row per advert id, current state.
SILVER = struct(
    ("id", S), ("brand", S), ("model", S), ("year", I), ("price", T.DecimalType(10, 2)),
    ("mileage", I), ("fuel_type", S), ("engine_size", D), ("transmission", S),
    ("is_ulez_compliant", B), ("processed_at", TS),
)

MARKET_IMPACT = struct(("brand", S), ("avg_price_compliant", D),
                       ("avg_price_non_compliant", D), ("percent_diff", D))

AUDIT = struct(("check_timestamp", TS), ("layer", S), ("check_name", S),
               ("status", S), ("error_count", L))

# Warehouse raw tables and the warehouse fact.
MERC_RAW = struct(("model", S), ("year", I), ("price", I), ("transmission", S), ("mileage", I),
                  ("fuelType", S), ("tax", I), ("mpg", D), ("engineSize", D))
API_RAW = struct(("id", S), ("brand", S), ("title", S), ("price", S), ("year", I),
                        ("mileage", I), ("fuelType", S), ("engineSize", D), ("transmission", S),
                        ("search_timestamp", TS))
WAREHOUSE_FACT = struct(
    ("brand", S), ("model", S), ("year", I), ("price", D), ("transmission", S), ("mileage", I),
    ("fuel_type", S), ("tax", I), ("mpg", D), ("engine_size", D), ("is_ulez_compliant", B),
    ("vehicle_age", I), ("price_per_mile", D),
)
