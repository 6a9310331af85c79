"""DuckDB SQL for ``kerbside.inventory``. The rules under test (thresholds,
words, casts) are fixed values."""

from __future__ import annotations

from kerbside.oracle import _FEATURED, _SIDE, API_RAW, FACT, IMPACT_SUMMARY, LISTINGS_RAW, MERC_RAW, ORACLE, SILVER, LISTING_TEXTS

INVENTORY_ORACLE: dict[str, str] = {}
LINES = "FROM lineitem JOIN part ON l_partkey = p_partkey"
MILES = "concat(CAST(CAST(l_quantity AS INT) AS VARCHAR), ',500')"

INVENTORY_ORACLE["badge_mileage"] = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber IN (2, 4) THEN CAST(replace({MILES}, ',', '') AS INT)
            WHEN l_linenumber IN (3, 5) THEN CAST(l_quantity AS INT) ELSE 0 END AS mileage
{LINES}"""

TEXTS = f"""
texts AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_linenumber WHEN 1 THEN '2.0 Petrol ' || p_name WHEN 2 THEN '12.5 TDI ' || p_type WHEN 3 THEN NULL
              WHEN 4 THEN '1.6 Hybrid Automatic' WHEN 5 THEN 'petrol 3 ' || p_name WHEN 6 THEN 'Electric 1.25' ELSE '' END AS sub,
         CASE WHEN l_returnflag = 'A' THEN 'Great Diesel' WHEN l_linestatus = 'O' THEN NULL ELSE 'semi Auto' END AS grab
  {LINES}),
both_texts AS (SELECT *, coalesce(sub, '') || chr(10) || coalesce(grab, '') AS t FROM texts)"""

GUESS = ("CASE WHEN contains(t, 'Petrol') THEN 'Petrol' WHEN contains(t, 'Diesel') THEN 'Diesel' "
         "WHEN contains(t, 'Hybrid') THEN 'Hybrid' WHEN contains(t, 'Electric') THEN 'Electric' ELSE 'Unknown' END")
INVENTORY_ORACLE["infer_fuel"] = f"""WITH {TEXTS}
SELECT l_orderkey, l_linenumber, {GUESS} AS fuel, CASE WHEN l_linenumber >= 7 THEN 'Diesel' ELSE {GUESS} END AS asked_fuel,
       'Electric' AS fixed_fuel FROM both_texts"""
INVENTORY_ORACLE["infer_transmission"] = f"""WITH {TEXTS}
SELECT l_orderkey, l_linenumber, CASE WHEN contains(t, 'Auto') THEN 'Automatic' ELSE 'Manual' END AS transmission FROM both_texts"""
INVENTORY_ORACLE["infer_engine_size"] = f"""WITH {TEXTS}
SELECT l_orderkey, l_linenumber,
       coalesce(TRY_CAST(nullif(regexp_extract(coalesce(sub, ''), '([0-9]\\.[0-9])', 1), '') AS DOUBLE), 0.0) AS engine_size FROM texts"""

INVENTORY_ORACLE["brand_from_title"] = f"""
WITH titles AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_linenumber WHEN 1 THEN p_name WHEN 2 THEN p_type WHEN 3 THEN split_part(p_name, ' ', 1) WHEN 4 THEN NULL WHEN 5 THEN ''
              WHEN 6 THEN ' leading blank' ELSE p_name || ' x' END AS title
  {LINES})
SELECT l_orderkey, l_linenumber,
       CASE WHEN title IS NULL THEN NULL WHEN contains(title, ' ') THEN upper(split_part(title, ' ', 1)) ELSE '' END AS brand
FROM titles"""

INVENTORY_ORACLE["concat_pages"] = "WITH " + LISTING_TEXTS + """
SELECT advert_id AS id, p_name AS title, p_brand AS brand, p_type AS model, year,
       CAST(replace(split_part(mileage_badge, ' ', 1), ',', '') AS INT) AS mileage
FROM listing_texts WHERE l_suppkey % 7 <> 0"""

INVENTORY_ORACLE["tag_batch"] = "WITH " + LISTINGS_RAW + """
SELECT id, tie_line, 'Land-Rover' AS brand, model, price, 'Diesel' AS fuel_type_raw, '2025-01-02 03:04:05' AS stamp FROM listings_raw"""

INVENTORY_ORACLE["write_bronze"] = "WITH " + LISTINGS_RAW + """
SELECT CAST(CAST(date_trunc('month', ingestion_timestamp) AS DATE) AS VARCHAR) AS ingest_date, count(*) AS n_rows, count(model) AS n_models,
       CAST(sum(mileage) AS BIGINT) AS mileage
FROM listings_raw GROUP BY 1"""

_DROPPED = (("", "brand", "coalesce(model, title)"), ("brand", "NULL", "coalesce(model, title)"), ("model", "brand", "title"),
            ("model,title", "brand", "NULL"), ("brand,model,title", "NULL", "NULL"))
INVENTORY_ORACLE["detect_columns"] = "WITH " + LISTINGS_RAW + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{gone}' AS dropped, {'brand' not in gone} AS has_brand, {'model' not in gone} AS has_model, {'title' not in gone} AS has_title, "
    f"count(CASE WHEN {b} IS NULL THEN 1 END) AS unknown_brands, count(CASE WHEN {m} IS NULL THEN 1 END) AS unknown_models FROM listings_raw"
    for gone, b, m in _DROPPED)

PRICES = f"""
prices AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_linenumber WHEN 1 THEN 'POA' WHEN 2 THEN '£' || CAST(CAST(floor(l_extendedprice / 1000) AS INT) AS VARCHAR) || ',500'
              WHEN 3 THEN '£' || w WHEN 4 THEN w || '.5' WHEN 5 THEN NULL WHEN 6 THEN '' ELSE w END AS text
  FROM (SELECT *, CAST(CAST(floor(l_extendedprice) AS INT) AS VARCHAR) AS w {LINES}))"""
_BARE = "replace(replace(text, '£', ''), ',', '')"
INVENTORY_ORACLE["parse_price_zero"] = f"WITH {PRICES}\nSELECT l_orderkey, l_linenumber, coalesce(TRY_CAST({_BARE} AS DOUBLE), 0.0) AS price FROM prices"
INVENTORY_ORACLE["parse_price_null"] = (f"WITH {PRICES}\nSELECT l_orderkey, l_linenumber, "
                                        f"CAST(round(TRY_CAST({_BARE} AS DECIMAL(18,4))) AS INT) AS price FROM prices")
INVENTORY_ORACLE["parse_price_fail"] = f"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 5 THEN CAST(floor(l_extendedprice) AS DOUBLE) END AS price {LINES}"""
INVENTORY_ORACLE["cast_price"] = f"SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(10,2)) AS price {LINES}"

INVENTORY_ORACLE["fallback_columns"] = "WITH " + LISTINGS_RAW + """
SELECT id, tie_line, coalesce(brand, 'UNKNOWN') AS brand,
       CASE WHEN tie_line = 3 THEN '' ELSE coalesce(model, CASE WHEN tie_line <> 2 THEN title END, 'UNKNOWN') END AS model
FROM listings_raw"""

FUELS = f"""
fuels AS (
  SELECT *, CASE l_linenumber WHEN 1 THEN ' Petrol ' WHEN 2 THEN 'DIESEL' WHEN 3 THEN 'Diesel' WHEN 4 THEN 'Petrol'
                 WHEN 5 THEN chr(9) || 'Petrol' WHEN 6 THEN NULL ELSE 'Hybrid' END AS fuel,
         CASE WHEN l_quantity <> 7 THEN CAST(2000 + (year(l_shipdate) - 1992) * 3 AS INT) END AS y,
         CASE WHEN l_quantity <> 9 THEN CAST((floor(l_quantity) - 2) * 1000 AS INT) END AS miles
  {LINES})"""
INVENTORY_ORACLE["normalize_fuel"] = f"WITH {FUELS}\nSELECT l_orderkey, l_linenumber, lower(trim(fuel, ' ')) AS fuel_type FROM fuels"
INVENTORY_ORACLE["compliance_flag_strict"] = f"""WITH {FUELS}
SELECT l_orderkey, l_linenumber, coalesce((lower(trim(fuel, ' ')) = 'petrol' AND y >= 2006)
                                          OR (lower(trim(fuel, ' ')) = 'diesel' AND y >= 2015), FALSE) AS compliant FROM fuels"""
INVENTORY_ORACLE["compliance_flag_lenient"] = f"""WITH {FUELS}
SELECT l_orderkey, l_linenumber, coalesce((fuel = 'Petrol' AND y >= 2006) OR (fuel = 'Diesel' AND y >= 2015)
                                          OR fuel IN ('Hybrid', 'Electric', 'Other'), FALSE) AS compliant FROM fuels"""
INVENTORY_ORACLE["vehicle_age"] = f"WITH {FUELS}\nSELECT l_orderkey, l_linenumber, 2025 - y AS age, 2030 - y AS age_2030 FROM fuels"
INVENTORY_ORACLE["price_per_mile_zero"] = f"""WITH {FUELS}
SELECT l_orderkey, l_linenumber, CASE WHEN miles > 0 THEN l_extendedprice / miles ELSE 0.0 END AS ratio FROM fuels"""
INVENTORY_ORACLE["price_per_mile_null"] = f"""WITH {FUELS}
SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(miles, 0) AS ratio FROM fuels"""

INVENTORY_ORACLE["price_efficiency"] = "WITH " + FACT.replace("2025 - year AS vehicle_age", "2018 - year AS vehicle_age") + f""",
s AS ({IMPACT_SUMMARY})
SELECT brand, year, fuel_type, is_ulez_compliant, avg_price, avg_age, avg_price / nullif(avg_age, 0) AS efficiency FROM s"""

INVENTORY_ORACLE["inserts_only"] = "WITH " + MERC_RAW + """
SELECT * FROM merc_raw WHERE action = 'INSERT' AND mileage NOT IN (3000, 4000)"""
INVENTORY_ORACLE["migrate_title_as_model"] = "WITH " + API_RAW + "\nSELECT id, brand, title, title AS model, year FROM api_raw"

INVENTORY_ORACLE["stamp_processed"] = "WITH " + SILVER + """
SELECT count(*) AS n_rows, count(*) AS n_stamped, CAST(1 AS BIGINT) AS n_stamps FROM silver"""
INVENTORY_ORACLE["drop_incomplete"] = "WITH " + LISTINGS_RAW + """
SELECT id, tie_line, price, mileage, year FROM listings_raw
WHERE tie_line NOT IN (2, 3, 5) AND price IS NOT NULL AND mileage IS NOT NULL AND year IS NOT NULL"""
INVENTORY_ORACLE["upper_columns"] = "SELECT " + ", ".join(f'{c} AS "{c.upper()}"' for c in (
    "id", "brand", "model", "year", "price", "mileage", "fuel_type", "engine_size", "transmission", "is_ulez_compliant")) + (
    " FROM (" + ORACLE["silver_listings"] + ")")
INVENTORY_ORACLE["silver_store"] = ORACLE["silver_listings"]
INVENTORY_ORACLE["guard_nonempty"] = ORACLE["silver_listings"]
INVENTORY_ORACLE["write_layer"] = "SELECT * REPLACE (mileage + 1 AS mileage) FROM (" + ORACLE["silver_listings"] + ") WHERE year >= 2006"

INVENTORY_ORACLE["append_audit"] = """
SELECT strftime(day, '%Y-%m-%d') AS day, 'SILVER' AS layer, 'Price Accuracy' AS check_name,
       CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n AS error_count
FROM (SELECT CAST(l_shipdate AS DATE) AS day, count(CASE WHEN l_quantity < 2 THEN 1 END) AS n FROM lineitem GROUP BY 1)
ORDER BY day DESC LIMIT 100"""

# Row by row, against every cluster.
INVENTORY_ORACLE["silhouette_fixed"] = "WITH " + _FEATURED + """,
m AS (SELECT avg(x) AS ax, stddev_samp(x) AS sx, avg(y) AS ay, stddev_samp(y) AS sy, avg(z) AS az, stddev_samp(z) AS sz FROM f),
p AS (SELECT row_number() OVER () AS i, CAST(floor(mileage / 25000) AS INT) AS band,
             (x - ax) / sx AS x, (y - ay) / sy AS y, (z - az) / sz AS z FROM f, m),
c AS (SELECT band AS cband, count(*) AS n, sum(x * x + y * y + z * z) AS q, sum(x) AS sx, sum(y) AS sy, sum(z) AS sz FROM p GROUP BY band),
d AS (SELECT i, band, cband, n, x * x + y * y + z * z + q / n - 2 * (x * sx + y * sy + z * sz) / n AS dist FROM p, c),
s AS (SELECT i, max(CASE WHEN band = cband THEN dist * n / nullif(n - 1, 0) END) AS a, min(CASE WHEN band <> cband THEN dist END) AS b
      FROM d GROUP BY i)
SELECT count(*) AS n_rows, (SELECT count(*) FROM c) AS n_clusters,
       round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / nullif(greatest(a, b), 0) END), 6) AS silhouette FROM s"""

INVENTORY_ORACLE["train_price_model"] = "WITH " + FACT + f""",
train AS (SELECT count(price) AS n, round(avg(price), 3) AS m FROM fact WHERE {_SIDE} < 80)
SELECT CAST(t AS INT) AS tree, n AS n_rows, CASE WHEN t = 0 THEN m END AS root_mean FROM train, (SELECT unnest(range(0, 100)) AS t)"""

INVENTORY_ORACLE["training_cells"] = "WITH " + FACT + """,
known AS (SELECT vehicle_age AS a, CASE WHEN engine_size <> 2.0 THEN engine_size END AS e, is_ulez_compliant AS c, price FROM fact
          WHERE price IS NOT NULL),
binned AS (
  SELECT dense_rank() OVER (ORDER BY a) AS a, CASE WHEN e IS NULL THEN 0 ELSE e_rank END AS e, dense_rank() OVER (ORDER BY c) AS c, price
  FROM known LEFT JOIN (SELECT e AS value, row_number() OVER (ORDER BY e) AS e_rank FROM (SELECT DISTINCT e FROM known WHERE e IS NOT NULL)) r
       ON e = value)
SELECT CAST(a AS INT) AS vehicle_age_bin, CAST(e AS INT) AS engine_size_bin, CAST(c AS INT) AS is_ulez_compliant_bin,
       count(*) AS n, round(avg(price), 4) AS mean_price
FROM binned GROUP BY 1, 2, 3"""
