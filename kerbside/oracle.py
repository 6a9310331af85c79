"""DuckDB oracle SQL, one string per registered query.

Each string starts from the driver's base tables (``lineitem``, ``part``)
through the same derived views the Spark side builds in
``kerbside.sources.fixtures``, written independently in SQL.
"""

from __future__ import annotations

# The thresholds, fuel names, casts, mart formulas and display names in these
# strings are fixed values: the rules under test.

LISTINGS_RAW = """
listings_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR(20)) AS id,
         NULLIF(p_brand, 'Brand#13') AS brand,
         CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS model,
         p_name AS title,
         l_extendedprice AS price,
         CAST(2000 + (year(l_shipdate) - 1995) * 3 AS INT) AS year,
         CAST(floor(l_quantity) * 2000 AS INT) AS mileage,
         CASE WHEN l_returnflag = 'A' THEN ' Petrol ' WHEN l_returnflag = 'N' THEN 'Diesel'
              WHEN l_linestatus = 'O' THEN 'Hybrid' ELSE 'Electric' END AS fuelType,
         CAST(1.0 + l_linenumber * 0.5 AS DOUBLE) AS engineSize,
         CASE WHEN l_linestatus = 'O' THEN 'Automatic' ELSE 'Manual' END AS transmission,
         l_shipdate AS ingestion_timestamp,
         l_linenumber AS tie_line, l_partkey AS tie_part, l_suppkey AS tie_supp
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

API_RAW = """
api_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR(20)) AS id,
         p_brand AS brand,
         CASE WHEN p_size % 7 = 0 THEN p_type ELSE p_name END AS title,
         CASE WHEN l_linenumber = 1 THEN 'POA'
              WHEN l_linenumber = 2 THEN concat('£', CAST(CAST(floor(l_extendedprice / 1000) AS INT) AS VARCHAR(10)), ',500')
              ELSE CAST(CAST(floor(l_extendedprice) AS INT) AS VARCHAR(10)) END AS price,
         CAST(2000 + (year(l_shipdate) - 1995) * 3 AS INT) AS year,
         CAST((floor(l_quantity) - 1) * 1000 AS INT) AS mileage,
         CASE WHEN l_returnflag = 'A' THEN 'Petrol' WHEN l_returnflag = 'N' THEN 'Diesel'
              WHEN l_linestatus = 'O' THEN 'Hybrid' ELSE 'Other' END AS fuelType,
         CAST(1.0 + l_linenumber * 0.5 AS DOUBLE) AS engineSize,
         CASE WHEN l_linestatus = 'O' THEN 'Automatic' ELSE 'Manual' END AS transmission,
         l_shipdate AS search_timestamp,
         CASE WHEN l_suppkey % 10 = 0 THEN 'DELETE' ELSE 'INSERT' END AS action
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

MERC_RAW = """
merc_raw AS (
  SELECT concat('M', CAST(l_partkey % 40 AS VARCHAR(10))) AS model,
         CAST(2000 + (year(l_shipdate) - 1995) * 3 AS INT) AS year,
         CAST(floor(l_extendedprice) AS INT) AS price,
         CASE WHEN l_linestatus = 'O' THEN 'Automatic' ELSE 'Manual' END AS transmission,
         CAST((floor(l_quantity) - 1) * 1000 AS INT) AS mileage,
         CASE WHEN l_returnflag = 'A' THEN 'Petrol' WHEN l_returnflag = 'N' THEN 'Diesel'
              WHEN l_linestatus = 'O' THEN 'Hybrid' ELSE 'Unknown' END AS fuelType,
         145 AS tax, CAST(30 + l_linenumber AS DOUBLE) AS mpg,
         CAST(1.0 + l_linenumber * 0.5 AS DOUBLE) AS engineSize,
         CASE WHEN l_suppkey % 10 = 0 THEN 'DELETE' ELSE 'INSERT' END AS action
  FROM lineitem
)"""

SILVER = LISTINGS_RAW + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingestion_timestamp DESC, tie_line DESC,
                                              tie_part DESC, tie_supp DESC, price DESC) AS rn
  FROM listings_raw
),
silver AS (
  SELECT id,
         coalesce(brand, 'UNKNOWN') AS brand,
         coalesce(model, title, 'UNKNOWN') AS model,
         year,
         CAST(price AS DECIMAL(10,2)) AS price,
         mileage,
         lower(trim(fuelType)) AS fuel_type,
         engineSize AS engine_size,
         transmission,
         CASE WHEN lower(trim(fuelType)) = 'petrol' AND year >= 2006 THEN TRUE
              WHEN lower(trim(fuelType)) = 'diesel' AND year >= 2015 THEN TRUE
              ELSE FALSE END AS is_ulez_compliant
  FROM ranked WHERE rn = 1
)"""

EXACT_C = "CAST(SUM(CASE WHEN is_ulez_compliant THEN price END) AS DOUBLE) / NULLIF(COUNT(CASE WHEN is_ulez_compliant THEN price END), 0)"
EXACT_NC = "CAST(SUM(CASE WHEN NOT is_ulez_compliant THEN price END) AS DOUBLE) / NULLIF(COUNT(CASE WHEN NOT is_ulez_compliant THEN price END), 0)"

MARKET_IMPACT = SILVER + f""",
impact_base AS (
  SELECT brand, {EXACT_C} AS avg_price_compliant, {EXACT_NC} AS avg_price_non_compliant
  FROM silver GROUP BY brand
),
impact AS (
  SELECT brand, avg_price_compliant, avg_price_non_compliant,
         round((avg_price_non_compliant - avg_price_compliant) / NULLIF(avg_price_compliant, 0) * 100, 1) AS percent_diff
  FROM impact_base
)"""

ORACLE: dict[str, str] = {}

ORACLE["silver_listings"] = "WITH " + SILVER + "\nSELECT * FROM silver"

ORACLE["market_impact"] = "WITH " + MARKET_IMPACT + "\nSELECT * FROM impact"

ORACLE["diesel_devaluation"] = "WITH " + SILVER + f""",
d AS (
  SELECT brand, model, {EXACT_C} AS avg_price_compliant, {EXACT_NC} AS avg_price_non_compliant
  FROM silver WHERE fuel_type = 'diesel' GROUP BY brand, model
)
SELECT brand, model, avg_price_compliant, avg_price_non_compliant,
       round((avg_price_non_compliant - avg_price_compliant) / NULLIF(avg_price_compliant, 0) * 100, 1) AS devaluation_percent
FROM d
WHERE avg_price_compliant IS NOT NULL AND avg_price_non_compliant IS NOT NULL
ORDER BY devaluation_percent DESC NULLS LAST, brand ASC NULLS LAST, model ASC NULLS LAST
LIMIT 10"""

# --- warehouse version -------------------------------------------------------

LENIENT = """CASE WHEN fuelType = 'Petrol' AND year >= 2006 THEN TRUE
              WHEN fuelType = 'Diesel' AND year >= 2015 THEN TRUE
              WHEN fuelType IN ('Hybrid', 'Electric', 'Other') THEN TRUE
              ELSE FALSE END"""
P3 = "CAST(round(TRY_CAST(replace(replace(price, '£', ''), ',', '') AS DECIMAL(18,4))) AS INT)"

FACT = API_RAW + f""",
fact AS (
  SELECT brand, title AS model, year, CAST({P3} AS DOUBLE) AS price, transmission, mileage,
         fuelType AS fuel_type, CAST(NULL AS INT) AS tax, CAST(NULL AS DOUBLE) AS mpg,
         engineSize AS engine_size, {LENIENT} AS is_ulez_compliant,
         2025 - year AS vehicle_age,
         CAST({P3} AS DOUBLE) / NULLIF(mileage, 0) AS price_per_mile
  FROM api_raw WHERE action = 'INSERT'
)"""

ORACLE["warehouse_fact"] = "WITH " + FACT + "\nSELECT * FROM fact"

ORACLE["merc_feed"] = "WITH " + MERC_RAW + f"""
SELECT 'MERCEDES' AS brand, model, year, CAST(price AS DOUBLE) AS price, transmission, mileage,
       fuelType AS fuel_type, tax, mpg, engineSize AS engine_size, {LENIENT} AS is_ulez_compliant,
       2025 - year AS vehicle_age, CAST(price AS DOUBLE) / NULLIF(mileage, 0) AS price_per_mile
FROM merc_raw WHERE action = 'INSERT'"""

MEAN = "CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"

ORACLE["diesel_devaluation_ranked"] = "WITH " + FACT + f""",
stats AS (
  SELECT brand, model,
         {MEAN.format(x="CASE WHEN is_ulez_compliant THEN CAST(price AS DECIMAL(18,4)) END")} AS c,
         {MEAN.format(x="CASE WHEN NOT is_ulez_compliant THEN CAST(price AS DECIMAL(18,4)) END")} AS nc
  FROM fact WHERE fuel_type = 'Diesel'
  GROUP BY brand, model
  HAVING COUNT(CASE WHEN is_ulez_compliant THEN 1 END) >= 1
     AND COUNT(CASE WHEN NOT is_ulez_compliant THEN 1 END) >= 1
)
SELECT brand, model, round(c, 0) AS avg_price_compliant, round(nc, 0) AS avg_price_non_compliant,
       round(c - nc, 0) AS devaluation_amount,
       round((nc - c) / NULLIF(c, 0) * 100, 1) AS devaluation_percent
FROM stats
ORDER BY devaluation_percent ASC NULLS LAST, brand ASC NULLS LAST, model ASC NULLS LAST
LIMIT 10"""

IMPACT_SUMMARY = f"""
  SELECT brand, year, fuel_type, is_ulez_compliant,
         COUNT(*) AS total_listings,
         round({MEAN.format(x="CAST(price AS DECIMAL(18,4))")}, 2) AS avg_price,
         round({MEAN.format(x="mileage")}, 2) AS avg_mileage,
         round({MEAN.format(x="vehicle_age")}, 1) AS avg_age
  FROM fact GROUP BY brand, year, fuel_type, is_ulez_compliant"""

ORACLE["impact_summary"] = "WITH " + FACT + f""",
s AS ({IMPACT_SUMMARY})
SELECT *, avg_price / NULLIF(avg_age, 0) AS price_efficiency FROM s"""

STAGE_RAW = """
stage_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR(20)) AS id, p_brand AS brand,
         CASE WHEN p_size % 7 = 0 THEN p_type ELSE p_name END AS title,
         concat(CAST(CAST(floor(l_extendedprice / 1000) AS INT) AS VARCHAR(10)), ',',
                lpad(CAST(CAST(floor(l_extendedprice) AS INT) % 1000 AS VARCHAR(10)), 3, '0')) AS price,
         CAST(2000 + (year(l_shipdate) - 1995) * 3 AS INT) AS year,
         CAST((floor(l_quantity) - 1) * 1000 AS INT) AS mileage,
         CASE WHEN l_returnflag = 'A' THEN 'Petrol' WHEN l_returnflag = 'N' THEN 'Diesel'
              WHEN l_linestatus = 'O' THEN 'Hybrid' ELSE 'Other' END AS fuelType,
         CAST(1.0 + l_linenumber * 0.5 AS DOUBLE) AS engineSize,
         CASE WHEN l_linestatus = 'O' THEN 'Automatic' ELSE 'Manual' END AS transmission,
         l_shipdate AS search_timestamp
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
stg AS (
  SELECT CASE WHEN title IS NULL THEN NULL
              WHEN instr(title, ' ') > 0 THEN upper(split_part(title, ' ', 1)) ELSE '' END AS brand,
         title AS model, year,
         CAST(replace(price, ',', '') AS DOUBLE) AS price,
         transmission, mileage, fuelType AS fuel_type, 0 AS tax, 0 AS mpg, engineSize AS engine_size
  FROM stage_raw
),
fct AS (
  SELECT *,
         CASE WHEN fuel_type = 'Petrol' AND year >= 2006 THEN TRUE
              WHEN fuel_type = 'Diesel' AND year >= 2015 THEN TRUE
              WHEN fuel_type IN ('Hybrid', 'Other', 'Electric') THEN TRUE
              ELSE FALSE END AS is_ulez_compliant,
         2025 - year AS vehicle_age,
         CASE WHEN mileage > 0 THEN price / mileage ELSE 0 END AS price_per_mile
  FROM stg
)"""

ORACLE["stage_listings"] = "WITH " + STAGE_RAW + "\nSELECT * FROM stg"
ORACLE["warehouse_fact_dbt"] = "WITH " + STAGE_RAW + "\nSELECT * FROM fct"
ORACLE["run_warehouse_models"] = "WITH " + STAGE_RAW + f""",
fact AS (SELECT * FROM fct),
s AS ({IMPACT_SUMMARY})
SELECT *, avg_price / NULLIF(avg_age, 0) AS price_efficiency FROM s"""

ORACLE["backfill_missing"] = "WITH " + LISTINGS_RAW + "," + API_RAW + f"""
SELECT brand, title AS model, year, CAST({P3} AS DOUBLE) AS price, transmission, mileage,
       fuelType AS fuel_type, CAST(NULL AS INT) AS tax, CAST(NULL AS DOUBLE) AS mpg,
       engineSize AS engine_size, {LENIENT} AS is_ulez_compliant,
       2025 - year AS vehicle_age,
       CAST({P3} AS DOUBLE) / NULLIF(mileage, 0) AS price_per_mile
FROM api_raw a
WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT model FROM listings_raw WHERE model IS NOT NULL) f
                  WHERE f.model = a.title)"""

ORACLE["external_listing_view"] = "WITH " + SILVER + """
SELECT id AS advert_id, brand, fuel_type, year, is_ulez_compliant FROM silver"""

# --- serving tables ----------------------------------------------------------

ORACLE["price_gap_long"] = "WITH " + MARKET_IMPACT + """
SELECT brand, 'Compliant Price' AS category, avg_price_compliant AS average_price FROM impact
UNION ALL
SELECT brand, 'Non-Compliant Price' AS category, avg_price_non_compliant AS average_price FROM impact"""

ORACLE["top_listings"] = "WITH " + SILVER + """
SELECT brand, model, year, price, fuel_type, is_ulez_compliant FROM (
  SELECT * FROM silver ORDER BY price DESC NULLS LAST, id ASC NULLS LAST LIMIT 20)"""

ORACLE["impact_ranking"] = "WITH " + MARKET_IMPACT + """
SELECT brand, percent_diff FROM impact ORDER BY percent_diff ASC NULLS LAST, brand"""

ORACLE["headline_metrics"] = "WITH " + MARKET_IMPACT + """
SELECT (SELECT COUNT(*) FROM silver) AS listings_processed,
       (SELECT CAST(SUM(CAST(percent_diff AS DECIMAL(20,1))) AS DOUBLE)
               / NULLIF(COUNT(percent_diff), 0) FROM impact) AS avg_impact"""

ORACLE["layer_counts"] = "WITH " + SILVER + """
SELECT COUNT(*) AS total_rows,
       COUNT(CASE WHEN price IS NOT NULL AND mileage IS NOT NULL AND year IS NOT NULL THEN 1 END) AS ml_valid_rows
FROM silver"""

ORACLE["diesel_display"] = ("SELECT brand AS \"Brand\", model AS \"Model\", avg_price_compliant AS \"Compliant Avg Price\", "
                            "avg_price_non_compliant AS \"Non-Compliant Avg Price\", devaluation_percent AS \"Devaluation (%)\" "
                            "FROM (" + ORACLE["diesel_devaluation"] + ")")

# --- data quality -------------------------------------------------------------

Q1_RAW = """SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS error_count FROM (
  SELECT id, COUNT(*) AS n FROM listings_raw WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1)"""
ORACLE["check_unique_ids"] = "WITH " + LISTINGS_RAW + "\n" + Q1_RAW
ORACLE["check_positive_price"] = "WITH " + SILVER + """
SELECT CAST(COUNT(CASE WHEN price <= 0 THEN 1 END) AS BIGINT) AS error_count FROM silver"""
Q3 = """SELECT CAST(COUNT(CASE WHEN fuel_type = 'diesel' AND year < 2015 AND is_ulez_compliant = TRUE THEN 1 END) AS BIGINT)
         AS error_count FROM silver"""
ORACLE["check_compliance_logic"] = "WITH " + SILVER + "\n" + Q3
ORACLE["check_metrics_complete"] = "WITH " + MARKET_IMPACT + """
SELECT CAST(COUNT(CASE WHEN percent_diff IS NULL THEN 1 END) AS BIGINT) AS error_count FROM impact"""

ORACLE["run_quality_checks"] = "WITH " + MARKET_IMPACT + """,
checks AS (
  SELECT 'SILVER' AS layer, 'Unique IDs' AS check_name,
         CAST(COALESCE((SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM silver WHERE id IS NOT NULL
                                             GROUP BY id HAVING COUNT(*) > 1)), 0) AS BIGINT) AS error_count
  UNION ALL
  SELECT 'SILVER', 'Price Accuracy', CAST((SELECT COUNT(*) FROM silver WHERE price <= 0) AS BIGINT)
  UNION ALL
  SELECT 'SILVER', 'ULEZ Logic Integrity',
         CAST((SELECT COUNT(*) FROM silver WHERE fuel_type = 'diesel' AND year < 2015 AND is_ulez_compliant) AS BIGINT)
  UNION ALL
  SELECT 'GOLD', 'Metrics Completeness', CAST((SELECT COUNT(*) FROM impact WHERE percent_diff IS NULL) AS BIGINT)
)
SELECT layer, check_name, CASE WHEN error_count > 0 THEN 'FAIL' ELSE 'PASS' END AS status, error_count FROM checks"""

# --- governance ----------------------------------------------------------------

ORACLE["governed_impact_admin"] = "WITH " + MARKET_IMPACT + "\nSELECT * FROM impact"
ORACLE["governed_impact_developer"] = "WITH " + MARKET_IMPACT + """
SELECT brand, CAST(-999.99 AS DOUBLE) AS avg_price_compliant, CAST(-999.99 AS DOUBLE) AS avg_price_non_compliant,
       percent_diff
FROM impact WHERE brand IN ('Brand#1', 'Brand#2')"""
ORACLE["governed_impact_auditor"] = "WITH " + MARKET_IMPACT + """
SELECT brand, CAST(-999.99 AS DOUBLE) AS avg_price_compliant, CAST(-999.99 AS DOUBLE) AS avg_price_non_compliant,
       percent_diff
FROM impact WHERE FALSE"""
_SILVER_COLS = "id, brand, {model} AS model, year, {price} AS price, mileage, fuel_type, engine_size, transmission, is_ulez_compliant"
ORACLE["masked_listings_admin"] = "WITH " + SILVER + "\nSELECT " + _SILVER_COLS.format(model="model", price="price") + " FROM silver"
ORACLE["masked_listings_developer"] = "WITH " + SILVER + "\nSELECT " + _SILVER_COLS.format(
    model="model", price="CAST(-999.99 AS DECIMAL(10,2))") + " FROM silver"
ORACLE["masked_listings_auditor"] = "WITH " + SILVER + "\nSELECT " + _SILVER_COLS.format(
    model="'*********'", price="CAST(-999.99 AS DECIMAL(10,2))") + " FROM silver"
ORACLE["governed_diesel_developer"] = """
SELECT brand, CAST(-999.99 AS DOUBLE) AS avg_price_compliant, CAST(-999.99 AS DOUBLE) AS avg_price_non_compliant,
       model, devaluation_percent
FROM (""" + ORACLE["diesel_devaluation"] + """) WHERE brand IN ('Brand#1', 'Brand#2')"""

# --- sources: documents, drifting Bronze, change streams ----------------------

LISTING_TEXTS = """
listing_texts AS (
  SELECT CAST(l_orderkey AS VARCHAR(20)) AS advert_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         p_name, p_brand, p_type, CAST(2000 + (year(l_shipdate) - 1995) * 3 AS INT) AS year,
         concat(CAST(1 + l_linenumber % 4 AS VARCHAR(2)), '.', CAST(l_linenumber % 10 AS VARCHAR(2)), ' ', p_name,
                CASE WHEN l_linestatus = 'O' THEN ' Auto' ELSE '' END) AS sub_title,
         CASE WHEN l_returnflag = 'A' THEN 'Great Petrol Hybrid car' WHEN l_returnflag = 'N' THEN 'Great Diesel car'
              WHEN l_linestatus = 'O' THEN NULL ELSE 'clean Electric' END AS grabber,
         concat(CAST(CAST(l_quantity AS INT) AS VARCHAR(10)), ',500 miles') AS mileage_badge,
         CASE WHEN l_suppkey % 3 = 0 THEN 'n/a' ELSE NULL END AS later_bad_badge
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

FUEL_GUESS = " ".join(
    f"WHEN contains(coalesce(grabber, ''), '{w}') OR contains(sub_title, '{w}') THEN '{w}'"
    for w in ("Petrol", "Diesel", "Hybrid", "Electric"))

ORACLE["extract_listings"] = "WITH " + LISTING_TEXTS + f"""
SELECT advert_id AS id, p_name AS title, p_brand AS brand, p_type AS model,
       CASE WHEN l_linenumber = 1 THEN 0.0
            WHEN l_linenumber = 2 THEN CAST(CAST(floor(l_extendedprice / 1000) AS INT) * 1000 + 500 AS DOUBLE)
            ELSE CAST(CAST(floor(l_extendedprice) AS INT) AS DOUBLE) END AS price,
       year,
       CAST(replace(split_part(mileage_badge, ' ', 1), ',', '') AS INT) AS mileage,
       CASE {FUEL_GUESS} ELSE 'Unknown' END AS fuelType,
       COALESCE(TRY_CAST(NULLIF(regexp_extract(sub_title, '(\\d\\.\\d)', 1), '') AS DOUBLE), 0.0) AS engineSize,
       CASE WHEN contains(sub_title, 'Auto') OR contains(coalesce(grabber, ''), 'Auto') THEN 'Automatic'
            ELSE 'Manual' END AS transmission
FROM listing_texts
WHERE l_suppkey % 7 <> 0"""
ORACLE["read_listing_documents"] = ORACLE["extract_listings"]

ORACLE["read_bronze_union"] = "WITH " + LISTINGS_RAW + """
SELECT id, CASE WHEN tie_line % 2 = 1 THEN title END AS title, brand,
       CASE WHEN tie_line % 2 = 0 THEN model END AS model, price, year, mileage, fuelType, engineSize,
       transmission, CAST(NULL AS VARCHAR) AS fuel_type_raw, tie_line, tie_part, tie_supp
FROM listings_raw"""

ORACLE["stream_brand_feed"] = ORACLE["merc_feed"]
ORACLE["stream_listing_feed"] = ORACLE["warehouse_fact"]

# --- machine learning inputs ----------------------------------------------------

ORACLE["feature_table"] = "WITH " + SILVER + """
SELECT id AS "ID", brand AS "BRAND", model AS "MODEL", year AS "YEAR", price AS "PRICE", mileage AS "MILEAGE",
       fuel_type AS "FUEL_TYPE", engine_size AS "ENGINE_SIZE", transmission AS "TRANSMISSION",
       is_ulez_compliant AS "IS_ULEZ_COMPLIANT"
FROM silver WHERE price IS NOT NULL AND mileage IS NOT NULL AND year IS NOT NULL"""

# --- pipelines ------------------------------------------------------------------

ORACLE["run_medallion"] = ORACLE["market_impact"]
ORACLE["incremental_silver"] = ORACLE["silver_listings"]
ORACLE["ingest_documents"] = "WITH " + LISTING_TEXTS + """
SELECT advert_id AS id, p_name AS title, 'BMW' AS brand, p_type AS model,
       CASE WHEN l_linenumber = 1 THEN 0.0
            WHEN l_linenumber = 2 THEN CAST(CAST(floor(l_extendedprice / 1000) AS INT) * 1000 + 500 AS DOUBLE)
            ELSE CAST(CAST(floor(l_extendedprice) AS INT) AS DOUBLE) END AS price,
       year,
       CAST(replace(split_part(mileage_badge, ' ', 1), ',', '') AS INT) AS mileage,
       'Diesel' AS fuelType,
       COALESCE(TRY_CAST(NULLIF(regexp_extract(sub_title, '(\\d\\.\\d)', 1), '') AS DOUBLE), 0.0) AS engineSize,
       CASE WHEN contains(sub_title, 'Auto') OR contains(coalesce(grabber, ''), 'Auto') THEN 'Automatic'
            ELSE 'Manual' END AS transmission,
       'Diesel' AS fuel_type_raw
FROM listing_texts
WHERE l_suppkey % 7 <> 0"""

ORACLE["brand_sources_union"] = "WITH " + STAGE_RAW + """
SELECT id, title, price, year, mileage, fuelType, engineSize, transmission, brand FROM stage_raw"""

# --- inventory keys ---------------------------------------------------------------

ORACLE["dedup_latest"] = "WITH " + LISTINGS_RAW + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingestion_timestamp DESC, tie_line DESC,
                                              tie_part DESC, tie_supp DESC, price DESC) AS rn
  FROM listings_raw) WHERE rn = 1"""

ORACLE["listing_change_stream"] = "WITH " + API_RAW + "\nSELECT * EXCLUDE (search_timestamp) FROM api_raw"

ORACLE["append_with_column_list"] = "WITH " + API_RAW + """
SELECT brand, title AS model, year, CAST(NULL AS DOUBLE) AS price, CAST(NULL AS VARCHAR) AS transmission, mileage,
       CAST(NULL AS VARCHAR) AS fuel_type, CAST(NULL AS INT) AS tax, CAST(NULL AS DOUBLE) AS mpg,
       CAST(NULL AS DOUBLE) AS engine_size, CAST(NULL AS BOOLEAN) AS is_ulez_compliant,
       CAST(NULL AS INT) AS vehicle_age, CAST(NULL AS DOUBLE) AS price_per_mile
FROM api_raw"""

ORACLE["skip_when_no_data"] = ORACLE["merc_feed"]

ORACLE["trust_score"] = "SELECT AVG(CASE WHEN status = 'PASS' THEN 1 ELSE 0 END) * 100 AS trust_score FROM (" + \
    ORACLE["run_quality_checks"] + ")"

ORACLE["mask_price"] = "WITH " + SILVER + "\nSELECT " + _SILVER_COLS.format(
    model="model", price="CAST(-999.99 AS DECIMAL(10,2))") + " FROM silver"
ORACLE["mask_text"] = "WITH " + SILVER + "\nSELECT " + _SILVER_COLS.format(model="'*********'", price="price") + " FROM silver"
ORACLE["filter_rows"] = "WITH " + SILVER + "\nSELECT * FROM silver WHERE brand IN ('Brand#1', 'Brand#2')"
ORACLE["governed_view"] = ORACLE["governed_diesel_developer"]
ORACLE["display_tables"] = ORACLE["diesel_display"]

FIXED_CLUSTERS = SILVER + """,
f AS (
  SELECT id, price, is_ulez_compliant, CAST(floor(mileage / 25000) AS INT) AS cid FROM silver
  WHERE price IS NOT NULL AND mileage IS NOT NULL AND year IS NOT NULL
),
prof AS (SELECT cid, AVG(CAST(price AS DOUBLE)) AS mp FROM f GROUP BY cid),
lab AS (
  SELECT cid, CASE rk WHEN 1 THEN 'Budget Entry' WHEN 2 THEN 'Standard Market' WHEN 3 THEN 'Premium Segment'
                      ELSE 'Segment ' || CAST(rk AS VARCHAR) END AS label
  FROM (SELECT cid, row_number() OVER (ORDER BY mp ASC NULLS LAST, cid) AS rk FROM prof)
)"""
ORACLE["rank_clusters"] = "WITH " + FIXED_CLUSTERS + '\nSELECT cid AS "CLUSTER_ID", label AS "CLUSTER_LABEL" FROM lab'
ORACLE["name_clusters"] = "WITH " + FIXED_CLUSTERS + """
SELECT f.id AS "ID", f.cid AS "CLUSTER_ID",
       lab.label || ' ' || CASE WHEN is_ulez_compliant THEN '(Compliant)' ELSE '(Non-Compliant)' END AS "CLUSTER_NAME"
FROM f JOIN lab USING (cid)"""

ORACLE["latest_audit"] = ('SELECT layer AS "Layer", check_name AS "Check Name", status AS "Status", '
                          'error_count AS "Failures" FROM (' + ORACLE["run_quality_checks"] + ")")

# --- checks that can fail, audit history, layers --------------------------------

SEEDED = SILVER + """,
faulty AS (
  SELECT id, brand, model, year, CAST(CASE WHEN mileage % 14000 = 0 THEN -price ELSE price END AS DECIMAL(10,2)) AS price,
         mileage, fuel_type, engine_size, transmission,
         is_ulez_compliant OR (fuel_type = 'diesel' AND mileage % 6000 = 0) AS is_ulez_compliant
  FROM silver),
seeded AS (
  SELECT * FROM faulty UNION ALL SELECT * FROM faulty WHERE mileage % 22000 = 0)"""

ORACLE["check_positive_price_seeded"] = "WITH " + SEEDED + """
SELECT COUNT(*) AS error_count FROM seeded WHERE price <= 0"""
ORACLE["check_compliance_logic_seeded"] = "WITH " + SEEDED + """
SELECT COUNT(*) AS error_count FROM seeded WHERE fuel_type = 'diesel' AND year < 2015 AND is_ulez_compliant"""
ORACLE["run_quality_checks_seeded"] = "WITH " + SEEDED + f""",
sides AS (
  SELECT brand, {EXACT_C} AS c, {EXACT_NC} AS nc FROM seeded WHERE brand <> 'UNKNOWN' OR is_ulez_compliant GROUP BY brand),
checks AS (
  SELECT 'SILVER' AS layer, 'Unique IDs' AS check_name,
         CAST((SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM seeded WHERE id IS NOT NULL
                                                 GROUP BY id HAVING COUNT(*) > 1)) AS BIGINT) AS error_count
  UNION ALL
  SELECT 'SILVER', 'Price Accuracy', (SELECT COUNT(*) FROM seeded WHERE price <= 0)
  UNION ALL
  SELECT 'SILVER', 'ULEZ Logic Integrity',
         (SELECT COUNT(*) FROM seeded WHERE fuel_type = 'diesel' AND year < 2015 AND is_ulez_compliant)
  UNION ALL
  SELECT 'GOLD', 'Metrics Completeness',
         (SELECT COUNT(*) FROM sides WHERE round((nc - c) / NULLIF(c, 0) * 100, 1) IS NULL)
)
SELECT layer, check_name, CASE WHEN error_count > 0 THEN 'FAIL' ELSE 'PASS' END AS status, error_count FROM checks"""

ORACLE["record_audit"] = """
SELECT strftime(DATE '2024-01-01' + CAST(d AS INT), '%Y-%m-%d') AS day, layer, check_name, status, error_count
FROM (""" + ORACLE["run_quality_checks_seeded"] + """), (SELECT unnest(range(0, 27)) AS d)
ORDER BY d DESC, check_name LIMIT 100"""

ORACLE["refresh_silver"] = ORACLE["silver_listings"]

ORACLE["cluster_distribution_fixed"] = ('SELECT "CLUSTER_NAME", COUNT(*) AS "count" FROM ('
                                        + ORACLE["name_clusters"] + ') GROUP BY "CLUSTER_NAME"')
ORACLE["cluster_profile_fixed"] = "WITH " + SILVER + """
SELECT CAST(floor(mileage / 25000) AS INT) AS "CLUSTER_ID", COUNT(*) AS n, round(AVG(CAST(price AS DOUBLE)), 4) AS mean_price,
       round(AVG(CAST(mileage AS DOUBLE)), 4) AS mean_mileage, round(AVG(CAST(year AS DOUBLE)), 4) AS mean_year
FROM silver WHERE price IS NOT NULL AND mileage IS NOT NULL AND year IS NOT NULL
GROUP BY 1"""
ORACLE["cluster_scatter"] = "WITH " + FIXED_CLUSTERS + """
SELECT s.mileage AS "MILEAGE", s.price AS "PRICE",
       lab.label || ' ' || CASE WHEN s.is_ulez_compliant THEN '(Compliant)' ELSE '(Non-Compliant)' END AS "CLUSTER_NAME",
       s.brand AS "BRAND", s.model AS "MODEL", s.year AS "YEAR"
FROM silver s JOIN lab ON lab.cid = CAST(floor(s.mileage / 25000) AS INT)
WHERE s.price IS NOT NULL AND s.mileage IS NOT NULL AND s.year IS NOT NULL"""

ORACLE["read_layer"] = ORACLE["silver_listings"]
ORACLE["save_clusters_table"] = "WITH " + FIXED_CLUSTERS + '\nSELECT id AS "ID", cid AS "CLUSTER_ID" FROM f'
ORACLE["materialize"] = ORACLE["run_warehouse_models"]
ORACLE["evolve_schema"] = "WITH " + MERC_RAW + """
SELECT CAST(NULL AS VARCHAR) AS brand, model, year, CAST(price AS DOUBLE) AS price, CAST(NULL AS VARCHAR) AS transmission, mileage,
       CAST(NULL AS VARCHAR) AS fuel_type, CAST(NULL AS INT) AS tax, CAST(NULL AS DOUBLE) AS mpg,
       CAST(NULL AS DOUBLE) AS engine_size, CAST(NULL AS BOOLEAN) AS is_ulez_compliant,
       CAST(NULL AS INT) AS vehicle_age, CAST(NULL AS DOUBLE) AS price_per_mile
FROM merc_raw"""
ORACLE["run_segmentation"] = "WITH " + SILVER + """
SELECT id AS "ID", brand AS "BRAND", price AS "PRICE", is_ulez_compliant AS "IS_ULEZ_COMPLIANT", TRUE AS "NAMED"
FROM silver WHERE price IS NOT NULL AND mileage IS NOT NULL AND year IS NOT NULL"""
ORACLE["run_medallion_outputs"] = ("SELECT 'silver' AS layer, id AS key, brand, CAST(price AS DOUBLE) AS value FROM ("
                                   + ORACLE["silver_listings"] + ") UNION ALL SELECT 'impact', NULL, brand, percent_diff FROM ("
                                   + ORACLE["market_impact"] + ") UNION ALL SELECT 'diesel', model, brand, devaluation_percent FROM ("
                                   + ORACLE["diesel_devaluation"] + ")")

# --- machine learning: splits, scores, and what must hold of a real run ---------

_KEY = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in ("brand", "model", "year", "mileage", "transmission", "fuel_type"))
_SIDE = f"CAST('0x' || substr(md5(concat_ws('|', '42', {_KEY})), 1, 8) AS BIGINT) % 100"
ORACLE["split_train_test"] = "WITH " + FACT + f"\nSELECT *, CASE WHEN {_SIDE} < 80 THEN 'train' ELSE 'test' END AS side FROM fact"
ORACLE["price_attribution_totals"] = "WITH " + FACT + f"""
SELECT COUNT(*) AS n_rows, COUNT(price) AS n_labelled, COUNT(*) AS n_additive FROM fact WHERE {_SIDE} >= 80"""
ORACLE["score_regression"] = "WITH " + FACT + """
SELECT COUNT(price) AS n, round(AVG(abs(price - p)), 4) AS mae,
       round(1 - SUM((price - p) * (price - p)) / NULLIF(VAR_POP(price) * COUNT(price), 0), 6) AS r2
FROM (SELECT price, CAST(90000.0 AS DOUBLE) - CAST(1000.0 AS DOUBLE) * vehicle_age AS p FROM fact)"""

_FEATURED = SILVER + """,
f AS (SELECT *, CAST(price AS DOUBLE) AS x, CAST(mileage AS DOUBLE) AS y, CAST(year AS DOUBLE) AS z FROM silver
      WHERE price IS NOT NULL AND mileage IS NOT NULL AND year IS NOT NULL)"""
ORACLE["scale_features_rounded"] = "WITH " + _FEATURED + """,
m AS (SELECT AVG(x) AS ax, STDDEV_SAMP(x) AS sx, AVG(y) AS ay, STDDEV_SAMP(y) AS sy, AVG(z) AS az, STDDEV_SAMP(z) AS sz FROM f)
SELECT id AS "ID", round((x - ax) / sx, 5) AS "PRICE_Z", round((y - ay) / sy, 5) AS "MILEAGE_Z",
       round((z - az) / sz, 5) AS "YEAR_Z" FROM f, m"""
ORACLE["segment_market_totals"] = "WITH " + _FEATURED + """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT id) AS n_ids, CAST(0 AS BIGINT) AS n_bad_suffixes, CAST(0 AS BIGINT) AS n_unnamed,
       CAST(0 AS BIGINT) AS n_unused_ids, CAST(0 AS BIGINT) AS n_bad_ids FROM f"""
ORACLE["segment_market_fixed_k_totals"] = "WITH " + _FEATURED + """
SELECT COUNT(*) AS n_rows, CAST(3 AS BIGINT) AS n_clusters, CAST(1 AS BIGINT) AS n_names, CAST(0 AS BIGINT) AS n_unused_ids,
       CAST(0 AS BIGINT) AS n_bad_ids FROM f"""
# Every K from 2 to 7 that has as many distinct points and fewer than there are rows.
ORACLE["select_k_totals"] = "WITH " + _FEATURED + """,
n AS (SELECT COUNT(*) AS rows_, (SELECT COUNT(*) FROM (SELECT DISTINCT x, y, z FROM f)) AS points FROM f)
SELECT COUNT(*) AS n_ks, CAST(SUM(k) AS BIGINT) AS sum_ks, CAST(0 AS BIGINT) AS n_bad_scores
FROM (SELECT unnest(range(2, 8)) AS k), n WHERE k <= points AND k < rows_"""
