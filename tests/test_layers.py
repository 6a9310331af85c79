import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kerbside.operators.silver import build_silver, detect_columns, guard_nonempty
from kerbside.schemas import SILVER
from kerbside.sources.bronze import read_bronze_union, read_layer

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _write(path, table, **options):
    pq.write_table(table, path, **({"coerce_timestamps": "us"} | options))


def test_drifting_bronze_files_union_by_name(spark, tmp_path):
    # File a: year BIGINT, model present but entirely null (null-typed).
    a = pa.table({"id": ["1"], "title": ["Audi A3"], "brand": ["Audi"], "model": pa.array([None], pa.null()),
                  "price": [1000.0], "year": pa.array([2010], pa.int64()), "mileage": pa.array([5], pa.int64()),
                  "fuelType": ["Petrol"], "engineSize": [1.4], "transmission": ["Manual"],
                  "ingestion_timestamp": pa.array([T0], pa.timestamp("us"))})
    # File b: year DOUBLE (a missing year), no model column, has title.
    b = pa.table({"id": ["2", "3"], "title": ["VW Golf", None], "brand": ["VW", None], "price": [2000.0, 3000.0],
                  "year": pa.array([2016.0, None], pa.float64()), "mileage": pa.array([7, 9], pa.int64()),
                  "fuelType": ["Diesel", "Diesel"], "engineSize": [2.0, 1.6], "transmission": ["Auto", "Auto"],
                  "ingestion_timestamp": pa.array([T0, T0], pa.timestamp("us"))})
    _write(tmp_path / "a.parquet", a)
    _write(tmp_path / "b.parquet", b)
    bronze = read_bronze_union(spark, str(tmp_path))
    assert dict(bronze.dtypes)["year"] == "int" and dict(bronze.dtypes)["model"] == "string"
    rows = {r.id: r for r in bronze.collect()}
    assert rows["1"].year == 2010 and rows["1"].model is None
    assert rows["2"].year == 2016 and rows["3"].year is None and rows["3"].title is None
    silver = {r.id: r for r in build_silver(bronze).collect()}
    assert silver["1"].model == "Audi A3" and silver["3"].model == "UNKNOWN" and silver["3"].brand == "UNKNOWN"
    assert silver["2"].is_ulez_compliant is True and silver["3"].is_ulez_compliant is False


def test_detect_columns_and_fallbacks(spark):
    df = spark.createDataFrame([("1", "", None)], "id string, brand string, title string")
    assert detect_columns(df) == {"brand": True, "model": False, "title": True}


def test_empty_bronze_and_empty_silver_abort(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_bronze_union(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        guard_nonempty(spark.createDataFrame([], SILVER))


def test_read_layer_missing_path_is_empty(spark, tmp_path):
    df = read_layer(spark, str(tmp_path / "missing"), SILVER)
    assert df.count() == 0 and df.columns == SILVER.fieldNames()


def test_dedup_keeps_newest_and_collapses_null_ids(spark):
    rows = [("1", 100.0, T0, 1), ("1", 200.0, T0 + dt.timedelta(days=1), 1), (None, 5.0, T0, 1),
            (None, 6.0, T0, 2), ("2", 7.0, T0, 1), ("2", 8.0, T0, 2)]
    df = spark.createDataFrame(rows, "id string, price double, ingestion_timestamp timestamp, tie int")
    df = df.selectExpr("*", "'b' brand", "'m' model", "2020 year", "1 mileage", "'Petrol' fuelType",
                       "1.0 engineSize", "'Manual' transmission")
    out = {r.id: r.price for r in build_silver(df, tie_breakers=["tie"]).collect()}
    assert out == {"1": Decimal("200.00"), None: Decimal("6.00"), "2": Decimal("8.00")}


def _batch(ids, at, **columns):
    n = len(ids)
    return pa.table({"id": ids, "title": ["t"] * n, "brand": ["b"] * n, "price": [1.0] * n, "year": pa.array([2010] * n, pa.int64()),
                     "mileage": pa.array([5] * n, pa.int64()), "fuelType": ["Petrol"] * n, "engineSize": [1.4] * n,
                     "transmission": ["Manual"] * n, "ingestion_timestamp": at, **columns})


def test_bronze_in_a_folder_with_blanks_and_signs(spark, tmp_path):
    root = tmp_path / "sp ace %41 é"
    root.mkdir()
    _write(root / "a b.parquet", _batch(["1"], pa.array([T0], pa.timestamp("us"))))
    _write(root / "c%20d.parquet", _batch(["2"], pa.array([T0], pa.timestamp("us")), year=pa.array([2011.0], pa.float64())))
    assert {r.id: r.year for r in read_bronze_union(spark, str(root)).collect()} == {"1": 2010, "2": 2011}


def test_bronze_nanosecond_stamps(spark, tmp_path):
    at = T0 + dt.timedelta(microseconds=123456)
    _write(tmp_path / "ns.parquet", _batch(["1"], pa.array([at], pa.timestamp("ns"))), coerce_timestamps=None, version="2.6")
    _write(tmp_path / "us.parquet", _batch(["2"], pa.array([at], pa.timestamp("us"))))
    got = {r.id: r.ingestion_timestamp for r in read_bronze_union(spark, str(tmp_path)).collect()}
    assert got["1"] == got["2"] == at


def test_undated_bronze_files_are_kept(spark, tmp_path):
    day = dt.timedelta(days=1)
    stamp = lambda t: pa.array([t], pa.timestamp("us"))
    _write(tmp_path / "flat-old.parquet", _batch(["flat-old"], stamp(T0)))
    _write(tmp_path / "flat-new.parquet", _batch(["flat-new"], stamp(T0 + 2 * day)))
    for name, t in (("old", T0), ("new", T0 + 2 * day)):
        folder = tmp_path / f"ingest_date={t:%Y-%m-%d}"
        folder.mkdir()
        _write(folder / "part.parquet", _batch([f"dated-{name}"], stamp(t)))
    every = {"flat-old", "flat-new", "dated-old", "dated-new"}
    assert {r.id for r in read_bronze_union(spark, str(tmp_path)).collect()} == every
    since = read_bronze_union(spark, str(tmp_path), since=f"{T0 + day:%Y-%m-%d}")
    assert {r.id for r in since.collect()} == {"flat-new", "dated-new"}
    assert not any("ingest_date=2024-01-01" in f for f in since.inputFiles())


def test_layer_is_replaced_whole_or_not_at_all(spark, tmp_path):
    from pyspark.sql import functions as F

    from kerbside.sinks.layers import write_layer

    path = str(tmp_path / "lake" / "layer")
    first = write_layer(spark.range(5), path)
    assert sorted(r.id for r in write_layer(first.where("id > 1"), path).collect()) == [2, 3, 4]  # from itself
    broken = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_layer(broken, path)
    assert sorted(r.id for r in read_layer(spark, path, first.schema).collect()) == [2, 3, 4]
    assert [p.name for p in (tmp_path / "lake").iterdir() if "__old" in p.name] == []


def test_late_rows_do_not_replace_newer_ones(spark):
    from kerbside.operators.silver import silver_state
    from kerbside.plans.medallion import incremental_silver

    def bronze(rows):
        df = spark.createDataFrame(rows, "id string, price double, ingestion_timestamp timestamp")
        return df.selectExpr("*", "'b' brand", "'m' model", "2020 year", "1 mileage", "'Petrol' fuelType", "1.0 engineSize", "'Manual' transmission")

    first = [("1", 100.0, T0 + dt.timedelta(days=5)), ("2", 1.0, T0)]
    late = [("1", 50.0, T0), ("2", 2.0, T0 + dt.timedelta(days=1)), ("3", 3.0, T0)]
    state = silver_state(bronze(first), stamp=False)
    got = {r.id: r.price for r in incremental_silver(state, bronze(late)).collect()}
    assert got == {r.id: r.price for r in build_silver(bronze(first + late)).collect()} == {
        "1": Decimal("100.00"), "2": Decimal("2.00"), "3": Decimal("3.00")}


def test_catalog_tables(spark, tmp_path):
    from kerbside.sinks.layers import materialize, save_clusters_table

    for n in (3, 2):
        out = materialize(spark.range(n).withColumnRenamed("id", "v"), "kerbside_test_table", "table", str(tmp_path / f"w{n}"))
        assert out.count() == n and spark.catalog.tableExists("kerbside_test_table")
    assert materialize(spark.range(4), "kerbside_test_view", "view", "").count() == 4
    for n in (5, 6):
        assert save_clusters_table(spark.range(n), "kerbside_test_clusters", str(tmp_path / "clusters")).count() == n
    spark.sql("DROP TABLE kerbside_test_table")
    spark.sql("DROP TABLE kerbside_test_clusters")
