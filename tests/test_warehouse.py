
from kerbside.operators import warehouse as wh
from kerbside.plans.warehouse_models import run_warehouse_models
from kerbside.schemas import API_RAW, WAREHOUSE_FACT
from kerbside.sources.warehouse import brand_sources_union


def _raw(spark, rows):
    return spark.createDataFrame(rows, "id string, brand string, title string, price string, year int, "
                                       "mileage int, fuelType string, engineSize double, transmission string")


def test_backfill_keeps_unmatched_and_null_titles(spark):
    raw = _raw(spark, [("1", "B", "X5", "100", 2016, 10, "Diesel", 2.0, "Auto"),
                       ("2", "B", "i3", "£1,000", 2020, 0, "Electric", 0.0, "Auto"),
                       ("3", "B", None, "POA", 2001, 5, "Petrol", 1.0, "Manual"),
                       ("4", "A", "i3", "7", 2020, 1, "Other", 1.0, "Manual")])
    fact = spark.createDataFrame([("X5",), ("X5",), (None,)], "model string")
    out = {r.model: r for r in wh.backfill_missing(raw, fact).collect() if r.model != "i3"}
    assert set(out) == {None}
    got = wh.backfill_missing(raw, fact)
    assert got.count() == 3 and got.columns == WAREHOUSE_FACT.fieldNames()


def test_evolve_schema_adds_columns_and_defaults_stamp(spark):
    df = spark.createDataFrame([("1", "T", "£5")], "id string, title string, price string")
    out = wh.evolve_schema(df, API_RAW, stamp_col="search_timestamp").collect()[0]
    assert out.brand is None and out.search_timestamp is not None and out.price == "£5"


def test_warehouse_models_materialize_view_and_tables(spark, tmp_path):
    raw = _raw(spark, [("1", "B", "BMW X5", "12,000", 2016, 100, "Diesel", 2.0, "Auto"),
                       ("2", "B", "Audi", "8,000", 2010, 0, "Diesel", 2.0, "Manual")])
    out = run_warehouse_models(raw, location=str(tmp_path))
    fct = {r.model: r for r in out["fct_cars"].collect()}
    assert fct["BMW X5"].brand == "BMW" and fct["Audi"].brand == ""
    assert fct["BMW X5"].price_per_mile == 120.0 and fct["Audi"].price_per_mile == 0.0
    assert fct["BMW X5"].vehicle_age == 9 and fct["Audi"].is_ulez_compliant is False
    assert spark.table("mart_ulez_impact").count() == 2
    assert (tmp_path / "fct_cars").exists() and not (tmp_path / "stg_cars").exists()


def test_brand_sources_from_mapping(spark):
    a = spark.createDataFrame([("m1", 2010)], "model string, year int")
    b = spark.createDataFrame([("m2", 2011)], "model string, year int")
    out = brand_sources_union(spark, {"audi": a, "bmw": b}, schema=None)
    assert sorted((r.model, r.brand) for r in out.collect()) == [("m1", "audi"), ("m2", "bmw")]


def test_csv_columns_are_taken_by_header(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T

    from kerbside.sources.warehouse import brand_sources_union

    schema = T.StructType([T.StructField("model", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("price", T.DoubleType())])
    for brand, text in (("audi", "model,year,price\nA3,2010,1.5\n"), ("kia", "year,extra,model,price\n2012,x,Rio,2.5\n"), ("vw", "model\nGolf\n")):
        (tmp_path / brand).mkdir()
        (tmp_path / brand / "a.csv").write_text(text)
    got = brand_sources_union(spark, {b: str(tmp_path / b) for b in ("audi", "kia", "vw")}, schema).collect()
    assert sorted(tuple(r) for r in got if r.brand != "vw") == [("A3", 2010, 1.5, "audi"), ("Rio", 2012, 2.5, "kia")]
    assert [tuple(r) for r in got if r.brand == "vw"] == [("Golf", None, None, "vw")]
    (tmp_path / "audi" / "b.csv").write_text("year,model,price\n2010,A4,3.5\n")
    with pytest.raises(Exception, match="CSV header"):
        brand_sources_union(spark, {"audi": str(tmp_path / "audi")}, schema).collect()
