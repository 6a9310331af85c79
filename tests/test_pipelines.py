import datetime as dt
import json


from kerbside.operators import gold, serving
from kerbside.plans import medallion
from kerbside.sinks.layers import write_bronze
from kerbside.sources import fixtures as fx
from kerbside.sources.documents import bronze_batch_name

from conftest import SF

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def _page(ids, fuel_word="Diesel"):
    return [{"data": {"searchResults": {"listings": [
        {"advertId": i, "title": f"Car {i}", "subTitle": f"1.6 {fuel_word}", "badges": [],
         "trackingContext": {"advertContext": {"make": "VW", "model": "Golf", "year": 2016, "price": "£9,995"}}}
        for i in ids]}}}]


def test_ingest_then_medallion_end_to_end(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "p1.json").write_text(json.dumps(_page(["a", "b"])))
    (pages / "p2.json").write_text(json.dumps(_page(["b", "c"])))
    bronze = str(tmp_path / "bronze")
    assert medallion.ingest_documents(spark, str(pages), "Volkswagen", "Diesel", bronze, at=T0)
    later = tmp_path / "later"
    later.mkdir()
    (later / "p1.json").write_text(json.dumps(_page(["a"])))
    assert medallion.ingest_documents(spark, str(later), "Volkswagen", "Diesel", bronze,
                                      at=T0 + dt.timedelta(days=1))
    out = medallion.run_medallion(spark, bronze, str(tmp_path / "lake"))
    rows = {r.id: r for r in out.silver.collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].brand == "Volkswagen" and float(rows["a"].price) == 9995.0
    assert rows["a"].fuel_type == "diesel" and rows["a"].is_ulez_compliant is True
    assert out.market_impact.count() == 1
    assert bronze_batch_name("Mercedes-Benz", "Diesel", T0) == "mercedes_benz_diesel_20240301_120000"


def test_empty_batch_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "id string, ingestion_timestamp timestamp")
    assert write_bronze(empty, str(tmp_path / "b")) is False
    assert not (tmp_path / "b").exists()


def test_segmentation_pipeline_reads_and_writes_layers(spark, tmp_path):
    silver = fx.listings_raw(spark, SF)
    from kerbside.operators.silver import build_silver
    s_path = str(tmp_path / "silver")
    build_silver(silver, tie_breakers=fx.LISTING_TIE_BREAKERS).write.parquet(s_path)
    out = medallion.run_segmentation(spark, s_path, str(tmp_path / "clusters"), restarts=2)
    assert out is not None and out.count() == spark.read.parquet(s_path).count()
    assert {"CLUSTER_ID", "CLUSTER_NAME", "PRICE"} <= set(out.columns)
    assert medallion.run_segmentation(spark, str(tmp_path / "missing"), str(tmp_path / "x")) is None


def test_serving_tables(spark):
    impact = spark.createDataFrame([("A", 100.0, 90.0, -10.0), ("B", None, 50.0, None), ("C", 10.0, 12.0, 20.0)],
                                   "brand string, avg_price_compliant double, avg_price_non_compliant double, "
                                   "percent_diff double")
    long = sorted(tuple(r) for r in gold.price_gap_long(impact).collect())
    assert ("B", "Compliant Price", None) in long and len(long) == 6
    assert [r.brand for r in serving.impact_ranking(impact).collect()] == ["A", "C", "B"]
    silver = spark.createDataFrame([("1",), ("2",)], "id string")
    head = serving.headline_metrics(silver, impact).first()
    assert head.listings_processed == 2 and head.avg_impact == 5.0


def test_incremental_silver_reads_only_new_partitions(spark, tmp_path):
    from kerbside.sources.bronze import read_bronze_union
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "p1.json").write_text(json.dumps(_page(["a", "b", "c"])))
    bronze = str(tmp_path / "bronze")
    medallion.ingest_documents(spark, str(pages), "Audi", "Petrol", bronze, at=T0)
    lake = str(tmp_path / "lake1")
    medallion.refresh_silver(spark, read_bronze_union(spark, bronze), f"{lake}/state", f"{lake}/silver", stamp=False)
    later = tmp_path / "later"
    later.mkdir()
    (later / "p1.json").write_text(json.dumps(_page(["b", "d"], "Petrol")))
    medallion.ingest_documents(spark, str(later), "Audi", "Diesel", bronze, at=T0 + dt.timedelta(days=2))
    new = read_bronze_union(spark, bronze, since=(T0 + dt.timedelta(days=1)).strftime("%Y-%m-%d"))
    assert new.count() == 2
    inc = medallion.refresh_silver(spark, new, f"{lake}/state", f"{lake}/silver", stamp=False)
    full = medallion.run_medallion(spark, bronze, str(tmp_path / "lake2")).silver.drop("processed_at")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(inc) == key(full)
    assert {r.id: r.fuel_type for r in inc.collect()}["b"] == "diesel"
