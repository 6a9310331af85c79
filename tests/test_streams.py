import pyarrow as pa
import pyarrow.parquet as pq

from kerbside.operators.warehouse import merc_feed_rows
from kerbside.sources import fixtures as fx
from kerbside.streaming import feeds

from conftest import SF


def test_stream_equals_batch_and_rerun_adds_nothing(spark, tmp_path):
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    feeds.stream_brand_feed(spark, SF, sink, ckpt, glob="lineitem.parquet", raw=fx.project_merc)
    streamed = spark.read.parquet(sink)
    batch = merc_feed_rows(fx.merc_raw(spark, SF))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    feeds.stream_brand_feed(spark, SF, sink, ckpt, glob="lineitem.parquet", raw=fx.project_merc)
    assert spark.read.parquet(sink).count() == batch.count()


def test_listing_feed_over_raw_table_folder(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    table = pa.table({"id": ["1", "2", "3"], "brand": ["B", "B", "C"], "title": ["t1", "t2", "t3"],
                      "price": ["£12,000", "POA", "900"], "year": pa.array([2010, 2016, 2020], pa.int32()),
                      "mileage": pa.array([0, 100, 10], pa.int32()), "fuelType": ["Diesel", "Diesel", "Petrol"],
                      "engineSize": [1.0, 2.0, 3.0], "transmission": ["Manual"] * 3,
                      "action": ["INSERT", "INSERT", "DELETE"]})
    pq.write_table(table, src / "batch1.parquet")
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    feeds.stream_listing_feed(spark, str(src), sink, ckpt)
    rows = {r.model: r for r in spark.read.parquet(sink).collect()}
    assert set(rows) == {"t1", "t2"}
    assert rows["t1"].price == 12000.0 and rows["t1"].price_per_mile is None
    assert rows["t2"].price is None and rows["t2"].is_ulez_compliant is True
    assert rows["t1"].vehicle_age == 15 and rows["t1"].tax is None


def test_backlog_is_cut_into_batches(spark, tmp_path):
    src, sink, ckpt = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    fx.merc_raw(spark, SF).repartition(4).write.parquet(src)
    query = feeds.stream_brand_feed(spark, src, sink, ckpt, max_files_per_trigger=1)
    assert sum(1 for p in query.recentProgress if p["numInputRows"]) == 4
    assert spark.read.parquet(sink).count() == merc_feed_rows(fx.merc_raw(spark, SF)).count()
