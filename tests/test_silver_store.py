"""Silver as base and delta: equal to a full refresh after every batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators.silver import build_silver
from kerbside.plans import silver_store
from kerbside.sinks.layers import write_bronze

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id string, price double, ingestion_timestamp timestamp, tie int"


def bronze(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'b' brand", "'m' model", "2020 year", "1 mileage", "'Petrol' fuelType", "1.0 engineSize", "'Manual' transmission")


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "price", "year", "is_ulez_compliant").collect()), key=str)


def batches(n, size):
    """Ids repeat within and between batches, one is hot, some are NULL, and
    half of the rows of a batch are older than what came before."""
    rnd = random.Random(n)
    for k in range(n):
        yield [(rnd.choice(["hot", None, *(f"id{rnd.randrange(40 * (k + 1))}" for _ in range(6))]), float(rnd.randrange(9000)),
                T0 + dt.timedelta(hours=rnd.randrange(100) if rnd.random() < 0.5 else 100 * k), k * size + i) for i in range(size)]


@pytest.mark.parametrize("compact_rows", [1000, 60])
def test_equals_a_full_refresh_after_every_batch(spark, scratch, compact_rows):
    root, seen, bases = f"{scratch}/store", [], []
    for batch in batches(5, 120):
        seen += batch
        now = silver_store.refresh_store(spark, bronze(spark, batch), root, tie_breakers=["tie"], stamp=False, compact_rows=compact_rows)
        bases.append(now.base)
        assert now.n_delta <= compact_rows
        want = build_silver(bronze(spark, seen), tie_breakers=["tie"], stamp=False)
        assert rows_of(silver_store.read_store(spark, root)) == rows_of(want)
    assert len(set(bases)) == 1 if compact_rows == 1000 else 1 < len(set(bases))  # rewritten only where the delta outgrew its bound
    assert silver_store.drop_old_versions(spark, root) and not silver_store.drop_old_versions(spark, root)
    assert rows_of(silver_store.read_store(spark, root)) == rows_of(want)


def test_readers_and_refreshes_do_not_shuffle_the_base(spark, scratch):
    root = f"{scratch}/store"
    for batch in batches(2, 100):
        silver_store.refresh_store(spark, bronze(spark, batch), root, tie_breakers=["tie"], stamp=False)
    plan = silver_store.read_store(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_a_failed_refresh_leaves_the_old_state(spark, scratch):
    root = f"{scratch}/store"
    one, two = batches(2, 50)
    silver_store.refresh_store(spark, bronze(spark, one), root, tie_breakers=["tie"], stamp=False)
    before, version = rows_of(silver_store.read_store(spark, root)), silver_store.manifest(spark, root).version
    bad = bronze(spark, [*two, ("huge", 1e12, T0, 1)])  # the price does not fit its column
    with pytest.raises(Exception):
        silver_store.refresh_store(spark, bad, root, tie_breakers=["tie"], stamp=False)
    assert rows_of(silver_store.read_store(spark, root)) == before and silver_store.manifest(spark, root).version == version


def test_empty_batches_and_no_store(spark, scratch):
    with pytest.raises(FileNotFoundError):
        silver_store.read_store(spark, f"{scratch}/none")
    root = f"{scratch}/store"
    silver_store.refresh_store(spark, bronze(spark, []), root, tie_breakers=["tie"])
    assert silver_store.read_store(spark, root).count() == 0
    silver_store.refresh_store(spark, bronze(spark, [("a", 1.0, T0, 0), (None, 2.0, None, 0)]), root, tie_breakers=["tie"])
    silver_store.refresh_store(spark, bronze(spark, []), root, tie_breakers=["tie"])
    assert {r.id for r in silver_store.read_store(spark, root).collect()} == {"a", None}


def test_bronze_days_are_few_files(spark, scratch):
    rows = [(f"id{i}", 1.0, T0 + dt.timedelta(days=i % 7), i) for i in range(7000)]
    df = bronze(spark, rows).repartition(8)
    assert write_bronze(df, f"{scratch}/bronze")
    back = spark.read.parquet(f"{scratch}/bronze")
    assert back.count() == 7000 and len(back.inputFiles()) == 7
    assert back.groupBy("ingest_date").count().where(F.col("count") != 1000).count() == 0
