"""Each operator of the inventory against its SQL, and what SQL cannot show."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kerbside.functions.prices import parse_price
from kerbside.inventory import INVENTORY
from kerbside.inventory_oracle import INVENTORY_ORACLE
from kerbside.queries import QUERIES

from conftest import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_sql_and_a_name_of_its_own():
    assert set(INVENTORY) == set(INVENTORY_ORACLE) and not set(INVENTORY) & set(QUERIES)


# The full fit takes half a minute; tools/check_oracle.py runs it, test_ml.py smaller ones.
@pytest.mark.parametrize("name", sorted(set(INVENTORY) - {"train_price_model"}))
def test_sql(spark, con, name):
    got = INVENTORY[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in got.columns)} FROM ({INVENTORY_ORACLE[name]})").fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert want


def test_every_branch_occurs(spark):
    fuels = {r[0] for r in INVENTORY["infer_fuel"](spark, SF).select("fuel").distinct().collect()}
    assert fuels == {"Petrol", "Diesel", "Hybrid", "Electric", "Unknown"}
    for name, column in (("parse_price_null", "price"), ("price_per_mile_null", "ratio"), ("brand_from_title", "brand"),
                         ("vehicle_age", "age"), ("price_efficiency", "efficiency")):
        df = INVENTORY[name](spark, SF)
        assert 0 < df.where(F.col(column).isNull()).count() < df.count(), name
    for name in ("compliance_flag_strict", "compliance_flag_lenient"):
        assert INVENTORY[name](spark, SF).select("compliant").distinct().count() == 2


def test_a_pound_sign_fails_the_strict_price(spark):
    df = spark.createDataFrame([("£1,000",)], "text string").select(parse_price("text", "fail").alias("price"))
    with pytest.raises(Exception, match="price is not a number"):
        df.collect()
