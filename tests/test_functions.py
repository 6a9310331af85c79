import pytest
from pyspark.sql import functions as F

from kerbside.functions.compliance import compliance_flag, normalize_fuel, price_per_mile
from kerbside.functions.listing import brand_from_title
from kerbside.functions.prices import parse_price

PRICES = ["£15,000", "POA", None, "12.5", ""]


def _col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_price_modes(spark):
    assert _col(spark, PRICES, parse_price(F.col("v"), "zero")) == [15000.0, 0.0, 0.0, 12.5, 0.0]
    assert _col(spark, PRICES, parse_price(F.col("v"), "null")) == [15000, None, None, 13, None]
    assert _col(spark, ["15,000", "12.5"], parse_price(F.col("v"), "fail")) == [15000.0, 12.5]
    with pytest.raises(Exception):
        _col(spark, ["£15,000"], parse_price(F.col("v"), "fail"))


def test_brand_from_title(spark):
    assert _col(spark, ["BMW 3 Series", "BMW", None], brand_from_title(F.col("v"))) == ["BMW", "", None]


def test_compliance_rules(spark):
    rows = [(" Petrol ", 2006), ("petrol", 2005), ("Diesel", 2015), ("diesel", 2014), ("Hybrid", 2000),
            ("Electric", None), ("Other", 1990), (None, 2020)]
    df = spark.createDataFrame(rows, "fuel string, year int")
    strict = [r[0] for r in df.select(compliance_flag(normalize_fuel("fuel"), F.col("year"), "strict")).collect()]
    lenient = [r[0] for r in df.select(compliance_flag("fuel", "year", "lenient")).collect()]
    assert strict == [True, False, True, False, False, False, False, False]
    assert lenient == [False, False, True, False, True, True, True, False]


def test_price_per_mile_policies(spark):
    df = spark.createDataFrame([(100.0, 0), (100.0, None), (100.0, 50)], "p double, m int")
    assert [r[0] for r in df.select(price_per_mile("p", "m", "null")).collect()] == [None, None, 2.0]
    assert [r[0] for r in df.select(price_per_mile("p", "m", "zero")).collect()] == [0.0, 0.0, 2.0]


def test_fail_mode_raises_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            _col(spark, ["£15,000"], parse_price(F.col("v"), "fail"))
        assert _col(spark, ["1,250", None], parse_price(F.col("v"), "fail")) == [1250.0, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_numbers_with_suffixes_are_not_prices(spark):
    import pytest

    from kerbside.functions.prices import parse_price

    rows = [("12d",), ("7f",), ("0x10",), ("1e3",), (" 5 ",), (".5",), ("5.",), ("-3",), ("1,250.75",), ("NaN",), ("",), (None,)]
    df = spark.createDataFrame(rows, "p string")
    got = {r.p: r.z for r in df.select("p", parse_price("p", "zero").alias("z")).collect()}
    assert got == {"12d": 0, "7f": 0, "0x10": 0, "1e3": 1000, " 5 ": 5, ".5": 0.5, "5.": 5, "-3": -3, "1,250.75": 1250.75, "NaN": 0, "": 0, None: 0}
    for bad in ("12d", "7f", "x"):
        with pytest.raises(Exception, match="not a number"):
            spark.createDataFrame([(bad,)], "p string").select(parse_price("p", "fail")).collect()
