from kerbside.operators.governance import governed_view

ROWS = [("BMW", "X5", 10.0), ("AUDI", "A4", 20.0), ("FORD", "Ka", 30.0), ("bmw", "i3", 40.0)]


def _mart(spark):
    return spark.createDataFrame(ROWS, "brand string, model string, avg_price_compliant double")


def _view(spark, role):
    return sorted(tuple(r) for r in governed_view(_mart(spark), role, price_cols=("avg_price_compliant",)).collect())


def test_admin_sees_everything(spark):
    assert _view(spark, "ULEZ_ADMIN") == sorted(ROWS)
    assert _view(spark, "SYSADMIN") == sorted(ROWS)


def test_developer_sees_two_brands_masked_price(spark):
    assert _view(spark, "ULEZ_DEVELOPER") == [("AUDI", "A4", -999.99), ("BMW", "X5", -999.99)]


def test_auditor_and_unknown_see_nothing(spark):
    assert _view(spark, "ULEZ_AUDITOR") == []
    assert _view(spark, "PUBLIC") == []
