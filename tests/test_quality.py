import datetime as dt
from decimal import Decimal

from kerbside.operators import quality, serving
from kerbside.schemas import AUDIT, MARKET_IMPACT, SILVER

NOW = dt.datetime(2024, 5, 1)


def _silver(spark):
    def row(i, price, fuel="petrol", year=2020, flag=True):
        return (i, "B", "M", year, None if price is None else Decimal(price), 1, fuel, 1.0, "Manual", flag, NOW)
    rows = [row("dup", "10"), row("dup", "11"), row("dup", "12"), row("a", "0"), row("b", "-1"), row("c", None),
            row("d", "5", "diesel", 2010, True), row("e", "7", "diesel", 2010, False)]
    return spark.createDataFrame(rows, SILVER)


def test_checks_count_seeded_errors(spark):
    s = _silver(spark)
    assert quality.check_unique_ids(s).first().error_count == 3
    assert quality.check_positive_price(s).first().error_count == 2
    assert quality.check_compliance_logic(s).first().error_count == 1


def test_run_checks_writes_audit_and_skips_missing_gold(spark):
    s = _silver(spark)
    impact = spark.createDataFrame([("B", 1.0, 2.0, None), ("C", 1.0, 2.0, 100.0)], MARKET_IMPACT)
    ok, audit = quality.run_quality_checks(spark, s, impact)
    got = {r.check_name: (r.layer, r.status, r.error_count) for r in audit.collect()}
    assert not ok
    assert got["Metrics Completeness"] == ("GOLD", "FAIL", 1)
    assert got["Unique IDs"] == ("SILVER", "FAIL", 3)
    ok2, audit2 = quality.run_quality_checks(spark, s, None)
    assert audit2.count() == 3
    ok3, _ = quality.run_quality_checks(spark, None)
    assert ok3 is False


def test_audit_keeps_newest_100_and_trust_score(spark):
    hist = [(NOW + dt.timedelta(minutes=i), "SILVER", f"c{i}", "PASS" if i % 2 else "FAIL", 0) for i in range(103)]
    audit = quality.append_audit(spark.createDataFrame(hist[100:], AUDIT), spark.createDataFrame(hist[:100], AUDIT))
    kept = audit.collect()
    assert len(kept) == 100
    assert {r.check_name for r in kept}.isdisjoint({"c0", "c1", "c2"})
    latest = serving.latest_audit(audit).collect()
    assert [r["Check Name"] for r in latest] == ["c102", "c101", "c100", "c99"]
    assert serving.trust_score(audit).first().trust_score == 50.0


def test_top_listings_and_layer_counts(spark):
    s = _silver(spark)
    top = serving.top_listings(s, n=2).collect()
    assert [r.price for r in top] == [Decimal("12.00"), Decimal("11.00")]
    counts = serving.layer_counts(s).first()
    assert (counts.total_rows, counts.ml_valid_rows) == (8, 7)


def test_audit_history_on_storage(spark, tmp_path):
    path = str(tmp_path / "audit")
    for i in range(26):
        fresh = [(NOW + dt.timedelta(days=i), "SILVER", f"c{k}", "PASS", 3_000_000_000) for k in range(4)]
        kept = quality.record_audit(spark.createDataFrame(fresh, AUDIT), path).collect()
        assert len(kept) == min(100, 4 * (i + 1))
    assert min(r.check_timestamp for r in kept) == NOW + dt.timedelta(days=1) and kept[0].error_count == 3_000_000_000
    assert spark.read.parquet(path).count() == 100
