import json

from pyspark.sql import functions as F

from kerbside.sources.documents import extract_listings, ingest_listings, parse_documents

# Two adverts and one without tracking context, on one page.
MOCK = [{"data": {"searchResults": {"listings": [
    {"advertId": "k-701", "title": "Skoda Octavia Estate", "subTitle": "1.6 TDI SE L 5dr Automatic", "attentionGrabber": None,
     "price": "£8,250", "badges": [{"type": "OWNERS", "displayText": "2 owners"}, {"type": "MILEAGE", "displayText": "73,410 miles"}],
     "trackingContext": {"advertContext": {"make": "Skoda", "model": "Octavia", "year": 2015, "price": "£8,100"}}},
    {"advertId": "k-702", "title": "Kia Picanto", "subTitle": "1.0 Petrol Manual", "attentionGrabber": "One owner, Petrol, low tax",
     "price": "£4,995", "badges": [],
     "trackingContext": {"advertContext": {"make": "Kia", "model": "Picanto", "year": 2012, "price": "4995"}}},
    {"advertId": "k-703", "title": "Advert without context", "badges": []},
]}}}]


def _listings(spark, *docs):
    text = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    return parse_documents(text)


def test_document_gives_a_row_per_tracked_advert(spark):
    rows = {r.id: r for r in extract_listings(_listings(spark, MOCK)).collect()}
    assert set(rows) == {"k-701", "k-702"}
    estate, small = rows["k-701"], rows["k-702"]
    assert (estate.title, estate.brand, estate.model, estate.year) == ("Skoda Octavia Estate", "Skoda", "Octavia", 2015)
    assert (estate.fuelType, estate.transmission, estate.mileage, estate.engineSize) == ("Unknown", "Automatic", 73410, 1.6)
    assert (small.fuelType, small.transmission, small.mileage, small.engineSize) == ("Petrol", "Manual", 0, 1.0)
    assert (estate.price, small.price) == ("£8,100", "4995")  # the context price, as text


def test_ingest_parses_price_and_tags_batch(spark):
    rows = {r.id: r for r in ingest_listings(_listings(spark, MOCK), "Skoda", "Diesel").collect()}
    assert rows["k-701"].price == 8100.0 and rows["k-702"].price == 4995.0
    for row in rows.values():
        assert (row.brand, row.fuelType, row.fuel_type_raw) == ("Skoda", "Diesel", "Diesel") and row.ingestion_timestamp is not None


def test_missing_levels_and_errors_give_no_rows(spark):
    no_ctx = json.loads(json.dumps(MOCK))
    for listing in no_ctx[0]["data"]["searchResults"]["listings"]:
        listing.pop("trackingContext", None)
    assert extract_listings(_listings(spark, no_ctx)).count() == 0
    assert _listings(spark, [{"errors": ["boom"]}]).count() == 0
    assert _listings(spark, {"message": "HTTP 500"}).count() == 0
    assert _listings(spark, [{"data": {"searchResults": {}}}]).count() == 0


def _doc(**listing):
    base = {"advertId": "1", "trackingContext": {"advertContext": {"make": "X"}}}
    base.update(listing)
    return [{"data": {"searchResults": {"listings": [base]}}}]


def _one(spark, fuel_filter=None, **listing):
    return extract_listings(_listings(spark, _doc(**listing)), fuel_filter).collect()[0]


def test_badge_mileage_rules(spark):
    assert _one(spark, badges=[{"type": "MILEAGE"}]).mileage == 0
    assert _one(spark, badges=[{"type": "MILEAGE", "displayText": "50,000 miles"},
                               {"type": "MILEAGE", "displayText": "n/a"}]).mileage == 50000
    assert _one(spark, badges=[{"type": "MILEAGE", "displayText": "10 miles"},
                               {"type": "MILEAGE", "displayText": "20 miles"}]).mileage == 20
    assert _one(spark, badges=[]).mileage == 0
    assert _one(spark, badges=[{"type": "OWNERS", "displayText": "3 owners"}]).mileage == 0


def test_engine_size_fuel_and_transmission(spark):
    assert _one(spark, subTitle="12.5 TDI").engineSize == 2.5
    assert _one(spark, subTitle="V8").engineSize == 0.0
    assert _one(spark).engineSize == 0.0
    assert _one(spark, attentionGrabber="Petrol Hybrid").fuelType == "Petrol"
    assert _one(spark, attentionGrabber="petrol").fuelType == "Unknown"
    assert _one(spark).fuelType == "Unknown"
    assert _one(spark, subTitle="Electric").fuelType == "Electric"
    assert _one(spark, "Diesel", attentionGrabber="Petrol").fuelType == "Diesel"
    assert _one(spark, "", attentionGrabber="Hybrid").fuelType == "Hybrid"
    assert _one(spark, subTitle="Automatic").transmission == "Automatic"
    assert _one(spark, attentionGrabber="Auto gearbox").transmission == "Automatic"
    assert _one(spark, subTitle="manual").transmission == "Manual"


def test_pages_of_a_batch_read_together(spark, tmp_path):
    from kerbside.sources.documents import read_listing_documents
    for i in (1, 2):
        d = json.loads(json.dumps(MOCK))
        del d[0]["data"]["searchResults"]["listings"][1:]
        d[0]["data"]["searchResults"]["listings"][0]["advertId"] = f"p{i}"
        (tmp_path / f"page{i}.json").write_text(json.dumps(d, indent=2))
    (tmp_path / "page3.json").write_text(json.dumps([{"data": {"searchResults": {"listings": []}}}]))
    rows = extract_listings(read_listing_documents(spark, str(tmp_path))).select("id").collect()
    assert sorted(r.id for r in rows) == ["p1", "p2"]


def test_saved_documents_are_small_and_read_back_whole(spark, tmp_path):
    from kerbside.sources import documents

    listing = [{"advertId": str(i), "title": f"Car {i}", "subTitle": "1.6 Diesel", "price": "£0", "badges": [],
                "trackingContext": {"advertContext": {"make": "Audi", "model": "A3", "year": 2012, "price": str(9000 + i)}}} for i in range(700)]
    texts = spark.createDataFrame([(json.dumps([{"data": {"searchResults": {"listings": [x]}}}]),) for x in listing], "value string")
    docs = texts.select(F.from_json("value", documents.DOCUMENT)[0].alias("response")).coalesce(1)
    plain, path = str(tmp_path / "plain"), str(tmp_path / "saved")
    docs.select(F.to_json(F.array("response")).alias("value")).write.text(plain)
    documents.LINES_PER_FILE, was = 100, documents.LINES_PER_FILE
    try:
        documents.save_documents(docs, path)
    finally:
        documents.LINES_PER_FILE = was
    size = lambda p: sum(f.stat().st_size for f in (tmp_path / p).iterdir() if f.name.startswith("part-"))
    assert size("saved") * 3 < size("plain")
    assert len([f for f in (tmp_path / "saved").iterdir() if f.name.startswith("part-")]) == 7
    key = lambda p: sorted(map(tuple, documents.extract_listings(documents.read_listing_documents(spark, p, per_line=True)).collect()), key=str)
    assert key(path) == key(plain) and len(key(path)) == 700


def test_documents_are_built_without_sorting_the_lines(spark, tmp_path):
    from kerbside.sources import fixtures

    lines = [(i, i % 50, i % 9, i % 7 + 1, float(i % 50 + 1), 1000.0 + i, "ANR"[i % 3], "OF"[i % 2], f"199{5 + i % 4}-03-01 00:00:00") for i in range(400)]
    lines.append((400, None, 1, 1, 1.0, 1000.0, "A", "O", "1996-03-01 00:00:00"))
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate string").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(str(tmp_path / "lineitem.parquet"))
    parts = [(i, f"part {i}", "Brand#1", "STEEL") for i in range(40)] + [(3, "again", "Brand#2", "TIN"), (None, "no key", "Brand#2", "TIN")]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    docs = fixtures.listing_documents(spark, str(tmp_path))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("SortAggregate", "")
    assert docs.count() == sum(1 + (p == 3) for _, p, *_ in lines if p is not None and p < 40)
