"""Golden cases for the text and number expressions (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from tableprep import config as C
from tableprep.functions import text as X


def one(spark, value, expr_fn, schema="s string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr_fn(F.col("s")).alias("r")).first()["r"]


def test_currency(spark):
    assert one(spark, "RM 340 000", X.currency) == 340000.0
    assert one(spark, "RM abc", X.currency) is None


def test_before_unit(spark):
    assert one(spark, "1000 sq.ft.", X.before_unit) == 1000.0
    assert one(spark, "1,000.5 sq.ft.", X.before_unit) == 1000.5
    assert one(spark, "1000 m2", X.before_unit) is None


def test_numeric_guard_refuses_java_suffixes(spark):
    assert one(spark, "1d", X.numeric) is None
    assert one(spark, "1f", X.numeric) is None
    assert one(spark, " 12 ", X.numeric) == 12.0
    assert one(spark, "3e2", X.numeric) == 300.0


def test_digits_and_first_decimal(spark):
    assert one(spark, "1000.5", X.digits) == 10005.0
    assert one(spark, "340000.0", X.digits) == 3400000.0
    assert one(spark, "about -12.5 units", X.first_decimal) == -12.5


def test_rooms_loose_and_strict(spark):
    text = "✅ 2 bedrooms + 2 bathroom"
    assert one(spark, text, lambda c: X.extract_rooms(c, "bed")) == 2.0
    assert one(spark, text, lambda c: X.extract_rooms(c, "bath")) == 2.0
    assert one(spark, "SQFT : 3000\nBEDROOMS : 6", X.extract_bedrooms_strict) is None
    assert one(spark, "4+1 bedroom", X.extract_bedrooms_strict) == 1.0
    assert one(spark, "3 Bed-rooms", X.extract_bedrooms_strict) == 3.0


def test_size_with_source(spark):
    r = one(spark, "Built Up: 9800 sq.ft, Land Area: 6800 sq.ft", X.extract_size_source)
    assert (r["value"], r["is_land"]) == (6800.0, True)
    r = one(spark, "1227.74 sqft unit", X.extract_size_source)
    assert (r["value"], r["is_land"]) == (1227.74, False)
    r = one(spark, "For sale", X.extract_size_source)
    assert r["value"] is None


def test_state_from_address(spark):
    f = lambda c: X.last_segment_match(c, C.VALID_STATES)
    assert one(spark, "Puchong, Selangor, Puchong", f) == "Selangor"
    assert one(spark, "SABAH", f) == "Sabah"
    assert one(spark, "Kampung Melaka", f) is None
    assert one(spark, "Brand#1, Johor Bahru,  Johor ", f) == "Johor"
    assert one(spark, None, f) is None


def test_facility_list(spark):
    assert one(spark, "Parking, Sauna, 10", X.list_count) == 2
    assert one(spark, "Parking, Sauna, 10", X.parse_list) == ["Parking", "Sauna"]
    assert one(spark, "swimming pool", X.parse_list) == ["Swimming Pool"]
    assert one(spark, None, X.list_count) == 0
    assert one(spark, None, X.parse_list) == []


def test_title_case_like_python(spark):
    for s in ["house-bar", "10th floor", "BBQ area", "o'neil"]:
        assert one(spark, s, X.title_case) == s.title()


def test_strip_unicode_whitespace(spark):
    s = " \t value 　"
    assert one(spark, s, X.strip_ws) == s.strip()
