"""Null semantics and ordered rule tables on tiny literal frames."""

import pytest
from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.functions import rules as R
from sparkprep.functions import text as X


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"c {dtype}").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,label", [
    ("Lives in the MIDWEST", "Midwest US"),
    ("moved to the west coast", "West US"),
    ("Southwest Texas", "Southwest US"),       # southwest wins over west
    ("from Canada", "International"),
    ("nowhere special", "Other"),
    (None, "Other"),
])
def test_region_order_and_null(spark, text, label):
    assert one(spark, R.region(F.col("c")), text) == label


@pytest.mark.parametrize("text,label", [
    ("Washington County, OR", "Washington DC"),   # earlier washington rule wins
    ("Montgomery County, MD", "Maryland"),
    ("montgomery county, pa", "Other"),
    ("City of Chicago", "Illinois"),
    (None, "Other"),
])
def test_jurisdiction(spark, text, label):
    assert one(spark, R.jurisdiction_state(F.col("c")), text) == label


def test_keyword_first_match_and_trailing_blank(spark):
    kw = R.keyword_category(F.col("c"), fv.TRANSIT_KEYWORDS)
    assert one(spark, kw, "Take the BUS to downtown") == "bus "
    assert one(spark, kw, "bus") == "other" or one(spark, kw, "bus") == "other"
    assert one(spark, kw, "a short walk to the train") == "walk"
    assert one(spark, kw, None) == "other"
    ov = R.keyword_category(F.col("c"), fv.OVERVIEW_KEYWORDS)
    assert one(spark, ov, "walking distance") == "walk"     # walking unreachable behind walk


def test_host_mentions_substring_semantics(spark):
    hm = R.host_mentions(F.col("c"))
    assert one(spark, hm, "Atlanta native") == "Travel and Locations"   # "la" substring
    assert one(spark, hm, "cozy") == "Home and Living"
    assert one(spark, hm, "zzz") == "Other"


def test_license_status(spark):
    ls = R.license_status(F.col("c"))
    assert one(spark, ls, None) == "No"
    assert one(spark, ls, "City Registration Pending") == "Pending"
    assert one(spark, ls, "12345") == "Yes"


def test_null_modes_of_pattern_tests(spark):
    assert one(spark, X.has(F.col("c"), "abc"), None) is False
    assert one(spark, X.detect(F.col("c"), "abc"), None) is None


def test_property_policy_bed_extra(spark):
    pc = R.property_category(F.col("c"))
    assert one(spark, pc, "Loft") == "apartment"
    assert one(spark, pc, "Hostel") == "hotel"
    assert one(spark, pc, None) == "other"
    assert one(spark, R.merge_policy(F.col("c")), "super_strict_30") == "strict"
    assert one(spark, R.merge_policy(F.col("c")), None) is None
    assert one(spark, R.bed_category(F.col("c")), None) is None
    assert one(spark, R.bed_category(F.col("c")), "Futon") == "other"
    yn = R.yes_no_positive(F.col("c"))
    assert one(spark, yn, None, "double") is None
    assert one(spark, yn, 0.0, "double") == "NO"


@pytest.mark.parametrize("v,label", [(100.0, "ALL"), (98.0, "SOME"), (None, "MISSING"), (120.0, None)])
def test_rate_level(spark, v, label):
    assert one(spark, R.rate_level(F.col("c")), v, "double") == label


@pytest.mark.parametrize("txt,val", [("$1,234.50", 1234.5), ("N/A", None), ("", None),
                                     (None, None), ("98%", 98.0)])
def test_parse_number(spark, txt, val):
    assert one(spark, X.parse_number(F.col("c")), txt) == val


def test_normalize_label(spark):
    assert one(spark, X.normalize_label(F.col("c")), "  San  Diego,\tCA! ") == "san diego ca"
    assert one(spark, X.normalize_label(F.col("c")), None) == "Missing"


def test_has_rules_and_access_flags(spark):
    assert one(spark, R.has_rules(F.col("c")), "No smoking please") == "Yes"
    assert one(spark, R.has_rules(F.col("c")), None) == "No"
    row = spark.createDataFrame([("Free PARKING and full access",), (None,)], "c string") \
        .select(R.access_flags(F.col("c")).alias("f")).select("f.*").collect()
    assert row[0]["parking"] == 1 and row[0]["full_access"] == 1 and row[0]["kitchen_access"] == 0
    assert row[1]["parking"] is None


def test_list_tokens_and_fill(spark):
    from sparkprep.operators.impute import fill_tokens
    df = spark.createDataFrame([("TV, Wifi ,Air-conditioning,",), (None,)], "c string")
    out = df.select(fill_tokens(X.list_tokens(F.col("c")), fv.MISSING_TOKEN).alias("t")).collect()
    assert out[0]["t"] == ["tv", "wifi", "airconditioning", ""]
    assert out[1]["t"] == [fv.MISSING_TOKEN]


def test_has_rules_word_boundary_option(spark):
    txt = "pets are not a problem"
    assert one(spark, R.has_rules(F.col("c")), txt) == "Yes"            # "not" contains "no"
    assert one(spark, R.has_rules(F.col("c"), word_boundary=True), txt) == "No"
    assert one(spark, R.has_rules(F.col("c"), word_boundary=True), "no pets") == "Yes"
