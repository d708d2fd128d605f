import datetime
import difflib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harvestry.functions import geo, prices, terms, text
from harvestry.functions.trigram import similarity


def values(spark, column, rows, ddl):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (text.normalize_name, {" Hill&Dale ": "hill and dale", "St. Mary, East": "st mary east", "a\t\nb": "a b", "...": "", None: "", "Ä (ö)": "ä (ö)", "x & y & z": "x and y and z"}),
        (text.normalize_kind, {"Grade\tA": "grade a", " \n ": "other", None: "other", "OTHER": "other", "b-2 ": "b-2"}),
        (text.market_key, {"Riverton Market": "riverton", "(Riverton) Grain": "riverton", "Marketing": "marketing", "APMC": "", "F & V Lakeside": "lakeside"}),
        (text.core_name, {"New Riverton Cooperative Society (old town)": "riverton", "East Taluka Riverton-2": "east riverton 2", "The Board": "the"}),
        (text.place_name, {"Lakeside Sub Yard": "Lakeside", "Lakeside Mandi Market": "Lakeside", "Lakeside (x) (y)": "Lakeside", "MARKET": ""}),
        (text.display_name, {"lake-side (east) 2nd": "Lake-Side (East) 2nd", "ÜBER x": "Über X", "": ""}),
        (text.state_tag, {"[state=A b] x [state=C]": "A b", "[state=]": None, " [state=A]": None}),
        (text.slug, {"--A  &  b--": "a-b", "Ünder 2": "nder-2"}),
        (text.normalize_unit, {None: "", " Box ": "box"}),
    ],
)
def test_text(spark, f, cases):
    assert dict(zip(cases, values(spark, f("x"), [(k,) for k in cases], "x string"))) == cases


def test_name_scores(spark):
    rows = [("Katol", "Agriculture Produce Market Committee Katol"), ("Sahnewal APMC Mandi Board", "Punjab Mandi Board Ludhiana"), ("Mandi", "x")]
    got = values(spark, text.name_match("a", "b"), rows, "a string, b string")
    assert got[0] == 1.0 and got[1] == pytest.approx(difflib.SequenceMatcher(None, "sahnewal", "punjab ludhiana").ratio()) and got[2] == 0.0
    assert values(spark, text.name_match_or_shared("a", "b"), [("north katol", "katol town")], "a string, b string") == [1.0]


def test_trigrams(spark):
    got = values(spark, similarity(F.col("a"), F.col("b")), [("word", "two words"), ("i.r. 64", "i.r.-64"), ("", "")], "a string, b string")
    assert [round(x, 6) for x in got] == [0.363636, 1.0, 0.0]


def test_price_parsing(spark):
    assert values(spark, prices.tolerant_double(F.col("x")), [("2500",), ("NR",), ("nan",), (None,)], "x string") == [2500.0, None, None, None]
    got = values(spark, prices.day_first_date(F.col("x")), [("15/07/2026",), ("2026-07-15",), ("31/02/2026",)], "x string")
    assert got == [datetime.date(2026, 7, 15), None, None]
    assert values(spark, prices.per_kilo(F.lit(2500.0), F.col("x")), [(10,), (234,)], "x long") == [25.0, 2500.0]
    assert values(spark, prices.source_rank(F.col("x")), [("manual",), ("resource_1",), ("other",), (None,)], "x string") == [3, 1, 0, 0]
    assert values(spark, prices.percent_change(F.col("x"), F.lit(0.0)), [(1.0,)], "x double") == [None]


def test_quality(spark):
    q = lambda *a: prices.quality(*map(F.lit, a))["score"]
    rows = [(1,)]
    assert values(spark, q("resource_2", 25.0, 20.0, 30.0, "faq", False, False), rows, "x int") == [0.975]
    assert values(spark, q("resource_2", 25.0, 20.0, 30.0, "faq", True, False), rows, "x int") == [0.85]
    assert values(spark, q("resource_1", 35.0, 20.0, 30.0, "", False, False), rows, "x int") == [0.6875]
    assert values(spark, q("zz", None, 20.0, 30.0, None, True, True), rows, "x int") == [0.125]


def test_content_hash_depends_on_prices_only(spark):
    h = lambda *a: prices.content_hash(*(F.lit(x).cast("double") for x in a))
    a, b, c, d = values(spark, F.array(h(900, 800, 1000), h(900.0, 800, 1000), h(901, 800, 1000), h(None, 800, 1000)), [(1,)], "x int")[0]
    assert a == b != c and d not in (a, c)


def test_locations(spark):
    km = geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    assert values(spark, km, [(1,)], "x int")[0] == pytest.approx(111.195, abs=1e-3)
    assert values(spark, geo.confidence(F.col("s"), F.col("a")), [(90.0, False), (70.0, False), (50.0, True), (50.0, False), (1.0, False), (0.0, True)], "s double, a boolean") == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "REVIEW", "UNRESOLVED"]
    reason = geo.reject_reason(F.col("n"), F.split("t", ","), F.lit("Doraha APMC"), F.col("d"))
    rows = [("Doraha", "locality,political", 1.0), ("Mandi Board Ludhiana", "government_office", 1.0), ("Doraha Board", "government_office", 1.0), ("Doraha", "market", 61.0)]
    assert values(spark, reason, rows, "n string, t string, d double") == ["admin_only_type", "institutional_office_mismatch", None, "distance_out_of_bound"]


def test_search_terms(spark):
    assert values(spark, terms.places_queries(F.col("n"), F.lit("Thrissur"), F.lit("kerala ")), [("Amballur",)], "n string") == [["Amballur VFPCK, Thrissur, kerala , India", "Amballur farmers market, Thrissur, kerala , India"]]
    assert values(spark, F.size(terms.terms_for(F.col("s"))), [("Goa",), (None,), ("Gujarat",)], "s string") == [6, 6, 3]
    assert values(spark, F.get(terms.terms_for(F.lit("Keralam"), respell=True), 0), [(1,)], "x int") == ["VFPCK"]
    assert values(spark, F.size(terms.osm_queries(F.col("n"), F.lit("D"), F.lit("Bihar"))), [("Amballur Market",), ("Amballur",)], "n string") == [6, 4]


@given(st.lists(st.tuples(st.text("ab c.", max_size=8), st.text("ab c.", max_size=8)), min_size=1, max_size=20))
@settings(max_examples=10, deadline=None)
def test_similarity_is_symmetric(spark, pairs):
    got = spark.createDataFrame(pairs, "a string, b string").select(similarity(F.col("a"), F.col("b")).alias("x"), similarity(F.col("b"), F.col("a")).alias("y")).collect()
    assert all(r.x == r.y and 0 <= r.x <= 1 for r in got)
