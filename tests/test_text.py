import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkweave.functions import keys, text
from linkweave.functions.similarity import best_score, lcs_length, ratio, score_bound, token_set_ratio
from linkweave.operators import cleaning as C


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "c string").select(expr(F.col("c")).alias("x")).first()[0]


@pytest.mark.parametrize("raw, want", [("côte d'ivoire", "Côte D'Ivoire"), ("u.s.a", "U.S.A"), ("3rd land", "3Rd Land"), ("  india ", "India"), (None, "")])
def test_country(spark, raw, want):
    assert one(spark, raw, C.normalize_country) == want


@pytest.mark.parametrize(
    "raw, norm, core",
    [
        ("Acme Pvt. Ltd.", "acme pvt ltd", "acme"),
        ("AT&T Inc.", "at and t inc", "at and t"),
        ("Foo Private Limited.", "foo pvt ltd", "foo"),
        ("X/Y L.L.C.", "x y llc", "x y"),
        ("Group Co", "group co", "group"),
        ("Company", "co", "co"),
        ("Tata Sons Co., Ltd", "tata sons co, ltd", "tata sons co,"),
        (None, "", ""),
        ("", "", ""),
        ("a" * 20_000 + " Ltd.", "a" * 20_000 + " ltd", "a" * 20_000),
    ],
)
def test_name(spark, raw, norm, core):
    assert one(spark, raw, C.normalize_name) == norm
    assert one(spark, raw, lambda c: C.name_core(C.normalize_name(c))) == core


@pytest.mark.parametrize("raw, want", [("Foo dba Bar", "Bar"), ("x t/a Y, z", "Y"), ("Foo DBA ", None), ("Foo", None), (None, None)])
def test_trade_name(spark, raw, want):
    assert one(spark, raw, C.trade_name) == want


@pytest.mark.parametrize(
    "raw, country, want",
    [
        ("12 main st.", "France", "12 main street."),
        ("st.james rd", "France", "streetjames road"),
        ("h.no. 5 opp. x", "India", "house number. 5 opposite. x"),
        ("joe's", "Us", "joe'south"),
        (None, "Us", ""),
    ],
)
def test_address(spark, raw, country, want):
    assert one(spark, raw, lambda c: C.normalize_address(c, F.lit(country))) == want


@pytest.mark.parametrize("raw, want", [("12 MG Rd, Near City Mall, Pune 411001", "Near City Mall, Pune 411001"), ("opp. bank", None), ("near SBI", None), (None, None)])
def test_landmark(spark, raw, want):
    assert one(spark, raw, C.landmark) == want


def test_address_keys(spark):
    query = lambda s: sorted(one(spark, s, keys.address_keys_query))
    index = lambda s: sorted(one(spark, s, keys.address_keys_index))
    assert query("007 park road pune 411001") == ["7|park", "7|pune", "pin|411001"]
    assert query("main plaza") == [] and index("main plaza") == ["0|main", "0|plaza"]
    assert query("") == [] and index("") == []


def test_anchor(spark):
    assert one(spark, "the global traders", lambda c: keys.name_anchor(c, 5)) == "traders"
    assert one(spark, "acme co", lambda c: keys.name_anchor(c, 5)) is None


def test_casefold_and_strip(spark):
    assert one(spark, " Straße\t", text.clean_scalar) == "strasse"
    assert one(spark, None, text.clean_scalar) == ""


def test_lcs_against_table():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(12))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        assert lcs_length(a, b) == row[-1]


def test_similarities():
    assert round(ratio("kitten", "sitting"), 6) == 61.538462
    assert round(ratio("acme pvt ltd", "acme corp"), 6) == 57.142857
    assert ratio("", "") == 100.0
    assert token_set_ratio("a b", "b a c") == 100.0 and token_set_ratio("", "x") == 0.0
    assert round(token_set_ratio("alpha beta", "alpha gamma"), 6) == round(max(100 - 100 * 7 / 21, 100 - 100 * 5 / 15, 100 - 100 * 6 / 16), 6)
    assert best_score("x", "", "x", "", "") == 100.0


def test_first_match_ignores_blank(spark):
    assert one(spark, "ab  cd", lambda c: text.first_match(c, r"\s+")) is None
    assert re.match("x", "x")


@given(st.lists(st.text(alphabet="abc d", max_size=12), min_size=5, max_size=5), st.sampled_from([1.0, 50.0, 78.0, 100.0]))
def test_bound_changes_no_score_that_counts(t, least):
    full, bounded = best_score(*t), best_score(*t, least)
    assert bounded == full if full >= least else bounded in (0.0, full)


def test_bound_of_texts_that_repeat_letters():
    assert score_bound("a" * 40 + " x", "a" * 40 + " y") == 100.0  # more than a lane holds
    assert score_bound("abc", "abc def") == 100.0 and score_bound("", "") == 100.0 and score_bound("abcd", "efgh") == 0.0
