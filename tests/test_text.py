"""Tokenizer, cleaning and id rules on the hand-made inputs of FIXTURES.md §2."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheen.functions import parse as P
from sheen.functions import text as T
from sheen.functions.constants import INGREDIENT_DELIMITERS, PRODUCT_LINK_MARKER


def tokens_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    rows = df.select("i", T.ingredient_tokens(F.col("x")).alias("t")).collect()
    return {r["i"]: list(r["t"]) for r in rows}


def reference_tokens(text):
    """The rules stated in plain Python (Python's own Unicode \\s and strip)."""
    if text is None:
        text = "nan"
    parts = re.split("|".join(INGREDIENT_DELIMITERS), text.lower())
    toks = [p.lower().strip() for p in parts]
    toks = [t for t in toks if t]
    toks = ["water" if ("water" in t and "water-binding" not in t) else t for t in toks]
    toks = ["oil" if (" oil" in t and "mineral oil" not in t) else t for t in toks]
    toks = ["extract" if " extract" in t else t for t in toks]
    return [t for t in toks if len(t) > 3]


CASES = {
    "Candelilla Wax": ["elilla wax"],
    "Jojoba Oil, Mineral Oil": ["mineral oil"],
    "Water-Binding Agent": ["water", "binding agent"],
    "water extract oil": ["water"],
    "Green Tea Extract": ["extract"],
    "nan": [],
    "": [],
    "a--b [] c": [],
    "Step 1 others Zinc Oxide": ["zinc oxide"],
}


def test_hand_made_tokens(spark):
    texts = list(CASES) + [None]
    got = tokens_of(spark, texts)
    for i, t in enumerate(texts):
        expected = CASES.get(t, [])
        assert got[i] == expected, (t, got[i])
        assert got[i] == reference_tokens(t)


ALPHABET = list("abcdeilnorstw -_.,:;/*[]\t\n  ") + ["and", "water", " oil", " extract",
                                                               "other", "step 1", "â\u0080¢"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join), min_size=40,
                max_size=40))
def test_tokenizer_matches_plain_python(spark, texts):
    got = tokens_of(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == reference_tokens(t), repr(t)


def test_cleaning_rules(spark):
    df = spark.createDataFrame([("l-5-0", "on 1/7/2019 5:03", "01/07/2019", "1,399",
                                 "85% would repurchase", "Package Quality: 4.1", "Price: $$$",
                                 "Age: 19-24\tSkin: Dry, Fair, Cool\tHair: Red, Wavy, Fine\tEyes: Blue")],
                               "l string, d1 string, d2 string, n string, r string, q string, p string, c string")
    r = df.select(P.clean_lipies(F.col("l")).alias("l"), P.parse_dates(F.col("d1")).alias("d1"),
                  P.parse_dates(F.col("d2")).alias("d2"), P.review_page_count(F.col("n")).alias("n"),
                  P.clean_repurchases(F.col("r")).alias("r"), P.clean_pkg_quals(F.col("q")).alias("q"),
                  P.clean_prices(F.col("p")).alias("p"), P.split_traits(F.col("c")).alias("c")).first()
    assert r["l"] == 5
    assert r["d1"] == r["d2"] == dt.date(2019, 1, 7)
    assert r["n"] == 140
    assert abs(r["r"] - 0.85) < 1e-12 and r["q"] == 4.1 and r["p"] == 3
    assert list(r["c"]) == ["19-24", "Dry, Fair, Cool", "Red, Wavy, Fine", "Blue"]


def test_extract_id(spark):
    df = spark.createDataFrame([(PRODUCT_LINK_MARKER + "66238/page=1",), (PRODUCT_LINK_MARKER + "66238",),
                                ("/other/thing",)], "x string")
    got = [r[0] for r in df.select(P.extract_id(F.col("x"), PRODUCT_LINK_MARKER)).collect()]
    assert got == ["66238", "", ""]


def test_unicode_strip(spark):
    df = spark.createDataFrame([(" \t a b  \n",)], "x string")
    assert df.select(T.ustrip(F.col("x"))).first()[0] == "a b"
