"""Column expressions that turn the page's source strings into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheen.functions.constants import CATEGORY_IDS, CATEGORY_NAMES
from sheen.functions.text import WS, ustrip

# trait block labels as they appear in a review's characteristics cell
TRAIT_SPLIT_RE = (rf"\bAge:{WS}\b|\bSkin:{WS}\b|\bHair:{WS}\b|\bEyes:{WS}\b|\t")
#: The same matches; most places of a text fail on one look at their character. For Java only: RE2 knows no lookahead.
FAST_TRAIT_RE = rf"(?=[ASHE\t])(?:{TRAIT_SPLIT_RE})"
DATE_RE = r"(\d+/\d+/\d+)"


def clean_ratings(c: Column, safe: bool = False) -> Column:
    """'4.1' -> 4.1 (``safe`` gives null instead of an error on bad input)."""
    return c.try_cast("double") if safe else c.cast("double")


def clean_repurchases(c: Column) -> Column:
    """'85% would repurchase' -> 0.85"""
    return F.replace(c, F.lit("% would repurchase"), F.lit("")).cast("double") / F.lit(100.0)


def clean_pkg_quals(c: Column) -> Column:
    """'Package Quality: 4.1' -> 4.1"""
    return F.replace(c, F.lit("Package Quality: "), F.lit("")).cast("double")


def clean_prices(c: Column) -> Column:
    """'Price: $$$' -> 3 (the number of characters after the label)."""
    return F.length(F.replace(c, F.lit("Price: "), F.lit("")))


def split_traits(c: Column) -> Column:
    """'Age: a<TAB>Skin: ...' -> [a, 'type, tone, undertone', 'color, type, texture', eyes]"""
    # every separator becomes a tab first: Spark keeps the pattern of a replacement, but reads that of a split anew for each row
    return F.filter(F.split(F.regexp_replace(c, FAST_TRAIT_RE, "\t"), "\t", -1), lambda x: x != "")


def clean_lipies(c: Column) -> Column:
    """'l-5-0' -> 5 (third character)."""
    return F.substring(c, 3, 1).cast("int")


def parse_dates(c: Column) -> Column:
    """First m/d/Y in free text -> date."""
    return F.to_date(F.regexp_extract(c, DATE_RE, 1), "M/d/yyyy")


def format_month(d: Column) -> Column:
    return F.date_format(d, "MMM-yyyy")


def split_strip(c: Column, sep: str = ",") -> Column:
    """'a, b, c' -> ['a', 'b', 'c'] (Unicode strip of each part)."""
    return F.transform(F.split(c, sep, -1), ustrip)


def ingredients_to_string(c: Column) -> Column:
    """Missing ingredients become the literal 'nan', as the source's string cast does."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def category_name(c: Column) -> Column:
    pairs = []
    for k, v in zip(CATEGORY_IDS, CATEGORY_NAMES):
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[c]


def extract_id(link: Column, marker: str) -> Column:
    """Text between ``marker`` and the next '/'; '' when no '/' follows or the
    marker is absent."""
    import re
    return F.regexp_extract(link, re.escape(marker) + "([^/]*)/", 1)


def canonical_link(link: Column, marker: str) -> Column:
    """Cut a link after the item id and append '/page=' (ready for a page number)."""
    import re
    return F.concat(F.regexp_extract(link, "^(.*?" + re.escape(marker) + "[^/]*)", 1),
                    F.lit("/page="))


def review_page_count(c: Column, per_page: int = 10) -> Column:
    """'1,399' -> 140 pages of ``per_page`` reviews."""
    digits = F.regexp_replace(c, r"\D", "").cast("bigint")
    return F.ceil(digits / F.lit(float(per_page))).cast("int")
