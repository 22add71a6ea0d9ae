"""Stored review pages -> raw review rows (§2.2), as one Spark job over a table
of (page_id, url, html).

Links and guards are built-in regex functions. The fields of a review page come from the
standard library's HTML parser, run once per page on Arrow batches: nested elements, any
quoting, class lists and all entities need a parser.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from sheen.functions.constants import (BRAND_LINK_MARKER, MAX_SEARCH_PAGES, PRODUCT_LINK_MARKER,
                                       REVIEWS_PER_PAGE, SEARCH_PATH_TEMPLATE)
from sheen.functions.markup import page_fields
from sheen.functions.parse import canonical_link, extract_id, review_page_count

TITLE_RE = r"(?is)<title\b"
HREF_RE = r'(?is)<a\b[^>]*?\bhref="([^"]*)"'


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def all_of(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), 1)


# ----------------------------------------------------------------------------- crawl frontier

def frontier_urls(categories: DataFrame, host: str = "https://reviews.example.com",
                  pages_col: str = "n_pages") -> DataFrame:
    """(cat_id, page, url): every search page of every category."""
    base = F.concat(F.lit(host), F.lit(SEARCH_PATH_TEMPLATE.split("{}")[0]), F.col("cat_id"),
                    F.lit(SEARCH_PATH_TEMPLATE.split("{}")[1]))
    return categories.select("cat_id", base.alias("_b"), F.explode(
        F.sequence(F.lit(1), F.col(pages_col))).alias("page")).select(
        "cat_id", "page", F.concat("_b", F.col("page").cast("string")).alias("url"))


def page_links(html: Column, marker: str) -> Column:
    """All anchor hrefs holding ``marker``, in page order."""
    return F.filter(all_of(html, HREF_RE), lambda h: h.contains(marker))


def every_second(arr: Column, start: int = 0) -> Column:
    """``arr[start::2]``"""
    return F.filter(arr, lambda x, i: i % 2 == start)


def expand_review_pages(links: DataFrame, link_col: str = "link", count_col: str = "n_reviews",
                        marker: str = PRODUCT_LINK_MARKER, per_page: int = REVIEWS_PER_PAGE
                        ) -> DataFrame:
    """Each product link times its review pages: (link, page, url)."""
    n = review_page_count(F.col(count_col), per_page)
    return links.select("*", F.explode(F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).alias("page")) \
        .where(n >= 1) \
        .withColumn("url", F.concat(canonical_link(F.col(link_col), marker), F.col("page").cast("string")))


def skip_bad_pages(urls: DataFrame, blocklist: DataFrame, col: str = "url") -> DataFrame:
    return urls.join(blocklist.select(col), col, "left_anti")


def cap_pages(links: Column, prefix: Column, cap: int = MAX_SEARCH_PAGES) -> Column:
    """Number of search pages: the number between ``prefix`` and the next '/' in
    the second-to-last paging link, at most ``cap``; 1 when there is no such
    link or number (a single search page)."""
    last = F.try_element_at(links, F.lit(-2))
    tail = F.substring(last, F.length(prefix) + 1, 1 << 20)
    num = F.when(tail.contains("/"), F.substring_index(tail, "/", 1)).try_cast("int")
    ok = last.startswith(prefix) & num.isNotNull()
    return F.when(ok, F.least(num, F.lit(cap))).otherwise(F.lit(1))


# ----------------------------------------------------------------------------- page fields

def title_guard(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages without a <title> are skipped."""
    return pages.where(F.col(html).rlike(TITLE_RE))


_TEXTS = ["names", "ratings", "repurchases", "pkg_quals", "prices", "ingredients", "brands", "brand_href"]
_LISTS = ["users_a", "chars_a", "reviews_a", "lipies_a", "dates_a"]
PARSED = StructType([StructField("has_title", BooleanType()), *[StructField(c, StringType()) for c in _TEXTS],
                     *[StructField(c, ArrayType(StringType())) for c in _LISTS]])
PARSED_ARROW = pa.struct([("has_title", pa.bool_()), *[(c, pa.string()) for c in _TEXTS],
                          *[(c, pa.list_(pa.string())) for c in _LISTS]])


#: Bytes of HTML that are parsed at a time: a batch that reaches a task holds up to 64 MB, of which the
#: strings, the fields and their Arrow form would be held all at once.
PARSE_BYTES = 1 << 20


def _slices(html: pa.Array):
    """(start, rows) of consecutive slices of about ``PARSE_BYTES``, a row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(html):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PARSE_BYTES, "right")))
        yield start, stop - start
        start = stop


def parse_pages(pages: DataFrame, html: str = "html", keep: bool = True) -> DataFrame:
    """``pages`` with column ``parsed``: the review fields of each page, parsed once. Without
    ``keep`` the HTML itself, which nothing reads any more, is left out."""
    names = [c for c in pages.columns if keep or c != html]
    schema = StructType([*[f for f in pages.schema.fields if f.name in names], StructField("parsed", PARSED)])
    at = pages.columns.index(html)

    def run(batches):
        for batch in batches:
            for start, rows in _slices(batch.column(at)):
                part = batch.slice(start, rows)
                fields = pa.array([page_fields(h) for h in part.column(at).to_pylist()], PARSED_ARROW)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], fields], names=[*names, "parsed"])

    return pages.mapInArrow(run, schema)


def page_text_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """The page-level scalars of a review page, repeated later for each review: the second
    h1, the first h3, the first paragraphs about repurchase, package and price, ingredients,
    and the brand link. Null where the page has no such element."""
    p = pages if "parsed" in pages.columns else parse_pages(pages, html)
    return p.select(
        "*", *[F.col(f"parsed.{c}") for c in ("names", "ratings", "repurchases", "pkg_quals", "prices",
                                              "ingredients", "brands")],
        extract_id(F.col("parsed.brand_href"), BRAND_LINK_MARKER).alias("brand_ids"),
        extract_id(F.col("url"), PRODUCT_LINK_MARKER).alias("pro_ids"))


def page_review_arrays(pages: DataFrame, html: str = "html") -> DataFrame:
    """One array per review field, in page order."""
    p = pages if "parsed" in pages.columns else parse_pages(pages, html)
    return p.select("*", *[F.col(f"parsed.{c}") for c in REVIEW_ARRAYS])


REVIEW_ARRAYS = ["users_a", "chars_a", "reviews_a", "lipies_a", "dates_a"]
SCALARS = ["pro_ids", "names", "ratings", "repurchases", "pkg_quals", "prices", "ingredients",
           "brands", "brand_ids"]


def quarantine_pages(arrays: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split pages with scalars and arrays into (good, rejected): a page that lacks a field,
    or whose review arrays differ in length, is reported with its sizes and missing fields and
    skipped, instead of failing the job."""
    sizes = [F.size(c) for c in REVIEW_ARRAYS]
    same = reduce(lambda a, b: a & b, [s == sizes[0] for s in sizes[1:]])
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in SCALARS])
    good = arrays.where(same & whole)
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in SCALARS])), ",")
    rejected = arrays.where(~(same & whole)).select(
        "page_id", "url", *[F.size(c).alias("n_" + c[:-2]) for c in REVIEW_ARRAYS], missing.alias("missing"))
    return good, rejected


def explode_reviews(good: DataFrame) -> DataFrame:
    """One row per review: page scalars repeated, review arrays zipped."""
    z = F.arrays_zip(*[F.col(c).alias(c[:-2]) for c in REVIEW_ARRAYS])
    return good.select(*SCALARS, "cat_id", F.inline(z)) if "cat_id" in good.columns else \
        good.select(*SCALARS, F.inline(z))


def extract_reviews(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pages -> (raw review rows with empty ingredients as null, rejected pages)."""
    from sheen.operators.clean import blank_to_null
    good, rejected = quarantine_pages(page_review_arrays(page_text_fields(parse_pages(title_guard(pages), keep=False))))
    return blank_to_null(explode_reviews(good)), rejected


def tag_category(pages: DataFrame) -> DataFrame:
    """Review rows of all categories with their ``cat_id``: pages keep the category of the
    search that found them, so one pass extracts any number of categories."""
    return extract_reviews(pages)[0]


# ----------------------------------------------------------------------------- rendering

#: Columns of a page that are its product's.
PRODUCT = ["names", "ratings", "repurchases", "pkg_quals", "prices", "ingredients", "brands", "brand_ids", "cat_id"]


def render_review_pages(raw: DataFrame, per_page: int = REVIEWS_PER_PAGE, products: DataFrame | None = None) -> DataFrame:
    """Lay raw review rows out as review-site pages (the inverse of
    ``extract_reviews``): (page_id, url, html, cat_id).

    Reviews of a product are spread over ceil(n / per_page) pages by a hash of
    the review, whose number is counted where the product's reviews already are, so that they are
    read and shuffled once. The columns of the product come from ``products`` (pro_ids, PRODUCT), of which a row per
    product is joined to its finished pages, so that its text is not carried with every
    review; without it, from the reviews.
    """
    products = (raw if products is None else products).select("pro_ids", *PRODUCT).dropDuplicates(["pro_ids"])
    counted = raw.where(F.col("pro_ids").isNotNull()).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("pro_ids")))
    key = F.xxhash64("users", "dates", "reviews", "chars", "lipies")
    paged = counted.withColumn(
        "page", (F.pmod(key, F.ceil(F.col("_n") / per_page)) + 1).cast("int"))
    review = F.concat(
        F.lit('<div class="review"><span class="user-name">'), escape(F.col("users")),
        F.lit('</span><div class="important">'), escape(F.col("chars")),
        F.lit('</div><div class="lipies"><span class="'), F.col("lipies"),
        F.lit('"></span></div><div class="date">'), escape(F.col("dates")),
        F.lit('</div><div class="comment-content">'), escape(F.col("reviews")),
        F.lit("</div></div>"))
    pages = paged.groupBy("pro_ids", "page").agg(
        F.array_sort(F.collect_list(F.struct(key.alias("k"), review.alias("r")))).alias("rv")).join(products, "pro_ids")
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), escape(F.col("names")),
        F.lit("</title></head><body><h1>Reviews</h1><h1>"), escape(F.col("names")),
        F.lit("</h1><h3>"), F.col("ratings"), F.lit("</h3><p>"), F.col("repurchases"),
        F.lit("</p><p>"), F.col("pkg_quals"), F.lit("</p><p>"), F.col("prices"),
        F.lit('</p><a class="track_BreadCrumbs_Brand" href="'), F.lit(BRAND_LINK_MARKER),
        F.col("brand_ids"), F.lit('/">'), escape(F.col("brands")),
        F.lit('</a><div id="hold-ingredients">'), escape(F.col("ingredients")),
        F.lit("</div>"), F.array_join(F.transform("rv", lambda x: x["r"]), ""),
        F.lit("</body></html>"))
    url = F.concat(F.lit(PRODUCT_LINK_MARKER), F.col("pro_ids"), F.lit("/page="),
                   F.col("page").cast("string"))
    return pages.select(F.xxhash64("pro_ids", "page").alias("page_id"), url.alias("url"),
                        html.alias("html"), "cat_id")


