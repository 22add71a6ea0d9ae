"""Page extraction on made-up pages (FIXTURES.md §2) and the render/extract round trip."""

from pyspark.sql import functions as F

from sheen.functions.constants import BRAND_LINK_MARKER, PRODUCT_LINK_MARKER
from sheen.operators import pages as PG

REVIEW = ('<div class="review"><span class="user-name">\t{u}\t</span><div class="important">'
          'Age: 19-24\tSkin: Dry, Fair, Cool\tHair: Red, Wavy, Fine\tEyes: Blue</div>'
          '<div class="lipies"><span class="l-4-0"></span></div><div class="date">\ton 1/7/2019\t</div>'
          '{c}</div>')
HEAD = ('<html><head><title>x</title></head><body><h1>Reviews</h1><h1>Rose &amp; Oud Cream</h1>'
        '<h3>4.1</h3><p>85% would repurchase</p><p>Package Quality: 4.0</p><p>Price: $$$</p>'
        f'<a class="track_BreadCrumbs_Brand" href="{BRAND_LINK_MARKER}17/">Brand A</a>'
        '<div id="hold-ingredients">Water, Glycerin</div>')


def page(pid, body, title=True):
    html = HEAD + body + "</body></html>"
    if not title:
        html = html.replace("<title>x</title>", "")
    return (pid, f"{PRODUCT_LINK_MARKER}{100 + pid}/page=1", html)


def test_fields_quarantine_and_title_guard(spark):
    good = "".join(REVIEW.format(u=u, c=f'<div class="comment-content">great {u}</div>') for u in "ab")
    bad = "".join(REVIEW.format(u=u, c=('<div class="comment-content">x</div>' if u != "c" else ""))
                  for u in "abc")
    pages = spark.createDataFrame([page(1, good), page(2, bad), page(3, good, title=False)],
                                  "page_id bigint, url string, html string")
    rows, rejected = PG.extract_reviews(pages)
    rows = rows.collect()
    assert len(rows) == 2 and {r.pro_ids for r in rows} == {"101"}
    r = rows[0]
    assert (r.names, r.ratings, r.repurchases, r.pkg_quals, r.prices) == (
        "Rose & Oud Cream", "4.1", "85% would repurchase", "Package Quality: 4.0", "Price: $$$")
    assert (r.ingredients, r.brands, r.brand_ids, r.lipies) == ("Water, Glycerin", "Brand A", "17", "l-4-0")
    assert r.users.strip() in "ab" and r.dates == "\ton 1/7/2019\t"
    rej = rejected.collect()
    assert [(x.page_id, x.n_users, x.n_reviews) for x in rej] == [(2, 3, 2)]


def one(spark, body):
    pages = spark.createDataFrame([page(1, body)], "page_id bigint, url string, html string")
    return PG.page_review_arrays(PG.page_text_fields(PG.parse_pages(pages))).first()


def test_whole_texts(spark):
    """Nested tags, any tag and class list, either quote, and all entities."""
    r = one(spark, '<div class="comment-content">first <div>inner</div> second<!-- no --><script>x()</script></div>'
                   "<a class='user-name big'>Caf&eacute; &#233; &amp;lt;</a><p class=important>a<br>b</p>"
                   '<div class="box lipies"><b>n</b><i><span class="l-5-0 x"></span></i></div>'
                   '<div class="x date">on 1/2/2019</div><span class="date">no</span><i class="user-names">no</i>')
    assert r.reviews_a == ["first inner second"] and r.users_a == ["Café é &lt;"] and r.chars_a == ["ab"]
    assert r.lipies_a == ["l-5-0"] and r.dates_a == ["on 1/2/2019"]
    assert r.prices == "Price: $$$" and r.names == "Rose & Oud Cream"


def test_missing_fields_reject_the_page(spark):
    body = REVIEW.format(u="a", c='<div class="comment-content">x</div>')
    p1, p2, p3 = page(1, body), page(2, body), page(3, body)
    pages = [p1, (*p2[:2], p2[2].replace("<h3>4.1</h3>", "")), (*p3[:2], p3[2].replace("<p>Price: $$$</p>", "<p>Price: <b>$</b>$</p>"))]
    pages += [(4, "u", None), (5, "u", ""), (6, "u", "<title>t</title><p>unclosed <div class=date>")]
    rows, rejected = PG.extract_reviews(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    assert [r.pro_ids for r in rows.collect()] == ["101"]
    assert {r.page_id: r.missing for r in rejected.collect()} == {2: "ratings", 3: "prices", 6: ",".join(
        c for c in PG.SCALARS if c != "pro_ids")}


def test_round_trip(spark, sf):
    from sheen.sources import fixtures as FX
    raw = FX.reviews_raw_fx(spark, sf)
    rows, rejected = PG.extract_reviews(PG.render_review_pages(raw))
    cols = ["pro_ids", "names", "ratings", "users", "chars", "reviews", "lipies", "dates"]
    a = rows.select(*cols)
    b = raw.select(*cols)
    assert rejected.count() == 0
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_links(spark):
    df = spark.createDataFrame([('<a href="/a">1</a><a class="x" href="/b">2</a><a href="/c">',)], "h string")
    r = df.select(PG.page_links(F.col("h"), "/").alias("l")).select(
        "l", PG.every_second(F.col("l"), 0).alias("e"), PG.every_second(F.col("l"), 1).alias("o")).first()
    assert list(r.l) == ["/a", "/b", "/c"] and list(r.e) == ["/a", "/c"] and list(r.o) == ["/b"]


def test_cap_pages(spark):
    pre = "https://h/p/page="
    df = spark.createDataFrame([([pre + "1/", pre + "80/", pre + "2/"],), ([pre + "1/", pre + "7/", "n"],),
                                ([pre + "1/"],), ([pre + "1/", pre + "7", "n"],)], "l array<string>")
    got = [r[0] for r in df.select(PG.cap_pages(F.col("l"), F.lit(pre))).collect()]
    assert got == [66, 7, 1, 1]
