"""The extraction plan on a stream of page files gives the batch result."""

from sheen.operators import pages as PG
from sheen.sources import fixtures as FX
from sheen.streaming.pages import extract_reviews_stream


def test_stream_matches_batch(spark, sf, tmp_path):
    base = str(tmp_path)
    pages = PG.render_review_pages(FX.reviews_raw_fx(spark, sf)).select("page_id", "url", "html", "cat_id")
    pages.repartition(3).write.parquet(f"{base}/in")
    q1, q2 = extract_reviews_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    q1.awaitTermination(300)
    q2.awaitTermination(300)
    got = spark.read.parquet(f"{base}/out/reviews").select("pro_ids", "users", "lipies", "cat_id")
    want, _ = PG.extract_reviews(pages)
    want = want.select("pro_ids", "users", "lipies", "cat_id")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
