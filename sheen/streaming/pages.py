"""The page-extraction plan (§2.2) over a stream of stored pages.

The crawl of the source application delivers pages over time; here pages land
as Parquet files (page_id, url, html, cat_id) in a folder. Extraction is
stateless (a projection, a filter and a generator per page), so each
micro-batch runs the same plan as the batch job: no state store, no
watermark. Review rows go to a Parquet sink partitioned by category; rejected
pages to a second sink. Progress lives in the checkpoint folders, so a restart
after a failure resumes without loss or duplicates.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from sheen.operators.pages import extract_reviews

PAGE_SCHEMA = "page_id BIGINT, url STRING, html STRING, cat_id STRING"


def extract_reviews_stream(spark: SparkSession, pages_dir: str, out_dir: str, checkpoint_dir: str,
                           available_now: bool = True, max_files_per_trigger: int = 1000
                           ) -> tuple[StreamingQuery, StreamingQuery]:
    pages = (spark.readStream.schema(PAGE_SCHEMA)
             .option("maxFilesPerTrigger", max_files_per_trigger).parquet(pages_dir))
    rows, rejected = extract_reviews(pages)

    def start(df, name, partition=None):
        w = (df.writeStream.format("parquet").outputMode("append")
             .option("path", f"{out_dir}/{name}")
             .option("checkpointLocation", f"{checkpoint_dir}/{name}"))
        if partition:
            w = w.partitionBy(partition)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()

    return start(rows, "reviews", "cat_id"), start(rejected, "rejected")
