"""The incremental sides of curation as structured streams: new pages, names already taken, audit logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.functions import html as H
from quillspark.operators.enrich import highest_numbers, name_number, with_suffixes


def new_pages(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """A stream of (path, html) of pages as they come into a folder; the checkpoint remembers which were read."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).load(folder)
    return raw.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def probe(pages: DataFrame) -> DataFrame:
    return pages.select("path", H.marker_counts(F.col("html")).alias("c")).select("path", "c.*")


def append(df: DataFrame, out: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Appends a stream to a table of Parquet files, all that is there now, and ends."""
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).options(**options).trigger(availableNow=True).start()


def append_named(df: DataFrame, out: str, checkpoint: str, name: str, *order: str) -> StreamingQuery:
    """Appends a stream whose names must be unique: those already in the table and those of the batch count.

    The table has a folder for each batch. Beside it, in out with the ending _numbers, each batch leaves the highest
    number of every root that it has names of, so later batches read these and not the table. A batch that runs again
    replaces what it wrote before. Null names are kept as they are.
    """
    numbers = f"{out.rstrip('/')}_numbers"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = spark.createDataFrame([], "root string, ext string, high long")
        if _exists(spark, numbers):
            roots = batch.select(name_number(F.col(name)).alias("x")).select("x.root", "x.ext").distinct()
            old = spark.read.schema("root string, ext string, high long, batch long").parquet(numbers).where(F.col("batch") < number)
            earlier = old.join(roots, ["root", "ext"], "left_semi").groupBy("root", "ext").agg(F.max("high").alias("high"))
        named = with_suffixes(batch, name, *order, taken=earlier)
        named.write.mode("overwrite").parquet(f"{out}/batch={number}")
        written = spark.read.parquet(f"{out}/batch={number}")
        highest_numbers(written, "unique_name").write.mode("overwrite").parquet(f"{numbers}/batch={number}")

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def latest_visits(visits: DataFrame, delay: str = "30 days") -> DataFrame:
    """Streaming counts of page visits by book and day of discovery, late visits within delay included."""
    return visits.withWatermark("discovered_at", delay).groupBy(F.window("discovered_at", "1 day"), "book_slug").agg(F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("failed"))
