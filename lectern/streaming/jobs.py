"""Streaming ingest, accepted counter and latest status.

Each micro-batch is written to its own folder, query=<id>/batch_id=<n>, in overwrite mode: a batch that
runs again after a failure replaces its own output and nothing else, as the id stays with the checkpoint.
Readers fold the folders into the current table.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lectern.config import DEFAULTS, JobConfig
from lectern.functions.html import content_blocks, page_title
from lectern.operators.metrics import accepted_counts
from lectern.operators.requests import observe_contract, observed_violations
from lectern.operators.state import latest_status

# The folders of a micro-batch as columns.
BATCH_COLUMNS = (StructField("query", StringType()), StructField("batch_id", LongType()))


def stream_table(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """File stream over the Parquet tables of a folder that match `glob`, each a file or a folder of files.

    A table's folder may be partitioned, unless `folder` is a pattern itself.
    """
    # A filter on names would look at the files inside a table's folder; braces make a pattern of any name.
    path = f"{folder}/{{{glob}}}"
    # A micro-batch is given files only; partition columns are read off their paths below the base.
    base = {} if any(c in folder for c in "*?[{\\") else {"basePath": folder}
    return spark.readStream.schema(spark.read.options(**base).parquet(path).schema).options(**base).parquet(path)


def stream_payloads(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """File stream of landed JSON payloads, one per line, as (payload)."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    return lines.withColumnRenamed("value", "payload")


def write_batches(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    partition_by: tuple[str, ...] = (),
    mode: str = "append",
    every: str | None = None,
    checks: str | None = None,
    after: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Applies a batch transformation to every micro-batch and writes it to its own folder.

    Works off what has landed and stops, or runs on with a micro-batch `every` so often. With `checks`, a folder, the
    write of a micro-batch of requests also counts what breaks their contract, and (rule, n) goes to a folder of the batch there.
    `after` is called with the batch's number when its rows are written; a batch that runs again calls it again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        done, seen, own = batch.transform(transform), None, f"query={query}/batch_id={batch_id}"
        if checks:
            done, seen = observe_contract(done)
        writer = done.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{out}/{own}")
        if seen is not None:
            observed_violations(spark, seen).coalesce(1).write.mode("overwrite").parquet(f"{checks}/{own}")
        if after is not None:
            after(spark, batch_id)

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def read_batches(spark: SparkSession, out: str, schema: StructType | None = None) -> DataFrame:
    """Rows of all micro-batches so far, with `query` and `batch_id`.

    Partitioned batches without rows leave no file that tells the columns; give the `schema` of what was written there.
    """
    reader = spark.read.option("basePath", out)
    if schema is not None:
        reader = reader.schema(StructType([*schema, *BATCH_COLUMNS]))
    return reader.parquet(out)


def stream_requests(
    stream: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Routes arriving requests with the batch functions; accepted and rejected rows part by folder.

    Both outcomes go out in one write, so a random id is drawn once, and a bad request only ends up
    on the other side.
    """
    return write_batches(stream, out, checkpoint, process, partition_by=("status",), every=every)


def stream_accepted_counts(
    stream: DataFrame, ts: str = "submitted_ts", late: str = "10 minutes", window: str = "1 hour"
) -> DataFrame:
    """Accepted counter on a stream; rows later than the watermark are dropped."""
    return accepted_counts(stream.withWatermark(ts, late), ts, window=window)


def distinct_deliveries(
    stream: DataFrame, ts: str = "submitted_ts", late: str = "10 minutes", keys: tuple[str, ...] = ("payload",)
) -> DataFrame:
    """Payloads without those that were delivered before, within `late` of the first delivery.

    Deliveries are told apart by a digest of `keys`; the state holds the digest only, until the watermark has passed it.
    It is part of the checkpoint, so a delivery repeated after a restart is known.
    """
    # A NULL and an empty field are different, and so is where a field ends.
    text = F.concat_ws("|", *[F.coalesce(F.hex(F.encode(F.col(k).cast("string"), "UTF-8")), F.lit("none")) for k in keys])
    marked = stream.withWatermark(ts, late).withColumn("_digest", F.sha2(text, 256))
    return marked.dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def join_landing_pages(
    requests: DataFrame,
    pages: DataFrame,
    request_key: str = "request_hash",
    asked: str = "asked_ts",
    landed: str = "landed_ts",
    url: str = "url",
    early: str = "1 hour",
    wait: str = "1 hour",
    late: str = "10 minutes",
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Classified requests of a stream with the text and `page_title` of the web page they name.

    Both sides may come first: a page is good for a request if it lands between `early` before and `wait` after it. A
    TEXT request without text waits for its page until the watermarks of both streams (`late` behind the newest row)
    have passed its time, and then goes on without one; other requests go on at once. Every request gives one row; of
    several pages the one that is met first counts. Pages are read before they are kept, so the state holds text and title
    only. An outer join and the removal of second pages: run it in append mode.
    """
    read = pages.where(F.col(url).isNotNull()).select(
        F.col(url).alias("_url"),
        F.col(landed).alias("_landed"),
        F.nullif(F.array_join(content_blocks(F.col("html"), cfg.min_text_block), ""), F.lit("")).alias("_text"),
        page_title(F.col("html")).alias("page_title"),
    )
    reads_page = F.coalesce((F.col("type") == "TEXT") & (F.coalesce("text", F.lit("")) == ""), F.lit(False))
    in_time = F.expr(f"_landed >= {asked} - INTERVAL {early} AND _landed <= {asked} + INTERVAL {wait}")
    joined = requests.withWatermark(asked, late).join(
        read.withWatermark("_landed", late), reads_page & (F.col("uri") == F.col("_url")) & in_time, "leftOuter"
    )
    text = F.coalesce(F.nullif("text", F.lit("")), "_text")
    one = joined.withColumn("text", text).drop("_url", "_landed", "_text")
    return one.dropDuplicatesWithinWatermark([request_key])


def fold_counts(log: DataFrame) -> DataFrame:
    """Current counter from the updates of all micro-batches: a query's last update of a window holds.

    Queries with checkpoints of their own count their own inputs, so their counters add up.
    """
    newest = F.max_by(F.struct("n_batches", "n_requests"), "batch_id").alias("row")
    counters = log.groupBy("window_start", "query").agg(newest).select("window_start", "row.*")
    return counters.groupBy("window_start").agg(
        F.sum("n_batches").alias("n_batches"), F.sum("n_requests").alias("n_requests")
    )


def stream_latest_status(stream: DataFrame, key: str, order_by: tuple[str, ...]) -> DataFrame:
    """Latest state per request, kept incrementally; run it in update mode."""
    return latest_status(stream, key, order_by)


def fold_status(log: DataFrame, key: str, order_by: tuple[str, ...]) -> DataFrame:
    """Current status table from the updates of all micro-batches."""
    return latest_status(log.drop("query", "batch_id"), key, order_by)
