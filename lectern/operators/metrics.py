"""Counts over requests and estimates over texts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.config import DEFAULTS, JobConfig
from lectern.functions.text import word_count


def accepted_counts(
    batches: DataFrame, ts: str = "submitted_ts", n_requests: str = "n_requests", window: str = "1 hour"
) -> DataFrame:
    """Accepted batches and their requests per time window. Works on a table or a stream."""
    return (
        batches.groupBy(F.window(ts, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_batches"), F.sum(n_requests).cast("bigint").alias("n_requests"))
        .select(F.col("w.start").alias("window_start"), "n_batches", "n_requests")
    )


def route_census(routed: DataFrame, by: tuple[str | Column, ...] = ("type", "status")) -> DataFrame:
    return routed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def playback_estimate(
    docs: DataFrame,
    by: tuple[str, ...] = ("source", "lang"),
    text: str = "text",
    rate: str | None = None,
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Listening time of texts read aloud: words over words per minute, summed per group.

    `rate` names a column with a document's own rate; unset or 0 takes the job's.
    """
    own = F.lit(None).cast("int") if rate is None else F.nullif(F.col(rate), F.lit(0))
    wpm = F.coalesce(own, F.lit(cfg.words_per_minute))
    words = docs.select(*by, word_count(F.col(text)).alias("words"), wpm.alias("wpm"))
    # Words are summed per rate first, as whole numbers; only one fraction per rate is added up.
    per_rate = words.groupBy(*by, "wpm").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words"))
    return per_rate.groupBy(*by).agg(
        F.sum("n").alias("n_docs"),
        F.sum("words").alias("words"),
        F.round(F.sum(F.col("words") / F.col("wpm")), 4).alias("minutes"),
    )
