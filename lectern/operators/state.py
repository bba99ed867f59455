"""Latest state of requests, lookups by id, duplicates and export winners."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.config import DEFAULTS, JobConfig
from lectern.functions.text import fingerprint
from lectern.functions.titles import clean_title, type_ext
from lectern.operators.skew import count_keys, salted_join


def latest_status(history: DataFrame, key: str, order_by: tuple[str, ...]) -> DataFrame:
    """Newest row per key. Partial maxima shrink a hot key before anything is shuffled."""
    values = [c for c in history.columns if c != key]
    newest = F.max_by(F.struct(*values), F.struct(*order_by)).alias("row")
    return history.groupBy(key).agg(newest).select(key, "row.*")


def lookup_status(
    ids: DataFrame, history: DataFrame, key: str, order_by: tuple[str, ...], cfg: JobConfig = DEFAULTS
) -> DataFrame:
    """Latest state of each id asked for, with a `found` flag.

    The ids are counted first. A short list of them is broadcast to cut the history before it is
    aggregated; an id asked for very often is salted in the join.
    """
    counts = count_keys(ids, key)
    wanted = counts.small_keys(cfg.broadcast_bytes)
    if wanted is not None:
        history = history.join(wanted, key, "left_semi")
    latest = latest_status(history, key, order_by).withColumn("found", F.lit(True))
    asked = ids.withColumn("_row", F.monotonically_increasing_id())
    return (
        salted_join(asked, latest, key, ["_row"], counts=counts)
        .drop("_row")
        .withColumn("found", F.coalesce("found", F.lit(False)))
    )


def missing_ids(ids: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Distinct ids without any state: the not-found answers.

    Both sides are reduced to distinct ids before the join, so there is no hot id left in it.
    """
    return ids.select(key).distinct().join(history.select(key).distinct(), key, "left_anti")


def lookup_result(
    content: DataFrame, content_type: str, ids: DataFrame, key: str, cfg: JobConfig = DEFAULTS
) -> DataFrame:
    """Stored rows of one type for the ids asked for. The type prunes partitions of a stored table."""
    typed = content.where(F.col("type") == content_type)
    counts = count_keys(ids, key)
    wanted = counts.small_keys(cfg.broadcast_bytes)
    if wanted is not None:
        return typed.join(wanted, key, "left_semi")
    others = [c for c in typed.columns if c != key]
    every_id = counts.table.where(F.col(key).isNotNull()).select(key)
    return salted_join(typed, every_id, key, others, "inner").select(*typed.columns)


def lookup_points(stored: DataFrame, ids: DataFrame, key: str, most: int = 100, cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Rows of `stored`, a table written by `sinks.write_lookup`, for the ids asked for; each row once.

    The distinct ids are counted first. Up to `most` of them become equalities that reach the scan, where row groups whose
    Bloom filter or range has none of them are skipped unread; more are joined as `lookup_result` does.
    """
    counts = count_keys(ids, key)
    few = counts.table.where(F.col(key).isNotNull()).select(key).limit(most + 1).collect()
    if len(few) <= most:
        # Not isin: beyond a few values that reaches the scan as a range only.
        return stored.where(_any([F.col(key) == F.lit(r[0]) for r in few]))
    wanted = counts.small_keys(cfg.broadcast_bytes)
    if wanted is not None:
        return stored.join(wanted, key, "left_semi")
    others = [c for c in stored.columns if c != key]
    every_id = counts.table.where(F.col(key).isNotNull()).select(key)
    return salted_join(stored, every_id, key, others, "inner").select(*stored.columns)


def _any(checks: list[Column]) -> Column:
    """One of the checks holds; halved, so that the expression is not deep."""
    if len(checks) < 2:
        return checks[0] if checks else F.lit(False)
    middle = len(checks) // 2
    return _any(checks[:middle]) | _any(checks[middle:])


def duplicate_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts that occur more than once: (fingerprint, n, first_id)."""
    return (
        df.select(fingerprint(F.col(text)).alias("fingerprint"), F.col(key).alias("id"))
        .groupBy("fingerprint")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .where(F.col("n") > 1)
    )


def flat_export(stored: DataFrame) -> DataFrame:
    """Audio items of the flat export folder: the last writer of each file name wins.

    (basename, request_hash, created, storage_path, n_writers), by maxima, so that a file name that
    many items share needs no sort.
    """
    name = F.concat_ws(".", clean_title(F.col("title")), type_ext(F.col("type"), F.col("uri")))
    winner = F.max_by(F.struct("request_hash", "created", "storage_path"), F.struct("created", "request_hash"))
    return (
        stored.where((F.col("type") == "AUDIO") & F.col("storage_path").isNotNull())
        .groupBy(name.alias("basename"))
        .agg(winner.alias("row"), F.count(F.lit(1)).alias("n_writers"))
        .select("basename", "row.request_hash", "row.created", "row.storage_path", "n_writers")
    )
