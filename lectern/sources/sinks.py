"""Sinks."""

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.binding import with_computed
from lectern.functions.titles import created_date, storage_path
from lectern.sources import readers, snapshots


def with_layout(df: DataFrame) -> DataFrame:
    """Adds storage_path and created_date."""
    path = storage_path(F.col("type"), F.col("uri"), F.col("title"), F.col("created"))
    return with_computed(df, {"storage_path": path, "created_date": created_date(F.col("created"))})


def write_content(df: DataFrame, base: str, run: str | None = None) -> None:
    """Adds items by type and creation date; items without a storage path are refused.

    Every run writes its own folder inside the partitions and never touches those of other runs. A
    repeated run, of the same `run` name and the same items, replaces its own. Run names rise with time, so that
    `readers.read_content` knows the last writer of a storage path; by default they are the time of the call.
    The rebalance hint gathers the rows of a partition into few files and splits a hot partition.
    A run that `compact_content` has folded cannot be repeated: its name is refused.
    """
    run = run or f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    before = snapshots.newest(df.sparkSession, base)
    if before is not None and run in before.covered["runs"]:
        raise ValueError(f"run {run} is part of the snapshot already")
    (
        with_layout(df)
        .where(F.col("storage_path").isNotNull())
        .withColumn("run", F.lit(run))
        .hint("rebalance", "type", "created_date")
        .write.partitionBy("type", "created_date", "run")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(base)
    )
    snapshots.put(df.sparkSession, f"{base}/{snapshots.HIDDEN}/run-{run}", "")


def compact_content(spark: SparkSession, base: str) -> snapshots.Manifest | None:
    """Folds all finished runs into a new snapshot; the manifest in force, None while there is no finished run.

    Only the snapshot before and the runs since are read. A run that is still being written is left for the next
    time, and read beside the snapshot meanwhile. If the fold dies, the old version stays in force and no run is touched.
    """
    before = snapshots.newest(spark, base)
    known = before.covered["runs"] if before else []
    finished = {path.rsplit("/run-", 1)[1] for path in snapshots.children(spark, f"{base}/{snapshots.HIDDEN}/run-*")}
    fresh = [run for run in readers.runs_since(spark, base, before) if run in finished]
    if not fresh:
        return before
    stored = readers.read_runs(spark, base, fresh)
    if before is not None:
        stored = before.rows(spark).unionByName(stored)
    winners, folder = readers.last_writers(stored), snapshots.draft_folder(base)
    # The run stays with each row: a run that comes late may be older than what is folded.
    winners.hint("rebalance", "type", "created_date").write.partitionBy("type", "created_date").parquet(folder)
    columns = [c for c in winners.schema if c.name not in ("type", "created_date")]
    columns += [winners.schema["type"], winners.schema["created_date"]]
    return snapshots.publish(spark, base, before, folder, T.StructType(columns), {"runs": sorted({*known, *fresh})})


def write_lookup(
    df: DataFrame, path: str, key: str, partition_by: tuple[str, ...] = (), keys_per_group: int = 100_000,
    group_bytes: int = 128 << 20,
) -> None:
    """Stores a table that is asked for single keys: `state.lookup_points` reads only what may hold them.

    A key's rows are in one file of each partition, in order of the key, and every row group of `group_bytes` has a Bloom
    filter for about `keys_per_group` keys beside its least and largest key.
    """
    (
        df.repartition(*partition_by, key)
        .sortWithinPartitions(*partition_by, key)
        .write.partitionBy(*partition_by)
        .option(f"parquet.bloom.filter.enabled#{key}", True)
        .option(f"parquet.bloom.filter.expected.ndv#{key}", keys_per_group)
        .option("parquet.block.size", group_bytes)
        .mode("overwrite")
        .parquet(path)
    )


def to_json_lines(df: DataFrame, *columns: str) -> DataFrame:
    """One JSON object per row as (json); unset fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("json"))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
