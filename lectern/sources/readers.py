"""Scans."""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.session import materialize
from lectern.sources import snapshots


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spreads an input of fewer splits than cores, such as one small file, over the cores.

    A large input has more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def scan_content(spark: SparkSession, path: str, text: str = "text") -> DataFrame:
    """One column of a content table; a missing text reads as ''."""
    return spark.read.parquet(path).select(F.coalesce(F.col(text), F.lit("")).alias("text"))


CSV_OPTIONS = {"header": "false", "mode": "FAILFAST", "escape": '"', "inferSchema": "false"}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, whole_files: bool | None = None
) -> DataFrame:
    """CSV with every field a string and no header; a row of another width fails the read.

    Quoted fields may have line breaks, and files larger than a split are still read in splits (`csv_records`); smaller ones
    are a task each anyway. `whole_files` says which way to go. A line break inside a field reads as a line feed either way.
    """
    if whole_files is None:
        largest = file_manifest(spark, path).agg(F.max("size")).first()[0] or 0
        whole_files = largest <= spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    plain = spark.read.options(**CSV_OPTIONS).option("multiLine", True)
    rows = (plain.schema(schema) if schema else plain).csv(path)
    if not whole_files:
        # The reader above has only looked at the first record, for the number of columns.
        record = F.from_csv("record", rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), CSV_OPTIONS)
        rows = csv_records(spark, path).select(record.alias("r")).select("r.*")
    fields = [F.regexp_replace(F.col(c), "\r\n?", "\n") if whole_files else F.col(c) for c in rows.columns]
    return rows.select(*[F.coalesce(f, F.lit("")).alias(c) for f, c in zip(fields, rows.columns, strict=True)])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as (record), line breaks inside quotes included; files are read in splits.

    A line starts inside a field if the quotes before it in its file are odd in number. They are counted per split and summed
    over the splits of a file (a row for each); with that sum a task puts the lines of a split together as they are read. Only what
    crosses the ends of splits, a fragment or two of each, is shuffled; the text itself is neither sorted nor written, but
    read three times. Blank lines between records are no records.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select(F.col("value").alias("line"), *place)
    quotes = F.char_length("line") - F.char_length(F.replace("line", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("n"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # The numbers given to splits are pinned down by the table.
    splits = materialize(before.withColumn("split", F.monotonically_increasing_id()), "splits")
    # A later scan may be cut otherwise, as when executors have come; quotes before a place that is known are the same then.
    known = F.coalesce("split", F.raise_error(F.lit("The splits of the CSV files have changed, read them again.")).cast("long"))
    marked = lines.join(F.broadcast(splits), ["file", "block"], "left").select(known.alias("split"), "before", "line")
    whole = marked.mapInArrow(_records_within, "record string")
    ends = marked.mapInArrow(_records_across, "split long, opens boolean, part string").join(F.broadcast(splits), "split")
    so_far = W.partitionBy("file").orderBy("block", "opens").rowsBetween(W.unboundedPreceding, 0)
    owned = ends.withColumn("own", F.max(F.when(F.col("opens"), F.col("block"))).over(so_far))
    parts = F.array_sort(F.collect_list(F.struct("block", "opens", "part")))
    across = owned.groupBy("file", "own").agg(parts.alias("parts"))
    return whole.unionByName(across.select(F.array_join(F.transform("parts", lambda p: p["part"]), "\n").alias("record")))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The records of (split, before, line), lines in order: (split, opens, closes, texts).

    `opens` and `closes` say if the texts, an Arrow array, begin and end in the split; if not, it is one text.
    """
    split, quotes, held, opens = None, 0, [], False

    def joined(lines: pa.Array) -> str:
        return "\n".join(lines.to_pylist())

    for batch in batches:
        ids, before, lines = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        counts = pc.count_substring(lines, '"').to_numpy().astype(np.int64)
        filled = pc.greater(pc.binary_length(lines), 0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if low == high:
                continue
            if ids[low] != split:
                if held:
                    yield split, opens, False, pa.array(["\n".join(held)])
                split, quotes, held, opens = int(ids[low]), int(before[low]), [], False
            above = quotes + np.cumsum(counts[low:high]) - counts[low:high]
            quotes += int(counts[low:high].sum())
            inside = above % 2 == 1
            kept = inside | filled[low:high]
            own = lines.slice(low, high - low).filter(pa.array(kept))
            starts = np.flatnonzero(~inside[kept])
            if not len(starts):
                held += [joined(own)] if len(own) else []
                continue
            first, last = int(starts[0]), int(starts[-1])
            held += [joined(own.slice(0, first))] if first else []
            if held:
                yield split, opens, True, pa.array(["\n".join(held)])
            if last > first:
                offsets = pa.array(starts - first, pa.int32())
                yield split, True, True, pc.binary_join(pa.ListArray.from_arrays(offsets, own.slice(first, last - first)), "\n")
            held, opens = [joined(own.slice(last))], True
    if held:
        yield split, opens, False, pa.array(["\n".join(held)])


def _records_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that are known to begin and end in their split."""
    for _, opens, closes, texts in _records(batches):
        if opens and closes:
            yield pa.RecordBatch.from_arrays([texts], ["record"])


def _records_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a split begins with of an earlier one's record, and the record it ends in."""
    for split, opens, closes, texts in _records(batches):
        if not (opens and closes):
            yield pa.RecordBatch.from_arrays([pa.array([split], pa.int64()), pa.array([opens]), texts], ["split", "opens", "part"])


def file_manifest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, size, modified) of landed files. The file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed request payloads, one JSON text per line, as (payload)."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


# How the winner of a storage path is found, beside the run.
CONTENT_KEYS = ["type", "created_date", "storage_path"]


def last_writers(stored: DataFrame) -> DataFrame:
    """Of every storage path the row of the latest run, in it the newest item, and of those the one with the largest id.

    The winners are found on the key columns alone.
    """
    order = ["run", *[c for c in ("created", "request_hash") if c in stored.columns]]
    winners = stored.groupBy(*CONTENT_KEYS).agg(F.max(F.struct(*order)).alias("_last"))
    winners = winners.select(*[F.col(c).alias(f"_{c}") for c in CONTENT_KEYS], "_last")
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in CONTENT_KEYS])
    return stored.join(winners, same & F.struct(*order).eqNullSafe(F.col("_last")), "left_semi")


def runs_since(spark: SparkSession, base: str, before: snapshots.Manifest | None) -> list[str]:
    """Runs that have something in the content folder which the snapshot does not hold, in order."""
    names = {path.rsplit("=", 1)[1] for path in snapshots.children(spark, f"{base}/type=*/created_date=*/run=*")}
    return sorted(names - set(before.covered["runs"] if before else ()))


def read_runs(spark: SparkSession, base: str, runs: list[str]) -> DataFrame:
    globs = [f"{base}/type=*/created_date=*/run={run}" for run in runs]
    return spark.read.option("basePath", base).parquet(*globs).withColumn("run", F.col("run").cast("string"))


def read_content(spark: SparkSession, base: str) -> DataFrame:
    """Table written by write_content, the last writer of each storage path only (`last_writers`).

    Filters on type and created_date prune the folders. After `sinks.compact_content` that is its snapshot as it lies there;
    runs added since are folded over it, without reading the runs it holds.
    """
    before = snapshots.newest(spark, base)
    if before is None:
        return last_writers(spark.read.option("basePath", base).parquet(base)).drop("run")
    fresh = runs_since(spark, base, before)
    if not fresh:
        return before.rows(spark).drop("run")
    return last_writers(before.rows(spark).unionByName(read_runs(spark, base, fresh))).drop("run")
