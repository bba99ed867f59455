"""Sharding: longest-processing-time scheduling of groups that stay together."""

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lectern.llm.common import pieces_of_rows, text_hash
from lectern.session import materialize

# Bundles that small groups are gathered in; a group at least as large as a mean bundle is scheduled
# by itself, so there are at most twice as many items to schedule, whatever the input.
BUNDLES = 1 << 13


def schedule(sizes: dict, n_shards: int) -> dict:
    """Longest first, each item to the least-loaded shard (the lowest number among equals)."""
    loads = [(0, shard) for shard in range(n_shards)]
    placed = {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], str(x[0]))):
        load, shard = heapq.heappop(loads)
        placed[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def shard(rows: DataFrame, n_shards: int = 8, bundles: int = BUNDLES) -> DataFrame:
    """Adds `shard` and `slot` to `rows` (group string, size long, order long, ...).

    All rows of a group go to one shard. Groups of at least the mean size of a bundle are items of
    their own; smaller ones are bundled by a hash of the group. Longest-processing-time scheduling
    of these items, at most 2 * `bundles` of them, runs on the driver; rows never go there. A shard's
    load is above the mean by less than the largest item. `slot` numbers a shard's rows from 0 without
    gaps. NULL groups are one group, NULL sizes count 0, an empty table stays empty; rows that are
    equal in every column get different slots. Given columns called shard or slot are replaced, all others stay.
    """
    # The given columns stay in a struct, so that none can have a name that is used here.
    columns = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.coalesce("group", F.lit("")).alias("group"), "size", "order")
    totals = rows.groupBy("group").agg(F.sum(F.coalesce("size", F.lit(0))).alias("bytes"))
    totals = materialize(totals, "groups")
    whole = totals.agg(F.sum("bytes")).first()[0] or 0
    least = max(1, -(-whole // bundles))
    bundle = F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("int")
    large = totals.where(F.col("bytes") >= least).select("group", "bytes").collect()
    small = totals.where(F.col("bytes") < least).groupBy(bundle.alias("b")).agg(F.sum("bytes").alias("bytes")).collect()
    placed = schedule({r["group"]: r["bytes"] for r in large} | {r["b"]: r["bytes"] for r in small}, n_shards)
    spark = rows.sparkSession
    alone = spark.createDataFrame(
        [(k, v) for k, v in placed.items() if isinstance(k, str)],
        T.StructType([T.StructField("group", T.StringType()), T.StructField("_own", T.IntegerType())]),
    )
    together = spark.createDataFrame(
        [(k, v) for k, v in placed.items() if isinstance(k, int)],
        T.StructType([T.StructField("_bundle", T.IntegerType()), T.StructField("_shared", T.IntegerType())]),
    )
    put = rows.withColumn("_bundle", bundle).join(F.broadcast(alone), "group", "left")
    put = put.join(F.broadcast(together), "_bundle", "left")
    put = put.withColumn("shard", F.coalesce("_own", "_shared")).drop("_own", "_shared", "_bundle")
    return numbered(put, pieces_of_rows(rows, 50_000, 16)).select("row.*", "shard", "slot")


def numbered(rows: DataFrame, bins: int) -> DataFrame:
    """Adds `slot`: 0, 1, 2 ... within each `shard`, counted over bins of rows rather than whole shards."""
    binned = rows.withColumn("_bin", F.pmod(F.xxhash64("order", "group"), F.lit(bins)))
    counts = binned.groupBy("shard", "_bin").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_bin").orderBy("order", "group")
    ranked = binned.withColumn("_rank", F.row_number().over(within) - 1)
    return ranked.join(starts, ["shard", "_bin"]).withColumn("slot", F.col("_start") + F.col("_rank")).drop(
        "_bin", "_start", "_rank"
    )


def shard_texts(documents: DataFrame, n_shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of (doc_id, text); equal texts form a group.

    size: UTF-8 bytes plus 1; NULL counts as no bytes and is a group apart from the empty text.
    """
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    light = documents.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        text_hash(F.col("text")).alias("group"),
        F.col("doc_id").alias("order"),
    )
    return shard(materialize(light, "sizes"), n_shards).drop("group", "order")
