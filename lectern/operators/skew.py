"""Joins that stay balanced when a few keys own most of the rows."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.session import checkpointed

# A key is hot when it owns more than this share of the rows, so there are at most 1 / share of them,
# and more rows than one task should work on anyway.
HOT_SHARE = 0.0001
HOT_ROWS = 10_000

# Bytes a broadcast row takes besides its strings.
ROW_BYTES = 32


def row_bytes(*columns: str) -> Column:
    """Size of a row of the given columns as a broadcast counts it, roughly."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint") for c in columns]
    return sum(sizes, F.lit(ROW_BYTES).cast("bigint"))


@dataclass(frozen=True)
class KeyCounts:
    """Rows per key of a table, counted once: `table` holds (key, n), NULL among the keys."""

    table: DataFrame
    key: str
    rows: int
    largest: int
    distinct_bytes: int

    def small_keys(self, max_bytes: int) -> DataFrame | None:
        """The distinct keys, marked for broadcast, or None when they are more than `max_bytes`."""
        if self.distinct_bytes > max_bytes:
            return None
        return F.broadcast(self.table.where(F.col(self.key).isNotNull()).select(self.key))

    def hot_keys(self, share: float = HOT_SHARE, min_rows: int = HOT_ROWS) -> DataFrame | None:
        """(key, pieces) of the keys with more than `share` of the rows; None without any.

        A piece is as large as a key may be without being hot, so there are at most 1 / share keys and
        2 / share pieces.
        """
        limit = max(share * self.rows, min_rows, 1)
        if self.largest <= limit:
            return None
        pieces = F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("pieces")
        return self.table.where(F.col("n") > limit).select(self.key, pieces)


def count_keys(df: DataFrame, key: str) -> KeyCounts:
    """Counts the rows per key: one pass over the key column, partial counts before the shuffle."""
    table = checkpointed(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    sizes = table.agg(
        F.sum("n").alias("rows"), F.max("n").alias("largest"), F.sum(row_bytes(key)).alias("bytes")
    ).first()
    return KeyCounts(table, key, sizes["rows"] or 0, sizes["largest"] or 0, sizes["bytes"] or 0)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: list[str | Column],
    how: str = "left",
    counts: KeyCounts | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi join whose hot keys of `left` are cut into pieces that go to different tasks.

    The keys of `left` are counted first (or given as `counts`). Without a hot key this is the plain
    join. Otherwise rows of a hot key get a piece number from `spread_by`, and what `right` has for
    that key is repeated per piece; rows without a key match nothing and are spread as well. The list
    of hot keys is short by construction and therefore broadcast.
    """
    counts = counts or count_keys(left, key)
    hot = counts.hot_keys(share, min_rows)
    if hot is None:
        return left.join(right, key, how)
    hot = F.broadcast(hot.where(F.col(key).isNotNull()).withColumnRenamed("pieces", "_pieces"))
    spread = F.xxhash64(*spread_by)
    piece = (
        F.when(F.col(key).isNull(), F.pmod(spread, F.lit(int(1 / share))))
        .when(F.col("_pieces").isNotNull(), F.pmod(spread, F.col("_pieces")))
        .otherwise(F.lit(0))
        .cast("int")
    )
    pieces = F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    salted = left.join(hot, key, "left").withColumn("_piece", piece).drop("_pieces")
    repeated = right.join(hot, key, "left").withColumn("_piece", F.explode(pieces)).drop("_pieces")
    return salted.join(repeated, [key, "_piece"], how).drop("_piece")
