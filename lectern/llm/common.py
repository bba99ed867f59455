"""Helpers shared by the operators of this subpackage."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what a word is, wherever a contract speaks of words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) of `df`, without any other column whose name could clash; a NULL text stays NULL."""
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )


def text_hash(text: Column) -> Column:
    """128 bits that stand for the text itself; NULL has a hash of its own."""
    return F.when(text.isNull(), F.lit("")).otherwise(F.md5(F.encode(text, "UTF-8")))


def pieces_for(df: DataFrame, bytes_each: int, least: int, text_column: str = "text") -> int:
    """Number of pieces of about `bytes_each` bytes of text, by one scan that sums the lengths.

    Only balance depends on it, never a result.
    """
    size = df.agg(F.sum(F.octet_length(text_column).cast("long") + 64)).first()[0] or 0
    return max(least, size // bytes_each + 1)


def pieces_of_rows(df: DataFrame, rows_each: int, least: int) -> int:
    """Number of pieces of about `rows_each` rows of a written table."""
    return max(least, df.count() // rows_each + 1)


def pack(values: np.ndarray) -> bytes:
    """An array of numbers in a compressed block, first bytes first; its type and length go along."""
    head = f"{values.dtype.str}:{len(values)}:".encode()
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return head + zstandard.compress(planes.tobytes(), 1)


def unpack(block: bytes) -> np.ndarray:
    kind, count, rest = bytes(block).split(b":", 2)
    kind, count = np.dtype(kind.decode()), int(count)
    raw = zstandard.decompress(rest, max_output_size=max(1, count * kind.itemsize))
    planes = np.frombuffer(raw, np.uint8).reshape(kind.itemsize, count)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """A rising array of unsigned 64-bit integers: the first one and the differences, narrow where they can be."""
    steps = np.diff(values.astype("<u8"))
    if len(steps) and steps.max() < 1 << 32:
        steps = steps.astype("<u4")
    return joined(pack(values[:1].astype("<u8")), pack(steps))


def unpack_sorted(block: bytes) -> np.ndarray:
    first, steps = map(unpack, parted(block))
    return np.cumsum(np.concatenate([first, steps.astype("<u8")]), dtype=np.uint64)


def joined(*parts: bytes) -> bytes:
    """Several blocks as one."""
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def parted(block: bytes) -> list[bytes]:
    """The blocks that `joined` put together."""
    out, at = [], 0
    while at < len(block):
        size = int.from_bytes(block[at : at + 4], "little")
        out.append(block[at + 4 : at + 4 + size])
        at += 4 + size
    return out


def slices(batches: Iterator[pa.RecordBatch], text_column: int, rows: int = 512, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows, and of about `size` bytes of text unless one row has more."""
    for batch in batches:
        low = 0
        lengths = np.array(pc.fill_null(pc.binary_length(batch.column(text_column)), 0), np.int64) if batch.num_rows else ()
        ends = np.cumsum(lengths)
        while low < batch.num_rows:
            before = int(ends[low - 1]) if low else 0
            high = int(np.searchsorted(ends, before + size, "right"))
            high = min(max(high, low + 1), low + rows, batch.num_rows)
            yield batch.slice(low, high - low)
            low = high


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Values of the named columns, row by row."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)
