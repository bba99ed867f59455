"""Packing: documents in the order of a space-filling curve, laid end to end into sequences."""

import base64
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import pieces_of_rows, rows_of, slices
from lectern.session import materialize

# The separator's text and id in this vocabulary, and the id that ends a document.
SEPARATOR, SEPARATOR_ID, END_ID = "<|endoftext|>", 50256, 1

DIMENSIONS, BITS = 3, 10

# Texts or ids that a task holds as Python objects at a time.
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE vocabulary by the place of its ranks file."""

    ranks_path: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def _encoder(vocabulary: Vocabulary) -> tiktoken.Encoding:
    with open(vocabulary.ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, vocabulary: Vocabulary) -> np.ndarray:
    """Ids of a whole text, then END_ID; the same ids as the tokenizers library gives."""
    encoder = _encoder(vocabulary)
    ids = encoder.encode_ordinary(text) if SEPARATOR not in text else []
    if SEPARATOR in text:
        for i, part in enumerate(text.split(SEPARATOR)):
            ids += [SEPARATOR_ID] * (i > 0) + encoder.encode_ordinary(part)
    ids.append(END_ID)
    return np.array(ids, dtype="<u2")


@lru_cache(maxsize=4)
def _signs(size: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0], dtype=np.float32), (size, DIMENSIONS))


def project(ids: np.ndarray, seed: int = 7) -> np.ndarray:
    """The document's vector of token counts, hashed to a few dimensions and put on a grid."""
    seen, counts = np.unique(ids, return_counts=True)
    spot = counts @ _signs(1 << 16, seed)[seen] / np.sqrt((counts.astype(float) ** 2).sum())
    cells = 1 << BITS
    return np.clip((spot + 4) / 8 * cells, 0, cells - 1).astype(np.int64)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each grid cell (a row of `cells`) on the Hilbert curve."""
    x = cells.T.copy()
    n = len(x)
    # From coordinates to the transposed index: undo the rotations, level by level from the top.
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            set_ = (x[i] & level) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap if i else 0
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((x[n - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _tokenised(vocabulary: Vocabulary):
    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices([batch], 1, size=SLICE_BYTES):
                ids = [encode(text or "", vocabulary) for text in part.column(1).to_pylist()]
                keys = hilbert_key(np.array([project(x) for x in ids]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(row, row + len(ids)), pa.int64()),
                        part.column(0),
                        pa.array(keys, pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                    ],
                    ["row", "doc_id", "curve", "n", "ids"],
                )
                row += len(ids)

    return run


def _running(batches):
    """Tokens before each row within its range of the curve."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(1).to_numpy()
        starts = before + np.cumsum(n) - n
        before += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([part] * len(n), pa.int32()), pa.array(starts, pa.int64()), batch.column(1)],
            ["row", "part", "before", "n"],
        )


PIECES = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "sequence_id", "offset", "doc_tokens")] + [("ids", pa.binary())]
)


def _pieces(length: int):
    # What a slice of rows is cut into goes out before the next one is looked at, a long document's pieces in several batches.
    most = max(1, SLICE_BYTES // (4 * length))

    def run(batches):
        for part in (part for batch in batches for part in slices([batch], batch.schema.get_field_index("ids"), size=SLICE_BYTES)):
            out = []
            for doc_id, at, block in rows_of([part], "doc_id", "at", "ids"):
                ids = np.frombuffer(block, "<u2")
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(at + start, length)
                    end = min(len(ids), start + length - offset)
                    out.append((doc_id, start, end - start, sequence, offset, len(ids), ids[start:end].astype("<u4").tobytes()))
                    start = end
                    if len(out) >= most:
                        yield _batch(out)
                        out = []
            if out:
                yield _batch(out)

    return run


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pieces], f.type) for i, f in enumerate(PIECES)], schema=PIECES)


def pack(documents: DataFrame, length: int = 2048, vocabulary: Vocabulary | None = None) -> DataFrame:
    """One row per piece: (doc_id, start, length, sequence_id, offset, doc_tokens, ids).

    Takes (doc_id, text); NULL texts count as empty and have the ending id only. Documents follow each
    other by the Hilbert key of their projected token counts (then doc_id) without a gap, cut where a
    sequence is full: every sequence but the last has `length` ids. ids: the piece's ids, little-endian
    unsigned 32-bit. Repeated rows are packed each; an empty table gives no rows.
    """
    vocabulary = vocabulary or Vocabulary()
    texts = documents.select("doc_id", "text")
    tokens = texts.mapInArrow(_tokenised(vocabulary), "row long, doc_id long, curve long, n long, ids binary")
    tokens = materialize(tokens, "tokens")
    ranges = pieces_of_rows(tokens, 100_000, 4)
    ordered = tokens.select("row", "n", "curve", "doc_id").repartitionByRange(ranges, "curve", "doc_id", "row")
    ordered = ordered.sortWithinPartitions("curve", "doc_id", "row").select("row", "n")
    placed = materialize(ordered.mapInArrow(_running, "row long, part int, before long, n long"), "order")
    # One row per range of the curve.
    sums, starts, total = placed.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect(), [], 0
    for r in sums:
        starts.append((r["part"], total))
        total += r["n"]
    starts = placed.sparkSession.createDataFrame(starts, "part int, first long")
    at = placed.join(F.broadcast(starts), "part").select("row", (F.col("first") + F.col("before")).alias("at"))
    # The places are narrow; so the ids are neither sorted nor held, only dealt.
    located = tokens.select("row", "doc_id", "ids").join(at.hint("shuffle_hash"), "row").select("doc_id", "at", "ids")
    return located.mapInArrow(
        _pieces(length),
        "doc_id long, start long, length long, sequence_id long, offset long, doc_tokens long, ids binary",
    )


def with_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with ids_crc32 (unsigned) in place of their ids."""
    kept = [c for c in pieces.columns if c != "ids"]
    return pieces.select(*kept, F.crc32("ids").alias("ids_crc32"))


def digest_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
