"""Quality: a compression classifier, zstandard dictionaries of good and of bad text and a calibrated difference.

A text that reads like good ones is compressed better with the dictionary of good ones. The difference of both
compressed sizes, normalised by their sum, and how far the text can be compressed at all go through a logistic
calibration. Dictionaries and calibration are fitted on different halves of the labelled rows, both
ways round; the score is the mean of the two.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.session import materialize

BLOCK = 256  # Bytes compressed at once: within a block a text learns little from itself.
LEVEL = 3
SLICE = 64  # Rows whose texts are held as Python objects.


@dataclass(frozen=True)
class Half:
    """Dictionaries of good and bad text and the calibration found on other rows."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # Constant, difference, ratio, ratio squared.


@dataclass(frozen=True)
class CompressionModel:
    """Score of a text: the mean of its halves' probabilities that its label is 1; without halves, the labels' share."""

    halves: tuple[Half, ...]
    share: float


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def evidence(raw: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[float, float]:
    """(difference of the compressed sizes by their sum, log of the smaller by the text's size); zeros for an empty text."""
    if not raw:
        return 0.0, 0.0
    a = b = 0
    for at in range(0, len(raw), BLOCK):
        block = raw[at : at + BLOCK]
        a += len(good.compress(block))
        b += len(bad.compress(block))
    return (b - a) / (a + b), math.log(min(a, b) / len(raw))


def _terms(difference, ratio) -> np.ndarray:
    return np.stack([np.ones_like(difference), difference, ratio, ratio * ratio], axis=-1)


def _calibrated(difference, ratio, quality, weight, ridge: float = 1e-3, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton's method, ridge on standardised terms, rows weighted."""
    x, w = _terms(difference, ratio), weight / weight.sum()
    middle = (w[:, None] * x).sum(0)
    spread = np.sqrt((w[:, None] * (x - middle) ** 2).sum(0)) + 1e-9
    middle[0], spread[0] = 0.0, 1.0
    z, beta, held = (x - middle) / spread, np.zeros(x.shape[1]), ridge * np.array([0.0, 1, 1, 1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -50, 50)))
        slope = z.T @ (w * (p - quality)) + held * beta
        curve = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(held + 1e-9)
        beta = beta - np.linalg.solve(curve, slope)
    beta = beta / spread
    beta[0] -= (beta[1:] * middle[1:]).sum()
    return tuple(float(b) for b in beta)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is not learnt from: crc32 of the id as text is a multiple of `folds`, or there is no id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == 0, F.lit(True))


def _blocks(batches):
    """(quality, half, block) of labelled texts."""
    for batch in batches:
        for i in range(batch.num_rows):
            quality, half, text = (batch.column(c)[i].as_py() for c in ("quality", "half", "text"))
            raw = (text or "").encode()
            blocks = [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]
            for low in range(0, len(blocks), 4096):
                some = blocks[low : low + 4096]
                kinds = [pa.array([v] * len(some), pa.int32()) for v in (quality, half)]
                yield pa.RecordBatch.from_arrays([*kinds, pa.array(some, pa.binary())], ["quality", "half", "block"])


def _measured(dictionaries: dict[int, tuple[bytes, bytes]]):
    """(quality, half, difference, ratio) of labelled texts, with the dictionaries of the other half."""

    def run(batches):
        tools = {half: tuple(map(_compressor, d)) for half, d in dictionaries.items()}
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                quality, half, text = (batch.column(c)[i].as_py() for c in ("quality", "half", "text"))
                if 1 - half in tools:
                    out.append((quality, half, *evidence((text or "").encode(), *tools[1 - half])))
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
            names = ["quality", "half", "difference", "ratio"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)

    return run


def fit(
    documents: DataFrame,
    labels: DataFrame,
    rows_per_class: int = 4_000,
    blocks_per_class: int = 8_192,
    dictionary_bytes: int = 1 << 16,
) -> CompressionModel:
    """Fits on the documents (doc_id, text) that `labels` (doc_id, quality 0 or 1) marks and `held_out` does not hold.

    The sample is bounded: at most `rows_per_class` ids of either label that have a document, by a hash of the
    id, and of each half of them `blocks_per_class` blocks by a hash of the block; the calibration weighs classes back
    to the shares of all usable labels. Several labels for an id: the highest counts. NULL ids, NULL labels and
    ids without a document do not count. Without rows of both classes the score is the share of label 1 (0.5 without any).
    """
    usable = labels.where(~held_out(F.col("doc_id"))).select("doc_id", (F.col("quality") > 0).cast("int").alias("quality"))
    usable = usable.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    usable = materialize(usable.join(documents.select("doc_id"), "doc_id", "left_semi"), "labels")
    totals = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    if len(totals) < 2:
        return CompressionModel((), share)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [usable.where(F.col("quality") == q).orderBy(*order).limit(rows_per_class) for q in (0, 1)]
    sample = parts[0].unionByName(parts[1])
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int").alias("half")
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    texts = materialize(texts.select("quality", half, "text"), "labelled")
    blocks = materialize(texts.mapInArrow(_blocks, "quality int, half int, block binary"), "blocks")
    dictionaries = {}
    for h in (0, 1):
        of_class = []
        for q in (1, 0):
            own = blocks.where((F.col("half") == h) & (F.col("quality") == q))
            own = own.orderBy(F.xxhash64("block"), "block").limit(blocks_per_class)
            of_class.append(_dictionary([bytes(r["block"]) for r in own.collect()], dictionary_bytes))
        if all(of_class):
            dictionaries[h] = tuple(of_class)
    found = texts.mapInArrow(_measured(dictionaries), "quality int, half int, difference double, ratio double").collect()
    halves = []
    for h, (good, bad) in dictionaries.items():
        rows = [r for r in found if r["half"] == 1 - h]
        if len({r["quality"] for r in rows}) < 2:
            continue
        difference, ratio, quality = (np.array([r[c] for r in rows], float) for c in ("difference", "ratio", "quality"))
        weight = np.where(quality > 0, *(totals[q] / (quality == q).sum() for q in (1, 0)))
        halves.append(Half(good, bad, _calibrated(difference, ratio, quality, weight)))
    return CompressionModel(tuple(halves), share)


def _dictionary(blocks: list[bytes], size: int) -> bytes:
    """A trained dictionary; with too little text for one, the text itself."""
    total = sum(map(len, blocks))
    try:
        return zstandard.train_dictionary(max(256, min(size, total // 2)), blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-size:]


def score(documents: DataFrame, model: CompressionModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of (doc_id, text), a row for each; predicted is 1 from `threshold` on.

    The score, 0 to 1, is how likely the label is 1 by the whole text alone. NULL counts as empty; an empty
    text has the score that its evidence, zeros, gets. Equal texts have equal scores; an empty table gives no rows;
    other columns are not looked at.
    """

    def run(batches):
        tools = [(_compressor(h.good), _compressor(h.bad), np.array(h.weights)) for h in model.halves]
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                scores = np.zeros(part.num_rows)
                raws = (text.as_py() for text in part.column(1))
                for i, raw in enumerate((t or "").encode() for t in raws):
                    terms = ((_terms(*map(np.float64, evidence(raw, good, bad))) @ w) for good, bad, w in tools)
                    each = [1 / (1 + math.exp(-min(50.0, max(-50.0, t)))) for t in terms]
                    scores[i] = sum(each) / len(each) if each else model.share
                columns = [part.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
