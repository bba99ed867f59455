"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, as products of sparse matrices.

A text's tokens in vocabulary A and in vocabulary B are rows of two token-byte incidence matrices. Their
product A * B^T has an entry where two tokens overlap. Tokens tile the text, so the overlap links climb like a
staircase; where a step changes both tokens, both end at the same byte and a group ends. With the tokens of equal id put
together, the product of the two group incidences then holds every link inside a group, and how often. All
products go row by row (Gustavson) over compressed rows made here.
"""

import base64
import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lectern.llm.common import joined, pack, pack_sorted, parted, unpack, unpack_sorted
from lectern.session import materialize

CHUNK_BYTES = 16 << 20  # Texts whose links are put together before they are counted.
BATCH_BYTES = 1 << 20  # Texts that are multiplied at once.
SEGMENT = 1 << 20  # Characters from which on a text is cut at a place where both vocabularies end a token.
TERMS = 1 << 21  # Terms of a product that are expanded at once.
B_BITS = 16  # A pair of ids as one number: A's id above, B's in these bits.

# Between two characters that are no space, neither vocabulary has a token across a single space's left edge.
CUT = re.compile(r"\S(?= \S)")


@dataclass(frozen=True)
class Vocabularies:
    """Both vocabularies by the places of their files: A by ranks and, for what the fast encoder refuses, by its JSON."""

    ranks_path: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    json_path: str = public_tokenizers.path("byte_bpe_50k.json")
    model_path: str = public_tokenizers.path("piece_bpe_32k.model")
    pattern: str = public_tokenizers.PATTERN


class Encoders:
    """Ids of both vocabularies and the bytes of every id."""

    def __init__(self, vocabularies: Vocabularies):
        with open(vocabularies.ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=vocabularies.pattern, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.slow = vocabularies.json_path, None
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=vocabularies.model_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in names
        ]
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.a_bytes[i] = raw
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # Long texts may be cut before a space only if no piece has one after another character.
        self.may_cut = not any(re.search("[^▁]▁", p) for p in names)
        inside, last = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))], len(self.a_bytes)
        # What a token adds to the text of the groups: the id and a comma, or what ends its side of a group.
        self.names = [x + "," for x in inside] + [x + "|" for x in inside[:last]] + [x + ";" for x in inside[: len(self.b_bytes)]]
        self.ends_a, self.ends_b = len(inside), len(inside) + last

    def a(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as refused:
            # Its pattern engine gives up on very long runs of white space by a panic, which is no Exception.
            if type(refused).__name__ != "PanicException":
                raise
        if self.slow is None:
            self.slow = Tokenizer.from_file(self.json_path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def segments(self, text: str) -> list[str]:
        """`text`, which starts with a space, in pieces that start with a space and whose tokens do not depend on each other."""
        if len(text) < 2 * SEGMENT or not self.may_cut:
            return [text]
        out, start = [], 0
        while len(text) - start >= 2 * SEGMENT and (cut := CUT.search(text, start + SEGMENT)):
            out.append(text[start : cut.end()])
            start = cut.end()
        return [*out, text[start:]]

    def tokens(self, text: str) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per segment of " " + text the ids of A and of B; none where the joined bytes of either differ from the text's."""
        out = []
        for segment in self.segments(" " + text) if text else ():
            a, b, raw = self.a(segment), self.pieces.encode(segment[1:]), segment.encode()
            if b"".join(map(self.b_bytes.__getitem__, b)) != raw or b"".join(map(self.a_bytes.__getitem__, a)) != raw:
                return []
            out.append((np.array(a, np.int64), np.array(b, np.int64)))
        return out


@lru_cache(maxsize=2)
def encoders(vocabularies: Vocabularies) -> Encoders:
    return Encoders(vocabularies)


@dataclass
class Csr:
    """Compressed rows: the columns and values of row i are at starts[i] to starts[i + 1]."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> "Csr":
        """From entries in order of row and column."""
        return Csr(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=shape[0]))]), columns, values, shape[1])

    def transposed(self) -> "Csr":
        order = np.argsort(self.columns, kind="stable")
        return Csr.of(self.columns[order], self.rows[order], self.values[order], (self.width, len(self.starts) - 1))

    def times(self, other: "Csr") -> "Csr":
        """The product by Gustavson: each entry of a row brings in a row of `other`, equal columns are summed."""
        sizes = np.diff(other.starts)[self.columns]
        rows, parts = self.rows, []
        before = np.concatenate([[0], np.cumsum(sizes)])
        low, n = 0, len(self.starts) - 1
        # Whole rows of this matrix at a time, so that no more than TERMS terms (or one row's) are held.
        while low < n:
            target = before[self.starts[low]] + TERMS
            high = max(low + 1, int(np.searchsorted(before[self.starts], target, "right")) - 1)
            some = slice(int(self.starts[low]), int(self.starts[high]))
            size = sizes[some]
            total = int(size.sum())
            shift = other.starts[self.columns[some]] - (np.cumsum(size) - size)
            source = np.repeat(shift, size) + np.arange(total)
            key = np.repeat(rows[some], size) * other.width + other.columns[source]
            value = np.repeat(self.values[some], size) * other.values[source]
            if total and (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.zeros(0, int)
            parts.append((key[heads], np.add.reduceat(value, heads) if total else value))
            low = high
        key = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        value = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        return Csr.of(key // other.width, key % other.width, value, (n, other.width))


def byte_incidence(sizes: np.ndarray) -> Csr:
    """Tokens by bytes: which bytes each token of `sizes` bytes covers, one after the other."""
    total = int(sizes.sum())
    return Csr(np.concatenate([[0], np.cumsum(sizes)]), np.arange(total), np.ones(total, np.int64), total)


def overlaps(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Csr:
    """Tokens of A by tokens of B: how many bytes they share, of tokens that tile the same bytes."""
    return byte_incidence(a_sizes).times(byte_incidence(b_sizes).transposed())


def groups(links: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A token and of every B token, counted from 0, from their overlaps."""
    rows, columns = links.rows, links.columns
    ends = (rows[1:] != rows[:-1]) & (columns[1:] != columns[:-1])
    group = np.concatenate([[0], np.cumsum(ends)]) if len(rows) else rows
    of_b = np.zeros(links.width, np.int64)
    of_b[columns] = group
    return group[links.starts[:-1]], of_b


def _counted(high: np.ndarray, middle: np.ndarray, low: np.ndarray, bits: tuple[int, int]):
    """Distinct triples in order and how often each occurs; `bits` bound the last two."""
    key, n = np.unique((((high << bits[0]) | middle) << bits[1]) | low, return_counts=True)
    return key >> (bits[0] + bits[1]), (key >> bits[1]) & ((1 << bits[0]) - 1), key & ((1 << bits[1]) - 1), n


def shared_groups(document, a, group_a, b, group_b, n_groups: int):
    """Every pair of ids that shares a group, by document: (document, pair, how many links of it)."""
    span = max(1, int(n_groups - 1).bit_length())
    doc, ids, group, n = _counted(document, a, group_a, (B_BITS, span))
    row_key = (doc << B_BITS) | ids
    heads = np.flatnonzero(np.concatenate([[True], row_key[1:] != row_key[:-1]])) if len(row_key) else row_key
    row = np.cumsum(np.concatenate([[0], (row_key[1:] != row_key[:-1]).astype(np.int64)])) if len(row_key) else row_key
    left = Csr.of(row, group, n, (len(heads), n_groups))
    _, group, ids, n = _counted(np.zeros(len(b), np.int64), group_b, b, (span, B_BITS))
    product = left.times(Csr.of(group, ids, n, (n_groups, 1 << B_BITS)))
    key = row_key[heads][product.rows]
    return key >> B_BITS, ((key & ((1 << B_BITS) - 1)) << B_BITS) | product.columns, product.values


class _Chunk:
    """Documents of a chunk while they are read."""

    def __init__(self, tools: Encoders):
        self.tools = tools
        self.ids, self.hashes, self.sizes = [], [], []  # per document; sizes: tokens of A, of B, groups
        self.open, self.open_bytes, self.bytes = [], 0, 0
        self.found, self.first_open = [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        number = len(self.ids)
        segments = self.tools.tokens(text)
        self.ids.append(doc_id)
        self.hashes.append(hashlib.sha256() if segments else None)
        self.sizes.append([0, 0, 0])
        for a, b in segments:
            self.open.append((number, a, b))
            self.open_bytes += 4 * (len(a) + len(b))
            if self.open_bytes >= BATCH_BYTES:
                self.multiply()
        self.bytes += 64 + len(text)

    def multiply(self) -> None:
        if not self.open:
            return
        tools = self.tools
        numbers = np.array([x[0] for x in self.open])
        n_a, n_b = (np.array([len(x[i]) for x in self.open]) for i in (1, 2))
        a, b = (np.concatenate([x[i] for x in self.open]) for i in (1, 2))
        group_a, group_b = groups(overlaps(tools.a_sizes[a], tools.b_sizes[b]))
        n_groups = int(group_a[-1]) + 1
        self.found.append(shared_groups(np.repeat(numbers, n_a), a, group_a, b, group_b, n_groups))
        # The groups as text: A's ids of a group, then B's.
        last_a, last_b = (np.concatenate([g[1:] != g[:-1], [True]]) for g in (group_a, group_b))
        code = np.concatenate([a + tools.ends_a * last_a, b + tools.ends_b * last_b])
        side = np.concatenate([2 * group_a, 2 * group_b + 1])
        words = list(map(tools.names.__getitem__, code[np.argsort(side, kind="stable")].tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        firsts, lasts = group_a[np.cumsum(n_a) - n_a].tolist(), group_a[np.cumsum(n_a) - 1].tolist()
        for i, (number, own_a, own_b) in enumerate(self.open):
            size, begun = self.sizes[number], self.sizes[number][2] > 0
            text = "".join(words[ends[i - 1] if i else 0 : ends[i]])[:-1]
            self.hashes[number].update((";" * begun + text).encode())
            size[0] += len(own_a)
            size[1] += len(own_b)
            size[2] += lasts[i] - firsts[i] + 1
        self.open, self.open_bytes = [], 0

    def row(self, number: int) -> pa.RecordBatch:
        self.multiply()
        parts = [np.concatenate([f[i] for f in self.found]) if self.found else np.zeros(0, np.int64) for i in range(3)]
        document, pair, times = parts
        # The segments of a long text may have met the same pair in several products.
        key = (document << 32) | pair
        if (key[1:] <= key[:-1]).any():
            key, where = np.unique(key, return_inverse=True)
            times = np.bincount(where, times).astype(np.int64)
            document, pair = key >> 32, key & 0xFFFFFFFF
        pairs, at, documents = np.unique(pair, return_inverse=True, return_counts=True)
        starts = np.concatenate([[0], np.cumsum(np.bincount(document, minlength=len(self.ids)))])
        sizes = np.array(self.sizes, np.int64).reshape(-1, 3)
        digests = b"".join(h.digest() if h else bytes(32) for h in self.hashes)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        none = np.array([i is None for i in self.ids], np.uint8)
        blocks = [ids, none, sizes.reshape(-1), starts, at.astype(np.uint32), _narrow(times), np.frombuffer(digests, np.uint8)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([joined(*map(pack, blocks))], pa.binary()),
                pa.array([joined(pack_sorted(pairs.astype(np.uint64)), pack(_narrow(documents)))], pa.binary()),
            ],
            ["chunk", "links", "pairs"],
        )


def _narrow(values: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _chunks(vocabularies: Vocabularies, chunk_bytes: int):
    def run(batches):
        tools = encoders(vocabularies)
        number, chunk = TaskContext.get().partitionId() << 32, _Chunk(tools)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                chunk.add(ids[i].as_py(), texts[i].as_py() or "")
                if chunk.bytes >= chunk_bytes:
                    yield chunk.row(number)
                    number, chunk = number + 1, _Chunk(tools)
        if chunk.ids:
            yield chunk.row(number)

    return run


def _pairs(batches):
    """A row per chunk and pair: in how many of its documents the pair is linked."""
    for batch in batches:
        for number, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            pairs, documents = parted(block)
            pairs, documents = unpack_sorted(pairs).astype(np.int64), unpack(documents).astype(np.int64)
            for low in range(0, len(pairs), 1 << 16):
                part = slice(low, low + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs[part]), number)), pa.array(pairs[part]), pa.array(documents[part])],
                    ["chunk", "pair", "n"],
                )


def _summed(key, chunk: pa.Table, counted: pa.Table) -> pa.Table:
    """Per document of a chunk: its row of links times the columns of the pairs' counts and of their being best."""
    ids, none, sizes, starts, at, times, digests = (unpack(x) for x in parted(chunk.column("links")[0].as_py()))
    order = np.argsort(counted.column("pair").to_numpy())
    count = counted.column("count").to_numpy()[order]
    best = counted.column("best").to_numpy(zero_copy_only=False)[order]
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[starts])
    times, sizes = times.astype(np.int64), sizes.reshape(-1, 3)
    raw = digests.tobytes()
    hashes = [raw[32 * i : 32 * i + 32].hex() if sizes[i, 0] else "" for i in range(len(ids))]
    columns = [sizes[:, 0], sizes[:, 1], sizes[:, 2], sums(times), sums(times * best[at]), sums(times * count[at])]
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64(), mask=none.astype(bool)),
            **{n: pa.array(x, pa.int64()) for n, x in zip(NUMBERS, columns, strict=True)},
            "groups_sha256": pa.array(hashes, pa.string()),
        }
    )


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(documents: DataFrame, vocabularies: Vocabularies | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of (doc_id, text), a row for each.

    A encodes a space and the text, B the text, to which it adds the space; special tokens' strings are
    plain text. Where the tokens of both end, a group ends; n_links counts the pairs of an A and a B token of one group.
    A pair of ids counts in as many rows of the whole input as have it linked: count_sum adds that up over
    links, n_best tells the links whose pair has the highest count of its A id, ties included. groups_sha256 is the hash of
    "a1,a2|b1;a3|b2,b3". NULL and empty texts, and those that the vocabularies do not give back byte by
    byte, have no tokens: zeros and ''. Repeated rows and ids count each; an empty table gives no rows; other columns are not looked at.

    Links stay with their chunk of texts as a sparse matrix of documents by distinct pairs; what is counted over
    all chunks is one row per chunk and pair, and a chunk gets one row per pair back.
    """
    texts = documents.select("doc_id", "text")
    chunks = texts.mapInArrow(_chunks(vocabularies or Vocabularies(), chunk_bytes), "chunk long, links binary, pairs binary")
    chunks = materialize(chunks, "links")
    rows = chunks.select("chunk", "pairs").mapInArrow(_pairs, "chunk long, pair long, n long")
    counts = materialize(rows.groupBy("pair").agg(F.sum("n").alias("count")), "counts")
    a = F.shiftright("pair", B_BITS)
    # One row per A id: as many as the vocabulary has.
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    counts = counts.withColumn("a", a).join(F.broadcast(highest), "a")
    counts = counts.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = rows.select("chunk", "pair").join(counts, "pair").select("chunk", "pair", "count", "best")
    schema = ", ".join(f"{n} long" for n in ("doc_id", *NUMBERS)) + ", groups_sha256 string"
    together = chunks.select("chunk", "links").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return together.applyInArrow(_summed, schema)


def links(text: str, vocabularies: Vocabularies | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """One text's overlap links (A token, B token, shared bytes) and group links (A token, B token), by token position."""
    tools = encoders(vocabularies or Vocabularies())
    segments = tools.tokens(text)
    if not segments:
        return [], []
    a, b = (np.concatenate([s[i] for s in segments]) for i in (0, 1))
    shared = overlaps(tools.a_sizes[a], tools.b_sizes[b])
    group_a, group_b = groups(shared)
    one = lambda g: Csr.of(np.arange(len(g)), g, np.ones(len(g), np.int64), (len(g), int(group_a[-1]) + 1))
    both = one(group_a).times(one(group_b).transposed())
    overlapping = list(zip(shared.rows.tolist(), shared.columns.tolist(), shared.values.tolist(), strict=True))
    return overlapping, list(zip(both.rows.tolist(), both.columns.tolist(), strict=True))
