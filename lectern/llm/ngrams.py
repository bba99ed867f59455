"""LM scoring: n-gram probabilities in Elias-Fano tries, one per shard of contexts.

A word's id is its rank by frequency within its shard of words, interleaved over the shards, so
frequent words have small ids. A trie has three levels: first words, their successors, and the successors of
both; each level is a rising sequence, because a word's number is added to a base that grows
from context to context. Levels of pointers say where the successors of a context begin, and a word is
searched among those only. All sequences, pointers included, are Elias-Fano coded and read without unpacking;
smoothed probabilities are quantised to 16 bits.
"""

import mmap
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.chunks import NO_ID, Chunk, ask, by_shard, chunked, finish, shard_count, with_replies
from lectern.llm.common import joined, pack, pack_sorted, parted, unpack, unpack_sorted

END = b"\n"  # No word has white space, so this is none.
ADDED = 0.1
STEPS = 4096  # Quantisation steps of a power of ten.
U32 = np.uint64(32)


_BYTES = np.arange(256, dtype=np.uint8)
_SET = np.unpackbits(_BYTES[:, None], axis=1, bitorder="little")
# Place of the set bit with each rank in every byte; 0 where it has fewer.
_PLACE = np.array([np.pad(np.flatnonzero(bits), (0, 8 - int(bits.sum()))) for bits in _SET], np.uint8)


_EACH = np.uint64(0x0101010101010101)
_TOP = np.uint64(0x8080808080808080)


def _bit_with_rank(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit that has `rank` set bits below it in each 64-bit word."""
    rank = rank.astype(np.uint64)
    # In every byte of `reached`: the bits set up to it and in it.
    reached = words - ((words >> np.uint64(1)) & np.uint64(0x5555555555555555))
    reached = (reached & np.uint64(0x3333333333333333)) + ((reached >> np.uint64(2)) & np.uint64(0x3333333333333333))
    reached = ((reached + (reached >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH
    # The bytes that do not reach the rank are those before the one with the bit.
    shift = np.bitwise_count(((rank * _EACH | _TOP) - reached) & _TOP).astype(np.uint64) << np.uint64(3)
    below = ((reached << np.uint64(8)) >> shift) & np.uint64(255)
    byte = (words >> shift) & np.uint64(255)
    return shift.astype(np.int64) + _PLACE[byte.astype(np.int64), (rank - below).astype(np.int64)]


class EliasFano:
    """A rising sequence: low bits packed side by side, high parts in unary.

    Both are read in place; beside them there is one count per 64 bits of the unary part.
    """

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.low_bits = n, low_bits
        # Eight bytes from every byte on, without a copy.
        self.lows = np.ndarray(len(lows) - 7, "<u8", lows.data, strides=(1,))
        self.words = highs[:-8].view("<u8")
        self.highs = np.ndarray(len(highs) - 7, "<u8", highs.data, strides=(1,))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones, self.zeros = ones, 64 * np.arange(len(ones)) - ones
        self.top = int(self.access(np.array([n - 1]))[0]) >> low_bits if n else -1

    @staticmethod
    def coded(values: np.ndarray) -> list[np.ndarray]:
        """(n, low_bits), lows, highs as bytes; both have eight bytes more than needed, highs are whole words."""
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = min(56, max(0, (top // max(1, n)).bit_length() - 1))
        values = values.astype(np.uint64)
        low = values & np.uint64((1 << low_bits) - 1)
        plane = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        packed = lambda bits: np.concatenate([np.packbits(bits, bitorder="little"), np.zeros(8, np.uint8)])
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 1
        unary = np.zeros(size + -size % 64, np.uint8)
        unary[high + np.arange(n)] = 1
        return [np.array([n, low_bits], np.int64).view(np.uint8), packed(plane.reshape(-1)), packed(unary)]

    @classmethod
    def opened(cls, parts: list[np.ndarray]) -> "EliasFano":
        n, low_bits = parts[0].view(np.int64).tolist()
        return cls(n, low_bits, parts[1], parts[2])

    def low(self, at: np.ndarray) -> np.ndarray:
        first = at * self.low_bits
        word = self.lows[first >> 3] >> (first & 7).astype(np.uint64)
        return (word & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def access(self, at: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, at, "right") - 1
        place = 64 * word + _bit_with_rank(self.words[word], at - self.ones[word])
        return ((place - at) << self.low_bits) | self.low(at)

    def begin(self, upper: np.ndarray) -> np.ndarray:
        """Where the elements whose upper part is at least `upper` start."""
        rank = np.clip(upper - 1, 0, max(0, self.top))
        word = np.searchsorted(self.zeros, rank, "right") - 1
        place = 64 * word + _bit_with_rank(~self.words[word], rank - self.zeros[word])
        return np.where(upper <= 0, 0, np.where(upper > self.top, self.n, place - rank))

    def _bucket(self, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the elements with each upper part begin and end: a search, and the ones in a row from there."""
        begin = self.begin(upper)
        place = np.minimum(begin + np.minimum(upper, self.top + 1), 8 * (len(self.highs) - 1))
        window = self.highs[place >> 3] >> (place & 7).astype(np.uint64)
        ones = np.bitwise_count((window ^ (window + np.uint64(1))) >> np.uint64(1)).astype(np.int64)
        end = np.where(upper > self.top, self.n, begin + ones)
        long = np.flatnonzero((ones >= 56) & (upper <= self.top))
        end[long] = self.begin(upper[long] + 1)
        return begin, end

    def _search(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first element of first .. last - 1 that is not below each value, end of its bucket there)."""
        begin, end = self._bucket(values >> self.low_bits)
        low, end = np.clip(begin, first, last), np.clip(end, first, last)
        high, wanted = end.copy(), values & ((1 << self.low_bits) - 1)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low, end
            middle = (low[open_] + high[open_]) >> 1
            below = self.low(middle) < wanted[open_]
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]

    def successor(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Place of the first element of first .. last - 1 that is not below each value; `last` if there is none.

        A search by the low bits among those of that range with the value's upper part.
        """
        return self._search(values, first, last)[0] if self.n else last.copy()

    def find(self, values: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | None = None) -> np.ndarray:
        """Place of each value among first .. last - 1 (all elements by default), or -1."""
        if not self.n:
            return np.full(len(values), -1)
        first, last = np.broadcast_to(first, values.shape), np.broadcast_to(self.n if last is None else last, values.shape)
        at, end = self._search(values, first, last)
        # Up to the end of the bucket all have the value's upper part.
        same = self.low(np.minimum(at, self.n - 1)) == (values & ((1 << self.low_bits) - 1))
        return np.where((at < end) & same, at, -1)


def quantised(p: np.ndarray) -> np.ndarray:
    """1 + steps of -log10 p; 0 is kept for what is absent."""
    with np.errstate(divide="ignore"):
        return np.clip(np.rint(-np.log10(p) * STEPS), 0, 65534).astype(np.uint16) + np.uint16(1)


def restored(code: np.ndarray, absent: float) -> np.ndarray:
    return np.where(code == 0, absent, 10.0 ** (-(code.astype(float) - 1) / STEPS))


class Trie:
    """Three levels of n-grams in one block of bytes, opened without copying.

    The first level holds the first words. A level below holds the successors of each context, by id, after those of
    the context before; to make it rise, each id is added to the last value of the context before. A pointer level says
    where each context's successors begin.
    """

    @staticmethod
    def _below(context: np.ndarray, words: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
        """(pointers, values) of a level from rising contexts and the rising words of each."""
        begin = np.searchsorted(context, np.arange(contexts + 1))
        # Every context has its own base: the sum of the last ids, plus one each, of all before it.
        last = np.where(begin[1:] > begin[:-1], words[np.maximum(begin[1:] - 1, 0)] + 1 if len(words) else 0, 0)
        base = np.concatenate([[0], np.cumsum(last)])
        return begin, base[context] + words

    @staticmethod
    def built(pairs, c1, c12, parent, third, c123, kappa2: float, kappa3: float) -> bytes:
        """From rising pairs (first << 32 | second) and, by parent pair, rising third words; counts are above 0."""
        first, second = (pairs >> U32).astype(np.int64), (pairs & np.uint64((1 << 32) - 1)).astype(np.int64)
        context = np.bincount(parent, c123, len(pairs))
        starts = np.concatenate([[True], first[1:] != first[:-1]]) if len(first) else np.zeros(0, bool)
        parts = EliasFano.coded(first[starts])
        for level in (Trie._below(np.cumsum(starts) - 1, second, int(starts.sum())), Trie._below(parent, third, len(pairs))):
            parts += EliasFano.coded(level[0]) + EliasFano.coded(level[1])
        probabilities = (c12 / (c1 + kappa2), kappa3 / (context + kappa3), c123 / (context[parent] + kappa3))
        parts += [quantised(p).view(np.uint8) for p in probabilities]
        sizes = np.array([len(p) for p in parts], np.int64)
        pad = lambda p: p.tobytes() + b"\0" * (-len(p) % 8)
        return len(parts).to_bytes(8, "little") + sizes.tobytes() + b"".join(map(pad, parts))

    def __init__(self, block):
        count = int(np.frombuffer(block, np.int64, 1)[0])
        sizes, at, parts = np.frombuffer(block, np.int64, count, 8), 8 + 8 * count, []
        for size in sizes.tolist():
            parts.append(np.frombuffer(block, np.uint8, size, at))
            at += size + -size % 8
        self.first, self.begin2, self.second, self.begin3, self.third = (
            EliasFano.opened(parts[i : i + 3]) for i in (0, 3, 6, 9, 12)
        )
        self.p2, self.backoff3, self.p3 = (p.view(np.uint16) for p in parts[15:18])

    @staticmethod
    def _successors(begin: EliasFano, level: EliasFano, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each context's successor `word`, or -1: a search relative to the context."""
        out = np.full(len(context), -1)
        known = np.flatnonzero(context >= 0)
        if not len(known) or not level.n:
            return out
        # Neighbours mostly share their context.
        own = context[known]
        heads = np.concatenate([[True], own[1:] != own[:-1]])
        which, own = np.cumsum(heads) - 1, own[heads]
        first, last = begin.access(own), begin.access(own + 1)
        base = np.where(first > 0, level.access(np.maximum(first - 1, 0)) + 1, 0)
        out[known] = level.find(base[which] + word[known], first[which], last[which])
        return out

    def lookup(self, pairs, parent, third):
        """Codes of the pairs' probabilities and back-off weights, and of the triples'; 0 if not there."""
        heads = self.first.find((pairs >> U32).astype(np.int64))
        second = (pairs & np.uint64((1 << 32) - 1)).astype(np.int64)
        at = self._successors(self.begin2, self.second, heads, second)
        below = self._successors(self.begin3, self.third, at[parent], third)
        code = lambda codes, where: np.where(where >= 0, codes[where] if len(codes) else 0, 0).astype(np.uint16)
        return code(self.p2, at), code(self.backoff3, at), code(self.p3, below)


def held_out(ids: np.ndarray) -> np.ndarray:
    """Whether the model does not learn from a document; it never does from one without an id."""
    return np.array([i == NO_ID or zlib.crc32(str(i).encode()) % 10 == 0 for i in ids.tolist()], bool)


def _words(chunk: Chunk):
    """(hashes of distinct words, rising; per token the place of its word; ends of documents; per token: learnt from)."""
    numbers = defaultdict()
    numbers.default_factory = numbers.__len__
    parts, sizes = [], []
    for text in chunk.texts():
        words = text.lower().split()
        words.append(END)
        sizes.append(len(words))
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    order = np.argsort(hashes)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    tokens = place[np.concatenate(parts)] if parts else np.zeros(0, np.int64)
    sizes = np.array(sizes, np.int64)
    return hashes[order], tokens, np.cumsum(sizes), np.repeat(~held_out(chunk.ids), sizes)


def _word_question(shards: int):
    def question(chunk: Chunk, _):
        hashes, tokens, _, learnt = _words(chunk)
        counts = np.bincount(tokens[learnt], minlength=len(hashes)).astype(np.uint32)
        low, high = by_shard(hashes, shards)
        for shard, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
            if b > a:
                yield shard, joined(pack(np.array([shard, shards])), pack_sorted(hashes[a:b]), pack(counts[a:b]))

    return question


def _word_answer(blocks: list[bytes]):
    """Ids and counts of the words asked about; the shard's tokens and distinct words."""
    parts = [parted(b) for b in blocks]
    shard, shards = unpack(parts[0][0]).tolist()
    keys = [unpack_sorted(p[1]) for p in parts]
    every, where = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(where, np.concatenate([unpack(p[2]) for p in parts])).astype(np.int64)
    ids = np.empty(len(every), np.int64)
    ids[np.argsort(-counts, kind="stable")] = np.arange(len(every))
    ids = ids * shards + shard
    replies, at = [], 0
    for own in keys:
        mine = where[at : at + len(own)]
        at += len(own)
        replies.append(joined(pack(ids[mine].astype(np.uint32)), pack(counts[mine].astype(np.uint64))))
    return replies, int(counts.sum()), int((counts > 0).sum())


def _numbered(chunk: Chunk, reply: dict[int, bytes], shards: int):
    """Per token its word's id and count; ends; per token: learnt from."""
    hashes, tokens, ends, learnt = _words(chunk)
    ids, counts = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
    low, high = by_shard(hashes, shards)
    for shard, block in reply.items():
        own, count = map(unpack, parted(block))
        ids[int(low[shard]) : int(high[shard])] = own
        counts[int(low[shard]) : int(high[shard])] = count
    return ids[tokens], counts[tokens], ends, learnt


def _grams(ids: np.ndarray, ends: np.ndarray):
    """Distinct pairs and triples of the chunk, and where each token's pair and triple are among them.

    Pairs and triples are named by their last token; -1 where a document has not begun far enough.
    """
    n = len(ids)
    position = np.arange(n) - np.repeat(np.concatenate([[0], ends[:-1]]) if len(ends) else ends, np.diff(ends, prepend=0))
    second = np.flatnonzero(position >= 1)
    pairs, of_pair = np.unique((ids[second - 1].astype(np.uint64) << U32) | ids[second].astype(np.uint64), return_inverse=True)
    pair_at = np.full(n, -1)
    pair_at[second] = of_pair
    third = np.flatnonzero(position >= 2)
    triples, of_triple = np.unique((pair_at[third - 1].astype(np.uint64) << U32) | ids[third].astype(np.uint64), return_inverse=True)
    triple_at = np.full(n, -1)
    triple_at[third] = of_triple
    return pairs, pair_at, triples, triple_at


def _shard_of(pairs: np.ndarray, shards: int) -> np.ndarray:
    x = pairs * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> U32
    return ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.int64) % shards


def _dealt(pairs, triples, shards: int):
    """For each shard its pairs and triples (their places), in order."""
    shard = _shard_of(pairs, shards)
    parent = (triples >> U32).astype(np.int64)
    by_pair, by_triple = np.argsort(shard, kind="stable"), np.argsort(shard[parent], kind="stable")
    pair_cut = np.searchsorted(shard[by_pair], np.arange(shards + 1))
    triple_cut = np.searchsorted(shard[parent][by_triple], np.arange(shards + 1))
    for s in range(shards):
        if pair_cut[s + 1] > pair_cut[s]:
            yield s, by_pair[pair_cut[s] : pair_cut[s + 1]], by_triple[triple_cut[s] : triple_cut[s + 1]]


def _gram_question(shards: int):
    def question(chunk: Chunk, replies):
        ids, counts, ends, learnt = _numbered(chunk, replies[0], shards)
        pairs, pair_at, triples, triple_at = _grams(ids, ends)
        has2, has3 = pair_at >= 0, triple_at >= 0
        c12 = np.bincount(pair_at[has2 & learnt], minlength=len(pairs))
        c123 = np.bincount(triple_at[has3 & learnt], minlength=len(triples))
        c1 = np.zeros(len(pairs), np.int64)
        c1[pair_at[has2]] = counts[np.flatnonzero(has2) - 1]
        parent, word = (triples >> U32).astype(np.int64), triples & np.uint64((1 << 32) - 1)
        for shard, own, below in _dealt(pairs, triples, shards):
            children = np.bincount(np.searchsorted(own, parent[below]), minlength=len(own))
            yield (
                shard,
                joined(
                    pack_sorted(pairs[own]),
                    pack(c1[own].astype(np.uint64)),
                    pack(c12[own].astype(np.uint32)),
                    pack(children.astype(np.uint32)),
                    pack(word[below].astype(np.uint32)),
                    pack(c123[below].astype(np.uint32)),
                ),
            )

    return question


def _gram_answer(kappa2: float, kappa3: float):
    def answer(blocks: list[bytes]):
        parts = []
        for block in blocks:
            pairs, *rest = parted(block)
            parts.append((unpack_sorted(pairs), *(unpack(x).astype(np.int64) for x in rest)))
        every, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        c1 = np.zeros(len(every))
        c1[where] = np.concatenate([p[1] for p in parts])
        c12 = np.bincount(where, np.concatenate([p[2] for p in parts]), len(every))
        parent = np.repeat(where, np.concatenate([p[3] for p in parts])).astype(np.uint64)
        keys, at = np.unique((parent << U32) | np.concatenate([p[4] for p in parts]).astype(np.uint64), return_inverse=True)
        c123 = np.bincount(at, np.concatenate([p[5] for p in parts]), len(keys))
        # What was seen in training makes the trie.
        seen = c12 > 0
        place = np.cumsum(seen) - 1
        third = keys[c123 > 0]
        block = Trie.built(
            every[seen], c1[seen], c12[seen], place[(third >> U32).astype(np.int64)],
            (third & np.uint64((1 << 32) - 1)).astype(np.int64), c123[c123 > 0], kappa2, kappa3,
        )
        mapped = mmap.mmap(-1, len(block))
        mapped.write(block)
        # Every pair and triple is looked up once, however many chunks ask about it.
        p2, backoff3, p3 = Trie(mapped).lookup(every, (keys >> U32).astype(np.int64), (keys & np.uint64((1 << 32) - 1)).astype(np.int64))
        replies, a, c = [], 0, 0
        for pairs, *_, words, _ in parts:
            own, below = where[a : a + len(pairs)], at[c : c + len(words)]
            a, c = a + len(pairs), c + len(words)
            replies.append(joined(pack(p2[own]), pack(backoff3[own]), pack(p3[below])))
        return replies, int(seen.sum()), len(block)

    return answer


def _scored(shards: int, n: int, v: int, kappa2: float):
    def work(chunk: Chunk, replies):
        ids, counts, ends, _ = _numbered(chunk, replies[0], shards)
        pairs, pair_at, triples, triple_at = _grams(ids, ends)
        p2, backoff3 = np.zeros(len(pairs), np.uint16), np.zeros(len(pairs), np.uint16)
        p3 = np.zeros(len(triples), np.uint16)
        for shard, own, below in _dealt(pairs, triples, shards):
            p2[own], backoff3[own], p3[below] = map(unpack, parted(replies[1][shard]))
        p1 = (counts + ADDED) / (n + ADDED * (v + 1))
        p = p1.copy()
        second = np.flatnonzero(pair_at >= 0)
        p[second] = restored(p2, 0.0)[pair_at[second]] + kappa2 / (counts[second - 1] + kappa2) * p1[second]
        third = np.flatnonzero(triple_at >= 0)
        p[third] = restored(p3, 0.0)[triple_at[third]] + restored(backoff3, 1.0)[pair_at[third - 1]] * p[third]
        sums = lambda x: np.diff(np.cumsum(x)[ends - 1], prepend=0.0) if len(ends) else np.zeros(0)
        total = lambda x: np.add.reduceat(x, ends - np.diff(ends, prepend=0)) if len(ends) else np.zeros(0)
        size = len(ends)
        return pa.RecordBatch.from_arrays(
            [
                chunk.out_ids(),
                pa.array(held_out(chunk.ids)),
                pa.array(np.diff(ends, prepend=0), pa.int64()),
                pa.array(np.rint(sums((counts > 0).astype(float))).astype(np.int64), pa.int64()),
                pa.array(np.full(size, n), pa.int64()),
                pa.array(total(np.log10(p1)), pa.float64()),
                pa.array(total(np.log10(p)), pa.float64()),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return work


def score(documents: DataFrame, kappa2: float = 20.0, kappa3: float = 5.0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of (doc_id, text).

    Learns from the documents whose crc32(doc_id as text) mod 10 is not 0, all of their tokens, and
    scores every whole text. Tokens: words in lower case (A-Z only), then one end. Probabilities, with
    counts c of the training tokens, N all, V distinct:
    p1(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),
    p2(w | u) = (c(u w) + kappa2 p1(w)) / (c(u) + kappa2),
    p3(w | t u) = (c(t u w) + kappa3 p2(w | u)) / (c(t u .) + kappa3); the first token has p1, the second p2.
    Each sums to 1 over the words and one unknown word. base_score sums log10 p1, score log10 p; both
    to 16-bit steps of the stored terms. NULL and blank texts have the end only; a NULL doc_id is held
    out. Every row is scored, repeated ones alike; an empty table gives no rows.
    """
    chunks = chunked(documents)
    shards = shard_count(chunks)
    words = ask(chunks, _word_question(shards), _word_answer, "words")
    sizes = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    asked = with_replies(chunks, words)
    grams = ask(asked, _gram_question(shards), _gram_answer(kappa2, kappa3), "grams")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    work = _scored(shards, sizes["n"] or 0, sizes["v"] or 0, kappa2)
    return finish(with_replies(chunks, words, grams), work, schema)
