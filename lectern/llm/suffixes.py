"""Suffix-array dedup: a logarithmic family of suffix indexes, asked for long byte matches.

Only suffixes that can start a match are indexed. Every window of `length` bytes has an anchor, the
least hash among its runs of ANCHOR bytes; equal windows have equal anchors at equal offsets, so
windows whose anchor occurs once in the corpus are unique and never leave their chunk. The others go
to the shard of their anchor, several windows with one anchor as one stretch of bytes, equal stretches
of a chunk once. A shard takes in the stretches batch by batch, in the order of the texts: each batch gets an array of
its suffixes, ordered by a fingerprint of the first `length` bytes of each, and is merge-scanned against the levels
before it. What a level has already, byte by byte, is a repeat; the others are added, and levels of like size are
merged, so there are logarithmically many.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from lectern.llm.chunks import Chunk, ask, by_shard, chunked, finish, shard_count, with_replies
from lectern.llm.common import joined, pack, pack_sorted, parted, unpack, unpack_sorted

ANCHOR = 32
BLOCK = 1 << 19
RANGE = 200_000  # Windows of a shard looked at together.
BATCH = 32_768  # Windows of a batch of the family.
TABLE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= MIX[1]
    x ^= x >> np.uint64(29)
    return x


def run_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of all runs of `width` bytes: two runs' fingerprints roll into that of the longer one."""
    out, length = TABLE[data], 1
    if len(data) < width:
        return np.zeros(0, np.uint64)
    while length < width:
        step = min(length, width - length)
        count = len(out) - step
        out = _mixed(out[:count] * MIX[0] + out[step : step + count])
        length += step
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        values = np.minimum(values[: len(values) - step], values[step:])
        covered += step
    return values


def stretches(chunk: Chunk, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor hash, offset of the anchor) of windows in a row with one anchor."""
    data = np.frombuffer(chunk.data, np.uint8)
    n, width = len(data), length - ANCHOR + 1
    firsts, counts, hashes, offsets = [], [], [], []
    low_bits = np.uint64((1 << 20) - 1)
    for start in range(0, max(0, n - length + 1), BLOCK):
        end = min(n, start + BLOCK + length - 1)
        grams = run_hashes(data[start:end], ANCHOR)
        ranked = (grams & ~low_bits) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_least(ranked, width) & low_bits).astype(np.int64)
        window = np.arange(len(anchor)) + start
        document = np.searchsorted(chunk.ends, window, side="right")
        inside = window + length <= chunk.ends[document]
        window, anchor, document = window[inside], anchor[inside], document[inside]
        if not len(window):
            continue
        new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(document) != 0)])
        heads = np.flatnonzero(new)
        firsts.append(window[heads])
        counts.append(np.diff(np.append(heads, len(window))))
        hashes.append(grams[anchor[heads]])
        offsets.append(anchor[heads] + start - window[heads])
    if not firsts:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(hashes), np.concatenate(offsets)


def _anchor_question(length: int, shards: int):
    def question(chunk: Chunk, _):
        keys = np.unique(stretches(chunk, length)[2])
        low, high = by_shard(keys, shards)
        for shard, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
            if b > a:
                yield shard, pack_sorted(keys[a:b])

    return question


def _anchor_answer(blocks: list[bytes]):
    """For each anchor whether another chunk has it as well."""
    parts = [unpack_sorted(b) for b in blocks]
    every = np.sort(np.concatenate(parts))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    return [pack(np.packbits(np.isin(p, shared, assume_unique=True))) for p in parts], len(every), len(shared)


def _candidates(chunk: Chunk, reply: dict[int, bytes], length: int, shards: int):
    """Stretches whose anchor is not unique: those to send (by anchor), and those equal to an earlier one here."""
    first, count, hashes, offset = stretches(chunk, length)
    keys, where, times = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = times > 1
    low, high = by_shard(keys, shards)
    for shard, block in reply.items():
        a, b = int(low[shard]), int(high[shard])
        shared[a:b] |= np.unpackbits(unpack(block), count=b - a).astype(bool)
    wanted = np.flatnonzero(shared[where])
    seen, own, copies = set(), [], []
    for i, start, size in zip(wanted.tolist(), first[wanted].tolist(), (count[wanted] + length - 1).tolist(), strict=True):
        piece = chunk.data[start : start + size]
        if piece in seen:
            copies.append(i)
        else:
            seen.add(piece)
            own.append(i)
    own = np.array(own, np.int64)
    own = own[np.argsort(hashes[own], kind="stable")] if len(own) else own
    return first, count, hashes, offset, own, np.array(copies, np.int64)


def _stretch_question(length: int, shards: int):
    def question(chunk: Chunk, replies):
        first, count, hashes, offset, own, _ = _candidates(chunk, replies[0], length, shards)
        low, high = by_shard(hashes[own], shards)
        document = np.searchsorted(chunk.ends, first, side="right")
        for shard, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
            if b > a:
                some = own[a:b]
                sizes = count[some] + length - 1
                data = b"".join(
                    chunk.data[s : s + n] for s, n in zip(first[some].tolist(), sizes.tolist(), strict=True)
                )
                ids, place = np.unique(document[some], return_inverse=True)
                yield (
                    shard,
                    joined(
                        pack_sorted(hashes[some]),
                        pack(count[some].astype(np.uint16)),
                        pack(offset[some].astype(np.uint16)),
                        pack(place.astype(np.uint16)),
                        pack(chunk.ids[ids]),
                        pack((first[some] - chunk.starts[document[some]]).astype(np.int64)),
                        zstandard.compress(data, 3),
                    ),
                )

    return question


class LevelFamily:
    """Sorted arrays of (fingerprint of a suffix, its place in the text); like sizes are merged as they come.

    `text` is what all suffixes are of, `length` how many of their bytes count. A suffix is known by its bytes: those with
    one fingerprint and other bytes are kept side by side.
    """

    def __init__(self, text: np.ndarray, length: int):
        self.windows = np.lib.stride_tricks.sliding_window_view(text, length) if len(text) >= length else text[:0, None]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def _equal(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        out = np.ones(len(one), bool)
        for low in range(0, len(one), 4096):
            part = slice(low, low + 4096)
            out[part] = (self.windows[one[part]] == self.windows[other[part]]).all(axis=1)
        return out

    def _known(self, level: tuple[np.ndarray, np.ndarray], keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which of the suffixes a level has; `keys` rise, as the level's do: one merge."""
        own, held = level
        at, end = np.searchsorted(own, keys, "left"), np.searchsorted(own, keys, "right")
        found = np.zeros(len(keys), bool)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            found[open_] = self._equal(held[at[open_]], places[open_])
            at[open_] += 1
            open_ = open_[~found[open_] & (at[open_] < end[open_])]
        return found

    def scan(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which suffixes of a batch occur before: in a level, or further ahead in the batch. Then takes the new ones in."""
        order = np.argsort(keys, kind="stable")
        ranked, held = keys[order], places[order]
        repeated = np.zeros(len(keys), bool)
        for level in self.levels:
            fresh = np.flatnonzero(~repeated)
            repeated[fresh] = self._known(level, ranked[fresh], held[fresh])
        # Among equal fingerprints of the batch the first of each text is new.
        fresh = np.flatnonzero(~repeated)
        same = np.flatnonzero(ranked[fresh][1:] == ranked[fresh][:-1]) + 1
        group = np.cumsum(np.concatenate([[True], ranked[fresh][1:] != ranked[fresh][:-1]])) if len(fresh) else fresh
        heads = np.searchsorted(group, group[same])
        equal = self._equal(held[fresh[heads]], held[fresh[same]])
        repeated[fresh[same[equal]]] = True
        for i in same[~equal].tolist():  # One fingerprint, other bytes.
            rivals = [j for j in range(int(np.searchsorted(group, group[i])), i) if not repeated[fresh[j]]]
            repeated[fresh[i]] = any(self._equal(held[fresh[[j]]], held[fresh[[i]]])[0] for j in rivals)
        self._add(ranked[~repeated], held[~repeated])
        out = np.empty(len(keys), bool)
        out[order] = repeated
        return out

    def _add(self, keys: np.ndarray, places: np.ndarray) -> None:
        self.levels.append((keys, places))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (k1, p1), (k2, p2) = self.levels.pop(), self.levels.pop()
            keys, places = np.concatenate([k2, k1]), np.concatenate([p2, p1])
            order = np.argsort(keys, kind="stable")
            self.levels.append((keys[order], places[order]))


def _windows(data: bytes, count: np.ndarray, offset: np.ndarray, anchors: np.ndarray, length: int):
    """(key, stretch, place in it, place in `data`) of every window of the stretches; anchor and offset are part of the key."""
    hashes = run_hashes(np.frombuffer(data, np.uint8), length)
    sizes = count + length - 1
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    stretch = np.repeat(np.arange(len(count)), count)
    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    salt = anchors[stretch] * MIX[0] + (offset[stretch] - within).astype(np.uint64)
    place = begin[stretch] + within
    return _mixed(hashes[place] + salt) if len(place) else place.astype(np.uint64), stretch, within, place


def _ranges(anchors: list[np.ndarray], counts: list[np.ndarray]) -> list[tuple[np.uint64, np.uint64]]:
    """Ranges of anchors (both ends included) with about RANGE windows each."""
    every, windows = np.concatenate(anchors), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, piece = every[order], np.cumsum(windows[order]) // RANGE
    last = np.flatnonzero(np.concatenate([every[1:] != every[:-1], [True]]))
    cut = last[np.flatnonzero(np.concatenate([np.diff(piece[last]) > 0, [True]]))]
    lows = np.concatenate([[0], cut[:-1] + 1])
    return list(zip(every[lows], every[cut], strict=True))


def _stretch_answer(length: int):
    def answer(blocks: list[bytes]):
        parts = []
        for block in blocks:
            anchors, count, offset, place, ids, start, data = parted(block)
            count, offset = unpack(count).astype(np.int64), unpack(offset).astype(np.int64)
            total = int((count + length - 1).sum())
            raw = zstandard.decompress(data, max_output_size=max(1, total))
            parts.append((unpack_sorted(anchors), count, offset, unpack(ids)[unpack(place)], unpack(start), raw))
        # Ranks of all stretches by document and place; the windows of one follow each other.
        ids, starts = (np.concatenate([p[i] for p in parts]) for i in (3, 4))
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((starts, ids))] = np.arange(len(ids))
        at = np.cumsum([0, *(len(p[0]) for p in parts)])
        bits = [[] for _ in parts]
        windows = 0
        # Equal windows have one anchor, so a shard is gone through in ranges of anchors.
        for low, high in _ranges([p[0] for p in parts], [p[1] for p in parts]):
            texts, found, before = [], [], 0
            for part, (anchors, count, offset, _, _, raw) in enumerate(parts):
                a, b = np.searchsorted(anchors, low), np.searchsorted(anchors, high, side="right")
                sizes = count + length - 1
                start, size = int(sizes[:a].sum()), int(sizes[a:b].sum())
                text = raw[start : start + size]
                keys, stretch, within, place = _windows(text, count[a:b], offset[a:b], anchors[a:b], length)
                texts.append(text)
                found.append((keys, rank[at[part] + a + stretch] * 65536 + within, place + before))
                before += size
            keys, ranks, places = (np.concatenate([f[i] for f in found]) for i in range(3))
            order = np.argsort(ranks, kind="stable")
            family, repeated = LevelFamily(np.frombuffer(b"".join(texts), np.uint8), length), np.zeros(len(keys), bool)
            for first in range(0, len(order), BATCH):
                batch = order[first : first + BATCH]
                repeated[batch] = family.scan(keys[batch], places[batch])
            windows += len(keys)
            for own, mine in zip(bits, np.split(repeated, np.cumsum([len(f[0]) for f in found])[:-1]), strict=True):
                own.append(mine)
        replies = [pack(np.packbits(np.concatenate(own))) for own in bits]
        return replies, windows, 0

    return answer


def _finished(length: int, shards: int, with_text: bool):
    def work(chunk: Chunk, replies):
        first, count, hashes, _, own, copies = _candidates(chunk, replies[0], length, shards)
        low, high = by_shard(hashes[own], shards)
        cover = np.zeros(len(chunk.data) + 1, np.int32)
        for shard, block in replies[1].items():
            some = own[int(low[shard]) : int(high[shard])]
            n = count[some]
            bits = np.unpackbits(unpack(block), count=int(n.sum())).astype(bool)
            window = np.repeat(first[some], n) + np.arange(len(bits)) - np.repeat(np.cumsum(n) - n, n)
            np.add.at(cover, window[bits], 1)
            np.add.at(cover, window[bits] + length, -1)
        np.add.at(cover, first[copies], 1)
        np.add.at(cover, first[copies] + count[copies] + length - 1, -1)
        gone = np.cumsum(cover)[:-1] > 0
        data = np.frombuffer(chunk.data, np.uint8)
        out = []
        for start, end in zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            mask = gone[start:end]
            removed = int(mask.sum())
            kept = data[start:end][~mask].tobytes() if removed else chunk.data[start:end]
            spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if removed else 0
            shown = kept.decode(errors="ignore") if with_text else hashlib.sha256(kept).hexdigest()
            out.append((end - start, removed, spans, shown))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([chunk.out_ids(), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return work


def without_repeats(documents: DataFrame, length: int = 100, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of (doc_id, text).

    Removes each byte of the UTF-8 text covered by a string of `length` bytes that also starts earlier: in a
    row with a smaller doc_id, or before in the same text. Strings are judged on the input; they do
    not reach across texts. n_spans: maximal removed runs. kept: what is left (cut characters are dropped from it),
    or its bytes' SHA-256 if not `with_text`. NULL texts count as empty. NULL ids come last; rows with
    equal ids count as one after the other. Every row is kept; an empty table gives no rows.
    `length` is between ANCHOR and 4096.
    """
    chunks = chunked(documents)
    # A shard unfolds its stretches into windows, many times their size, so shards are smaller than chunks.
    shards = 4 * shard_count(chunks)
    shared = ask(chunks, _anchor_question(length, shards), _anchor_answer, "anchors")
    asked = with_replies(chunks, shared)
    repeats = ask(asked, _stretch_question(length, shards), _stretch_answer(length), "stretches")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept string"
    return finish(with_replies(chunks, shared, repeats), _finished(length, shards, with_text), schema)
