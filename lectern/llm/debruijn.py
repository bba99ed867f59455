"""Substring dedup: a de Bruijn graph of word k-mers, compacted into repeated paths.

Runs of k words are the edges. An edge that an earlier document has as well knows that document's place, and edges that
follow each other both here and there make a path. Equal paths are compacted into one by joins, each distinct path is
compared, words and all, with the place it came from, and only what is the same there is removed.
"""

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.chunks import Chunk, ask, by_shard, chunked, finish, open_chunks, shard_count, with_replies
from lectern.llm.common import joined, pack, pack_sorted, parted, unpack, unpack_sorted
from lectern.session import materialize

SPAN = "array<struct<start: bigint, length: bigint, source: bigint, path: bigint>>"

# Where a path comes from: a chunk, a document of it and a word of that.
PLACE = ("source_chunk", "source_doc", "source_at")


def _word_hashes(chunk: Chunk) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each document, the hashes of all words in a row, and where each document ends."""
    words = [text.split() for text in chunk.texts()]
    numbers = defaultdict()
    numbers.default_factory = numbers.__len__
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    local = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    at = 0
    for some in words:
        local[at : at + len(some)] = np.fromiter(map(numbers.__getitem__, some), np.int64, len(some))
        at += len(some)
    table = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    return words, table[local], ends


def edges_of(hashes: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, document) of every run of `k` words within a document."""
    count = max(0, len(hashes) - k + 1)
    out = np.zeros(count, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + count]
        out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    place = np.arange(count)
    document = np.searchsorted(ends, place, side="right")
    inside = place + k <= ends[document] if count else place.astype(bool)
    return out[inside], place[inside], document[inside]


def _distinct(chunk: Chunk, k: int, bits: int):
    words, hashes, ends = _word_hashes(chunk)
    edges, place, document = edges_of(hashes, ends, k)
    edges >>= np.uint64(64 - bits)
    order = np.argsort(edges, kind="stable")
    ranked = edges[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return words, ends, place, document, order, new, ranked[new], document[order][new], place[order][new]


def _starts(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], ends[:-1]]) if len(ends) else ends


def _edge_question(k: int, bits: int, shards: int):
    def question(chunk: Chunk, _):
        *_, keys, first, place = distinct = _distinct(chunk, k, bits)
        at = place - _starts(distinct[1])[first]
        low, high = by_shard(keys, shards)
        ids, number = pack_sorted(chunk.ids.astype(np.uint64) ^ np.uint64(1 << 63)), pack(np.array([chunk.number]))
        for shard, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
            if b > a:
                parts = (number, ids, pack_sorted(keys[a:b]), pack(first[a:b].astype(np.uint16)), pack(at[a:b].astype(np.uint32)))
                yield shard, joined(*parts)

    return question


def _edge_answer(blocks: list[bytes]):
    """For each edge asked about its first document, by id, and the place there, if that is before the asking chunk's first."""
    keys, columns = [], []
    for block in blocks:
        number, ids, own, first, at = parted(block)
        keys.append(unpack_sorted(own))
        first = unpack(first).astype(np.int64)
        doc_ids = (unpack_sorted(ids) ^ np.uint64(1 << 63)).view(np.int64)[first]
        columns.append((doc_ids, np.repeat(unpack(number), len(first)), first, unpack(at).astype(np.int64)))
    every, ids = np.concatenate(keys), np.concatenate([c[0] for c in columns])
    # Blocks come by chunk: of equal ids the first chunk's is the source.
    order = np.lexsort((ids, every))
    heads = np.flatnonzero(np.concatenate([[True], every[order][1:] != every[order][:-1]]))
    source = np.empty(len(every), np.int64)
    source[order] = np.repeat(order[heads], np.diff(np.append(heads, len(every))))
    address = [np.concatenate([c[i] for c in columns]) for i in range(4)]
    replies, at = [], 0
    for own in columns:
        mine = source[at : at + len(own[0])]
        at += len(own[0])
        earlier = ids[mine] < own[0]
        found = [x[mine[earlier]] for x in address]
        kinds = (np.int64, np.int64, np.uint16, np.uint32)
        replies.append(joined(pack(np.packbits(earlier)), *(pack(x.astype(t)) for x, t in zip(found, kinds, strict=True))))
    return replies, len(heads), int((np.diff(np.append(heads, len(every))) > 1).sum())


def _occurrences(k: int, bits: int, shards: int):
    """The paths of every document: consecutive repeated edges that are consecutive at their source as well."""
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    names = ["chunk", "doc", "at", "start", "length", "path", "source", *PLACE]

    def work(chunk: Chunk, replies):
        words, ends, place, document, order, new, keys, first, first_place = _distinct(chunk, k, bits)
        starts = _starts(ends)
        # Of every distinct edge: the source's id, chunk, document and word; here, if nowhere before.
        address = [chunk.ids[first].copy(), np.full(len(keys), chunk.number), first.astype(np.int64), first_place - starts[first]]
        low, high = by_shard(keys, shards)
        for shard, reply in replies[0].items():
            flags, *found = map(unpack, parted(reply))
            a, b = int(low[shard]), int(high[shard])
            earlier = np.flatnonzero(np.unpackbits(flags, count=b - a)) + a
            for own, some in zip(address, found, strict=True):
                own[earlier] = some
        # Back from distinct edges to all of them, in reading order.
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        hits = np.flatnonzero(address[0][which] < chunk.ids[document]) if len(which) else which
        if not len(hits):
            return None
        # From here on only what repeated edges need is held.
        source, from_chunk, from_doc, from_at = (x[which[hits]] for x in address)
        place, document = place[hits], document[hits]
        del order, new, keys, first, first_place, address, which
        same = (np.diff(place) == 1) & (np.diff(document) == 0) & (np.diff(from_at) == 1)
        same &= (np.diff(from_chunk) == 0) & (np.diff(from_doc) == 0)
        heads = np.concatenate([[0], np.flatnonzero(~same) + 1])
        length = np.diff(np.append(heads, len(hits)))
        doc = document[heads]
        begin = place[heads] - starts[doc]
        own = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1])
        ordinal = np.arange(len(doc)) - np.repeat(own, np.diff(np.append(own, len(doc))))
        digests = [
            hashlib.md5(b" ".join(words[d][b : b + n + k - 1])).digest()
            for d, b, n in zip(doc.tolist(), begin.tolist(), length.tolist(), strict=True)
        ]
        columns = (np.full(len(doc), chunk.number), doc, ordinal, begin, length, digests, source[heads], from_chunk[heads], from_doc[heads], from_at[heads])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return work


def chains(links: DataFrame) -> DataFrame:
    """(node, first) of all in `links` (node, next), where no node has two next ones or is that of two.

    Every node looks at the one before it, and in each round at what that one looks at: after log n rounds it
    has the first of its chain. What is not there by then goes round in a circle and gets its least number. Rounds are written tables; a
    node that has arrived is not joined again, so no first one gathers its chain's rows.
    """
    before = links.select(F.col("next").alias("node"), F.col("node").alias("up"))
    firsts = links.select("node").join(before.select("node"), "node", "left_anti").select("node", F.col("node").alias("up"))
    here = F.least("node", "up").alias("least")
    state = before.select("node", "up", here, F.lit(False).alias("there"))
    state = materialize(state.unionByName(firsts.select("node", "up", here, F.lit(True).alias("there"))), "chains")
    rounds = max(1, state.count()).bit_length() + 1
    for _ in range(rounds):
        going = state.where("NOT there")
        if going.isEmpty():
            break
        above = state.select(F.col("node").alias("up"), F.col("up").alias("top"), F.col("least").alias("low"), F.col("there").alias("done"))
        moved = going.join(above, "up").select("node", F.col("top").alias("up"), F.least("least", "low").alias("least"), F.col("done").alias("there"))
        state = materialize(state.where("there").unionByName(moved), "chains")
    return state.select("node", F.when(F.col("there"), F.col("up")).otherwise(F.col("least")).alias("first"))


def compact(occurrences: DataFrame, k: int = 13) -> DataFrame:
    """(path, source place, words, times, source, joined): the distinct repeated paths of the graph.

    Takes the paths of documents (chunk, doc, at, start, length, path, source, source place). Equal ones from one place are one path.
    Two paths that follow each other without a gap everywhere (the first has one successor and the second one
    predecessor) are parts of one nonbranching path; `joined` names it by its first one's number (the least, where paths
    follow each other in a circle). The joins go over paths, not over words.
    """
    nodes = occurrences.groupBy("path", *PLACE).agg(
        (F.max("length") + k - 1).alias("words"), F.count("*").alias("times"), F.min("source").alias("source")
    )
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "paths")
    placed = occurrences.join(nodes.select("path", *PLACE, "node"), ["path", *PLACE])
    placed = materialize(placed.select("chunk", "doc", "at", "start", "length", "node"), "placed")
    after = placed.select("chunk", "doc", (F.col("at") - 1).alias("at"), F.col("node").alias("next"), F.col("start").alias("begin"))
    follows = placed.join(after, ["chunk", "doc", "at"]).where(F.col("start") + F.col("length") == F.col("begin"))
    follows = materialize(follows.groupBy("node", "next").agg(F.count("*").alias("times")), "follows")
    single = follows.groupBy("node").agg(F.count("*").alias("n"), F.first("next").alias("next")).where("n = 1")
    alone = follows.groupBy("next").agg(F.count("*").alias("m")).where("m = 1").select("next")
    labels = chains(single.join(alone, "next").select("node", "next")).select("node", F.col("first").alias("joined"))
    return nodes.join(labels, "node", "left").withColumn("joined", F.coalesce("joined", "node"))


def _packed(columns: tuple[str, ...], key: str, to: str):
    """A row per group: its columns as one block, in the order given."""

    def run(group: pa.Table) -> pa.Table:
        blocks = []
        for c in columns:
            column = group.column(c)
            if pa.types.is_binary(column.type):
                blocks.append(pack(np.frombuffer(b"".join(column.to_pylist()), np.uint8)))
            else:
                blocks.append(pack(column.to_numpy()))
        return pa.table({key: group.column(key)[:1], to: pa.array([joined(*blocks)], pa.binary())})

    return run


def _opened(batches, column: str):
    """(chunk, arrays of the block in `column`, or None) of chunks joined to blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            block = one.column(one.schema.get_field_index(column))[0].as_py()
            chunk, _ = next(open_chunks([one]))
            yield chunk, None if block is None else list(map(unpack, parted(block)))


def verified(chunks: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, same): whether the words of each path are those of the place it comes from, read there."""
    columns = ("node", "path", "source_doc", "source_at", "words")
    asked = nodes.select(F.col("source_chunk").alias("chunk"), *columns)
    asked = asked.groupBy("chunk").applyInArrow(_packed(columns, "chunk", "asked"), "chunk long, asked binary")

    def run(batches):
        for chunk, (node, path, doc, at, size) in _opened(batches, "asked"):
            digests, words, same = path.tobytes(), {}, []
            for i, (d, a, n) in enumerate(zip(doc.tolist(), at.tolist(), size.tolist(), strict=True)):
                if d not in words:
                    words[d] = chunk.data[int(chunk.starts[d]) : int(chunk.ends[d])].split()
                same.append(hashlib.md5(b" ".join(words[d][a : a + n])).digest() == digests[16 * i : 16 * i + 16])
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(same, pa.bool_())], ["node", "same"])

    return chunks.join(asked.hint("shuffle_hash"), "chunk").mapInArrow(run, "node long, same boolean")


def _exact_edges(chunks: DataFrame, wrong: DataFrame, k: int) -> DataFrame:
    """(chunk, doc, start) of the edges of `wrong` paths (chunk, doc, start, length) that an earlier document really has.

    For paths whose words are not those of their place, which takes two runs of words with one 64-bit hash. All edges of
    the corpus go by a digest of their words; none of this runs while no hash collides.
    """

    def edges(batches):
        for chunk, _ in open_chunks(batches):
            for d, text in enumerate(chunk.texts()):
                words = text.split()
                count = max(0, len(words) - k + 1)
                digests = [hashlib.md5(b" ".join(words[i : i + k])).digest() for i in range(count)]
                columns = [np.full(count, chunk.number), np.full(count, d), np.arange(count), np.full(count, chunk.ids[d])]
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(digests, pa.binary())], ["chunk", "doc", "start", "id", "edge"])

    every = materialize(chunks.mapInArrow(edges, "chunk long, doc int, start long, id long, edge binary"), "edges")
    first = every.groupBy("edge").agg(F.min("id").alias("first"))
    starts = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("start")
    asked = wrong.select("chunk", "doc", starts).distinct()
    return every.join(asked, ["chunk", "doc", "start"]).join(first, "edge").where("first < id").select("chunk", "doc", "start", "first")


def _finished(k: int, with_text: bool):
    def run(batches):
        for chunk, found in _opened(batches, "spans"):
            own = defaultdict(list)
            if found is not None:
                for span in sorted(zip(*(x.tolist() for x in found), strict=True)):
                    own[span[0]].append(span[1:])
            out = []
            for d, text in enumerate(chunk.texts()):
                words = text.split()
                kept, gone = words, 0
                if own[d]:
                    cover = np.zeros(len(words) + 1, np.int32)
                    for start, length, *_ in own[d]:
                        cover[start] += 1
                        cover[start + length + k - 1] -= 1
                    keep = np.cumsum(cover)[: len(words)] == 0
                    kept = [w for w, k_ in zip(words, keep.tolist(), strict=True) if k_]
                    gone = len(words) - len(kept)
                left = b" ".join(kept)
                out.append((len(words), gone, left.decode(errors="replace") if with_text else hashlib.sha256(left).hexdigest(), own[d]))
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "source", "path")]))
            spans = [[dict(zip(("start", "length", "source", "path"), s, strict=True)) for s in r[3]] for r in out]
            kinds = (pa.int64(), pa.int64(), pa.string())
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
            names = ["doc_id", "n_words", "n_removed", "kept", "paths"]
            yield pa.RecordBatch.from_arrays([chunk.out_ids(), *columns, pa.array(spans, kind)], names)

    return run


def path_occurrences(chunks: DataFrame, k: int = 13, hash_bits: int = 64) -> DataFrame:
    """The paths of all documents of a table of chunks, as `compact` takes them: found by hashes, not compared yet."""
    shards = shard_count(chunks)
    replies = ask(chunks, _edge_question(k, hash_bits, shards), _edge_answer, "edges")
    schema = "chunk long, doc int, at int, start long, length long, path binary, source long, source_chunk long, source_doc int, source_at long"
    return materialize(finish(with_replies(chunks, replies), _occurrences(k, hash_bits, shards), schema), "occurrences")


def repeated_spans(documents: DataFrame, k: int = 13, with_text: bool = True, hash_bits: int = 64) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, paths) of (doc_id, text).

    Words are what white space separates, as they are. Each run of `k` words of a document is an edge
    of the graph (between its first and its last k - 1 words). An edge that also occurs in a document
    with a smaller doc_id is repeated; consecutive repeated edges that are consecutive in the same first source form a
    path: (start, length in edges, source, path), `path` the number of the nonbranching path in this run (`compact`). kept:
    the words no path covers, joined by single spaces (their SHA-256, if not `with_text`). Hashes only find paths; the
    words of each distinct one are compared with those at its source before anything is removed.
    Everything is judged on the input. NULL and blank texts have no words; a NULL doc_id comes after all others
    and is never a source for another NULL; rows with equal ids are not sources of each other.
    Every row is kept; an empty table gives no rows.
    """
    chunks = chunked(documents)
    occurrences = path_occurrences(chunks, k, hash_bits)
    nodes = materialize(compact(occurrences, k), "compacted")
    same = materialize(verified(chunks, nodes), "verified")
    nodes = nodes.select("path", *PLACE, "node", "joined").join(same, "node")
    paths = occurrences.join(nodes, ["path", *PLACE])
    spans = paths.where("same").select("chunk", "doc", "start", "length", "source", F.col("joined").alias("path"))
    if not same.where("NOT same").isEmpty():
        wrong = materialize(paths.where("NOT same").select("chunk", "doc", "start", "length"), "wrong")
        exact = _exact_edges(chunks, wrong, k)
        one, none = F.lit(1).cast("long").alias("length"), F.lit(-1).cast("long").alias("path")
        spans = spans.unionByName(exact.select("chunk", "doc", "start", one, F.col("first").alias("source"), none))
    columns = ("doc", "start", "length", "source", "path")
    blocks = spans.groupBy("chunk").applyInArrow(_packed(columns, "chunk", "spans"), "chunk long, spans binary")
    schema = f"doc_id long, n_words long, n_removed long, kept string, paths {SPAN}"
    return chunks.join(blocks.hint("shuffle_hash"), "chunk", "left").mapInArrow(_finished(k, with_text), schema)
