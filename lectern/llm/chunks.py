"""Work on whole texts in chunks, and questions that chunks ask of shards.

Documents are gathered into chunks of a few megabytes, each written as one row of a bucketed table. A
chunk asks about what it holds (hashes of words, of windows) by sending one block to each shard;
a shard sees the blocks of all chunks for its part of the hashes, and answers each of them. Blocks
hold a key once per chunk, so a key that a third of all rows have is still as rare as there are
chunks, and shards are balanced by hash. The table is bucketed by chunk: it is never shuffled, only
the answers are.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import pack, pieces_for, unpack
from lectern.session import materialize, run_folder

CHUNK_BYTES = 8 << 20

# Stands for a NULL id: after all others.
NO_ID = (1 << 63) - 1


@dataclass
class Chunk:
    """Documents of one chunk by rising id (NULL last, equal ids by text): ids, the texts' ends, all bytes."""

    number: int
    ids: np.ndarray
    ends: np.ndarray
    data: bytes

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.int64), self.ends[:-1]]) if len(self.ends) else self.ends

    def texts(self) -> Iterator[bytes]:
        for start, end in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            yield self.data[start:end]

    def out_ids(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.ids == NO_ID)


def _written(chunk_bytes: int):
    def flush(number, rows):
        rows.sort()
        ids = np.array([r[0] for r in rows], np.int64)
        sizes = np.array([len(r[1]) for r in rows], np.int64)
        data = zstandard.compress(b"".join(r[1] for r in rows), 3)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([pack(ids)]), pa.array([pack(sizes)]), pa.array([data], pa.binary())],
            ["chunk", "ids", "sizes", "data"],
        )

    def run(batches):
        number, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                some = batch.slice(part, 256)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    raw = (text or "").encode()
                    rows.append((NO_ID if doc_id is None else doc_id, raw))
                    size += len(raw)
                    if size >= chunk_bytes or len(rows) >= 1 << 16:
                        yield flush(number, rows)
                        number, rows, size = number + 1, [], 0
        if rows:
            yield flush(number, rows)

    return run


def chunked(documents: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The table of chunks of (doc_id, text); a NULL text counts as empty."""
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text")
    rows = texts.mapInArrow(_written(chunk_bytes), "chunk long, ids binary, sizes binary, data binary")
    folder = run_folder(spark, "chunks")
    name = "chunks_" + folder.rsplit("-", 1)[1]
    buckets = pieces_for(texts, chunk_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.write.bucketBy(min(buckets, 100_000), "chunk").option("path", folder).saveAsTable(name)
    return spark.table(name)


def open_chunks(batches) -> Iterator[tuple[Chunk, dict[int, bytes]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda name, i=i, batch=batch: batch.column(batch.schema.get_field_index(name))[i].as_py()
            ids, sizes = unpack(get("ids")), unpack(get("sizes"))
            total = int(sizes.sum())
            data = zstandard.decompress(get("data"), max_output_size=max(1, total)) if total else b""
            replies = [{r["shard"]: r["reply"] for r in get(c) or ()} for c in batch.schema.names if c.startswith("replies")]
            yield Chunk(get("chunk"), ids, np.cumsum(sizes), data), replies


def with_replies(chunks: DataFrame, *replies: DataFrame) -> DataFrame:
    """Each chunk with the answers it got; only the answers move."""
    out = chunks
    for n, some in enumerate(replies):
        gathered = some.groupBy("chunk").agg(F.collect_list(F.struct("shard", "reply")).alias(f"replies{n}"))
        out = out.join(gathered.hint("shuffle_hash"), "chunk", "left")
    return out


def ask(chunks: DataFrame, question: Callable, answer: Callable, label: str) -> DataFrame:
    """(chunk, shard, reply, n, v) for what `question` sends and `answer` gives back, as a table.

    question(chunk, replies) yields (shard, block); answer(blocks) takes a list of all blocks of a
    shard, by chunk, and gives a list of as many replies and two numbers about the shard.
    """

    def send(batches):
        for chunk, replies in open_chunks(batches):
            for shard, block in question(chunk, replies):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([chunk.number], pa.int64()), pa.array([block], pa.binary())],
                    ["shard", "chunk", "block"],
                )

    def give(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("chunk").to_numpy())
        group = group.take(pa.array(order))
        replies, n, v = answer([b.as_py() for b in group.column("block")])
        rest = [0] * (len(replies) - 1)
        return pa.table(
            {
                "chunk": group.column("chunk"),
                "shard": group.column("shard"),
                "reply": pa.array(replies, pa.binary()),
                "n": pa.array([n, *rest], pa.int64()),
                "v": pa.array([v, *rest], pa.int64()),
            }
        )

    asked = chunks.mapInArrow(send, "shard int, chunk long, block binary")
    given = asked.groupBy("shard").applyInArrow(give, "chunk long, shard int, reply binary, n long, v long")
    return materialize(given, label)


def finish(chunks: DataFrame, work: Callable, schema: str) -> DataFrame:
    """work(chunk, replies) -> record batch, or None for no rows, for every chunk."""

    def run(batches):
        for chunk, replies in open_chunks(batches):
            if (done := work(chunk, replies)) is not None:
                yield done

    return chunks.mapInArrow(run, schema)


def by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each shard's part of the rising 64-bit `keys` starts: shards are ranges of the keys."""
    edges = (np.arange(1, shards, dtype=object) * (1 << 64) // shards).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges)]), np.concatenate([np.searchsorted(keys, edges), [len(keys)]])


def shard_count(chunks: DataFrame) -> int:
    """As many shards as chunks; 1 at least."""
    return max(1, chunks.count())
