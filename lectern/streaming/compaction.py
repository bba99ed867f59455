"""The current status table, folded: what a status costs to read depends on the keys, not on the updates.

`jobs.write_batches` adds a folder per micro-batch, so that a log of updates grows for ever. `compact_status` folds
all finished batches into a snapshot with one row per key; `current_status` reads it and the batches since.
"""

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.state import latest_status
from lectern.sources import snapshots
from lectern.streaming.jobs import read_batches, stream_latest_status, write_batches


def _finished(spark: SparkSession, out: str) -> dict[str, list[str]]:
    """Batches of each query whose write is complete, numbers as text."""
    found = defaultdict(list)
    for path in snapshots.children(spark, f"{out}/query=*/batch_id=*/_SUCCESS"):
        query, batch = (part.split("=", 1)[1] for part in path.split("/")[-3:-1])
        found[query].append(batch)
    return dict(found)


def _since(spark: SparkSession, out: str, before: snapshots.Manifest | None) -> dict[str, list[str]]:
    """Finished batches that the snapshot does not hold."""
    covered = {q: set(batches) for q, batches in (before.covered if before else {}).items()}
    fresh = {q: [b for b in batches if b not in covered.get(q, ())] for q, batches in _finished(spark, out).items()}
    return {q: batches for q, batches in fresh.items() if batches}


def _updates(spark: SparkSession, out: str, batches: dict[str, list[str]]) -> DataFrame:
    folders = [f"{out}/query={q}/batch_id={b}" for q, numbers in batches.items() for b in numbers]
    return spark.read.option("basePath", out).parquet(*folders).drop("query", "batch_id")


def current_status(spark: SparkSession, out: str, key: str, order_by: tuple[str, ...]) -> DataFrame:
    """Newest state per key: the snapshot, and the batches since folded over it.

    Without a snapshot that is every batch. Right after `compact_status` the snapshot is the answer as it lies there.
    """
    before = snapshots.newest(spark, out)
    if before is None:
        return latest_status(read_batches(spark, out).drop("query", "batch_id"), key, order_by)
    fresh = _since(spark, out, before)
    if not fresh:
        return before.rows(spark)
    return latest_status(before.rows(spark).unionByName(_updates(spark, out, fresh)), key, order_by)


def compact_status(spark: SparkSession, out: str, key: str, order_by: tuple[str, ...]) -> snapshots.Manifest | None:
    """Folds the finished batches into a new snapshot; the manifest in force, None while there is nothing at all.

    The snapshot before and the new batches are read, not the batches it holds already. A stream may go on
    meanwhile: batches that finish later are read beside the snapshot. If the fold dies, the old
    version stays in force and the log is untouched. A key is in one file, in order, with Bloom filters, so that
    `state.lookup_points` asks it for single ids. A batch that its stream writes again after it was folded has the
    same rows, as a stream repeats a batch from the same offsets.
    """
    before = snapshots.newest(spark, out)
    fresh = _since(spark, out, before)
    if not fresh:
        return before
    rows = _updates(spark, out, fresh)
    if before is not None:
        rows = before.rows(spark).unionByName(rows)
    latest, folder = latest_status(rows, key, order_by), snapshots.draft_folder(out)
    latest.sortWithinPartitions(key).write.option(f"parquet.bloom.filter.enabled#{key}", True).parquet(folder)
    covered = {q: list(batches) for q, batches in (before.covered if before else {}).items()}
    for q, batches in fresh.items():
        covered[q] = sorted({*covered.get(q, ()), *batches}, key=int)
    return snapshots.publish(spark, out, before, folder, latest.schema, covered)


def drop_folded(spark: SparkSession, out: str, keep: int = 1) -> int:
    """Deletes the batch folders that every one of the `keep` newest versions holds, and older versions; how many went.

    Run it when no reader uses an older version. The newest batch of each query stays, because a stream
    that restarts may write it again.
    """
    gone = snapshots.expire(spark, out, keep)
    before = snapshots.newest(spark, out)
    for q, batches in (before.covered if before else {}).items():
        for b in batches[:-1]:
            folder = f"{out}/query={q}/batch_id={b}"
            if snapshots.exists(spark, folder):
                snapshots.remove(spark, folder)
                gone += 1
    return gone


def stream_current_status(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    key: str,
    order_by: tuple[str, ...],
    fold_every: int = 100,
    every: str | None = None,
) -> StreamingQuery:
    """Latest state per request kept incrementally, its log folded by the stream itself after every `fold_every` batches.

    A fold takes the time of a micro-batch that reads all keys. If another process folds the same log, one of the two is
    put off to the next time. A fold that fails otherwise ends the stream as a failed batch does; nothing is lost.
    """

    def fold(spark: SparkSession, batch_id: int) -> None:
        if (batch_id + 1) % fold_every == 0:
            try:
                compact_status(spark, out, key, order_by)
            except snapshots.SnapshotConflict:
                return

    return write_batches(stream_latest_status(stream, key, order_by), out, checkpoint, mode="update", every=every, after=fold)
