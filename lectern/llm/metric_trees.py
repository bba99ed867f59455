"""Vector codes: product quantisation whose rounds walk metric trees instead of comparing every part with every entry.

The parts at one position of a block of vectors are put into a tree of balls, made middle-out: about
sqrt(n) anchors first, each the point farthest from the anchors before and owner of what is nearest to it;
balls of anchors merged upwards, the smallest parent first; each anchor's own points split the same way below. Every ball
keeps the sum and count of its points. A round walks the trees from the top with a list of entries that may be
nearest: a ball inherits its parent's list and drops the entries that another is nearer than to all of
the ball. A ball with one entry left is wholly owned: its sum and count go to that entry and nothing below is
looked at. Only leaves with several entries left compare points, in whole numbers, so ties are exact.
"""

import hashlib
import math
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import joined, pack, parted, unpack
from lectern.operators.skew import salted_join
from lectern.session import materialize

BLOCK = 8_192  # Vectors of one block; a tree holds one part of each.
LEAF = 48  # Points of a ball that is not split.
LARGEST = 1 << 27  # Whole components beyond are cut to it, so that squares and sums stay exact.
SENT = 4 << 20  # Bytes of label sums that are broadcast.


@dataclass
class Tree:
    """Balls from the top down, a ball's points side by side; inner balls have two children."""

    points: np.ndarray  # Whole components, in the order of the balls.
    order: np.ndarray  # Each point's row in the block.
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray  # -1 at a leaf.
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    sums: np.ndarray

    def packed(self) -> bytes:
        values = [getattr(self, f.name) for f in fields(self)]
        return joined(*(pack(x.reshape(-1)) for x in values), pack(np.array(self.points.shape)))

    @staticmethod
    def unpacked(block: bytes) -> "Tree":
        *values, shape = map(unpack, parted(block))
        values[0] = values[0].astype(np.int64)
        wide = {0, 6, 8}
        return Tree(*(x.reshape(-1, shape[1]) if i in wide else x for i, x in enumerate(values)))


def anchors(points: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor that owns each point: each new one is the point farthest from its owner and takes what is nearer to it."""
    distance = np.sqrt(((points - points[0]) ** 2).sum(1))
    owner, pivots = np.zeros(len(points), np.int64), [points[0]]
    while len(pivots) < wanted:
        far = int(distance.argmax())
        if distance[far] == 0:
            break
        new = points[far]
        between = np.sqrt(((np.array(pivots) - new) ** 2).sum(1))
        # Points nearer to their owner than half the way to the new anchor cannot be taken.
        near = np.flatnonzero(distance > between[owner] / 2)
        theirs = np.sqrt(((points[near] - new) ** 2).sum(1))
        taken = theirs < distance[near]
        owner[near[taken]], distance[near[taken]] = len(pivots), theirs[taken]
        pivots.append(new)
    return owner


def _merged(centres: np.ndarray, radii: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of balls in the order they are merged, the smallest enclosing ball first; a merged ball has the next number."""
    n = len(centres)
    centre, radius, count = centres.copy(), radii.copy(), counts.astype(float)
    number, pairs = list(range(n)), []
    apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2))
    size = np.maximum((apart + radius[:, None] + radius[None]) / 2, np.maximum(radius[:, None], radius[None]))
    np.fill_diagonal(size, np.inf)
    for step in range(n - 1):
        a, b = divmod(int(size.argmin()), n)
        pairs.append((number[a], number[b]))
        both = count[a] + count[b]
        middle = (centre[a] * count[a] + centre[b] * count[b]) / both
        reach = max(math.dist(middle, centre[i]) + radius[i] for i in (a, b))
        centre[a], radius[a], count[a], number[a] = middle, reach, both, n + step
        away = np.sqrt(((centre - middle) ** 2).sum(1))
        row = np.maximum((away + radius + reach) / 2, np.maximum(radius, reach))
        row[np.isinf(size[a])] = np.inf
        row[b] = row[a] = np.inf
        size[a], size[:, a] = row, row
        size[b], size[:, b] = np.inf, np.inf
    return pairs


def _grown(points: np.ndarray, rows: np.ndarray):
    """A ball as nested pairs; a leaf is an array of rows."""
    if len(rows) <= LEAF:
        return rows
    own = points[rows]
    owner = anchors(own, math.isqrt(len(rows) - 1) + 1)
    parts = owner.max() + 1
    if parts == 1:  # All equal.
        return rows
    by_owner = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=parts)
    cuts = np.cumsum(counts) - counts
    centres = np.add.reduceat(own[by_owner], cuts) / counts[:, None]
    reach = np.sqrt(((own[by_owner] - np.repeat(centres, counts, 0)) ** 2).sum(1))
    balls = [_grown(points, rows[by_owner[c : c + n]]) for c, n in zip(cuts.tolist(), counts.tolist(), strict=True)]
    for a, b in _merged(centres, np.maximum.reduceat(reach, cuts), counts):
        balls.append((balls[a], balls[b]))
    return balls[-1]


def build(points: np.ndarray) -> Tree:
    """The tree of whole `points` (a row each)."""
    left, right, start, end, leaves, at = [], [], [], [], [], 0
    waiting = [(_grown(points.astype(float), np.arange(len(points))), -1, left)]
    while waiting:  # Depth first, the left child first: a ball's points are side by side.
        ball, parent, side = waiting.pop()
        if parent >= 0:
            side[parent] = len(start)
        start.append(at)
        end.append(at)
        left.append(-1)
        right.append(-1)
        if isinstance(ball, tuple):
            me = len(start) - 1
            waiting += [(ball[1], me, right), (ball[0], me, left)]
        else:
            leaves.append(ball)
            at += len(ball)
            end[-1] = at
    start, end, left, right = (np.array(x, np.int32) for x in (start, end, left, right))
    for i in range(len(start) - 1, -1, -1):
        if right[i] >= 0:
            end[i] = end[right[i]]
    order = np.concatenate(leaves).astype(np.int32)
    own = points[order]
    sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(own, 0, dtype=np.int64)])
    sums = sums[end] - sums[start]
    count = (end - start).astype(np.int64)
    centre = sums / count[:, None]
    # Every ball's radius from its own points.
    which = np.repeat(np.arange(len(start)), count)
    first = np.cumsum(count) - count
    place = np.repeat(start - first, count) + np.arange(int(count.sum()))
    radius = np.sqrt(np.maximum.reduceat(((own[place] - centre[which]) ** 2).sum(1), first))
    return Tree(own.astype(np.int32), order, start, end, left, right, centre, radius, sums)


def nearest(tree: Tree, book: np.ndarray, assign: bool):
    """(sums and counts of each entry of `book`; with `assign` each point's entry, in the tree's order).

    The nearest entry by squared distance, ties to the lower index.
    """
    m, entries = len(book), book.astype(float)
    sums, counts = np.zeros((m, book.shape[1]), np.int64), np.zeros(m, np.int64)
    chosen = np.zeros(len(tree.points), np.int64) if assign else None
    between = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(2))
    # Of equal entries only the first can be chosen.
    possible = ~np.tril(between == 0, -1).any(1)
    balls, lists = np.zeros(1, np.int64), possible[None].copy()
    leaves, leaf_lists = [], []
    while len(balls):
        square = ((tree.centre[balls][:, None] - entries[None]) ** 2).sum(2)
        best = np.where(lists, square, np.inf).argmin(1)
        least = square[np.arange(len(balls)), best][:, None]
        # All of the ball is strictly nearer to `best`: it lies on its side of the plane between. The margin covers rounding.
        clear = square - least - 1e-9 * (square + least) - 1e-6 > 2 * between[best] * tree.radius[balls][:, None]
        lists &= ~clear
        lists[np.arange(len(balls)), best] = True
        owned = lists.sum(1) == 1
        np.add.at(sums, best[owned], tree.sums[balls[owned]])
        np.add.at(counts, best[owned], (tree.end - tree.start)[balls[owned]])
        if assign:
            for ball, entry in zip(balls[owned].tolist(), best[owned].tolist(), strict=True):
                chosen[tree.start[ball] : tree.end[ball]] = entry
        leaf = ~owned & (tree.left[balls] < 0)
        leaves.append(balls[leaf])
        leaf_lists.append(lists[leaf])
        inner = ~owned & ~leaf
        balls = np.concatenate([tree.left[balls[inner]], tree.right[balls[inner]]]).astype(np.int64)
        lists = np.concatenate([lists[inner], lists[inner]])
    balls, lists = np.concatenate(leaves), np.concatenate(leaf_lists)
    if len(balls):
        size, width = (tree.end - tree.start)[balls].astype(np.int64), lists.sum(1)
        entry_of, begins = np.nonzero(lists)[1], np.cumsum(width) - width
        leaf_of = np.repeat(np.arange(len(balls)), size)
        point = np.repeat(tree.start[balls] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        width, begins = width[leaf_of], begins[leaf_of]
        heads = np.cumsum(width) - width
        pair_point = np.repeat(point, width)
        pair_entry = entry_of[np.repeat(begins - heads, width) + np.arange(int(width.sum()))]
        square = ((tree.points[pair_point] - book[pair_entry]) ** 2).sum(1)
        hit = np.flatnonzero(square == np.repeat(np.minimum.reduceat(square, heads), width))
        entry = pair_entry[hit[np.searchsorted(hit, heads)]]  # The first of the least: the lowest index.
        np.add.at(sums, entry, tree.points[point])
        counts += np.bincount(entry, minlength=m)
        if assign:
            chosen[point] = entry
    return sums, counts, chosen


def whole_components(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; NULL where the vector or a component is NULL or not finite."""
    x = lambda v: v.cast("double")
    fine = F.forall(vector, lambda v: F.coalesce(F.abs(x(v)) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x(v)))
    limit = F.lit(float(LARGEST))
    floor = F.transform(vector, lambda v: F.least(F.greatest(F.floor(x(v) * scale).cast("double"), -limit), limit).cast("int"))
    return F.when(vector.isNotNull() & fine, floor)


def _blocks(parts: int, width: int):
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary()))

    def flush(number, ids, labels, vectors):
        q = np.array(vectors, np.int64)
        padded = np.zeros((len(q), parts * width), np.int64)
        padded[:, : q.shape[1]] = q
        trees = [build(padded[:, p * width : (p + 1) * width]).packed() for p in range(parts)]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip((number, ids, labels, trees), kinds, strict=True)],
            ["block", "ids", "labels", "trees"],
        )

    def run(batches):
        number, held = TaskContext.get().partitionId() << 32, ([], [], [])
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                for column, values in zip(held, part.columns, strict=True):
                    column += values.to_pylist()
                if len(held[0]) >= BLOCK:
                    yield flush(number, *held)
                    number, held = number + 1, ([], [], [])
        if held[0]:
            yield flush(number, *held)

    return run


def _round(books: list[np.ndarray]):
    """Sums of each part, entry and component over the blocks of a task: (part, entry, component, sum, n)."""

    def run(batches):
        sums, counts = [np.zeros(b.shape, np.int64) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for i in range(batch.num_rows):
                for p, block in enumerate(batch.column(0)[i]):
                    more, n, _ = nearest(Tree.unpacked(block.as_py()), books[p], False)
                    sums[p] += more
                    counts[p] += n
        for p, (total, n) in enumerate(zip(sums, counts, strict=True)):
            used = np.flatnonzero(n)
            if len(used):
                width = total.shape[1]
                columns = (np.full(len(used) * width, p), np.repeat(used, width), np.tile(np.arange(width), len(used)))
                values = (total[used].reshape(-1), np.repeat(n[used], width))
                kinds = [pa.int32()] * 3 + [pa.int64()] * 2
                arrays = [pa.array(c, t) for c, t in zip((*columns, *values), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "component", "sum", "n"])

    return run


def _coded(books: list[np.ndarray]):
    digits = np.array([f"{i:02x}" for i in range(len(books[0]))], object) if len(books[0]) else None

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels, trees = (batch.column(c)[i].as_py() for c in range(3))
                error, codes = np.zeros(len(ids), np.int64), np.zeros((len(ids), len(trees)), np.int64)
                for p, block in enumerate(trees):
                    tree = Tree.unpacked(block)
                    _, _, chosen = nearest(tree, books[p], True)
                    codes[tree.order, p] = chosen
                    error[tree.order] += ((tree.points - books[p][chosen]) ** 2).sum(1)
                code = ["".join(row) for row in digits[codes].tolist()]
                columns = [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(code), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return run


def compress(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of (vec_id, embedding, label), a row per kept vector.

    Components become floor(scale * x). Vectors that are NULL or hold a NULL or non-finite component are dropped, and so are
    vectors of another length than most (ties: the longer). A length that `parts` does not divide is filled up with zeros;
    whole components beyond 2^27 are cut to it. Each part position starts with that part of the
    `entries` smallest vec_ids (NULL after all others, equal ids by their components) and goes through `rounds` of assigning
    every part to the nearest entry (ties: lower index) and moving used entries to floor(sum / count). At most 256
    entries. label_error sums the error over equal labels, NULLs together. Repeated rows count each; an empty table gives no rows.

    Trees are built once, block by block, and stay where they are written; a round sends the codebooks out (parts * entries
    rows) and as many sums back, whatever the number of vectors.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: between 1 and 256 entries")
    spark = vectors.sparkSession
    whole = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        whole_components(F.col("embedding"), scale).alias("q"),
    ).where("q IS NOT NULL AND size(q) > 0")
    lengths = whole.groupBy(F.size("q").alias("size")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.col("n").desc(), F.col("size").desc()).first()
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if most is None:
        return spark.createDataFrame([], schema)
    whole, width = whole.where(F.size("q") == most["size"]), -(-most["size"] // parts)
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).collect()
    start = np.zeros((len(first), parts * width), np.int64)
    start[:, : most["size"]] = [r["q"] for r in first]
    books = [start[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    made = whole.mapInArrow(_blocks(parts, width), "block long, ids array<long>, labels array<string>, trees array<binary>")
    blocks = materialize(made, "trees")
    for _ in range(rounds):
        sums = blocks.select("trees").mapInArrow(_round(books), "part int, entry int, component int, sum long, n long")
        sums = sums.groupBy("part", "entry", "component").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
        for r in sums.collect():  # parts * entries * width rows at most
            books[r["part"]][r["entry"], r["component"]] = r["sum"] // r["n"]
    coded = blocks.select("ids", "labels", "trees").mapInArrow(_coded(books), "vec_id long, label string, code string, error long")
    coded = materialize(coded.withColumn("same", F.coalesce(F.concat(F.lit("="), "label"), F.lit("none"))).drop("label"), "codes")
    errors = materialize(coded.groupBy("same").agg(F.sum("error").alias("label_error")), "errors")
    sent = errors.agg(F.sum(F.octet_length("same").cast("long") + 48).alias("n")).first()["n"]
    if (sent or 0) <= SENT:
        rows = coded.join(F.broadcast(errors), "same")
    else:
        rows = salted_join(coded, errors, "same", ["vec_id", "code"])
    text = ",".join(str(v) for book in books for v in book.reshape(-1).tolist())
    digest = F.lit(hashlib.sha256(text.encode()).hexdigest())
    return rows.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
