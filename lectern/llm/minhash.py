"""MinHash near-dedup: banded candidates, sequential Bayesian pruning, exact verification."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import pieces_of_rows, rows_of, slices, text_hash
from lectern.llm.graph import components
from lectern.session import materialize

# With 40 bands of 6 a pair at a similarity of 0.8 shares no band with a probability of 5e-6.
BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
BATCH = 24  # Hashes compared before each decision.
MISS = 1e-4  # Probability, at each decision, of pruning a pair that is similar enough.
REMEMBERED = 200_000
PIECE = 2_000  # Members of a bucket that one task compares with its strangers.
SENT = 16 << 20  # Bytes of keys that are broadcast to find their texts.
MEMBERS, STRANGERS, SHINGLES = 1_000, 500, 1_000_000  # About what a tile holds when pairs are verified.

_random = np.random.default_rng(5)
FACTORS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str, k: int, known: dict) -> np.ndarray:
    """Hashes of the distinct runs of k words, rising; with fewer words, of all of them as one; none of no words."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(k, len(words))
    count = len(hashes) - width + 1
    out = np.full(count, np.uint64(width))
    for j in range(width):
        out = out * MIX + hashes[j : j + count]
        out ^= out >> np.uint64(31)
    return np.unique(out * FACTORS[0])


def signature(own: np.ndarray) -> np.ndarray:
    """The least of each hash function over the set, 32 bits each."""
    least = np.full(HASHES, np.uint64(0xFFFFFFFF))
    for start in range(0, len(own), 2048):
        some = own[start : start + 2048]
        np.minimum(least, ((some[:, None] * FACTORS + SHIFTS) >> np.uint64(32)).min(axis=0), out=least)
    return least


def _sketch(k: int):
    names = ["doc_id", "text_key", "set_id", "n", "bands", "bits"]

    def run(batches):
        known, salt = _Hashes(), np.arange(BANDS, dtype=np.uint64)
        for part in slices(batches, 1):
            out = []
            for doc_id, key, text in rows_of([part], "doc_id", "text_key", "text"):
                own = shingles(text or "", k, known)
                if not len(own):
                    out.append((doc_id, key, None, 0, None, None))
                    continue
                least = signature(own)
                bands = salt
                for row in least.reshape(BANDS, ROWS).T:
                    bands = (bands ^ row) * MIX
                    bands = bands ^ (bands >> np.uint64(29))
                out.append(
                    (doc_id, key, hashlib.md5(own.tobytes()).digest(), len(own), bands.view(np.int64), least.astype(np.uint8).tobytes())
                )
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    return run


def least_matches(percent: int, miss: float = MISS) -> dict[int, int]:
    """For n hashes compared: with fewer matches a pair is pruned.

    With a uniform prior, m matches among n leave similarity s with a Beta(m + 1, n - m + 1)
    distribution, so P(s >= t) = P(Binomial(n + 1, t) <= m); pruned where that is below `miss`. Eight bits of each
    hash are compared, which agree by chance once in 256.
    """
    t, out = percent / 100, {}
    t += (1 - t) / 256
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out[n] = m
    return out


def _plausible(percent: int):
    limits = least_matches(percent)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (
                np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), np.uint8).reshape(-1, HASHES)
                for c in ("bits_a", "bits_b")
            )
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for n, least in limits.items():
                part = slice(n - BATCH, n)
                matches[alive] += (one[alive, part] == other[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], ["a", "b"])

    return run


def _confirmed(k: int, percent: int):
    def run(batches):
        known = _Hashes()
        last, own = None, None
        for batch in slices(batches, 2, rows=128):
            keep = []
            for a, one, other in rows_of([batch], "a", "text_a", "text_b"):
                if a != last:
                    last, own = a, shingles(one, k, known)
                theirs = shingles(other, k, known)
                both = len(np.intersect1d(own, theirs, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(theirs) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in (0, 1)], ["a", "b"])

    return run


def _across(percent: int):
    """Per bucket piece: which of its strangers may be similar to which members of other components.

    A row per stranger and block of members: (x, block, ys).
    """
    limits = least_matches(percent)

    def run(group: pa.Table) -> pa.Table:
        column = lambda c: group.column(c).to_numpy()
        key, piece, node, part, main, block, stranger = (
            column(c) for c in ("key", "piece", "node", "c", "main", "block", "stranger")
        )
        bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint8).reshape(-1, HASHES)
        order = np.lexsort((piece, key))
        edge = np.flatnonzero((np.diff(key[order]) != 0) | (np.diff(piece[order]) != 0)) + 1
        found = defaultdict(set)
        for rows in np.split(order, edge):
            members = rows[~stranger[rows]]
            for x in rows[stranger[rows]].tolist():
                # Two strangers visit each other's pieces: the larger node compares.
                due = (part[members] != part[x]) & ((part[members] == main[members]) | (node[members] < node[x]))
                alive = members[due]
                matches = np.zeros(len(alive), np.int64)
                for n, least in limits.items():
                    span = slice(n - BATCH, n)
                    matches += (bits[alive, span] == bits[x, span]).sum(axis=1)
                    good = matches >= least
                    alive, matches = alive[good], matches[good]
                for where in np.unique(block[alive]).tolist():
                    found[int(node[x]), where].update(node[alive[block[alive] == where]].tolist())
        return pa.table(
            {
                "x": pa.array([x for x, _ in found], pa.int64()),
                "block": pa.array([where for _, where in found], pa.int64()),
                "ys": pa.array([sorted(ys) for ys in found.values()], pa.list_(pa.int64())),
            }
        )

    return run


def _confirmed_in_tiles(k: int, percent: int):
    """Exactly similar pairs of the strangers and the block of each tile: one link per stranger and component."""

    def run(group: pa.Table) -> pa.Table:
        known, links = _Hashes(), set()
        columns = (group.column(c).to_pylist() for c in ("block", "part", "node", "c", "ys", "text"))
        tiles = defaultdict(lambda: ({}, []))
        for block, part, node, c, ys, text in zip(*columns, strict=True):
            sets, strangers = tiles[block, part]
            if ys is None:
                sets[node] = (c, shingles(text, k, known))
            else:
                strangers.append((node, ys, text))
        for sets, strangers in tiles.values():
            for x, ys, text in strangers:
                own, joined = shingles(text, k, known), set()
                for y in ys:
                    c, theirs = sets[y]
                    # Bounded by the sizes before the sets are looked through.
                    if c in joined or 100 * min(len(own), len(theirs)) < percent * max(len(own), len(theirs)):
                        continue
                    at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
                    both = int((own[at] == theirs).sum())
                    if 100 * both >= percent * (len(own) + len(theirs) - both):
                        joined.add(c)
                        links.add((min(x, y), max(x, y)))
        pairs = sorted(links)
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return run


def _sent(keys: DataFrame) -> DataFrame:
    """`keys`, a written table, for broadcast if it is small."""
    rows = keys.count()
    return F.broadcast(keys) if rows * 32 * len(keys.columns) <= SENT else keys


class _Verifier:
    """Prunes and verifies candidate pairs of classes; `candidates` (node) are all that may be in a pair."""

    def __init__(self, documents: DataFrame, classes: DataFrame, candidates: DataFrame, k: int, percent: int):
        self.classes, self.k, self.percent = classes, k, percent
        keys = materialize(classes.select("node", "text_key").join(candidates, "node", "left_semi"), "keys")
        # Every text once, whatever the rounds ask for; other texts leave their task only if there are very many keys.
        found = documents.select("text_key", "text").join(_sent(keys), "text_key")
        self.every_text = materialize(found.groupBy("node").agg(F.first("text").alias("text")), "candidates")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough, exactly."""
        return self.confirmed(self.plausible(pairs))

    def plausible(self, pairs: DataFrame) -> DataFrame:
        bits = self.classes.select("node", "bits")
        signed = pairs.join(bits.toDF("a", "bits_a"), "a").join(bits.toDF("b", "bits_b"), "b")
        signed = signed.select("a", "b", "bits_a", "bits_b")
        return signed.mapInArrow(_plausible(self.percent), "a long, b long")

    def confirmed(self, alive: DataFrame) -> DataFrame:
        alive = materialize(alive, "plausible")
        if alive.isEmpty():
            return alive
        nodes = alive.select(F.col("a").alias("node")).unionByName(alive.select(F.col("b").alias("node"))).distinct()
        texts = self.texts(nodes)
        full = alive.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
        full = full.select("a", "b", "text_a", "text_b")
        return materialize(full.mapInArrow(_confirmed(self.k, self.percent), "a long, b long"), "links")

    def texts(self, nodes: DataFrame) -> DataFrame:
        """(node, text) of the classes in `nodes`."""
        return materialize(self.every_text.join(_sent(materialize(nodes, "nodes")), "node", "left_semi"), "texts")

    def across(self, apart: DataFrame) -> DataFrame:
        """Links (a, b) between the components that buckets still hold, of `apart` as `_mixed` gives it.

        Plausible pairs are never rows of their own: a stranger has one row per block of members it may be
        similar to. A block is a part of the nodes whose least bucket is the same, so that a group's
        members meet in few blocks; a tile is a block with some of its strangers, and holds about a million shingles.
        """
        nodes = apart.groupBy("node").agg(F.min("key").alias("home"), F.first("c").alias("c"))
        nodes = materialize(nodes.join(self.classes.select("node", "bits", "n"), "node"), "nodes")
        homes = nodes.groupBy("home").agg(self._cuts(MEMBERS).alias("cuts"))
        block = F.xxhash64("home", F.pmod(F.xxhash64("node"), "cuts"))
        nodes = nodes.join(homes, "home").select("node", "c", "bits", "n", block.alias("block"))
        rows = apart.join(nodes.select("node", "bits", "block"), "node")
        own = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")
        columns = ["key", "node", "c", "main", "bits", "block"]
        every = rows.select(*columns, own.alias("piece"), F.lit(False).alias("stranger"))
        strangers = rows.where("c <> main").select(
            *columns, F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(True).alias("stranger")
        )
        groups = pieces_of_rows(apart, 20_000, 8)
        dealt = every.unionByName(strangers).withColumn("deal", F.pmod(F.xxhash64("key", "piece"), F.lit(groups)))
        found = dealt.groupBy("deal").applyInArrow(_across(self.percent), "x long, block long, ys array<long>")
        found = found.groupBy("x", "block").agg(F.array_distinct(F.flatten(F.collect_list("ys"))).alias("ys"))
        found = materialize(found, "plausible")
        asked = found.select("block").distinct()
        blocks = nodes.join(asked, "block", "left_semi")
        texts = self.texts(found.select(F.col("x").alias("node")).unionByName(blocks.select("node")).distinct())
        sized = found.join(nodes.select(F.col("node").alias("x"), "n", "c"), "x")
        parts = sized.groupBy("block").agg(self._cuts(STRANGERS).cast("int").alias("parts"))
        part = F.pmod(F.xxhash64("x"), F.col("parts")).cast("int")
        columns = ["block", "part", "node", "c", "ys", "text"]
        asking = sized.join(parts, "block").withColumn("part", part).withColumnRenamed("x", "node")
        asking = asking.join(texts, "node").select(*columns)
        none = F.lit(None).cast("array<bigint>")
        answering = blocks.join(parts, "block").join(texts, "node").withColumn("ys", none)
        answering = answering.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*columns)
        tiles = pieces_of_rows(found, 1_000, 8)
        deal = F.pmod(F.xxhash64("block", "part"), F.lit(tiles))
        tiled = asking.unionByName(answering).withColumn("deal", deal).groupBy("deal")
        return materialize(tiled.applyInArrow(_confirmed_in_tiles(self.k, self.percent), "a long, b long"), "links")

    @staticmethod
    def _cuts(rows: int):
        """In how many parts to cut a group of rows with `n` shingles each."""
        return F.floor(F.count("*") / rows + F.sum("n") / SHINGLES) + 1


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """`members` (key, node) with their component so far."""
    labels = components(links).withColumnRenamed("component", "c")
    return members.join(labels, "node", "left").withColumn("c", F.coalesce("c", "node"))


def _mixed(labels: DataFrame) -> DataFrame:
    """Rows of buckets with several components, with the bucket's largest and in how many pieces to cut it."""
    sizes = labels.groupBy("key", "c").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("key").agg(
        F.max_by("c", F.struct("n", "c")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("n")
    )
    pieces = (F.floor(F.col("n") / PIECE) + 1).cast("int").alias("pieces")
    return labels.join(buckets.where("parts > 1").select("key", "main", pieces), "key")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept, component) of (doc_id, text), a row for each.

    A document's set: the distinct runs of `k` of its words (lower case, A-Z only); with fewer words all
    of them as one; without words empty, and linked with nothing. Documents whose sets have
    100 * intersection >= percent * union are linked, confirmed on full sets; component_id is the
    smallest doc_id of all that can be reached, kept tells the row that has it. A NULL text has no words, NULL ids
    count as larger than all others (a component of them only has a NULL component_id and its rows are kept). Ids need not be
    unique, so component_id does not identify a component: component does, a number of this run (NULL without words).

    Equal sets are one class. Classes that share a band are candidates, but a bucket's pairs are never
    all made: first each class is compared with one leader of its buckets, then with the others not
    connected yet, and last, in buckets that still hold several components, the members outside the
    largest (strangers) with the members of other components, signature by signature within pieces of
    the bucket; what is plausible is verified in tiles. Whatever is in one component needs no further comparing.
    """
    keyed = documents.select("doc_id", "text").withColumn("text_key", text_hash(F.col("text")))
    sketches = keyed.mapInArrow(
        _sketch(k), "doc_id long, text_key string, set_id binary, n long, bands array<long>, bits binary"
    )
    sketches = materialize(sketches, "sketches")
    some = sketches.where("n > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first(F.struct("text_key", "bands", "bits", "n")).alias("s")
    )
    classes = some.select(F.monotonically_increasing_id().alias("node"), "set_id", "rep", "s.*")
    classes = materialize(classes, "classes")
    bands = classes.select("node", F.explode("bands").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    members = materialize(bands.join(buckets.select("key", "leader"), "key"), "members")
    stars = members.where("node <> leader").groupBy(F.col("leader").alias("a"), F.col("node").alias("b"))
    stars = materialize(stars.agg(F.count("*").alias("shared")), "stars")
    verifier = _Verifier(keyed, classes, members.select("node").distinct(), k, percent)
    # First the leader a class shares most buckets with.
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a")).select("a", "b")
    best = materialize(best, "best")
    links = verifier.links(best)
    # Then the other leaders that it is not connected with.
    labels = materialize(_labelled(members.select("key", "node"), links), "labelled")
    of_node = labels.select("node", "c").distinct()
    rest = stars.select("a", "b").join(best, ["a", "b"], "left_anti")
    rest = rest.join(of_node.toDF("a", "ca"), "a").join(of_node.toDF("b", "cb"), "b").where("ca <> cb").select("a", "b")
    links = materialize(links.unionByName(verifier.links(rest)), "links")
    # Then, with all that is still apart, each stranger of a bucket against all of it.
    apart = materialize(_mixed(_labelled(members.select("key", "node"), links)), "apart")
    if not apart.isEmpty():
        links = materialize(links.unionByName(verifier.across(apart)), "links")
    found = classes.select("node", "set_id", "rep").join(components(links), "node", "left")
    found = found.withColumn("component", F.coalesce("component", "node"))
    least = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = found.join(least, "component").select("set_id", "component_id", "component")
    rows = sketches.select("doc_id", "text_key", "set_id", F.col("n").alias("n_shingles")).join(by_set, "set_id", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    rows = rows.select("doc_id", "text_key", "n_shingles", own.alias("component_id"), "component")
    return rows.select("doc_id", "text_key", "n_shingles", "component_id", kept, "component")


def deduplicate(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """`documents` with one row of each component of `near_duplicates`; other columns stay as they are.

    It is the row with the smallest doc_id (NULL last) and then text key. Rows without words are all
    kept. Of rows that are equal in id and text one stays.
    """
    found = near_duplicates(documents.select("doc_id", "text"), k, percent)
    found = materialize(found, "near")
    # A component's least row always counts as kept.
    kept = found.where("kept").groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("times"))
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "times")
    kept = kept.select("component", row.alias("one"))
    one = kept.where("component IS NOT NULL").groupBy("component").agg(F.min("one").alias("one"))
    one = one.unionByName(kept.where("component IS NULL")).select("one.*").drop("none")
    # The given columns stay in a struct, so that none can have a name that is used here.
    keyed = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), text_hash(F.col("text")).alias("own_key"))
    rows = keyed.join(one, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key")))
    if not one.where("times > 1").isEmpty():
        again = rows.where("times > 1").dropDuplicates(["own_id", "own_key"])
        rows = rows.where("times = 1").unionByName(again)
    return rows.select("row.*")
