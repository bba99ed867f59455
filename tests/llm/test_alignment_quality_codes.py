"""Cross-tokenizer links, the compression classifier and vector codes against brute force."""

import dataclasses
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lectern.llm import alignment, disclosure, metric_trees, minhash, quality, sharding, toxicity, winnowing
from lectern.llm.common import id_and_text, table
from lectern.llm.queries import QUERIES

# Alignment


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_table():
    """The byte that each character of a byte-level entry stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def tokens_of(text, encoders):
    """[(id, end byte)] of A and of B; empty without tokens."""
    a, b = encoders
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    known = byte_table()
    bytes_a = [bytes(known[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        is_byte = len(piece) == 6 and piece.startswith("<0x")
        bytes_b.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode())
    raw = (" " + text).encode()
    if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return [], []
    ends = lambda ids, parts: list(zip(ids, np.cumsum([len(p) for p in parts]).tolist(), strict=True))
    return ends(ids_a, bytes_a), ends(ids_b, bytes_b)


def groups_of(a, b):
    cuts = sorted({e for _, e in a} & {e for _, e in b})
    out = [([], []) for _ in cuts]
    for side, own in enumerate((a, b)):
        for i, e in own:
            out[int(np.searchsorted(cuts, e))][side].append(i)
    return out


TEXTS = ["plain words and more", "", None, "  two  spaces\n\n\ttabs", "<|endoftext|> and </s> are text", "▁odd▁", "ﬁne éé",
         "\U0001d4b3 日本語 مرحبا", "x" * 500, "a", " ", "nul\x00byte", "plain words and more", "1234567 8.9e10 don't"]


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 200])
def test_alignment(spark, small, encoders, monkeypatch, chunk_bytes):
    monkeypatch.setattr(alignment, "TERMS", 64)
    given = id_and_text(table(spark, small, "documents")).where("doc_id < 40").collect()
    rows = [(r.doc_id, r.text) for r in given] + [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (1000, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("chunk", F.lit("clash"))
    found = Counter(tuple(r) for r in alignment.align(df, chunk_bytes=chunk_bytes).collect())
    groups = [groups_of(*tokens_of(t or "", encoders)) for _, t in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    count = Counter(p for own in links for p in set(own))
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    expected = Counter()
    for (doc_id, _), g, own in zip(rows, groups, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        best = sum(count[p] == highest[p[0]] for p in own)
        sizes = (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own))
        digest = hashlib.sha256(text.encode()).hexdigest() if g else ""
        expected[(doc_id, *sizes, best, sum(count[p] for p in own), digest)] += 1
    assert found == expected


def test_long_texts_are_cut_where_both_end_tokens(encoders, monkeypatch):
    tools = alignment.encoders(alignment.Vocabularies())
    rng = random.Random(2)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "don't", "éé", "12", "."]) for _ in range(4000))
    whole = tools.tokens(text)
    monkeypatch.setattr(alignment, "SEGMENT", 50)
    parts = tools.tokens(text)
    assert len(whole) == 1 and len(parts) > 20
    for side in (0, 1):
        assert np.concatenate([p[side] for p in parts]).tolist() == whole[0][side].tolist()


def test_white_space_that_the_fast_encoder_refuses(encoders):
    tools = alignment.encoders(alignment.Vocabularies())
    text = " " * 1_000_000 + "a"
    assert tools.a(text) == encoders[0].encode(text, add_special_tokens=False).ids


def test_overlap_links_of_a_text():
    overlap, shared = alignment.links("unbelievable tokens")
    dense = lambda links: {(a, b) for a, b, *_ in links}
    assert dense(overlap) <= dense(shared) and sum(n for *_, n in overlap) == len(" unbelievable tokens")
    assert alignment.links("") == ([], [])


def test_gustavson_by_dense_product(monkeypatch):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 3, (7, 9)) * rng.integers(0, 2, (7, 9)), rng.integers(0, 3, (9, 5)) * rng.integers(0, 2, (9, 5))
    csr = lambda m: alignment.Csr.of(*np.nonzero(m), m[np.nonzero(m)], m.shape)
    for terms in (1, 4, 1000):
        monkeypatch.setattr(alignment, "TERMS", terms)
        product = csr(a).times(csr(b))
        dense = np.zeros((7, 5), int)
        dense[product.rows, product.columns] = product.values
        assert np.array_equal(dense, a @ b) and np.array_equal(csr(a).transposed().starts, csr(a.T.copy()).starts)


# Quality


@pytest.fixture(scope="module")
def model(spark):
    folder = "/root/testdata/sf0.1"
    return quality.fit(id_and_text(table(spark, folder, "documents")), table(spark, folder, "labels"))


def test_quality_on_held_out_rows(spark, model):
    folder = "/root/testdata/sf0.1"
    docs = id_and_text(table(spark, folder, "documents"))
    scored = quality.score(docs, model).join(table(spark, folder, "labels"), "doc_id")
    rows = scored.where(quality.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 500 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert np.mean([r.predicted for r in good]) > 0.99 and np.mean([r.predicted for r in bad]) < 0.15
    pairs = [(g.score > b.score) + 0.5 * (g.score == b.score) for g in good for b in bad]
    assert np.mean(pairs) > 0.99
    # Calibrated: the mean score is the share of label 1.
    assert abs(np.mean([r.score for r in rows]) - len(good) / len(rows)) < 0.03


def test_quality_is_of_the_text_alone(spark, model):
    rows = [(1, "same text, twice"), (None, "same text, twice"), (2, None), (3, ""), (4, "x" * 3_000_000), (5, "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit(7.0), "lang": F.lit("en")})
    found = quality.score(df, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    score = {r.doc_id: r.score for r in found}
    assert score[1] == score[None] and score[2] == score[3]


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(9)] + [(None, 0), (77, 0), (2, None)], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, ones)).collect()} == {1.0}
    # So little text that no dictionary can be trained.
    both = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, quality int")
    few = quality.score(docs, quality.fit(docs, both)).collect()
    assert len(few) == 9 and all(0 <= r.score <= 1 for r in few)
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), both)).count() == 0


def test_held_out_labels_are_not_looked_at(spark, small):
    docs, labels = id_and_text(table(spark, small, "documents")), table(spark, small, "labels")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, labels) == quality.fit(docs, turned)


# Codes


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    q = np.array([r[2] for r in kept], object)
    width = -(-q.shape[1] // parts)
    q = np.concatenate([q, np.zeros((len(q), parts * width - q.shape[1]), int)], axis=1).astype(object)
    codes, error, books = [], np.zeros(len(q), object), []
    for p in range(parts):
        x = q[:, p * width : (p + 1) * width]
        book = x[:entries].copy()
        for step in range(rounds + 1):
            d = ((x[:, None] - book[None]) ** 2).sum(2)
            best = d.argmin(1)
            for e in range(len(book) if step < rounds else 0):
                if (best == e).any():
                    book[e] = [int(s) // int((best == e).sum()) for s in x[best == e].sum(0)]
        codes.append(best)
        error += d[np.arange(len(x)), best]
        books.append(book)
    label_error = defaultdict(int)
    for (_, label, _), e in zip(kept, error, strict=True):
        label_error[label] += e
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1)).encode()).hexdigest()
    text = ["".join(f"{c:02x}" for c in row) for row in zip(*codes, strict=True)]
    return Counter((i, t, e, label_error[label], digest) for (i, label, _), t, e in zip(kept, text, error, strict=True))


SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, dims, spread, seed):
    rng = np.random.default_rng(seed)
    return [(i, rng.choice(spread, dims).tolist() if isinstance(spread, list) else rng.normal(0, spread, dims).tolist(), [None, 1, 2][i % 3]) for i in range(n)]


ODD = [(900, None, 1), (901, [None] * 16, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] * 16, 2), (None, [0.5] * 16, None),
       (5, [0.25] * 16, 7), (5, [0.25] * 16, 7), (904, [0.1] * 3, 1), (905, [], 1), (3, [-0.001] * 16, None)]


@pytest.mark.parametrize("case", ["many", "ties", "few", "uneven"])
def test_vector_codes(spark, case, monkeypatch):
    monkeypatch.setattr(metric_trees, "BLOCK", 1024)
    monkeypatch.setattr(metric_trees, "LEAF", 8)
    rows = {
        "many": vectors(3000, 32, 0.2, 1),
        "ties": vectors(500, 16, [-0.01, 0.0, 0.004, 0.008], 2) + ODD,
        "few": vectors(20, 16, 0.3, 3) + ODD,
        "uneven": vectors(300, 21, 0.1, 4),
    }[case]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("code", F.lit("the caller's"))
    if case in ("ties", "few"):
        rows = [r for r in rows if r[1] is None or len(r[1]) == 16]
    monkeypatch.setattr(metric_trees, "SENT", 4 << 20 if case == "many" else 0)
    found = Counter(tuple(r) for r in metric_trees.compress(df).collect())
    assert found == brute_codes(rows)


def test_vector_codes_of_no_vectors(spark):
    assert metric_trees.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert metric_trees.compress(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).count() == 0


def test_balls_hold_their_points_and_settle_most_of_them(monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.integers(-2000, 2000, (40, 4))
    points = (centres[rng.integers(0, 40, 6000)] + rng.integers(-20, 20, (6000, 4))).astype(np.int64)
    tree = metric_trees.Tree.unpacked(metric_trees.build(points).packed())
    assert np.array_equal(tree.points, points[tree.order]) and sorted(tree.order.tolist()) == list(range(6000))
    for i in range(len(tree.start)):
        own = tree.points[tree.start[i] : tree.end[i]]
        assert np.array_equal(own.sum(0), tree.sums[i])
        assert np.sqrt(((own - tree.centre[i]) ** 2).sum(1)).max() <= tree.radius[i] + 1e-6
        if tree.left[i] >= 0:
            a, b = tree.left[i], tree.right[i]
            assert (tree.start[a], tree.end[a], tree.end[b]) == (tree.start[i], tree.start[b], tree.end[i])
    sums, counts, chosen = metric_trees.nearest(tree, points[:64], True)
    d = ((tree.points[:, None] - points[:64][None]) ** 2).sum(2)
    assert np.array_equal(chosen, d.argmin(1)) and counts.sum() == 6000
    whole = metric_trees.nearest(tree, centres.astype(np.int64), False)
    # With an entry in each cluster, wholly owned balls settle nearly all: most points are never looked at.
    blind = metric_trees.Tree(np.zeros_like(tree.points), *[getattr(tree, f.name) for f in dataclasses.fields(tree)[1:]])
    unseen = metric_trees.nearest(blind, centres.astype(np.int64), False)
    assert (unseen[1] != whole[1]).sum() <= 10 and unseen[1].sum() == 6000
    d = ((tree.points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert np.array_equal(whole[1], np.bincount(d, minlength=40))
    assert np.array_equal(whole[0], np.stack([np.bincount(d, tree.points[:, j], 40) for j in range(4)], 1).astype(int))


def test_large_components_stay_whole(spark):
    rows = [(i, [3e38 if i == 1 else float(i)] * 16, None) for i in range(3)]
    found = metric_trees.compress(spark.createDataFrame(rows, SCHEMA), entries=1, rounds=0).collect()
    assert {r.vec_id: r.error for r in found} == {0: 0, 1: 16 * (1 << 27) ** 2, 2: 16 * 512**2}


# Names


def test_columns_of_the_user_stay(spark, small):
    texts = [(i, f"document number {i} says write to user{i}@mail.example.org or 10.0.0.{i} about {'this and that ' * i}") for i in range(8)]
    names = ["_key", "_own", "_spans", "_times", "_bundle", "_bin", "_edited", "_range", "grade", "rejected", "row", "spans", "text_key", "times", "id", "one"]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    given = docs.withColumns({n: F.concat(F.lit(f"{n} of "), "doc_id") for n in names})
    model = toxicity.OrdinalModel({}, (30.0, 31.0))
    for kept in (disclosure.sanitise(given), minhash.deduplicate(given), toxicity.accepted(given, model)):
        assert kept.columns == given.columns
        rows = kept.collect()
        assert len(rows) == 8 and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names)
    sized = given.withColumns({"group": F.col("text"), "size": F.lit(5).cast("long"), "order": F.col("doc_id"), "shard": F.lit("mine")})
    placed = sharding.shard(sized).collect()
    assert len(placed) == 8 and all(r[n] == f"{n} of {r.doc_id}" for r in placed for n in names) and {r.shard for r in placed} <= set(range(8))
    plain = winnowing.compare_with_edits(docs)
    assert sorted(winnowing.compare_with_edits(given).collect()) == sorted(plain.collect())


def test_the_queries_are_registered(spark, small):
    for name in ("op11_alignment", "op12_quality", "op13_vector_codes"):
        source = "embeddings" if name.startswith("op13") else "documents"
        assert QUERIES[name](spark, small).count() == table(spark, small, source).count()
