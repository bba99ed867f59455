"""What the operators decide, computed again directly."""

import heapq
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import alignment, decontamination, disclosure, packing, quality, sharding, toxicity, winnowing
from lectern.llm.common import id_and_text, table

SCHEMA = "doc_id long, text string"

# Toxicity


def test_the_fit_is_where_the_likelihood_is_highest():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(200):
        at = sorted(rng.choice(4, 2, replace=False).tolist())
        rate = rng.uniform(0, 3, 2).tolist()
        score = sum(r * (1.5, -1.0, 0.5, 0.0)[i] for i, r in zip(at, rate, strict=True)) + rng.logistic()
        rows.append({"grade": int(score > 1) + int(score > 3), "at": at, "rate": rate})
    weights, ridge = {True: 2.0, False: 1.0}, 1e-4
    beta, cuts = toxicity._fit(rows, weights, 4, 3, 4000, ridge)
    assert cuts[0] < cuts[1]
    scale = np.zeros(4)
    for r in rows:
        for i, v in zip(r["at"], r["rate"], strict=True):
            scale[i] += v * v
    scale = np.sqrt(scale / len(rows))
    total = sum(weights[r["grade"] > 0] for r in rows)
    sigmoid = lambda t: 1 / (1 + math.exp(-t))

    def loss(b, c):
        out = ridge / 2 * sum((x * s) ** 2 for x, s in zip(b, scale, strict=True))
        for r in rows:
            eta = sum(b[i] * v for i, v in zip(r["at"], r["rate"], strict=True))
            high = 1.0 if r["grade"] == 2 else sigmoid(c[r["grade"]] - eta)
            low = 0.0 if r["grade"] == 0 else sigmoid(c[r["grade"] - 1] - eta)
            out -= weights[r["grade"] > 0] / total * math.log(high - low)
        return out

    found = [*beta, *cuts]
    least = loss(found[:4], found[4:])
    for i in range(6):
        for step in (-0.05, 0.05):
            moved = list(found)
            moved[i] += step
            assert loss(moved[:4], moved[4:]) > least - 1e-6


def test_expected_severity_is_the_mean_of_the_grades(spark):
    model = toxicity.OrdinalModel({"bad": 0.4, "~^wors": 0.2, "fine": -0.3}, (1.0, 4.0))
    texts = ["bad and worse", "fine", "", None, "BAD bad, fine 12 words", "x " * 50 + "bad"]
    rows = toxicity.score(spark.createDataFrame(list(enumerate(texts)), SCHEMA), model).collect()
    for r in rows:
        words = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        hits = sum(model.weights.get(w, 0) + (0.2 if f"^{w}$".startswith("^wors") else 0) for w in words)
        eta = 100 * hits / max(1, len(words))
        above = [1 / (1 + math.exp(c - eta)) for c in model.cuts]
        p = [1 - above[0], above[0] - above[1], above[1]]
        assert math.isclose(r.expected_severity, p[1] + 2 * p[2], abs_tol=1e-9) and math.isclose(r.p_toxic, above[0], abs_tol=1e-9)
        assert r.grade == max(range(3), key=lambda k: (p[k], -k)) and r.rejected == (above[0] >= 0.5)
    accepted = toxicity.accepted(spark.createDataFrame(list(enumerate(texts)), SCHEMA), model).collect()
    assert {r.doc_id for r in accepted} == {r.doc_id for r in rows if not r.rejected}


def test_labels_without_a_document_do_not_count(spark):
    docs = spark.createDataFrame([(i, f"{'bad' if i < 30 else 'good'} word {i % 3}") for i in range(90)], SCHEMA)
    labels = docs.select("doc_id", (F.col("doc_id") < 30).cast("int").alias("grade"))
    strangers = spark.range(1000, 9000).select(F.col("id").alias("doc_id"), F.lit(0).alias("grade"))
    assert toxicity.fit(docs, labels, rows_per_class=40) == toxicity.fit(docs, labels.unionByName(strangers), rows_per_class=40)


# Personal data


def test_disclosing_terms_by_counting(spark):
    rng = random.Random(7)
    people = {f"p{i}@mail.example.org": f"name{chr(97 + i)}" * 2 for i in range(6)}
    names = {v: re.sub(r"\d", "", v) for v in people.values()}
    docs = []
    for _ in range(300):
        words = rng.choices(["alpha", "beta", "gamma", "delta", "omega"], k=5)
        if rng.random() < 0.5:
            mail, name = rng.choice(list(people.items()))
            words.append(mail.upper() if rng.random() < 0.3 else mail)
            if rng.random() < 0.9:
                words.append(names[name])
        if rng.random() < 0.02:
            words.append(rng.choice(list(names.values())))
        docs.append(" ".join(rng.sample(words, len(words))))
    docs += docs[:40]
    found = disclosure.find_patterns(spark.createDataFrame(list(enumerate(docs)), SCHEMA))
    got = {r.term for r in disclosure.disclosing_terms(found, 0.8, 3).collect()}
    mail_of = lambda t: {m.lower() for m in re.findall(r"[\w.]+@[\w.]+", t)}
    terms_of = lambda t: set(re.findall(r"[a-z]{3,}", re.sub(r"[\w.]+@[\w.]+", " | ", t).lower()))
    values, terms, both, texts = Counter(), Counter(), Counter(), defaultdict(set)
    held = defaultdict(set)
    for t in docs:
        values.update(mail_of(t))
        terms.update(terms_of(t))
        for v in mail_of(t):
            held[v].add(t)
            for w in terms_of(t):
                both[v, w] += 1
                texts[v, w].add(t)
    n, expected = len(docs), set()
    for (v, w), c in both.items():
        information = -math.log(values[v] / n)
        mutual = math.log(c * n / (values[v] * terms[w]))
        if len(texts[v, w]) >= 3 and len(held[v]) >= 3 and terms[w] >= 3 and mutual >= 0.8 * information - 1e-9:
            expected.add(w)
    assert got == expected and expected


# Fingerprints


def test_likeness_is_that_of_the_hashes(spark, small):
    rows = winnowing.compare_with_edits(id_and_text(table(spark, small, "documents"))).collect()
    rows.sort(key=lambda r: -r.doc_id)
    marks = lambda text: {m.split(":")[0] for m in text.split(",") if m}

    def jaccard(a, b):
        return 1.0 if not a and not b else len(a & b) / len(a | b)

    for r, after in zip(rows, [*rows[1:], rows[0]], strict=True):
        own = marks(r.fingerprint)
        assert math.isclose(r.near_edited, jaccard(own, marks(r.edited_fingerprint)))
        assert math.isclose(r.near_next, jaccard(own, marks(after.fingerprint)))


# Packing


def test_documents_follow_the_curve(spark, small):
    docs = id_and_text(table(spark, small, "documents"))
    vocabulary = packing.Vocabulary()
    place = {r.doc_id: (r.sequence_id, r.offset) for r in packing.pack(docs, 2048).where("start = 0").collect()}
    keys = {r.doc_id: int(packing.hilbert_key(np.array([packing.project(packing.encode(r.text or "", vocabulary))]))[0]) for r in docs.collect()}
    assert sorted(keys, key=lambda i: (keys[i], i)) == sorted(place, key=place.get)


# Sharding


def test_the_schedule_with_bundles_is_the_longest_first(spark):
    rng = random.Random(5)
    rows = [(f"g{min(rng.randrange(40), rng.randrange(40))}", rng.randrange(1, 100), i) for i in range(400)]
    df = spark.createDataFrame(rows, "group string, size long, order long")
    bundles = 6
    number = F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("int").alias("b")
    bundle = {r.group: r.b for r in df.select("group", number).distinct().collect()}
    sums = Counter()
    for group, size, _ in rows:
        sums[group] += size
    least = -(-sum(sums.values()) // bundles)
    items = Counter()
    for group, size in sums.items():
        items[group if size >= least else bundle[group]] += size
    loads, where = [(0, s) for s in range(4)], {}
    for item, size in sorted(items.items(), key=lambda x: (-x[1], str(x[0]))):
        load, shard = heapq.heappop(loads)
        where[item] = shard
        heapq.heappush(loads, (load + size, shard))
    got = {r.group: r.shard for r in sharding.shard(df, 4, bundles).collect()}
    assert got == {g: where[g if sums[g] >= least else bundle[g]] for g in sums}


# Decontamination


def kinds_of(text):
    out, opens = [], True
    for token in re.findall(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n]", text):
        if token in ".!?:\n":
            opens = True
            continue
        low = token.lower()
        if token[0].isdigit():
            kind = "number"
        elif low in decontamination.UNITS:
            kind = "unit"
        else:
            kind = "name" if len(token) > 1 and token[0].isupper() and not opens else "word"
        out.append((kind, low, len(token) > 1 and token[0].isupper()))
        opens = False
    return out


def holds(doc, item, width, literals):
    n = min(width, len(item))
    for i in range(len(item) - n + 1 if n else 0):
        theirs = item[i : i + n]
        for j in range(len(doc) - n + 1):
            mine = doc[j : j + n]
            if [t[1] for t in mine] == [t[1] for t in theirs]:
                return True
            # As templates: the first word may count as a word on either side.
            firsts = (theirs[0], ("word", *theirs[0][1:])) if theirs[0][0] == "name" else (theirs[0],)
            own = (mine[0], ("word", *mine[0][1:])) if mine[0][0] == "name" else (mine[0],)
            for a in firsts:
                for b in own:
                    x, y = [a, *theirs[1:]], [b, *mine[1:]]
                    if [k for k, *_ in x] != [k for k, *_ in y] or sum(k == "word" for k, *_ in x) < literals:
                        continue
                    there, back, fine = {}, {}, True
                    for (k, v, _), (_, w, _) in zip(x, y, strict=True):
                        if k == "word":
                            fine &= v == w
                        else:
                            fine &= there.setdefault((k, v), w) == w and back.setdefault((k, w), v) == v
                    if fine:
                        return True
    return False


def test_templates_by_comparing_all_windows(spark):
    rng = random.Random(11)
    words = "how many apples does share with each friend left after the trip".split()
    names, units = ["Anna", "Bert", "Cleo", "Dora"], ["km", "hours", "kg"]

    def sentence(size):
        pick = lambda: rng.choice([rng.choice(words)] * 6 + [rng.choice(names), str(rng.randrange(5)), rng.choice(units)])
        return " ".join(pick() for _ in range(size))

    def changed(text):
        swap = {a: rng.choice(names) for a in names}
        return " ".join(swap.get(w, str(int(w) + 1) if w.isdigit() else w) for w in text.split())

    items = [(i, sentence(rng.randrange(3, 18))) for i in range(12)]
    docs = []
    for i in range(60):
        text = rng.choice(items)[1]
        middle = [text, changed(text), changed(text).lower(), sentence(15)][i % 4]
        docs.append((i, " ".join([sentence(4), rng.choice(["", ".", "!"]), middle, sentence(3)])))
    found = decontamination.leaks(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), width=8, least_literals=4
    )
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    split_docs, split_items = [(i, kinds_of(t)) for i, t in docs], [(i, kinds_of(t)) for i, t in items]
    assert got == {(i, k) for i, d in split_docs for k, t in split_items if holds(d, t, 8, 4)}
    assert 20 < len(got) < 700


# The pipeline


def test_every_stage_decides_as_its_operator(spark, small):
    given = id_and_text(table(spark, small, "documents"))
    extra = spark.createDataFrame([(None, None), (9001, ""), (9002, None), (1, "another text of one id " * 4)], SCHEMA)
    docs = given.unionByName(extra).withColumns({"lang": F.lit("xx"), "grade": F.lit("school"), "_key": F.lit(5)})
    kept = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)
    fine = stages["toxicity"](spark, docs, small).cache()
    texts = id_and_text(docs)
    model = toxicity.fit(texts, toxicity.grade_labels(texts, table(spark, small, "labels")))
    assert kept(fine) == kept(toxicity.score(texts, model).where("NOT rejected"))
    assert 0.8 * docs.count() < fine.count() < docs.count()
    single = stages["near_duplicates"](spark, fine, small).cache()
    assert not kept(single) - kept(fine)
    clean = stages["decontamination"](spark, single, small).cache()
    leaked = {r.doc_id for r in decontamination.leaks(single, table(spark, small, "benchmark")).collect()}
    assert kept(clean) == Counter({k: n for k, n in kept(single).items() if k[0] not in leaked}) and leaked
    masked = stages["pii"](spark, clean, small).cache()
    assert sorted(r.doc_id or -1 for r in masked.collect()) == sorted(r.doc_id or -1 for r in clean.collect())
    left = disclosure.span_digest(disclosure.find_spans(masked.select("doc_id", "text"))).agg(F.sum("n_email"), F.sum("n_card")).first()
    assert tuple(left) == (0, 0)
    for df in (fine, single, clean, masked):
        assert df.columns == docs.columns and {(r.grade, r._key) for r in df.select("grade", "_key").distinct().collect()} == {("school", 5)}
    pieces = packing.pack(id_and_text(masked)).collect()
    vocabulary = packing.Vocabulary()
    expected = Counter(packing.encode(r.text or "", vocabulary).astype("<u4").tobytes() for r in masked.collect())
    own = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        own[p.doc_id].append(p)
    flat = b"".join(p.ids for parts in own.values() for p in parts)
    assert len(flat) == sum(len(k) * n for k, n in expected.items())
    packed = stages["packing"](spark, masked, small)
    assert packed.agg(F.sum("length")).first()[0] * 4 == len(flat)


# Long texts


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(5000)]
    return " ".join(rng.choices(words, k=1_500_000))


def test_one_text_of_many_megabytes(spark, long_text):
    docs = spark.createDataFrame([(1, long_text), (2, "short"), (3, None)], SCHEMA)
    model = toxicity.OrdinalModel({"bad": 1.0}, (1.0, 2.0))
    assert toxicity.accepted(docs, model).count() == 3
    good = quality.CompressionModel((), 0.5)
    assert {r.score for r in quality.score(docs, good).collect()} == {0.5}
    assert {r.doc_id: r.doc_tokens for r in packing.pack(docs).select("doc_id", "doc_tokens").distinct().collect()}[1] > 1_500_000
    aligned = {r.doc_id: r for r in alignment.align(docs).collect()}
    assert aligned[1].n_groups > 1_000_000 and aligned[2].n_groups >= 1 and aligned[3].groups_sha256 == ""
