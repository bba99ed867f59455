"""Every operator against a brute-force version, over the small table with awkward rows added."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm import (
    chunks,
    debruijn,
    decontamination,
    disclosure,
    minhash,
    ngrams,
    packing,
    sharding,
    suffixes,
    toxicity,
    winnowing,
)
from lectern.llm.common import id_and_text, pack, pack_sorted, table, unpack, unpack_sorted

SCHEMA = "doc_id long, text string"
AWKWARD = [
    (None, "the lone row of no id"),
    (9001, None),
    (9002, ""),
    (9003, " \t\n "),
    (9004, "x" * 3000),
    (9005, "ab" * 400),
    (9006, "word"),
    (9007, "WORD"),
    (9008, "a@b.c_d@e.f x@y..z 1.2.3.4.5.6.7.8 999.1.1.1.1 card 4111 1111-1111 1111 +1 (234) 567-8901 +49-12"),
    (9009, "€ü@x.de ü.a@b.co 𝒳 1.1.1.1 " + "1" * 4000 + " a <|endoftext|> b"),
]


@pytest.fixture(scope="module")
def documents(spark, small):
    given = id_and_text(table(spark, small, "documents")).where("doc_id < 120")
    return given.unionByName(spark.createDataFrame(AWKWARD, SCHEMA)).cache()


@pytest.fixture(scope="module")
def rows(documents):
    return sorted(((r.doc_id, r.text or "") for r in documents.collect()), key=lambda r: (r[0] is None, r[0] or 0))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    """Several chunks and shards from little data."""
    for module in (suffixes, debruijn, ngrams):
        monkeypatch.setattr(module, "chunked", lambda df: chunks.chunked(df, 150_000))


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def test_empty_tables(nothing, spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for df in (
        ngrams.score(nothing), winnowing.compare_with_edits(nothing), disclosure.find_spans(nothing),
        minhash.near_duplicates(nothing, 2), packing.pack(nothing), sharding.shard_texts(nothing),
        suffixes.without_repeats(nothing), debruijn.repeated_spans(nothing), decontamination.leaks(nothing, benchmark),
    ):
        assert df.count() == 0


def test_sorted_blocks():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        for top in (10, 1 << 40, 1 << 64):
            values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
            assert np.array_equal(unpack_sorted(pack_sorted(values)), values)


@pytest.mark.parametrize("hash_bits", [64, 6])
def test_words_repeated_from_smaller_ids(documents, rows, hash_bits):
    # With six bits nearly every edge has the hash of others, and nothing may be removed or kept for that.
    found = by_id(debruijn.repeated_spans(documents, with_text=False, hash_bits=hash_bits))
    seen = set()
    for doc_id, text in rows:
        words = text.encode().split()
        keys = [tuple(words[i : i + 13]) for i in range(len(words) - 12)]
        gone = {i + j for i, key in enumerate(keys) if key in seen for j in range(13)}
        seen.update(keys)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        r = found[doc_id]
        assert (r.n_words, r.n_removed, r.kept) == (len(words), len(gone), sha(kept))
    assert any(r.n_removed for r in found.values())


def test_paths_are_compacted(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), "a " + " ".join(words), " ".join(words[:30]) + " b c", None, "z " + " ".join(words)]
    table_of = chunks.chunked(spark.createDataFrame(list(enumerate(texts)), SCHEMA))
    paths = debruijn.compact(debruijn.path_occurrences(table_of)).collect()
    assert {(r.words, r.times, r.source, r.source_doc, r.source_at) for r in paths} == {(60, 2, 0, 0, 0), (30, 1, 0, 0, 0)}
    assert all(r.same for r in debruijn.verified(table_of, spark.createDataFrame(paths)).collect())


def test_long_chains_and_circles(spark):
    rng = np.random.default_rng(4)
    numbers = rng.permutation(700).tolist()
    chain, other, circle, alone = numbers[:500], numbers[500:503], numbers[503:520], numbers[520:522]
    links = [*zip(chain, chain[1:], strict=False), *zip(other, other[1:], strict=False), *zip(circle, circle[1:] + circle[:1], strict=True), tuple(alone)]
    found = {r.node: r["first"] for r in debruijn.chains(spark.createDataFrame(links, "node long, next long")).collect()}
    expected = {n: c[0] for c in (chain, other, alone) for n in c} | {n: min(circle) for n in circle}
    assert found == expected
    assert debruijn.chains(spark.createDataFrame([], "node long, next long")).count() == 0


def test_paths_that_always_follow_each_other_are_joined(spark):
    one, two, three = ([f"{c}{i}" for i in range(40)] for c in "abc")
    # The last text has the first three end to end: edges across their borders are new, so three paths with gaps; a
    # later copy of it has one source throughout.
    texts = [" ".join(one), " ".join(two), " ".join(three), " ".join(one + two + three), " ".join(one + two + three)]
    found = by_id(debruijn.repeated_spans(spark.createDataFrame(list(enumerate(texts)), SCHEMA)))
    assert [(p.start, p.length, p.source) for p in found[3].paths] == [(0, 28, 0), (40, 28, 1), (80, 28, 2)]
    last = [(p.start, p.length, p.source) for p in found[4].paths]
    assert last == [(0, 28, 0), (28, 12, 3), (40, 28, 1), (68, 12, 3), (80, 28, 2)]
    # Paths 1 and 2 of it also stand alone, so nothing joins them; the text is gone as a whole.
    assert found[4].n_removed == 120 and found[3].n_removed == 120


def test_bytes_that_start_earlier(documents, rows):
    found = by_id(suffixes.without_repeats(documents, with_text=False))
    seen = set()
    for doc_id, text in rows:
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            key = raw[i : i + 100]
            if key in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(key)
        spans = len(bytes(gone).replace(b"\0", b" ").split())
        r = found[doc_id]
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept) == (len(raw), sum(gone), spans, sha(kept))
    assert found[9004].n_removed > 2000


def brute_scan(text: bytes, places, length):
    seen, out = set(), []
    for p in places:
        out.append(text[p : p + length] in seen)
        seen.add(text[p : p + length])
    return out


@pytest.mark.parametrize("collide", [False, True])
def test_level_family_scans_and_merges(collide):
    rng = np.random.default_rng(5)
    text = rng.integers(97, 100, 4000).astype(np.uint8)
    raw, length = text.tobytes(), 6
    family = suffixes.LevelFamily(text, length)
    places = np.arange(len(text) - length + 1)
    hashes = suffixes.run_hashes(text, length)
    keys = hashes % np.uint64(17) if collide else hashes  # Many texts with one fingerprint.
    found = []
    for low in range(0, len(places), 100):
        found += family.scan(keys[low : low + 100], places[low : low + 100]).tolist()
        assert len(family.levels) <= 10
    assert found == brute_scan(raw, places.tolist(), length)
    sizes = [len(k) for k, _ in family.levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:], strict=False))


def test_without_levels_repeats_between_batches_are_missed(monkeypatch):
    monkeypatch.setattr(suffixes, "BATCH", 50)
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 123, 600).astype(np.uint8).tobytes()
    blocks = []
    for number in range(2):
        text = bytes([48 + number]) * 150 + passage + bytes([50 + number]) * 150
        chunk = chunks.Chunk(number, np.array([number]), np.array([len(text)]), text)
        shared = np.packbits(np.ones(len(np.unique(suffixes.stretches(chunk, 100)[2])), bool))
        blocks += [block for _, block in suffixes._stretch_question(100, 1)(chunk, [{0: pack(shared)}])]
    repeats = lambda: [int(np.unpackbits(unpack(r)).sum()) for r in suffixes._stretch_answer(100)(blocks)[0]]
    # Every window of the passage is a repeat in the second text, and none in the first beyond its own padding.
    with_levels = repeats()
    monkeypatch.setattr(suffixes.LevelFamily, "_add", lambda *_: None)
    without = repeats()
    assert with_levels[1] - with_levels[0] == 501 and without[1] - without[0] < 501


def test_probabilities(documents, rows):
    found = by_id(ngrams.score(documents, 20.0, 5.0))
    texts = {i: [*t.encode().lower().split(), b"\n"] for i, t in rows}
    out = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    learnt = [w for i, w in texts.items() if not out[i]]
    c1 = Counter(a for w in learnt for a in w)
    c2 = Counter(p for w in learnt for p in zip(w, w[1:], strict=False))
    c3 = Counter(p for w in learnt for p in zip(w, w[1:], w[2:], strict=False))
    context = Counter()
    for (a, b, _), n in c3.items():
        context[a, b] += n
    total, kinds = sum(c1.values()), len(c1)

    def p(words):
        one = (c1[words[-1]] + 0.1) / (total + 0.1 * (kinds + 1))
        if len(words) == 1:
            return one
        two = (c2[words[-2:]] + 20 * one) / (c1[words[-2]] + 20)
        return two if len(words) == 2 else (c3[words] + 5 * two) / (context[words[:2]] + 5)

    for i, w in texts.items():
        r = found[i]
        known = sum(c1[a] > 0 for a in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(w), known, total)
        assert math.isclose(r.base_score, sum(math.log10(p((a,))) for a in w), rel_tol=1e-9)
        exact = sum(math.log10(p(tuple(w[max(0, j - 2) : j + 1]))) for j in range(len(w)))
        assert abs(r.score - exact) < 3e-4 * len(w)


def test_elias_fano():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 500):
        values = np.sort(rng.integers(0, 100_000, n))
        coded = ngrams.EliasFano.opened(ngrams.EliasFano.coded(values))
        assert np.array_equal(coded.access(np.arange(n)), values)
        asked = np.concatenate([values, rng.integers(0, 120_000, 300)])
        whole = (np.zeros(len(asked), int), np.full(len(asked), n))
        assert np.array_equal(coded.successor(asked, *whole), np.searchsorted(values, asked))
        # Within a part of the sequence only.
        first = rng.integers(0, n + 1, len(asked))
        last = rng.integers(first, n + 1)
        expected = [a + np.searchsorted(values[a:b], x) for x, a, b in zip(asked, first, last, strict=True)]
        assert np.array_equal(coded.successor(asked, first, last), expected)


def test_successors_of_a_context():
    rng = np.random.default_rng(3)
    grams = sorted({tuple(g) for g in rng.integers(0, 9, (200, 3)).tolist()})
    pairs = sorted({g[:2] for g in grams} | {(20, 1), (21, 0)})
    place = {p: i for i, p in enumerate(pairs)}
    packed = np.array([(a << 32) | b for a, b in pairs], np.uint64)
    parent, third = np.array([place[g[:2]] for g in grams]), np.array([g[2] for g in grams])
    ones = lambda x: np.ones(len(x))
    trie = ngrams.Trie(ngrams.Trie.built(packed, ones(pairs), ones(pairs), parent, third, ones(grams), 1.0, 1.0))
    # Every pair and word there is, and many that are not.
    asked = [(a, b) for a in range(23) for b in range(10)]
    words = [(i, w) for i in range(len(asked)) for w in range(11)]
    codes = trie.lookup(
        np.array([(a << 32) | b for a, b in asked], np.uint64), np.array([i for i, _ in words]), np.array([w for _, w in words])
    )
    assert [c > 0 for c in codes[0].tolist()] == [p in place for p in asked]
    assert [c > 0 for c in codes[2].tolist()] == [(*asked[i], w) in set(grams) for i, w in words]
    # The unary parts are read where they lie: nothing is kept per element.
    assert sum(x.nbytes for x in (trie.third.ones, trie.third.zeros)) <= 16 * (len(grams) // 16 + 2)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def patterns_of(text: str) -> list[str]:
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_personal_data_by_pattern(documents, rows):
    found = by_id(disclosure.span_digest(disclosure.find_spans(documents)))
    for doc_id, text in rows:
        assert found[doc_id].base_sha256 == sha(",".join(patterns_of(text)).encode())
    assert found[9008].n_email == 2 and found[9008].n_card == 1 and found[9008].n_phone == 1


def test_terms_that_disclose(spark):
    pairs = ("apples bridges", "candles dragons", "engines forests", "gardens hammers")
    texts = [f"{p} Zaphod writes from zz@planet.example.com about {p}" for p in pairs]
    texts += ["many people write from home about apples"] * 40 + ["someone writes about nothing"] * 40
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    spans = by_id(disclosure.span_digest(disclosure.find_spans(df)))
    assert spans[0].spans == "term:15:21,email:34:55"
    assert all("term" not in spans[i].spans for i in range(4, 84))
    masked = by_id(disclosure.sanitise(df))
    assert masked[0].text == "apples bridges [TERM] writes from [EMAIL] about apples bridges" and masked[10].text == texts[10]


def test_terms_disclose_in_all_documents(spark):
    """Also far from the value, in whatever case it is spelt, and where it is not."""
    filler = "many people write from home about apples " * 5
    texts = [f"Zaphod says {c} {filler} {a}" for c in "xy" for a in ("Zz@Planet.example.com", "zz@planet.example.COM")]
    texts += ["so Zaphod left"] + [f"{filler} says {i}" for i in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    masked = by_id(disclosure.sanitise(df))
    assert masked[0].text == f"[TERM] says x {filler} [EMAIL]" and masked[4].text == "so [TERM] left"
    assert all(masked[i].text == texts[i] for i in range(5, 85))


def test_near_duplicates(documents, rows):
    found = by_id(minhash.near_duplicates(documents, 2).where("doc_id IS NOT NULL"))
    sets = {}
    for i, text in rows:
        w = text.encode().lower().split()
        sets[i] = frozenset(zip(w, w[1:], strict=False)) if len(w) > 1 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = [i for i in sets if i is not None]
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    for i in ids:
        r = found[i]
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[i]), root(i), root(i) == i)
    assert found[9007].component_id == 9006


def test_deduplicate_keeps_one_row(spark):
    df = spark.createDataFrame([(1, "a b c", 1), (1, "a b c", 1), (2, "a b c", 2), (3, None, 3), (3, None, 3)], SCHEMA + ", kept int")
    assert sorted(tuple(r) for r in minhash.deduplicate(df).collect()) == [(1, "a b c", 1), (3, None, 3)]


def test_deduplicate_tells_components_of_one_id_apart(spark):
    given = [
        (None, "an alpha text without id"), (None, "some beta words without id"), (None, "some beta words without id"),
        (1, "gamma text under one id"), (1, "other delta words with it"), (2, "other delta words with it"),
        (None, "gamma text under one id"), (None, None), (4, ""),
    ]
    kept = minhash.deduplicate(spark.createDataFrame(given, SCHEMA)).collect()
    expected = [given[i] for i in (0, 1, 3, 4, 7, 8)]
    assert Counter(map(tuple, kept)) == Counter(expected)


def test_near_duplicate_stage_by_brute_force(spark, documents, small):
    """One row of each component of five-word sets, with repeated and missing ids."""
    more = [(None, "no id and so many other words here"), (None, "no id but a text of its own"), (3, "the id of another text")]
    df = documents.unionByName(spark.createDataFrame(more, SCHEMA))
    given = sorted(set(map(tuple, df.collect())), key=lambda r: (r[0] is None, r[0] or 0, sha((r[1] or "").encode())))
    sets = []
    for _, text in given:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(given)))
    for a in range(len(given)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    names = {}
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.without_near_duplicates(spark, df, small).collect())
    assert max(kept.values()) == 1
    for n, row in enumerate(given):
        names.setdefault(group[n], []).append(row)
    assert sum(kept.values()) == len(names)
    for rows_ in names.values():
        own = [r for r in rows_ if r in kept]
        least = rows_[0][0]
        assert len(own) == 1 and own[0][0] == least


def test_the_model_is_fitted_on_arrays_not_on_rows():
    rows = [(0, [0], [1.0]), (1, [1, 2], [2.0, 0.5]), (0, [], []), (2, [1], [3.0]), (0, [0, 2], [0.5, 0.5])]
    kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()))
    whole = pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["grade", "at", "rate"])
    # As the tasks send them: in several batches, some of them parts of others.
    parts = pa.concat_tables([whole.slice(0, 2), whole.slice(2, 0), whole.slice(2, 3)])
    fits = [toxicity._fit(t, {True: 2.0, False: 1.0}, 3, 3, 50, 1e-4) for t in (whole, parts)]
    assert (fits[0][0] == fits[1][0]).all() and fits[0][1] == fits[1][1]
    assert fits[0][0][0] < 0 < fits[0][0][1]


def test_packing_works_on_slices_of_a_batch():
    # Long and short rows in one batch, which must not be turned into Python objects, or sent on, as a whole.
    rng, length = np.random.default_rng(3), 64
    sizes = [1, *rng.integers(1, 6_000, 900).tolist(), 3 * packing.SLICE_BYTES, 5]
    blocks = [rng.integers(0, 50_000, n).astype("<u2").tobytes() for n in sizes]
    ends = np.cumsum(sizes)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(sizes)), pa.int64()), pa.array(ends - sizes, pa.int64()), pa.array(blocks, pa.binary())], ["doc_id", "at", "ids"]
    )
    out = list(packing._pieces(length)(iter([batch])))
    assert max(b.nbytes for b in out) <= 2 * packing.SLICE_BYTES
    pieces = [p for b in out for p in b.to_pylist()]
    assert all(p["sequence_id"] * length + p["offset"] == ends[p["doc_id"]] - sizes[p["doc_id"]] + p["start"] for p in pieces)
    assert all(p["offset"] + p["length"] <= length and p["doc_tokens"] == sizes[p["doc_id"]] for p in pieces)
    whole = defaultdict(bytes)
    for p in pieces:
        assert len(whole[p["doc_id"]]) == 4 * p["start"] and len(p["ids"]) == 4 * p["length"]
        whole[p["doc_id"]] += p["ids"]
    assert [whole[i] for i in range(len(sizes))] == [np.frombuffer(b, "<u2").astype("<u4").tobytes() for b in blocks]


def test_packing(documents, rows):
    pieces = packing.pack(documents).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = defaultdict(list)
    for p in pieces:
        own[p.doc_id].append(p)
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        parts = sorted(own[doc_id], key=lambda p: p.start)
        assert b"".join(p.ids for p in parts) == np.array(ids, "<u4").tobytes()
        assert all(p.doc_tokens == len(ids) for p in parts)
    ends = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends[p.sequence_id]
        ends[p.sequence_id] += p.length
    assert all(n == 2048 for s, n in ends.items() if s != max(ends))


def test_hilbert_neighbours_touch():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_key(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_shards(documents, rows):
    got = sharding.shard_texts(documents, 4).collect()
    assert sorted(Counter(r.shard for r in got)) == [0, 1, 2, 3]
    for shard in range(4):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    place = by_id(sharding.shard_texts(documents, 4))
    groups = defaultdict(set)
    for i, text in rows:
        if i != 9001:
            groups[text].add(place[i].shard)
        assert place[i].size == len(text.encode()) + 1 and place[i].text_crc32 == zlib.crc32(text.encode())
    assert all(len(s) == 1 for s in groups.values())
    loads = Counter()
    for r in got:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) <= max(len(t.encode()) + 1 for _, t in rows)


def test_schedule_takes_the_longest_first():
    placed = sharding.schedule({"a": 7, "b": 6, "c": 5, "d": 4, "e": 3}, 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0}


def test_fingerprints(documents, rows):
    found = by_id(winnowing.compare_with_edits(documents).where("doc_id IS NOT NULL"))
    order = [r for r in reversed([r for r in rows if r[0] is not None])] + [r for r in rows if r[0] is None]
    for n, (i, text) in enumerate(order):
        if i is None:
            continue
        after = order[(n + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == sha(edited.encode())
        assert 0 <= r.near_edited <= 1 and (edited != text or r.fingerprint == r.edited_fingerprint)
    assert np.mean([r.near_edited for r in found.values()]) > 0.25 > 0.05 > np.mean([r.near_next for r in found.values()])


def test_winnowing_by_brute_force(spark):
    text = " ".join(f"w{i % 17}q{i % 5}" for i in range(120))
    units = [w[i : i + 4] for w in text.split() for i in range(0, len(w), 4)]
    hashed = [r[0] for r in spark.createDataFrame([(u,) for u in units], "u string").select(
        F.pmod(F.xxhash64("u"), F.lit(winnowing.PRIME - 1)) + 1
    ).collect()]
    grams = [sum(h * winnowing.BASE ** (3 - j) for j, h in enumerate(hashed[i : i + 4])) % winnowing.PRIME for i in range(len(units) - 3)]
    picked = []
    for i in range(len(grams) - 7):
        best = min(range(i, i + 8), key=lambda j: (grams[j], -j))
        if not picked or picked[-1] != (grams[best], best):
            picked.append((grams[best], best))
    got = winnowing.fingerprints(spark.createDataFrame([(1, text)], SCHEMA)).first().fingerprint
    assert [(x.hash, x.position) for x in got] == picked


def test_benchmark_items_are_found(spark, documents, rows, small):
    benchmark = table(spark, small, "benchmark")
    items = {r.item_id: r.text for r in benchmark.collect()}
    found = {(r.doc_id, r.item_id) for r in decontamination.leaks(documents, benchmark).collect()}
    assert found == {(i, k) for i, t in rows for k, item in items.items() if item in t}
    kept = {r.doc_id for r in decontamination.decontaminate(documents, benchmark).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in found}


def test_changed_numbers_and_names_are_found(spark):
    item = "A train with 3 wagons leaves and Anna counts 3 wagons while Ben counts 5 km of track in all"
    asked = {
        1: item.replace("3", "8").replace("Anna", "Clara").replace("5 km", "70 miles"),
        2: item.replace("counts 3", "counts 4"),
        3: "An unrelated text about trains and wagons that goes on for a while without end",
    }
    docs = spark.createDataFrame([(i, f"Some words first. {t}. More words.") for i, t in asked.items()], SCHEMA)
    found = decontamination.leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string"), width=20).collect()
    assert [(r.doc_id, r.item_id, r.exact) for r in found] == [(1, 7, False)]


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    documents, labels = id_and_text(table(spark, folder, "documents")), table(spark, folder, "labels")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    known = labels.where(fold == 0)
    model = toxicity.fit(documents, toxicity.grade_labels(documents, known))
    other = documents.join(labels.where(fold == 1), "doc_id").withColumn("grade", F.lit("clash"))
    scored = toxicity.score(other, model).collect()
    toxic, clean = ([r for r in scored if r.toxic == t] for t in (1, 0))
    assert sum(r.rejected for r in toxic) / len(toxic) > 0.9
    assert sum(r.rejected for r in clean) / len(clean) < 0.01
    assert all(0 <= r.expected_severity <= 2 for r in scored)
    assert all(a < b for a, b in zip(model.cuts, model.cuts[1:], strict=False))


def test_copies_are_found_whatever_they_are_made_of(spark):
    items = {
        1: "What is the capital city of France",
        2: "Yes or no",
        3: "Boil 3 kg, 4 kg, 5 kg, 6 kg and 7 kg for 8 minutes, 9 minutes and 10 minutes",
        4: "Anna gave Ben and Clara and Dora and Emil one of the apples that Fritz had picked",
        5: "",
    }
    asked = {
        11: ("we asked What is the capital city of France and", {1}),
        12: ("we asked What is the capital city of Spain and", {1}),
        13: ("we asked Where is the capital city of France and", set()),
        14: ("they said YES OR NO to it", {2}),
        15: (f"so {items[3]} at least", {3}),
        16: (items[4].upper(), {4}),
        17: (items[4].lower(), {4}),
        18: ("yes and no", set()),
        19: (None, set()),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in asked.items()], SCHEMA)
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontamination.leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, k) for i, (_, own) in asked.items() for k in own}
    assert {r.doc_id for r in found if not r.exact} == {12}
    kept = {r.doc_id for r in decontamination.decontaminate(docs, benchmark).collect()}
    assert kept == {i for i, (_, own) in asked.items() if not own}


@pytest.mark.parametrize("rows_per_class", [50, 100, 1000])
def test_prior_does_not_depend_on_the_sample(spark, rows_per_class):
    """The mean probability is the share of toxic labels, whether classes are cut or not."""
    toxic = [(i, f"{'bad' if i % 10 < 6 else 'good'} words number {chr(97 + i % 7) * 3}") for i in range(80)]
    clean = [(i, f"{'bad' if i % 10 < 2 else 'good'} words number {chr(97 + i % 7) * 3}") for i in range(80, 400)]
    documents = spark.createDataFrame(toxic + clean, SCHEMA)
    labels = documents.select("doc_id", (F.col("doc_id") < 80).cast("int").alias("toxic"))
    model = toxicity.fit(documents, toxicity.grade_labels(documents, labels, rows_per_class), rows_per_class=rows_per_class)
    assert model.weights
    mean = toxicity.score(documents, model).agg(F.avg("p_toxic")).first()[0]
    assert abs(mean - 80 / 400) < 0.04


def test_pipeline(spark, small):
    docs = table(spark, small, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small)
        assert after.schema.names == docs.schema.names
        assert 0 < after.count() <= docs.count()
        docs = after
    pieces = corpus_pipeline.run(spark, small)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} <= {r.doc_id for r in docs.collect()}
