"""Hot keys and giant groups: the balanced plans must give the plain answers."""

import math
import random
from collections import Counter

import pytest
from compare import rows
from pyspark.sql import functions as F

from lectern.config import JobConfig
from lectern.operators import keywords, sections, skew, state
from lectern.operators.extract import enrich_text

TINY = JobConfig(broadcast_bytes=0, page_bucket=4, outline_chunk=3)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key, a third have none."""
    rng = random.Random(1)
    data = [(i, None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{rng.randrange(400)}") for i in range(6000)]
    return spark.createDataFrame(data, "id bigint, key string")


@pytest.fixture(autouse=True, scope="module")
def everything_counts_as_big():
    """Small test tables must take the salted way, too."""
    before, skew.salted_join.__defaults__ = skew.salted_join.__defaults__, ("left", None, 0.01, 0)
    yield
    skew.salted_join.__defaults__ = before


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("min_rows", [0, 10**6])
def test_salted_join_equals_join(spark, hot, how, min_rows):
    right = spark.createDataFrame([("hot", 1), ("unused", 2), *[(f"k{i}", i) for i in range(300)]], "key string, v int")
    salted = skew.salted_join(hot, right, "key", ["id"], how, min_rows=min_rows)
    plain = hot.join(right, "key", how)
    assert ("_piece" in salted._jdf.queryExecution().optimizedPlan().toString()) == (min_rows == 0)
    assert rows(salted.columns, salted.collect()) == rows(plain.columns, plain.collect())


def test_key_counts(spark, hot):
    counts = skew.count_keys(hot, "key")
    assert (counts.rows, counts.largest) == (6000, 2000)
    hottest = {r["key"]: r["pieces"] for r in counts.hot_keys(0.1, 0).collect()}
    assert hottest == {"hot": 4, None: 4}
    for share in (0.1, 0.01, 0.001):
        pieces = [r["pieces"] for r in counts.hot_keys(share, 0).collect()]
        assert len(pieces) <= 1 / share and sum(pieces) <= 2 / share
    assert counts.hot_keys(0.5, 0) is None and counts.hot_keys() is None
    assert counts.small_keys(100) is None
    keys = counts.small_keys(10**6).collect()
    assert len(keys) == len(set(keys)) == hot.where("key is not null").select("key").distinct().count()
    nothing = skew.count_keys(hot.where("false"), "key")
    assert (nothing.rows, nothing.largest, nothing.distinct_bytes) == (0, 0, 0)


def test_hot_rows_are_spread(spark, hot):
    right = spark.createDataFrame([("hot", 1)], "key string, v int")
    plan = skew.salted_join(hot, right, "key", ["id"], share=0.05, min_rows=0)._jdf.queryExecution().analyzed().toString()
    assert "_piece" in plan
    per_piece = hot.where("key = 'hot'").groupBy(F.pmod(F.xxhash64("id"), F.lit(7))).count().collect()
    assert len(per_piece) == 7 and max(r["count"] for r in per_piece) < 2 * 2000 / 7


def test_empty_left_side(spark, hot):
    right = spark.createDataFrame([("hot", 1)], "key string, v int")
    assert skew.salted_join(hot.where("false"), right, "key", ["id"]).count() == 0


def test_keywords_with_and_without_broadcast(spark):
    rng = random.Random(5)
    words = ["the"] * 40 + [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    texts += ["", "!!!", "x" * 300 + " the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    df = Counter(t for text in texts for t in set(text.replace("!", "").split()))
    wanted = Counter()
    for doc, text in enumerate(texts):
        tf = Counter(text.replace("!", "").split())
        scored = [(round(n * math.log(len(texts) / df[t]), 6), t, n) for t, n in tf.items()]
        for rank, (score, term, n) in enumerate(sorted(scored, key=lambda s: (-s[0], s[1]))[:4], 1):
            wanted[(doc, rank, score, term, n)] += 1
    for budget in (10**9, 10 * (keywords.DIGEST_BYTES + skew.ROW_BYTES)):
        got = keywords.keywords(docs, 4, cfg=JobConfig(broadcast_bytes=budget))
        assert rows(got.columns, got.collect()) == wanted


def outline_cases():
    rng = random.Random(11)
    markers = []
    for doc in range(6):
        start = 0
        for line in range(rng.randrange(1, 30)):
            # Mostly rising page numbers, now and then the same page again or a step back.
            start = max(0, start + rng.choice([-6, 0, 1, 2, 5, 9]))
            markers.append((doc, line * 2, f"s{doc}.{line}", start))
    pages = [(doc, n, f"[{doc}:{n}]") for doc in range(7) for n in range(0, 40) if rng.random() < 0.9]
    return markers, pages


def expected_ranges(markers):
    out = []
    for doc in sorted({m[0] for m in markers}):
        mine = sorted(m for m in markers if m[0] == doc)
        for i, (_, line, name, start) in enumerate(mine):
            end = max(mine[i + 1][3], 1) - 1 if i + 1 < len(mine) else -1
            out.append((doc, line, name, max(start, 1), end))
    return out


@pytest.mark.parametrize("cfg", [JobConfig(), TINY])
def test_sections_against_brute_force(spark, cfg):
    markers, pages = outline_cases()
    marker_df = spark.createDataFrame(markers, "doc_id bigint, line_no bigint, name string, page_start bigint")
    page_df = spark.createDataFrame(pages, "doc_id bigint, page_no bigint, text string")
    ranges = sections.section_ranges(marker_df, cfg=cfg)
    wanted = expected_ranges(markers)
    assert sorted(tuple(r) for r in ranges.collect()) == sorted(wanted)

    slices = sections.slice_sections(ranges, page_df, cfg=cfg)
    expected = [
        (doc, line, name, start, n, text)
        for doc, line, name, start, end in wanted
        for d, n, text in pages
        if d == doc and n >= start and (end == -1 or n <= end)
    ]
    assert sorted(tuple(r) for r in slices.collect()) == sorted(expected)

    texts = sections.section_texts(slices).collect()
    whole = {(r["doc_id"], r["line_no"]): r["text"] for r in texts}
    assert len(texts) == len(whole) and whole == {
        key: "".join(t for d, ln, _, _, n, t in sorted(expected) if (d, ln) == key)
        for key in {(e[0], e[1]) for e in expected}
    }


@pytest.mark.parametrize("last", [4, 1000, 70_000, 2**40, 2**62])
def test_stray_page_numbers(spark, last):
    rng = random.Random(last)
    numbers = sorted({1, 2, 3, last, *[rng.randint(1, last) for _ in range(200)]})
    pages = spark.createDataFrame([(1, n, str(n)) for n in numbers], "doc_id bigint, page_no bigint, text string")
    ranges = [(1, i, "s", *sorted(rng.choices(numbers, k=2))) for i in range(40)] + [(1, 40, "s", 2, -1)]
    df = spark.createDataFrame(ranges, "doc_id bigint, line_no bigint, name string, page_start bigint, page_end bigint")
    got = sorted((r["line_no"], r["page_no"]) for r in sections.slice_sections(df, pages, cfg=JobConfig()).collect())
    assert got == sorted(
        (line, n) for _, line, _, start, end in ranges for n in numbers if n >= start and (end == -1 or n <= end)
    )


def test_rising_sections_cover_each_page_once(spark):
    markers = [(1, i, f"s{i}", i * 3 + 1) for i in range(20)]
    pages = spark.createDataFrame([(1, n, "x") for n in range(1, 90)], "doc_id bigint, page_no bigint, text string")
    df = spark.createDataFrame(markers, "doc_id bigint, line_no bigint, name string, page_start bigint")
    slices = sections.slice_sections(sections.section_ranges(df), pages, cfg=TINY)
    assert slices.count() == slices.select("page_no").distinct().count() == 89


@pytest.mark.parametrize("cfg", [JobConfig(), TINY])
def test_enrich_with_hot_and_missing_uris(spark, cfg):
    long = "long enough " * 12
    pages = [(1, "u:hot", f"<title>Hot one</title><p>{long}old"), (2, "u:hot", f"<title>Hot two</title><p>{long}new")]
    pages += [(10 + i, f"u:{i}", f"<p>{long}{i}") for i in range(20)] + [(99, None, "<p>x")]
    asked = [(i, "u:hot" if i % 3 == 0 else None if i % 3 == 1 else f"u:{i % 40}", "own" if i % 10 == 0 else None) for i in range(900)]
    requests = spark.createDataFrame(asked, "req_no bigint, uri string, text string")
    page_df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["req_no"]: (r["text"], r["page_title"]) for r in enrich_text(requests, page_df, "req_no", cfg=cfg).collect()}
    assert len(got) == 900
    body = {"u:hot": (f"{long}new", "Hot two")} | {f"u:{i}": (f"{long}{i}", None) for i in range(20)}
    for number, link, text in asked:
        assert got[number] == ((text, None) if text else body.get(link, (None, None)))


@pytest.mark.parametrize("cfg", [JobConfig(), TINY])
def test_lookups_with_a_hot_id(spark, cfg):
    history = [(f"r{i % 50}", "TEXT" if i % 2 else "AUDIO", i) for i in range(500)] + [("hot", "TEXT", i) for i in range(500)]
    ids = ["hot"] * 300 + [f"r{i}" for i in range(100)] + [None]
    history_df = spark.createDataFrame(history, "id string, type string, created bigint")
    ids_df = spark.createDataFrame([(i,) for i in ids], "id string")
    newest = {}
    for key, kind, created in history:
        if created >= newest.get(key, (None, -1))[1]:
            newest[key] = (kind, created)
    found = state.lookup_status(ids_df, history_df, "id", ("created",), cfg)
    wanted = Counter((i, *newest.get(i, (None, None)), i in newest) for i in ids)
    assert Counter((r["id"], r["type"], r["created"], r["found"]) for r in found.collect()) == wanted
    missing = state.missing_ids(ids_df, history_df, "id").collect()
    assert {r["id"] for r in missing} == {i for i in ids if i not in newest}
    result = state.lookup_result(history_df, "TEXT", ids_df, "id", cfg)
    asked = set(ids)
    assert Counter(tuple(r) for r in result.collect()) == Counter(h for h in history if h[1] == "TEXT" and h[0] in asked)


def test_flat_export_and_duplicates(spark):
    items = [("AUDIO", "same title", f"h{i}", i // 2, f"p{i}") for i in range(100)]
    items += [("AUDIO", "other", "x", 1, "px"), ("TEXT", "other", "t", 9, "pt"), ("AUDIO", "?", "n", 9, None)]
    df = spark.createDataFrame(items, "type string, title string, request_hash string, created bigint, storage_path string")
    got = sorted(tuple(r) for r in state.flat_export(df.withColumn("uri", F.lit("http://h/x"))).collect())
    assert got == [("other.mp3", "x", 1, "px", 1), ("same_title.mp3", "h99", 49, "p99", 100)]
    copies = spark.createDataFrame([(i, "copy" if i % 3 == 0 else f"t{i}") for i in range(30)], "doc_id int, text string")
    groups = state.duplicate_groups(copies).collect()
    assert [(g["n"], g["first_id"]) for g in groups] == [(10, 0)]


def test_section_ranges_keep_rows_without_document_or_line(spark):
    rows = [(None, 0, "a", 1), (None, 5, "b", 4), (None, 9, "c", 7), (1, None, "d", 1), (1, 4, "e", 3), (1, 5, "f", 9)]
    markers = spark.createDataFrame(rows, "doc_id long, line_no long, name string, page_start long")
    wanted = [("a", 3), ("b", 6), ("c", -1), ("d", 2), ("e", 8), ("f", -1)]
    for chunk in (1, 3, 10_000):
        ranges = sections.section_ranges(markers, cfg=JobConfig(outline_chunk=chunk)).collect()
        assert sorted((r["name"], r["page_end"]) for r in ranges) == wanted


def test_terms_of_one_document_are_not_looked_up(spark):
    # 300 terms of one document each, 40 shared ones; what fits holds the shared ones only.
    texts = [(d, " ".join([f"own{d}x{i}" for i in range(10)] + [f"common{(d + i) % 40}" for i in range(20)])) for d in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").cache()
    whole = keywords.keywords(docs, 25)
    for budget, joins in ((4_000, False), (1_200, True)):
        got = keywords.keywords(docs, 25, cfg=JobConfig(broadcast_bytes=budget))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) == joins
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
