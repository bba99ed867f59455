"""Batches, normalization, titles, routing and the contract report."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from lectern.config import CONTENT_TYPES, JobConfig
from lectern.operators import requests as rq
from lectern.plans.jobs import process_payloads, process_requests
from lectern.schema import REQUEST_SCHEMA

PAYLOADS = [
    (1, json.dumps([{"uri": "http://h/a.mp3"}, {"uri": "u2", "text": "hello", "title": "two", "words_per_minute": 200}])),
    (2, "[]"),
    (3, "{not json"),
    (4, '{"uri":"bare object"}'),
    (5, '[{"uri":"x"}, {broken'),
    (6, '[{"uri":"x","words_per_minute":"fast"}]'),
    (7, '  [{"uri":"spaced"}]'),
    (8, None),
    (9, "17"),
    (10, '[{"uri":"x","length":1.5}]'),
]


@pytest.fixture(scope="module")
def payloads(spark):
    return spark.createDataFrame(PAYLOADS, "payload_id int, payload string")


def test_batches(payloads):
    good, bad = rq.read_request_batches(payloads)
    rows = sorted((r["payload_id"], r["pos"], r["uri"], r["text"], r["words_per_minute"]) for r in good.collect())
    assert rows == [(1, 0, "http://h/a.mp3", None, None), (1, 1, "u2", "hello", 200), (7, 0, "spaced", None, None)]
    assert sorted(r["payload_id"] for r in bad.collect()) == [3, 4, 5, 6, 8, 9, 10]


@pytest.mark.parametrize("with_pages", [False, True])
def test_payload_job_loses_nothing(spark, payloads, with_pages):
    pages = spark.createDataFrame([(1, "other", "<p>x")], "page_id bigint, url string, html string")
    done = process_payloads(payloads, pages if with_pages else None).collect()
    reasons = {}
    for r in done:
        reasons.setdefault(r["payload_id"], []).append((r["status"], r["reason"]))
    assert len(done) == 3 + 7
    assert reasons[5] == [("ERROR", "malformed payload")]
    kept = {r["payload_id"]: r["payload"] for r in done if r["reason"] == "malformed payload"}
    assert kept == {i: text or "" for i, text in PAYLOADS if i in (3, 4, 5, 6, 8, 9, 10)}
    assert all(r["type"] is None for r in done if r["payload"] is not None)
    assert sorted(reasons[1]) == [("ACCEPTED", None), ("ERROR", "title too small")]
    assert reasons[7] == [("ERROR", "no content")]


def test_normalize(spark):
    sent = [("u", "", "", "AUDIO", "mine", 0, "v", 5), (None, "text", "title", None, None, 300, "", 6)]
    raw = spark.createDataFrame(
        sent,
        "uri string, text string, title string, type string, request_hash string, words_per_minute int,"
        " espeak_voice string, created bigint",
    )
    df = rq.normalize_requests(raw, F.lit(99))
    assert df.schema.names == REQUEST_SCHEMA.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in REQUEST_SCHEMA]
    first, second = sorted(df.collect(), key=lambda r: r["uri"] is None)
    assert (first["type"], first["text"], first["title"], first["words_per_minute"]) == ("URI", None, None, None)
    assert first["espeak_voice"] == "v" and first["created"] == first["submitted_at"] == 99
    assert uuid.UUID(first["request_hash"]).version == 4 and first["request_hash"] != second["request_hash"]
    assert (second["type"], second["text"], second["title"], second["words_per_minute"]) == ("TEXT", "text", "title", 300)
    assert second["espeak_voice"] is None and second["tags"] is None


def titled(spark, rows, limit=40):
    df = spark.createDataFrame(
        [(*row,) for row in rows], "type string, uri string, title string, text string, page_title string"
    )
    out = rq.resolve_title(df, JobConfig(title_limit=limit)).select("type", "title").collect()
    return [tuple(r) for r in out]


def test_title_cascade(spark):
    long = "x" * 50
    cases = [
        (("URI", "http://h/lecture.mp3", None, None, None), ("AUDIO", "lecture")),
        (("URI", "http://h/four.mp3", None, None, None), ("AUDIO", None)),
        (("URI", "http://h/lecture.mp3", "own", None, None), ("AUDIO", "own")),
        (("URI", f"http://h/{long}.mp4", None, None, None), ("VIDEO", "x" * 40)),
        (("URI", "http://h/a", long, None, None), ("TEXT", "x" * 40)),
        (("URI", "http://h/a", None, None, "Page title"), ("TEXT", "Page title")),
        (("URI", "http://h/a", None, "the text", "abc"), ("TEXT", "the text")),
        (("URI", "http://h/a", None, None, long), ("TEXT", "x" * 40)),
        (("TEXT", None, long, "text", None), ("TEXT", long)),
        (("TEXT", None, None, "y" * 100, None), ("TEXT", "y" * 64)),
        (("TEXT", "http://h/lecture.mp3", None, "short", None), ("TEXT", "short")),
        (("URI", "bad uri", None, None, "A page"), ("TEXT", "A page")),
        (("URI", "http://h/a", "é" * 25, None, None), ("TEXT", "é" * 25)),
        (("URI", None, None, None, None), ("TEXT", None)),
        (("URI", "https://youtu.be/abc", "a\x07 video", None, None), ("YOUTUBE", "a video")),
        (("URI", "http://h/a.mp4", "a\x07 video", None, None), ("VIDEO", "a\x07 video")),
    ]
    assert titled(spark, [c[0] for c in cases]) == [c[1] for c in cases]


def test_no_title_limit_for_pages(spark):
    assert titled(spark, [("TEXT", None, None, None, "x" * 50)], limit=0) == [("TEXT", "x" * 50)]


def test_measures_keep_what_is_set(spark):
    df = spark.createDataFrame([("é", None, 0), ("é", 9, 8), (None, 0, None)], "text string, length bigint, size bigint")
    assert [(r["length"], r["size"]) for r in rq.measure_text(df).collect()] == [(2, 2), (9, 8), (0, 0)]


def test_routes_first_failure_wins(spark):
    cases = [
        (("YOUTUBE", "http://youtu.be/x", "title", None, 0), None),
        (("YOUTUBE_LIST", "http://youtu.be/playlist", "", None, 0), "unknown content type"),
        (("URI", None, "title", "text", 4), "unknown content type"),
        ((None, None, "title", "text", 4), "unknown content type"),
        (("PDF", "http://h/x?f=.pdf", "", None, 0), "could not parse ext"),
        (("VIDEO", "http://h/x?f=.mp4", "title", None, 0), "could not parse ext"),
        (("VIDEO", "http://h/x.mp4", "title", None, 0), None),
        (("PDF", "http://h/x.pdf", "title", None, 0), "no content"),
        (("TEXT", None, "", "", 0), "no content"),
        (("TEXT", None, "", "ab", 2), "text too short"),
        (("TEXT", None, "!", "abc", 3), "title too small"),
        (("TEXT", None, "ok", "abc", 3), None),
        (("AUDIO", "http://h/x", None, None, 0), "title too small"),
    ]
    df = spark.createDataFrame([c[0] for c in cases], "type string, uri string, title string, text string, length bigint")
    out = rq.route_requests(df).collect()
    assert [r["reason"] for r in out] == [c[1] for c in cases]
    assert [r["status"] for r in out] == ["ACCEPTED" if c[1] is None else "ERROR" for c in cases]
    assert all((r["output_type"] == "AUDIO") == (r["status"] == "ACCEPTED") for r in out)


def test_processing_keeps_every_request(spark):
    made = [(f"http://h/{i}" if i % 4 else None, "text" * i if i % 3 == 0 else None, None) for i in range(60)]
    raw = spark.createDataFrame(made, "uri string, text string, title string")
    requests = rq.normalize_requests(raw, F.lit(0), F.concat(F.lit("id"), F.monotonically_increasing_id()))
    pages = spark.createDataFrame(
        [(i, f"http://h/{i}", f"<title>Title {i}</title><p>{'body ' * 30}") for i in range(0, 60, 2)],
        "page_id bigint, url string, html string",
    )
    done = process_requests(requests, pages).collect()
    assert len(done) == 60 and len({r["request_hash"] for r in done}) == 60
    read = [r for r in done if r["title"] and r["title"].startswith("Title")]
    assert read and all(r["status"] == "ACCEPTED" and r["length"] == 149 for r in read)
    assert all((r["storage_path"] is None) == (r["status"] == "ERROR") for r in done)
    assert {r["words_per_minute"] for r in done} == {350} and {r["espeak_voice"] for r in done} == {"f5"}


def test_public_view(spark):
    base = {name: None for name in REQUEST_SCHEMA.names}
    rows = [base | {"request_hash": "a", "uri": "u", "submitted_at": 0}, base | {"request_hash": None}]
    rows.append(base | {"request_hash": "b", "submitted_at": 7})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], REQUEST_SCHEMA)
    shown = rq.list_requests(df)
    assert not {"espeak_voice", "submitted_by", "submitted_with", "storage_path"} & set(shown.columns)
    assert [(r["request_hash"], r["submitted_at"]) for r in shown.collect()] == [("a", 0), ("b", 7)]
    assert [r["submitted_at"] for r in rq.list_requests(df, None).collect()] == [None, 7]


def test_contract_report(spark):
    good = "c73bcdcc-2669-4bf6-81d3-e4ae73fb11fd"
    rows = [("u", t, good, 1) for t in CONTENT_TYPES] + [("", "audio", "x", -1), (None, None, None, None)]
    df = spark.createDataFrame(rows, "uri string, type string, request_hash string, size bigint")
    report = {r["rule"]: r["n"] for r in rq.contract_violations(df).collect()}
    assert report == {"uri_required": 2, "type_pattern": 1, "request_id_pattern": 1, "size_unsigned": 1}


def test_requests_from_uris(spark):
    df = rq.requests_from_uris(spark.createDataFrame([("http://h/x",)], "uri string"), F.lit(5))
    row = df.first()
    assert (row["type"], row["atempo"], row["words_per_minute"], row["espeak_voice"], row["submitted_with"]) == (
        "URI", "2.0", 350, "f5", "api",
    )
    assert row["submitted_at"] == 5


def test_documents_of_pdf_requests(spark):
    sent = [(f"http://h/paper{i}.pdf", "own text" if i == 1 else None, None) for i in range(4)] + [("http://h/page", None, None)]
    raw = spark.createDataFrame(sent, "uri string, text string, title string")
    requests = rq.normalize_requests(raw, F.lit(0))
    leaves = [(f"http://h/paper{i}.pdf", n, f"<{i}.{n}>") for i in (1, 2, 3) for n in range(1, 5 if i == 2 else 26)]
    pages = spark.createDataFrame(leaves, "uri string, page_no int, text string")
    done = process_requests(requests, documents=pages).collect()
    texts = {}
    for r in done:
        texts.setdefault(r["uri"], []).append(r["text"])
    assert texts["http://h/page"] == [None] and texts["http://h/paper0.pdf"] == [None]
    assert texts["http://h/paper1.pdf"] == ["own text"]
    assert len(texts["http://h/paper2.pdf"]) == 1
    assert texts["http://h/paper3.pdf"] == ["".join(f"<3.{n}>" for n in range(1, 26))]
    paths = [r["storage_path"] for r in done if r["status"] == "ACCEPTED"]
    assert len(paths) == len(set(paths)) and "AUDIO/1970/01/01/paper3.mp3" in paths


def test_json_types_of_payloads(spark):
    good = ["[]", "[{}]", "[null]", '[{"uri":null,"words_per_minute":null}]', '[{"uri":"5","words_per_minute":5,"other":[1]}]']
    bad = ['[{"uri":5}]', '[{"uri":{"a":1}}]', '[{"title":["t"]}]', '[{"text":true}]', '[{"words_per_minute":"200"}]',
           '[{"uri":"u"},{"uri":1.5}]', "[1]", '["u"]', '[{"words_per_minute":1.5}]', "[[]]"]
    df = spark.createDataFrame([(p,) for p in good + bad], "payload string")
    got = {r["payload"]: r["items"] is not None for r in rq.parse_payloads(df).collect()}
    assert got == {p: p in good for p in good + bad}


def test_empty_batches_are_counted(spark):
    payloads = [(1, "[]"), (2, '[{"uri":"u"},{"uri":"v"}]'), (3, "{}"), (4, None), (5, '[{"words_per_minute":5000000000}]')]
    df = spark.createDataFrame(payloads, "id int, payload string")
    got = sorted(tuple(r) for r in rq.batch_outcomes(df).collect())
    assert got == [(1, True, 0), (2, True, 2), (3, False, 0), (4, False, 0), (5, False, 0)]
