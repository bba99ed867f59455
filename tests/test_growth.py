"""Tables that grow: folds, differences, lookups, sketches, ropes and streams whose parts land in any order."""

import json
import random

import pytest
from compare import rows
from pyspark.sql import functions as F

from lectern.operators import converters, keywords, ropes, state, vocabulary
from lectern.operators import requests as rq
from lectern.operators.extract import assemble_pages
from lectern.operators.requests import classify_requests
from lectern.operators.state import latest_status
from lectern.sources import readers, sinks, snapshots
from lectern.streaming import compaction, jobs


def same(a, b):
    return sorted(a.columns) == sorted(b.columns) and rows(a.columns, a.collect()) == rows(a.columns, b.select(*a.columns).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    """Rows that the scan of a plan without shuffles has read."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


# Content


def items(spark, some):
    data = [("AUDIO", None, f"title{i % 7}", 86400 * (i % 3), f"id{i}", i) for i in some]
    return spark.createDataFrame(data, "type string, uri string, title string, created long, request_hash string, n long")


def test_content_reads_without_join_after_a_fold(spark, tmp_path):
    base = str(tmp_path / "content")
    for run, some in (("a", range(20)), ("b", range(10, 40)), ("c", range(5))):
        sinks.write_content(items(spark, some), base, run)
    before = readers.read_content(spark, base)
    assert "Join" in plan(before)
    expected = before.collect()
    assert sinks.compact_content(spark, base).version == 1
    after = readers.read_content(spark, base)
    assert "Join" not in plan(after.where("type = 'AUDIO' AND created_date = '1970-01-02'"))
    assert rows(before.columns, expected) == rows(before.columns, after.select(*before.columns).collect())
    # Nothing new: the same version. A later run is read beside the snapshot, and an earlier name loses against it.
    assert sinks.compact_content(spark, base).version == 1
    sinks.write_content(items(spark, [0, 50]), base, "d")
    sinks.write_content(items(spark, [1, 51]), base, "B")
    whole = readers.last_writers(spark.read.option("basePath", base).parquet(base)).drop("run")
    assert same(readers.read_content(spark, base), whole)
    assert sinks.compact_content(spark, base).version == 2
    assert same(readers.read_content(spark, base), whole)
    with pytest.raises(ValueError, match="part of the snapshot"):
        sinks.write_content(items(spark, [1]), base, "a")


def test_a_fold_that_dies_or_comes_second_changes_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "content")
    sinks.write_content(items(spark, range(9)), base, "a")
    sinks.compact_content(spark, base)
    sinks.write_content(items(spark, range(4, 12)), base, "b")
    expected = readers.read_content(spark, base).collect()

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish", dies)
        with pytest.raises(RuntimeError):
            sinks.compact_content(spark, base)
    now = readers.read_content(spark, base)
    assert rows(now.columns, expected) == rows(now.columns, now.collect())
    first = snapshots.newest(spark, base)
    sinks.compact_content(spark, base)
    with pytest.raises(snapshots.SnapshotConflict):
        snapshots.publish(spark, base, first, snapshots.draft_folder(base), now.schema, {"runs": []})
    # The dead fold's rows and the first version go, what is in force stays.
    assert snapshots.expire(spark, base, keep=1) == 3
    again = readers.read_content(spark, base)
    assert rows(again.columns, expected) == rows(again.columns, again.collect())


def test_a_run_that_is_being_written_is_not_folded(spark, tmp_path):
    base = str(tmp_path / "content")
    sinks.write_content(items(spark, range(9)), base, "a")
    sinks.write_content(items(spark, range(20, 25)), base, "b")
    snapshots.remove(spark, f"{base}/{snapshots.HIDDEN}/run-b")  # As if it had not ended.
    assert sinks.compact_content(spark, base).covered == {"runs": ["a"]}
    assert readers.read_content(spark, base).where("n >= 20").count() > 0


# Status


def test_status_reads_keys_and_not_updates(spark, tmp_path):
    out, order = str(tmp_path / "log"), ("created", "step")
    schema = "id string, step int, created bigint, type string"

    def land(batch, some):
        data = [(f"r{i % 5}", i, (i * 37) % 101, f"T{i}") for i in some]
        spark.createDataFrame(data, schema).write.parquet(f"{out}/query=q/batch_id={batch}")

    for batch in range(12):
        land(batch, range(batch * 10, batch * 10 + 10))
    everything = latest_status(jobs.read_batches(spark, out).drop("query", "batch_id"), "id", order)
    assert same(compaction.current_status(spark, out, "id", order), everything)
    compaction.compact_status(spark, out, "id", order)
    folded = compaction.current_status(spark, out, "id", order)
    assert same(folded, everything)
    assert scanned(folded) == 5  # 120 updates, five keys
    assert not any("batch_id" in f for f in folded.inputFiles())
    land(12, range(200, 203))
    now = compaction.current_status(spark, out, "id", order)
    assert {f.split("batch_id=")[1].split("/")[0] for f in now.inputFiles() if "batch_id" in f} == {"12"}
    everything = latest_status(jobs.read_batches(spark, out).drop("query", "batch_id"), "id", order)
    assert same(now, everything)
    expected = everything.collect()
    compaction.compact_status(spark, out, "id", order)
    # Eleven folded batches, one old version and its rows go; the last batch may be written again by its stream.
    compaction.drop_folded(spark, out)
    assert snapshots.children(spark, f"{out}/query=q/batch_id=*") == [f"file:{out}/query=q/batch_id=12"]
    left = compaction.current_status(spark, out, "id", order)
    assert rows(left.columns, expected) == rows(left.columns, left.collect())


def test_a_killed_status_fold_loses_nothing(spark, tmp_path, monkeypatch):
    out, order = str(tmp_path / "log"), ("created",)
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, created long")
    df.write.parquet(f"{out}/query=q/batch_id=0")
    # A batch whose write has not ended is not folded.
    df.withColumn("created", F.col("created") + 5).write.parquet(f"{out}/query=q/batch_id=1")
    (tmp_path / "log/query=q/batch_id=1/_SUCCESS").unlink()
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "put", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            compaction.compact_status(spark, out, "id", order)
    assert snapshots.newest(spark, out) is None
    assert compaction.compact_status(spark, out, "id", order).covered == {"q": ["0"]}
    assert sorted(compaction.current_status(spark, out, "id", order).collect()) == [("a", 2), ("b", 1)]


def test_a_stream_folds_its_own_log(spark, tmp_path):
    folder, out, order = str(tmp_path / "in"), str(tmp_path / "out"), ("created",)
    for part in range(5):
        df = spark.createDataFrame([(f"r{i}", 10 * part + i) for i in range(part, part + 3)], "id string, created long")
        df.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    compaction.stream_current_status(stream, out, str(tmp_path / "state"), "id", order, fold_every=2).awaitTermination()
    manifest = snapshots.newest(spark, out)
    assert manifest.version == 2 and list(manifest.covered.values()) == [["0", "1", "2", "3"]]
    now = compaction.current_status(spark, out, "id", order)
    assert same(now, latest_status(spark.read.parquet(folder), "id", order))
    found = state.lookup_points(now, spark.createDataFrame([("r3",), ("r99",)], "id string"), "id")
    assert [r.id for r in found.collect()] == ["r3"]


# Vocabulary


def test_vocabulary_of_a_growing_corpus(spark, tmp_path):
    base, rng = str(tmp_path / "vocabulary"), random.Random(4)
    words = [f"w{i}" for i in range(30)]
    corpus = {}

    def run(name, fresh, replaced):
        texts = {i: " ".join(rng.choices(words, k=rng.randrange(0, 9))) for i in (*fresh, *replaced)}
        old = [(i, corpus[i]) for i in replaced]
        corpus.update(texts)
        frame = lambda data: spark.createDataFrame(data, "doc_id long, text string")
        vocabulary.add_texts(spark, base, name, frame(list(texts.items())), frame(old) if old else None)

    assert vocabulary.vocabulary(spark, base).count() == 0
    for i, (fresh, replaced) in enumerate([(range(20), ()), (range(20, 30), (3, 5)), ((), (3, 21)), (range(30, 33), range(12))]):
        run(f"run-{i}", fresh, replaced)
        if i in (1, 2):
            vocabulary.fold_vocabulary(spark, base)
        whole = keywords.idf(spark.createDataFrame(list(corpus.items()), "doc_id long, text string"))
        found = vocabulary.vocabulary(spark, base)
        assert same(found.withColumn("idf", F.round("idf", 9)), whole.withColumn("idf", F.round("idf", 9)))
    # Folded runs are not read again.
    assert {f.split("run=")[1].split("/")[0] for f in found.inputFiles() if "run=" in f} == {"run-3"}
    with pytest.raises(ValueError, match="part of the snapshot"):
        vocabulary.add_texts(spark, base, "run-0", found.select(F.col("term").alias("text")))


def test_sketches_add_up(spark):
    data = [(d, s, f"word{i} word{(i * 7) % 5000} {s}") for i, (d, s) in enumerate([(i % 4, "ab"[i % 2]) for i in range(8000)])]
    docs = spark.createDataFrame([*data, (9, None, None), (9, "c", "...")], "day int, source string, text string")
    merged = keywords.merge_sketches(keywords.term_sketches(docs, ("day", "source"))).first()
    exact = keywords.corpus_stats(docs.fillna({"text": ""})).first()
    assert (merged.n_docs, merged.n_postings) == (exact.n_docs, exact.n_postings)
    assert abs(merged.n_terms - exact.n_terms) <= 0.065 * exact.n_terms
    by_source = {r.source: r for r in keywords.merge_sketches(keywords.term_sketches(docs, ("day", "source")), ("source",)).collect()}
    assert (by_source[None].n_docs, by_source[None].n_terms, by_source["c"].n_terms) == (1, 0, 0)


# Lookups


def test_absent_ids_read_no_row_group(spark, tmp_path):
    path = str(tmp_path / "lookup")
    rng = random.Random(1)
    ids = [f"{rng.getrandbits(64):016x}" for _ in range(20_000)]
    df = spark.createDataFrame([(i, "TEXT" if n % 2 else "AUDIO", n) for n, i in enumerate(ids)], "id string, type string, n long")
    sinks.write_lookup(df, path, "id", ("type",), keys_per_group=2_000, group_bytes=32_768)
    stored = spark.read.parquet(path)
    ask = lambda some: state.lookup_points(stored, spark.createDataFrame([(i,) for i in some], "id string"), "id")
    # Inside the range of every file, and in none.
    absent = [f"{rng.getrandbits(64):016x}" for _ in range(20)]
    assert ask(absent).count() == 0 and scanned(ask(absent)) <= len(ids) // 10
    some = [ids[5], ids[77], ids[5], absent[0], None]
    assert sorted(r.n for r in ask(some).collect()) == [5, 77]
    assert scanned(ask(some)) < len(ids) // 4
    many = ids[:300]
    assert sorted(r.n for r in ask(many).collect()) == list(range(300))
    assert ask([None]).count() == 0


# Contract


def test_contract_is_counted_by_the_write(spark, tmp_path):
    data = [("u", "URI", "x"), ("", "TEXT", "0a0a0a0a-0a0a-0a0a-0a0a-0a0a0a0a0a0a"), (None, "ODD", None)]
    df = spark.createDataFrame(data, "uri string, type string, request_hash string")
    watched, seen = rq.observe_contract(df)
    watched.write.parquet(str(tmp_path / "written"))
    assert same(rq.observed_violations(spark, seen), rq.contract_violations(df))
    # Each micro-batch of a stream.
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    out, state_, checks = (str(tmp_path / n) for n in ("out", "state", "checks"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    jobs.write_batches(stream, out, state_, checks=checks).awaitTermination()
    counted = jobs.read_batches(spark, checks).groupBy("rule").agg(F.sum("n").alias("n"))
    assert same(counted, rq.contract_violations(df))


# Ropes


@pytest.mark.parametrize("piece", [1, 3, 1000])
def test_any_range_of_a_rope_is_the_slice_of_the_text(spark, piece):
    rng = random.Random(piece)
    pages = [(d, rng.randrange(0, 5000), "".join(rng.choices("aé€𝒳 ", k=rng.randrange(0, 12)))) for d in ("a", "b") for _ in range(25)]
    pages += [("a", 7, None), ("a", 7, "same"), ("a", 7, "same"), ("c", 1, None), ("d", 1, ""), ("e", None, "first"), ("e", 2, "last")]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, text string")
    whole = {r.doc_id: r.text.encode() for r in assemble_pages(df).collect()}
    rope = ropes.text_rope(df, piece_chars=piece)
    ranges = [(d, f"{d}{i}", rng.randrange(-3, 150), rng.randrange(0, 180)) for d in "abcdef" for i in range(12)]
    asked = spark.createDataFrame(ranges, "doc_id string, range_id string, start long, end long")
    found = {r.range_id: bytes(r.data) for r in ropes.cut_ranges(rope, asked, piece_chars=piece).collect()}
    expected = {k: whole.get(d, b"")[max(0, s) : max(0, e)] for d, k, s, e in ranges}
    assert found == {k: v for k, v in expected.items() if v}


# Codecs


def test_a_codec_that_fails_is_a_row(spark):
    data = [(1, "up", b"a"), (2, "up", b"\xff"), (3, "none", b"a"), (4, None, b"a"), (5, "up", None), (6, "up", b"")]
    df = spark.createDataFrame(data, "n int, route string, data binary").withColumn("error", F.lit("the caller's"))
    done = converters.convert_bytes(df, {"up": lambda raw: raw.decode("ascii").upper().encode()}, slice_bytes=1)
    got = {r.n: (None if r.result is None else bytes(r.result), (r.error or "").split(":")[0]) for r in done.collect()}
    assert got == {1: (b"A", ""), 2: (None, "UnicodeDecodeError"), 3: (None, "no codec for route none"),
                   4: (None, "no codec for route None"), 5: (None, ""), 6: (b"", "")}
    assert plan(done).count("Scan") == 1


# Streams


def test_pages_land_before_after_and_never(spark, tmp_path):
    asked, landed = str(tmp_path / "asked"), str(tmp_path / "landed")
    out, kept = str(tmp_path / "out"), str(tmp_path / "state")
    html = f"<html><title>A title</title><p>{'body ' * 40}</p></html>"

    def ask(*some):
        data = [(i, url, text, "URI", None, f"2024-01-01 {at}") for i, url, text, at in some]
        df = spark.createDataFrame(data, "request_hash string, uri string, text string, type string, title string, at string")
        df.withColumn("asked_ts", F.col("at").cast("timestamp")).drop("at").coalesce(1).write.mode("append").parquet(asked)

    def land(*some):
        df = spark.createDataFrame([(url, html, f"2024-01-01 {at}") for url, at in some], "url string, html string, at string")
        df.withColumn("landed_ts", F.col("at").cast("timestamp")).drop("at").coalesce(1).write.mode("append").parquet(landed)

    def run():
        streams = [spark.readStream.schema(spark.read.parquet(f).schema).parquet(f) for f in (asked, landed)]
        joined = jobs.join_landing_pages(classify_requests(streams[0]), streams[1])
        jobs.write_batches(joined, out, kept).awaitTermination()
        return {r.request_hash: (r.text is not None, r.page_title) for r in jobs.read_batches(spark, out).collect()}

    land(("http://h/before", "09:50:00"), ("http://h/twice", "10:00:00"))
    ask(("before", "http://h/before", None, "10:00:00"), ("after", "http://h/after", None, "10:00:00"),
        ("never", "http://h/never", None, "10:00:00"), ("given", "http://h/before", "own text", "10:00:00"),
        ("twice", "http://h/twice", None, "10:01:00"), ("audio", "http://h/a.mp3", None, "10:00:00"))
    first = run()
    assert first["before"] == (True, "A title") and first["given"] == (True, None) and first["audio"] == (False, None)
    assert "after" not in first and "never" not in first
    # After a restart: the page comes, and another copy of one that has been met.
    land(("http://h/after", "10:20:00"), ("http://h/twice", "10:05:00"))
    assert run()["after"] == (True, "A title")
    ask(("end", None, "x", "20:00:00"))
    land(("http://h/end", "20:00:00"))
    last = run()
    assert last["never"] == (False, None) and set(last) >= {"before", "after", "never", "given", "twice", "audio"}
    counts = jobs.read_batches(spark, out).groupBy("request_hash").count().collect()
    assert {r["count"] for r in counts} == {1}


def test_a_payload_delivered_twice_counts_once_across_restarts(spark, tmp_path):
    folder, out, kept = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def land(*some):
        df = spark.createDataFrame([(json.dumps(p) if p is not None else None, f"2024-01-01 {at}") for p, at in some], "payload string, at string")
        df.select("payload", F.col("at").cast("timestamp").alias("submitted_ts")).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
        jobs.write_batches(jobs.distinct_deliveries(stream), out, kept).awaitTermination()
        return sorted((r.payload or "none", r.n) for r in jobs.read_batches(spark, out).groupBy("payload").agg(F.count("*").alias("n")).collect())

    land(([1], "10:00:00"), ([1], "10:00:00"), ([2], "10:01:00"), (None, "10:01:00"))
    assert run() == [("[1]", 1), ("[2]", 1), ("none", 1)]
    land(([1], "10:04:00"), ([3], "10:04:00"), (None, "10:05:00"))
    assert run() == [("[1]", 1), ("[2]", 1), ("[3]", 1), ("none", 1)]
    # Long after the watermark has passed the first delivery, it is another submission.
    land(([4], "15:00:00"))
    run()
    land(([1], "15:01:00"))
    assert dict(run())["[1]"] == 2
