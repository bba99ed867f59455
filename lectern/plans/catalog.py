"""Named queries over the given tables, one or more per operator."""

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import titles, uri
from lectern.functions.text import fingerprint, word_count
from lectern.operators import converters, extract, keywords, metrics, requests, ropes, sections, state, vocabulary
from lectern.plans import inputs
from lectern.plans.inputs import derive, normalized, table
from lectern.plans.jobs import finish_requests, process_requests, split_by_outline
from lectern.session import run_folder
from lectern.sources import readers, sinks
from lectern.streaming import compaction
from lectern.streaming import jobs as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _spread_documents(spark: SparkSession, folder: str) -> DataFrame:
    return readers.spread(_documents(spark, folder), "doc_id")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return readers.spread(table(spark, folder, "pages"), "page_id")


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.request_rows(_spread_documents(spark, folder))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return normalized(_rows(spark, folder))


def _titled(spark: SparkSession, folder: str) -> DataFrame:
    return requests.resolve_title(_requests(spark, folder))


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return process_requests(_requests(spark, folder))


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.history_rows(_rows(spark, folder))


def _lookups(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.lookup_rows(_rows(spark, folder))


def _pages_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "conversations"), inputs.DOCUMENT_PAGES_SQL, "conversations")


def _outline(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "conversations"), inputs.OUTLINE_SQL, "conversations")


def _page_requests(spark: SparkSession, folder: str) -> DataFrame:
    return normalized(derive(table(spark, folder, "pages"), inputs.PAGE_REQUESTS_SQL, "pages"))


def _hour(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("window_start")


# Sources and sinks


@query
def request_batch_explode(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = requests.read_request_batches(inputs.payload_rows(_rows(spark, folder)))
    return rows.select("payload_id", "pos", "uri", "title", "text")


@query
def request_batch_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = requests.read_request_batches(inputs.payload_rows(_rows(spark, folder)))
    return bad.select("payload_id", "payload")


@query
def content_scan(spark: SparkSession, folder: str) -> DataFrame:
    return readers.scan_content(spark, f"{folder}/documents.parquet")


@query
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    path = run_folder(spark, "csv")
    docs.write.option("quoteAll", True).option("escape", '"').csv(path)
    return readers.read_csv(spark, path).toDF(*docs.columns)


@query
def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "files")
    docs = _documents(spark, folder).select(F.coalesce("text", F.lit("")), F.coalesce("source", F.lit("none")).alias("source"))
    docs.write.partitionBy("source").text(path)
    files = readers.file_manifest(spark, path, "*.txt")
    source = F.url_decode(F.regexp_extract("path", "/source=([^/]+)/", 1)).alias("source")
    return files.groupBy(source).agg(F.sum("size").alias("n_bytes"))


@query
def storage_layout(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "content")
    items = _titled(spark, folder)
    # Two runs over the same days: the second adds to what the first has stored.
    sinks.write_content(items.where("req_no % 2 = 0"), path, "run-1")
    sinks.write_content(items.where("req_no % 2 = 1"), path, "run-2")
    stored = readers.read_content(spark, path)
    return stored.groupBy("type", F.col("created_date").cast("string").alias("created_date")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("storage_path").alias("n_paths"), F.sum("req_no").alias("winners")
    )


@query
def storage_compacted(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "content")
    items = _titled(spark, folder)
    # The first run is folded, the second comes later and is folded over it, without reading the first again.
    for rest in (0, 1):
        sinks.write_content(items.where(F.col("req_no") % 2 == rest), path, f"run-{rest + 1}")
        sinks.compact_content(spark, path)
    stored = readers.read_content(spark, path)
    return stored.groupBy("type", F.col("created_date").cast("string").alias("created_date")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("storage_path").alias("n_paths"), F.sum("req_no").alias("winners")
    )


@query
def flat_export_winners(spark: SparkSession, folder: str) -> DataFrame:
    stored = _outcomes(spark, folder).where(F.col("status") == "ACCEPTED")
    return state.flat_export(stored.withColumn("type", F.col("output_type")))


@query
def request_to_json(spark: SparkSession, folder: str) -> DataFrame:
    fields = ("type", "request_hash", "text", "title", "created", "uri", "submitted_at", "words_per_minute")
    return sinks.to_json_lines(_requests(spark, folder), *fields)


# Projections, filters, predicates


@query
def normalize_requests(spark: SparkSession, folder: str) -> DataFrame:
    return _requests(spark, folder).select(
        "req_no", "type", "request_hash", "text", "title", "created", "uri", "submitted_at", "words_per_minute"
    )


@query
def classify_uri(spark: SparkSession, folder: str) -> DataFrame:
    return _rows(spark, folder).select("req_no", "uri", uri.classify(F.col("uri")).alias("type"))


@query
def uri_title_ext(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id", uri.uri_title(url).alias("title_stub"), uri.uri_ext(url).alias("ext")
    )


@query
def request_uri_title_ext(spark: SparkSession, folder: str) -> DataFrame:
    link = F.col("uri")
    return _rows(spark, folder).select(
        "req_no", uri.uri_title(link).alias("title_stub"), uri.uri_ext(link).alias("ext")
    )


@query
def clean_title(spark: SparkSession, folder: str) -> DataFrame:
    title = F.col("title")
    return _rows(spark, folder).select(
        "req_no", titles.clean_title(title).alias("clean_title"), titles.has_content(title).alias("has_content")
    )


@query
def resolve_title(spark: SparkSession, folder: str) -> DataFrame:
    return _titled(spark, folder).select("req_no", "type", "title")


@query
def storage_path(spark: SparkSession, folder: str) -> DataFrame:
    item = [F.col(c) for c in ("type", "uri", "title", "created")]
    return _titled(spark, folder).select(
        "req_no", titles.work_path(*item).alias("work_path"), titles.storage_path(*item).alias("storage_path")
    )


@query
def content_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select("doc_id", fingerprint(F.col("text")).alias("fingerprint"))


@query
def duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    return state.duplicate_groups(_documents(spark, folder))


@query
def list_requests(spark: SparkSession, folder: str) -> DataFrame:
    return requests.list_requests(requests.measure_text(_titled(spark, folder)))


@query
def submit_response(spark: SparkSession, folder: str) -> DataFrame:
    return requests.list_requests(_requests(spark, folder))


@query
def route_requests(spark: SparkSession, folder: str) -> DataFrame:
    return _outcomes(spark, folder).select("req_no", "route", "status", "reason", "output_type", "storage_path")


@query
def reject_summary(spark: SparkSession, folder: str) -> DataFrame:
    rejected = _outcomes(spark, folder).where(F.col("status") == "ERROR")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("req_no")
    sent_id = F.when(number % 11 == 0, F.concat(F.lit("bad-"), number.cast("string"))).otherwise(
        inputs.stable_id(number)
    )
    return requests.contract_violations(_rows(spark, folder).withColumn("request_hash", sent_id), "type_in")


@query
def observed_violations(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("req_no")
    sent_id = F.when(number % 11 == 0, F.concat(F.lit("bad-"), number.cast("string"))).otherwise(
        inputs.stable_id(number)
    )
    rows, seen = requests.observe_contract(_rows(spark, folder).withColumn("request_hash", sent_id), "type_in")
    rows.write.parquet(run_folder(spark, "observed"))
    return requests.observed_violations(spark, seen)


@query
def text_measures(spark: SparkSession, folder: str) -> DataFrame:
    sent = F.when(F.col("doc_id") % 4 == 0, F.col("n_chars")).otherwise(F.lit(0))
    docs = _documents(spark, folder).withColumns({"length": sent, "size": F.lit(0).cast("bigint")})
    return requests.measure_text(docs).select("doc_id", "length", "size")


@query
def narration_defaults(spark: SparkSession, folder: str) -> DataFrame:
    return requests.apply_defaults(_requests(spark, folder)).select("req_no", "words_per_minute", "espeak_voice")


@query
def uri_requests(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "pages").select(
        "page_id", F.col("url").alias("uri"), F.lit(None).cast("string").alias("title")
    )
    made = requests.classify_requests(requests.requests_from_uris(links, F.lit(1704067200)))
    return made.select(
        "page_id", "uri", "type", "title", "atempo", "words_per_minute", "espeak_voice", "submitted_with", "submitted_at"
    )


@query
def processed_requests(spark: SparkSession, folder: str) -> DataFrame:
    done = process_requests(_page_requests(spark, folder), _pages(spark, folder), "req_no")
    return done.select(
        "req_no", "type", "title", "text", "length", "size", "words_per_minute", "espeak_voice",
        "status", "reason", "output_type", "storage_path",
    )


@query
def processed_documents(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    papers = normalized(derive(turns, inputs.PAPER_REQUESTS_SQL, "conversations"))
    leaves = derive(turns, inputs.PAPER_PAGES_SQL, "conversations")
    done = process_requests(papers, request_key="req_no", documents=leaves)
    return done.select("req_no", "type", "title", "text", "length", "status", "reason", "storage_path")


# Extraction


@query
def html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return extract.html_blocks(_pages(spark, folder))


@query
def extract_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract_text(_pages(spark, folder))


@query
def page_title(spark: SparkSession, folder: str) -> DataFrame:
    return extract.page_titles(_pages(spark, folder))


@query
def assemble_pages(spark: SparkSession, folder: str) -> DataFrame:
    return extract.assemble_pages(_pages_of_documents(spark, folder))


@query
def rope_ranges(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages_of_documents(spark, folder)
    # Pieces and buckets far below their usual size, so that ranges go over many of them.
    rope = ropes.text_rope(pages, piece_chars=16)
    ends = rope.groupBy("doc_id").agg(F.max("end").alias("n"))
    head = ends.select("doc_id", F.lit("head").alias("range_id"), F.lit(10).cast("long").alias("start"), F.lit(90).cast("long").alias("end"))
    tail = ends.select("doc_id", F.lit("tail").alias("range_id"), F.greatest(F.col("n") - 50, F.lit(0)).alias("start"), (F.col("n") + 7).alias("end"))
    cut = ropes.cut_ranges(rope, head.unionByName(tail), piece_chars=16)
    return cut.select("doc_id", "range_id", F.hex("data").alias("data"))


@query
def enrich_text(spark: SparkSession, folder: str) -> DataFrame:
    enriched = extract.enrich_text(_page_requests(spark, folder), _pages(spark, folder), "req_no")
    return enriched.select("req_no", "uri", "text", "page_title")


# Corpus analytics


@query
def term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return keywords.term_frequency(_spread_documents(spark, folder))


@query
def document_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return keywords.document_frequency(_spread_documents(spark, folder))


@query
def idf(spark: SparkSession, folder: str) -> DataFrame:
    weights = keywords.idf(_spread_documents(spark, folder))
    return weights.withColumn("idf", F.round("idf", 6))


@query
def tfidf_topk(spark: SparkSession, folder: str) -> DataFrame:
    return keywords.keywords(_spread_documents(spark, folder), 10)


@query
def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    return keywords.corpus_stats(_spread_documents(spark, folder))


@query
def idf_of_growing_corpus(spark: SparkSession, folder: str) -> DataFrame:
    base = run_folder(spark, "vocabulary")
    docs = _spread_documents(spark, folder).select("doc_id", "text")
    number = F.col("doc_id")
    # Two thirds first, then the rest; then a fifth is replaced by other texts.
    vocabulary.add_texts(spark, base, "run-1", docs.where(number % 3 != 0))
    vocabulary.fold_vocabulary(spark, base)
    vocabulary.add_texts(spark, base, "run-2", docs.where(number % 3 == 0))
    old = docs.where(number % 5 == 0)
    vocabulary.add_texts(spark, base, "run-3", old.select("doc_id", F.concat(F.lit("revised edition "), number.cast("string")).alias("text")), old)
    return vocabulary.vocabulary(spark, base).withColumn("idf", F.round("idf", 6))


@query
def corpus_sketches(spark: SparkSession, folder: str) -> DataFrame:
    docs = _spread_documents(spark, folder)
    merged = keywords.merge_sketches(keywords.term_sketches(docs, ("lang", "source")), ("lang",))
    words = keywords.term_frequency(docs.withColumn("doc_id", F.col("lang")))
    exact = words.groupBy(F.col("doc_id").alias("_lang")).agg(F.countDistinct("term").alias("_n"))
    # Four standard errors of a sketch of this size.
    close = F.abs(F.col("n_terms") - F.col("_n")) <= 0.065 * F.col("_n")
    both = merged.join(exact, F.col("lang").eqNullSafe(F.col("_lang")))
    return both.select("lang", "n_docs", "n_postings", F.col("_n").alias("n_terms"), close.alias("is_close"))


@query
def accepted_counts(spark: SparkSession, folder: str) -> DataFrame:
    batches = derive(table(spark, folder, "events"), inputs.BATCHES_SQL, "events")
    return metrics.accepted_counts(batches).select(_hour("window_start"), "n_batches", "n_requests")


@query
def accepted_payloads(spark: SparkSession, folder: str) -> DataFrame:
    payloads = inputs.payload_rows(_rows(spark, folder))
    submitted = F.timestamp_seconds(1704067200 + F.abs("payload_id") * 97).alias("submitted_ts")
    batches = requests.batch_outcomes(payloads).where("accepted").select("*", submitted)
    return metrics.accepted_counts(batches).select(_hour("window_start"), "n_batches", "n_requests")


@query
def route_census(spark: SparkSession, folder: str) -> DataFrame:
    routed = _outcomes(spark, folder).withColumn("host", uri.uri_host(F.col("uri")))
    return metrics.route_census(routed, ("type", "status", "host"))


@query
def playback_estimate(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.playback_estimate(_spread_documents(spark, folder))


# Outlines, latest state, lookups


@query
def outline_parse(spark: SparkSession, folder: str) -> DataFrame:
    return sections.parse_outline(_outline(spark, folder))


@query
def section_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return sections.section_ranges(sections.parse_outline(_outline(spark, folder)))


@query
def section_slices(spark: SparkSession, folder: str) -> DataFrame:
    ranges = sections.section_ranges(sections.parse_outline(_outline(spark, folder)))
    return sections.slice_sections(ranges, _pages_of_documents(spark, folder))


@query
def section_texts(spark: SparkSession, folder: str) -> DataFrame:
    return split_by_outline(_outline(spark, folder), _pages_of_documents(spark, folder))


@query
def latest_status(spark: SparkSession, folder: str) -> DataFrame:
    return state.latest_status(_history(spark, folder), "req_no", ("created", "step"))


@query
def status_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return state.lookup_status(_lookups(spark, folder), _history(spark, folder), "req_no", ("created", "step"))


@query
def status_missing(spark: SparkSession, folder: str) -> DataFrame:
    return state.missing_ids(_lookups(spark, folder), _history(spark, folder), "req_no")


@query
def result_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return state.lookup_result(_history(spark, folder), "TEXT", _lookups(spark, folder), "req_no")


@query
def point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    history, path = _history(spark, folder), run_folder(spark, "lookup")
    sinks.write_lookup(history, path, "req_no", ("type",))
    # The first request of each source, and as many ids that nobody has.
    first = _documents(spark, folder).groupBy("source").agg(F.min("doc_id").alias("req_no"))
    ids = first.select("req_no").unionByName(first.select(-1 - F.col("req_no")).toDF("req_no"))
    return state.lookup_points(spark.read.parquet(path), ids, "req_no")


# Streams


@query
def stream_page_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    asked = _page_requests(spark, folder).withColumn("asked_ts", F.timestamp_seconds("submitted_at"))
    # A page lands before its request, soon after, never, or too late.
    kind = F.col("page_id") % 4
    seconds = F.when(kind == 0, -600).when(kind == 1, 1200).otherwise(7200)
    landed = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 97 + seconds)
    pages = table(spark, folder, "pages").where(kind != 2).select("page_id", "url", "html", landed.alias("landed_ts"))
    # One more row on either side, in a far year, moves the watermarks past all others.
    end = F.lit("2100-01-01").cast("timestamp")
    last = asked.limit(1).withColumns({"req_no": F.lit(-1).cast("long"), "request_hash": F.lit("end"), "uri": F.lit(None).cast("string"), "asked_ts": end})
    closing = pages.limit(1).withColumns({"url": F.lit("end"), "landed_ts": end})
    folders = [run_folder(spark, name) for name in ("asked", "landed", "arrived", "state")]
    asked.unionByName(last).write.parquet(folders[0])
    pages.unionByName(closing).write.parquet(folders[1])
    requests_stream, pages_stream = (spark.readStream.schema(spark.read.parquet(f).schema).parquet(f) for f in folders[:2])
    arriving = streaming.join_landing_pages(requests.classify_requests(requests_stream), pages_stream)
    streaming.write_batches(finish_requests(arriving), folders[2], folders[3]).awaitTermination()
    done = streaming.read_batches(spark, folders[2]).where("req_no >= 0")
    return done.select("req_no", "type", "title", "text", "length", "status", "reason", "storage_path")


@query
def stream_distinct_payloads(spark: SparkSession, folder: str) -> DataFrame:
    payloads = inputs.payload_rows(_rows(spark, folder))
    submitted = F.timestamp_seconds(1704067200 + F.abs("payload_id") * 97).alias("submitted_ts")
    landed, out, kept = (run_folder(spark, name) for name in ("landed", "counts", "state"))
    # Everything is delivered twice, in different files.
    for _ in range(2):
        payloads.select("*", submitted).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(spark.read.parquet(landed).schema).parquet(landed)
    once = streaming.distinct_deliveries(stream, late="400 days", keys=("payload_id", "payload"))
    accepted = requests.batch_outcomes(once).where("accepted")
    streaming.write_batches(accepted, out, kept).awaitTermination()
    counts = metrics.accepted_counts(streaming.read_batches(spark, out))
    return counts.select(_hour("window_start"), "n_batches", "n_requests")


@query
def stream_current_status(spark: SparkSession, folder: str) -> DataFrame:
    out, history = run_folder(spark, "status"), _history(spark, folder)
    # Two streams of updates, the log folded after the first; then the rest is read beside the snapshot.
    for part in ("step = 0", "step > 0"):
        landed = run_folder(spark, "history")
        history.where(part).write.parquet(landed)
        stream = spark.readStream.schema(spark.read.parquet(landed).schema).parquet(landed)
        latest = streaming.stream_latest_status(stream, "req_no", ("created", "step"))
        streaming.write_batches(latest, out, run_folder(spark, "state"), mode="update").awaitTermination()
        if part == "step = 0":
            compaction.compact_status(spark, out, "req_no", ("created", "step"))
    return compaction.current_status(spark, out, "req_no", ("created", "step"))


@query
def stream_route(spark: SparkSession, folder: str) -> DataFrame:
    arriving = normalized(inputs.request_rows(streaming.stream_table(spark, folder, "documents.parquet")))
    out = run_folder(spark, "routed")
    streaming.stream_requests(arriving, process_requests, out, run_folder(spark, "state")).awaitTermination()
    return streaming.read_batches(spark, out, process_requests(arriving).schema).select(
        "req_no", "route", "status", "reason", "output_type", "storage_path"
    )


@query
def stream_accepted_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = streaming.stream_table(spark, folder, "events.parquet")
    batches = derive(events, inputs.BATCHES_SQL, "events").withColumn(
        "submitted_ts", F.col("submitted_ts").cast("timestamp")
    )
    out = run_folder(spark, "counts")
    counts = streaming.stream_accepted_counts(batches)
    streaming.write_batches(counts, out, run_folder(spark, "state"), mode="update").awaitTermination()
    folded = streaming.fold_counts(streaming.read_batches(spark, out))
    return folded.select(_hour("window_start"), "n_batches", "n_requests")


@query
def stream_latest_status(spark: SparkSession, folder: str) -> DataFrame:
    documents = streaming.stream_table(spark, folder, "documents.parquet")
    history = inputs.history_rows(inputs.request_rows(documents))
    out = run_folder(spark, "status")
    latest = streaming.stream_latest_status(history, "req_no", ("created", "step"))
    streaming.write_batches(latest, out, run_folder(spark, "state"), mode="update").awaitTermination()
    return streaming.fold_status(streaming.read_batches(spark, out), "req_no", ("created", "step"))


# Extension point


@query
def converted_bytes(spark: SparkSession, folder: str) -> DataFrame:
    codecs = {
        "plain": lambda raw: raw.decode("ascii").upper().encode(),
        "packed": lambda raw: zlib.decompress(zlib.compress(raw)),
        "turned": lambda raw: raw[::-1],
    }
    number = F.col("doc_id") % 4
    route = F.when(number == 0, "plain").when(number == 1, "packed").when(number == 2, "turned").otherwise("unknown")
    items = _spread_documents(spark, folder).select("doc_id", route.alias("route"), F.encode("text", "UTF-8").alias("data"))
    done = converters.convert_bytes(items, codecs)
    failed = F.substring_index("error", ":", 1).alias("failed")
    # Bytes of other characters, turned around, are no text that SQL could hash.
    text = (F.col("route") != "turned") | (F.octet_length("data") == F.char_length(F.decode("data", "UTF-8")))
    return done.select("doc_id", "route", F.octet_length("result").cast("long").alias("n_bytes"), F.when(text, F.sha2("result", 256)).alias("digest"), failed)


@query
def converter_chain(spark: SparkSession, folder: str) -> DataFrame:
    def narrate(df: DataFrame) -> DataFrame:
        minutes = F.round(word_count(F.col("text")) / F.col("words_per_minute"), 4)
        return df.withColumn("minutes", minutes)

    def speed_up(df: DataFrame) -> DataFrame:
        return df.withColumn("atempo", F.lit("2.0")).withColumn("minutes", F.lit(None).cast("double"))

    def as_audio(df: DataFrame) -> DataFrame:
        return df.withColumn("type", F.lit("AUDIO"))

    by_route = {
        "TEXT": converters.chain(requests.apply_defaults, narrate, as_audio),
        "AUDIO": converters.chain(speed_up),
        "VIDEO": converters.chain(speed_up, as_audio),
    }
    routed = _outcomes(spark, folder).where(F.col("status") == "ACCEPTED")
    done = converters.convert_by_route(routed, by_route)
    return done.select("req_no", "route", "type", "words_per_minute", "atempo", "minutes")
