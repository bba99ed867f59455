"""Streams of several files against the same work as one batch."""

import json
import shutil

import pytest
from compare import rows
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from lectern.operators.metrics import accepted_counts
from lectern.operators.state import latest_status
from lectern.plans.jobs import process_payloads
from lectern.sources.readers import read_payloads
from lectern.streaming import jobs


@pytest.fixture
def history(spark, tmp_path):
    """Three landed files with states of twenty requests, newest not always last."""
    folder = str(tmp_path / "history")
    data = [(f"r{i % 20}", i, (i * 37) % 101, f"T{i}") for i in range(90)]
    df = spark.createDataFrame(data, "id string, step int, created bigint, type string")
    for part in range(3):
        df.where(F.col("step") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_latest_status_over_several_batches(spark, history, tmp_path):
    stream = spark.readStream.schema(spark.read.parquet(history).schema).option("maxFilesPerTrigger", 1).parquet(history)
    out = str(tmp_path / "out")
    latest = jobs.stream_latest_status(stream, "id", ("created", "step"))
    jobs.write_batches(latest, out, str(tmp_path / "state"), mode="update").awaitTermination()
    log = jobs.read_batches(spark, out)
    assert log.select("batch_id").distinct().count() == 3
    folded = jobs.fold_status(log, "id", ("created", "step"))
    batch = latest_status(spark.read.parquet(history), "id", ("created", "step"))
    assert rows(folded.columns, folded.collect()) == rows(batch.columns, batch.collect())


@pytest.mark.parametrize("parts", [None, 3])
@pytest.mark.parametrize("glob", ["texts.parquet", "te*.parquet"])
def test_a_streamed_table_is_a_file_or_a_folder(spark, tmp_path, parts, glob):
    texts, others = tmp_path / "texts.parquet", tmp_path / "others.parquet"
    spark.range(20).withColumn("text", F.lit("t")).repartition(parts or 1).write.parquet(str(texts))
    spark.range(5).write.parquet(str(others))
    if not parts:
        (tmp_path / "files").mkdir()
        for table in (texts, others):
            shutil.copy(next(table.glob("part-*.parquet")), tmp_path / "files" / table.name)
    out, folder = str(tmp_path / "out"), str(tmp_path if parts else tmp_path / "files")
    stream = jobs.stream_table(spark, folder, glob)
    jobs.write_batches(stream, out, str(tmp_path / "state")).awaitTermination()
    assert sorted(r["id"] for r in jobs.read_batches(spark, out).where("text = 't'").collect()) == list(range(20))


@pytest.mark.parametrize("name", ["stream_route", "stream_accepted_counts", "stream_latest_status"])
def test_streams_of_tables_in_several_files(spark, small, sql, tmp_path, name):
    for table in ("documents", "events"):
        spark.read.parquet(f"{small}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    df = queries()[name](spark, str(tmp_path))
    cursor = sql.execute(oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["stream_route", "stream_accepted_counts", "stream_latest_status"])
def test_streams_of_tables_without_rows(spark, small, tmp_path, name):
    for table in ("documents", "events"):
        spark.read.parquet(f"{small}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    df, whole = queries()[name](spark, str(tmp_path)), queries()[name](spark, small)
    assert df.dtypes == whole.dtypes and df.collect() == []


@pytest.mark.parametrize("name", ["stream_route", "stream_latest_status"])
def test_streams_of_partitioned_tables(spark, small, sql, tmp_path, name):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    documents.write.partitionBy("source", "lang").parquet(f"{tmp_path}/documents.parquet")
    df = queries()[name](spark, str(tmp_path))
    cursor = sql.execute(oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cursor.description], cursor.fetchall())


def counter_files(spark, folder, times):
    for at in times:
        df = spark.createDataFrame([(t, 2) for t in at], "t string, n_requests int")
        typed = df.select(F.col("t").cast("timestamp").alias("submitted_ts"), "n_requests")
        typed.coalesce(1).write.mode("append").parquet(folder)


TIMES = [
    ["2024-01-01 00:05:00", "2024-01-01 00:50:00"],
    ["2024-01-01 00:55:00", "2024-01-01 01:10:00"],
    ["2024-01-01 03:00:00"],
    ["2024-01-01 00:59:00", "2024-01-01 03:30:00"],
]


@pytest.mark.parametrize("mode", ["update", "append"])
def test_accepted_counter(spark, tmp_path, mode):
    folder = str(tmp_path / "batches")
    counter_files(spark, folder, TIMES)
    schema = spark.read.parquet(folder).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(folder)
    out = str(tmp_path / "out")
    counts = jobs.stream_accepted_counts(stream)
    jobs.write_batches(counts, out, str(tmp_path / "state"), mode=mode).awaitTermination()
    folded = {str(r["window_start"]): r["n_batches"] for r in jobs.fold_counts(jobs.read_batches(spark, out)).collect()}
    everything = accepted_counts(spark.read.parquet(folder)).collect()
    whole = {str(r["window_start"]): r["n_batches"] for r in everything}
    # The last file's 00:59 is far behind the watermark and dropped; append leaves the open window out.
    whole["2024-01-01 00:00:00"] -= 1
    if mode == "append":
        del whole["2024-01-01 03:00:00"]
    assert folded == whole


def test_payload_stream_equals_batch_and_resumes(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def land(name, payloads):
        (folder / name).write_text("\n".join(payloads) + "\n")

    def run():
        stream = jobs.stream_payloads(spark, str(folder), max_files=1)
        jobs.stream_requests(stream, process_payloads, out, state).awaitTermination()

    land("1.json", [json.dumps([{"uri": f"http://h/lecture{i}.mp3"}, {"uri": "u", "text": "some text"}]) for i in range(5)])
    land("2.json", ["{broken", '{"uri":"bare"}', "[]"])
    run()
    land("3.json", [json.dumps([{"uri": "https://youtu.be/playlist"}])])
    run()
    run()

    def summary(df):
        return sorted((r["status"], r["reason"] or "", r["uri"] or "", r["n"]) for r in
                      df.groupBy("status", "reason", "uri").agg(F.count("*").alias("n")).collect())

    streamed = jobs.read_batches(spark, out)
    assert summary(streamed) == summary(process_payloads(read_payloads(spark, str(folder))))
    assert streamed.where("status = 'ACCEPTED'").select("request_hash").distinct().count() == 10


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    out, folder = str(tmp_path / "out"), tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("[]\n")

    def run(state):
        stream = jobs.stream_payloads(spark, str(folder))
        jobs.write_batches(stream, out, str(tmp_path / state)).awaitTermination()
        return jobs.read_batches(spark, out).count()

    assert run("first") == 1
    # Without its commit, batch 0 counts as failed and runs again.
    for name in ("0", ".0.crc"):
        (tmp_path / "first" / "commits" / name).unlink()
    assert run("first") == 1
    # Another checkpoint is another query: it adds to the output.
    assert run("second") == 2


def test_a_running_stream_takes_up_new_files(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.json").write_text('[{"uri":"http://h/lecture.mp3"}]\n')
    stream = jobs.stream_payloads(spark, str(folder))
    running = jobs.stream_requests(stream, process_payloads, out, str(tmp_path / "state"), every="1 second")
    try:
        running.processAllAvailable()
        assert running.isActive and jobs.read_batches(spark, out).count() == 1
        (folder / "b.json").write_text("{broken\n")
        running.processAllAvailable()
    finally:
        running.stop()
    assert sorted(r["status"] for r in jobs.read_batches(spark, out).collect()) == ["ACCEPTED", "ERROR"]
