"""Sources, sinks and scratch space."""

import csv
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.session import materialize, run_folder, shared_folder
from lectern.sources import readers, sinks


def test_csv_keeps_every_field_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"na""me",note\n1,"two\nlines",\n2, spaced ,"a,b"\n')
    for whole in (None, False, True):
        rows = sorted(tuple(r) for r in readers.read_csv(spark, str(tmp_path), whole_files=whole).collect())
        assert rows == [("1", "two\nlines", ""), ("2", " spaced ", "a,b"), ("id", 'na"me', "note")]


@pytest.mark.parametrize("whole", [False, True])
def test_csv_refuses_ragged_rows(spark, tmp_path, whole):
    (tmp_path / "a.csv").write_text("a,b\n1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, str(tmp_path), whole_files=whole).collect()


def test_csv_is_split_inside_quoted_fields(spark, tmp_path):
    rng = random.Random(8)
    field = lambda: "".join(rng.choices(['a', 'é', '"', ',', "\n", "\r\n", "\n\n", " "], k=rng.randrange(0, 40)))
    expected = []
    for name in ("a", "b"):
        rows = [[f"{name}{i}", field(), field() * (50 if i == 7 else 1), "end"] for i in range(400)]
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out, quoting=csv.QUOTE_ALL if name == "a" else csv.QUOTE_MINIMAL, lineterminator="\n")
            writer.writerows(rows)
        expected += [tuple(f.replace("\r\n", "\n") for f in row) for row in rows]
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1500)
    try:
        split = readers.read_csv(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        found = Counter(map(tuple, split.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == Counter(expected)
    assert found == Counter(map(tuple, readers.read_csv(spark, str(tmp_path), whole_files=True).collect()))


def test_csv_splits_are_read_in_place(spark, tmp_path):
    folder, shared = tmp_path / "in", f"{shared_folder(spark)}/lectern"
    folder.mkdir()
    rng = random.Random(9)
    rows = [(str(i), "".join(rng.choices('ab,"\n\u00e9', k=60 if i % 70 else 9_000)), "end") for i in range(3_000)]
    with open(folder / "a.csv", "w", newline="") as out:
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
    size = (folder / "a.csv").stat().st_size
    earlier = set(os.listdir(shared.removeprefix("file:"))) if os.path.isdir(shared.removeprefix("file:")) else set()
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8_000)
    try:
        read = readers.read_csv(spark, str(folder))
        assert Counter(map(tuple, read.collect())) == Counter(rows)
        # Nothing but a row for each split is written; lines are not dealt anew.
        new = [os.path.join(d, f) for n in set(os.listdir(shared.removeprefix("file:"))) - earlier
               for d, _, files in os.walk(os.path.join(shared.removeprefix("file:"), n)) for f in files]
        assert sum(map(os.path.getsize, new)) < size / 4
        spread = read._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in spread.splitlines() if "Exchange hashpartitioning" in line and "block" in line]
        # Splits that are cut otherwise later give the same records, or an error.
        spark.conf.set("spark.sql.files.maxPartitionBytes", 16_000)
        assert Counter(map(tuple, read.select("*").collect())) == Counter(rows)
        spark.conf.set("spark.sql.files.maxPartitionBytes", 5_000)
        with pytest.raises(Exception, match="have changed"):
            read.select("*").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_content_scan(spark, tmp_path):
    spark.createDataFrame([("a", 1), (None, 2)], "text string, x int").write.parquet(str(tmp_path / "t"))
    assert sorted(r["text"] for r in readers.scan_content(spark, str(tmp_path / "t")).collect()) == ["", "a"]


def test_manifest(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "a.mp3").write_bytes(b"12345")
    (tmp_path / "d" / "b.mp3").write_bytes(b"1")
    (tmp_path / "c.txt").write_bytes(b"")
    rows = readers.file_manifest(spark, str(tmp_path), "*.mp3").collect()
    assert sorted((os.path.basename(r["path"]), r["size"]) for r in rows) == [("a.mp3", 5), ("b.mp3", 1)]


def stored(spark, days):
    rows = [("TEXT" if i % 2 else "AUDIO", f"title {d} {i}", 86400 * d, f"{d}.{i}") for d in days for i in range(4)]
    df = spark.createDataFrame(rows, "type string, title string, created bigint, text string")
    return df.withColumn("uri", F.lit("http://h/x"))


def test_content_sink_adds_and_the_last_writer_of_a_path_wins(spark, tmp_path):
    base = str(tmp_path / "content")
    first = stored(spark, [0, 1])
    sinks.write_content(first.where("title LIKE '% 1'"), base)
    sinks.write_content(first.where("title NOT LIKE '% 1'"), base)
    sinks.write_content(stored(spark, [1, 2]).withColumn("text", F.lit("new")), base, "9")
    sinks.write_content(stored(spark, [1, 2]).withColumn("text", F.lit("new")), base, "9")
    sinks.write_content(stored(spark, [2]).withColumn("title", F.lit("?")), base)
    assert readers.read_content(spark, base).where("text = 'new'").count() == 8
    back = readers.read_content(spark, base)
    assert back.count() == 12
    first = back.where("type = 'TEXT'").select("storage_path").orderBy("storage_path").first()
    assert first["storage_path"] == "TEXT/1970/01/01/title_0_1.txt"
    chosen = back.where("type = 'AUDIO' and created_date = date'1970-01-02'")
    assert "PartitionFilters: [isnotnull(type" in chosen._jdf.queryExecution().executedPlan().toString()
    assert chosen.count() == 2
    assert os.path.isdir(f"{base}/type=AUDIO/created_date=1970-01-01")


def test_json_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ('q"é', 2)], "title string, n int")
    sinks.write_jsonl(df, str(tmp_path / "out"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    wanted = [{"title": "a"}, {"title": 'q"é', "n": 2}]
    assert sorted(map(json.loads, lines), key=lambda r: r["title"]) == wanted
    assert sorted(r["json"] for r in sinks.to_json_lines(df).collect()) == sorted(lines)


def test_spread(spark):
    assert readers.spread(spark.range(10).repartition(2), "id").rdd.getNumPartitions() == 8
    many = spark.range(10).repartition(12)
    assert readers.spread(many, "id") is many


class Cluster:
    """What shared_folder asks a session."""

    def __init__(self, folder, master="spark://host:7077"):
        self.folder, self.master, self.conf, self.sparkContext = folder, master, self, self

    def get(self, key, default):
        return self.folder if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return None


def test_shared_folder_comes_from_the_session():
    assert shared_folder(Cluster("hdfs://shared/checkpoints/")) == "hdfs://shared/checkpoints"
    assert run_folder(Cluster("hdfs://shared"), "x").startswith("hdfs://shared/lectern/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster(None))


def test_materialize(spark):
    df = materialize(spark.range(5).withColumn("half", F.col("id") / 2), "numbers")
    assert df.count() == 5 and df.columns == ["id", "half"]
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert run_folder(spark, "x") != run_folder(spark, "x")
