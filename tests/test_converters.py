"""The extension point."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lectern.operators.converters import chain, convert_by_route
from lectern.operators.metrics import playback_estimate, route_census


@pytest.fixture
def routed(spark):
    kinds = ["TEXT", "AUDIO", "VIDEO", None]
    data = [(i, kinds[i % 4], f"item {i}") for i in range(20)]
    return spark.createDataFrame(data, "id int, route string, text string")


def test_each_route_has_its_converter(routed):
    def shout(df):
        return df.withColumn("text", F.upper("text"))

    def mark(df):
        return df.withColumn("text", F.concat("text", F.lit("!")))

    done = convert_by_route(routed, {"TEXT": chain(shout, mark), "AUDIO": mark}).collect()
    assert len(done) == 20
    for row in done:
        plain = f"item {row['id']}"
        wanted = {"TEXT": plain.upper() + "!", "AUDIO": plain + "!"}.get(row["route"], plain)
        assert row["text"] == wanted


def test_a_converter_may_use_pandas(routed):
    def encode(df):
        def batches(parts):
            for part in parts:
                yield part.assign(text=part["text"].map(lambda t: t[::-1]))

        return df.mapInPandas(batches, df.schema)

    done = convert_by_route(routed, {"AUDIO": encode}).toPandas().set_index("id")["text"]
    assert done[1] == "1 meti" and done[2] == "item 2" and isinstance(done, pd.Series)


def test_converters_must_agree_on_columns(routed):
    with pytest.raises(ValueError, match="extra"):
        convert_by_route(routed, {"TEXT": lambda df: df.withColumn("extra", F.lit(1)), "AUDIO": lambda df: df})


def test_no_converters(routed):
    assert convert_by_route(routed, {}).count() == 20


def test_playback_rates(spark):
    data = [("a", "x y z", 0), ("a", "x", 100), ("b", "", None)]
    docs = spark.createDataFrame(data, "source string, text string, wpm int")
    rows = playback_estimate(docs, ("source",), rate="wpm").orderBy("source").collect()
    assert [(r["source"], r["n_docs"], r["words"], r["minutes"]) for r in rows] == [
        ("a", 2, 4, round(3 / 350 + 1 / 100, 4)),
        ("b", 1, 0, 0.0),
    ]


def test_census(routed):
    census = {r["route"]: r["n"] for r in route_census(routed, ("route",)).collect()}
    assert census == {"TEXT": 5, "AUDIO": 5, "VIDEO": 5, None: 5}
