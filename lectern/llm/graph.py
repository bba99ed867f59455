"""Connected components as joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b): the smallest node it is connected with.

    Each round takes the smallest label among the neighbours and then the label of one's label, so a
    chain of n links takes about log n rounds. Rounds are written tables, rows are pre-aggregated per node.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a <> b").distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("c")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("c").alias("n"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.least("c", "n").alias("c"), (F.col("n") < F.col("c")).alias("moved")
        )
        above = labels.select(F.col("node").alias("c"), F.col("c").alias("up"))
        step = step.join(above, "c").select(
            "node", F.least("c", "up").alias("c"), (F.col("moved") | (F.col("up") < F.col("c"))).alias("moved")
        )
        step = materialize(step, "labels")
        labels = step.select("node", "c")
        if step.where("moved").isEmpty():
            return labels.withColumnRenamed("c", "component")
