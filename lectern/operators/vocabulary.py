"""Document frequencies of a corpus that grows: each run adds what it changes, nobody counts the corpus again.

A run writes signed differences: +1 for each term of a new text, -1 for each term of the text it replaces. The vocabulary
is their sum by term. The number of documents is kept the same way, in a row without a term. Runs are folded into
snapshots now and then, as content is.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.keywords import document_frequency
from lectern.sources import snapshots

SCHEMA = "term string, df long"


def frequency_delta(new: DataFrame, old: DataFrame | None = None, text: str = "text") -> DataFrame:
    """(term, df): by how much document frequencies change when the texts `new` come and `old` ones go.

    `old` are the earlier texts of replaced items, and the texts of removed ones. The row with a NULL term says by how much
    the number of documents changes. Terms whose frequency stays are left out. Only these texts are read.
    """
    signed = []
    for texts, sign in ((new, 1), (old, -1)):
        if texts is not None:
            terms = document_frequency(texts, text).select("term", (F.col("df") * sign).alias("df"))
            count = texts.agg(F.count(F.lit(1)).alias("df"))
            signed.append(terms.unionByName(count.select(F.lit(None).cast("string").alias("term"), (F.col("df") * sign).alias("df"))))
    both = signed[0].unionByName(signed[1]) if len(signed) > 1 else signed[0]
    return both.groupBy("term").agg(F.sum("df").alias("df")).where("df <> 0")


def add_texts(spark: SparkSession, base: str, run: str, new: DataFrame, old: DataFrame | None = None, text: str = "text") -> None:
    """Stores the difference that a run makes. The same run again replaces its own; a folded one is refused."""
    before = snapshots.newest(spark, base)
    if before is not None and run in before.covered["runs"]:
        raise ValueError(f"run {run} is part of the snapshot already")
    frequency_delta(new, old, text).write.mode("overwrite").parquet(f"{base}/run={run}")


def _since(spark: SparkSession, base: str, before: snapshots.Manifest | None) -> list[str]:
    """Finished runs that the snapshot does not hold."""
    runs = [path.split("/")[-2].split("=", 1)[1] for path in snapshots.children(spark, f"{base}/run=*/_SUCCESS")]
    return sorted(set(runs) - set(before.covered["runs"] if before else ()))


def _summed(spark: SparkSession, base: str, before: snapshots.Manifest | None, runs: list[str]) -> DataFrame:
    parts = [] if before is None else [before.rows(spark)]
    if runs:
        parts.append(spark.read.schema(SCHEMA).parquet(*[f"{base}/run={run}" for run in runs]))
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    if not runs:
        return parts[0]
    both = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    return both.groupBy("term").agg(F.sum("df").alias("df")).where("df <> 0")


def fold_vocabulary(spark: SparkSession, base: str) -> snapshots.Manifest | None:
    """Folds the finished runs into a new snapshot, of one row per term; the manifest in force."""
    before = snapshots.newest(spark, base)
    fresh = _since(spark, base, before)
    if not fresh:
        return before
    rows, folder = _summed(spark, base, before, fresh), snapshots.draft_folder(base)
    rows.write.parquet(folder)
    runs = sorted({*(before.covered["runs"] if before else ()), *fresh})
    return snapshots.publish(spark, base, before, folder, rows.schema, {"runs": runs})


def vocabulary(spark: SparkSession, base: str) -> DataFrame:
    """(term, df, idf) of the corpus as all finished runs have left it, idf = ln(N / df).

    Reads the snapshot and the runs since; without either it is empty.
    """
    before = snapshots.newest(spark, base)
    rows = _summed(spark, base, before, _since(spark, base, before))
    n_docs = rows.where("term IS NULL").agg(F.coalesce(F.sum("df"), F.lit(0))).scalar()
    return rows.where("term IS NOT NULL").select("term", "df", F.log(n_docs / F.col("df")).alias("idf"))
