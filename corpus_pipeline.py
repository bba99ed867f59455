"""A corpus from raw documents to packed sequences: toxic texts, near duplicates and leaked benchmark items
go, personal data is masked, and what is left is packed."""

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import decontamination, disclosure, minhash, packing, toxicity
from lectern.llm.common import id_and_text, table
from lectern.session import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity is 0 more likely than not; learnt from the labelled ones among them."""
    texts = id_and_text(docs)
    model = toxicity.fit(texts, toxicity.grade_labels(texts, table(spark, sf_dir, "labels")))
    return toxicity.accepted(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its runs of five words."""
    return minhash.deduplicate(docs, k=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what gives it away masked in their text."""
    return disclosure.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, neighbours on the curve together."""
    return packing.with_digest(packing.pack(id_and_text(docs), length=2048))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

# Neither hashing nor fitting can be told in SQL. The tests compare the near-duplicate stage with brute force, the other
# operators on their own tables (toxicity: held-out labels only), not over what earlier stages leave.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage gives is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
