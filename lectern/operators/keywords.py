"""Term statistics and keywords over a corpus; every row of the input is one document."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.config import DEFAULTS, JobConfig
from lectern.functions.text import term_counts, tokens
from lectern.operators.skew import ROW_BYTES, row_bytes
from lectern.session import materialize

# Terms of so many bytes or more are broadcast as a digest, which is as long.
DIGEST_BYTES = 32


def term_frequency(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, term, tf). Counted inside each row, so nothing is shuffled."""
    return docs.select(key, F.inline(term_counts(F.col(text))))


def document_frequency(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, df): documents that contain the term. One shuffle, after partial counts."""
    return (
        docs.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def idf(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, df, idf) with idf = ln(N / df); N is a scalar subquery over the row count."""
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    return document_frequency(docs, text).withColumn("idf", F.log(n_docs / F.col("df")))


def corpus_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: documents, distinct terms and (document, term) pairs."""
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    return document_frequency(docs, text).agg(
        n_docs.alias("n_docs"),
        F.count(F.lit(1)).alias("n_terms"),
        F.coalesce(F.sum("df"), F.lit(0)).alias("n_postings"),
    )


def term_sketches(docs: DataFrame, by: tuple[str, ...], text: str = "text", log_k: int = 12) -> DataFrame:
    """Mergeable sketches per group: (by, n_docs, n_postings, terms), `terms` a HyperLogLog sketch of the distinct terms.

    A day's or a source's sketches are made once and kept; `merge_sketches` adds any of them up without the texts.
    """
    words = docs.select(*by, F.array_distinct(tokens(F.coalesce(F.col(text), F.lit("")))).alias("_terms"))
    sizes = words.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(F.size("_terms")), F.lit(0)).alias("n_postings")
    )
    terms = words.select(*by, F.explode("_terms").alias("term")).groupBy(*by)
    sketches = terms.agg(F.hll_sketch_agg("term", F.lit(log_k)).alias("terms"))
    # Groups can be NULL, and a group may have no term at all.
    named = sketches.select(*[F.col(c).alias(f"_{c}") for c in by], "terms")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return sizes.join(named, same, "left").select(*by, "n_docs", "n_postings", "terms")


def merge_sketches(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, n_docs, n_terms, n_postings) of sketches added up; n_terms is estimated.

    With log_k = 12 the standard error of n_terms is about 1.6 %, whatever the number of sketches.
    """
    merged = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum("n_postings"), F.lit(0)).alias("n_postings"),
        F.hll_union_agg("terms").alias("_terms"),
    )
    n_terms = F.coalesce(F.hll_sketch_estimate("_terms"), F.lit(0))
    return merged.select(*by, "n_docs", n_terms.alias("n_terms"), "n_postings")


def keywords(
    docs: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", cfg: JobConfig = DEFAULTS
) -> DataFrame:
    """The k terms of each document with the highest tf * idf: (key, term, tf, score, rank).

    The texts are read once: term counts are written, and the vocabulary comes from them. It is
    measured, and if it fits, broadcast whole. Otherwise as many of the most frequent terms are as do, however long:
    they settle nearly all postings without a shuffle and take the hot keys out of the shuffle join
    that is left for the rare terms, if there are any but those of a single document. Either way the rank is cut to k per document before rows move.
    """
    tf = materialize(term_frequency(docs, key, text), "tf")
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    weights = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    vocabulary = materialize(weights.withColumn("idf", F.log(n_docs / F.col("df"))), "idf")
    # Bytes by power of two of the frequency, 63 rows at most.
    coded_bytes = F.least(F.octet_length("term"), F.lit(DIGEST_BYTES)) + ROW_BYTES
    power = F.floor(F.log2("df") + 1e-9).alias("power")
    sizes = vocabulary.groupBy(power).agg(
        F.sum("df").alias("postings"), F.sum(row_bytes("term")).alias("bytes"), F.sum(coded_bytes.cast("bigint")).alias("coded")
    ).collect()
    if sum(r["bytes"] for r in sizes) <= cfg.broadcast_bytes:
        weighted = tf.join(F.broadcast(vocabulary), "term")
    else:
        # No more than postings / limit terms reach the limit, so `frequent` fits the budget; mostly a much lower limit does.
        rows = max(cfg.broadcast_bytes // (DIGEST_BYTES + ROW_BYTES), 1)
        limit = sum(r["postings"] for r in sizes) // rows + 1
        fitting = [p for p in range(1, 64) if sum(r["coded"] for r in sizes if r["power"] >= p) <= cfg.broadcast_bytes]
        limit = min(limit, 1 << fitting[0])
        short = F.octet_length("term") < DIGEST_BYTES
        code = F.when(short, F.col("term")).otherwise(F.md5(F.encode("term", "UTF-8"))).alias("_code")
        frequent = F.broadcast(vocabulary.where(F.col("df") >= limit).select(code, "idf"))
        # Terms of one document need no lookup: what is found nowhere is one of them.
        once = F.coalesce("idf", F.log(n_docs / F.lit(1))).alias("idf")
        coded = tf.select("*", code)
        if limit <= 2:
            weighted = coded.join(frequent, "_code", "left").select(key, "term", "tf", once)
        else:
            rare = vocabulary.where((F.col("df") < limit) & (F.col("df") > 1)).select("term", "idf").hint("shuffle_merge")
            settled = coded.join(frequent, "_code").select(key, "term", "tf", "idf")
            others = coded.join(frequent.select("_code"), "_code", "left_anti").drop("_code")
            weighted = settled.unionByName(others.join(rare, "term", "left").select(key, "term", "tf", once))
    scored = weighted.select(key, "term", "tf", F.round(F.col("tf") * F.col("idf"), 6).alias("score"))
    best_first = W.partitionBy(key).orderBy(F.desc("score"), F.asc("term"))
    return (
        scored.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )
