"""Toxicity: a cumulative-link ordinal regression over sparse text features."""

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import rows_of, slices
from lectern.session import materialize

WORDS = re.compile(r"[^\W\d_]+").findall

# Word scores a task remembers; beyond, it starts afresh. No result depends on it.
REMEMBERED = 200_000


def features(word: str) -> list[str]:
    """A word's features: itself and its runs of five characters, the word's ends included."""
    edged = f"^{word}$"
    return [word, *{f"~{edged[i : i + 5]}" for i in range(len(edged) - 4)}]


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = sigmoid(cuts[k] - weights . x): one weight per feature for all thresholds.

    x has the occurrences of each feature per 100 words.
    """

    weights: dict[str, float]
    cuts: tuple[float, ...]

    def word_score(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def above(self, score: float) -> list[float]:
        """P(grade > k) for every threshold k; their sum is the expected grade."""
        return [1 / (1 + math.exp(min(700.0, max(-700.0, cut - score)))) for cut in self.cuts]


class _Scores(dict):
    def __init__(self, model: OrdinalModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = score = self.model.word_score(word)
        return score


def _bounded_sample(labels: DataFrame, rows_per_class: int) -> tuple[DataFrame, dict[bool, float]]:
    """At most `rows_per_class` labelled ids of either class by hash order, and how many rows each stands for.

    Labels that are a sample themselves say in `weight` how many rows each of them stands for.
    """
    toxic = F.coalesce(F.col("grade") > 0, F.lit(False))
    weight = F.col("weight") if "weight" in labels.columns else F.lit(1.0)
    known = labels.where("doc_id IS NOT NULL AND grade IS NOT NULL").select("doc_id", "grade", weight.alias("weight"))
    known = known.groupBy("doc_id").agg(F.max("grade").alias("grade"), F.max("weight").alias("weight"))
    sums = known.groupBy(toxic.alias("t")).agg(F.count("*").alias("n"), F.sum("weight").alias("all")).collect()
    weights = {r["t"]: r["all"] / min(r["n"], rows_per_class) for r in sums}
    parts = [
        known.where(toxic if t else ~toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        for t in (True, False)
    ]
    return parts[0].unionByName(parts[1]).select("doc_id", "grade"), weights


def _with_document(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """The labels whose id a document has; only ids are shuffled."""
    return labels.join(documents.select("doc_id"), "doc_id", "left_semi")


def _count_features(batches):
    """Per document the features it has, once each."""
    for batch in slices(batches, 0):
        grades, found = [], []
        for text, grade in rows_of([batch], "text", "grade"):
            own = set().union(*map(features, set(WORDS((text or "").lower()))), ())
            found.extend(own)
            grades.extend([grade > 0] * len(own))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(grades, pa.bool_())], ["f", "toxic"])


def choose_features(
    sample: DataFrame, n_features: int, min_documents: int, least_z: float = 3.0
) -> list[tuple[str, float]]:
    """The features that tell the classes apart best, with their smoothed log odds.

    Only those whose log odds are at least `least_z` standard errors from 0.
    """
    sizes = {r["t"]: r["n"] for r in sample.groupBy((F.col("grade") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    if not n1 or not n0:
        return []
    has = sample.select("text", "grade").mapInArrow(_count_features, "f string, toxic boolean").groupBy("f").agg(
        F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b")
    )
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n1 + 1 - a)) - F.log(b / (n0 + 1 - b))
    z = odds / F.sqrt(1 / a + 1 / b)
    best = has.where(F.col("a") + F.col("b") >= min_documents).select("f", odds.alias("odds"), z.alias("z"))
    best = best.where(F.abs("z") >= least_z)
    return [(r["f"], r["odds"]) for r in best.orderBy(F.abs("z").desc(), "f").limit(n_features).collect()]


RATES = pa.schema([("grade", pa.int32()), ("at", pa.list_(pa.int32())), ("rate", pa.list_(pa.float64()))])


def _rates(names: list[str]):
    """Sparse rows of the model's x: (grade, indices, values)."""
    index = {f: i for i, f in enumerate(names)}

    def run(batches):
        for batch in slices(batches, 0):
            out = []
            for text, grade in rows_of([batch], "text", "grade"):
                words = WORDS((text or "").lower())
                counts: Counter = Counter()
                for word, n in Counter(words).items():
                    for f in features(word):
                        if f in index:
                            counts[index[f]] += n
                out.append((grade, list(counts), [100 * n / len(words) for n in counts.values()]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(RATES)], schema=RATES)

    return run


def _fit(rows: pa.Table | list[dict], weights, n_features: int, n_grades: int, steps: int, ridge: float):
    """Maximum likelihood by Adam; thresholds stay ordered as a first cut and positive gaps."""
    if not isinstance(rows, pa.Table):
        rows = pa.Table.from_pylist(rows, RATES)
    y = rows["grade"].to_numpy()
    w = np.array([weights[g > 0] for g in y], dtype=float)
    w /= w.sum()
    # Numbers of a sparse row as Python objects would take ten times the memory, in the driver.
    at = pc.list_flatten(rows["at"]).to_numpy().astype(np.int64)
    value = pc.list_flatten(rows["rate"]).to_numpy()
    row = np.repeat(np.arange(len(rows)), pc.list_value_length(rows["at"]).to_numpy())
    scale = np.sqrt(np.bincount(at, value**2, n_features) / len(rows)) + 1e-9
    value = value / scale[at]
    beta, raw = np.zeros(n_features), np.zeros(n_grades - 1)
    raw[0] = 1.0
    m, v = np.zeros(n_features + n_grades - 1), np.zeros(n_features + n_grades - 1)
    sigmoid = lambda t: 1 / (1 + np.exp(-np.clip(t, -60, 60)))
    for step in range(1, steps + 1):
        cuts = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        eta = np.bincount(row, value * beta[at], len(rows))
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        high, low = sigmoid(edges[y + 1] - eta), sigmoid(edges[y] - eta)
        p = np.maximum(high - low, 1e-12)
        up, down = high * (1 - high) / p, low * (1 - low) / p
        slope_eta = w * (up - down)  # minus the log likelihood's
        grad_beta = np.bincount(at, value * slope_eta[row], n_features) + ridge * beta
        slope_cut = np.zeros(n_grades - 1)
        for k in range(n_grades - 1):
            slope_cut[k] = -(w * up)[y == k].sum() + (w * down)[y == k + 1].sum()
        tail = np.cumsum(slope_cut[::-1])[::-1]
        grad_raw = np.concatenate([tail[:1], tail[1:] * np.exp(raw[1:])])
        g = np.concatenate([grad_beta, grad_raw])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        beta, raw = beta - move[:n_features], raw - move[n_features:]
    return beta / scale, tuple(np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    n_grades: int = 3,
    rows_per_class: int = 4_000,
    n_features: int = 2_000,
    min_documents: int = 5,
    steps: int = 300,
    ridge: float = 1e-4,
) -> OrdinalModel:
    """Fits on labelled documents: `labels` (doc_id, grade 0 .. n_grades - 1[, weight: rows it stands for]).

    The sample is bounded: at most `rows_per_class` rows with grade 0 and as many above, chosen by a
    hash of the id and weighted back to the share of their class. The model is the mean of
    one on all of the sample and two with the features of one half and the weights of the other. Several grades for an id: the
    highest counts. NULL ids, NULL grades and ids without a document do not count. Without rows of
    both classes every document gets grade 0.
    """
    sample, weights = _bounded_sample(_with_document(labels, documents), rows_per_class)
    texts = documents.select(F.col("doc_id"), F.col("text")).join(F.broadcast(sample), "doc_id")
    texts = materialize(texts.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))), "labelled")
    halves = [texts.where(F.col("half") == h) for h in (0, 1)]
    models = []
    # What is only chance in the rows that choose the features looks certain there; rows that did not choose weigh it low.
    for share, choosing, fitting in ((0.5, texts, texts), (0.25, *halves), (0.25, *halves[::-1])):
        names = [f for f, _ in choose_features(choosing, n_features, min_documents)]
        if not names:
            continue
        rows = fitting.select("text", "grade").mapInArrow(_rates(names), "grade int, at array<int>, rate array<double>").toArrow()
        if len(np.unique(rows["grade"].to_numpy() > 0)) == 2:
            models.append((share, names, *_fit(rows, weights, len(names), n_grades, steps, ridge)))
    if not models:
        return OrdinalModel({}, tuple(30.0 + k for k in range(n_grades - 1)))
    whole, mean, cuts = sum(m[0] for m in models), Counter(), np.zeros(n_grades - 1)
    for share, names, beta, own in models:
        mean.update({f: float(b) * share / whole for f, b in zip(names, beta, strict=True)})
        cuts += np.array(own) * share / whole
    return OrdinalModel(dict(mean), tuple(map(float, cuts)))


def grade_labels(documents: DataFrame, labels: DataFrame, rows_per_class: int = 4_000) -> DataFrame:
    """(doc_id, grade, weight) from labels that only say toxic or not; weight is how many labels a row stands for.

    Grade 0: not toxic. A toxic document has grade 1, or 2 when its rate of words that occur in toxic
    documents of the (bounded) sample mostly is above the median of the toxic documents.
    """
    plain = labels.select("doc_id", F.col("toxic").cast("int").alias("grade"))
    sample, weights = _bounded_sample(_with_document(plain, documents), rows_per_class)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    marked = {f for f, odds in choose_features(texts, 2_000, 5) if odds > 3 and f[0] != "~"}

    def rate(batches):
        for batch in batches:
            out = []
            for doc_id, text in rows_of([batch], "doc_id", "text"):
                words = WORDS((text or "").lower())
                out.append((doc_id, sum(w in marked for w in words) / max(1, len(words))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.float64())], ["doc_id", "rate"]
            )

    toxic = texts.where("grade > 0").mapInArrow(rate, "doc_id long, rate double")
    middle = toxic.agg(F.percentile_approx("rate", 0.5).alias("m")).first()["m"]
    severe = toxic.where(F.col("rate") > F.lit(middle)).select("doc_id").distinct().withColumn("severe", F.lit(1))
    graded = sample.join(F.broadcast(severe), "doc_id", "left")
    weight = F.when(F.col("grade") > 0, weights.get(True, 0.0)).otherwise(weights.get(False, 0.0))
    return graded.select(
        "doc_id", F.when(F.col("severe") == 1, 2).otherwise(F.col("grade")).alias("grade"), weight.alias("weight")
    )


def _above(text: str | None, scores: _Scores, model: OrdinalModel) -> list[float]:
    words = WORDS((text or "").lower())
    return model.above(100 * math.fsum(map(scores.__getitem__, words)) / max(1, len(words)))


def accepted(documents: DataFrame, model: OrdinalModel, threshold: float = 0.5) -> DataFrame:
    """The rows of `documents` that `score` would not reject, columns as they are, whatever their names.

    Rejected rows end in the task that scores them. NULL and empty texts have no features; an empty table stays empty.
    """
    at = documents.columns.index("text")

    def run(batches):
        scores = _Scores(model)
        for batch in slices(batches, at):
            texts = batch.column(at).to_pylist()
            fine = pa.array([_above(text, scores, model)[0] < threshold for text in texts], pa.bool_())
            yield batch.filter(fine)

    return documents.mapInArrow(run, documents.schema)


def score(documents: DataFrame, model: OrdinalModel, threshold: float = 0.5) -> DataFrame:
    """`documents` with expected_severity, p_toxic, grade and rejected.

    Whole texts count; a NULL or empty text has no features. expected_severity is the mean of the
    grades' distribution, grade its most likely value, rejected says P(grade > 0) >= threshold.
    Columns of these names in the input are replaced; all others stay. Rows are neither lost nor made.
    """
    new = ["expected_severity", "p_toxic", "grade", "rejected"]
    kept = documents.select(*[F.col(f"`{c}`") for c in documents.columns if c.lower() not in new])
    at = kept.columns.index("text")

    def run(batches):
        scores = _Scores(model)
        for batch in slices(batches, at):
            out = []
            for text in batch.column(at).to_pylist():
                above = _above(text, scores, model)
                edges = [1.0, *above, 0.0]
                likely = max(range(len(edges) - 1), key=lambda k: (edges[k] - edges[k + 1], -k))
                out.append((sum(above), above[0], likely, above[0] >= threshold))
            kinds = (pa.float64(), pa.float64(), pa.int32(), pa.bool_())
            more = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *new])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{types}, expected_severity double, p_toxic double, grade int, rejected boolean")
