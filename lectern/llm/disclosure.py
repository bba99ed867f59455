"""Personal data: patterns, and terms that disclose a protected value by their co-occurrence with it.

Built-in functions only. A protected value (an e-mail address, a number) discloses itself; a term
discloses it as well when their pointwise mutual information, estimated over the corpus, comes close
to the value's own information content.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.binding import let, with_computed
from lectern.llm.common import text_hash
from lectern.session import materialize

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns. Greedy runs that cannot give anything back are possessive, and a run of
# characters that may start a match is only tried at its first one (or where the last match ended),
# so that long runs are not searched again from each of their characters.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}

# Terms: runs of letters.
TERM = r"\p{L}{3,}"
# So many disclosing terms at most are sent to every task; more are joined by shuffle, skewed partitions cut by Spark.
SENT = 100_000
BLOCK = 256


def running_sum(values: Column) -> Column:
    """For each element the sum of those before it, in blocks, so that long arrays stay cheap."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    def with_blocks(v: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
            lambda b: total(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))),
        )
        starts = F.aggregate(
            blocks,
            F.array(F.lit(0).cast("bigint")),
            lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s)),
        )
        return let(
            starts,
            lambda st: F.transform(
                v,
                lambda x, i: F.get(st, F.floor(i / BLOCK).cast("int"))
                + total(F.slice(v, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
            ),
        )

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<bigint>")).otherwise(with_blocks(v)))


def matches(text: Column, pattern: str) -> Column:
    """(start, end, match) of all leftmost, non-overlapping matches; code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g).cast("bigint"))

    def placed(m: Column) -> Column:
        sizes = F.transform(m, lambda x: F.char_length(x).cast("bigint"))

        def starts(g: Column) -> Column:
            steps = F.zip_with(F.slice(g, F.lit(1), F.size(sizes)), sizes, lambda a, b: a + b)
            return F.zip_with(running_sum(steps), F.slice(g, F.lit(1), F.size(sizes)), lambda a, b: a + b)

        return F.zip_with(
            let(gaps, starts),
            m,
            lambda s, x: F.struct(s.alias("start"), (s + F.char_length(x)).alias("end"), x.alias("match")),
        )

    none = F.array().cast("array<struct<start: bigint, end: bigint, match: string>>")
    return let(found, lambda m: F.when(F.size(m) == 0, none).otherwise(placed(m)))


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.char_length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """(start, kind, end, match) of all personal data by pattern, by start and then kind."""

    def of_kind(kind: str) -> Column:
        number = KINDS.index(kind)
        spans = F.transform(
            F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["match"])),
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), m["match"].alias("match")
            ),
        )
        none = F.array().cast("array<struct<start: bigint, kind: int, end: bigint, match: string>>")
        return F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(none) if kind in NEEDS else spans

    return F.array_sort(F.concat(*[of_kind(k) for k in KINDS]))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def _apart(spans: Column) -> Column:
    """`spans` by start without those that begin inside an earlier one, the longer of two with one start."""
    kind = "array<struct<start: bigint, end: bigint, kind: int>>"
    return F.aggregate(
        F.array_sort(
            F.transform(spans, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"].alias("kind")))
        ),
        F.array().cast(kind),
        lambda acc, s: F.when(
            (F.size(acc) == 0) | (F.get(acc["end"], F.size(acc) - 1) <= s["start"]),
            F.concat(acc, F.array(F.struct(s["start"].alias("start"), (-s["back"]).alias("end"), s["kind"].alias("kind")))),
        ).otherwise(acc),
    )


def find_patterns(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans, values, terms) of (doc_id, text): data by pattern, the distinct values of it
    whatever their case, and the distinct terms outside it.

    The text itself is not carried along.
    """
    documents = documents.withColumn("text", F.coalesce("text", F.lit("")))
    found = with_computed(documents, {"spans": base_spans(F.col("text"))})

    def between(s: Column) -> Column:
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(s["end"], i - 1))
        parts = F.transform(
            s, lambda x, i: F.substring("text", (before(i) + 1).cast("int"), F.greatest(x["start"] - before(i), F.lit(0)).cast("int"))
        )
        last = F.substring("text", (F.get(s["end"], F.size(s) - 1) + 1).cast("int"), F.char_length("text"))
        return F.concat(F.array_join(parts, " | "), F.lit(" | "), last)

    outside = F.when(F.size("spans") == 0, F.col("text")).otherwise(let(_apart(F.col("spans")), between))
    return found.select(
        "doc_id",
        text_hash(F.col("text")).alias("text_key"),
        "spans",
        F.array_distinct(F.transform("spans", lambda s: F.xxhash64(F.lower(s["match"])))).alias("values"),
        F.array_distinct(F.regexp_extract_all(F.lower(outside), F.lit(TERM), 0)).alias("terms"),
    )


def disclosing_terms(found: DataFrame, threshold: float = 0.9, min_contexts: int = 3) -> DataFrame:
    """(value, term) pairs of `find_patterns` where the term gives the value away.

    With N documents, p(v) = documents with v / N, p(t) = documents with t outside all values / N and
    p(v, t) = documents with both / N, the term discloses v if PMI(v; t) >= threshold * IC(v), where
    IC(v) = -log p(v): with threshold 1 the term occurs beside v only. At least `min_contexts` different
    texts must have both, so that copies of one text do not make a pattern. All documents count.

    As both occur together no more often than the value does, a term in more than
    n_value ** threshold * N ** (1 - threshold) documents cannot disclose it: such pairs are not made.
    """
    held = found.select("text_key", F.explode("values").alias("value")).groupBy("text_key", "value")
    held = materialize(held.agg(F.count("*").alias("n")), "held")
    values = held.groupBy("value").agg(F.sum("n").alias("n_value"), F.count("*").alias("texts"))
    total = found.count()
    most = F.pow(F.col("n_value"), threshold) * float(total) ** (1 - threshold) * (1 + 1e-9)
    values = values.where(F.col("texts") >= min_contexts).select("value", "n_value", most.alias("most"))
    held = materialize(held.join(values, "value"), "holders")
    corpus = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    top = held.agg(F.max("most")).first()[0] or 0.0
    corpus = corpus.where((F.col("n_term") >= min_contexts) & (F.col("n_term") <= top))
    texts = found.select("text_key", "terms").join(held.select("text_key").distinct(), "text_key", "left_semi")
    # Copies share a key; one of them is enough.
    texts = texts.groupBy("text_key").agg(F.first("terms").alias("terms"))
    beside = texts.select("text_key", F.explode("terms").alias("term")).join(corpus, "term")
    # Terms too frequent for a value are left out by the join itself.
    due = (beside["text_key"] == held["text_key"]) & (F.col("n_term") <= F.col("most"))
    pairs = beside.join(held, due).groupBy("value", "term").agg(
        F.sum("n").alias("n_both"),
        F.count("*").alias("n_texts"),
        F.first("n_value").alias("n_value"),
        F.first("n_term").alias("n_term"),
    )
    information = -F.log(F.least(F.col("n_value") / float(total or 1), F.lit(1.0)))
    mutual = F.log(F.col("n_both") * float(total) / (F.col("n_value") * F.col("n_term").cast("double")))
    # A hair of slack for the rounding of logarithms.
    enough = (F.col("n_texts") >= min_contexts) & (mutual >= threshold * information - 1e-9)
    return pairs.where(enough).select("value", "term")


def find_spans(documents: DataFrame, threshold: float = 0.9, min_contexts: int = 3) -> DataFrame:
    """(doc_id, text_key, spans) of (doc_id, text): patterns and disclosing terms, by start and then kind.

    A term is a span of kind 4 wherever it occurs in any document, whether or not that holds the value it
    gives away, outside the spans by pattern. NULL texts count as empty and have no spans. Equal rows have
    equal spans; every row is kept.
    """
    found = materialize(find_patterns(documents), "patterns")
    wanted = materialize(disclosing_terms(found, threshold, min_contexts).select("term").distinct(), "disclosing")
    wanted = F.broadcast(wanted) if wanted.count() <= SENT else wanted
    holders = found.select("text_key", F.explode("terms").alias("term")).join(wanted, "term", "left_semi")
    # Of every text its own disclosing terms, so that no other term of it is ever a row.
    holders = materialize(holders.groupBy("text_key").agg(F.collect_set("term").alias("own")), "holders")
    documents = documents.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("text_key", text_hash(F.col("text")))
    # Copies share a key; one of them is enough.
    texts = documents.select("text_key", "text").join(holders, "text_key")
    texts = texts.groupBy("text_key").agg(F.first("text").alias("text"), F.first("own").alias("own"))
    disclosing = F.filter(matches(F.col("text"), TERM), lambda m: F.array_contains("own", F.lower(m["match"])))
    span = lambda m: F.struct(m["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), m["end"].alias("end"), F.lit("").alias("match"))
    hits = texts.select("text_key", F.transform(disclosing, span).alias("more"))
    both = found.select("doc_id", "text_key", "spans").join(hits, "text_key", "left")
    outside = F.filter(
        "more", lambda m: ~F.exists("spans", lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"]))
    )
    merged = F.array_sort(F.concat("spans", outside))
    return both.select(
        "doc_id", "text_key", F.when(F.col("more").isNull(), F.col("spans")).otherwise(merged).alias("spans")
    )


def sanitise(documents: DataFrame, threshold: float = 0.9, min_contexts: int = 3) -> DataFrame:
    """`documents` with personal data generalised to its kind ([EMAIL], ...) and disclosing terms removed.

    Overlapping spans are taken from the left, the longer of two with one start. All other columns
    stay as they are, whatever their names, NULL texts too, and every row is kept, repeated ones included. An empty
    table stays empty.
    """
    spans = find_spans(documents.select("doc_id", "text"), threshold, min_contexts)
    spans = spans.where(F.size("spans") > 0).groupBy("text_key").agg(F.first("spans").alias("spans"))
    # The given columns stay in a struct, so that none can have a name that is used here.
    keyed = documents.select(
        F.struct("*").alias("row"), F.col("text"), text_hash(F.coalesce("text", F.lit(""))).alias("text_key")
    )
    joined = keyed.join(spans, "text_key", "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS], F.lit("[TERM]"))

    def rewritten(s: Column) -> Column:
        parts = F.transform(
            s,
            lambda x, i: F.concat(
                F.substring(
                    "text",
                    (F.when(i == 0, F.lit(0)).otherwise(F.get(s["end"], i - 1)) + 1).cast("int"),
                    (x["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(s["end"], i - 1))).cast("int"),
                ),
                F.get(names, x["kind"]),
            ),
        )
        rest = F.substring("text", (F.get(s["end"], F.size(s) - 1) + 1).cast("int"), F.char_length("text"))
        return F.concat(F.array_join(parts, ""), rest)

    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(let(_apart(F.col("spans")), rewritten))
    return joined.select(F.col("row").withField("text", text).alias("row")).select("row.*")


def span_digest(spans: DataFrame) -> DataFrame:
    """Counts, digest and text form of the spans of `find_spans`."""
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    counted = with_computed(spans, {"_base": base})
    counts = [
        F.size(_of_kind("_base", number)).cast("long").alias(f"n_{kind}")
        for number, kind in enumerate(KINDS)
    ]
    return counted.select(
        "doc_id", *counts, F.sha2(written(F.col("_base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def _of_kind(spans: str, number: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == number)
