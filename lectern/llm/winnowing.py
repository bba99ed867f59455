"""Document fingerprints: winnowing over rolling k-gram hashes, in built-in functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions.binding import let, with_computed
from lectern.llm.common import pieces_for

# The prime the hashes are taken modulo, and the base they roll with.
PRIME, BASE = (1 << 31) - 1, 1_000_003

# A unit: up to four characters of one word, counted from the word's start.
UNIT = r"[^\x20\x09-\x0D]{1,4}"


def _shifted(values: Column, step: int, join) -> Column:
    """join(values[i], values[i + step]) for every i that has both."""
    count = F.size(values) - step
    return F.zip_with(F.slice(values, F.lit(1), count), F.slice(values, F.lit(step + 1), count), join)


def _steps(size: int) -> list[int]:
    """Shifts whose doubling covers `size` neighbours: 1, 2, 4, ... and what is left."""
    steps, covered = [], 1
    while covered < size:
        steps.append(min(covered, size - covered))
        covered += steps[-1]
    return steps


def rolling_hashes(units: Column, k: int) -> Column:
    """Hashes of all runs of `k` units: sum of unit[i + j] * BASE^(k - 1 - j), modulo PRIME.

    k is a power of two. Two runs' hashes roll into the hash of the run twice as long, so the work is
    log k passes whatever k is. Fewer than k units are filled up to one run.
    """
    values = F.transform(units, lambda u: F.pmod(F.xxhash64(u), F.lit(PRIME - 1)) + 1)
    missing = F.greatest(F.lit(k) - F.size(units), F.lit(0))
    values = F.concat(values, F.array_repeat(F.lit(0).cast("long"), missing))
    length = 1
    while length < k:
        factor, step = pow(BASE, length, PRIME), length
        values = let(
            values,
            lambda v: _shifted(v, step, lambda a, b: (a * F.lit(factor) + b) % F.lit(PRIME)),
        )
        length *= 2
    return values


def winnow(units: Column, k: int = 4, window: int = 8) -> Column:
    """Selected k-grams as numbers hash * 2^32 + (2^32 - 1 - position), by rising position.

    Of each `window` neighbouring k-grams the one with the smallest hash is taken, the rightmost among
    equals (a later position makes the smaller number). A run of k + window - 1 units that two texts
    share is sure to give both a common fingerprint. Short texts have one window with all they have;
    no units give an empty array.
    """
    top = (1 << 32) - 1
    coded = let(rolling_hashes(units, k), lambda h: F.transform(h, lambda x, i: x * F.lit(1 << 32) + (F.lit(top) - i)))
    missing = lambda c: F.greatest(F.lit(window) - F.size(c), F.lit(0))
    lowest = let(coded, lambda c: F.concat(c, F.array_repeat(F.lit((1 << 63) - 1), missing(c))))
    for step in _steps(window):
        lowest = let(lowest, lambda c: _shifted(c, step, lambda a, b: F.least(a, b)))
    return F.when(F.size(units) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(lowest))


def hashes(fingerprint: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(fingerprint, lambda v: F.shiftright(v, 32)))


def positions(fingerprint: Column) -> Column:
    """(hash, position in units) of each selected k-gram."""
    top = (1 << 32) - 1
    return F.transform(
        fingerprint,
        lambda v: F.struct(F.shiftright(v, 32).alias("hash"), (F.lit(top) - v.bitwiseAND(F.lit(top))).alias("position")),
    )


def as_text(fingerprint: Column) -> Column:
    """hash:position pairs, hashes in hexadecimal, comma-joined by position; empty without any."""
    top = (1 << 32) - 1
    return F.array_join(
        F.transform(
            fingerprint,
            lambda v: F.concat(F.lower(F.hex(F.shiftright(v, 32))), F.lit(":"), F.lit(top) - v.bitwiseAND(F.lit(top))),
        ),
        ",",
    )


def likeness(one: Column, other: Column) -> Column:
    """Jaccard coefficient of two sets of hashes; two empty ones are alike (1), one empty is not (0)."""
    both = F.size(F.array_intersect(one, other))
    return F.when((F.size(one) == 0) & (F.size(other) == 0), F.lit(1.0)).otherwise(
        both / (F.size(one) + F.size(other) - both)
    )


def fingerprints(documents: DataFrame, text_column: str = "text", k: int = 4, window: int = 8) -> DataFrame:
    """`documents` with `fingerprint`: array of (hash, position). NULL and blank texts have none.

    A column of that name in the input is replaced.
    """
    units = F.regexp_extract_all(F.coalesce(F.col(text_column), F.lit("")), F.lit(UNIT), 0)
    return with_computed(documents, {"fingerprint": let(units, lambda u: positions(winnow(u, k, window)))})


def with_next_text(documents: DataFrame) -> DataFrame:
    """Adds `next_text`: the text of the next row by descending doc_id; the last row's next is the first.

    Ids that are NULL come last; equal ids are ordered by text. The order is found within ranges of
    ids, cut at quantiles and then evenly, and only the first row of each range crosses to another.
    """
    documents = documents.withColumn("text", F.coalesce("text", F.lit("")))
    ranges = pieces_for(documents, 16 << 20, 8)
    coarse = min(64, ranges)
    cuts = documents.agg(F.percentile_approx("doc_id", [i / coarse for i in range(coarse + 1)], 10_000)).first()[0]
    fine = -(-ranges // coarse)
    place = F.lit(-1).cast("long")
    for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False) if cuts else ()):
        if high > low:
            within = F.floor((F.col("doc_id").cast("double") - low) / (high - low) * fine).cast("long")
            bounded = F.least(F.greatest(within, F.lit(0)), F.lit(fine - 1))
            place = F.when(F.col("doc_id") >= low, F.lit(i * fine) + bounded).otherwise(place)
    placed = documents.withColumn("_range", F.when(F.col("doc_id").isNull(), F.lit(-2)).otherwise(place))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    window = Window.partitionBy("_range").orderBy(*order)
    led = placed.withColumn("_next", F.lead("text").over(window))
    # The first row of each range: one row per range, joined to the range before it.
    heads = placed.groupBy("_range").agg(F.min_by("text", F.struct(-F.col("doc_id"), "text")).alias("_head"))
    around = Window.orderBy(F.col("_range").desc())
    places = placed.select("_range").distinct()
    following = places.select(
        "_range", F.coalesce(F.lead("_range").over(around), F.max("_range").over(Window.partitionBy(F.lit(0)))).alias("_after")
    )
    heads = following.join(heads.withColumnRenamed("_range", "_after"), "_after").select("_range", "_head")
    return led.join(heads, "_range", "left").select(
        *documents.columns, F.coalesce("_next", "_head").alias("next_text")
    )


def compare_with_edits(documents: DataFrame, k: int = 4, window: int = 8) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they and the next document's are.

    Takes (doc_id, text); NULL texts count as empty. The edited text has its last floor(n / 2) code points replaced
    by the first as many of the next document's (all, if it has fewer). Every row is kept, repeated ones too; NULL ids
    come last; an empty table gives no rows; other columns are not looked at.
    """
    paired = with_next_text(documents.select("doc_id", "text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)
    )
    paired = with_computed(paired, {"n_chars": F.char_length("text").cast("long")})
    paired = with_computed(paired, {"_edited": edited})
    units = lambda c: F.regexp_extract_all(F.col(c), F.lit(UNIT), 0)
    marks = lambda c: let(units(c), lambda u: winnow(u, k, window))
    paired = with_computed(paired, {"_a": marks("text"), "_b": marks("_edited"), "_c": marks("next_text")})
    paired = with_computed(paired, {"_ha": hashes(F.col("_a")), "_hb": hashes(F.col("_b")), "_hc": hashes(F.col("_c"))})
    return paired.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("_a")).alias("fingerprint"),
        as_text(F.col("_b")).alias("edited_fingerprint"),
        likeness(F.col("_ha"), F.col("_hb")).alias("near_edited"),
        likeness(F.col("_ha"), F.col("_hc")).alias("near_next"),
    )
