"""Texts as ropes: ordered pieces with the byte they start at, for texts that should never be one string.

`extract.assemble_pages` gives one string per document. A rope keeps the pages as rows, cut where one is long, so that a
document may be larger than a task, and any byte range is cut out of the few pieces that it touches.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions.text import byte_length
from lectern.operators.skew import salted_join

PIECE_CHARS = 1 << 16  # Characters of a piece; at most four times as many bytes.
CHUNK = 1_000  # Page numbers whose pieces are summed before documents are.
BUCKET = 1 << 18  # Bytes of the buckets that ranges and pieces meet in.


def text_rope(
    pages: DataFrame, doc: str = "doc_id", page_no: str = "page_no", text: str = "text", piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """(doc, page_no, part, start, end, text): the pieces of each document's text, in bytes of UTF-8, end exclusive.

    Joined in order of start they are the text that `assemble_pages` gives; unreadable (NULL) pages are skipped, pages of
    one number go by their text. Where a piece starts is summed within chunks of page numbers and then over the chunks of a
    document: no window holds the pages of a whole document. Pages without a document make one, pages without a
    number come first.
    """
    # Pages of one number are put in order before anything is cut, so that pieces need not carry their page.
    ties = W.partitionBy(doc, "page_no").orderBy("_page")
    whole = pages.where(F.col(text).isNotNull()).select(doc, F.col(page_no).alias("page_no"), F.col(text).alias("_page"))
    whole = whole.withColumn("_tie", F.row_number().over(ties))
    parts = F.sequence(F.lit(0), F.floor(F.greatest(F.char_length("_page") - 1, F.lit(0)) / piece_chars).cast("int"))
    cut = F.substring("_page", F.col("part") * piece_chars + 1, F.lit(piece_chars))
    pieces = whole.select("*", F.explode(parts).alias("part")).select(doc, "page_no", "_tie", "part", cut.alias("text"))
    pieces = pieces.withColumns({"_n": byte_length(F.col("text")), "_chunk": F.floor(F.col("page_no") / CHUNK)})
    order = ["page_no", "_tie", "part"]
    running = W.partitionBy(doc, "_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    sums = pieces.groupBy(doc, "_chunk").agg(F.sum("_n").alias("_sum"))
    earlier = W.partitionBy(doc).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    firsts = sums.select(
        F.col(doc).alias("_doc"), F.col("_chunk").alias("_of"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_first")
    )
    within = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    same = F.col(doc).eqNullSafe(F.col("_doc")) & F.col("_chunk").eqNullSafe(F.col("_of"))
    start = F.col("_first") + F.col("_before")
    return within.join(firsts, same).select(
        doc, "page_no", "part", start.alias("start"), (start + F.col("_n")).alias("end"), "text"
    )


def cut_ranges(
    rope: DataFrame, ranges: DataFrame, doc: str = "doc_id", key: str = "range_id", piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """(doc, key, start, end, data): the bytes `start` to `end` (exclusive) of each range's document, in order.

    Ranges (doc, key, start, end) and pieces meet in buckets of bytes, so that a range reads the pieces it touches and
    no others. A range beyond the text gives what there is of it; one that meets no byte gives no row. A cut may
    fall inside a character: data is binary.
    """
    longest = 4 * piece_chars
    low = F.floor(F.greatest(F.col("start") - longest, F.lit(0)) / BUCKET)
    last = rope.groupBy(doc).agg(F.max("end").alias("_last"))
    asked = salted_join(ranges.select(doc, key, "start", "end"), last, doc, [key], "inner")
    # No row per bucket beyond the text.
    asked = asked.withColumn("_end", F.least("end", "_last")).where(F.greatest("start", F.lit(0)) < F.col("_end"))
    asked = asked.select(
        doc, key, F.col("start").alias("_from"), F.col("end").alias("_to"),
        F.explode(F.sequence(low, F.floor((F.col("_end") - 1) / BUCKET))).alias("_bucket"),
    )
    placed = rope.withColumn("_bucket", F.floor(F.col("start") / BUCKET))
    met = asked.join(placed, [doc, "_bucket"]).where((F.col("start") < F.col("_to")) & (F.col("end") > F.col("_from")))
    skip = F.greatest(F.col("_from") - F.col("start"), F.lit(0)).cast("int")
    size = (F.least("end", "_to") - F.greatest("start", "_from")).cast("int")
    # Binary aggregates do not concatenate in order; pieces are put in order as hexadecimal text.
    data = F.hex(F.substring(F.encode("text", "UTF-8"), skip + 1, size))
    cut = met.select(doc, key, "_from", "_to", F.struct(F.col("start"), data.alias("data")).alias("_piece"))
    whole = cut.groupBy(doc, key, "_from", "_to").agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    return whole.select(
        doc, key, F.col("_from").alias("start"), F.col("_to").alias("end"),
        F.unhex(F.array_join(F.transform("_pieces", lambda p: p["data"]), "")).alias("data"),
    )
