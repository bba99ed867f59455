"""Outlines: markers, page ranges and the pages of each section."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.config import DEFAULTS, JobConfig
from lectern.operators.skew import salted_join

# Patterns of an outline line that points at a page.
PAGE_MARK = r"#([0-9]+),[0-9]+,[0-9]+"
NAME_MARK = r'"([^"]*)"'
OPEN_END = -1

# A tree over the buckets of pages, 64 children a node.
TREE_BITS = 6


def parse_outline(lines: DataFrame, doc: str = "doc_id", line_no: str = "line_no", line: str = "line") -> DataFrame:
    """(doc, line_no, name, page_start) of the lines that hold a page and a quoted name.

    A page number beyond 64 bits makes no marker.
    """
    text = F.col(line)
    page = F.regexp_extract(text, PAGE_MARK, 1).try_cast("bigint")
    return lines.where(text.rlike(PAGE_MARK) & text.rlike(NAME_MARK) & page.isNotNull()).select(
        doc,
        line_no,
        F.regexp_extract(text, NAME_MARK, 1).alias("name"),
        page.alias("page_start"),
    )


def section_ranges(markers: DataFrame, doc: str = "doc_id", cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Markers with `page_end`: the page before the next marker, or -1 for the last one.

    Pages count from 1. The next marker is looked up inside chunks of lines, and across them only
    between their first markers: a giant outline is never one window. Markers without a document or
    line number are kept; those without a document make one outline, those without a number come first.
    """
    starts = markers.withColumn("page_start", F.greatest("page_start", F.lit(1)))
    chunks = starts.withColumn("_chunk", F.floor(F.col("line_no") / F.lit(cfg.outline_chunk)))
    inside = F.lead("page_start").over(W.partitionBy(doc, "_chunk").orderBy("line_no"))
    # A struct, as min_by leaves out rows without an order.
    first = F.min(F.struct("line_no", "page_start"))["page_start"]
    after = F.lead("_first").over(W.partitionBy(doc).orderBy("_chunk"))
    firsts = chunks.groupBy(doc, "_chunk").agg(first.alias("_first"))
    firsts = firsts.select(F.col(doc).alias("_doc"), F.col("_chunk").alias("_of"), after.alias("_after"))
    same = F.col(doc).eqNullSafe(F.col("_doc")) & F.col("_chunk").eqNullSafe(F.col("_of"))
    following = F.coalesce("_inside", "_after")
    return (
        chunks.withColumn("_inside", inside)
        .join(firsts, same)
        .select(doc, "line_no", "name", "page_start", F.coalesce(following - 1, F.lit(OPEN_END)).alias("page_end"))
    )


def _levels(last_bucket: int) -> int:
    """How high the tree has to be for buckets up to `last_bucket`: its top level has 64 nodes at most."""
    levels = 1
    while last_bucket >> (TREE_BITS * levels):
        levels += 1
    return levels


def _cover(first: Column, last: Column, levels: int) -> Column:
    """Nodes (_level, _node) of the tree over buckets that hold first..last, each bucket in one of them.

    On every level the nodes that lie inside the range while their parents do not: 126 at most.
    """

    def inside(level: int) -> tuple[Column, Column]:
        return F.shiftright(first + ((1 << TREE_BITS * level) - 1), TREE_BITS * level), F.shiftright(
            last + 1, TREE_BITS * level
        )

    def run(level: int, start: Column, end: Column) -> Column:
        numbers = F.when(start < end, F.sequence(start, end - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(numbers, lambda n: F.struct(F.lit(level).alias("_level"), n.alias("_node")))

    runs = []
    for level in range(levels):
        start, end = inside(level)
        parent, parent_end = inside(min(level + 1, levels - 1))
        has_parents = (parent < parent_end) & F.lit(level + 1 < levels)
        runs.append(run(level, start, F.when(has_parents, parent * (1 << TREE_BITS)).otherwise(end)))
        runs.append(run(level, F.when(has_parents, parent_end * (1 << TREE_BITS)).otherwise(end), end))
    return F.concat(*runs)


def slice_sections(
    sections: DataFrame,
    pages: DataFrame,
    doc: str = "doc_id",
    page_no: str = "page_no",
    text: str = "text",
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Pages of each section as rows (doc, line_no, name, page_no, text).

    A range join on (doc, bucket of pages): a section is repeated per bucket it covers and meets the
    pages of those buckets only, so neither a giant document nor a giant section is one group. The
    buckets are those that have pages, found through a tree, so that a stray page number far off
    costs a section some nodes and not a row per bucket in between. The tree is as high as the largest page number,
    looked up first, asks for.
    """
    width = F.lit(cfg.page_bucket)
    levels = _levels(max(0, pages.agg(F.max(page_no)).first()[0] or 0) // cfg.page_bucket)
    content = pages.select(
        F.col(doc), F.col(page_no).alias("page_no"), F.col(text).alias("text")
    ).withColumn("_bucket", F.floor(F.col("page_no") / width))
    last_pages = pages.groupBy(doc).agg(F.max(page_no).alias("_last"))
    closed = (
        salted_join(sections, last_pages, doc, ["line_no"], "inner")
        .withColumn(
            "_end",
            F.when(F.col("page_end") == OPEN_END, F.col("_last")).otherwise(F.least("page_end", "_last")),
        )
        .where(F.col("_end") >= F.col("page_start"))
    )
    cover = _cover(F.floor(F.col("page_start") / width), F.floor(F.col("_end") / width), levels)
    nodes = (
        content.select(doc, "_bucket")
        .distinct()
        .withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
        .withColumn("_node", F.expr(f"shiftright(_bucket, {TREE_BITS} * _level)"))
    )
    return (
        closed.select("*", F.inline(cover))
        .join(nodes, [doc, "_level", "_node"])
        .join(content, [doc, "_bucket"])
        .where(F.col("page_no").between(F.col("page_start"), F.col("_end")))
        .select(doc, "line_no", "name", "page_start", "page_no", "text")
    )


def section_texts(slices: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Text of each section, its pages joined in order: one row per section."""
    in_order = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return (
        slices.where(F.col("text").isNotNull())
        .groupBy(doc, "line_no", "name")
        .agg(in_order.alias("pages"))
        .select(
            doc,
            "line_no",
            "name",
            F.size("pages").cast("bigint").alias("n_pages"),
            F.array_join(F.transform("pages", lambda p: p["text"]), "").alias("text"),
        )
    )
