"""Readable text from landed pages and paged documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.config import DEFAULTS, JobConfig
from lectern.functions.html import content_blocks, page_title, text_blocks
from lectern.functions.text import byte_length
from lectern.operators.skew import count_keys, salted_join


def html_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Text tokens of each page with the most recent start tag: (key, pos, tag, text)."""
    return pages.select(key, F.inline(text_blocks(F.col(html))))


def extract_text(
    pages: DataFrame, keys: tuple[str, ...] = ("page_id",), html: str = "html", cfg: JobConfig = DEFAULTS
) -> DataFrame:
    """Body text of each page: its content blocks joined in order. No shuffle, a page is a row."""
    blocks = pages.select(*keys, content_blocks(F.col(html), cfg.min_text_block).alias("blocks"))
    return blocks.select(
        *keys,
        F.array_join("blocks", "").alias("text"),
        byte_length(F.array_join("blocks", "")).alias("size"),
        F.size("blocks").cast("bigint").alias("n_blocks"),
    )


def page_titles(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return pages.select(key, page_title(F.col(html)).alias("title"))


def assemble_pages(
    pages: DataFrame, doc: str = "doc_id", page_no: str = "page_no", text: str = "text"
) -> DataFrame:
    """Page texts of each document joined in page order; unreadable (NULL) pages are skipped.

    One row per document, however many pages it has: its text is one record.
    """
    in_order = F.array_sort(F.collect_list(F.struct(F.col(page_no).alias("no"), F.col(text).alias("text"))))
    return (
        pages.where(F.col(text).isNotNull())
        .groupBy(doc)
        .agg(in_order.alias("pages"))
        .select(
            doc,
            F.size("pages").cast("bigint").alias("n_pages"),
            F.array_join(F.transform("pages", lambda p: p["text"]), "").alias("text"),
        )
    )


def landed_text(pages: DataFrame, uri: str, order_by: str, html: str = "html", cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Newest landed page per URI as (uri, landed_text, page_title)."""
    read = pages.where(F.col(uri).isNotNull()).select(
        F.col(uri).alias("uri"),
        F.col(order_by).alias("_order"),
        F.nullif(F.array_join(content_blocks(F.col(html), cfg.min_text_block), ""), F.lit("")).alias("landed_text"),
        page_title(F.col(html)).alias("page_title"),
    )
    newest = F.max_by(F.struct("landed_text", "page_title"), F.col("_order")).alias("page")
    return read.groupBy("uri").agg(newest).select("uri", "page.landed_text", "page.page_title")


def _without_text() -> Column:
    return F.coalesce(F.col("text"), F.lit("")) == ""


def text_from_pages(
    requests: DataFrame,
    pages: DataFrame,
    request_key: str,
    uri: str = "url",
    order_by: str = "page_id",
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Text and `page_title` of the landed page for requests without text.

    Joins on the URI, salted, because one URI may be asked for by a large share of the requests. When
    the URIs asked for are few, the pages are first cut down to them, so that only those are parsed.
    """
    counts = count_keys(requests, "uri")
    wanted = counts.small_keys(cfg.broadcast_bytes)
    if wanted is not None:
        pages = pages.join(wanted, pages[uri] == wanted["uri"], "left_semi")
    landed = landed_text(pages, uri, order_by, cfg=cfg)
    found = salted_join(requests, landed, "uri", [request_key], counts=counts)
    return found.withColumn("text", F.col("landed_text")).drop("landed_text")


def text_from_documents(
    requests: DataFrame,
    pages: DataFrame,
    request_key: str,
    uri: str = "uri",
    page_no: str = "page_no",
    text: str = "text",
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Text of the paged document, a page table keyed by URI, for requests without text."""
    counts = count_keys(requests, "uri")
    wanted = counts.small_keys(cfg.broadcast_bytes)
    if wanted is not None:
        pages = pages.join(wanted, pages[uri] == wanted["uri"], "left_semi")
    whole = assemble_pages(pages, uri, page_no, text).select(
        F.col(uri).alias("uri"), F.nullif(F.col("text"), F.lit("")).alias("landed_text")
    )
    found = salted_join(requests, whole, "uri", [request_key], counts=counts)
    return found.withColumn("text", F.col("landed_text")).drop("landed_text")


def enrich_text(
    requests: DataFrame,
    pages: DataFrame,
    request_key: str,
    uri: str = "url",
    order_by: str = "page_id",
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Requests with the text of their landed page where they carry none.

    Requests with text never reach the join.
    """
    read = text_from_pages(requests.where(_without_text()), pages, request_key, uri, order_by, cfg)
    return requests.where(~_without_text()).withColumn("page_title", F.lit(None).cast("string")).unionByName(read)


def read_by_type(
    requests: DataFrame,
    pages: DataFrame | None,
    documents: DataFrame | None,
    request_key: str,
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Text-less TEXT requests read from web pages, PDF ones from paged documents, the others as they are.

    Adds `page_title`. Each kind takes its own join, none sees the rows of another.
    """
    kind = F.when(_without_text(), F.col("type"))
    from_pages = F.coalesce(kind == "TEXT", F.lit(False)) & F.lit(pages is not None)
    from_documents = F.coalesce(kind == "PDF", F.lit(False)) & F.lit(documents is not None)
    no_title = F.lit(None).cast("string")
    done = requests.where(~from_pages & ~from_documents).withColumn("page_title", no_title)
    if pages is not None:
        read = text_from_pages(requests.where(from_pages), pages, request_key, cfg=cfg)
        done = done.unionByName(read)
    if documents is not None:
        read = text_from_documents(requests.where(from_documents), documents, request_key, cfg=cfg)
        done = done.unionByName(read.withColumn("page_title", no_title))
    return done
