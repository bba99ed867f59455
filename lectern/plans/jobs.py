"""End-to-end jobs: requests to stored items, corpus to keywords, outline to sections."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.config import DEFAULTS, JobConfig
from lectern.functions.titles import storage_path
from lectern.operators.extract import read_by_type
from lectern.operators.requests import (
    apply_defaults,
    classify_requests,
    measure_text,
    normalize_requests,
    route_requests,
    title_from_page,
    title_from_text,
    title_of_video,
    unpack_payloads,
)
from lectern.operators.sections import parse_outline, section_ranges, section_texts, slice_sections
from lectern.session import materialize


def process_requests(
    requests: DataFrame,
    pages: DataFrame | None = None,
    request_key: str = "request_hash",
    documents: DataFrame | None = None,
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Normalized requests to outcomes: classified, read, titled, measured, routed and placed.

    `pages` is the table of landed web pages (page_id, url, html) that TEXT requests are read from,
    `documents` the one of parsed document pages (uri, page_no, text) for PDF requests. Every request
    gives one outcome.
    """
    return finish_requests(read_by_type(classify_requests(requests, cfg), pages, documents, request_key, cfg), cfg)


def finish_requests(read: DataFrame, cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Requests whose text has been read (with `page_title`) to outcomes; row by row, in a batch or a stream."""
    titled = title_of_video(title_from_text(title_from_page(read, cfg), cfg))
    routed = route_requests(apply_defaults(measure_text(titled), cfg))
    path = storage_path(F.lit("AUDIO"), F.col("uri"), F.col("title"), F.col("created"))
    return routed.withColumn("storage_path", F.when(F.col("status") == "ACCEPTED", path)).drop("page_title")


def process_payloads(
    payloads: DataFrame,
    pages: DataFrame | None = None,
    documents: DataFrame | None = None,
    payload: str = "payload",
    cfg: JobConfig = DEFAULTS,
) -> DataFrame:
    """Landed payloads to outcomes, the rejected payloads among them as errors of their own.

    Everything that arrived comes out on one side or the other, so one write stores it all.
    """
    keys = tuple(c for c in payloads.columns if c != payload)
    requests = normalize_requests(unpack_payloads(payloads, payload), keep=(*keys, payload, "pos"))
    if pages is not None or documents is not None:
        # The joins read them more than once: parse the payloads and draw the ids a single time.
        requests = materialize(requests, "requests")
    malformed = F.col(payload).isNotNull()
    return process_requests(requests, pages, documents=documents, cfg=cfg).withColumns(
        {
            "type": F.when(~malformed, F.col("type")),
            "route": F.when(~malformed, F.col("route")),
            "status": F.when(malformed, "ERROR").otherwise(F.col("status")),
            "output_type": F.when(~malformed, F.col("output_type")),
            "reason": F.when(malformed, "malformed payload").otherwise(F.col("reason")),
        }
    )


def split_by_outline(lines: DataFrame, pages: DataFrame, doc: str = "doc_id", cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Outline lines and pages to the text of each section."""
    ranges = section_ranges(parse_outline(lines, doc), doc, cfg)
    return section_texts(slice_sections(ranges, pages, doc, cfg=cfg), doc)
