"""Requests: batches in, normalized, titled, measured, routed and projected rows out."""

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.config import CONTENT_TYPES, DEFAULTS, JobConfig
from lectern.functions.binding import let, with_computed
from lectern.functions.titles import clean_title, cut_title, drop_non_graphic, type_ext
from lectern.functions.text import byte_length
from lectern.functions.uri import classify, uri_title
from lectern.schema import INPUT_NUMBERS, INPUT_STRINGS, PUBLIC_COLUMNS, REQUEST_SCHEMA

# Contract patterns of a content type and of a request id.
TYPE_PATTERN = f"^({'|'.join(CONTENT_TYPES)})$"
REQUEST_ID_PATTERN = r"^[0-9a-fA-F]{8}\b-[0-9a-fA-F]{4}\b-[0-9a-fA-F]{4}\b-[0-9a-fA-F]{4}\b-[0-9a-fA-F]{12}$"

UNSIGNED_COLUMNS = (
    "created",
    "size",
    "length",
    "submitted_at",
    "number_of_conversions",
    "words_per_minute",
)


def _given(name: str) -> Column:
    """Text field as sent, NULL when empty."""
    return F.nullif(F.col(name), F.lit(""))


def _positive(name: str, kind: str) -> Column:
    return F.when(F.col(name) > 0, F.col(name)).cast(kind)


def _field(df: DataFrame, name: str, value: Column) -> Column:
    kind = REQUEST_SCHEMA[name].dataType
    return (value if name in df.columns else F.lit(None)).cast(kind).alias(name)


def _number_type(name: str) -> str:
    """The SQL type that holds all values of an input number."""
    return "decimal(20,0)" if INPUT_NUMBERS[name][1] >= 2**63 else "bigint"


def parse_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds `items`, the parsed array of inputs: NULL for a payload that must be rejected.

    A payload is rejected whole when it is no JSON array of objects (a bare object counts as none), when
    one of its fields has a value of another JSON type, or when one of its numbers is no whole number or
    outside the range of its field. The case of keys does not matter; of several spellings the last counts. JSON types are
    known of payloads that a variant can hold; one that is too large for it, or that repeats a field, is judged by
    its values alone.
    """
    sent = F.try_parse_json(F.col(payload)).try_cast("array<variant>")
    # All keys as they are spelt, repeated ones too; values as text.
    loose = F.when(
        F.json_array_length(F.col(payload)).isNotNull(),
        F.from_json(F.col(payload), "array<map<string,string>>", {"mode": "PERMISSIVE"}),
    )

    def folded(item: Column) -> Column:
        def field(entries: Column, name: str) -> Column:
            own = F.filter(entries, lambda e: F.lower(e["key"]) == name)
            return let(own, lambda found: F.get(found, F.size(found) - 1)["value"]).alias(name)

        names = [*INPUT_STRINGS, *INPUT_NUMBERS]
        return let(F.map_entries(item), lambda entries: F.struct(*[field(entries, n) for n in names]))

    def wrong_number(item: Column) -> Column:
        checks = []
        for name, (least, most) in INPUT_NUMBERS.items():
            number = item[name].try_cast("decimal(38,0)")
            whole = item[name].rlike("^-?[0-9]+$" if least < 0 else "^[0-9]+$")
            bounds = [F.lit(str(n)).cast("decimal(38,0)") for n in (least, most)]
            fits = whole & F.coalesce(number.between(*bounds), F.lit(False))
            checks.append(item[name].isNotNull() & ~fits)
        return reduce(lambda a, b: a | b, checks)

    def wrong_type(item: Column) -> Column:
        def odd(entry: Column) -> Column:
            key, kind = F.lower(entry["key"]), F.coalesce(F.schema_of_variant(entry["value"]), F.lit("VOID"))
            number = key.isin(*INPUT_NUMBERS) & ~kind.rlike(r"^(BIGINT|DECIMAL\([0-9]+,0\)|VOID)$")
            return number | (key.isin(*INPUT_STRINGS) & ~kind.isin("STRING", "VOID"))

        fields = item.try_cast("map<string,variant>")
        no_object = fields.isNull() & ~F.is_variant_null(item)
        return no_object | F.coalesce(F.exists(F.map_entries(fields), odd), F.lit(False))

    wrong = F.coalesce(F.exists(sent, wrong_type), F.lit(False))
    parsed = with_computed(payloads, {"items": F.when(~wrong, F.transform(loose, folded))})
    return with_computed(parsed, {"items": F.when(~F.exists("items", wrong_number), F.col("items"))})


def batch_outcomes(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per payload, empty batches included: its other columns, `accepted` and `n_requests`."""
    keys = [c for c in payloads.columns if c != payload]
    return parse_payloads(payloads, payload).select(
        *keys,
        F.col("items").isNotNull().alias("accepted"),
        F.coalesce(F.array_size("items"), F.lit(0)).cast("bigint").alias("n_requests"),
    )


def unpack_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per element of each JSON array, and one row per payload that was rejected.

    The payload itself stays only with a rejected one; its other columns are NULL then. An empty batch
    holds no request; `batch_outcomes` counts it. One pass, each payload is parsed once.
    """
    parsed = parse_payloads(payloads, payload).where(F.col("items").isNull() | (F.size("items") > 0))
    keys = [c for c in payloads.columns if c != payload]
    rejected = F.when(F.col("items").isNull(), F.coalesce(F.col(payload), F.lit("")))
    rows = parsed.select(*keys, rejected.alias(payload), F.posexplode_outer("items").alias("pos", "item"))
    return rows.select(
        *keys,
        payload,
        F.col("pos").cast("bigint").alias("pos"),
        *[F.col(f"item.{n}").alias(n) for n in INPUT_STRINGS],
        *[F.col(f"item.{n}").cast(_number_type(n)).alias(n) for n in INPUT_NUMBERS],
    )


def read_request_batches(payloads: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """One row per element of each JSON array, and the payloads that were rejected."""
    rows = unpack_payloads(payloads, payload)
    bad = rows.where(F.col(payload).isNotNull()).select(*payloads.columns)
    return rows.where(F.col(payload).isNull()).drop(payload), bad


def normalize_requests(
    raw: DataFrame, now: Column | None = None, request_id: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Inputs as requests: new id and times, text makes the type TEXT, empty values become NULL.

    What the caller says about type, id, times, sizes or tags is ignored. `keep` names columns to
    carry along. The default id is random: write the result before it feeds two sinks.
    """
    now = F.unix_timestamp(F.current_timestamp()) if now is None else now
    request_id = F.uuid() if request_id is None else request_id
    text = _given("text")
    values = {
        "type": F.when(text.isNotNull(), F.lit("TEXT")).otherwise(F.lit("URI")),
        "request_hash": request_id,
        "created": now,
        "submitted_at": now,
    }
    columns = [*keep]
    for field in REQUEST_SCHEMA:
        if field.name in values:
            columns.append(values[field.name].cast(field.dataType).alias(field.name))
        elif field.name in ("text", "title", "uri", "submitted_by", "espeak_voice", "atempo"):
            columns.append(_field(raw, field.name, _given(field.name)))
        elif field.name == "words_per_minute":
            columns.append(_field(raw, field.name, _positive(field.name, "bigint")))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return raw.select(*columns)


def requests_from_uris(uris: DataFrame, now: Column | None = None, cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Requests for a table of URIs, with the narration settings of the job."""
    now = F.unix_timestamp(F.current_timestamp()) if now is None else now
    return uris.withColumns(
        {
            "type": F.lit("URI"),
            "atempo": F.lit(cfg.atempo),
            "words_per_minute": F.lit(cfg.words_per_minute),
            "espeak_voice": F.lit(cfg.espeak_voice),
            "submitted_with": F.lit(cfg.submitted_with),
            "submitted_at": now.cast("bigint"),
        }
    )


def classify_requests(df: DataFrame, cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Type and first title of requests that came as a bare URI; others pass unchanged."""
    bare = F.col("type") == "URI"
    stub = let(uri_title(F.col("uri")), lambda s: F.when(F.octet_length(s) > 4, drop_non_graphic(s)))
    title = cut_title(F.coalesce(F.col("title"), F.when(bare, stub)), cfg.title_limit)
    return with_computed(
        df,
        {
            "title": F.when(bare, F.nullif(title, F.lit(""))).otherwise(F.col("title")),
            "type": F.when(bare, classify(F.col("uri"))).otherwise(F.col("type")),
        },
    )


def title_from_page(df: DataFrame, cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Title of the landed page (column `page_title`) for requests that still have none."""
    page = F.when(F.octet_length(F.col("page_title")) > 3, F.col("page_title"))
    if cfg.title_limit > 0:
        page = F.when(F.octet_length(page) > cfg.title_limit, F.substring(page, 1, cfg.title_limit)).otherwise(page)
    return df.withColumn("title", F.coalesce(F.col("title"), F.nullif(drop_non_graphic(page), F.lit(""))))


def title_from_text(df: DataFrame, cfg: JobConfig = DEFAULTS) -> DataFrame:
    """First characters of the text for PDF and TEXT requests that still have no title."""
    start = F.when(
        F.col("type").isin("PDF", "TEXT"), F.nullif(F.substring(F.col("text"), 1, cfg.text_title_chars), F.lit(""))
    )
    return df.withColumn("title", F.coalesce(F.col("title"), start))


def title_of_video(df: DataFrame) -> DataFrame:
    """Titles of YOUTUBE requests without characters that cannot be shown."""
    shown = (F.col("type") == "YOUTUBE") & (F.octet_length("title") > 3)
    return df.withColumn("title", F.when(shown, drop_non_graphic(F.col("title"))).otherwise(F.col("title")))


def resolve_title(df: DataFrame, cfg: JobConfig = DEFAULTS) -> DataFrame:
    """The whole title cascade: URI, then page, then text. Classifies bare URIs on the way."""
    titled = classify_requests(df, cfg)
    if "page_title" in df.columns:
        titled = title_from_page(titled, cfg)
    return title_of_video(title_from_text(titled, cfg))


def measure_text(df: DataFrame) -> DataFrame:
    """Byte length and size of the text, where they are not set yet."""
    measured = byte_length(F.coalesce(F.col("text"), F.lit("")))
    return df.withColumns(
        {
            "length": F.coalesce(F.nullif(F.col("length"), F.lit(0)), measured),
            "size": F.coalesce(F.nullif(F.col("size"), F.lit(0)), measured),
        }
    )


def apply_defaults(df: DataFrame, cfg: JobConfig = DEFAULTS) -> DataFrame:
    """Speech rate and voice of the job where the request sets none."""
    return df.withColumns(
        {
            "words_per_minute": F.coalesce(F.nullif(F.col("words_per_minute"), F.lit(0)), F.lit(cfg.words_per_minute)),
            "espeak_voice": F.coalesce(_given("espeak_voice"), F.lit(cfg.espeak_voice)),
        }
    )


def route_requests(df: DataFrame) -> DataFrame:
    """Adds route, status and the reason of the first check that fails.

    Expects classified, titled and measured requests; a missing reason means accepted.
    """
    kind = F.col("type")
    written = kind.isin("PDF", "TEXT")
    known = F.coalesce(kind.isin("YOUTUBE", "PDF", "TEXT", "AUDIO", "VIDEO"), F.lit(False))
    reason = (
        F.when(~known, "unknown content type")
        .when(kind.isin("PDF", "VIDEO") & type_ext(kind, F.col("uri")).isNull(), "could not parse ext")
        .when(written & F.coalesce(F.col("text") == "", F.lit(True)), "no content")
        .when(written & (F.coalesce(F.col("length"), F.lit(0)) < 3), "text too short")
        .when(F.coalesce(F.length(clean_title(F.col("title"))), F.lit(0)) < 2, "title too small")
    )
    return (
        with_computed(df, {"reason": reason})
        .withColumn("route", kind)
        .withColumn("status", F.when(F.col("reason").isNull(), "ACCEPTED").otherwise("ERROR"))
        .withColumn("output_type", F.when(F.col("reason").isNull(), "AUDIO"))
    )


def list_requests(df: DataFrame, submitted_default: int | None = 0) -> DataFrame:
    """Public view of stored requests. The input form of it leaves an unset time NULL."""
    submitted = F.when(F.col("submitted_at") > 0, F.col("submitted_at"))
    if submitted_default is not None:
        submitted = F.coalesce(submitted, F.lit(submitted_default).cast("bigint"))
    view = [submitted.alias(c) if c == "submitted_at" else F.col(c) for c in PUBLIC_COLUMNS]
    return df.where(F.col("request_hash").isNotNull()).select(*view)


def _rules(df: DataFrame, type_column: str, id_column: str) -> dict[str, Column]:
    """When a row breaks each declared rule."""
    rules = {"uri_required": F.col("uri").isNull() | (F.col("uri") == "")}
    rules["type_pattern"] = F.col(type_column).isNotNull() & ~F.col(type_column).rlike(TYPE_PATTERN)
    rules["request_id_pattern"] = F.col(id_column).isNotNull() & ~F.col(id_column).rlike(REQUEST_ID_PATTERN)
    for name in UNSIGNED_COLUMNS:
        if name in df.columns:
            rules[f"{name}_unsigned"] = F.col(name) < 0
    return rules


def contract_violations(df: DataFrame, type_column: str = "type", id_column: str = "request_hash") -> DataFrame:
    """Rows that break each declared rule: (rule, n), one row per rule. One pass, no row copies."""
    rules = _rules(df, type_column, id_column)
    counts = df.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("n")) for rule in rules])
    return counts.select(F.inline(pairs))


def observe_contract(
    df: DataFrame, type_column: str = "type", id_column: str = "request_hash"
) -> tuple[DataFrame, Observation]:
    """`df`, and what `contract_violations` would say of it, counted by the first action that reads it.

    The write itself takes the counts: there is no second scan.
    """
    seen = Observation(f"contract {uuid.uuid4().hex}")
    rules = _rules(df, type_column, id_column)
    return df.observe(seen, *[F.count_if(broken).alias(rule) for rule, broken in rules.items()]), seen


def observed_violations(spark: SparkSession, seen: Observation) -> DataFrame:
    """(rule, n) of an observation whose action has run."""
    return spark.createDataFrame(list(seen.get.items()), "rule string, n long")
