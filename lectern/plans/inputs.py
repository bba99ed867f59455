"""Inputs derived from the given tables, in SQL that reads the same on other engines."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.requests import normalize_requests

REQUESTS_SQL = """
SELECT doc_id AS req_no,
 CASE doc_id % 12 WHEN 0 THEN concat('https://youtu.be/vid', doc_id)
  WHEN 1 THEN concat('https://www.youtube.com/playlist?list=', doc_id)
  WHEN 2 THEN concat('https://vimeo.com/', doc_id)
  WHEN 3 THEN concat('http://media.example.com/lecture_', doc_id, '.mp3')
  WHEN 4 THEN concat('http://media.example.com/lecture_', doc_id, '.mp3?this=is&some=parameter')
  WHEN 5 THEN concat('http://media.example.com/clip_', doc_id, '.mp4')
  WHEN 6 THEN concat('http://papers.example.org/paper_', doc_id, '.pdf')
  WHEN 7 THEN concat('http://news.example.net/a/', doc_id)
  WHEN 8 THEN concat('http://news.example.net/story-', doc_id, '.html#top')
  WHEN 9 THEN concat('http://news.example.net/inline-', doc_id)
  WHEN 10 THEN NULL
  ELSE concat('https://www.facebook.com/watch/', doc_id) END AS uri,
 CASE WHEN doc_id % 12 IN (6, 9) THEN text ELSE '' END AS text,
 CASE doc_id % 5 WHEN 0 THEN '?x' WHEN 1 THEN concat('Title: ', source, ' #', doc_id)
  WHEN 2 THEN concat('A deliberately long title that goes past the limit ', doc_id) ELSE '' END AS title,
 CASE WHEN doc_id % 25 = 0 THEN 'BOGUS' WHEN doc_id % 7 = 0 THEN NULL ELSE 'URI' END AS type_in,
 CAST(1704067200 + doc_id * 97 AS BIGINT) AS submitted_at,
 CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 200 + CAST(doc_id % 4 AS INT) * 50 END AS words_per_minute
FROM {documents}
"""

PAGE_REQUESTS_SQL = """
SELECT page_id AS req_no, url AS uri,
 CASE WHEN page_id % 3 = 0 THEN 'inline text supplied by the caller' ELSE '' END AS text,
 '' AS title, CAST(1704067200 + page_id * 97 AS BIGINT) AS submitted_at
FROM {pages}
"""

OUTLINE_SQL = """
SELECT conv_id AS doc_id, turn AS line_no,
 CASE WHEN role = 'user' THEN concat('| "Section ', turn, '" #', turn, ',0,792')
      ELSE '| (no destination)' END AS line
FROM {conversations}
"""

DOCUMENT_PAGES_SQL = """
SELECT conv_id AS doc_id, turn AS page_no, text FROM {conversations}
UNION ALL SELECT conv_id, turn + 100000, NULL FROM {conversations} WHERE turn % 5 = 4
"""

PAPER_REQUESTS_SQL = """
SELECT conv_id AS req_no, concat('http://papers.example.org/paper_', conv_id, '.pdf') AS uri,
 '' AS text, CASE WHEN conv_id % 2 = 0 THEN concat('Paper ', conv_id) ELSE '' END AS title,
 CAST(1704067200 + conv_id * 97 AS BIGINT) AS submitted_at
FROM (SELECT conv_id FROM {conversations} UNION SELECT conv_id + 1000000 FROM {conversations} WHERE conv_id % 7 = 3) AS asked
"""

PAPER_PAGES_SQL = """
SELECT concat('http://papers.example.org/paper_', conv_id, '.pdf') AS uri, turn AS page_no, text
FROM {conversations}
UNION ALL SELECT concat('http://papers.example.org/paper_', conv_id, '.pdf'), turn + 100000, NULL
FROM {conversations} WHERE turn % 5 = 4
"""

BATCHES_SQL = """
SELECT event_id AS batch_id, ts AS submitted_ts, 1 + event_id % 10 AS n_requests FROM {events}
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive(df: DataFrame, sql: str, name: str) -> DataFrame:
    return df.sparkSession.sql(sql, **{name: df})


def request_rows(documents: DataFrame) -> DataFrame:
    return derive(documents, REQUESTS_SQL, "documents")


def stable_id(req_no: Column) -> Column:
    """Id in UUID form that depends on the request only, so that results can be compared."""
    digest = F.sha2(F.concat(F.lit("request "), req_no.cast("string")), 256)
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def normalized(rows: DataFrame) -> DataFrame:
    return normalize_requests(rows, F.col("submitted_at"), stable_id(F.col("req_no")), keep=("req_no",))


def history_rows(rows: DataFrame) -> DataFrame:
    """One to three states per request, 60 seconds apart."""
    steps = F.sequence(F.lit(0), F.least(F.col("req_no") % 4, F.lit(2)).cast("int"))
    return rows.select("req_no", "submitted_at", F.explode(steps).alias("step")).select(
        "req_no",
        "step",
        F.when(F.col("step") == 0, "URI").when(F.col("step") == 1, "TEXT").otherwise("AUDIO").alias("type"),
        (F.col("submitted_at") + F.col("step") * 60).alias("created"),
    )


def lookup_rows(rows: DataFrame) -> DataFrame:
    return rows.select((F.col("req_no") * 7).alias("req_no"))


def payload_rows(rows: DataFrame) -> DataFrame:
    """Ten requests per payload, plus empty batches, unusual ones and malformed ones that must be rejected."""
    packed = (
        rows.groupBy(F.floor(F.col("req_no") / 10).alias("payload_id"))
        .agg(F.array_sort(F.collect_list(F.struct("req_no", "uri", "title", "text"))).alias("r"))
        .select(
            "payload_id", F.to_json(F.transform("r", lambda r: r.dropFields("req_no"))).alias("payload")
        )
    )
    number = F.col("req_no").cast("string")
    broken = (
        F.when(F.col("req_no") % 50 == 0, F.concat(F.lit("{not json "), number))
        .when(F.col("req_no") % 50 == 1, F.concat(F.lit('{"uri":"'), number, F.lit('"}')))
        .when(F.col("req_no") % 50 == 2, F.concat(F.lit('[{"words_per_minute":"many '), number, F.lit('"}]')))
        .when(F.col("req_no") % 50 == 3, F.lit("[]"))
        .when(F.col("req_no") % 50 == 4, F.concat(F.lit('[{"words_per_minute":50000000000'), number, F.lit("}]")))
        .when(F.col("req_no") % 50 == 5, F.concat(F.lit('[{"words_per_minute":-5'), number, F.lit("}]")))
        .when(F.col("req_no") % 50 == 6, F.concat(F.lit('[{"uri":'), number, F.lit("}]")))
        .when(F.col("req_no") % 50 == 8, F.concat(F.lit('[{"submitted_at":-5'), number, F.lit("}]")))
        .when(F.col("req_no") % 50 == 9, F.lit('[{"words_per_minute":3000000000}]'))
        .when(F.col("req_no") % 50 == 10, F.lit('[{"created":18446744073709551615}]'))
        .when(F.col("req_no") % 50 == 11, F.concat(F.lit('[{"URI":"u'), number, F.lit('"}]')))
        .when(F.col("req_no") % 50 == 7, F.concat(F.lit('[{"uri":"u","words_per_minute":"'), number, F.lit('"}]')))
    )
    odd = rows.select((-1 - F.col("req_no")).alias("payload_id"), broken.alias("payload"))
    return packed.unionByName(odd.where(F.col("payload").isNotNull()))
