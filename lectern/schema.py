"""Column layouts shared by the operators."""

from pyspark.sql import types as T

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("request_hash", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("created", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("uri", T.StringType()),
        T.StructField("submitted_by", T.StringType()),
        T.StructField("submitted_at", T.LongType()),
        T.StructField("number_of_conversions", T.LongType()),
        T.StructField("download_uri", T.StringType()),
        T.StructField("words_per_minute", T.LongType()),
        T.StructField("espeak_voice", T.StringType()),
        T.StructField("atempo", T.StringType()),
        T.StructField("submitted_with", T.StringType()),
        T.StructField("storage_path", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

# Columns of the public view of a request; voice, submitter and path stay private.
PUBLIC_COLUMNS = (
    "uri",
    "request_hash",
    "title",
    "atempo",
    "words_per_minute",
    "length",
    "size",
    "text",
    "number_of_conversions",
    "type",
    "created",
    "submitted_at",
)

# Numbers a caller may send, with the least and the largest that their field takes.
INPUT_NUMBERS = {
    "created": (0, 2**64 - 1),
    "size": (0, 2**64 - 1),
    "length": (0, 2**64 - 1),
    "submitted_at": (-(2**63), 2**63 - 1),
    "number_of_conversions": (0, 2**32 - 1),
    "words_per_minute": (0, 2**32 - 1),
}
INPUT_STRINGS = (
    "uri",
    "type",
    "request_hash",
    "text",
    "title",
    "submitted_by",
    "download_uri",
    "espeak_voice",
    "atempo",
    "submitted_with",
    "storage_path",
)
