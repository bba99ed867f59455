"""Titles, file names and storage paths."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.binding import let
from lectern.functions.uri import uri_ext

# Characters a file name loses, and extensions by type.
NOT_IN_FILE_NAME = r"[^a-zA-Z0-9\-_]+"
TYPE_EXTENSIONS = (("URI", "uri"), ("AUDIO", "mp3"), ("TEXT", "txt"))

NON_GRAPHIC = r"[^\p{L}\p{M}\p{N}\p{P}\p{S}\p{Zs}]"


def clean_title(title: Column) -> Column:
    """Title as a file name: spaces become underscores, other special characters go."""
    return F.regexp_replace(F.replace(title, F.lit(" "), F.lit("_")), NOT_IN_FILE_NAME, "")


def has_content(title: Column) -> Column:
    """True if anything is left of a cleaned title."""
    return F.coalesce(F.length(clean_title(title)) > 0, F.lit(False))


def drop_non_graphic(text: Column) -> Column:
    """Text without control, format and unassigned characters."""
    return F.regexp_replace(text, NON_GRAPHIC, "")


def cut_title(title: Column, limit: int) -> Column:
    """Title cut to `limit` code points if it is longer than `limit` bytes."""
    return let(
        title,
        lambda t: F.when(F.octet_length(t) > limit, drop_non_graphic(F.substring(t, 1, limit))).otherwise(t),
    )


def type_ext(content_type: Column, uri: Column) -> Column:
    """File extension: by type, or by the URI for types without one of their own."""
    (first, ext), *rest = TYPE_EXTENSIONS
    rule = F.when(content_type == first, ext)
    for name, value in rest:
        rule = rule.when(content_type == name, value)
    return rule.otherwise(uri_ext(uri))


def created_date(created: Column) -> Column:
    """UTC date of an epoch second, whatever the session time zone; NULL outside the years 1 to 9999."""
    days = F.when(created.between(-62_135_596_800, 253_402_300_799), F.floor(created / F.lit(86400)))
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def work_path(content_type: Column, uri: Column, title: Column, created: Column) -> Column:
    """TYPE/yyyy/MM/dd/<clean title>.<ext>; NULL without an extension."""
    folder = F.concat(content_type, F.lit("/"), F.date_format(created_date(created), "yyyy/MM/dd"), F.lit("/"))
    return F.concat(folder, F.coalesce(clean_title(title), F.lit("")), F.lit("."), type_ext(content_type, uri))


def storage_path(content_type: Column, uri: Column, title: Column, created: Column) -> Column:
    """Work path, refused (NULL) when the clean title has fewer than two characters."""
    return let(
        clean_title(title),
        lambda name: F.when(F.length(name) >= 2, work_path(content_type, uri, name, created)),
    )
