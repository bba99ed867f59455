"""Content type, title stub and extension from a URI."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.binding import let

# Host fragments of video sites and the suffixes that decide a type.
VIDEO_SITES = ("youtu.be", "www.youtube.com", "facebook.com", "vimeo.com")
PLAYLIST_MARK = "playlist"
SUFFIX_TYPES = ((".mp3", "AUDIO"), (".mp4", "VIDEO"), (".pdf", "PDF"))

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"
_UNREADABLE = r"[\x00-\x1F\x7F]|%(?![0-9A-Fa-f]{2})"
_MUST_ESCAPE = r"[^A-Za-z0-9\-._~$&+,/:;=@!'()*\[\]%]"
# url_encode spelling -> spelling in a path.
_PATH_SPELLING = (
    ("+", "%20"),
    ("*", "%2A"),
    ("%7E", "~"),
    ("%24", "$"),
    ("%26", "&"),
    ("%2B", "+"),
    ("%2C", ","),
    ("%2F", "/"),
    ("%3A", ":"),
    ("%3B", ";"),
    ("%3D", "="),
    ("%40", "@"),
)


def classify(uri: Column) -> Column:
    """Content type by ordered, case-sensitive substring tests over the whole URI."""
    text = F.coalesce(uri, F.lit(""))
    on_video_site = reduce(lambda a, b: a | b, [text.contains(site) for site in VIDEO_SITES])
    rule = F.when(on_video_site & text.contains(PLAYLIST_MARK), "YOUTUBE_LIST").when(on_video_site, "YOUTUBE")
    for suffix, content_type in SUFFIX_TYPES:
        rule = rule.when(text.contains(suffix), content_type)
    return rule.otherwise("TEXT")


def _escape_path(path: Column) -> Column:
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    escaped = F.url_encode(plain)
    for found, wanted in _PATH_SPELLING:
        escaped = F.replace(escaped, F.lit(found), F.lit(wanted))
    return escaped


def uri_path(uri: Column) -> Column:
    """Escaped path of a request URI; a `#` belongs to the path. NULL if the URI is not readable."""
    with_host = _SCHEME + r"//[^/?]*"
    raw = F.when(uri.rlike(with_host), F.regexp_extract(uri, with_host + r"([^?]*)", 1)).otherwise(
        F.regexp_extract(uri, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(/[^?]*)", 1)
    )
    return F.when(uri.isNull() | uri.rlike(_UNREADABLE), F.lit(None).cast("string")).otherwise(
        let(raw, lambda path: F.when(path.rlike(_MUST_ESCAPE), _escape_path(path)).otherwise(path))
    )


def uri_title(uri: Column) -> Column:
    """Last path element with every occurrence of its extension removed."""

    def stub(path: Column) -> Column:
        base = F.regexp_extract(path, r"([^/]+)/*$", 1)
        ext = F.regexp_extract(path, r"(\.[^./]*)$", 1)
        return F.when(base != "", F.replace(base, ext, F.lit("")))

    return let(uri_path(uri), stub)


def uri_ext(uri: Column) -> Column:
    """Text after the last dot of the last path element, NULL without a dot."""
    return let(
        uri_path(uri),
        lambda path: F.when(path.rlike(r"\.[^./]*$"), F.regexp_extract(path, r"\.([^./]*)$", 1)),
    )


def uri_host(uri: Column) -> Column:
    """Lower-case host of an absolute URI, without user and port."""
    host = F.regexp_extract(uri, _SCHEME + r"//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.nullif(F.lower(host), F.lit(""))
