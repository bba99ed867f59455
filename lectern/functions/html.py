"""Title and text blocks of a page of HTML, computed inside the row."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.binding import let
from lectern.functions.text import trim_space, unescape_entities

# Text behind these start tags is not content.
NOT_CONTENT = ("script", "style", "meta", "link")

# One token per match. Every repetition is possessive or over single characters, so a long page
# neither backtracks nor deepens the stack; an unclosed comment, script or tag runs to the end.
TOKEN = "|".join(
    [
        r"(?is)<!--.*?(?:-->|\z)",
        r"<script\b.*?(?:</script\b[^>]*+>|\z)",
        r"<style\b.*?(?:</style\b[^>]*+>|\z)",
        r"""<[a-z](?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>""",
        r"<[a-z!?/][^>]*+>?+",
        r"(?:[^<]++|<(?![a-z!?/]))++",
    ]
)
_START_TAG = r"^<([a-zA-Z][a-zA-Z0-9]*)"
_MARKUP = r"^<[a-zA-Z!?/]"


def page_title(html: Column) -> Column:
    """Text of the first title element."""
    title = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title", 1)
    return F.nullif(unescape_entities(title), F.lit(""))


def text_blocks(html: Column) -> Column:
    """Text tokens in page order with the most recent start tag: array<struct<pos, tag, text>>.

    The tokens are cut at the start tags; each stretch up to the next start tag then carries its
    tag. End tags and self-closing tags do not open a stretch.
    """

    def stretches(page: Column) -> Column:
        marks = F.transform(
            page,
            lambda token, i: F.struct(
                i.alias("at"),
                F.when(~token.endswith("/>"), F.lower(F.regexp_extract(token, _START_TAG, 1))).alias("tag"),
            ),
        )
        opening = F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("tag"))
        starts = F.concat(F.array(opening), F.filter(marks, lambda m: m["tag"] != ""))
        return let(starts, lambda s: F.flatten(F.transform(s, lambda mark, k: _stretch(page, s, mark, k))))

    return let(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), stretches)


def _stretch(page: Column, starts: Column, mark: Column, k: Column) -> Column:
    end = F.coalesce(F.get(starts, k + 1)["at"], F.size(page))
    inner = F.slice(page, mark["at"] + 2, end - mark["at"] - 1)
    blocks = F.transform(
        inner,
        lambda token, j: F.struct(
            (mark["at"] + 1 + j).cast("bigint").alias("pos"), mark["tag"].alias("tag"), token.alias("text")
        ),
    )
    return F.filter(blocks, lambda b: ~b["text"].rlike(_MARKUP))


def content_blocks(html: Column, min_block: int) -> Column:
    """Unescaped, trimmed text blocks that are content and longer than `min_block` bytes."""
    kept = F.filter(text_blocks(html), lambda b: ~F.coalesce(b["tag"], F.lit("")).isin(*NOT_CONTENT))
    texts = F.transform(kept, lambda b: trim_space(unescape_entities(b["text"])))
    return F.filter(texts, lambda t: F.octet_length(t) > min_block)
