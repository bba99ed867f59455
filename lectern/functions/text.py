"""Text measures, tokens, fingerprints and entities."""

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.binding import let

# Characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_ENTITY_PARTS = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);|[^&]+|&"
_NAMED = json.dumps({name: chr(point) for name, point in name2codepoint.items()} | {"apos": "'"})
# Numbers 128 to 159 mean the characters of the Windows code page, where it has one.
_WINDOWS = json.dumps({n: c for n in range(0x80, 0xA0) if (c := bytes([n]).decode("cp1252", "ignore"))})


def fingerprint(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the text."""
    return F.sha2(text, 256)


def byte_length(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def word_count(text: Column) -> Column:
    """Number of runs of anything but white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f]+")), F.lit(0)).cast("bigint")


def trim_space(text: Column) -> Column:
    """Text without leading and trailing Unicode white space."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def _code_point(number: Column) -> Column:
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    point = F.when(valid, number).otherwise(F.lit(0xFFFD))
    character = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    windows = F.try_element_at(F.from_json(F.lit(_WINDOWS), "map<string,string>"), number.cast("string"))
    return F.when((number >= 0x80) & (number < 0xA0), F.coalesce(windows, character)).otherwise(character)


def _decode_part(part: Column) -> Column:
    name = F.substring_index(F.substring(part, 2, 64), ";", 1)
    digits = F.regexp_extract(part, "^&#0*([0-9]{1,18});$", 1).try_cast("bigint")
    hexadecimal = F.conv(F.regexp_extract(part, "^&#[xX]0*([0-9a-fA-F]{1,8});$", 1), 16, 10).cast("bigint")
    names = F.from_json(F.lit(_NAMED), "map<string,string>")
    return (
        F.when(~part.startswith("&") | (part == "&"), part)
        .when(part == "&amp;", "&")
        .when(part == "&lt;", "<")
        .when(part == "&gt;", ">")
        .when(part == "&quot;", '"')
        .when(part.rlike("^&#[xX]"), _code_point(F.coalesce(hexadecimal, F.lit(0))))
        .when(part.startswith("&#"), _code_point(F.coalesce(digits, F.lit(0))))
        .otherwise(F.coalesce(F.try_element_at(names, name), part))
    )


def unescape_entities(text: Column) -> Column:
    """Text with its character references replaced, in one pass."""
    decoded = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_ENTITY_PARTS), F.lit(0)), _decode_part), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def term_counts(text: Column) -> Column:
    """Distinct terms of a text with their counts, as array<struct<term, tf>>.

    Counted inside the row (sort, then measure the runs), so that no word is shuffled for it.
    """

    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - 1)
        first = F.filter(places, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
        return F.when(
            F.size(words) > 0,
            let(
                first,
                lambda starts: F.transform(
                    starts,
                    lambda at, k: F.struct(
                        F.get(words, at).alias("term"),
                        (F.coalesce(F.get(starts, k + 1), F.size(words)) - at).cast("bigint").alias("tf"),
                    ),
                ),
            ),
        )

    return let(F.sort_array(tokens(text)), runs)
