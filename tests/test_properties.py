"""Generated texts and URIs against plain Python, many cases per Spark job."""

import hashlib
import random
import string
from collections import Counter
from urllib.parse import urlsplit

import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.functions import titles, uri
from lectern.operators.keywords import document_frequency, term_frequency

# Letters whose lower case is the same everywhere, digits of several scripts, marks, symbols, emoji.
LETTERS = "abzéñßøжяλ中文ابक०٣9·ª²́_-'’–.,!?;&<>\t\n  　😀𝒳"
texts = st.lists(st.text(alphabet=LETTERS, max_size=60), min_size=1, max_size=40)


def words(text):
    return regex.findall(r"[\p{L}\p{N}]+", text.lower())


@settings(max_examples=6, deadline=None, derandomize=True)
@given(texts)
def test_terms_of_any_text(spark, values):
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")
    tf = {(r["doc_id"], r["term"]): r["tf"] for r in term_frequency(docs).collect()}
    assert tf == {(i, t): n for i, v in enumerate(values) for t, n in Counter(words(v)).items()}
    df = {r["term"]: r["df"] for r in document_frequency(docs).collect()}
    assert df == Counter(t for v in values for t in set(words(v)))


@settings(max_examples=6, deadline=None, derandomize=True)
@given(texts)
def test_measures_of_any_text(spark, values):
    text = F.col("text")
    row = spark.createDataFrame(list(enumerate(values)), "i int, text string").select(
        "i",
        tx.byte_length(text).alias("bytes"),
        tx.fingerprint(text).alias("print"),
        tx.trim_space(text).alias("trimmed"),
        tx.word_count(text).alias("words"),
        titles.clean_title(text).alias("clean"),
        titles.drop_non_graphic(text).alias("shown"),
    )
    for r in row.collect():
        value = values[r["i"]]
        assert r["bytes"] == len(value.encode())
        assert r["print"] == hashlib.sha256(value.encode()).hexdigest()
        assert r["trimmed"] == value.strip()
        assert r["words"] == len(regex.findall(r"[^ \t\n\r\f]+", value))
        assert r["clean"] == regex.sub(r"[^a-zA-Z0-9\-_]", "", value.replace(" ", "_"))
        assert r["shown"] == regex.sub(r"[^\p{L}\p{M}\p{N}\p{P}\p{S}\p{Zs}]", "", value)


def test_uris(spark):
    rng = random.Random(2)
    names = ["a", "file", "talk.mp3", "x.tar.gz", "b%20c.pdf", "v.mp4", "no-dot_", "~u", "playlist"]
    hosts = ["h.com", "youtu.be", "www.youtube.com", "m.facebook.com", "vimeo.com", "Example.ORG:81"]
    cases = []
    for _ in range(400):
        path = "".join("/" + rng.choice(names) for _ in range(rng.randrange(4))) + rng.choice(["", "", "/"])
        query = rng.choice(["", "?q=1", "?f=x.mp3&l=playlist", "?a=/b.pdf"])
        scheme = "".join(rng.choice(string.ascii_lowercase) for _ in range(4))
        cases.append(f"{scheme}://{rng.choice(hosts)}{path}{query}")
    link = F.col("u")
    out = spark.createDataFrame([(c,) for c in cases], "u string").select(
        "u", uri.classify(link).alias("c"), uri.uri_title(link).alias("t"), uri.uri_ext(link).alias("e"),
        uri.uri_host(link).alias("h"),
    )
    for r in out.collect():
        parts = urlsplit(r["u"])
        last = parts.path.rsplit("/", 1)[-1]
        dot = last[last.rindex(".") :] if "." in last else ""
        base = parts.path.rstrip("/").rsplit("/", 1)[-1]
        assert r["t"] == ((base.replace(dot, "") if dot else base) if base else None)
        assert r["e"] == (dot[1:] if dot else None)
        assert r["h"] == parts.hostname
        video = any(site in r["u"] for site in ("youtu.be", "www.youtube.com", "facebook.com", "vimeo.com"))
        suffix = [kind for s, kind in ((".mp3", "AUDIO"), (".mp4", "VIDEO"), (".pdf", "PDF")) if s in r["u"]]
        wanted = ("YOUTUBE_LIST" if "playlist" in r["u"] else "YOUTUBE") if video else (suffix or ["TEXT"])[0]
        assert r["c"] == wanted
