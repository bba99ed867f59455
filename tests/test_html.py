"""Text blocks against literal pages and a brute-force reader of generated ones."""

import random
import re

import pytest

from lectern.config import JobConfig
from lectern.functions import html
from lectern.operators.extract import assemble_pages, extract_text, html_blocks


def blocks(one, page):
    return [(b["tag"], b["text"]) for b in one(html.text_blocks, page) or []]


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ("plain", [(None, "plain")]),
        ("<p>a</p>b", [("p", "a"), ("p", "b")]),
        ("<p>a<br/>b<BR>c", [("p", "a"), ("p", "b"), ("br", "c")]),
        ("<p>a<!-- <b> -->c", [("p", "a"), ("p", "c")]),
        ("<script>if (a < b) x('</p>')</script>after<p>in", [("script", "after"), ("p", "in")]),
        ("<style>p{}</style> <i>x", [("style", " "), ("i", "x")]),
        ("<!DOCTYPE html><html>x", [("html", "x")]),
        ("<p>1 < 2 and 3 <4</p>", [("p", "1 < 2 and 3 <4")]),
        ("<a title='x > y' href=\"<b>\">t", [("a", "t")]),
        ("<a it's>t's", [("a", "t's")]),
        ("<p>open <!-- never closed <b>x", [("p", "open ")]),
        ("<p>a<script>never closed <b>x", [("p", "a")]),
        ("<p>a<b", [("p", "a")]),
        ("", []),
        (None, []),
    ],
)
def test_blocks(one, page, wanted):
    assert blocks(one, page) == wanted


def test_many_stray_marks_and_long_pages(one):
    stray = "x < " * 20_000
    assert blocks(one, "<p>" + stray) == [("p", stray)]
    page = "<p>" + "word <b>bold</b> " * 20_000
    assert len(blocks(one, page)) == 40_001
    assert blocks(one, "<!--" * 20_000) == []


def read_page(page):
    """Reads a page of known parts one by one, remembering the last start tag."""
    last, found = None, []
    for part in page:
        if part.startswith("</") or part.startswith("<!"):
            continue
        if part.startswith("<"):
            if not part.endswith("/>"):
                last = re.match(r"<(\w+)", part).group(1).lower()
        else:
            found.append((last, part))
    return found


def random_page(rng):
    markup = ["<p>", "</p>", "<br/>", "<B class='x>y'>", "<!-- <p>c</p> -->", "<script>var a = '<p>';</script>",
              "<style>b</style>", "<meta charset=u>", "<link rel=x>", "<td>", "</td>", "<!DOCTYPE x>"]
    parts = []
    for _ in range(rng.randrange(60)):
        if parts and not parts[-1].startswith("<") or rng.random() < 0.6:
            parts.append(rng.choice(markup))
        else:
            parts.append("".join(rng.choice("abé &;\n ") for _ in range(rng.randrange(1, 160))) or "x")
    return parts


def test_generated_pages(spark):
    rng = random.Random(7)
    pages = [random_page(rng) for _ in range(200)]
    df = spark.createDataFrame([(i, "".join(p)) for i, p in enumerate(pages)], "page_id bigint, html string")
    got = {}
    for row in html_blocks(df).orderBy("page_id", "pos").collect():
        got.setdefault(row["page_id"], []).append((row["tag"], row["text"]))
    assert got == {i: read_page(p) for i, p in enumerate(pages) if read_page(p)}

    cfg = JobConfig(min_text_block=30)
    texts = {r["page_id"]: (r["text"], r["size"], r["n_blocks"]) for r in extract_text(df, cfg=cfg).collect()}
    for i, page in enumerate(pages):
        kept = [t.strip() for tag, t in read_page(page) if tag not in ("script", "style", "meta", "link")]
        kept = [t for t in kept if len(t.encode()) > 30]
        assert texts[i] == ("".join(kept), len("".join(kept).encode()), len(kept))


def test_min_block_is_exclusive(spark):
    df = spark.createDataFrame([(1, "<p>" + "a" * 100 + "<p>" + "b" * 101 + "<p> é" + "c" * 99)], "page_id int, html string")
    assert extract_text(df).first()["text"] == "b" * 101 + "é" + "c" * 99
    plain = spark.createDataFrame([(1, "just a line of text\n")], "page_id int, html string")
    assert extract_text(plain, cfg=JobConfig(min_text_block=0)).first()["text"] == "just a line of text"


def test_page_title(one):
    assert one(html.page_title, "<TITLE lang=x>Q &amp; A\n</title><title>no</title>") == "Q & A\n"
    assert one(html.page_title, "<p>none") is None


def test_assembled_documents_hold_every_page_once(spark):
    rng = random.Random(3)
    pages = [(9, n, "x" if n % 3 else None) for n in range(30_000)]
    pages += [(d, n, None if rng.random() < 0.1 else f"[{d}:{n}]") for d in range(5) for n in range(1, 60 * d + 2)]
    shuffled = rng.sample(pages, len(pages))
    df = spark.createDataFrame(shuffled, "doc_id int, page_no int, text string")
    rows = {r["doc_id"]: (r["n_pages"], r["text"]) for r in assemble_pages(df).collect()}
    for doc in (0, 1, 2, 3, 4, 9):
        texts = [t for d, n, t in pages if d == doc and t is not None]
        assert rows[doc] == (len(texts), "".join(texts))
