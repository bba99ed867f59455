"""Literal cases of the column functions."""

import hashlib
import html

import pytest

from lectern.functions import text as tx
from lectern.functions import titles, uri


@pytest.mark.parametrize(
    ("link", "wanted"),
    [
        ("http://something.com/my_podcast.mp3", "AUDIO"),
        ("http://something.com/my_podcast.mp3?this=is&some=parameter&trash=bad", "AUDIO"),
        ("https://youtu.be/abc", "YOUTUBE"),
        ("https://www.youtube.com/playlist?list=1", "YOUTUBE_LIST"),
        ("https://vimeo.com/1.mp3", "YOUTUBE"),
        ("https://m.facebook.com/x", "YOUTUBE"),
        ("https://youtube.com/watch", "TEXT"),
        ("http://a.b/c.MP3", "TEXT"),
        ("http://a.b/c.mp4.pdf", "VIDEO"),
        ("http://a.b/c.pdf", "PDF"),
        ("", "TEXT"),
        (None, "TEXT"),
    ],
)
def test_classify(one, link, wanted):
    assert one(uri.classify, link) == wanted


@pytest.mark.parametrize(
    ("link", "stub", "ext"),
    [
        ("http://somedomain.com/somefile.txt", "somefile", "txt"),
        ("http://anotherdomain.com/hot_new_lecture.mp3", "hot_new_lecture", "mp3"),
        ("https://ia601407.us.archive.org/32/items/videoplayback_20191122_2202/videoplayback.mp4", "videoplayback", "mp4"),
        ("http://h.com/371#top", "371%23top", None),
        ("http://h.com/story.html#top", "story", "html%23top"),
        ("http://h.com/a.b.a.b", "a.a", "b"),
        ("http://h.com/x.txt.txt", "x", "txt"),
        ("http://h.com/dir.d/", "dir.d", None),
        ("http://h.com/name.", "name", ""),
        ("http://h.com", None, None),
        ("http://h.com/", None, None),
        ("http://h.com?q=/x.mp3", None, None),
        ("http://h.com/p?q=/x.mp3", "p", None),
        ("/local/file.pdf", "file", "pdf"),
        ("relative/file.pdf", None, None),
        ("mailto:someone@h.com", None, None),
        ("http://h.com/été.txt", "%C3%A9t%C3%A9", "txt"),
        ("http://h.com/a b+c~d.txt", "a%20b+c~d", "txt"),
        ("http://h.com/100%25.txt", "100%25", "txt"),
        ("http://h.com/100%.txt", None, None),
        ("http://h.com/a(1).txt", "a(1)", "txt"),
        (None, None, None),
    ],
)
def test_title_and_extension(one, link, stub, ext):
    assert one(uri.uri_title, link) == stub
    assert one(uri.uri_ext, link) == ext


def test_host(one):
    assert one(uri.uri_host, "https://me@News.Example.com:8080/x") == "news.example.com"
    assert one(uri.uri_host, "/x") is None


@pytest.mark.parametrize(
    ("title", "wanted"),
    [("test title", "test_title"), ("?x", "x"), ("é–!", ""), ("a-b_c 1", "a-b_c_1"), ("tab\there", "tabhere")],
)
def test_clean_title(one, title, wanted):
    assert one(titles.clean_title, title) == wanted
    assert one(titles.has_content, title) is (wanted != "")


def test_has_content_of_nothing(one):
    assert one(titles.has_content, None) is False


@pytest.mark.parametrize(
    ("kind", "title", "path"),
    [
        ("TEXT", "test_title", "TEXT/1982/02/26/test_title.txt"),
        ("AUDIO", "test_title", "AUDIO/1982/02/26/test_title.mp3"),
        ("URI", "test title", "URI/1982/02/26/test_title.uri"),
        ("PDF", "test_title", "PDF/1982/02/26/test_title.pdf"),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_paths(spark, one, kind, title, path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        item = (kind, "http://h.com/x.pdf", title, 383576400)
        assert one(titles.work_path, *item) == path
        assert one(titles.storage_path, *item) == path
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_paths_refused(one):
    assert one(titles.work_path, "AUDIO", "http://h.com/x", "?x", 0) == "AUDIO/1970/01/01/x.mp3"
    assert one(titles.storage_path, "AUDIO", "http://h.com/x", "?x", 0) is None
    assert one(titles.storage_path, "VIDEO", "http://h.com/x", "long", 0) is None


@pytest.mark.parametrize(
    "raw",
    ["a &amp; b", "&lt;&gt;&quot;&#39;", "&amp;lt;", "&copy;&middot;&nbsp;&eacute;&hellip;", "&#233;&#xE9;&#X1F600;",
     "AT&T & co", "&unknown;", "&", "&&amp;&", "no entities", "&apos;", "&#65;&#066;",
     "&#128;&#150;&#x92;&#159;&#160;"],
)
def test_unescape(one, raw):
    assert one(tx.unescape_entities, raw) == html.unescape(raw)


def test_unescape_keeps_control_characters(one):
    assert one(tx.unescape_entities, "&#127;x&#x81;") == "\x7fx\x81"


@pytest.mark.parametrize("raw", ["&#0;", "&#xD800;", "&#x110000;", "&#99999999999999999999999;", "&#xFFFFFFFFFFFFFFFFF;"])
def test_unescape_invalid_number(one, raw):
    assert one(tx.unescape_entities, raw) == "�"


def test_trim(one):
    assert one(tx.trim_space, "  \t\r\n x y　\x85") == "x y"


def test_measures(one):
    assert one(tx.byte_length, "é") == 2
    assert one(tx.word_count, " one\ttwo\nthree  four ") == 4
    assert one(tx.word_count, None) == 0
    assert one(tx.fingerprint, "abc") == hashlib.sha256(b"abc").hexdigest()


def test_tokens(one):
    assert one(tx.tokens, "Élan-vital, 42x élan!") == ["élan", "vital", "42x", "élan"]
    assert one(tx.tokens, "...") == []


def test_term_counts(one):
    counts = one(tx.term_counts, "b a B c a b")
    assert [tuple(c) for c in counts] == [("a", 2), ("b", 3), ("c", 1)]
    assert not one(tx.term_counts, "...")


def test_cut_title(one):
    assert one(lambda t: titles.cut_title(t, 4), "abcdef") == "abcd"
    assert one(lambda t: titles.cut_title(t, 4), "ab​c") == "ab​c"[:4].replace("​", "")
    assert one(lambda t: titles.cut_title(t, 4), "éé") == "éé"
    assert one(titles.drop_non_graphic, "a\x00b​c d") == "abc d"
