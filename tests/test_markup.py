"""Markup to text: hand-made cases and a tag-by-tag parser on generated pages."""

from __future__ import annotations

import html
import random
import re
from html.parser import HTMLParser

from pyspark.sql import functions as F

from panelloom.functions import text as tx


class _Texts(HTMLParser):
    """Text nodes outside dropped elements, joined by one space."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.dropped: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript"):
            self.dropped.append(tag)

    def handle_endtag(self, tag):
        if self.dropped and self.dropped[-1] == tag:
            self.dropped.pop()

    def handle_data(self, data):
        if not self.dropped:
            self.parts.append(data)


def parsed(page: str) -> str:
    parser = _Texts()
    parser.feed(page)
    parser.close()
    return re.sub(r"\s+", " ", html.unescape(" ".join(parser.parts))).strip()


def texts(spark, pages, function):
    rows = [(i, page) for i, page in enumerate(pages)]
    df = function(spark.createDataFrame(rows, "id int, page string"), "page", "out")
    return [row.out for row in df.orderBy("id").collect()]


def test_html_cases(spark):
    cases = {
        "<p>one</p><p>two</p>": "one two",
        "a<!-- hidden <b> -->b": "a b",
        "<title>t</title><body>x": "t x",
        "<script>if (a < b) {'</p>'}</script>x": "x",
        "<SCRIPT type='a>b'>x</Script >y": "y",
        "x<style>p{}</style>y<noscript>no <b>js</b></noscript>z": "x y z",
        "kept<script>never closed <p>text</p>": "kept",
        '<a title="1 > 0">link</a>': "link",
        "<p title='it>s'>q</p>": "q",
        "<p don't>x</p>": "x",
        "3 < 4 and 5 > 2": "3 < 4 and 5 > 2",
        "&amp;lt;tag&amp;gt;": "<tag>",
        "&lt;b&gt;bold&lt;/b&gt;": "<b>bold</b>",
        "&eacute;&#233;&#xe9;&notit;": "ééé¬it;",
        "a&nbsp;&nbsp;b&#160;c": "a b c",
        "fish &chips & &; &#; &unknown;": "fish &chips & &; &#; &unknown;",
        "&AMP;&ampx;&copy2": "&&x;©2",
        "<!DOCTYPE html><?xml version='1'?><![CDATA[x]]>y": "y",
        "<template>no <b>text</b></template>x": "x",
        "<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>字": "漢 字",
        "<ruby>a<rt>one<rp>two</ruby>b <rtc>c</rtc>": "a b c",
        "scripts <scripty>stay</scripty>": "scripts stay",
        "": "",
    }
    assert texts(spark, list(cases), tx.with_html_text) == list(cases.values())


def test_fast_route_keeps_script_content(spark):
    cases = {
        "<b>x</b><script>var a;</script>": "x var a;",
        "&amp;lt;": "&lt;",
        "a <!-- c --> b": "a b",
        "1 < 2 > 3": "1 3",
        "&Eacute;t&eacute;": "Été",
    }
    assert texts(spark, list(cases), tx.with_stripped_text) == list(cases.values())


def test_generated_pages_match_a_parser(spark):
    rng = random.Random(3)
    words = ["alpha", "b&amp;c", "&copy;", "&eacute;", "d  e", "\n", "é", "&#8217;", "&amp;amp;"]
    tags = ["p", "div", "b", "td", "h1"]

    def node(depth):
        kind = rng.randrange(7)
        if depth == 0 or kind < 3:
            return " ".join(rng.choice(words) for _ in range(rng.randrange(4)))
        if kind == 3:
            return f"<!-- {rng.choice(words)} <p> -->"
        if kind == 4:
            return f"<script>var x = '<{rng.choice(tags)}>';</script>"
        inner = "".join(node(depth - 1) for _ in range(rng.randrange(4)))
        tag = rng.choice(tags)
        return f'<{tag} class="a > b">{inner}</{tag}>'

    pages = ["<html>" + "".join(node(4) for _ in range(5)) + "</html>" for _ in range(300)]
    assert texts(spark, pages, tx.with_html_text) == [parsed(page) for page in pages]


def test_bytes_are_decoded_and_routed(spark):
    # The same page is read by the same rules at any size.
    large = b"<html><script>gone</script>" + b"<p>word</p>" * 60_000
    contents = [
        "<html>café<script>x</script></html>".encode(),
        "<HTML>café</HTML>".encode("latin-1"),
        b"<x>plain</x><script>kept</script>",
        b"<DIV>in</DIV><style>out</style>",
        large,
        b"",
        None,
    ]
    df = spark.createDataFrame(
        [(i, bytearray(c) if c is not None else None) for i, c in enumerate(contents)],
        "id int, content binary",
    )
    out = [r.text for r in tx.with_filing_text(df, "content").orderBy("id").collect()]
    assert out[:4] == ["café", "café", "plain kept", "in"]
    assert out[4] == " ".join(["word"] * 60_000)
    assert out[5:] == ["", None]


def test_long_texts_do_not_overflow(spark):
    pages = [
        "<p " + "a='1' " * 50_000 + ">x</p>",
        "<p " + "'" * 100_001 + ">y</p>",
        "<!--" + "-" * 200_000 + "-->z",
        "<" * 100_000,
    ]
    assert texts(spark, pages, tx.with_html_text) == ["x", "y", "z", "<" * 100_000]


def test_only_rare_entities_reach_python(spark):
    df = spark.createDataFrame([("a &amp; b",)], "page string")
    decoded = tx.with_unescaped(df, "page", F.lit(False))
    assert decoded.first().page == "a & b"
    assert decoded.columns == ["page"]
