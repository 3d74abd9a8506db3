import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from quizloom.functions import html
from quizloom.operators import links, manifest

URL = "https://exams.example.org/home?key=1"


def found(spark, page, needle=".pdf"):
    pages = spark.createDataFrame([(1, URL, page)], "page_id long, url string, html string")
    rows = links.link_rows(links.with_links(pages, needle)).orderBy("pos").collect()
    return [(r.text, r.href) for r in rows]


@pytest.mark.parametrize(
    "page, expected",
    [
        ('<a href="/a.pdf">A</a><a href="/b.html">B</a>', [("A", "/a.pdf")]),
        ('<A class=x HREF="/A.PDF" target=y>A</A >', [("A", "/A.PDF")]),
        ("<a href='/a.pdf?x=1'> A </a>", [("A", "/a.pdf?x=1")]),
        ("<a href=/a.pdf>A</a>", [("A", "/a.pdf")]),
        ('<a href="/a.pdf">x<b>y</b><i><u>z</u></i></a>', [("x y z", "/a.pdf")]),
        ('<a href="/a.pdf">x<a href="/b.pdf">y</a>', [("y", "/b.pdf")]),
        ('<a href="/a.pdf">x<a href="/b.html">y</a>', [("x y", "/a.pdf")]),
        ('<a href="/b.html">x<a href="/a.pdf">y</a>', [("y", "/a.pdf")]),
        ('<a href="/a.pdf">x', []),
        ('<a href="/a.pdf"></a>', [("", "/a.pdf")]),
        ('<!-- <a href="/a.pdf">x</a> --><a href="/b.pdf">y</a>', [("y", "/b.pdf")]),
        ('<a data-href="/a.pdf">x</a><abbr href="/b.pdf">y</abbr>', []),
        ('<a href="/a.pdf?x=1&amp;y=2">P&aacute;dr&#227;o &#x26; &unknown; &amp;amp;</a>', [("Pádrão & &unknown; &amp;", "/a.pdf?x=1&y=2")]),
        ('<a title="a>b" href="c.pdf">z</a>', [("z", "c.pdf")]),
        ("<a title='>' href=c.pdf x=\">\">z</a>", [("z", "c.pdf")]),
        ('<a href="a.html" href="b.pdf">z</a><a href="b.pdf" HREF=a.html>y</a>', [("z", "b.pdf")]),
        ('<script>"<a href=a.pdf>x</a>"</script><style><a href=b.pdf></a></style><a href=c.pdf>z</a>', [("z", "c.pdf")]),
        ('<a href=a.pdf>x<script>1 < 2 &amp;</script>y<!-- > </a> -->z</a>', [("x 1 < 2 &amp; y z", "a.pdf")]),
        ('<a href="a.pdf"/>x</a><a href=b.pdf/>y</a><a href=c.pdf>z<a name=w />', [("", "a.pdf"), ("y", "b.pdf/"), ("z", "c.pdf")]),
        ("<a href>x</a><a href=>y</a>< a href=b.pdf>z</a><a href=c.pdf", []),
        ('<a href="a&amp;b.pdf">1 < 2</a>', [("1  <  2", "a&b.pdf")]),
        ("no links", []),
        ("", []),
    ],
)
def test_links(spark, page, expected):
    assert found(spark, page) == expected


class Plain(HTMLParser):
    """Links by Python's own parser."""

    def __init__(self):
        super().__init__()
        self.links, self.href, self.text = [], None, []

    def handle_starttag(self, tag, attrs):
        href = dict(attrs).get("href") if tag == "a" else None
        if href and ".pdf" in href.lower():
            self.href, self.text = href, []

    def handle_data(self, data):
        self.text.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            self.links.append((" ".join(self.text).strip(), self.href))
            self.href = None


def markup(random_):
    quoted = lambda x: random_.choice([f'"{x}"', f"'{x}'"])
    attribute = lambda: random_.choice(
        [
            f"href={quoted(random_.choice(['a.pdf', 'b.PDF?x=1&amp;y', 'c.html', '>.pdf', ' d.pdf ']))}",
            f"href={random_.choice(['e.pdf', 'f.html', 'g.pdf/'])}",
            f"HREF = {quoted('h.pdf')}",
            f"title={quoted('a > b <i>')}",
            f"data-href={quoted('x.pdf')}",
            "disabled",
            "class=x",
        ]
    )
    gap = lambda: random_.choice([" ", "\n", "  ", "\t"])
    opening = lambda tag: f"<{tag}" + "".join(gap() + attribute() for _ in range(random_.randrange(4))) + random_.choice(["", " ", " /"]) + ">"  # noqa: E731, E501
    pieces = [
        lambda: opening(random_.choice(["a", "A", "a", "abbr", "b"])),
        lambda: random_.choice(["</a>", "</A>", "</a >", "</abbr>", "</b>"]),
        lambda: "<!-- " + opening("a") + random_.choice(["</a>", ">", "--"]) + " -->",
        lambda: random_.choice(["<script>", '<script type="x>y">']) + opening("a") + " 1 < 2 &amp; </a></script>",
        lambda: "<style>" + opening("a") + "</style >",
        lambda: random_.choice(["<!DOCTYPE html>", "<?php a ?>", "text", "two words", "&amp;", "1 < 2", "\n", "&eacute;!"]),
    ]
    return "".join(random_.choice(pieces)() for _ in range(random_.randrange(1, 14)))


def test_random_markup_equals_the_parser(spark):
    random_ = random.Random(12)
    pages = [markup(random_) for _ in range(1500)]
    frame = spark.createDataFrame(list(enumerate(pages)), "n int, html string")
    got = frame.select("n", html.links(F.col("html")).alias("links")).collect()
    for n, found_links in got:
        plain = Plain()
        plain.feed(pages[n])
        assert [(r.text, r.href) for r in found_links] == plain.links, pages[n]


def test_long_tags_and_pages(spark):
    attributes = " ".join(f'x{i}="a > {i}"' for i in range(20_000))
    page = f'<a {attributes} href="a.pdf">z</a>' + "<!--" + "x" * 500_000 + "-->" + "<b>" * 3000 + anchors(("t", "b.pdf"))
    assert found(spark, page) == [("z", "a.pdf"), ("t", "b.pdf")]


def test_order_and_any_href(spark):
    page = "".join(f'<a href="/{n}.html">t{n}</a>\n' for n in range(30))
    assert found(spark, page, "") == [(f"t{n}", f"/{n}.html") for n in range(30)]


@pytest.mark.parametrize(
    "href, url",
    [
        ("http://x.org/a.pdf", "http://x.org/a.pdf"),
        ("https://x.org/a.pdf", "https://x.org/a.pdf"),
        ("/arq/a.pdf", "https://exams.example.org/arq/a.pdf"),
        ("arq/a.pdf", "https://exams.example.org/arq/a.pdf"),
        ("//cdn.org/a.pdf", "https://cdn.org/a.pdf"),
        ("../arq/./x/../a.pdf?q=../z", "https://exams.example.org/arq/a.pdf?q=../z"),
        ("/arq/..", "https://exams.example.org/"),
        ("ftp://x/a.pdf", "ftp://x/a.pdf"),
        ("?a=b.pdf", "https://exams.example.org/?a=b.pdf"),
    ],
)
def test_resolve(spark, href, url):
    row = spark.createDataFrame([(href, URL)], "href string, page string")
    root = html.site_root(F.col("page"))
    assert row.select(html.resolve_url(F.col("href"), root)).first()[0] == url


def anchors(*pairs):
    return "".join(f'<a href="{href}">{text}</a>' for text, href in pairs)


@pytest.mark.parametrize(
    "page, exam, key, status, missing",
    [
        (
            anchors(
                ("Caderno Tipo 1", "/e1.pdf"),
                ("Caderno Tipo 1 bis", "/e2.pdf"),
                ("Gabarito Preliminar 2ª Fase", "/k0.pdf"),
                ("Gabarito Definitivo", "/k1.pdf"),
                ("GABARITO PRELIMINAR", "/k2.pdf"),
            ),
            "/e1.pdf",
            "/k2.pdf",
            "OK",
            [],
        ),
        (
            anchors(("Prova", "/x_TIPO_1.pdf"), ("Gabarito justificado", "/k0.pdf"), ("Gabarito", "/k1.pdf")),
            "/x_TIPO_1.pdf",
            "/k1.pdf",
            "OK",
            [],
        ),
        (anchors(("Padrão do gabarito prático", "/k.pdf")), None, None, "PARTIAL", ["prova", "gabarito"]),
        (anchors(("tipo 1", "/e.pdf")), "/e.pdf", None, "PARTIAL", ["gabarito"]),
    ],
)
def test_classify(spark, page, exam, key, status, missing):
    pages = spark.createDataFrame([(1, URL, page)], "page_id long, url string, html string")
    records = links.classify_links(links.with_links(pages))
    (row,) = manifest.completeness(records).collect()
    root = "https://exams.example.org"
    assert row.prova_url == (root + exam if exam else None)
    assert row.gabarito_url == (root + key if key else None)
    assert (row.status, row.missing) == (status, missing)
    assert row.total_links == page.count("<a ")
