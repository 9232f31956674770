"""Markup as the standard library's parser reads it, on odd fragments."""

import html
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from nightsift.functions.html import attribute, tags, text_of, unescaped
from nightsift.operators import candidates as c


class Reader(HTMLParser):
    def __init__(self, name):
        super().__init__(convert_charrefs=True)
        self.name, self.text, self.found = name, [], []

    def handle_data(self, data):
        self.text.append(data)

    def handle_starttag(self, tag, attrs):
        if tag == self.name:
            self.found.append(next((v for k, v in attrs if k == "href"), None))

    handle_startendtag = handle_starttag


def read(fragment):
    reader = Reader("a")
    reader.feed(fragment)
    reader.close()
    return "".join(reader.text), reader.found


PIECES = [
    "plain", " a < b > c ", "x<y", "1 <2", "<b>", "</b>", "<br/>", "<p class='x>y'>", '<i title="a > b">', "<!-- no <b> & -->", "<!---->", "<!-- a -- b -->", "<!DOCTYPE html>", "</p >",
    "&amp;", "&amp;lt;", "&#38;lt;", "&#x3C;b&#x3e;", "&lt;", "&lt", "&copy;", "&copyright", "&notit;", "&notin;", "&nope;", "&", "& ", "&;", "&#;", "&#x;", "&#0;", "&#1114111;", "&#1114112;", "&#99999999999999999999;", "&#128;", "&#x9F;", "&#55296;", "&#13;", "&#1;", "&#x1F680;", "&hearts;", "&NotEqualTilde;", "&CounterClockwiseContourIntegral;",
    "<a href='u'>", '<a class="k" href="v?a=1&amp;b=2">', "<a href=bare>", "<a\nHREF = 'w' >", "<a title='href=no' href=yes>", "<a title=\"x > y\" href='z'>", "<a data-href='n'>", "</a>", "<abbr>", "<A HREF='up'>",
    "<script>if (a < b && c) x('<b>')</script>", "<style>a > b {}</style>", "\n", "é ß", "日本", "=", "\"", "'", ">",
]


@pytest.fixture(scope="module")
def fragments():
    r = random.Random(4)
    return PIECES + ["".join(r.choices(PIECES, k=r.randint(2, 9))) for _ in range(400)]


def test_text_and_links(spark, fragments):
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fragments)], "i int, f string")
    got = df.select("i", text_of(F.col("f")).alias("t"), F.transform(tags(F.col("f"), "a"), lambda t: attribute(t, "href")).alias("h")).orderBy("i").collect()
    wrong = [(f, g.t, g.h, read(f)) for f, g in zip(fragments, got, strict=True) if (g.t, g.h) != read(f)]
    assert not wrong, (len(wrong), wrong[:5])


def test_references(spark):
    names = sorted(html.entities.html5)
    texts = [f"x&{n}y" for n in names] + [f"&#{n};" for n in [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFFFE, 0x1FFFE, 0x1FFFF, 0x10FFFF, 0x110000]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.u for r in df.select("i", unescaped(F.col("t")).alias("u")).orderBy("i").collect()]
    assert got == [html.unescape(t) for t in texts]


def test_extractors_on_odd_markup(spark):
    """Comments hide markup, values hold >, attributes come bare: blocks, links, tables and cut-outs are still found."""
    page = (
        "<a name='1_F_2026-1'><!-- <pre>not this</pre> <a href='http://simbad.u-strasbg.fr/no'> -->"
        "<a title='a > b' class=\"x field-processing-log-link\" href='./log'>Fld &amp; 7 field processing log</a>"
        "<pre class='q > r'>a < b &amp;lt; c\n</pre><img alt='>' src=p_1_F_2026-1_reference.png>"
        "<a href=http://wis-tns.org/x?a=1&amp;b=2>t</a><table border=1><tr><th>h</th></tr>"
        "<tr><td title='>'>Discovery&nbsp;image 1</td><td>d</td><td>2461160.5</td><td>11.25</td><td>01:02:03.4 -05:06:07.8</td><td>1 2</td><td>/d/i.fts</td></tr></table><HR>"
    )
    r = c.parse_candidates(spark.createDataFrame([("r", page)], "report_id string, text string"), "http://b").first()
    assert r.pre == "a < b &lt; c\n" and r.field == "Fld & 7"
    assert r.cutouts == {"reference": "http://b/p_1_F_2026-1_reference.png"}
    assert r.external_links == {"tns": "http://wis-tns.org/x?a=1&b=2"}
    assert r.discovery_images[0].label == "Discovery image 1" and r.discovery_images[0].mag == 11.25


def test_gaps_are_those_of_split(spark):
    """Also in texts that hold the mark, begin or end with a match, or have none."""
    from nightsift.functions.html import TOKEN, gaps

    rows = ["", "a", "<b>", "<b>a<i></i>b</b>", "\x01", "a\x01<b>c\x01", "<p>\x01</p>", "x<b>"]
    df = spark.createDataFrame([(x,) for x in rows], "t string").select("t", gaps(F.col("t"), TOKEN).alias("g"), F.split("t", TOKEN, -1).alias("s"))
    got = df.collect()
    assert len(got) == len(rows) and all(r.g == r.s for r in got)


def test_candidates_are_cut_and_parsed_once(spark):
    """Spark adds no test of what is exploded, which would make texts and rows twice."""
    from nightsift.operators import candidates as c
    from nightsift.plans import registry

    reports = spark.range(4).select(F.col("id").alias("report_id"), F.concat(F.lit("x<a name='c"), F.col("id").cast("string"), F.lit("'><HR>y<HR>z")).alias("text"))
    reports = reports.union(spark.createDataFrame([(9, None), (10, "no anchor<HR>"), (11, "<a name='b'> no end")], "report_id long, text string"))
    cut = c.split_candidates(reports)
    assert sorted((r.report_id, r.pos, r.html) for r in cut.collect()) == [(i, k, h) for i in range(4) for k, h in enumerate((f"<a name='c{i}'>", "y"))]
    for df, times in ((cut, 1), (registry.QUERIES["p9_discovery_images"](spark, "/root/testdata/sf0.001"), 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert max(plan.count("split("), 1) >= times and "Filter (size(" not in plan and not any("Filter" in x and "split(" in x for x in plan.splitlines())
