"""Elements that contain others of their name."""

from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanspark.functions import extract
from gleanspark.functions.extract import Element
from gleanspark.plans import postings
from tests.helpers import column, plan

DESC = Element("div", 'class="desc"')


class Reader(HTMLParser):
    """Elements by a stack of the open tags of one name."""

    def __init__(self, tag):
        super().__init__()
        self.tag, self.open, self.done, self.n = tag, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.open.append((self.n, []))
            self.n += 1

    def handle_data(self, data):
        for _, texts in self.open:
            texts.append(data)

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            self.done.append(self.open.pop())

    def texts(self, html):
        self.feed(html)
        self.close()
        return ["".join(t) for _, t in sorted(self.done + self.open, key=lambda x: x[0])]


CASES = [
    ('<div class="desc">a<div>b</div>c</div>d', "abc"),
    ('<div>x<div class="desc"><div><div>1</div>2</div>3</div>4</div>', "123"),
    ('<DIV CLASS="x"></DIV><DIV class="desc">A<Div>B</dIV>C</DIV>D', "ABC"),
    ('<div class="desc">never <div>closed', "never closed"),
    ('</div></div><div class="desc">a</div>b', "a"),
    ('<div class="desc" title="a>b </div>">x<div t=\'>\'>y</div></div>z', "xy"),
    ('<div class="desc">a<!-- <div> -->b<script>"</div>"</script>c</div>d', "abc"),
    ('<divider>no</divider><div class="desc"><divan>a</divan></div>', "a"),
    ('<div class="desc"></div>', ""),
    ("no element", ""),
    ("", ""),
    (None, None),
]


def test_text_of_the_first(spark):
    html, expected = zip(*CASES, strict=True)
    assert column(spark, html, "string", extract.extract_text(F.col("a"), DESC)) == [*expected]


def test_absent_or_empty(spark):
    html = ['<div class="desc"> </div>', "<div>x</div>", None]
    assert column(spark, html, "string", extract.if_present(F.col("a"), DESC)) == ["", None, None]


def test_all_with_their_tags(spark):
    html = ["<ul><li>1<ul><li>2</li></ul></li><li a='>'>3</li></ul>", "<p>none", None]
    found = column(spark, html, "string", extract.extract_all(F.col("a"), Element("li"), 0))
    assert found == [
        ["<li>1<ul><li>2</li></ul></li>", "<li>2</li>", "<li a='>'>3</li>"], [], None,
    ]


def test_rows(spark):
    html = "<ul><li>1<ul><li>2</li></ul></li><li>3</li></ul>"
    df = spark.createDataFrame([(7, html), (8, None)], "id int, html string")
    rows = extract.explode_elements(df, "html", Element("ul"), ["id"]).collect()
    assert [tuple(r) for r in rows] == [(7, 0, html), (7, 1, "<ul><li>2</li></ul>")]


def test_many_tags(spark):
    n = 1000
    deep = "<div>" * n + "x" + "</div>" * n
    flat = "".join(f"<div>{i}</div>" for i in range(n))
    count = F.size(extract.elements(F.col("a"), Element("div")))
    assert column(spark, [deep, flat], "string", count) == [n, n]
    last = F.get(extract.extract_texts(F.col("a"), Element("div")), F.lit(n - 1))
    assert column(spark, [flat], "string", last) == [str(n - 1)]


PIECES = st.lists(st.sampled_from(["<div>", "</div>", "<p>", "</p>", "a", "b", '<div c="d">']))


@settings(
    max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(PIECES, min_size=1, max_size=30))
def test_like_a_stack_of_open_tags(spark, pages):
    html = ["".join(p) for p in pages]
    found = column(spark, html, "string", extract.extract_texts(F.col("a"), Element("div")))
    # A closing tag without an opening one counts for nothing in a stack; leave these pages out.
    for page, texts in zip(html, found, strict=True):
        depth = 0
        for tag in page.replace("</div>", "\0").replace("<div", "\1"):
            depth += (tag == "\1") - (tag == "\0")
            if depth < 0:
                break
        if depth >= 0:
            assert texts == Reader("div").texts(page)


@pytest.mark.parametrize("source", ["a", "b"])
def test_feeds_take_nested_descriptions(spark, source):
    page = (
        '<h1>Job</h1><i>Acme</i><a href="/c">c</a><div id="d">Intro<div>Duties<div>more</div></div>'
        "End</div><div>other</div>"
    )
    pages = spark.createDataFrame([("https://x.example/1", page)], "url string, html string")
    search = postings.Search("k", "l", "2024-01-31")
    text, title, firm = Element("div", 'id="d"'), "<h1>(.*?)</h1>", "<i>(.*?)</i>"
    if source == "a":
        chosen = postings.SelectorsA(title, firm, 'href="([^"]*)"', "<u>()", text, Element("li"))
        feed = postings.feed_a(pages, chosen, search)
        assert "Python" not in plan(feed)
    else:
        chosen = postings.SelectorsB(
            (title,), (firm,), ('href="([^"]*)"',), (Element("ol"),), Element("li"), text
        )
        sites = spark.createDataFrame([("https://x.example/c", "s")], "profile_url string, website string")
        feed = postings.feed_b(pages, chosen, sites, search)
    row = feed.first()
    assert row["job_description"] == "IntroDutiesmoreEnd" and row["job_title"] == "Job"
