"""Cleaning rules against literal cases and plain Python statements of them."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import text
from tests.helpers import column


@pytest.fixture(autouse=True, scope="module")
def input_column(spark):
    global A
    A = F.col("a")


def test_entities_decode_once(spark):
    cases = {
        "a &amp;lt; b &lt; c": "a &lt; b < c",
        "&copy;2 &eacute;&hellip; &check;": "©2 é… ✓",
        "&#65;&#x1F600;&#X41; &#128;": "A😀A €",
        "&#xD800;&#0;&#99999999;": "���",
        "AT&T & co &": "AT&T & co &",
        "&nope; &nope": "&nope &nope",
        "no reference": "no reference",
        "": "",
        None: None,
    }
    got = column(spark, list(cases), "string", text.decode_entities(A))
    assert got == list(cases.values())


def test_clean_html_cases(spark):
    cases = {
        "<p>a</p><p>b</p>": "ab",
        '<p class="x>y">a<!-- <b>c</b> -->d</p>': "ad",
        "<script>var t='</p>';if(a<b){}</script>kept": "kept",
        "<STYLE>p{}</STYLE>kept<br/>too": "kepttoo",
        "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
        "a&nbsp;&nbsp;b\r\n\tc ": "a b c",
        "<script>never closed": "",
        "<a href='x' data-y=\"1>0\">link</a>": "link",
        "<b>a &amp</b>b &lt<i>c</i>": "a &b <c",
        "": "",
    }
    assert column(spark, list(cases), "string", text.clean_html(A)) == list(cases.values())


class Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skip, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_clean_html_equals_parser_on_every_page(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = pages.select("html", text.clean_html(F.col("html")).alias("text")).collect()
    assert rows
    for row in rows:
        parser = Text()
        parser.feed(row.html)
        parser.close()
        assert " ".join("".join(parser.out).split()) == row.text


def test_norm_ws_equals_split(spark):
    spaces = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0      　"
    rng = random.Random(1)
    cases = ["".join(rng.choice(spaces + "ab") for _ in range(12)) for _ in range(300)]
    assert column(spark, cases, "string", text.norm_ws(A)) == [" ".join(c.split()) for c in cases]


def test_lists(spark):
    items = ["ab", "a", "abc", "x", "ab", ""]
    cases = [items, ["a", "a"], [], [" ", "b ", "", "\xa0"]]

    def of(expr):
        return column(spark, cases, "array<string>", expr)

    assert of(text.ordered_distinct(A))[0] == ["ab", "a", "abc", "x", ""]
    assert of(text.remove_contained(A))[:3] == [["abc", "x"], ["a", "a"], []]
    assert of(text.drop_empty(A))[3] == [" ", "b ", "\xa0"]
    assert of(text.drop_blank(A))[3] == ["b "]


def test_clean_description(spark):
    cases = [["<p>Work here</p>", "Work", "<b></b>", "Work here", "Pay &amp; more"]]
    assert column(spark, cases, "array<string>", text.clean_description(A)) == [
        "Work here\nPay & more"
    ]


@pytest.mark.parametrize("rule", [text.dedup_lines, text.norm_ws])
def test_rules_are_idempotent(spark, sf_dir, rule):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    once = docs.select(rule(F.col("text")).alias("once"))
    assert once.where(F.col("once") != rule(F.col("once"))).count() == 0


def test_dedup_lines_and_bullet(spark):
    assert column(spark, ["a\n\nb\na\n\n", ""], "string", text.dedup_lines(A)) == ["a\n\nb", ""]
    assert column(spark, ["- Full-time", "x"], "string", text.strip_bullet(A)) == ["Full-time", ""]
