"""Classification, extraction and planning rules on literal cases."""

import math
import random
import re
import shlex
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import classify, extract, planning
from gleanspark.operators import paging
from tests.helpers import column


@pytest.fixture(autouse=True, scope="module")
def input_column(spark):
    global A
    A = F.col("a")


def test_classify_preferences(spark):
    cases = [
        (["$90K/yr", " ", "Remote", "Full-time"], ("$90K/yr", "Remote", "Full-time")),
        (["Hybrid", "Remote", "Contract", "Part-time"], ("", "Remote", "Part-time")),
        (["Remote "], ("", "", "Remote ")),
        (["€1", "£2", "On-site"], ("£2", "On-site", "")),
        ([], ("", "", "")),
        (None, ("", "", "")),
    ]
    got = column(spark, [c for c, _ in cases], "array<string>", classify.classify_preferences(A))
    assert [tuple(r) for r in got] == [want for _, want in cases]


def test_split_salary_type(spark):
    cases = [
        ([], (None, None)),
        (None, (None, None)),
        (["$50 an hour", "- Full-time"], ("$50 an hour", "Full-time")),
        (["Competitive", "- Contract"], ("Competitive", "Contract")),
        (["Full-time"], (None, "Full-time")),
        (["£30,000 a year"], ("£30,000 a year", None)),
        (["Part-time", "x", "y"], (None, "Part-time")),
    ]
    got = column(spark, [c for c, _ in cases], "array<string>", classify.split_salary_type(A))
    assert [tuple(r) for r in got] == [want for _, want in cases]


def test_normalise_salary(spark):
    cases = {
        "$120,000 - $150,000 a year": "$120,000 - $150,000",
        "$45.50 an hour": "$45.50",
        "$1,234,567.89": "$1,234",
        "$120,000.50": "$120,000",
        "From €50K": "€50",
        "$": "$",
        "£1 £2 £3": "£1",
        "Up to 50k": None,
        "": None,
        None: None,
    }
    got = column(spark, list(cases), "string", classify.normalise_salary(A))
    assert got == list(cases.values())


def test_normalise_salary_equals_python(spark):
    rng = random.Random(2)
    cases = ["".join(rng.choice("$€£1٣,. -a") for _ in range(10)) for _ in range(400)]

    def rule(label):
        prices = re.findall(r"[$€£]\d*,?\.?\d*", label)
        return " - ".join(prices) if len(prices) == 2 else (prices or [None])[0]

    got = column(spark, cases, "string", classify.normalise_salary(A))
    assert got == [rule(c) for c in cases]


def test_resolve_location(spark):
    cases = [
        (["Acme Inc", "Remote", "Austin, TX"], "Acme", ("Austin, TX", "Remote")),
        (["Hybrid work", "Remote"], "Acme", ("Hybrid work", "Remote")),
        (["Hybrid work", "Rome"], "Acme", ("Rome", "Hybrid work")),
        (["Berlin"], "", ("", "")),
        (["Remote"], "Acme", ("", "Remote")),
        (["Remote", "Remote", "Rome"], "Acme", ("Rome", "Remote")),
        (["", "Rome", ""], "Acme", ("", "")),
        ([], "Acme", ("", "")),
        (None, "Acme", ("", "")),
    ]
    df = spark.createDataFrame(
        [(i, h, c) for i, (h, c, _) in enumerate(cases)], "i int, h array<string>, c string"
    )
    rows = df.select("i", classify.resolve_location(F.col("h"), F.col("c")).alias("p"))
    got = [tuple(r.p) for r in rows.orderBy("i").collect()]
    assert got == [want for _, _, want in cases]


def test_split_keywords(spark):
    cases = ['"Data Scientist" Python', 'a"b c"d', '"a b"c', "", "'x y' z", " a\tb ", "it's ok"]
    rng = random.Random(3)
    cases += ["".join(rng.choice("ab \"'\t") for _ in range(8)) for _ in range(400)]

    def rule(keyword):
        try:
            return shlex.split(keyword, posix=False)
        except ValueError:
            return None

    got = column(spark, cases, "string", planning.split_keywords(A))
    assert got == [rule(c) for c in cases]


def test_search_url(spark):
    url = planning.search_url(F.lit("https://h"), A, F.lit("New York"))
    got = column(spark, ["", "  ", '"Data Scientist" x'], "string", url)
    assert got == [
        "https://h/jobs?q&l=New+York",
        "https://h/jobs?q&l=New+York",
        'https://h/jobs?q="Data Scientist"+x&l=New+York',
    ]


def test_counts(spark):
    labels = ["1,234 jobs", "5 jobs", "1,234,567 jobs", "jobs", "1,000+ results", "Page 1 of 2,500"]
    assert column(spark, labels, "string", planning.first_count(A)) == [1234, 5, 1234, None, 1000, 1]
    assert column(spark, labels, "string", planning.leading_count(A)) == [
        1234, 5, 1234567, None, None, None,
    ]


@pytest.mark.parametrize("n", [0, 1, 25, 26, 30, 60, 999, 1000, 5000, None])
def test_page_plan_25(spark, n):
    df = spark.createDataFrame([(n, "u")], "n bigint, u string")
    rows = paging.page_plan_25(df, "n", "u").orderBy("page").collect()
    limit = 0 if n is None else 1000 if n >= 1000 else math.ceil(n / 25) * 25
    assert [r.start for r in rows] == list(range(0, limit, 25))
    assert [r.page_url for r in rows] == [f"u&start={s}" for s in range(0, limit, 25)]


@pytest.mark.parametrize("n,pages", [(0, 1), (15, 1), (16, 67), (9999, 67), (None, 0)])
def test_page_plan_10(spark, n, pages):
    df = spark.createDataFrame([(n, "u")], "n bigint, u string")
    rows = paging.page_plan_10(df, "n", "u").orderBy("page").collect()
    assert [r.page_url for r in rows] == [f"u&start={p}0" for p in range(pages)]


def test_allowed_domains(spark):
    urls = {
        "https://www.example.org/x": True,
        "http://EXAMPLE.org": True,
        "https://badexample.org/": False,
        "https://example.org.evil.com/": False,
        "https://a.example.com/?u=example.org": False,
        "not a url": False,
        "http://[bad": False,
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    kept = {r.url for r in paging.allowed_domains(df, "url", ["example.org"]).collect()}
    assert kept == {u for u, ok in urls.items() if ok}


def test_absent_empty_and_fallbacks(spark):
    pages = ["<i></i><b>x</b>", "<b>x</b>", "<u>&amp;</u>", ""]
    present = [extract.if_present(A, f"<{t}>([^<]*)</{t}>") for t in "ib"]
    texts = [extract.extract_text(A, f"<{t}>([^<]*)</{t}>") for t in "ibu"]
    assert column(spark, pages, "string", extract.first_present(*present)) == ["", "x", None, None]
    assert column(spark, pages, "string", extract.first_present(*present, default="")) == [
        "", "x", "", "",
    ]
    assert column(spark, pages, "string", extract.first_non_empty(*texts)) == ["x", "x", "&", ""]
    sentinel = extract.or_sentinel(extract.if_present(A, "<u>([^<]*)</u>"), "NA")
    assert column(spark, pages, "string", sentinel) == ["NA", "NA", "&", "NA"]


def test_attributes(spark):
    pages = [
        '<a class="c" href="/x?a=1&amp;b=2">l</a>',
        '<article href="/no"></article><A HREF="/y">l</A>',
        "<a>l</a>",
    ]
    got = column(spark, pages, "string", extract.extract_attr(A, "a", "href"))
    assert got == ["/x?a=1&b=2", "/y", ""]


def test_attribute_quotes(spark):
    pages = ["<a href='/x'>", "<a rel=n href=/y>", '<a href = "/z">', "<a data-href='/n'>"]
    got = column(spark, pages, "string", extract.extract_attr(A, "a", "href"))
    assert got == ["/x", "/y", "/z", ""]


@pytest.mark.parametrize(
    "base", ["https://h.org/a/b/c?q=1#f", "https://h.org", "https://h.org/", "http://h.org:80/x/"]
)
def test_absolute_url_equals_urljoin(spark, base):
    links = [
        "/r", "//o.org/p", "https://o.org/z", "mailto:a@b.c", "x", "x/y?z=/../w", "./x", "../x",
        "../../../x", "a/./b/../c", "..", ".", "?n=2", "#top", "/a/../b/", "x/..", "/..", "y#s",
    ]
    got = column(spark, [*links, "", None], "string", extract.absolute_url(F.lit(base), A))
    assert got[:-2] == [urljoin(base, link) for link in links]
    # An empty link leads to the page itself, without its fragment.
    assert got[-2:] == [base.split("#")[0], None]


def test_first_non_empty_list(spark):
    lists = extract.first_non_empty_list(
        extract.extract_all(A, "<i>([^<]*)"), extract.extract_all(A, "<b>([^<]*)")
    )
    pages = ["<i>1<i>2<b>3", "<b>3", ""]
    assert column(spark, pages, "string", lists) == [["1", "2"], ["3"], []]
