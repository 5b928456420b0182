"""Both sources from captured pages to the published tab."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanspark import workspace
from gleanspark.plans import listing, postings
from gleanspark.schema import NOT_AVAILABLE, PAGE, POSTING_COLUMNS
from gleanspark.sources.feeds import read_tab
from gleanspark.streaming import ingest

SEARCH = postings.Search('"Data Scientist"', "New York", "2024-01-31")

A = postings.SelectorsA(
    title="<h1>(.*?)</h1>",
    company='<a class="co"[^>]*>(.*?)</a>',
    company_url='<a class="co" href="([^"]*)"',
    location='<span class="place">(.*?)</span>',
    description='(?s)<div id="about"><p>(.*?)</p>',
    preferences="(?s)<button>(.*?)</button>",
    dates=("<time>(.*?)</time>", "<i>(.*?)</i>"),
)
B = postings.SelectorsB(
    titles=('<h2 class="t">(.*?)</h2>', "<h1>(.*?)</h1>"),
    companies=('<a class="co"[^>]*>(.*?)</a>', "<b [^>]*>(.*?)</b>"),
    company_urls=('<a class="co" href="([^"]*)"', '<b data-href="([^"]*)"'),
    headers=("<dt>(.*?)</dt>", "<dd>(.*?)</dd>"),
    salary_type="<em>(.*?)</em>",
    description="(?s)<p>(.*?)</p>",
)

PAGES_A = [
    (
        1,
        "https://a.example.com/view/1",
        '<h1>Data &amp; ML</h1><a class="co" href="/co/acme"><b>Acme</b></a>'
        '<span class="place">Rome</span><i>2 days ago</i><button>$90K/yr</button>'
        "<button> </button><button>Remote</button><button>Contract</button>"
        '<div id="about"><p>First<br> part</p><p>Second</p></div>',
    ),
    (2, "https://a.example.com/view/2", "<time></time><i>later</i><button>Hybrid</button>"),
]
PAGES_B = [
    (
        1,
        "https://b.example.com/j/1",
        '<h1>Analyst</h1><b data-href="/cmp/acme">Acme</b><dt>Acme Inc</dt><dt>Hybrid work</dt>'
        "<dt>Austin, TX</dt><em>$120,000 - $150,000 a year</em><em>- Full-time</em>"
        "<p>Hello</p><p>World</p><p>Hello</p>",
    ),
    (
        2,
        "https://b.example.com/j/2",
        '<h2 class="t">Clerk</h2><a class="co" href="/cmp/none">Nobody</a><dd>Remote</dd>'
        "<em>Part-time</em>",
    ),
    (3, "https://b.example.com/j/3", ""),
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[1])


def test_first_source(spark):
    got = rows(postings.feed_a(spark.createDataFrame(PAGES_A, PAGE), A, SEARCH))
    lineage = ('"Data Scientist"', "New York", "2024-01-31", "Linkedin")
    assert got == [
        ("Data & ML", "https://a.example.com/view/1", "$90K/yr", "Rome", "2 days ago", "Remote",
         "Contract", "First part", "Acme", "", "https://a.example.com/co/acme", *lineage),
        ("", "https://a.example.com/view/2", "", "", "", "Hybrid", "", "", "", "", "", *lineage),
    ]


def test_second_source(spark):
    companies = postings.company_sites(
        spark.createDataFrame(
            [(1, "https://b.example.com/cmp/acme", '<a class="w" href="https://acme.example">s</a>')],
            PAGE,
        ),
        ['<a class="web" href="([^"]*)"', '<a class="w" href="([^"]*)"'],
    )
    got = rows(postings.feed_b(spark.createDataFrame(PAGES_B, PAGE), B, companies, SEARCH))
    lineage = ("", '"Data Scientist"', "New York", "2024-01-31", "Indeed")
    assert got == [
        ("Analyst", "https://b.example.com/j/1", "$120,000 - $150,000", "Austin, TX", "",
         "Hybrid work", "Full-time", "Hello\nWorld", "Acme", "https://acme.example", *lineage),
        ("Clerk", "https://b.example.com/j/2", None, "", "", "Remote", "Part-time", "", "Nobody",
         "", *lineage),
        ("", "https://b.example.com/j/3", None, "", "", "", None, "", "", "", *lineage),
    ]


def test_publish_replaces_the_feed_and_appends_to_the_tab(spark):
    feed = postings.feed_a(spark.createDataFrame(PAGES_A, PAGE), A, SEARCH)
    headers = list(POSTING_COLUMNS.values())
    repeated = spark.createDataFrame([tuple(headers)], feed.schema)
    path, dest = workspace.fresh_path(spark, "feed"), workspace.fresh_path(spark, "tabs")
    for batch in ("1", "2"):
        delivered = postings.publish(spark, [feed, repeated], path, dest, "Data", batch)
        assert delivered.columns == headers
        assert delivered.count() == 2
    tab = read_tab(spark, dest, "Data", headers)
    assert tab.count() == 4
    assert tab.where(F.col("Job title") == "Job title").count() == 0
    assert tab.where(F.col("Salary").isNull()).count() == 0


LISTING = [
    ("s", 0, "https://a.example.com/l?start=0", '<a href="/v/1">x</a><a href="/v/2">y</a>'),
    ("s", 1, "https://a.example.com/l?start=10", '<a href="/v/1">x</a><i>omitted</i>'),
    ("s", 2, "https://a.example.com/l?start=20", '<a href="/v/9">x</a>'),
    ("t", 0, "https://a.example.com/l?start=0", '<a href="https://o.example/q">x</a>'),
]


def test_listing_links_stop_at_the_marker(spark):
    pages = spark.createDataFrame(LISTING, "search_id string, page int, url string, html string")
    marker = F.col("html").contains("omitted")
    link = "<a [^>]*>"
    some = listing.listing_links(pages, "search_id", "page", link, marker).collect()
    assert sorted(map(tuple, some)) == [
        ("s", 0, 0, "https://a.example.com/v/1"),
        ("s", 0, 1, "https://a.example.com/v/2"),
        ("s", 1, 0, "https://a.example.com/v/1"),
        ("t", 0, 0, "https://o.example/q"),
    ]
    assert listing.listing_links(pages, "search_id", "page", link).count() == 5


def test_provider_listing(spark):
    pages = spark.createDataFrame(
        [
            ("p", 0, "https://c.example/", '<a href="/u/1"><h3>One</h3></a><a><h3>Two</h3></a><u>'),
            ("p", 1, "https://c.example/", '<a href="/u/3"></a>'),
            ("p", 2, "https://c.example/", '<a href="/u/4"><h3>Four</h3></a>'),
        ],
        "k string, page int, url string, html string",
    )
    found = listing.provider_listing(
        pages, "k", "page", F.col("html").contains("<u>"), "(?s)<a.*?</a>", "<h3>(.*?)</h3>",
        '<a href="([^"]*)"',
    )
    assert rows(listing.provider_feed(found)) == sorted(
        [
            ("One", "https://c.example/u/1"),
            ("Two", NOT_AVAILABLE),
            (NOT_AVAILABLE, "https://c.example/u/3"),
        ],
        key=lambda r: r[1],
    )
    assert listing.provider_feed(found).columns == ["Provider name", "Provider profile"]


def test_scratch_deletes_what_was_written_inside(spark, tmp_path):
    df = spark.range(5)
    with workspace.scratch(spark):
        outer = workspace.settle(df, "outer").inputFiles()[0].rsplit("/", 1)[0]
        with pytest.raises(ZeroDivisionError), workspace.scratch(spark):
            inner = workspace.settle(df, "inner")
            inner.write.parquet(f"{tmp_path}/kept")
            gone = inner.inputFiles()[0].rsplit("/", 1)[0]
            1 / 0
        assert not Path(gone.removeprefix("file://")).exists()
        assert Path(outer.removeprefix("file://")).exists()
    assert not Path(outer.removeprefix("file://")).exists()
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 5
    stays = workspace.settle(df, "stays")
    assert stays.count() == 5


def test_a_stream_leaves_no_tables_behind(spark, tmp_path):
    captures = spark.createDataFrame([(i, "u", "<p>") for i in range(4)], PAGE)
    captures.write.parquet(f"{tmp_path}/pages")
    before = set(Path(workspace.shared_dir(spark).removeprefix("file://")).iterdir())

    def job(batch):
        return workspace.settle(batch, "batch")

    stream = ingest.page_stream(spark, f"{tmp_path}/pages")
    query = ingest.ingest_to_tab(stream, job, f"{tmp_path}/tabs", "t", f"{tmp_path}/state")
    query.awaitTermination()
    rows = read_tab(spark, f"{tmp_path}/tabs", "t", captures.columns)
    assert rows.count() == 4
    assert set(Path(workspace.shared_dir(spark).removeprefix("file://")).iterdir()) == before
