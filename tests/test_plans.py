"""What the plans must not hold, and what they must."""

import re

import pytest
from pyspark.sql import functions as F

import checkset
from gleanspark.functions import text
from gleanspark.operators import skew
from gleanspark.sources.pages import read_table
from tests.helpers import plan

# Run a job while they are built, so they are covered by the other tests.
EAGER = {
    "csv_roundtrip", "csv_roundtrip_text", "csv_roundtrip_strings", "overwrite_feed", "append_tab",
    "unified_feed", "stream_ingest", "remaining_profiles",
}


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    # Nothing is small enough to broadcast by itself, as on the full data.
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(skew, "BROADCAST_BYTES", -1)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        built = {n: plan(q(spark, sf_dir)) for n, q in checkset.queries().items() if n not in EAGER}
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return built


def test_small_look_ups_do_not_shuffle_the_rows(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("enrich_company", "resume_anti", "in_domain_table", "feed_b"):
            assert "Exchange hashpartitioning" not in plan(checkset.queries()[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_and_no_pairing(plans):
    for name, tree in plans.items():
        for node in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in tree, (name, node)


def children(tree, node):
    """For each plan line with ``node``, that line and the one below it."""
    lines = tree.splitlines()
    return [(line, lines[i + 1]) for i, line in enumerate(lines[:-1]) if node in line]


def test_only_hot_groups_and_their_slices_are_broadcast(plans):
    bounded = ("_cuts#", "_parts#", "_start#", "_reached#")
    found = 0
    for name, tree in plans.items():
        for exchange, child in children(tree, "BroadcastExchange"):
            found += 1
            assert any(mark in child for mark in bounded), (name, exchange, child)
    assert found


def test_windows_have_a_slice_or_run_over_slices(plans):
    found = 0
    for name, tree in plans.items():
        for line in tree.splitlines():
            if "- Window [" in line or ":- Window [" in line:
                found += 1
                assert "_slice#" in line, (name, line)
    assert found


def test_one_task_sees_aggregates_only(plans):
    for name, tree in plans.items():
        for _, child in children(tree, "Exchange SinglePartition"):
            assert "HashAggregate" in child, (name, child)


def test_pages_are_not_shuffled(plans):
    for name in ("feed_a", "feed_b", "clean_html", "page_links"):
        for exchange, child in children(plans[name], "Exchange hashpartitioning"):
            assert not re.search(r"[\[ ]html#\d+[,\]]", child), (name, child)


def test_scans_read_needed_columns_only(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    scan = plan(pages.select(text.clean_html(F.col("html")).alias("t")))
    assert "ReadSchema: struct<html:string>" in scan


def test_cap_sends_few_rows(plans):
    below = plans["cap_per_search"].split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below.split("Scan", 1)[0]


def test_row_rules_do_not_shuffle(plans):
    for name in (
        "clean_html", "norm_ws", "drop_blank", "remove_contained", "clean_description",
        "dedup_lines", "classify_preferences", "split_salary_type", "normalise_salary",
        "extract_title", "first_present", "page_links", "feed_a", "allowed_domains",
        "split_keywords", "count_text", "unify_sources", "drop_header_rows", "null_tokens",
    ):
        assert "Exchange" not in plans[name], name


def test_resume_skip_does_not_shuffle_the_list(plans):
    body = plans["resume_skip"].split("Subquery", 1)[0]
    assert "Exchange" not in body
