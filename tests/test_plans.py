"""Plan shape: pushdown, pruning, pre-shuffle top-1, bounded broadcasts."""

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def plan(spark, capsys):
    def get(name, mode="formatted"):
        queries()[name](spark, SF).explain(mode=mode)
        return capsys.readouterr().out
    return get


def test_filters_reach_the_scan(plan):
    p = plan("q23_hub_departures")
    assert "PushedFilters" in p and "In(event_type" in p and "GreaterThanOrEqual(ts" in p


def test_projection_prunes_columns(plan):
    p = plan("q18_status_case")
    read = [l for l in p.splitlines() if "ReadSchema" in l]
    assert read and all("props" not in l for l in read)


def test_latest_limits_before_the_shuffle(plan):
    p = plan("q11_latest_by_key", mode="simple")
    lines = p.splitlines()
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    # The tree prints top-down: the partial limit is below (after) the exchange,
    # so each map task ships at most one row per key.
    assert partial > exchange


def test_split_has_no_window_over_all_versions(plan):
    p = plan("q22_partition_split", mode="simple")
    assert "row_number" not in p and "partial_max_by" in p
    # Both uses read the stored, numbered rows; the table itself is not scanned again.
    assert p.count("FileScan") == 2 and "lineitem.parquet" not in p and p.count("strata/split-") == 2


def test_aggregate_variant_combines_map_side(plan):
    p = plan("q11b_max_by")
    assert p.count("Aggregate") >= 2  # partial + final


def test_small_dims_are_broadcast_and_big_ones_left_to_aqe(plan):
    p = plan("q19_role_playing")
    assert "BroadcastExchange" in p
    assert "AdaptiveSparkPlan" in p


def test_gold_runs_in_codegen_stages(spark, capsys):
    df = queries()["q20_fact_master"](spark, SF)
    df.collect()
    df.explain(mode="formatted")
    p = capsys.readouterr().out
    assert "isFinalPlan=true" in p and "[codegen id" in p


def test_lines_are_paged_before_meeting_their_order(plan):
    # A hot order must not bring all its lines into one join task: lines are
    # reduced to bounded pages (partial + final set aggregation) first; pages
    # meet orders in a semi join, and orders without lines are found by an
    # anti join against distinct order keys.  No outer join over raw lines.
    p = plan("q06_explode_outer_empty", mode="simple")
    assert "partial_collect_set" in p
    assert "LeftSemi" in p and "LeftAnti" in p and "LeftOuter" not in p
