import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import (bounded_broadcast, completeness, dq_metrics, expect_flags,
                              expect_or_drop, latest, offset_gaps, partition_split, quarantine,
                              routes_on, route_frame, silver, star_left_join)
from strata.spec import QUARANTINE, Dim, FeedSpec, Rule
from pyspark.sql.types import StructType

T = dt.datetime


def _versions(spark):
    return spark.createDataFrame([
        ("k1", T(2024, 1, 1, 8), "b1", 1, "old-good"),
        ("k1", T(2024, 1, 1, 9), "b2", None, "new-bad"),
        ("k2", T(2024, 1, 1, 9), "b1", 2, "tie-a"),
        ("k2", T(2024, 1, 1, 9), "b2", 3, "tie-b"),
        (None, T(2024, 1, 1, 9), "b3", 4, "null-key"),
    ], "k string, ingested_at timestamp, batch_id string, v int, label string")


RULES = (Rule("has_v", "v IS NOT NULL"), Rule("has_k", "k IS NOT NULL"))
SPEC = FeedSpec(name="t", category="ref", array_path="payload.R.P.S", node_schema=StructType([]),
                fields=(), key=("k",), order=("ingested_at",), tie_break=None, rules=RULES)


@pytest.mark.parametrize("method", ["window", "aggregate"])
def test_latest_is_deterministic_and_methods_agree(spark, method):
    df = _versions(spark)
    got = {(r.k, r.label) for r in latest(df, ["k"], ["ingested_at"], None, method).collect()}
    # Tie on ingested_at for k2 is broken by batch_id descending.
    assert got == {("k1", "new-bad"), ("k2", "tie-b"), (None, "null-key")}


def test_dedup_then_check_vs_check_then_dedup(spark):
    df = _versions(spark)
    a = {r.label for r in silver(df, SPEC, mode="dedup_then_check").collect()}
    b = {r.label for r in silver(df, SPEC, mode="check_then_dedup").collect()}
    assert a == {"tie-b"}
    assert b == {"old-good", "tie-b"}


def test_quarantine_three_valued_and_quarantine_only_rule(spark):
    df = spark.createDataFrame([("FRA", "n", 1), ("XX", "n", 1), (None, "n", 1), ("MUC", None, 1),
                                ("ZRH", "n", None)], "code string, name string, age int")
    rules = (Rule("valid_code", "length(code) = 3"), Rule("has_name", "name IS NOT NULL"),
             Rule("young", None, fail_sql="age > 0", applies_to=frozenset({QUARANTINE})))
    q = {(r.code, r.name) for r in quarantine(df, rules).collect()}
    # NULL age does not quarantine (reference's three-valued OR), age>0 does.
    assert q == {("FRA", "n"), ("XX", "n"), (None, "n"), ("MUC", None)}
    kept = {r.code for r in expect_or_drop(df, rules).collect()}
    assert kept == {"FRA", "ZRH"}  # quarantine-only rule does not filter silver
    m = {r.rule: (r.action, r.n_pass, r.n_fail) for r in dq_metrics(df, rules).collect()}
    assert m["valid_code"] == ("drop", 3, 2)
    assert m["young"] == ("quarantine", 1, 4)


def test_warn_rule_flags_only(spark):
    df = spark.createDataFrame([(50.0,), (91.0,), (None,)], "lat double")
    rules = (Rule("valid_coords", "lat BETWEEN -90 AND 90", action="warn"),)
    out = expect_flags(expect_or_drop(df, rules), rules).collect()
    assert [r.valid_coords for r in out] == [True, False, False]


def test_partition_split_partitions_input(spark):
    df = _versions(spark).withColumnRenamed("label", "tag")
    split = partition_split(df, ["k"], ["ingested_at"], RULES)
    assert split.count() == df.count()
    got = {r.tag: (r.label, list(r.failed_rules)) for r in split.collect()}
    assert got == {"old-good": ("superseded", []), "new-bad": ("quarantine", ["has_v"]),
                   "tie-a": ("superseded", []), "tie-b": ("silver", []),
                   "null-key": ("quarantine", ["has_k"])}


def test_split_of_an_input_after_a_shuffle(spark):
    # Input straight out of a shuffle: the numbered rows are stored once.
    df = _versions(spark).repartition(3, "label")
    pinned = partition_split(df, ["k"], ["ingested_at"], RULES, label_col="split")
    want = partition_split(_versions(spark), ["k"], ["ingested_at"], RULES, label_col="split")
    assert sorted((r.label, r.split) for r in pinned.collect()) == \
        sorted((r.label, r.split) for r in want.collect())


def test_split_silver_equals_dedup_then_check(spark):
    df = _versions(spark).withColumnRenamed("label", "tag")
    split = partition_split(df, ["k"], ["ingested_at"], RULES).filter("label = 'silver'")
    a = sorted(tuple(r) for r in split.drop("label", "failed_rules").collect())
    b = sorted(tuple(r) for r in silver(df, SPEC).collect())
    assert a == b


def test_star_left_join_defaults_and_row_count(spark):
    fact = spark.createDataFrame([(1, "A", "X"), (2, "B", "Y"), (3, None, "Z")],
                                 "id int, ac string, dst string")
    ac = spark.createDataFrame([("A", "eqA", "nameA"), ("B", None, "nameB")],
                               "code string, equip string, name string")
    ap = spark.createDataFrame([("X", "DE"), ("Y", "US")], "code string, cc string")
    cn = spark.createDataFrame([("DE", "Germany")], "cc string, cname string")
    out = star_left_join(fact, [
        Dim(ac, "ac", "f.ac = ac.code", {"equip": "equip", "aname": "name"},
            defaults={"equip": "N/A", "aname": "Unknown"}, max_rows=100),
        Dim(ap, "dst", "f.dst = dst.code", keep=("cc",), max_rows=100),
        Dim(cn, "c", "dst.cc = c.cc", {"country": "cname"}),
    ])
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 3
    assert (rows[1].equip, rows[1].aname, rows[1].country) == ("eqA", "nameA", "Germany")
    assert (rows[2].equip, rows[2].country) == ("N/A", None)     # matched but NULL -> default
    assert (rows[3].equip, rows[3].aname) == ("N/A", "Unknown")  # unmatched -> default


def test_bounded_broadcast_respects_bound(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only hints may broadcast
    try:
        dim = spark.range(50).withColumnRenamed("id", "k")
        fact = spark.range(1000).select((F.col("id") % 50).alias("k"))
        fact.join(bounded_broadcast(dim, 100), "k").explain()
        within = capsys.readouterr().out
        fact.join(bounded_broadcast(dim, 10), "k").explain()
        over = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in within
    assert "BroadcastHashJoin" not in over and "SortMergeJoin" in over


def _gaps_brute(pages, total):
    covered = set()
    for off, lim in pages:
        covered.update(range(off, off + lim))
    gaps, start = [], None
    for i in range(total):
        if i not in covered and start is None:
            start = i
        if i in covered and start is not None:
            gaps.append((start, i)); start = None
    if start is not None:
        gaps.append((start, total))
    return gaps


def _sweep_like_the_feed(rnd, limit, total):
    """Pages as the fetch loop lands them: full pages, and on a bad record at
    p bisected clean sub-batches of [offset, offset + limit) without p, then
    a resume at p + 1 with a full page (so pages overlap); some pages are
    lost in transit."""
    pages, offset = [], 0
    while offset < total:
        if rnd.random() < 0.15:
            bad = offset + rnd.randrange(limit)
            cuts = sorted({offset, bad, bad + 1, offset + limit} | {rnd.randrange(offset, offset + limit) for _ in range(2)})
            for a, b in zip(cuts, cuts[1:]):
                if not (a <= bad < b):
                    pages.append((a, b - a))
            offset = bad + 1
        else:
            pages.append((offset, limit))
            offset += limit
    return [p for p in pages if rnd.random() > 0.1]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_offset_gaps_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    limit = 10
    total = 2000 - rnd.randint(0, 9)
    pages = _sweep_like_the_feed(rnd, limit, total)
    pages += pages[:5]  # re-delivered pages count once
    df = spark.createDataFrame([("s", o, l, total) for o, l in pages],
                               "sweep string, page_offset long, page_limit int, total_count long")
    want = _gaps_brute(pages, total)
    assert want  # the sweep really has holes
    for span in (35, 1000, 1 << 20):  # buckets smaller than, around and beyond the sweep
        got = sorted((r.gap_start, r.gap_end) for r in offset_gaps(df, ["sweep"], bucket_span=span).collect())
        assert got == want, span


def test_offset_gaps_long_page_covers_later_buckets(spark):
    # A page reaching over several buckets hides what lies under it.
    pages = [(0, 100), (10, 5), (120, 10), (200, 10)]
    df = spark.createDataFrame([("s", o, l, 215) for o, l in pages],
                               "sweep string, page_offset long, page_limit int, total_count long")
    got = sorted((r.gap_start, r.gap_end) for r in offset_gaps(df, ["sweep"], bucket_span=7).collect())
    assert got == _gaps_brute(pages, 215) == [(100, 120), (130, 200), (210, 215)]


def test_completeness_flags_short_sweeps(spark):
    df = spark.createDataFrame([("a", 0, 50, 50, 120, False), ("a", 50, 50, 50, 120, True),
                                ("b", 0, 50, 30, 30, None)],
                               "sweep string, page_offset long, page_limit int, n_records long, "
                               "total_count long, rec boolean")
    rows = {r.sweep: r for r in completeness(df, ["sweep"], recovered="rec").collect()}
    assert (rows["a"].n_records, rows["a"].missing_records, rows["a"].complete) == (100, 20, False)
    assert rows["a"].expected_pages == 3 and rows["a"].n_recovered == 1
    assert rows["b"].complete


def test_routes_on_semi_join(spark):
    df = spark.createDataFrame([("FRA", "JFK", 1), ("FRA", "LHR", 2), ("MUC", "JFK", 3)],
                               "o string, d string, id int")
    routes = route_frame(spark, [("FRA", "JFK"), ("MUC", "JFK")], ["o", "d"])
    assert sorted(r.id for r in routes_on(df, routes, ["o", "d"]).collect()) == [1, 3]


def test_hot_key_holding_a_third_of_rows(spark):
    # 3000 rows, 1000 of them on one key: results stay exact.
    rows = [("hot", i, i % 7) for i in range(1000)] + [(f"k{i}", i, 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v long, w long").repartition(8)
    for method in ("window", "aggregate"):
        out = {r.k: r.v for r in latest(df, ["k"], ["v"], ["w"], method).collect()}
        assert out["hot"] == 999 and len(out) == 2001
    split = partition_split(df, ["k"], ["v"], (Rule("pos", "v >= 0"),), ["w"])
    counts = {r.label: r["count"] for r in split.groupBy("label").count().collect()}
    assert counts == {"silver": 2001, "superseded": 999}
