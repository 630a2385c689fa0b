"""Change-driven layers equal a full recompute and leave other parts alone."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.dedupe import latest
from strata.plans.feeds import ALL_FEEDS, AIRPORTS, FLIGHTS
from strata.plans.incremental import (EPOCH, PART, Layout, read_gold, refresh_changes, refresh_gold, rewrite_parts,
                                      touched_parts)
from strata.plans.medallion import refresh
from strata.spec import FeedSpec, Field, Rule
from tests.flight_fixtures import build_landing, flight, flights_doc, write


def rows(df, cols):
    return sorted((tuple(map(str, r)) for r in df.select(*cols).collect()))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def same_as_recompute(spark, tmp, landing, changed):
    layers = refresh(spark, landing, f"{tmp}/full")
    for spec in ALL_FEEDS:
        full = spark.read.parquet(layers.silver[spec.name])
        assert rows(changed[spec.name].read(spark), full.columns) == rows(full, full.columns), spec.name
        bad = spark.read.parquet(layers.quarantine[spec.name])
        assert rows(spark.read.schema(bad.schema).parquet(changed[spec.name].quarantine), bad.columns) == rows(bad, bad.columns)
        counts = {r.rule: (r.action, r.n_pass, r.n_fail) for r in spark.read.parquet(layers.counts[spec.name]).collect()}
        assert counts == layers.metrics[spec.name]
    gold = spark.read.parquet(layers.gold["fact_flights_master"])
    return rows(gold, gold.columns), gold.columns


def test_two_refreshes_equal_a_recompute(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    build_landing(landing)
    days = Layout(by="datediff(to_date(sch_dep_utc), DATE'2020-01-01')")
    first = refresh_changes(spark, landing, out, ALL_FEEDS, {"flights": days})
    gold_path = f"{out}/gold_parts"
    refresh_gold(spark, first, gold_path)
    before, gold_before = files(first["flights"].newest), files(gold_path)
    assert len({os.path.dirname(f) for f in before}) > 2

    # One day's flights: a newer version that loses its destination, and a new flight.
    write(landing, "ops", "flights", "2024-03-05", "late.json", flights_doc("2024-03-05 08:00:00", "z", [
        flight(number="401", origin="JFK", dest=None), flight(number="999")], offset=0, limit=50))
    second = refresh_changes(spark, landing, out, ALL_FEEDS, {"flights": days})
    assert refresh_gold(spark, second, gold_path) == touched_parts(spark, second["flights"])
    assert len(touched_parts(spark, second["flights"])) == 1 and not touched_parts(spark, second["airports"])
    want, cols = same_as_recompute(spark, tmp, landing, second)
    assert rows(read_gold(spark, gold_path), cols) == want
    for old, new in ((before, files(first["flights"].newest)), (gold_before, files(gold_path))):
        touched = f"{PART}={touched_parts(spark, second['flights'])[0]}"
        assert {f: t for f, t in old.items() if touched not in f} == {f: t for f, t in new.items() if touched not in f}

    third = refresh_changes(spark, landing, out, ALL_FEEDS, {"flights": days})
    assert all(not t.epochs for t in third.values()) and refresh_gold(spark, third, gold_path) == []


SPEC = FeedSpec(name="x", category="ops", array_path="payload.A.B.C", node_schema=FLIGHTS.node_schema, key=("k",), order=("t",),
                fields=(Field("k", "K", "long"), Field("t", "T", "long"), Field("v", "V")), rules=(Rule("has_v", "v IS NOT NULL"),))


def test_a_repeated_epoch_changes_nothing(spark, tmp):
    one = spark.createDataFrame([(i, 1, f"v{i}") for i in range(200)], "k long, t long, v string")
    two = spark.createDataFrame([(5, 2, None), (6, 0, "old"), (300, 1, "new"), (300, 1, "tie")], one.schema)
    layout = Layout(by="k div 10")
    assert len(rewrite_parts(spark, one, SPEC, layout, tmp + "/t")) == 20
    assert rewrite_parts(spark, two, SPEC, layout, tmp + "/t") == [0, 30]
    got = rows(spark.read.parquet(tmp + "/t"), ["k", "t", "v", "_passes"])
    assert rewrite_parts(spark, two, SPEC, layout, tmp + "/t") == [0, 30]
    assert rows(spark.read.parquet(tmp + "/t"), ["k", "t", "v", "_passes"]) == got
    full = latest(one.unionByName(two), ["k"], ["t"])
    assert rows(spark.read.parquet(tmp + "/t"), ["k", "t", "v"]) == rows(full, ["k", "t", "v"])
    # A key whose newest version fails is out of silver, its older good version too.
    assert spark.read.parquet(tmp + "/t").where("_passes and k = 5").count() == 0
    assert rewrite_parts(spark, two.where("false"), SPEC, layout, tmp + "/t") == []


def test_a_part_may_lose_all_its_rows(spark, tmp):
    one = spark.createDataFrame([(1, 1, "a")], "k long, t long, v string")
    layout = Layout(parts=4)
    rewrite_parts(spark, one, SPEC, layout, tmp + "/t")
    rewrite_parts(spark, one.withColumn("t", F.lit(2).cast("long")).withColumn("v", F.lit(None).cast("string")), SPEC, layout, tmp + "/t")
    assert spark.read.parquet(tmp + "/t").where("_passes").count() == 0


def test_counts_and_columns_by_epoch(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    write(landing, "ops", "flights", "2024-03-01", "a.json", flights_doc("2024-03-01 08:00:00", "a", [
        flight(number="1"), flight(number="2", dest=None), flight(number="x")]))
    first = refresh_changes(spark, landing, out, (FLIGHTS,), evolving=("flights",))["flights"]
    assert "code_share" not in first.read(spark).columns
    newer = flight(number="7")
    newer["CodeShare"], newer["Legs"] = "UA7", 2
    write(landing, "ops", "flights", "2024-03-02", "b.json", flights_doc("2024-03-02 08:00:00", "b", [newer]))
    second = refresh_changes(spark, landing, out, (FLIGHTS,), evolving=("flights",))["flights"]
    got = {r.flight_number: (r.code_share, r.legs) for r in second.read(spark).collect()}
    assert got == {1: (None, None), 7: ("UA7", 2)}
    counts = {(r[EPOCH], r.rule): (r.n_pass, r.n_fail) for r in spark.read.parquet(second.metrics).collect()}
    assert counts == {(0, "valid_flight_number"): (2, 1), (0, "valid_departure_airport"): (3, 0), (0, "valid_arrival_airport"): (2, 1),
                      (1, "valid_flight_number"): (1, 0), (1, "valid_departure_airport"): (1, 0), (1, "valid_arrival_airport"): (1, 0)}
    # The columns are known to a later run that meets none of them.
    third = refresh_changes(spark, landing, out, (FLIGHTS,), evolving=("flights",))["flights"]
    assert {"code_share", "legs"} <= set(third.read(spark).columns)


@pytest.mark.parametrize("spec", [AIRPORTS])
def test_null_keys_of_empty_pages_take_no_part(spark, tmp, spec):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    build_landing(landing)
    changed = refresh_changes(spark, landing, out, (spec,))[spec.name]
    assert changed.read(spark, checked=False).where(f"{spec.key[0]} is null").count() == 0
