"""What queries shuffle, write and hold grows no faster than their input."""

import dataclasses
import glob
import gzip

from pyspark.sql import functions as F

from __spark_entry__ import queries
from strata.plans import catalogue, tablefeeds
from strata.plans.incremental import Layout, rewrite_parts
from strata.sources.tables import evolved_schema
from strata.session import INITIAL_PARTITIONS, shuffle_for
from strata.sources import discover, landing
from strata.streaming.latest import compact_latest, latest_aggregate, read_latest, start_latest

SCHEMA = "k long, at long, v string, m map<string,string>"


def test_landing_files_are_packed_and_bounded(spark, tmp, monkeypatch):
    monkeypatch.setattr(landing, "LANDING_FILE_DOCUMENTS", 10)
    docs = spark.range(0, 35, 1, 1).select(F.concat(F.lit('{"a":'), "id", F.lit("}")).alias("document"), F.lit("2024-01-01").alias("folder"))
    landing.write_landing(docs, tmp + "/l")
    files = glob.glob(tmp + "/l/folder=2024-01-01/*.gz")
    counts = [len(gzip.open(f).read().splitlines()) for f in files]
    assert sorted(counts) == [5, 10, 10, 10]
    assert spark.read.option("recursiveFileLookup", True).json(tmp + "/l").agg(F.sum("a")).first()[0] == sum(range(35))


def test_newest_rows_cross_a_shuffle_once(spark, tmp, capsys):
    src, out, base = f"{tmp}/src", f"{tmp}/changes", f"{tmp}/base"
    drops = [[(1, 1, "a"), (1, 2, None), (2, 1, "x"), (2, 1, "y"), (None, 5, "n")], [(1, 2, "b"), (2, 0, "late"), (3, None, "c")]]
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, "k long, at long, v string").write.mode("append").parquet(src)
        start_latest(spark, spark.readStream.schema("k long, at long, v string").parquet(src), ["k"], ["at", "v"], out, f"{tmp}/ck",
                     mode="update").awaitTermination()
        if i == 0:
            compact_latest(spark, out, ["k"], base, ["at", "v"])
    want = {(1, 2, "b"), (2, 1, "y"), (3, None, "c"), (None, 5, "n")}
    for frame in (read_latest(spark, out, ["k"]), read_latest(spark, out, ["k"], base), read_latest(spark, out, ["k"], base, ["at", "v"])):
        assert frame.columns == ["k", "at", "v"] and {tuple(r) for r in frame.collect()} == want
    read_latest(spark, out, ["k"], base, ["at", "v"]).explain("formatted")
    plan = capsys.readouterr().out
    assert all("_won_by" not in line for line in plan.splitlines() if "ReadSchema" in line)
    latest_aggregate(spark.createDataFrame(drops[0], "k long, at long, v string"), ["k"], ["at", "v"]).explain()
    assert "max_by" not in capsys.readouterr().out


def test_columns_without_an_order_are_kept(spark):
    df = spark.createDataFrame([(1, 1, "a", {"x": "1"}), (1, 2, "b", {"x": "2"})], SCHEMA)
    assert [tuple(r) for r in latest_aggregate(df, ["k"], ["at"]).collect()] == [(1, 2, "b", {"x": "2"})]


def test_run_audit_builds_its_documents_once(spark, capsys):
    queries()["q21b_run_completeness"](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "run-pages" in plan and "orders.parquet" not in plan and "from_json" not in plan


def test_records_are_cut_once_and_numbers_are_tried_first(spark, monkeypatch):
    tried, real = [], discover.parse
    monkeypatch.setattr(discover, "parse", lambda kind, c: tried.append(kind) or real(kind, c))
    doc = '{"payload":{"X":{"Ys":{"Y":[{"N":"%d","T":"2024-01-01T10:00Z","E":null,"O":{"b":"%d.5","a":"x"}},{"O":{"a":"y"},"N":"7"}]}}}}'
    docs = spark.createDataFrame([(doc % (i, i),) for i in range(3)], "document string")
    spec = discover.draft_feed(docs, "ys", "ops", key=("N",))
    assert [(f.path, f.kind) for f in spec.fields if f.path != "E"] == [("N", "long"), ("T", "ts_utc"), ("O.b", "double"), ("O.a", "string")]
    assert tried.count("ts_utc") == 2 and tried.count("int") >= 4  # T and O.a only
    records = docs.select(F.explode(F.array(F.lit('{"z":1,"a":2}'), F.lit('{"a":3}'), F.lit('{"a":1,"z":2}'))).alias("r"))
    assert discover.in_document_order(records, "r", discover.merged_schema(records, "r")).fieldNames() == ["a", "z"]


def test_parts_are_packed(spark, tmp):
    spec = dataclasses.replace(tablefeeds.CHECKED_LINES_FEED, rules=())
    rows = spark.createDataFrame([], evolved_schema(spark, spec)).unionByName(
        spark.createDataFrame([(1, 2)], "l_orderkey long, l_linenumber int"), allowMissingColumns=True)
    assert rewrite_parts(spark, rows, spec, Layout(by="l_orderkey"), tmp + "/t") == [1]
    assert glob.glob(tmp + "/t/_part=1/*.zstd.parquet")


def test_lines_are_shuffled_as_they_are_typed(spark, capsys):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    catalogue._lines_drop_documents(li, 1).explain()
    partial = [line for line in capsys.readouterr().out.splitlines() if "partial_collect_list" in line]
    assert partial and all("as string" not in line and "OrderKey" not in line for line in partial)


def test_partitions_follow_rows(spark, monkeypatch):
    kept = spark.conf.get(INITIAL_PARTITIONS, None)
    asked = []
    monkeypatch.setattr(catalogue, "shuffle_for", lambda s, rows: asked.append(rows))
    try:
        catalogue.q06_explode_outer_empty(spark, "/root/testdata/sf0.001")
        assert asked == [spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()]
        shuffle_for(spark, 4_000_000)
        assert spark.conf.get(INITIAL_PARTITIONS, None) == kept  # four are set
        shuffle_for(spark, 9_000_001)
        assert spark.conf.get(INITIAL_PARTITIONS) == "10"
        shuffle_for(spark, 10)
        assert spark.conf.get(INITIAL_PARTITIONS) == "10"
    finally:
        spark.conf.unset(INITIAL_PARTITIONS) if kept is None else spark.conf.set(INITIAL_PARTITIONS, kept)
