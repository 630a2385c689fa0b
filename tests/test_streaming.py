"""Latest-wins on a stream: complete snapshots and update-mode change logs."""

import datetime as dt

from strata.operators.dedupe import latest
from strata.streaming.latest import read_latest, start_latest

T = dt.datetime
SCHEMA = "k string, ingested_at timestamp, v long"


def _drop(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)


def _run(spark, src, out, ck, mode):
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    q = start_latest(spark, stream, ["k"], ["ingested_at", "v"], out, ck, mode=mode)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_update_mode_change_log_equals_batch_latest(spark, tmp):
    src, out, ck = f"{tmp}/src", f"{tmp}/changes", f"{tmp}/ck"
    first = [("a", T(2024, 1, 1, 8), 1), ("b", T(2024, 1, 1, 8), 2), ("a", T(2024, 1, 1, 9), 3)]
    _drop(spark, src, first)
    _run(spark, src, out, ck, "update")
    second = [("a", T(2024, 1, 1, 7), 9), ("c", T(2024, 1, 2, 8), 4), ("b", T(2024, 1, 2, 8), 5)]
    _drop(spark, src, second)
    _run(spark, src, out, ck, "update")
    got = {r.k: r.v for r in read_latest(spark, out, ["k"]).collect()}
    want = {r.k: r.v for r in latest(spark.createDataFrame(first + second, SCHEMA), ["k"],
                                      ["ingested_at", "v"]).collect()}
    assert got == want == {"a": 3, "b": 5, "c": 4}
    # The second trigger logged only the keys that received rows, each with the
    # trigger's own newest row; "a"'s late, older version loses when read.
    log = spark.read.parquet(out)
    epochs = sorted({r._epoch for r in log.collect()})
    changed = {r.k: r.v for r in log.filter(log._epoch == epochs[-1]).collect()}
    assert changed == {"a": 9, "b": 5, "c": 4}
    assert log.count() == 2 + 3  # O(changes) per trigger, not O(keys)


def test_complete_mode_snapshot(spark, tmp):
    src, out, ck = f"{tmp}/src", f"{tmp}/snap", f"{tmp}/ck"
    _drop(spark, src, [("a", T(2024, 1, 1, 8), 1), ("a", T(2024, 1, 1, 9), 2)])
    _run(spark, src, out, ck, "complete")
    _drop(spark, src, [("b", T(2024, 1, 1, 8), 7)])
    _run(spark, src, out, ck, "complete")
    assert {r.k: r.v for r in spark.read.parquet(out).collect()} == {"a": 2, "b": 7}


def test_bronze_stream_interrupted_between_batches_lands_every_document_once(spark, tmp):
    # A driver lost mid-run: the stream stops after its first micro-batch (one
    # landing file per trigger), then the same job is started again from its
    # checkpoint.  Every document reaches bronze exactly once.
    import time

    from strata.plans.feeds import FLIGHTS
    from strata.sources.bronze import read_bronze, start_bronze
    from tests.flight_fixtures import flight, flights_doc, write

    landing, bronze, ck = f"{tmp}/landing/ops/flights", f"{tmp}/bronze", f"{tmp}/ck"
    for i in range(6):
        write(f"{tmp}/landing", "ops", "flights", "2024-03-01", f"FRA_{i:04d}.json",
              flights_doc("2024-03-01 10:00:00", f"b{i}", [flight(number=str(100 + i))]))
    q = start_bronze(spark, FLIGHTS, landing, bronze, ck, max_files_per_trigger=1)
    deadline = time.time() + 60
    while q.isActive and q.lastProgress is None and time.time() < deadline:
        time.sleep(0.05)
    q.stop()
    first = read_bronze(spark, bronze).count()
    q = start_bronze(spark, FLIGHTS, landing, bronze, ck, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    docs = read_bronze(spark, bronze)
    assert 1 <= first <= 6
    assert docs.count() == 6
    assert docs.select("ingestion_metadata.batch_id").distinct().count() == 6


def test_latest_stream_restarted_mid_run_equals_batch_latest(spark, tmp):
    import time

    src, out, ck = f"{tmp}/src", f"{tmp}/changes", f"{tmp}/ck"
    drops = [[("a", T(2024, 1, 1, h), h), ("b", T(2024, 1, 1, h), 10 + h)] for h in range(1, 7)]
    for rows in drops:
        _drop(spark, src, rows)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_latest(spark, stream, ["k"], ["ingested_at", "v"], out, ck, mode="update")
    deadline = time.time() + 60
    while q.isActive and q.lastProgress is None and time.time() < deadline:
        time.sleep(0.05)
    q.stop()
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_latest(spark, stream, ["k"], ["ingested_at", "v"], out, ck, mode="update")
    q.awaitTermination()
    assert q.exception() is None
    got = {r.k: r.v for r in read_latest(spark, out, ["k"]).collect()}
    assert got == {"a": 6, "b": 16}


def test_compacted_base_plus_newer_epochs_equals_full_log(spark, tmp, capsys):
    from strata.streaming.latest import compact_latest

    src, out, ck, base = f"{tmp}/src", f"{tmp}/changes", f"{tmp}/ck", f"{tmp}/base"
    _drop(spark, src, [("a", T(2024, 1, 1, 8), 1), ("b", T(2024, 1, 1, 8), 2)])
    _run(spark, src, out, ck, "update")
    _drop(spark, src, [("a", T(2024, 1, 1, 9), 3)])
    _run(spark, src, out, ck, "update")
    upto = compact_latest(spark, out, ["k"], base)
    assert upto == 1
    _drop(spark, src, [("b", T(2024, 1, 1, 9), 4), ("c", T(2024, 1, 1, 9), 5)])
    _run(spark, src, out, ck, "update")
    full = {r.k: r.v for r in read_latest(spark, out, ["k"]).collect()}
    on_base = read_latest(spark, out, ["k"], base=base)
    assert {r.k: r.v for r in on_base.collect()} == full == {"a": 3, "b": 4, "c": 5}
    on_base.explain()  # only epochs after the base are listed and read
    assert "PartitionFilters: [isnotnull(_epoch" in capsys.readouterr().out
    # A second compaction builds on the first; reading it alone gives the same rows.
    assert compact_latest(spark, out, ["k"], base) == 2
    assert {r.k: r.v for r in read_latest(spark, out, ["k"], base=base).collect()} == full
    # A version without its commit marker (a compaction lost half-way) is ignored.
    spark.createDataFrame([("a", None, -1)], "k string, ingested_at timestamp, v long") \
        .write.parquet(f"{base}/epoch_9")
    assert {r.k: r.v for r in read_latest(spark, out, ["k"], base=base).collect()} == full
