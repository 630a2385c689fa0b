"""End to end: generated landing files through bronze, silver, quarantine, gold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans.feeds import ALL_FEEDS, FLIGHTS
from strata.plans.medallion import refresh
from strata.sources.bronze import corrupt_documents, read_bronze
from strata.sources.tables import read_current, write_version
from tests.flight_fixtures import build_landing


def _rows(spark, path, *cols):
    return {tuple(r) for r in spark.read.parquet(path).select(*cols).collect()}


def test_refresh_end_to_end(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    build_landing(landing)
    layers = refresh(spark, landing, out, ALL_FEEDS)

    bronze = read_bronze(spark, layers.bronze["flights"])
    assert bronze.count() == 5  # four good documents + one corrupt
    assert corrupt_documents(bronze).count() == 1

    silver = spark.read.parquet(layers.silver["flights"])
    ids = {r.flight_id: r for r in silver.collect()}
    # Latest-wins happened before the checks: flight 500's newest version has
    # no destination, so the key is gone although an older good version exists.
    assert not any(k.startswith("LH-500") for k in ids)
    assert "LH-400-2024-03-01" in ids and "LH-401-2024-03-01" in ids
    # NULL airline is skipped by concat_ws, never a NULL key.
    assert "600-2024-03-01" in ids
    # Pre-2024 flight is in silver (no expectation) and in quarantine (4th rule).
    assert "LH-700-2023-12-31" in ids
    # Malformed UTC time parses to NULL instead of failing the job.
    assert ids["LH-800"].sch_dep_utc is None
    assert silver.count() == silver.select("flight_id").distinct().count()

    q = spark.read.parquet(layers.quarantine["flights"])
    q_numbers = [r.flight_number for r in q.collect()]
    assert None in q_numbers                       # "4O2" and the empty page
    assert q.filter(F.col("flight_number") == 700).count() == 1
    assert q.filter(F.col("flight_number") == 500).count() == 1  # only the bad version
    assert q.filter(F.col("origin_iata").isNull() & F.col("batch_id").isNotNull()).count() >= 1

    # UTC text is read as UTC; local text keeps its wall clock.
    f400 = ids["LH-400-2024-03-01"]
    assert f400.sch_dep_local == dt.datetime(2024, 3, 1, 11, 30)

    airports = _rows(spark, layers.silver["airports"], "airport_code")
    assert airports == {("FRA",), ("JFK",), ("MUC",), ("ZRH",), ("ZZZ",)}  # ZZZ only warns
    aq = _rows(spark, layers.quarantine["airports"], "airport_code", "airport_name")
    assert ("XX", "Too short") in aq and (None, "No code") in aq and ("BER", None) in aq

    # Rule counts observed at the point of the check: over the newest versions.
    m = layers.metrics["flights"]
    assert m["valid_flight_number"] == ("drop", 6, 2)   # "4O2" and the empty page fail
    assert m["valid_arrival_airport"][2] == 2           # newest 500 and the empty page
    assert layers.metrics["airports"]["valid_coords"][0] == "warn"

    # Staged rows are stored once; silver and quarantine come from them.
    stg = spark.read.parquet(layers.staged["flights"])
    assert stg.count() == 9 and sum(m["valid_flight_number"][1:]) == 8  # one is superseded
    assert q.exceptAll(stg.select(*q.columns)).count() == 0

    gold = spark.read.parquet(layers.gold["fact_flights_master"])
    assert gold.count() == silver.count()
    assert gold.columns == ["flight_id", "airline_name", "flight_number", "origin_hub",
                            "destination", "country", "equip_code", "aircraft_name",
                            "sch_dep_utc", "dep_hour", "raw_time_status", "operational_status",
                            "ingested_at"]
    g = {r.flight_id: r for r in gold.collect()}
    r400 = g["LH-400-2024-03-01"]
    assert (r400.airline_name, r400.origin_hub, r400.destination, r400.country) == (
        "Northwind Air", "Frankfurt", "New York JFK", "United States")
    assert (r400.equip_code, r400.aircraft_name) == ("A388", "Airbus A380-800")
    assert r400.operational_status == "Delayed" and r400.dep_hour == 10
    assert g["LH-401-2024-03-01"].operational_status == "In Flight"
    assert (g["LH-401-2024-03-01"].equip_code, g["LH-401-2024-03-01"].aircraft_name) == (
        "N/A", "Unknown Aircraft")
    assert g["LH-800"].operational_status == "On Time"
    assert g["600-2024-03-01"].airline_name is None


def test_check_then_dedup_keeps_older_good_version(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    build_landing(landing)
    layers = refresh(spark, landing, out, (FLIGHTS,), mode="check_then_dedup", with_gold=False)
    silver = spark.read.parquet(layers.silver["flights"])
    assert silver.filter(F.col("flight_id") == "LH-500-2024-03-01").count() == 1


def test_rerun_adds_only_new_files(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    build_landing(landing)
    first = refresh(spark, landing, out, (FLIGHTS,), with_gold=False)
    n1 = read_bronze(spark, first.bronze["flights"]).count()
    again = refresh(spark, landing, out, (FLIGHTS,), with_gold=False)
    assert read_bronze(spark, again.bronze["flights"]).count() == n1
    from tests.flight_fixtures import flight, flights_doc, write
    write(landing, "ops", "flights", "2024-03-03", "FRA_1200_f.json",
          flights_doc("2024-03-03 12:00:00", "f", [flight(number="900")]))
    third = refresh(spark, landing, out, (FLIGHTS,), with_gold=False)
    assert read_bronze(spark, third.bronze["flights"]).count() == n1 + 1


def test_archived_landing_keeps_listings_small(spark, tmp):
    import glob
    landing, out, archive = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/archive"
    build_landing(landing)
    landed = set(glob.glob(f"{landing}/ops/flights/**/*.json", recursive=True))
    first = refresh(spark, landing, out, (FLIGHTS,), with_gold=False, archive_root=archive)
    n1 = read_bronze(spark, first.bronze["flights"]).count()
    from tests.flight_fixtures import flight, flights_doc, write
    write(landing, "ops", "flights", "2024-03-03", "FRA_1200_f.json",
          flights_doc("2024-03-03 12:00:00", "f", [flight(number="900")]))
    second = refresh(spark, landing, out, (FLIGHTS,), with_gold=False, archive_root=archive)
    # Every document once; files of the first run left the listed tree.
    assert read_bronze(spark, second.bronze["flights"]).count() == n1 + 1
    left = set(glob.glob(f"{landing}/ops/flights/**/*.json", recursive=True))
    assert not (left & landed)
    assert len(glob.glob(f"{archive}/ops/flights/**/*.json", recursive=True)) == len(landed)


def test_infer_schema_drafts_from_landed_files(spark, tmp):
    from strata.sources.bronze import infer_schema
    build_landing(f"{tmp}/landing")
    schema = infer_schema(spark, f"{tmp}/landing/ref/countries")
    assert "payload" in schema.fieldNames() and "ingestion_metadata" in schema.fieldNames()


def test_failed_rewrite_keeps_the_old_version(spark, tmp):
    path = f"{tmp}/t"
    write_version(spark.range(3), path)
    write_version(spark.range(5), path)
    with pytest.raises(Exception):
        write_version(spark.range(9).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), path)
    assert read_current(spark, path).count() == 5
