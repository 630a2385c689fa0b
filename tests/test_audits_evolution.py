"""Landing audits from bronze, and schema evolution at the record level."""

import dataclasses
import random

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.audit import SWEEP, completeness, newest_pages, offset_gaps, with_runs
from strata.operators.flatten import flatten
from strata.plans.feeds import AIRPORTS, FLIGHTS
from strata.plans.medallion import refresh
from strata.sources.bronze import read_bronze
from strata.spec import Field
from tests.flight_fixtures import build_landing, envelope, flight, flights_doc, names, write


def _airport_page(root, offset, limit, codes, total, recovered=False):
    records = [{"AirportCode": c, "Names": names(c.title()), "CountryCode": "DE"} for c in codes]
    write(root, "ref", "airports", "2024-03", f"airports_{offset}.json", envelope(
        "ref", "airports", "2024-03-01 07:00:00", f"p{offset}", "AirportResource", "Airports",
        "Airport", records, total=total, offset=offset, limit=limit,
        extra_meta={"poison_pill_recovered": True} if recovered else None))


def test_completeness_and_gaps_from_bronze(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    _airport_page(landing, 0, 5, ["AAA", "AAB", "AAC", "AAD", "AAE"], 22)
    _airport_page(landing, 5, 5, ["ABA", "ABB", "ABC", "ABD", "ABE"], 22)
    # Offsets 10-14 hit a bad record: a bisected sub-batch [10, 12) was
    # recovered, [12, 15) was skipped; the page at 20 never landed.
    _airport_page(landing, 10, 2, ["ACA", "ACB"], 22, recovered=True)
    _airport_page(landing, 15, 5, ["ADA", "ADB", "ADC", "ADD", "ADE"], 22)
    layers = refresh(spark, landing, out, (AIRPORTS,), with_gold=False)
    a = layers.audits["airports"]
    c = spark.read.parquet(a["completeness"]).first()
    assert (c.n_pages, c.n_records, c.total_count, c.missing_records, c.complete, c.n_recovered) == (
        4, 17, 22, 5, False, 1)
    gaps = sorted((r.gap_start, r.gap_end) for r in spark.read.parquet(a["gaps"]).collect())
    assert gaps == [(12, 15), (20, 22)]


def _hub_page(root, hub, hour, offset, n, total, limit=50, **extra):
    records = [flight(number=str(1000 + (offset or 0) + i)) for i in range(n)]
    write(root, "ops", "flights", "2024-03-01", f"{hub}_{hour}_{offset}.json", envelope(
        "ops", "flights", f"2024-03-01 {hour:02d}:00:00", f"{hub}{hour}{offset}", "FlightStatusResource", "Flights",
        "Flight", records, total=total, offset=offset, limit=limit, extra_meta={"endpoint": f"departures/{hub}", "limit": limit} | extra))


def test_sweeps_of_two_hubs_and_two_runs_are_audited_apart(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    # Hub A loses [50, 100) of 150; its first page comes again in a second run.
    for hour, offset in ((7, 0), (7, 100), (12, 0)):
        _hub_page(landing, "AAA", hour, offset, 50, 150)
    # Hub B is complete, one page of it without a usable limit.
    _hub_page(landing, "BBB", 7, 0, 50, 100, limit="n/a")
    _hub_page(landing, "BBB", 7, 50, 50, 100)
    # A lookup without offsets, cut at its limit.
    _hub_page(landing, "lookup", 7, None, 40, 60, limit=40)
    layers = refresh(spark, landing, out, (FLIGHTS,), with_gold=False)
    a = layers.audits["flights"]
    got = {(r.endpoint, r.run_start.hour): (r.n_pages, r.n_records, r.total_count, r.missing_records, r.complete)
           for r in spark.read.parquet(a["completeness"]).collect()}
    assert got == {("departures/AAA", 7): (2, 100, 150, 50, False), ("departures/AAA", 12): (1, 50, 150, 100, False),
                   ("departures/BBB", 7): (2, 100, 100, 0, True), ("departures/lookup", 7): (1, 40, 60, 20, False)}
    gaps = sorted((r.endpoint, r.run_start.hour, r.gap_start, r.gap_end) for r in spark.read.parquet(a["gaps"]).collect())
    assert gaps == [("departures/AAA", 7, 50, 100), ("departures/AAA", 12, 50, 150), ("departures/lookup", 7, 40, 60)]


def test_route_files_without_endpoint_are_sweeps_of_their_own(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    for i, (n, total) in enumerate([(7, 9), (4, 4), (5, 5)]):
        write(landing, "ops", "flights", "2024-03-01", f"route_{i}.json", flights_doc(
            "2024-03-01 06:00:00", f"route{i}", [flight(number=str(100 * i + j)) for j in range(n)], total=total))
    _hub_page(landing, "AAA", 6, 0, 50, 50)
    a = refresh(spark, landing, out, (FLIGHTS,), with_gold=False).audits["flights"]
    got = sorted((r.document or "", r.n_records, r.total_count, r.missing_records, r.complete)
                 for r in spark.read.parquet(a["completeness"]).collect())
    assert got == [("", 50, 50, 0, True), ("route0", 7, 9, 2, False), ("route1", 4, 4, 0, True), ("route2", 5, 5, 0, True)]
    assert [(r.document, r.gap_start, r.gap_end) for r in spark.read.parquet(a["gaps"]).collect()] == [("route0", 7, 9)]


PAGES = ("category string, entity string, endpoint string, batch_id string, ingested_at string, page_offset bigint, "
         "page_limit int, n_records bigint, total_count bigint")


def _audited(spark, rows):
    """Rows of (endpoint, ingested_at, offset, limit, records, total): both audits."""
    df = spark.createDataFrame([("ops", "x", e, f"b{i}", at, o, lim, n, t) for i, (e, at, o, lim, n, t) in enumerate(rows)], PAGES)
    pages = newest_pages(with_runs(df), SWEEP)
    done = completeness(pages, SWEEP, bucket_span=64).collect()
    gaps = offset_gaps(pages, SWEEP, bucket_span=64).collect()
    return done, gaps


def test_runs_are_found_from_the_data(spark):
    day = "2024-03-01 {:02d}:{:02d}:00"
    rows = [("h", day.format(23, 40 + i), 50 * i, 50, 50, 200) for i in range(4)]  # a run of its own
    rows += [("h", "2024-03-02 00:05:00", 150, 50, 50, 200)]  # a page again past midnight: the same run
    rows += [("h", "2024-03-02 06:00:00", 0, 50, 50, 150), ("h", "2024-03-02 06:20:00", 100, 50, 50, 150)]
    rows += [("h", "not a time", 0, 50, 50, 50), (None, "2024-03-02 06:00:00", None, None, 3, 4)]
    done, gaps = _audited(spark, rows)
    got = {(str(r.run_start), r.document, r.n_pages, r.n_records, r.missing_records, r.complete) for r in done}
    assert got == {("2024-03-01 23:40:00", None, 4, 200, 0, True), ("2024-03-02 06:00:00", None, 2, 100, 50, False),
                   ("2024-03-02 06:00:00", "b8", 1, 3, 1, False), ("None", None, 1, 50, 0, True)}
    assert {(r.document, r.gap_start, r.gap_end) for r in gaps} == {(None, 50, 100), ("b8", 3, 4)}


def test_overlapping_pages_are_not_complete_and_gapped(spark):
    at = "2024-03-01 07:00:00"
    done, gaps = _audited(spark, [("e", at, 0, 25, 25, 150), ("e", at, 25, 25, 25, 150), ("e", at, 41, 50, 50, 150), ("e", at, 91, 50, 50, 150)])
    assert [(r.n_records, r.missing_records, r.complete) for r in done] == [(150, 9, False)]
    assert [(r.gap_start, r.gap_end) for r in gaps] == [(141, 150)]


def test_audits_agree_with_a_set_of_offsets(spark):
    r = random.Random(7)
    rows, want = [], {}
    for e in range(40):
        total, covered, limited = r.randint(1, 400), set(), []
        for o in r.sample(range(0, 400, 5), r.randint(1, 30)):
            limit = r.randint(1, 60)
            limited.append((f"e{e}", "2024-03-01 07:00:00", o, limit, limit, total))
            covered |= set(range(o, o + limit))
        rows += limited
        # Coverage counts offsets up to the total only where pages end there; what lies beyond is the feed's own.
        want[f"e{e}"] = (len(covered), sorted(set(range(total)) - covered))
    done, gaps = _audited(spark, rows)
    missing = {}
    for g in gaps:
        missing.setdefault(g.endpoint, []).extend(range(g.gap_start, g.gap_end))
    for x in done:
        n, holes = want[x.endpoint]
        inside = sorted(h for h in missing.get(x.endpoint, []) if h < x.total_count)
        assert inside == holes
        assert x.missing_records == max(0, x.total_count - n)


def test_mistyped_side_fields_keep_their_records(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    for i, (total, offset, limit, extra) in enumerate([
            ("n/a", 0, 50, {}), ("3", 50, 50, {}), (4, "100", 50, {}), (4, 150, 50.5, {}),
            (4, 200, 50, {"poison_pill_recovered": "true"})]):
        records = [flight(number=str(100 + i))]
        write(landing, "ops", "flights", "2024-03-01", f"odd_{i}.json", envelope(
            "ops", "flights", "2024-03-01 07:00:00", f"b{i}", "FlightStatusResource", "Flights", "Flight",
            records, total=total, offset=offset, limit=limit, extra_meta=extra))
    write(landing, "ops", "flights", "2024-03-01", "cut.json", None, raw='{"ingestion_metadata": {"ingested_at": "2024-03')
    layers = refresh(spark, landing, out, (FLIGHTS,), with_gold=False)
    assert spark.read.parquet(layers.staged["flights"]).count() == 5
    bad = spark.read.parquet(layers.corrupt["flights"]).collect()
    assert len(bad) == 1 and bad[0].source_file.endswith("cut.json")


def test_new_record_field_is_readable_from_existing_bronze(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    build_landing(landing)
    newer = flight(number="950")
    newer["CodeShare"] = "UA950"
    write(landing, "ops", "flights", "2024-03-04", "FRA_1300_g.json",
          flights_doc("2024-03-04 13:00:00", "g", [newer]))
    layers = refresh(spark, landing, out, (FLIGHTS,), with_gold=False)
    # The feed spec learns the field later; bronze kept the raw records, so no
    # re-ingestion is needed and older documents read it as NULL.
    evolved = dataclasses.replace(
        FLIGHTS,
        node_schema=StructType(FLIGHTS.node_schema.fields + [StructField("CodeShare", StringType())]),
        fields=FLIGHTS.fields + (Field("code_share", "CodeShare"),))
    staged = flatten(read_bronze(spark, layers.bronze["flights"]), evolved)
    got = {r.flight_number: r.code_share for r in staged.filter(F.col("flight_number").isin(400, 950)).collect()}
    assert got == {400: None, 950: "UA950"}
