"""Feeds drafted from documents, and columns that appear."""

import json

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from strata.plans import catalogue, tablefeeds as tf
from strata.plans.feeds import AIRPORTS
from strata.sources.bronze import envelope_schema
from strata.sources.discover import appeared, draft_feed, evolve, leaves, merged_schema, recall, record_path, remember, snake
from strata.spec import Field
from tests.flight_fixtures import envelope, names

SF = "/root/testdata/sf0.001"


def documents(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "document string")


def test_drafted_order_lines_are_the_declared_feed(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct()
    pages = catalogue._line_pages(lines, distinct=False).withColumnRenamed("l_orderkey", "o_orderkey")
    docs = catalogue._order_line_docs(pages, single_as_object=True)
    # Objects and arrays both occur.
    shapes = {r[0][:1] for r in docs.selectExpr("get_json_object(document, '$.payload.OrderLineResource.OrderLines.OrderLine')").collect()}
    assert shapes == {"{", "["}
    assert draft_feed(docs, "order_lines", "ops", key=("OrderKey",), column=lambda p: "l_" + p.lower()) == catalogue._LINE_REF_FEED


def test_nested_objects_and_kinds(spark):
    recs = [{"Id": "7", "Seen": {"At": "2024-03-01T10:30Z", "Local": "2024-03-01T11:30"}, "Price": "1.5", "Names": names("A"), "Tags": [1]},
            {"Id": "8", "Seen": {"At": "2024-03-01T10:31Z"}, "Price": "2", "Names": names("B"), "Big": "3000000000", "Flag": True}]
    docs = documents(spark, [envelope("ops", "x", "2024-03-01 08:00:00", "a", "XResource", "Xs", "X", recs),
                             envelope("ops", "x", "2024-03-01 08:00:00", "b", "XResource", "Xs", "X", recs[0]),
                             envelope("ops", "x", "2024-03-01 08:00:00", "c", "XResource", "Xs", "X", [])])
    spec = draft_feed(docs.unionByName(spark.createDataFrame([("{broken",)], docs.schema)), "x", "ops", key=("Id",))
    assert spec.array_path == "payload.XResource.Xs.X"
    assert {f.path: f.kind for f in spec.fields} == {
        "Id": "long", "Seen.At": "ts_utc", "Seen.Local": "ts_local", "Price": "double", "Names.Name.@LanguageCode": "string",
        "Names.Name.$": "string", "Tags": "string", "Big": "long", "Flag": "boolean"}
    assert [f.path for f in spec.fields][:3] == ["Id", "Seen.At", "Seen.Local"] and spec.key == ("id",)
    assert spec.node_schema["Seen"].dataType == StructType([StructField("At", StringType()), StructField("Local", StringType())])


def test_no_record_list(spark):
    with pytest.raises(ValueError):
        record_path(documents(spark, [{"payload": {"XResource": {"Meta": {"TotalCount": 0}}}}]))


def test_one_schema_for_mixed_records(spark):
    df = spark.createDataFrame([('{"a": 1, "o": {"x": 1}}',), ('{"a": 2.5, "o": {"y": "t"}}',), ("not json",), (None,)], "r string")
    assert [(p, t.typeName()) for p, t in leaves(merged_schema(df, "r"))] == [("a", "decimal"), ("o.x", "long"), ("o.y", "string")]
    assert merged_schema(df.where("r is null"), "r") == StructType([])


def test_snake():
    assert [snake(x) for x in ("Departure.AirportCode", "AirlineID_ICAO", "@Version", "total")] == [
        "departure_airport_code", "airline_id_icao", "version", "total"]


def test_what_a_feed_declares_has_not_appeared(spark):
    rec = {"AirportCode": "AAA", "Names": names("A"), "Position": {"Coordinate": {"Latitude": 1.0, "Longitude": 2.0}},
           "Runways": 3, "Position2": {"H": "x"}}
    rec["Position"]["Height"] = 12
    docs = documents(spark, [envelope("ref", "airports", "2024-03-01 08:00:00", "a", "AirportResource", "Airports", "Airport", [rec])])
    from pyspark.sql import functions as F

    bronze = docs.select(F.from_json("document", envelope_schema(AIRPORTS, False)).alias("e")).select("e.*")
    found = appeared(bronze, AIRPORTS)
    assert sorted((f.name, f.path, f.kind) for f in found) == [
        ("position2_h", "Position2.H", "string"), ("position_height", "Position.Height", "long"), ("runways", "Runways", "long")]
    grown = evolve(AIRPORTS, found)
    assert appeared(bronze, grown) == []
    assert "Height" in grown.node_schema["Position"].dataType.names and "Coordinate" in grown.node_schema["Position"].dataType.names


def test_columns_are_remembered_by_feed(spark, tmp):
    assert recall(spark, f"{tmp}/none", AIRPORTS) == AIRPORTS
    remember(spark, f"{tmp}/c", AIRPORTS, [Field("runways", "Runways", "long")])
    remember(spark, f"{tmp}/c", AIRPORTS, [Field("runways", "Runways", "long")])
    remember(spark, f"{tmp}/c", tf.EVENTS_FEED, [Field("hour", "Hour", "long")])
    assert recall(spark, f"{tmp}/c", AIRPORTS) == evolve(AIRPORTS, [Field("runways", "Runways", "long")])
