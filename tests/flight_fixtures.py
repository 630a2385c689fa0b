"""Generated flight-feed landing files (values invented for the tests).

Documents are pretty-printed, one per file, in plain date folders, the way
the fetch scripts land them.  Edge cases follow FIXTURES.md section 4.
"""

from __future__ import annotations

import json
import os


def _dt(v):
    return None if v is None else {"DateTime": v}


def flight(airline="LH", number="400", origin="FRA", dest="JFK", dep_utc="2024-03-01T10:30Z",
           dep_local="2024-03-01T11:30", time_status="OT", status="NO", aircraft="388",
           registration=None, arr_utc="2024-03-01T19:00Z"):
    node = {
        "Departure": {"AirportCode": origin, "ScheduledTimeLocal": _dt(dep_local),
                      "ScheduledTimeUTC": _dt(dep_utc), "TimeStatus": {"Code": time_status},
                      "Terminal": {"Name": "1"}},
        "Arrival": {"AirportCode": dest, "ScheduledTimeUTC": _dt(arr_utc),
                    "ScheduledTimeLocal": _dt(arr_utc and arr_utc.rstrip("Z")),
                    "TimeStatus": {"Code": "OT"}},
        "MarketingCarrier": {"AirlineID": airline, "FlightNumber": number},
        "OperatingCarrier": {"AirlineID": airline, "FlightNumber": number},
        "Equipment": {"AircraftCode": aircraft},
        "FlightStatus": {"Code": status},
        "ServiceType": "Passenger",
    }
    if registration:
        node["Equipment"]["AircraftRegistration"] = registration
    if airline is None:
        node["OperatingCarrier"].pop("AirlineID")
    return node


def names(en):
    return {"Name": {"@LanguageCode": "EN", "$": en}} if en is not None else None


def envelope(category, entity, ingested_at, batch, resource, plural, singular, records,
             total=None, offset=None, limit=None, extra_meta=None):
    meta = {"ingested_at": ingested_at, "batch_id": batch, "category": category,
            "entity": entity, "script_name": "fixture.py"}
    if offset is not None:
        meta.update({"offset": offset, "limit": limit, "endpoint": f"{entity}"})
    meta.update(extra_meta or {})
    block = {plural: ({singular: records} if records is not None else None)}
    n = len(records) if isinstance(records, list) else (1 if records else 0)
    block["Meta"] = {"@Version": "1.0", "TotalCount": total if total is not None else n}
    return {"ingestion_metadata": meta, "payload": {resource: block}}


def write(root, category, entity, folder, name, doc, raw=None):
    d = os.path.join(root, category, entity, folder)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write(raw if raw is not None else json.dumps(doc, indent=2))


def flights_doc(ingested_at, batch, records, **kw):
    return envelope("ops", "flights", ingested_at, batch, "FlightStatusResource", "Flights",
                    "Flight", records, **kw)


def build_landing(root):
    """Landing tree covering the edge cases; returns nothing, files only."""
    # Batch a: several flights as an array.
    write(root, "ops", "flights", "2024-03-01", "FRA_0800_a.json", flights_doc(
        "2024-03-01 08:00:00", "a", [
            flight(number="400", time_status="DL", status="CD"),            # delayed + cancelled
            flight(number="401", origin="JFK", dest="FRA", status="DP", aircraft="999"),
            flight(number="4O2"),                                           # non-numeric number
            flight(number="500", origin="MUC", dest="ZRH", aircraft="320"),  # good, later bad
            flight(number="700", dep_utc="2023-12-31T23:00Z", dep_local="2024-01-01T00:00"),
            flight(number="800", dep_utc="31/03/2024 10:00", status=None, time_status=None),
        ], offset=0, limit=50))
    # Batch b: one flight as a lone object: newer version of 500 with no destination.
    write(root, "ops", "flights", "2024-03-01", "MUC_0900_b.json", flights_doc(
        "2024-03-01 09:00:00", "b", flight(number="500", origin="MUC", dest=None),
        offset=0, limit=50))
    # Batch c: empty page; batch d: truncated file; batch e: missing airline.
    write(root, "ops", "flights", "2024-03-01", "ZRH_0900_c.json",
          flights_doc("2024-03-01 09:00:00", "c", [], offset=50, limit=50))
    write(root, "ops", "flights", "2024-03-01", "VIE_0900_d.json", None,
          raw='{\n  "ingestion_metadata": {"ingested_at": "2024-03-01 09:00:00",\n  "payload": {')
    write(root, "ops", "flights", "2024-03-02", "BRU_1000_e.json", flights_doc(
        "2024-03-02 10:00:00", "e", [flight(airline=None, number="600", origin="BRU", dest="FRA")],
        offset=0, limit=50))

    def ref(entity, resource, plural, singular, records):
        write(root, "ref", entity, "2024-03", f"{entity}_2024-03-01.json", envelope(
            "ref", entity, "2024-03-01 07:00:00", f"r-{entity}", resource, plural, singular,
            records, offset=0, limit=100))

    ref("airports", "AirportResource", "Airports", "Airport", [
        {"AirportCode": "FRA", "Names": names("Frankfurt"), "CityCode": "FRA", "CountryCode": "DE",
         "Position": {"Coordinate": {"Latitude": 50.03, "Longitude": 8.57}}, "UtcOffset": "+01:00",
         "TimeZoneId": "Europe/Berlin", "LocationType": "Airport"},
        {"AirportCode": "JFK", "Names": names("New York JFK"), "CountryCode": "US",
         "Position": {"Coordinate": {"Latitude": 40.64, "Longitude": -73.78}}},
        {"AirportCode": "MUC", "Names": names("Munich"), "CountryCode": "DE"},
        {"AirportCode": "ZRH", "Names": names("Zurich"), "CountryCode": "CH"},
        {"AirportCode": "XX", "Names": names("Too short"), "CountryCode": "DE"},
        {"Names": names("No code"), "CountryCode": "DE"},
        {"AirportCode": "BER", "CountryCode": "DE"},
        {"AirportCode": "ZZZ", "Names": names("Off the map"), "CountryCode": "CH",
         "Position": {"Coordinate": {"Latitude": 91.0, "Longitude": 10.0}}},
    ])
    ref("countries", "CountryResource", "Countries", "Country", [
        {"CountryCode": "DE", "Names": names("Germany")},
        {"CountryCode": "US", "Names": names("United States")},
        {"CountryCode": "CH", "Names": names("Switzerland")},
    ])
    ref("airlines", "AirlineResource", "Airlines", "Airline",
        {"AirlineID": "LH", "AirlineID_ICAO": "DLH", "Names": names("Northwind Air")})
    ref("aircraft", "AircraftResource", "AircraftSummaries", "AircraftSummary", [
        {"AircraftCode": "388", "AirlineEquipCode": "A388", "Names": names("Airbus A380-800")},
        {"AircraftCode": "320", "Names": names("Airbus A320")},
    ])
    ref("cities", "CityResource", "Cities", "City", [
        {"CityCode": "FRA", "Names": names("Frankfurt"), "CountryCode": "DE"},
    ])
