"""The flight feeds: one ops feed, five reference feeds, and the gold fact.

Fixed values (must equal the feed's own names for correct results): resource
paths, field names, timestamp formats, rule predicates, status codes, default
labels, hub list and page sizes are stated here as plain text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.keys import flight_key
from strata.functions.status import flight_status
from strata.spec import QUARANTINE, SILVER, Dim, FeedSpec, Field, Rule


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


def _st(name: str, fields: list[StructField]) -> StructField:
    return StructField(name, StructType(fields))


_DT = [StructField("DateTime", StringType())]
_CODE = _s("Code", "Definition")
_NAMES = _st("Names", [_st("Name", _s("@LanguageCode", "$"))])

FLIGHT_NODE = StructType([
    _st("Departure", _s("AirportCode") + [
        _st("ScheduledTimeLocal", _DT), _st("ScheduledTimeUTC", _DT),
        _st("ActualTimeLocal", _DT), _st("ActualTimeUTC", _DT),
        _st("TimeStatus", _CODE), _st("Terminal", _s("Name", "Gate"))]),
    _st("Arrival", _s("AirportCode") + [
        _st("ScheduledTimeLocal", _DT), _st("ScheduledTimeUTC", _DT),
        _st("ActualTimeLocal", _DT), _st("ActualTimeUTC", _DT),
        _st("TimeStatus", _CODE), _st("Terminal", _s("Name", "Gate"))]),
    _st("MarketingCarrier", _s("AirlineID", "FlightNumber")),
    _st("OperatingCarrier", _s("AirlineID", "FlightNumber")),
    _st("Equipment", _s("AircraftCode", "AircraftRegistration")),
    _st("FlightStatus", _CODE),
    StructField("ServiceType", StringType()),
])

AIRPORT_NODE = StructType(_s("AirportCode", "CityCode", "CountryCode", "UtcOffset", "TimeZoneId",
                             "LocationType") + [
    _st("Position", [_st("Coordinate", _s("Latitude", "Longitude"))]), _NAMES])
CITY_NODE = StructType(_s("CityCode", "CountryCode", "UtcOffset", "TimeZoneId") + [_NAMES])
COUNTRY_NODE = StructType(_s("CountryCode") + [_NAMES])
AIRLINE_NODE = StructType(_s("AirlineID", "AirlineID_ICAO") + [_NAMES])
AIRCRAFT_NODE = StructType(_s("AircraftCode", "AirlineEquipCode") + [_NAMES])

LINEAGE = (
    Field("ingested_at", "@ingested_at", "ts"),
    Field("batch_id", "@batch_id"),
    Field("source_script", "@script_name"),
)

# Staged flight columns and their feed paths.
FLIGHTS = FeedSpec(
    name="flights",
    category="ops",
    array_path="payload.FlightStatusResource.Flights.Flight",
    node_schema=FLIGHT_NODE,
    fields=(
        Field("op_airline_id", "OperatingCarrier.AirlineID"),
        Field("mk_airline_id", "MarketingCarrier.AirlineID"),
        Field("flight_number", "OperatingCarrier.FlightNumber", "int"),
        Field("aircraft_code", "Equipment.AircraftCode"),
        Field("tail_number", "Equipment.AircraftRegistration"),
        Field("origin_iata", "Departure.AirportCode"),
        Field("dest_iata", "Arrival.AirportCode"),
        Field("status_code", "FlightStatus.Code"),
        Field("time_status", "Departure.TimeStatus.Code"),
        Field("sch_dep_utc", "Departure.ScheduledTimeUTC.DateTime", "ts_utc"),
        Field("sch_arr_utc", "Arrival.ScheduledTimeUTC.DateTime", "ts_utc"),
        Field("act_dep_utc", "Departure.ActualTimeUTC.DateTime", "ts_utc"),
        Field("sch_dep_local", "Departure.ScheduledTimeLocal.DateTime", "ts_local"),
        Field("sch_arr_local", "Arrival.ScheduledTimeLocal.DateTime", "ts_local"),
        Field("act_dep_local", "Departure.ActualTimeLocal.DateTime", "ts_local"),
    ) + LINEAGE,
    key=("flight_id",),
    key_expr=flight_key,
    order=("ingested_at",),
    # Rows of one file share ingested_at and batch_id.
    tie_break=("batch_id", "*"),
    rules=(
        Rule("valid_flight_number", "flight_number IS NOT NULL"),
        Rule("valid_departure_airport", "origin_iata IS NOT NULL"),
        Rule("valid_arrival_airport", "dest_iata IS NOT NULL"),
        Rule("recent_departure", None, fail_sql="sch_dep_utc < TIMESTAMP'2024-01-01 00:00:00'",
             applies_to=frozenset({QUARANTINE})),
    ),
    page_size=50,
)


def _ref(name: str, array_path: str, node: StructType, fields: tuple[Field, ...], key: str,
         name_col: str, extra_rules: tuple[Rule, ...] = (), key_rule: Rule | None = None,
         enabled: bool = True) -> FeedSpec:
    rules = (key_rule or Rule(f"valid_{key}", f"{key} IS NOT NULL"),
             Rule("has_name", f"{name_col} IS NOT NULL")) + extra_rules
    return FeedSpec(name=name, category="ref", array_path=array_path, node_schema=node,
                    fields=fields + LINEAGE, key=(key,), order=("ingested_at",),
                    tie_break=("batch_id", "*"), rules=rules, enabled=enabled, page_size=100,
                    null_key_prefilter=True)


# The five reference feeds.
AIRPORTS = _ref(
    "airports", "payload.AirportResource.Airports.Airport", AIRPORT_NODE,
    (Field("airport_code", "AirportCode"), Field("airport_name", "Names", "name"),
     Field("city_code", "CityCode"), Field("country_code", "CountryCode"),
     Field("latitude", "Position.Coordinate.Latitude", "double"),
     Field("longitude", "Position.Coordinate.Longitude", "double"),
     Field("utc_offset", "UtcOffset"), Field("timezone_id", "TimeZoneId"),
     Field("location_type", "LocationType")),
    "airport_code", "airport_name",
    key_rule=Rule("valid_iata_code", "length(airport_code) = 3"),
    extra_rules=(Rule("valid_coords", "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180",
                      action="warn", applies_to=frozenset({SILVER})),),
)
CITIES = _ref(
    "cities", "payload.CityResource.Cities.City", CITY_NODE,
    (Field("city_code", "CityCode"), Field("city_name", "Names", "name"),
     Field("country_code", "CountryCode"), Field("utc_offset", "UtcOffset"),
     Field("timezone_id", "TimeZoneId")),
    "city_code", "city_name", key_rule=Rule("valid_city_code", "city_code IS NOT NULL"),
)
COUNTRIES = _ref(
    "countries", "payload.CountryResource.Countries.Country", COUNTRY_NODE,
    (Field("country_code", "CountryCode"), Field("country_name", "Names", "name")),
    "country_code", "country_name", key_rule=Rule("valid_country_code", "country_code IS NOT NULL"),
)
AIRLINES = _ref(
    "airlines", "payload.AirlineResource.Airlines.Airline", AIRLINE_NODE,
    (Field("airline_id", "AirlineID"), Field("icao_code", "AirlineID_ICAO"),
     Field("airline_name", "Names", "name")),
    "airline_id", "airline_name", key_rule=Rule("valid_airline_id", "airline_id IS NOT NULL"),
)
AIRCRAFT = _ref(
    "aircraft", "payload.AircraftResource.AircraftSummaries.AircraftSummary", AIRCRAFT_NODE,
    (Field("aircraft_code", "AircraftCode"), Field("equip_code", "AirlineEquipCode"),
     Field("aircraft_name", "Names", "name")),
    "aircraft_code", "aircraft_name",
    key_rule=Rule("valid_aircraft_code", "aircraft_code IS NOT NULL"),
)

REFERENCE_FEEDS = (AIRPORTS, COUNTRIES, CITIES, AIRLINES, AIRCRAFT)
ALL_FEEDS = (FLIGHTS,) + REFERENCE_FEEDS

# Hub airports swept for departures, and gold defaults.
HUBS = ("FRA", "MUC", "ZRH", "VIE", "BRU")
EQUIP_DEFAULT = "N/A"
AIRCRAFT_DEFAULT = "Unknown Aircraft"

# Reference dimensions are bounded by the world's airports, airlines and
# aircraft types, not by flight volume; they are broadcast only under this bound.
REFERENCE_MAX_ROWS = 200_000


def gold_flights(flights: DataFrame, airports: DataFrame, airlines: DataFrame,
                 aircraft: DataFrame, countries: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The enriched flight fact (13 columns, and those of the flights named in ``keep``).  ``country`` is the destination's
    country (G13); only aircraft columns get defaults (G14)."""
    from strata.operators.enrich import star_left_join

    dims = [
        Dim(airlines, "al", "f.op_airline_id = al.airline_id", {"airline_name": "airline_name"},
            max_rows=REFERENCE_MAX_ROWS),
        Dim(airports, "org", "f.origin_iata = org.airport_code", {"origin_hub": "airport_name"},
            keep=("country_code",), max_rows=REFERENCE_MAX_ROWS),
        Dim(airports, "dst", "f.dest_iata = dst.airport_code", {"destination": "airport_name"},
            keep=("country_code",), max_rows=REFERENCE_MAX_ROWS),
        Dim(aircraft, "ac", "f.aircraft_code = ac.aircraft_code",
            {"equip_code": "equip_code", "aircraft_name": "aircraft_name"},
            defaults={"equip_code": EQUIP_DEFAULT, "aircraft_name": AIRCRAFT_DEFAULT},
            max_rows=REFERENCE_MAX_ROWS),
        Dim(countries, "cntry", "dst.country_code = cntry.country_code", {"country": "country_name"},
            max_rows=REFERENCE_MAX_ROWS),
    ]
    joined = star_left_join(flights, dims)
    return joined.select(
        "flight_id", "airline_name", "flight_number", "origin_hub", "destination", "country",
        "equip_code", "aircraft_name", "sch_dep_utc",
        F.hour("sch_dep_utc").alias("dep_hour"),
        F.col("time_status").alias("raw_time_status"),
        flight_status("time_status", "status_code").alias("operational_status"),
        "ingested_at", *keep,
    )
