from strata.functions.keys import content_id, flight_key, surrogate_key
from strata.functions.records import en_name, record_array, record_count
from strata.functions.status import flight_status, ordered_case
from strata.functions.typed import (parse, parse_ingest_ts, parse_local, parse_utc, try_double,
                                    try_int, try_long, wall_clock)

__all__ = [
    "content_id", "en_name", "flight_key", "flight_status", "ordered_case", "parse",
    "parse_ingest_ts", "parse_local", "parse_utc", "record_array", "record_count",
    "surrogate_key", "try_double", "try_int", "try_long", "wall_clock",
]
