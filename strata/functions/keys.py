"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*parts: Column | str, sep: str = "-") -> Column:
    """``concat_ws`` key: NULL parts are skipped, so the key itself is never
    NULL and two rows missing the same part can share a key (SURVEY G1)."""
    return F.concat_ws(sep, *[F.col(p) if isinstance(p, str) else p for p in parts])


def flight_key(airline: str = "op_airline_id", number: str = "flight_number",
               departure_utc: str = "sch_dep_utc") -> Column:
    """Airline, flight number and UTC departure date (no route: SURVEY G2)."""
    return surrogate_key(airline, number, F.to_date(F.col(departure_utc)))


def content_id(*parts: Column | str, bits: int = 256) -> Column:
    """Deterministic identifier of a landed document (stands in for a uuid4)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]), bits)
