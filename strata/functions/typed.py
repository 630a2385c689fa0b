"""NULL-on-error parsers for feed text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The feed's timestamp text formats.
UTC_FORMAT = "yyyy-MM-dd'T'HH:mm'Z'"
LOCAL_FORMAT = "yyyy-MM-dd'T'HH:mm"
INGEST_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def try_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def try_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def parse_utc(c: Column | str, fmt: str = UTC_FORMAT) -> Column:
    """UTC instant from ``2024-01-01T10:30Z`` text; NULL when malformed."""
    return F.try_to_timestamp(_col(c).cast("string"), F.lit(fmt))


def parse_local(c: Column | str, fmt: str = LOCAL_FORMAT) -> Column:
    """Wall-clock time without zone from ``2024-01-01T10:30``; NULL when malformed.

    Parsed and cast back in the same session zone, so the wall clock is kept
    whatever that zone is.
    """
    return F.try_to_timestamp(_col(c).cast("string"), F.lit(fmt)).cast("timestamp_ntz")


def parse_ingest_ts(c: Column | str) -> Column:
    return F.try_to_timestamp(_col(c).cast("string"), F.lit(INGEST_FORMAT))


def wall_clock(c: Column | str) -> Column:
    """An instant shown as its UTC wall clock (for zone-free comparisons)."""
    return _col(c).cast("timestamp_ntz")


PARSERS = {
    "string": lambda c: _col(c).cast("string"),
    "int": try_int,
    "long": try_long,
    "double": try_double,
    "boolean": lambda c: _col(c).try_cast("boolean"),
    "ts_utc": parse_utc,
    "ts_local": parse_local,
    "ts": parse_ingest_ts,
    "name": lambda c: _col(c).cast("string"),
}


def parse(kind: str, c: Column | str) -> Column:
    try:
        return PARSERS[kind](c)
    except KeyError:
        raise ValueError(f"unknown field kind {kind!r}") from None
