"""Declarative specs: a feed, its fields, its quality rules, its dimensions.

A feed is described once (array path, record schema, field map, key, ordering,
rules) and every layer - bronze, staging, silver, quarantine - is derived from
that description, so adding a sixth or seventh feed is configuration only.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

SILVER = "silver"
QUARANTINE = "quarantine"


@dataclass(frozen=True)
class Field:
    """One output column of a flattened record.

    ``path`` is relative to the record node (``Departure.AirportCode``) or, when
    it starts with ``@``, to the envelope metadata (``@ingested_at``), or, with
    ``?envelope.`` or ``?resource.``, to a field kept there in ``unknown``.
    ``kind`` selects the NULL-on-error parser applied to the text:
    string | int | long | double | boolean | ts_utc | ts_local | ts | name.
    """

    name: str
    path: str
    kind: str = "string"


@dataclass(frozen=True)
class Rule:
    """A row-level check.

    ``sql`` is the expectation: a row passes only when it evaluates to TRUE
    (NULL fails).  ``fail_sql`` optionally spells the quarantine predicate in
    the feed's own three-valued form; by default it is ``NOT coalesce(sql,
    false)``.  ``action`` is ``drop`` (filter silver) or ``warn`` (count only).
    ``applies_to`` says which outputs the rule shapes.
    """

    name: str
    sql: str | None
    action: str = "drop"
    fail_sql: str | None = None
    applies_to: frozenset = frozenset({SILVER, QUARANTINE})

    def passes(self) -> str:
        return f"coalesce(({self.sql}), false)"

    def fails(self) -> str:
        if self.fail_sql is not None:
            return self.fail_sql
        return f"NOT coalesce(({self.sql}), false)"


@dataclass(frozen=True)
class FeedSpec:
    """A landing feed (``ops/flights``, ``ref/airports`` ...).

    ``array_path`` locates the record list inside the envelope, for example
    ``payload.FlightStatusResource.Flights.Flight``; the list may arrive as an
    array or as a lone object.  ``key`` names the dedupe key; ``key_expr``
    builds it when it is computed (the flight surrogate key).  ``order`` is the
    recency ordering (newest first) and ``tie_break`` extra descending columns
    that make the pick deterministic; ``None`` means every other column.
    """

    name: str
    category: str
    array_path: str
    node_schema: StructType
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    order: tuple[str, ...] = ("ingested_at",)
    tie_break: tuple[str, ...] | None = None
    rules: tuple[Rule, ...] = ()
    enabled: bool = True
    page_size: int = 100
    multiline: bool = True
    key_expr: Callable[[], Column] | None = None
    null_key_prefilter: bool = False
    # Keep what the declared envelope does not name (new fields outside the
    # record list) as raw text next to the declared columns in bronze.
    keep_unknown: bool = True


@dataclass(frozen=True)
class Dim:
    """A dimension attached to a fact by a left join.

    ``on`` is a SQL condition over the fact alias and earlier dimension aliases
    (``f.origin_iata = org.airport_code``), so role-playing dimensions (the same
    table under two aliases) and snowflake hops (``dst.country_code =
    cntry.country_code``) are both plain entries.  ``cols`` maps output names to
    dimension columns; ``defaults`` gives literals for unmatched or NULL values.
    ``max_rows`` declares a size bound: only a dimension that provably stays
    under it is broadcast; otherwise the join strategy is left to AQE, which
    decides from measured shuffle sizes.
    """

    df: DataFrame
    alias: str
    on: str
    cols: dict = field(default_factory=dict)
    keep: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)
    max_rows: int | None = None
