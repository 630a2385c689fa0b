"""Feed selections that the fetch scripts made server-side, as filters.

* ``departures_from_hubs``: departures from a list of hub airports from a
  cut-off time on (the hub sweep).
* ``routes_on``: flights on a list of (origin, destination) routes and days,
  as a left-semi join against the route list (the route lookup).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.operators.enrich import bounded_broadcast


def departures_from_hubs(df: DataFrame, hubs: Iterable[str], since, origin: str = "origin_iata",
                         departure: str = "sch_dep_utc") -> DataFrame:
    since_col = since if not isinstance(since, str) else F.lit(since).cast(
        df.schema[departure].dataType)
    return df.filter(F.col(origin).isin(*list(hubs)) & (F.col(departure) >= since_col))


def route_frame(spark: SparkSession, routes: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(routes), list(names))


def routes_on(df: DataFrame, routes: DataFrame, on: Sequence[str], max_routes: int = 10_000) -> DataFrame:
    """Rows whose ``on`` columns match a route.  The route list is a literal
    list, so its size is known; it is broadcast only under ``max_routes``."""
    return df.join(bounded_broadcast(routes.select(*on).distinct(), max_routes), list(on), "left_semi")
