from strata.plans.feeds import (AIRCRAFT, AIRLINES, AIRPORTS, ALL_FEEDS, CITIES, COUNTRIES, FLIGHTS,
                                HUBS, REFERENCE_FEEDS, gold_flights)
from strata.plans.medallion import Layers, refresh, staged

__all__ = ["AIRCRAFT", "AIRLINES", "AIRPORTS", "ALL_FEEDS", "CITIES", "COUNTRIES", "FLIGHTS", "HUBS",
           "Layers", "REFERENCE_FEEDS", "gold_flights", "refresh", "staged"]
