from strata.operators.audit import completeness, landed_pages, offset_gaps
from strata.operators.dedupe import latest, latest_by_aggregate
from strata.operators.enrich import bounded_broadcast, star_left_join
from strata.operators.flatten import explode_records, flatten
from strata.operators.lookup import departures_from_hubs, route_frame, routes_on
from strata.operators.quality import (dq_metrics, expect_flags, expect_or_drop, observe_rules,
                                      partition_split, quarantine, silver, silver_by)

__all__ = [
    "bounded_broadcast", "completeness", "departures_from_hubs", "dq_metrics", "expect_flags",
    "expect_or_drop", "explode_records", "flatten", "landed_pages", "latest", "latest_by_aggregate",
    "observe_rules", "offset_gaps", "partition_split", "quarantine", "route_frame", "routes_on",
    "silver", "silver_by", "star_left_join",
]
