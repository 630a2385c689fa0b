"""Ordered CASE builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Flight status codes and labels of the operational status.
DELAYED_TIME_STATUS = "DL"
IN_FLIGHT_CODES = ("DP", "LD", "IP")
CANCELLED_CODE = "CD"


def ordered_case(branches: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """First matching branch wins; a NULL condition does not match."""
    if not branches:
        return F.lit(otherwise)
    cond, label = branches[0]
    out = F.when(cond, F.lit(label))
    for cond, label in branches[1:]:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def flight_status(time_status: Column | str = "time_status",
                  status_code: Column | str = "status_code") -> Column:
    """Delayed beats everything, then in flight, then cancelled; NULLs fall to
    "On Time" (SURVEY G12)."""
    ts = F.col(time_status) if isinstance(time_status, str) else time_status
    sc = F.col(status_code) if isinstance(status_code, str) else status_code
    return ordered_case(
        [
            (ts == DELAYED_TIME_STATUS, "Delayed"),
            (sc.isin(*IN_FLIGHT_CODES), "In Flight"),
            (sc == CANCELLED_CODE, "Cancelled"),
        ],
        "On Time",
    )
