"""Star (and snowflake) left joins of a fact to its dimensions.

Join strategy is decided per dimension:

* a dimension that declares ``max_rows`` is counted up to ``max_rows + 1``
  rows; only if it really is that small is it broadcast (a proven bound);
* any other dimension gets no hint.  AQE measures the shuffle output at run
  time and turns the join into a broadcast join when that side is small, and
  otherwise keeps a sort-merge join, splitting skewed fact partitions
  (``spark.sql.adaptive.skewJoin.enabled``).  A dimension that grows with the
  data is therefore never forced into executor memory.

A dimension that hangs on another one (customer on orders, region on nation) is
joined to that one first, so the fact is shuffled once per key of its own and
never again for a key that a dimension brought along.

Dimensions are unique on their join key by construction (they come out of
``latest``), so a left join keeps the fact row count; NULL keys never match.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F

from strata.spec import Dim


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only when the frame provably holds at most ``max_rows``."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def _check_bounds(dims: Sequence[Dim]) -> dict[int, bool]:
    """Whether each bounded dimension really is under its bound: one check
    per source frame (role-playing dims share it), the small count jobs
    submitted together from driver threads."""
    frames = {id(d.df): d for d in dims if d.max_rows is not None}
    if not frames:
        return {}
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        futures = {k: pool.submit(lambda d: d.df.limit(d.max_rows + 1).count() <= d.max_rows, d)
                   for k, d in frames.items()}
        return {k: f.result() for k, f in futures.items()}


def _referenced(on: str, alias: str) -> list[str]:
    return sorted(set(re.findall(rf"\b{re.escape(alias)}\.(\w+)", on)))


def star_left_join(fact: DataFrame, dims: Sequence[Dim], fact_alias: str = "f") -> DataFrame:
    """Left-join every dimension in order, then add each dimension's output
    columns (with ``defaults`` applied by ``coalesce``, which covers both
    unmatched rows and matched rows holding NULL: SURVEY G14)."""
    within_bound = _check_bounds(dims)
    sides = {}
    for d in dims:
        needed = list(dict.fromkeys(
            _referenced(d.on, d.alias) + list(d.keep) + list(d.cols.values())
            + [c for other in dims for c in _referenced(other.on, d.alias)]))
        sides[d.alias] = d.df.select(*needed).alias(d.alias)
    bounded = {d.alias for d in dims if d.max_rows is not None and within_bound[id(d.df)]}
    own = []
    for d in reversed(dims):
        # A left join keeps the rows of its left side, so a bounded dimension
        # stays bounded with what hangs on it.
        side = F.broadcast(sides[d.alias]) if d.alias in bounded else sides[d.alias]
        parents = [p.alias for p in dims if p.alias != d.alias and _referenced(d.on, p.alias)]
        if len(parents) == 1 and not _referenced(d.on, fact_alias):
            sides[parents[0]] = sides[parents[0]].join(side, F.expr(d.on), "left")
        else:
            own.append((side, d.on))
    out = fact.alias(fact_alias)
    for side, on in reversed(own):
        out = out.join(side, F.expr(on), "left")
    extra = []
    for d in dims:
        for name, col in d.cols.items():
            c = F.col(f"{d.alias}.{col}")
            if name in d.defaults:
                c = F.coalesce(c, F.lit(d.defaults[name]))
            extra.append(c.alias(name))
    return out.select(f"{fact_alias}.*", *extra)
