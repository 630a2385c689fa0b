"""Keep the newest version of each key.

Two plans give the same rows:

* ``window``: ``row_number()`` over ``partitionBy(keys)`` ordered newest first,
  keep 1.  Catalyst turns the filter into a ``WindowGroupLimit`` that already
  runs before the shuffle, so at most one row per key and map task crosses the
  network and a hot key does not pile up in one reducer.
* ``aggregate``: ``max_by(struct(row), struct(ordering))`` grouped by key, a
  partial/final aggregate with the same map-side reduction.

The ordering is made total by tie-break columns (SURVEY G4): by default every
remaining column, descending with NULLs last, so reruns pick the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

RANK = "_rank"


REST = "*"


def ordering_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     tie_break: Sequence[str] | None = None) -> list[str]:
    """Recency columns followed by tie-break columns.  ``None`` means every
    other column; a ``"*"`` entry stands for every column not named before
    it (so ``("batch_id", "*")`` is batch id, then the rest)."""
    if tie_break is None:
        tie_break = [REST]
    out = list(order)
    for c in tie_break:
        if c == REST:
            named = set(keys) | set(out) | {t for t in tie_break if t != REST}
            out += [x for x in df.columns if x not in named]
        elif c not in out:
            out.append(c)
    return out


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str],
           tie_break: Sequence[str] | None = None, method: str = "window") -> DataFrame:
    cols = ordering_columns(df, keys, order, tie_break)
    if method == "aggregate":
        return latest_by_aggregate(df, keys, cols)
    if method != "window":
        raise ValueError(f"unknown method {method!r}")
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in cols])
    return df.withColumn(RANK, F.row_number().over(w)).filter(F.col(RANK) == 1).drop(RANK)


def latest_by_aggregate(df: DataFrame, keys: Sequence[str], ordering: Sequence[str]) -> DataFrame:
    """``max_by`` over a struct of the ordering columns.  Struct comparison
    puts NULL fields lowest, which is ``DESC NULLS LAST`` for a maximum."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in ordering])).alias("_row")
    )
    return picked.select(*[F.col(c) for c in df.columns if c in keys],
                         *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
