"""Mixing sources to target word counts by subset-sum budget fitting.

Sources, ordered by code point (null last), carry repeating weights and share
a budget of ``share`` times all sizes.  A target stops at ``limit`` times its
source's size and the excess is reshared by weight until none is above.
Whole passes over a source are taken first; the remaining budget is fitted by
length: documents are counted by exact size, every length gives its
proportional share, and a bounded-knapsack dynamic programme over the left
counts closes all of the rest, whatever its size: a rest beyond ``table_bits``
words is counted in units (lengths rounded up to them), and what rounding leaves
is fitted again in smaller ones, down to single words.  Which documents of a
length are taken follows a seeded hash, so reruns agree.

Scale: documents are reduced to (doc_id, source, size) in one scan and stored.
Only counts by (source, size, hash bucket) are shuffled for the fit; a source
holding a third of all rows is a few thousand counted lengths.  Documents are
ranked within (source, size, bucket), never within a whole source, and only
the one bucket where a length's quota ends needs the ranks.

Null text has size 0, as has an empty one: such documents are taken in whole
passes only, which adds no words.  Repeated rows count each.  Null doc_ids
rank first among equal hashes.  An empty table gives an empty result.  Very long
texts are counted whole, in one more string of at most their size.  Only
doc_id, text and source are read; other columns never clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship, stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Words of a text: each becomes one letter, then white space goes."""
    letters = F.translate(F.regexp_replace(text, WORD, "w"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
            limit: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Water filling in closed form: with sources ordered by size per weight, a
    prefix is capped; the rest shares what is left by weight.  One row a
    source is ordered here, not documents.
    """
    n = len(weights)
    pos = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("pos") % n + 1).cast("int"))
    s = sources.withColumn("pos", pos).withColumn("w", w)
    s = s.withColumn("cap", limit * F.col("source_size"))
    by = Window.orderBy(F.col("cap") / F.col("w"), "pos")
    s = s.withColumn("before", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("rest_w", F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("budget", share * F.sum("source_size").over(Window.partitionBy()))
    # The level at which this source would be the first uncapped one.
    s = s.withColumn("level", (F.col("budget") - F.col("before")) / F.col("rest_w"))
    s = s.withColumn("level", F.max(F.when(F.col("cap") >= F.col("level") * F.col("w"), F.col("level")))
                     .over(Window.partitionBy()))
    return s.select("source", "source_size",
                    F.coalesce(F.least("cap", F.col("level") * F.col("w")), F.col("cap")).alias("target"))


TABLE_BITS = 1 << 22
KEEP_EVERY = 32


def best_below(sizes: np.ndarray, room: np.ndarray, goal: int) -> np.ndarray:
    """How many of each size (at most ``room``) make the largest sum up to ``goal``.

    Reachable sums are the bits of one integer; counts are split into powers of two.
    Every ``KEEP_EVERY``-th table is kept, those between are made again on the way
    back, so memory is a fraction of all tables."""
    take = np.zeros(len(sizes), dtype=np.int64)
    mask, reach, steps, kept = (1 << (goal + 1)) - 1, 1, [], [1]
    for i in np.argsort(-sizes):
        size = int(sizes[i])
        if not 0 < size <= goal:
            continue
        left, part = min(int(room[i]), goal // size), 1
        while left > 0:
            part = min(part, left)
            steps.append((i, part))
            reach = (reach | reach << (part * size)) & mask
            if len(steps) % KEEP_EVERY == 0:
                kept.append(reach)
            left -= part
            part *= 2
        if reach >> goal & 1:
            break
    at = reach.bit_length() - 1
    for block in reversed(range(0, len(steps), KEEP_EVERY)):
        tables, now = [], kept[block // KEEP_EVERY]
        for i, part in steps[block:block + KEEP_EVERY]:
            tables.append(now)
            now = (now | now << (part * int(sizes[i]))) & mask
        for (i, part), before in zip(reversed(steps[block:block + KEEP_EVERY]), reversed(tables)):
            if not before >> at & 1:
                take[i] += part
                at -= part * int(sizes[i])
    return take


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, table_bits: int = TABLE_BITS) -> np.ndarray:
    """How many of each length to take so that the sum comes near ``budget``,
    from below, with at most ``counts`` of each."""
    total = int((lengths * counts).sum())
    if budget <= 0 or total <= 0:
        return np.zeros(len(lengths), dtype=np.int64)
    if budget >= total:
        return counts.astype(np.int64)
    take = np.floor(counts * (budget / total)).astype(np.int64)
    left = budget - int((lengths * take).sum())
    while left > 0:
        unit = -(-left // table_bits)
        more = best_below(-(-lengths // unit), counts - take, left // unit)
        if unit > 1 and not more.any():  # rounding up leaves no length that fits: the longest that truly does
            fits = np.flatnonzero((lengths <= left) & (counts > take) & (lengths > 0))
            if len(fits):
                more[fits[np.argmax(lengths[fits])]] = 1
        gained = int((lengths * more).sum())
        take, left = take + more, left - gained
        if unit == 1 or not gained:
            break
    return take


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, limit: float = 2.0,
        seed: int = 17, buckets: int = 64, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per document,
    and the ``carry`` columns of ``docs``."""
    ship(docs.sparkSession)
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    sized = stored(docs.select("doc_id", "source", *carry, word_count(F.col("text")).alias("size"))
                   .withColumn("order", order).withColumn("bucket", F.pmod("order", F.lit(buckets)).cast("int")),
                   "mix-sizes")
    hist = stored(sized.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "mix-counts")
    total = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    goal = targets(total, weights, share, limit)
    # Whole passes over the source, then a subset of the rest.
    goal = goal.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("long"))
    goal = stored(goal.withColumn("rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")),
                  "mix-goals")

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        rows["quota"] = fit_counts(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), int(rows["rest"].iloc[0]))
        return rows[["source", "size", "quota"]]

    # One group a source: its distinct lengths with counts, not its documents.
    lengths = hist.groupBy("source", "size").agg(F.sum("n").alias("n"))
    quota = (lengths.join(goal.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
             .select("source", "size", "n", "rest")
             .groupBy("source").applyInPandas(fitted, "source string, size long, quota long"))
    q = (hist.join(quota.select(F.col("source").alias("s"), F.col("size").alias("z"), "quota"),
                   F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z"))
    run = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    q = q.withColumn("room", F.col("quota") - F.coalesce(F.sum("n").over(run), F.lit(0)))
    q = (q.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    q = stored(q.select(F.col("source").alias("qs"), F.col("size").alias("qz"), F.col("bucket").alias("qb"),
                        "n", "room", "passes", "source_size", "target"), "mix-quotas")
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("order", "doc_id"))
    out = (sized.withColumn("rank", rank)
           .join(q, F.col("source").eqNullSafe(F.col("qs")) & (F.col("size") == F.col("qz"))
                 & (F.col("bucket") == F.col("qb"))))
    copies = F.col("passes") + F.when(F.col("rank") <= F.col("room"), 1).otherwise(0)
    return out.select("doc_id", "source", *carry, "size", "source_size", "target",
                      copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
