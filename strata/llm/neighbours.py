"""Approximate nearest neighbours over learned partitions.

Learning, on a seeded sample of at most ``sample`` vectors (a documented bound;
the sample is all that reaches the driver): the neighbour graph of the sample
is cut into partitions of even size by label propagation under a capacity,
and a small softmax classifier learns to tell a vector's partition.  The
number of partitions routed to is the smallest that finds ``aim`` of the true
neighbours of sample vectors within the sample.  Partitions and router know
directions only; true neighbours are those by inner product of the vectors as
given, so the longer the longest vectors are, the more partitions are visited.

From ``FEW`` vectors on, their number's square root is the number of partitions, up
to ``MOST_PARTS`` (a sample of this size tells no more apart); beyond that,
partitions grow.

Index: every vector, not only the sample, goes to its most probable partition.
Search: a query goes to its most probable partitions, and to further ones
until they hold enough candidates; there it is compared with every vector by
inner product in double precision.  Partitions of any size are dealt into
blocks of ``block`` vectors and ``query_block`` queries, so a vector that a
third of all rows repeat loads many small groups, not one.  A partition's vectors
are sent once for each block of the queries routed there, not of all queries.  The most
probable sixteenth of the partitions is searched first; a query's k-th best score
there is the floor that candidates of its other partitions must reach to leave
their group.  Groups return their best ``k`` a query; the last step merges these.

Vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without vec_id.  Each number of components is a search of
its own, so a query meets the vectors it can be compared with.  A query's own row
is any with its vec_id.  Equal scores order by vec_id.  Repeated queries are
asked once (a vec_id with several numbers of components once in each); repeated
candidates stay.  With fewer
than ``k`` candidates all are returned; an empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import HASH_RANGE, hash_share, ship, stored
from strata.llm.vector_dedup import sound

MOST_PARTS = 256
FEW = 512


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Each row's ``degree`` nearest other rows by inner product."""
    out = np.empty((len(x), degree), dtype=np.int64)
    for at in range(0, len(x), 1024):
        s = x[at:at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 1024] = np.argpartition(-s, degree - 1, axis=1)[:, :degree]
    return out


def _halves(x: np.ndarray, ids: np.ndarray, parts: int, out: np.ndarray, first: int) -> None:
    """Even starting partition: median cuts along the widest direction."""
    if parts == 1:
        out[ids] = first
        return
    y = x[ids] - x[ids].mean(axis=0)
    side = y @ np.linalg.eigh(y.T @ y)[1][:, -1]
    order = ids[np.argsort(side, kind="stable")]
    cut = len(order) * (parts // 2) // parts
    _halves(x, order[:cut], parts // 2, out, first)
    _halves(x, order[cut:], parts - parts // 2, out, first + parts // 2)


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.05,
                       rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Partition of every row: rows move to the partition most of their graph
    neighbours are in, while it has room."""
    n = len(x)
    part = np.zeros(n, dtype=np.int64)
    _halves(x, np.arange(n), parts, part, 0)
    room = int(np.ceil(slack * n / parts))
    src = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    dst = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        votes = np.zeros((n, parts), dtype=np.int32)
        np.add.at(votes, (src, part[dst]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in rng.permutation(np.flatnonzero(gain > 0)):
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < n // 200:
            break
    return part


def fit_router(x: np.ndarray, part: np.ndarray, parts: int, steps: int = 250, rate: float = 0.05) -> np.ndarray:
    """Softmax weights (components + 1, parts), fitted by Adam."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros((xb.shape[1], parts))
    m, v = np.zeros_like(w), np.zeros_like(w)
    goal = np.eye(parts)[part]
    for t in range(1, steps + 1):
        p = router_scores(x, w)
        p = np.exp(p - p.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = xb.T @ (p - goal) / len(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def router_scores(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def probes_for(x: np.ndarray, w: np.ndarray, k: int, aim: float, seed: int = 4) -> int:
    """Partitions to visit so that sample vectors find ``aim`` of their ``k``
    nearest sample vectors by inner product; ``x`` as given, not scaled."""
    parts = w.shape[1]
    scores = router_scores(_units(x), w)
    home = scores.argmax(axis=1)
    some = np.random.default_rng(seed).permutation(len(x))[:512]
    s = x[some] @ x.T
    s[np.arange(len(some)), some] = -np.inf
    near = np.argpartition(-s, min(k, len(x) - 1) - 1, axis=1)[:, :min(k, len(x) - 1)]
    rank = np.empty((len(some), parts), dtype=np.int64)
    np.put_along_axis(rank, np.argsort(-scores[some], axis=1), np.arange(parts)[None, :], axis=1)
    need = np.take_along_axis(rank, home[near], axis=1)
    found = np.array([(need <= p).mean() for p in range(parts)])
    return int(np.argmax(found >= aim)) + 1 if (found >= aim).any() else parts


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def search(vectors: DataFrame, is_query: Column, k: int = 20, sample: int = 8192, per_partition: int = 1024,
           aim: float = 0.97, block: int = 4096, query_block: int = 4096, seed: int = 9) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query.

    ``vectors``: vec_id, embedding; ``is_query``: a condition on vec_id.
    """
    spark = vectors.sparkSession
    ship(spark)
    usable = (vectors.where("vec_id is not null").where(sound(F.col("embedding")))
              .select("vec_id", F.col("embedding").alias("x"), F.size("embedding").alias("dim")))
    sizes = (usable.groupBy("dim").agg(F.count("*").alias("rows"), F.count_if(is_query).alias("asked"))
             .where("asked > 0").orderBy("dim").collect())  # one row a number of components
    if len(sizes) > 1:
        usable = stored(usable, "ann-usable")
    found = [_search(usable.where(F.col("dim") == r.dim).select("vec_id", "x"), is_query, r.dim, r.rows, k, sample,
                     per_partition, aim, block, query_block, seed) for r in sizes]
    return (reduce(DataFrame.unionByName, found) if found
            else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double"))


def _search(usable: DataFrame, is_query: Column, dim: int, count: int, k: int, sample: int, per_partition: int,
            aim: float, block: int, query_block: int, seed: int) -> DataFrame:
    """``search`` among the ``count`` vectors (vec_id, x) of ``dim`` components."""
    order = F.xxhash64(F.lit(seed), "vec_id")
    place = F.pmod(order, F.lit(HASH_RANGE))
    # Twice the wanted vectors by hash, then exactly the wanted ones.
    picked = usable.where(place < hash_share(count, sample)).orderBy(place, "vec_id").limit(sample)
    x = np.array([r.x for r in picked.toLocalIterator()], dtype=np.float64).reshape(-1, dim)  # at most ``sample`` vectors
    parts = int(min(MOST_PARTS, max(1, count // per_partition, math.isqrt(count) if count >= FEW else 1), max(1, len(x) // 32)))
    if parts > 1:
        u = _units(x)
        w = fit_router(u, balanced_partition(u, neighbour_graph(u, min(12, len(u) - 1)), parts), parts)
        # The k nearest of all vectors are so many of a sample's.
        probes = probes_for(x, w, max(1, k * len(x) // count), aim)
    else:
        w, probes = np.zeros((dim + 1, 1)), 1

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y = np.array(batch["x"].tolist(), dtype=np.float64).reshape(-1, dim)
            yield batch.assign(part=router_scores(_units(y), w).argmax(axis=1).astype(np.int32))

    kind = usable.schema["x"].dataType.simpleString()
    index = stored(usable.mapInPandas(placed, f"vec_id long, x {kind}, part int"), "ann-index")
    held = {r.part: r["count"] for r in index.groupBy("part").count().collect()}  # one row a partition
    size = np.array([held.get(p, 0) for p in range(parts)])
    asked = (index.where(is_query).groupBy("vec_id").agg(F.min("x").alias("x")))

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y = np.array(batch["x"].tolist(), dtype=np.float64).reshape(-1, dim)
            order = np.argsort(-router_scores(_units(y), w), axis=1, kind="stable")
            enough = size[order].cumsum(axis=1) - size[order] <= k
            visit = enough | (np.arange(parts)[None, :] < probes)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "x": batch["x"],
                                "parts": [o[v].astype(np.int32) for o, v in zip(order, visit)]})

    # Blocks: vectors and queries of a partition, each dealt by hash; a partition's vectors meet only queries routed to it.
    rows_in = F.element_at(F.lit([int(max(1, -(-n // block))) for n in size]), F.col("part") + 1)
    q = stored(asked.mapInPandas(routed, f"vec_id long, x {kind}, parts array<int>"), "ann-queries")
    early = -(-parts // 16)
    each = q.select("vec_id", "x", F.posexplode("parts").alias("nth", "part"))
    late = (F.col("nth") >= early).alias("late")
    routes = {(r.late, r.part): r["count"] for r in each.groupBy(late, "part").count().collect()}  # two rows a partition

    def query_blocks(phase: bool) -> Column:
        """How many blocks of queries visit the row's partition."""
        return F.element_at(F.lit([-(-routes.get((phase, p), 0) // query_block) for p in range(parts)]), F.col("part") + 1)

    def rows_for(phase: bool) -> DataFrame:
        """Index rows, once for each block of queries that visits their partition."""
        return (index.where(query_blocks(phase) > 0)
                .select("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), rows_in).cast("int").alias("rb"),
                        F.explode(F.sequence(F.lit(0), query_blocks(phase) - 1)).alias("qb"),
                        F.lit(False).alias("asks"), "vec_id", "x", F.lit(None).cast("double").alias("floor")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        rows = group[~group["asks"]].sort_values("vec_id", kind="stable")
        asks = group[group["asks"]]
        if not len(rows) or not len(asks):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        y = np.array(rows["x"].tolist(), dtype=np.float64)
        ids = rows["vec_id"].to_numpy()
        out = []
        for query, v, least in zip(asks["vec_id"].to_numpy(), np.array(asks["x"].tolist(), dtype=np.float64),
                                   asks["floor"].fillna(-np.inf).to_numpy()):
            s = y @ v
            s[ids == query] = -np.inf
            floor = max(least, np.partition(s, -k)[-k] if len(s) > k else -np.inf)
            # Candidates near the floor are scored anew in a fixed order of addition.
            at = np.flatnonzero((s >= floor - 1e-9 * (1 + abs(floor))) & (s > -np.inf)) if floor > -np.inf \
                else np.flatnonzero(s > -np.inf)
            exact = (y[at] * v).sum(axis=1)
            top = np.argsort(-exact, kind="stable")[:k]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[at[top]], "score": exact[top]}))
        return pd.concat(out)

    def searched(queries: DataFrame, phase: bool) -> DataFrame:
        qb = F.pmod(F.xxhash64("vec_id"), query_blocks(phase)).cast("int").alias("qb")
        asks = queries.select("part", F.explode(F.sequence(F.lit(0), rows_in - 1)).alias("rb"), qb,
                              F.lit(True).alias("asks"), "vec_id", "x", "floor")
        return (asks.unionByName(rows_for(phase)).groupBy("part", "rb", "qb")
                .applyInPandas(compare, "query_id long, vec_id long, score double"))

    first = stored(searched(each.where(~late).withColumn("floor", F.lit(None).cast("double")), False), "ann-first")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"))
    floors = (first.withColumn("n", F.row_number().over(by_score)).where(F.col("n") == k)
              .select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor")))
    later = each.where(late).join(floors, "vec_id", "left")
    best = first.unionByName(searched(later, True)) if parts > early else first
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
