"""Near-duplicate embeddings by random-hyperplane sign hashing.

Vectors with the same label (not null) and the same number of components are
compared.  Several tables hash every vector to the signs of its products with
seeded random hyperplanes; vectors that share a table's signature are
candidates.  The number of bits follows the number of vectors and the number
of tables follows the bits, so that a pair at the threshold is in no common
bucket with probability ``miss`` at most, whatever the size.

Links are confirmed by the cosine of the original vectors in double
precision.  Equal vectors form a class that one row stands for; class sizes
enter the link counts, so copies never meet.  A bucket is compared in blocks
of ``block`` vectors; each pair of blocks is a group of its own, and a pair
that shares several buckets counts in the first of them only.  Counts and
spanning links leave a group, never its pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and
vectors without a label, link with nothing: n_links 0, component_id the own
vec_id, kept.  Repeated rows are vectors of their own and link with each
other.  A null vec_id is counted but names no component unless no member has
an id (component_id null, kept).  An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import components, ship, stored


def sound(vec: Column) -> Column:
    """True for a vector of finite components that is not all zeros."""
    finite = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def table_plan(count: int, cosine: float, miss: float = 1e-6, per_bucket: int = 64) -> tuple[int, int]:
    """(bits, tables): buckets of about ``per_bucket`` vectors and a pair at
    ``cosine`` missed with probability ``miss`` at most."""
    bits = min(30, max(4, math.ceil(math.log2(max(1, count) / per_bucket)) if count > per_bucket else 4))
    same = (1 - math.acos(min(1.0, cosine)) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - same)) if same < 1 else 1


def planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def signatures(x: np.ndarray, normals: np.ndarray, bits: int) -> np.ndarray:
    """Signature of every row in every table."""
    signs = (x @ normals > 0).reshape(len(x), -1, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2)


def _roots(adjacent: np.ndarray) -> np.ndarray:
    """Smallest reachable index of every row of a symmetric link matrix."""
    root = np.arange(len(adjacent))
    while True:
        low = np.where(adjacent, root[None, :], len(root)).min(axis=1, initial=len(root))
        new = np.minimum(root, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def near_vectors(vectors: DataFrame, cosine: float = 0.98, miss: float = 1e-6, per_bucket: int = 64,
                 block: int = 512, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``
    (vec_id, embedding, label)."""
    ship(vectors.sparkSession)
    keyed = vectors.select("vec_id", "embedding", "label", F.size("embedding").alias("dim"),
                           (sound(F.col("embedding")) & F.col("label").isNotNull()).alias("sound"),
                           F.xxhash64("embedding", "label").alias("k1"),
                           F.xxhash64("label", "embedding", F.lit(1)).alias("k2"))
    cls = (keyed.where("sound").groupBy("k1", "k2", "label", "dim")
           .agg(F.min("vec_id").alias("min_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")))
    own = F.row_number().over(Window.partitionBy(F.coalesce("min_id", "k1")).orderBy("k1", "k2")) == 1
    cls = stored(cls.withColumn("node", F.when(F.col("min_id").isNotNull() & own, F.col("min_id")).otherwise(F.col("k1"))),
                 "vec-classes")
    largest = cls.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = table_plan(largest, cosine, miss, per_bucket)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = np.array(part["embedding"].tolist(), dtype=np.float64)
                sig = signatures(x, planes(int(dim), bits, tables, seed), bits)
                yield pd.DataFrame({"node": part["node"].to_numpy(), "signature": list(sig)})

    signed = stored(cls.select("node", "dim", "embedding").mapInPandas(sign, "node long, signature array<long>"),
                    "vec-signatures")
    placed = (cls.select("node", "label", "dim").join(signed, "node")
              .select("node", "label", "dim", F.posexplode("signature").alias("tab", "sig")))
    buckets = stored(placed.groupBy("label", "dim", "tab", "sig").agg(F.count("*").alias("size")).where("size > 1"),
                     "vec-buckets")
    n_blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    dealt = (placed.join(buckets, ["label", "dim", "tab", "sig"]).withColumn("blocks", n_blocks)
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("label", "dim", "tab", "sig", F.least("own", "other").alias("bi"),
                     F.greatest("own", "other").alias("bj"), "own", "node"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        tab, lo, hi = int(group["tab"].iloc[0]), int(group["bi"].iloc[0]), int(group["bj"].iloc[0])
        group = group.sort_values("node", kind="stable").reset_index(drop=True)
        x = np.array(group["embedding"].tolist(), dtype=np.float64)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        near = x @ x.T >= cosine
        # Two blocks are compared with each other here, each within itself in a group of its own.
        if lo != hi:
            near &= group["own"].to_numpy()[:, None] != group["own"].to_numpy()[None, :]
        np.fill_diagonal(near, False)
        # A pair counts in the first table whose bucket it shares.
        sig = np.array(group["signature"].tolist())
        i, j = np.nonzero(near)
        first = (sig[i] == sig[j]).argmax(axis=1) == tab
        i, j = i[first], j[first]
        near = np.zeros_like(near)
        near[i, j] = True
        at = np.flatnonzero(near.any(axis=1))
        node = group["node"].to_numpy()
        return pd.DataFrame({"node": node[at], "root": node[_roots(near)[at]],
                             "links": (near @ group["copies"].to_numpy())[at]})

    rows = dealt.join(cls.select("node", "copies", "embedding"), "node").join(signed, "node")
    found = stored(rows.groupBy("label", "dim", "tab", "sig", "bi", "bj")
                   .applyInPandas(compare, "node long, root long, links long"), "vec-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vec")
    named = (cls.select("k1", "k2", "label", "dim", "node", "min_id", "copies")
             .join(links, "node", "left").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    least = named.groupBy("root").agg(F.min("min_id").alias("component_id"))
    named = named.join(least, "root").select(
        "k1", "k2", F.col("label").alias("l"), F.col("dim").alias("d"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    named = stored(named, "vec-named")
    own_key = [F.when(F.col("sound"), F.col(c)).alias(c) for c in ("k1", "k2", "label", "dim")]
    out = keyed.select("vec_id", "sound", *own_key).join(
        named.select("k1", "k2", F.col("l").alias("label"), F.col("d").alias("dim"), "component_id", "links"),
        ["k1", "k2", "label", "dim"], "left")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
