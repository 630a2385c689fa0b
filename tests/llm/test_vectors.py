"""Embedding links and nearest neighbours against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import neighbours, vector_dedup

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, node string, n_links int"


def corpus(seed=1, n=240, dim=12):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 6, dim)).astype(np.float32)
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] + rng.standard_normal(dim).astype(np.float32) * rng.choice([0, 0.02, 0.15, 0.5])
        rows.append([i, [float(np.float32(x)) for x in v * np.float32(rng.choice([1, 2.5]))], int(rng.integers(3))])
    rows += [[1000 + i, rows[0][1], rows[0][2]] for i in range(30)]
    rows += [[2000, None, 1], [2001, [0.0] * dim, 1], [2002, [NAN] + [1.0] * (dim - 1), 1], [2003, [INF] + [1.0] * (dim - 1), 1],
             [2004, [None] + [1.0] * (dim - 1), 1], [2005, rows[5][1], None], [2006, [], 1], [2007, [1.0, 2.0], 1],
             [2008, [1.0, 2.0], 1], [None, rows[7][1], rows[7][2]], rows[9]]
    return [tuple(r) + ("x", 0) for r in rows]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_links_and_components_match_all_pairs(spark):
    rows = corpus()
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if usable(a[1]) and usable(b[1]) and a[2] is not None and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    want = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        comp = min(ids) if ids and usable(r[1]) and r[2] is not None else r[0]
        want.append((r[0], links[i], comp, r[0] == comp))
    df = spark.createDataFrame(rows, SCHEMA)
    for block, per_bucket in ((512, 64), (4, 16)):
        got = [tuple(r) for r in vector_dedup.near_vectors(df, block=block, per_bucket=per_bucket).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("count", [0, 10, 10**4, 10**7, 10**10])
def test_table_plan_keeps_the_miss_bound(count):
    bits, tables = vector_dedup.table_plan(count, 0.98)
    same = (1 - math.acos(0.98) / math.pi) ** bits
    assert (1 - same) ** tables <= 1e-6


def brute(rows, query, k):
    q = next(r for r in rows if r[0] == query)
    x = np.array(q[1], float)
    scored = [(-float(np.array(r[1], float) @ x), r[0]) for r in rows
              if r[0] is not None and r[0] != query and usable(r[1]) and len(r[1]) == len(q[1])]
    return sorted(scored)[:k]


def test_search_is_exact_when_all_partitions_are_visited(spark):
    rows = [r for r in corpus(seed=2) if r[0] != 9]
    got = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=5, block=32, query_block=4)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    asked = {r[0] for r in rows if r[0] is not None and r[0] % 20 == 0 and usable(r[1]) and len(r[1]) == 12}
    assert found.keys() == asked
    for q, hits in found.items():
        hits.sort()
        assert [h[0] for h in hits] == [1, 2, 3, 4, 5]
        want = brute(rows, q, 5)
        assert np.allclose([h[1] for h in hits], [w[0] for w in want])
        assert [h[2] for h in hits] == [w[1] for w in want]


def test_learned_partitions_reach_recall(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 16))
    x[1000:2000] = x[1000]  # a third of all rows are one vector
    rows = [(i, [float(a) for a in v], 0, "x", 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, per_partition=250, sample=1500).toPandas()
    x32 = x.astype(np.float32).astype(float)
    hit = 0
    for q, g in got.groupby("query_id"):
        s = x32 @ x32[q]
        s[q] = -np.inf
        floor = np.sort(s)[-20]
        assert sorted(g["rank"]) == list(range(1, 21))
        hit += (g["score"] >= floor - 1e-9).sum()
    assert hit / (20 * 150) >= 0.9


def test_recall_holds_with_unequal_norms(spark):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((3000, 32))
    x *= (np.exp(0.8 * rng.standard_normal(3000)) / np.sqrt((x * x).sum(axis=1)))[:, None]
    x[:, :4] *= 3
    df = spark.createDataFrame([(i, [float(a) for a in v], 0, "x", 0) for i, v in enumerate(x)], SCHEMA)
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, per_partition=125, sample=1500).toPandas()
    x32 = x.astype(np.float32).astype(float)
    hit = 0
    for q, g in got.groupby("query_id"):
        s = x32 @ x32[q]
        s[q] = -np.inf
        hit += (g["score"] >= np.sort(s)[-20] - 1e-9).sum()
    assert hit / (20 * 150) >= 0.9


def test_every_query_meets_the_vectors_of_its_dimension(spark):
    rng = np.random.default_rng(12)
    rows = [(i, [float(np.float32(a)) for a in rng.standard_normal(3 + i // 20 % 3)], 0, "x", 0) for i in range(300)]
    rows.append((400, [1.0] * 9, 0, "x", 0))
    got = {}
    for r in neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(got) == list(range(0, 300, 20))
    for q, hits in got.items():
        assert [h[1] for h in sorted(hits)] == [w[1] for w in brute(rows, q, 5)]


def test_balanced_partition_is_balanced():
    x = np.random.default_rng(1).standard_normal((500, 8))
    part = neighbours.balanced_partition(x, neighbours.neighbour_graph(x, 10), 7)
    assert np.bincount(part, minlength=7).max() <= math.ceil(1.05 * 500 / 7)


def test_few_candidates_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1, "", 0), (20, [0.5, 0.5], 1, "", 0), (3, [0.0, 1.0], 2, "", 0)], SCHEMA)
    got = sorted(tuple(r) for r in neighbours.search(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 20, 0.5), (0, 2, 3, 0.0), (20, 1, 0, 0.5), (20, 2, 3, 0.5)]
    none = df.where("false")
    assert neighbours.search(none, F.col("vec_id") % 20 == 0).count() == 0
    assert vector_dedup.near_vectors(none).count() == 0
