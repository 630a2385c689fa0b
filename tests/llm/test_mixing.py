"""Budget fitting against exhaustive search, targets against step-by-step resharing."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import mixing


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 3)), min_size=1, max_size=5, unique_by=lambda x: x[0]),
       st.integers(0, 60))
def test_fit_counts_is_the_best_sum_below(items, budget):
    lengths, counts = np.array([x[0] for x in items]), np.array([x[1] for x in items])
    take = mixing.fit_counts(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    got = int((lengths * take).sum())
    free = [range(c + 1) for c in counts]
    start = np.floor(counts * min(1, budget / max(1, (lengths * counts).sum()))).astype(int)
    best = max(int((lengths * c).sum()) for c in itertools.product(*free)
               if (lengths * c).sum() <= budget and (np.array(c) >= start).all())
    assert got == best


@pytest.mark.parametrize("lengths, counts, budget, want", [
    ([599_000, 700_000], [1, 1], 600_000, 599_000),
    ([400, 600, 599_000, 700_000], [1, 1, 1, 1], 600_000, 600_000),
    ([5_000_000, 9_000_000], [3, 1], 5_000_100, 5_000_000),
    ([700_000], [1], 600_000, 0),
])
def test_long_documents_close_a_large_rest(lengths, counts, budget, want):
    lengths, counts = np.array(lengths), np.array(counts)
    take = mixing.fit_counts(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    assert int((lengths * take).sum()) == want


@pytest.mark.parametrize("lengths, counts, budget, want", [
    ([900_000, 700_000, 650_000], [1, 1, 1], 1_350_000, 1_350_000),
    ([400_000, 450_000, 700_000], [2, 1, 1], 800_000, 800_000),
    ([8_388_609], [2], 8_388_609, 8_388_609),
])
def test_no_rest_is_too_large_for_the_programme(lengths, counts, budget, want):
    lengths, counts = np.array(lengths), np.array(counts)
    assert int((lengths * mixing.fit_counts(lengths, counts, budget)).sum()) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(20_000, 900_000), min_size=3, max_size=6, unique=True), st.integers(1, 2_000_000))
def test_few_long_documents_are_fitted_exactly(sizes, budget):
    lengths, counts = np.array(sizes), np.ones(len(sizes), dtype=int)
    got = int((lengths * mixing.fit_counts(lengths, counts, budget)).sum())
    sums = [sum(c) for k in range(len(sizes) + 1) for c in itertools.combinations(sizes, k)]
    assert got == max(x for x in sums if x <= budget)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 5)), min_size=1, max_size=30, unique_by=lambda x: x[0]),
       st.integers(1, 700), st.integers(8, 64))
def test_units_come_near_and_never_above(items, budget, bits):
    lengths, counts = np.array([x[0] for x in items]), np.array([x[1] for x in items])
    take = mixing.fit_counts(lengths, counts, budget, table_bits=bits)
    got = int((lengths * take).sum())
    assert (take >= 0).all() and (take <= counts).all() and got <= max(budget, 0)
    # Nothing that is left would still fit.
    assert got == int((lengths * counts).sum()) or not ((lengths <= budget - got) & (counts > take)).any()


def test_words_without_an_array(spark):
    texts = ["", " ", "a", " a b\tc\nd\x0be\x0cf\rg ", "é\u00a0x w ww", None, "\x1f \x00"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count("t").alias("n")).collect()
    assert [r.n for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def by_steps(sizes, weights, share=1.5, limit=2.0):
    """Reshare the excess by weight until no target is above its limit."""
    target, capped = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(limit * sizes[s] for s in capped)
        open_w = sum(weights[s] for s in sizes if s not in capped)
        target = {s: limit * sizes[s] if s in capped else left * weights[s] / open_w for s in sizes}
        over = {s for s in sizes if s not in capped and target[s] > limit * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 70}, {"a": 1}, {"a": 10, "b": 10, "c": 10, "d": 900, None: 40},
                                   {"Z": 3, "a": 0, "é": 7}])
def test_targets(spark, sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = by_steps(sizes, weights)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def documents(spark):
    words = lambda n: " ".join("w" * (1 + i % 7) for i in range(n))
    data = [(i, words(3 + i * 7 % 41), f"s{i % 3}", "x") for i in range(300)]
    data += [(1000 + i, words(10), "hot", "x") for i in range(200)]
    data += [(2000, None, "s0", "x"), (2001, "", None, "x"), (None, "a\x0bb c", None, "x"), (7, words(11), "s1", "x")]
    return spark.createDataFrame(data, "doc_id long, text string, source string, target string"), data


def test_mix(spark):
    df, data = documents(spark)
    got = mixing.mix(df).collect()
    assert len(got) == len(data)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r["size"] for r in got) == sorted(size(d[1]) for d in data)
    for s in {d[2] for d in data}:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sum(size(d[1]) for d in data if d[2] == s)}
        assert all(r.taken == r.copies * r["size"] <= 2 * r["size"] for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r["size"] for r in mine)
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_empty_and_wordless(spark):
    df, _ = documents(spark)
    assert mixing.mix(df.where("false")).count() == 0
    none = mixing.mix(df.where("text is null or text = ''")).collect()
    assert [(r["size"], r.taken) for r in none] == [(0, 0)] * 2
