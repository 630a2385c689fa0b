"""Property tests: latest-per-key and the partition split against brute force
on generated versions (repeated keys, NULL keys, tied timestamps, NULLs)."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from strata.operators import latest, partition_split
from strata.operators.quality import silver_by
from strata.spec import Rule

SCHEMA = "k string, ingested_at timestamp, batch_id string, v int"
RULES = (Rule("has_v", "v IS NOT NULL"), Rule("small_v", "v < 8"))

rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from([dt.datetime(2024, 1, 1, h) for h in (8, 9)] + [None]),
        st.sampled_from(["b1", "b2", None]),
        st.one_of(st.none(), st.integers(0, 9)),
    ),
    min_size=1, max_size=30,
)

PROPS = settings(max_examples=12, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def _desc_nulls_last(values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def _brute_latest(data):
    """Newest per key: ingested_at, then batch_id, then v, each descending
    with NULLs last; whole-row ties are identical rows."""
    best = {}
    for r in data:
        rank = _desc_nulls_last(r[1:])
        if r[0] not in best or rank > best[r[0]][0]:
            best[r[0]] = (rank, r)
    return sorted((r for _, r in best.values()), key=repr)


def _rows(df):
    return sorted((tuple(r) for r in df.select("k", "ingested_at", "batch_id", "v").collect()), key=repr)


@PROPS
@given(data=rows)
def test_latest_plans_match_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    want = _brute_latest(data)
    for method in ("window", "aggregate"):
        assert _rows(latest(df, ["k"], ["ingested_at"], None, method)) == want, method


def _passes(r):
    return r[3] is not None and r[3] < 8


@PROPS
@given(data=rows)
def test_partition_split_labels_every_row_once(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    split = partition_split(df, ["k"], ["ingested_at"], RULES).collect()
    assert len(split) == len(data)
    labelled = [((r.k, r.ingested_at, r.batch_id, r.v), r.label) for r in split]
    winners = _brute_latest(data)
    assert sorted((t for t, lab in labelled if lab == "quarantine"), key=repr) == \
        sorted((r for r in data if not _passes(r)), key=repr)
    silver_rows = sorted((t for t, lab in labelled if lab == "silver"), key=repr)
    assert silver_rows == sorted((r for r in winners if _passes(r)), key=repr)
    assert silver_rows == _rows(silver_by(df, ["k"], ["ingested_at"], RULES))
    # Superseded: every passing version except its key's newest (as multisets,
    # since whole-row duplicates are possible).
    superseded = Counter(t for t, lab in labelled if lab == "superseded")
    assert superseded == Counter(r for r in data if _passes(r)) - Counter(r for r in winners if _passes(r))
