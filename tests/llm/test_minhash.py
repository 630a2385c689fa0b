"""Near-duplicate components against all pairs."""

import random

import numpy as np

from strata.llm import minhash


def grams(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def expected(rows):
    """Smallest reachable doc_id by index of row, from all pairs."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return out


def corpus(seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for group in (1, 1, 2, 3, 5, 40, 1, 1):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(20, 120))]
        for _ in range(group):
            w = [rnd.choice(vocab) if rnd.random() < 0.02 else x for x in base]
            rows.append((doc, " ".join(w)))
            doc += 1
    rows += [(doc + i, t) for i, t in enumerate(
        [None, "", " \n\t", "One", "one", "a b c d", "A B  c\x0bd", "a b c d e", rows[4][1], rows[4][1].upper(), "x " * 9000])]
    rnd.shuffle(rows)
    return rows + [(None, rows[0][1]), (None, None), (None, "all alone here"), (3, "another text of doc three, same id"), rows[1]]


def test_components_match_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, n int")
    for block in (256, 3):
        got = [(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, block=block).collect()]
        assert sorted(got, key=str) == sorted(expected(rows), key=str)
    for r in minhash.near_duplicates(df).collect():
        assert r.kept == (r.doc_id == r.component_id)


def test_cross_bucket_links_found_without_a_common_leader(spark):
    # A chain: each is near the next only, so no leader is near all of them.
    words = [f"v{i}" for i in range(400)]
    rows = [(100 - i, " ".join(words[4 * i:4 * i + 60])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()]
    assert sorted(got) == sorted(expected(rows))


def test_signature_estimates_jaccard():
    a, b = np.arange(0, 900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    a, b = minhash.mix(a), minhash.mix(b)
    same = (minhash.signature(a, 2048) == minhash.signature(b, 2048)).mean()
    assert abs(same - 0.8) < 0.05


def test_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n)) for n in (1, 5, 50, 6000, 8000)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert minhash.overlaps(sets, sets).astype(int).tolist() == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).count() == 0
