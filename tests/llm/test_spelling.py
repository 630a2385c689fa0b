"""Spelling variants against a scan over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import spelling
from strata.llm.queries import op11_spelling

DOCS = "doc_id long, text string, lang string, word string, id string"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, factor=5):
    form, out = {}, []
    for w, n in words.items():
        mates = sorted((x for x in words if x != w and near(w, x)), key=lambda x: (-words[x], x))
        form[w] = mates[0] if mates and words[mates[0]] >= factor * n else None
        out.append((w, n, len(mates)))
    rows = set()
    for w, n, k in out:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, k, words.get(form[w])))
    return rows


def lowered(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def words_of(rows, slip=199):
    seen = Counter()
    for doc_id, text in rows:
        for run in map(lowered, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run[:h % len(run)] + run[h % len(run) + 1:] if h % slip == 0 else run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def grouped(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("seed", range(3))
def test_same_as_all_pairs(spark, seed):
    r = random.Random(seed)
    words = {"".join(r.choices("abé", k=r.randint(1, 7))): r.choice([1, 1, 2, 5, 6, 30, 31, 200, 5000]) for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # borders between tasks
    try:
        assert grouped(spelling.group_variants(df)) == brute(words)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nodes_are_one_trie(spark):
    """Equal prefixes have one number in all tasks, different ones different numbers."""
    words = sorted({a + b + c for a in ("abcde", "abcd", "abx") for b in ("", "q", "qq", "r") for c in ("", "1", "12", "z")})
    df = spark.createDataFrame([(w,) for w in words], "key string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done, names = spelling.trie_paths(df, "test-trie")
        seen = {}
        for row in done.collect():
            for i, node in enumerate(spelling.final_nodes(row.part, __import__("numpy").array(row.path), names).tolist(), 1):
                seen.setdefault(row.key[:i], set()).add(node)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(names) > 1
    assert all(len(n) == 1 for n in seen.values())
    assert len(set.union(*seen.values())) == len(seen)


def test_whole_texts_with_edges(spark, tmp):
    r = random.Random(5)
    base = ["Meaning", "meanings", "TRAINING", "Àé×÷word", "straining", "letters", "lettersx", "letterz"]
    rows = [(i, " ".join(r.choices(base, k=60)), "en", "x", "y") for i in range(40)]
    rows += [(None, None, None, None, None), (None, "meaning meanimg meanimg meanimg meanimg meanimg", None, None, None), (3, "", None, None, None)]
    rows += [(50, "a" * 3000 + " ", None, None, None)] * 6 + [(51, "a" * 2999 + "-", None, None, None)] * 40
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp}/documents.parquet")
    got = grouped(op11_spelling(spark, tmp))
    want = brute(words_of([x[:2] for x in rows]))
    assert got == want
    assert any(len(w[0]) > 2000 and w[1] for w in got)
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp}/empty/documents.parquet")
    assert op11_spelling(spark, f"{tmp}/empty").count() == 0


def test_hot_group_stays_small(spark):
    """Words that share a pair: no more rows than the dictionary itself."""
    words = {"prefix" + chr(0x61 + i) + "suffix": i + 1 for i in range(26)} | {"prefixsuffix": 1000}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    _, pairs = spelling.node_pairs(df, "test-hot")
    assert pairs.count() == sum(2 * len(w) + 1 for w in words)
    assert grouped(spelling.group_variants(df)) == brute(words)
    assert {x.n_near for x in spelling.near_words(pairs).collect()} == {26}
