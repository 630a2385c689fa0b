"""License scans: counted phrases against a plain scan, the method's rules by example."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import licenses
from strata.llm.queries import LICENSE_PHRASES, op13_licenses

DOCS = "doc_id long, text string, labels string, row long, key string"


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(licenses.WORD, low)
    places = [(i, label) for phrase, label in LICENSE_PHRASES for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def scanned(spark, rows):
    df = spark.createDataFrame([r + ("x", 7, "k") for r in rows], DOCS)
    return licenses.scan(df, LICENSE_PHRASES).collect()


def test_counted_phrases(spark):
    r = random.Random(4)
    parts = ["mit", "License", "apache", "general", "public", "GPL", "the", "é", ",", ".", "\n", "-", "licenses", "gnu", "LICENSE",
             "mit license", "Apache-License", "General  Public\tLicense", "\x00", "٣", "K"]
    rows = [(i, " ".join(r.choices(parts, k=r.randint(0, 60)))) for i in range(200)]
    rows += [(None, None), (900, ""), (901, " .. "), (902, "x " * 60_000 + "MIT license"), (902, "MIT license"), (902, "MIT license")]
    got = scanned(spark, rows)
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((g.doc_id, g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) for g in got), key=key) == \
        sorted(((i, *plain(t)) for i, t in rows), key=key)
    for g in got:
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(","))
        assert 0 <= g.score <= 1 and (g.score > 0) == bool(g.labels)


EXAMPLES = {
    "Licensed under the Apache License, Version 2.0 (the \"License\")": ("apache", 1.0),
    "SPDX-License-Identifier: BSD-3-Clause": ("bsd-3-clause", 1.0),
    "Released under the terms of the GNU Lesser General Public License, version 2.1": ("gpl,lgpl", 1.0),  # gpl is a counted phrase
    "see the Mozilla Public Licence": ("mpl", 0.9),
    "the code is GPLv3": ("gpl", 0.7),
    "distributed under the GNU GPL v3 or later": ("gpl", 1.0),
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": ("mit", 1.0),
    "Creative Commons Attribution-ShareAlike License 4.0": ("cc-by-sa", 0.9),
    "All rights reserved.": ("proprietary", 0.9),
    "my driver's license and a fishing licence": ("", 0.0),
    "er kam mit der Lizenz": ("", 0.0),
    "the BSD 2-Clause License": ("bsd-2-clause", 0.7),
}


def test_rules_by_example(spark):
    texts = list(EXAMPLES)
    got = {g.doc_id: (g.labels, g.score) for g in scanned(spark, list(enumerate(texts)))}
    assert {texts[i]: v for i, v in got.items()} == EXAMPLES


def test_rules_are_sound():
    rules = licenses.signatures(LICENSE_PHRASES)
    assert 300 <= len(rules)
    anchors = set(licenses.anchors(LICENSE_PHRASES))
    for r in rules:
        assert r.pattern.count(licenses.MARK) == 1
        marked = re.search(licenses.MARK + r"([a-z0-9\[\]?]+)", r.pattern).group(1)
        assert any(re.fullmatch(marked, a) for a in anchors)
        assert len(re.sub(r"\?", "", r.pattern).split()) <= licenses.REACH + 8
    with pytest.raises(ValueError):
        licenses.signatures([("MIT license", "x")])


def test_suppression(spark):
    rows = [(1, 0, 9, 0, 2, "long"), (1, 2, 4, 1, 2, "inside"), (1, 2, 5, 2, 1, "better"), (1, 5, 12, 3, 3, "overlaps"),
            (1, 0, 9, 4, 2, "same"), (1, 0, 9, 5, 3, "worse"), (1, 3, 4, 6, 0, "counted"), (2, 2, 4, 1, 2, "other row")]
    df = spark.createDataFrame(rows, "row long, start int, stop int, rule int, rank int, label string")
    assert {r.label for r in licenses.standing(df).collect()} == {"long", "better", "overlaps", "counted", "other row"}


def test_empty_table_and_no_collect(spark, tmp):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp}/documents.parquet")
    df = op13_licenses(spark, tmp)
    assert df.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert df.count() == 0


def test_no_python_worker(spark):
    docs = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    found = licenses.anchored(docs.where(F.lit(True)), licenses.anchors(LICENSE_PHRASES))
    plan = licenses.standing(licenses.detections(found, licenses.signatures(LICENSE_PHRASES)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
