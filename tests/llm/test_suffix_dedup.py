"""Repeated strings against a scan over every position."""

import hashlib
import random

import numpy as np
import pytest

from strata.llm import suffix_dedup


def expected(rows, length):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=int)
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            if s in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(s)
        cut = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(data, np.uint8)[~cut].tobytes()
        spans = int((cut & ~np.concatenate([[False], cut[:-1]])).sum()) if len(cut) else 0
        out.append((doc, len(data), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeö") for _ in range(rnd.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(40), text(14)
    rows = []
    for i in range(60):
        parts = [text(rnd.randint(0, 60))]
        for p in (passage, line, passage[13:190], passage[50:]):
            if rnd.random() < 0.4:
                parts += [p, text(rnd.randint(0, 30))]
        rows.append((i, " ".join(parts)))
    rows += [(60, "ab" * 400), (61, "x" * 99), (62, "x" * 100), (63, "x" * 1000), (64, "abc" * 300 + passage), (65, ""),
             (66, None), (67, rows[3][1]), (68, rows[3][1] + "!"), (69, "y" + rows[3][1]), (70, passage[:100]),
             (71, text(5000) + passage + "ab" * 77)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,length,parts", [(1, 100, 1), (2, 100, 9), (3, 64, 5), (4, 128, 3)])
def test_matches_scan(spark, seed, length, parts):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, start int, doc string")
    got = suffix_dedup.remove_repeats(df.repartition(parts), length=length).select("doc_id", "_cut.*", "start", "doc").collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(expected(rows, length))
    assert all(tuple(r)[5:] == (1, "x") for r in got)


def test_small_flushes_change_nothing(spark, monkeypatch):
    rows = corpus(5)
    docs = [(d, 0, t) for d, t in rows if t]
    import pandas as pd

    batch = pd.DataFrame(docs, columns=["doc", "copy", "text"])
    monkeypatch.setattr(suffix_dedup, "FLUSH", 50)
    some = pd.concat(suffix_dedup._run_rows(100)([batch]))
    monkeypatch.setattr(suffix_dedup, "FLUSH", 10**9)
    all_rows = pd.concat(suffix_dedup._run_rows(100)([batch]))
    assert len(some) >= len(all_rows)
    firsts = lambda d: set(map(tuple, d[d["kind"] != 2][["name", "whole"]].to_numpy()))
    assert firsts(some) == firsts(all_rows)


def test_shared_and_missing_ids(spark):
    rows = corpus(6)
    rows += [(5, rows[1][1]), (5, rows[2][1] + "z"), (None, rows[3][1]), (None, "q" * 150), (None, None), rows[7]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in suffix_dedup.remove_repeats(df).select("doc_id", "_cut.*").collect()]
    want = expected(rows, 100)
    # Among rows of one id the order is the operator's own; sizes and whole-corpus totals do not depend on it.
    assert sorted(g[1] for g in got) == sorted(w[1] for w in want)
    shared = {5, None, rows[7][0]}
    assert sorted(g for g in got if g[0] is not None and g[0] < 5) == sorted(w for w in want if w[0] is not None and w[0] < 5)
    assert sum(g[2] for g in got if g[0] not in shared) == sum(w[2] for w in want if w[0] not in shared)


def test_kept_text_drops_cut_characters(spark):
    base = "ö" * 60
    df = spark.createDataFrame([(1, base), (2, "ab" + base + "cd")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, with_kept=True).select("doc_id", "_cut.*").collect()}
    assert got[2].kept_text == "abcd" and bytes(got[2].kept) == b"abcd"
    assert got[1].kept_text.strip("ö") == ""


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df).count() == 0


def test_long_texts_are_named_in_windows(spark):
    r = random.Random(8)
    size = suffix_dedup.WINDOW
    text = "".join(r.choice("abcdefgh ") for _ in range(2 * size + 5000))
    passage = text[size - 150:size + 150]  # across a border of windows
    text = text[:2 * size - 120] + passage + text[2 * size - 120:] + "z" * 400
    rows = [(1, text), (2, "x" + text[size - 60:size + 200] + "y"), (3, text[:size + 77] + "!" + text[size + 77:size + 900])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "_cut.*").collect()
    assert sorted(tuple(g) for g in got) == sorted(expected(rows, 100))


def test_internal_names_are_free(spark):
    extra = ["_doc", "_copy", "_begins", "_ends", "_part", "_row", "_done", "name", "whole", "several", "text_"]
    rows = [(i, t) + tuple(f"{c}{i}" for c in extra) for i, (_, t) in enumerate(corpus(9)[:20])] + [(3, "again") + tuple(extra)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra))
    got = suffix_dedup.remove_repeats(df)
    assert got.columns == [*df.columns, "_cut"]
    assert sorted(tuple(g)[2:-1] for g in got.collect()) == sorted(x[2:] for x in rows)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df.withColumnRenamed("_row", "_cut"))
    assert "cut" in suffix_dedup.remove_repeats(df.withColumnRenamed("_row", "_cut"), into="cut").columns


def test_a_line_that_many_documents_share(spark):
    """A line below the length repeats nowhere in full; its name is no task's alone."""
    r = random.Random(11)
    line = "".join(r.choice("abcdefgh ") for _ in range(80))
    own = lambda: "".join(r.choice("abcdefgh ") for _ in range(r.randint(60, 120)))
    rows = [(i, own() + line + own()) for i in range(300)] + [(300, rows_text := own() + own() + line), (301, rows_text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = suffix_dedup.remove_repeats(df).select("doc_id", "_cut.*").collect()
    assert sorted(tuple(g) for g in got) == sorted(expected(rows, 100))
