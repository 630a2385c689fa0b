"""The corpus pipeline stage by stage, and what the entry registers."""

import corpus_pipeline as P
from __spark_entry__ import oracle_sql, queries
from strata.llm.common import components

from tests.llm.test_minhash import expected as groups_of
from tests.llm.test_suffix_dedup import expected as cuts_of

SF = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert {"op7_minhash", "op9_url_filter", "op10_vector_dedup"} <= set(oracle_sql())


def test_stages_on_the_documents_table(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for i, (name, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{tmp}/{i}")
        docs = spark.read.parquet(f"{tmp}/{i}")
        rows = docs.collect()
        if name != "encode":
            assert docs.columns == list(P.COLUMNS)
        if name == "language":
            assert {r.doc_id for r in rows} >= {d for d, r in before.items() if r.n_chars > 40}
        if name == "near_duplicates":
            want = {d for d, n, c in groups_of([(d, r.text) for d, r in before.items()]) if d == c}
            assert {r.doc_id for r in rows} == want & before.keys() and len(rows) == len(want)
        if name == "repeats":
            want = {d: n - gone for d, n, gone, _, _ in cuts_of([(d, r.text) for d, r in before.items()], 100)}
            # Characters cut in half go too, so a text may be a few bytes shorter.
            assert all(want[r.doc_id] - 8 <= len(r.text.encode()) <= want[r.doc_id] for r in rows)
        if name == "mixing":
            assert {r.doc_id for r in rows} <= before.keys()
            copies = {}
            for r in rows:
                copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
                assert r.text == before[r.doc_id].text
            assert max(copies.values()) <= 2
            kept = len(rows)
        if name == "encode":
            assert len(rows) == kept
        before = {r.doc_id: r for r in rows}


def odd(spark):
    long = " ".join(f"word{i}" for i in range(4000))
    rows = [(1, "the cat sat on the mat today", "en", "a", 28), (1, "the cat sat on the mat today", "en", "a", 28),
            (2, None, "en", "a", None), (3, "", None, None, 0), (4, long, None, "b", len(long)), (None, long, "en", "b", 1),
            (None, None, None, None, None), (5, "12 34", "en", "b", 5), (6, "el perro de la casa", "es", None, 19),
            (4, "another text under the id of four", "en", "a", 3)]
    return spark.createDataFrame([r + ("t", 1) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, _key string, size int")


def test_stages_take_odd_rows_and_empty_tables(spark):
    for docs in (odd(spark), odd(spark).where("false")):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            if name != "encode":
                assert out.columns == list(P.COLUMNS)
            if docs.isEmpty():
                assert rows == []
            elif name == "near_duplicates":
                # One row of each group; rows without words stay.
                assert sorted(str(r.doc_id) for r in rows) == sorted(["1", "2", "3", "4", "4", "5", "6", "None"])
            elif name == "mixing":
                assert sum(r.doc_id == 1 for r in rows) <= 4


def test_rows_alike_but_for_lang_are_chosen_by_order(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "fr", "b", 33), (1, text, "de", "b", 33), (1, text, "en", "a", 33), (1, text, "de", "a", 33)]
    for i in (0, 2):
        docs = spark.createDataFrame(rows[i:] + rows[:i], "doc_id long, text string, lang string, source string, n_chars long")
        docs = docs.repartition(4)
        assert [(r.lang, r.source) for r in P.near_duplicates(spark, docs, SF).collect()] == [("de", "a")]
        assert {(r.lang, r.source) for r in P.mix(spark, docs, SF).collect()} <= {("de", "a"), ("de", "b")}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (300, 300)] + [(500, 500 + i) for i in range(1, 60)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(df, "t").collect()}
    want = {i: 0 for i in range(41)} | {100: 100, 150: 100, 200: 100} | {500 + i: 500 for i in range(60)}
    assert got == want
    assert components(df.where("false"), "t").count() == 0


def test_only_rows_without_a_language_go(spark, monkeypatch):
    from pyspark.sql import functions as F

    def unsure(docs, model, text="text"):
        pred = F.when(F.col("doc_id") == 1, F.lit("und")).otherwise(F.lit("en"))
        return docs.withColumn("_language", F.struct(pred.alias("lang_pred"), F.lit(0.1).alias("score")))

    monkeypatch.setattr(P.langid, "identify", unsure)
    df = spark.createDataFrame([(1, "12 34", None, "a", 5), (2, "qwx zzv", None, "a", 7), (3, "tere", "et", "a", 4)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.lang) for r in P.language(spark, df, "").collect()) == [(2, "en"), (3, "et")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_language_filter_predicts_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert _plan(P.language(spark, docs, SF)).count("ArrowEvalPython") == 1


def test_rows_kept_of_near_copies_cross_one_shuffle(spark):
    text = "one two three four five six seven"
    rows = [(7, text, "en", "b", 1), (7, text, "en", "a", 1), (None, text, "de", "a", 1), (None, "quite another text", "de", "z", 1),
            (None, "quite another text", None, "z", 1), (9, "a third one", "en", "a", 1), (3, " ", "en", "a", 1)]
    out = P.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), SF)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        (7, text, "en", "a", 1), (None, "quite another text", None, "z", 1), (9, "a third one", "en", "a", 1), (3, " ", "en", "a", 1)], key=str)
    # Without broadcasts: names meet rows (2), their groups' first rows (1) meet the kept ones (1), these are shuffled once.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert _plan(out.select("*")).count("Exchange hashpartitioning") <= 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
