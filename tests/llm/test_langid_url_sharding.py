"""Language ID by held-out accuracy, URL rules and reputation, sharding laws."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid, sharding, url_filter
from strata.llm.queries import URL_RULES

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs, langid.learnable(F.col("doc_id")), per_lang=60)
    got = langid.identify(docs, model).select(langid.held_out(F.col("doc_id")).alias("out"), "lang", "_language.*").collect()
    out = [r for r in got if r.out]
    assert abs(len(out) / len(got) - 0.25) < 0.05
    assert np.mean([r.lang == r.lang_pred for r in out]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert sorted(model.families) == ["germanic", "romance"]


def test_held_out_is_the_crc_of_the_id(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id")).unionByName(
        spark.createDataFrame([(None,)], "doc_id long"))
    for r in df.select("doc_id", langid.held_out(F.col("doc_id")).alias("h"), langid.learnable(F.col("doc_id")).alias("l")).collect():
        out = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert (r.h, r.l) == (out, r.doc_id is not None and not out)


def test_language_edges(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, None, "en"), (3, "", "en"), (4, "12 34 !?", "fr"), (5, "x " * 50_000, None),
            (None, "the dog", "en"), (7, "the end of the day", "en"), (7, "the end of the day", "en")]
    df = spark.createDataFrame([r + (0.5,) for r in rows], "doc_id long, text string, lang string, score double")
    model = langid.train(df, F.lit(True))
    got = [(r.doc_id, r._language.lang_pred, r._language.score > 0) for r in langid.identify(df, model).collect()]
    assert sorted(got, key=str) == sorted([(i, "und", False) if not langid.has_letter(t) else (i, "en", True)
                                           for i, t, _ in rows], key=str)
    nothing = langid.train(df.where("false"), F.lit(True))
    assert {r._language.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.identify(df.where("false"), model).count() == 0


def test_every_language_is_learned(spark):
    word = lambda i: chr(0x4E00 + 40 * i)
    rows = [(100 * i + j, f"{word(i)}{chr(0x4E01 + 40 * i + j % 3)} " * (3 + j), f"x{i:02}") for i in range(40) for j in range(8)]
    rows += [(9000 + j, "12 34", "x39") for j in range(50)]  # nothing to learn from
    rows += [(9100, "\u0416\u0416 \u0416", "many")] * 3000  # copies of one row
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df, F.lit(True), per_lang=6)
    assert sorted(model.families) == sorted({r[2] for r in rows})
    got = langid.identify(df.dropDuplicates().where("doc_id < 9000 or doc_id = 9100"), model)
    assert got.where("lang <> _language.lang_pred").count() == 0


URLS = {
    "http://A.Example.ORG/es/1?q=/x": ("a.example.org", "/es/1", "example.org/es/", "block"),
    "https://example.org/en/12#t": ("example.org", "/en/12", "example.org/en/1", "block"),
    "https://www.example.org/en/2": ("www.example.org", "/en/2", "org/", "allow"),
    "https://notexample.org": ("notexample.org", "", None, "allow"),
    "ftp://shop.com/de/": ("shop.com", "/de/", "com/de/", "block"),
    "ftp://shop.com/fr/a?b://c": ("shop.com", "/fr/a", "com/fr/", "allow"),
    "http://bad.net/p": ("bad.net", "/p", None, "block"),
    "http://good.net/p?x://y/z": ("good.net", "/p", None, "allow"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"),
    "x\n://É.com?q": ("É.com", "", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(0, list(URLS)[0], "h"), (None, None, "h")],
                                  "page_id long, url string, host string")
    told = [("http://bad.net/x", 0)] * 40 + [("http://good.net/", 1)] * 40 + [("http://bad.net/y", None), (None, None)]
    outcomes = spark.createDataFrame(told, "url string, good int")
    got = url_filter.filter_urls(pages, outcomes, URL_RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = list(URLS)[r.page_id] if r.page_id is not None else None
        assert (r.host, r.path, r.rule, r.verdict) == URLS[url], url
    none = url_filter.filter_urls(pages, outcomes.where("false"), URL_RULES).collect()
    assert {r.verdict for r in none if r.rule is None} == {"allow"}
    assert url_filter.filter_urls(pages.where("false"), outcomes, URL_RULES).count() == 0


NAMES = {
    "a.b.example.org": ("example.org", "org"), "shop.co.uk": ("shop.co.uk", "co.uk"), "www.shop.co.uk": ("shop.co.uk", "co.uk"),
    "co.uk": ("co.uk", "uk"), "me.github.io": ("me.github.io", "github.io"), "x.me.github.io:8080": ("me.github.io", "github.io"),
    "10.0.3.4": ("10.0.3.4", "(address)"), "u@10.1.3.4:80": ("10.1.3.4", "(address)"), "[::1]:80": ("[::1]", "(address)"),
    "localhost": ("localhost", "localhost"), "": ("", ""), "1.2.3": ("2.3", "3"),
}


def test_registered_domains(spark):
    df = spark.createDataFrame([(h,) for h in NAMES], "host string")
    got = df.select("host", url_filter.domain_of(F.col("host")).alias("d"), url_filter.suffix_of(F.col("host")).alias("s")).collect()
    assert {r.host: (r.d, r.s) for r in got} == NAMES


def test_strangers_under_one_suffix_are_apart(spark):
    bad = [(f"http://p{i}.bad.co.uk/x", 0) for i in range(30)]
    good = [(f"http://p{i}.fine.co.uk/x", 1) for i in range(30)]
    pages = spark.createDataFrame([(1, "http://new.bad.co.uk/"), (2, "http://new.fine.co.uk/"), (3, "http://10.0.0.1/")], "page_id long, url string")
    outcomes = spark.createDataFrame(bad + good + [("http://10.9.0.1/", 0)] * 40, "url string, good int")
    got = {r.page_id: (r.verdict, r.good_rate) for r in url_filter.filter_urls(pages, outcomes, ()).collect()}
    assert got[1][0] == "block" and got[2][0] == "allow" and got[1][1] < 0.1 < 0.9 < got[2][1]


def test_reputation_shrinks_towards_the_domain(spark):
    hosts = spark.createDataFrame([("a.bad.net", 200, 0), ("b.bad.net", 200, 4), ("new.bad.net", 0, 0), ("one.good.net", 1, 0),
                                   ("a.good.net", 300, 299), ("b.good.net", 300, 300)], "host string, n long, k long")
    got = {r.host: r for r in url_filter.host_reputation(hosts).collect()}
    assert got["new.bad.net"].rate < 0.5 < got["one.good.net"].rate
    assert got["a.bad.net"].blocked and not got["one.good.net"].blocked
    assert got["one.good.net"].rate < got["a.good.net"].rate


def placed(spark, rows, **how):
    df = spark.createDataFrame([r + (9,) for r in rows], "doc_id long, text string, shard int")
    return [r.asDict() for r in sharding.shard(df, **how).collect()]


def laws(rows, got, shards=8):
    assert sorted((str(r["doc_id"]), r["size"], str(r["text_crc32"])) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 1, str(None if t is None else zlib.crc32(t.encode()))) for d, t in rows)
    count = Counter(r["shard"] for r in got)
    assert set(count) <= set(range(shards))
    assert max(count.values()) - min(count[s] for s in range(shards)) <= 1
    for s in count:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(count[s]))
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_equal_texts_share_a_shard(spark):
    rows = [(i, f"text {i}") for i in range(300)] + [(1000 + i, f"copy {i % 25}") for i in range(100)]
    got = placed(spark, rows)
    laws(rows, got)
    text = dict(rows)
    cut = Counter()
    for t in {text[r["doc_id"]] for r in got}:
        cut[t] = len({r["shard"] for r in got if text[r["doc_id"]] == t})
    assert max(cut.values()) == 1


@pytest.mark.parametrize("rows", [
    [(i, "same") for i in range(333)] + [(1000 + i, f"t{i}") for i in range(300)],  # over half in one group
    [(i, "same") for i in range(101)],
    [(i, f"g{i % 9}") for i in range(450)] + [(None, None), (None, ""), (5, None), (5, "g5"), (5, "g5")],
    [(1, "a"), (2, "b"), (3, "x" * 100_000)],
])
def test_laws_hold_for_hot_groups_and_odd_rows(spark, rows):
    laws(rows, placed(spark, rows, rows_per_bucket=1))


@pytest.mark.parametrize("rows, cut", [
    ([(i, f"pair {i // 2}") for i in range(800)], 0),  # every shard full, nothing to fill up with
    ([(i, f"pair {i // 2}") for i in range(520)] + [(1000 + i, f"one {i}") for i in range(280)], 0),
    ([(i, "hot") for i in range(268)] + [(1000 + i, f"pair {i // 2}") for i in range(532)], 2),
    ([(i, f"g{i % 60}") for i in range(780)] + [(1000 + i, f"one {i}") for i in range(20)], 4),  # 60 of 13, 100 a shard
])
def test_linked_rows_stay_together_once_shards_are_full(spark, rows, cut):
    got = placed(spark, rows)
    laws(rows, got)
    text, where = dict(rows), {}
    for r in got:
        where.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(s) - 1 for s in where.values()) <= cut


def test_packing_keeps_to_the_room_and_cuts_only_what_must_be():
    pieces, extra = sharding.packed([(25, 1), (5, 2), (3, 1), (2, 1)], [10, 10, 10, 10], 10)
    load = Counter()
    for size, first, last, s, n in pieces:
        load[s] += (last - first) * n
    assert extra == 0 and sum(load.values()) == 40 and max(load.values()) == 10
    assert sorted(n for size, *_, n in pieces if size == 25) == [5, 10, 10]
    pieces, extra = sharding.packed([(2, 3)], [3, 3], 3)
    assert extra == 1 and sorted(p[4] * (p[2] - p[1]) for p in pieces) == [1, 1, 2, 2]


def test_empty_table(spark):
    assert placed(spark, []) == []


def test_full_shards_exchange_rows():
    assert sharding.exchange({(0, 1): 10, (1, 0): 4, (2, 1): 6}, [0, 0, 0]) == {(0, 1): 4, (1, 0): 4, (2, 1): 0}
    r = np.random.default_rng(5)
    for _ in range(50):
        asks = {(s, t): int(r.integers(0, 20)) for s in range(8) for t in range(8) if s != t and r.random() < 0.4}
        free = r.integers(0, 15, 8).tolist()
        flow = sharding.exchange(asks, free)
        assert all(0 <= flow[k] <= asks[k] for k in asks)
        for t in range(8):
            gain = sum(n for k, n in flow.items() if k[1] == t) - sum(n for k, n in flow.items() if k[0] == t)
            assert gain <= free[t]
            # A shard with room left takes all that ask for it.
            assert gain == free[t] or all(flow[k] == asks[k] for k in asks if k[1] == t)
    assert sharding.exchange({(0, 1): 10}, [0, 0]) == {(0, 1): 0}
    assert sharding.exchange({(0, 1): 10, (1, 2): 3, (2, 0): 3}, [0, 2, 0]) == {(0, 1): 5, (1, 2): 3, (2, 0): 3}


def test_dealt_evenly(spark):
    sizes = spark.createDataFrame([(f"g{i}", 2 + i % 5) for i in range(50)] + [("big", 500)], "gkey string, all long")
    got = sharding.dealt(sizes, 8, 4).collect()
    by_group, by_shard = Counter(), Counter()
    for r in got:
        by_group[r.gkey] += r.n
        by_shard[r.shard] += r.n
    assert by_group == {r.gkey: r["all"] for r in sizes.collect()}
    assert max(by_shard.values()) - min(by_shard.values()) <= 1


def test_propagation_leaves_little_to_pack(spark):
    """All rows in pairs: every shard is full from the first round on."""
    groups = spark.createDataFrame([(f"g{i}", 2) for i in range(800)], "gkey string, all long")
    room = sharding.quotas(1600, 8)
    done = sharding.propagate(sharding.stored(sharding.dealt(groups, 8, 4), "test-start"), room, 4).collect()
    load = Counter()
    for r in done:
        load[r.shard] += r.n
    assert all(load[s] <= room[s] for s in range(8)) and sum(load.values()) == 1600
    assert len(done) - 800 <= 8  # cut pairs
