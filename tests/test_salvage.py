"""Record salvage against a plain character walk, and end to end."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.flatten import flatten
from strata.operators.salvage import damaged_records, salvaged_documents, scan_objects, split_records, with_salvaged
from strata.plans.feeds import AIRPORTS
from strata.plans.medallion import refresh
from strata.sources.bronze import CORRUPT, read_bronze
from tests.flight_fixtures import envelope, names, write


def walk(text):
    """Complete top-level objects, where the rest begins, and whether the list ended."""
    spans, depth, start, rest, quoted, i = [], 0, 0, 0, False, 0
    while i < len(text):
        c = text[i]
        if c == "\\":
            i += 2
            continue
        if c == '"':
            quoted = not quoted
        elif not quoted and c == "{":
            start = i if depth == 0 else start
            depth += 1
        elif not quoted and c == "}":
            if depth == 0:
                return spans, rest, True
            depth -= 1
            if depth == 0:
                spans.append((start, i + 1))
                rest = i + 1
        elif not quoted and c == "]" and depth == 0:
            return spans, rest, True
        i += 1
    return spans, rest, False


def record(r):
    odd = ["a", 'q"q', "b\\b", "{", "}", "]", "é🙂", "\n", ""]
    return {"Key": r.choice(odd), "In": {"X": r.choice(odd), "L": [1, {"Y": r.choice(odd)}]}, "Z": r.choice(odd)}


def test_scan_is_the_character_walk(spark):
    r = random.Random(3)
    texts = []
    for _ in range(300):
        t = ",".join(json.dumps(record(r), ensure_ascii=r.random() < 0.5) for _ in range(r.randint(0, 4))) + "]}}"
        if r.random() < 0.6:
            t = t[:r.randint(0, len(t))]
        if r.random() < 0.3:
            cut = r.randint(0, len(t))
            t = t[:cut] + t[cut + 1:]
        texts.append(t)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for x in df.select("i", scan_objects(F.col("t")).alias("s")).collect():
        spans, rest, ended = walk(texts[x.i])
        # An escape cut off at the very end changes nothing the walk has kept.
        assert ([tuple(p) for p in x.s.spans], x.s.rest, x.s.ended) == (spans, rest, ended), texts[x.i]


@pytest.mark.parametrize("at", ["cut", "brace", "quote", "comma", "none"])
def test_only_the_damaged_record_is_lost(spark, at):
    recs = [json.dumps({"Key": str(i), "In": {"X": "}]"}, "Z": 'a"b'}) for i in range(6)]
    bad = list(recs)
    if at == "brace":
        bad[2] = bad[2][:-1]
    elif at == "quote":
        bad[2] = bad[2].replace('"Key": "2"', '"Key": "2')
    elif at == "comma":
        bad[2] = bad[2].replace('"Key": "2",', '"Key": "2",,')
    text = ",".join(bad) + ']},"Meta":{"TotalCount":6}}}}'
    if at == "cut":
        text = ",".join(recs)[: len(",".join(recs[:4])) + 9]
    got = split_records(spark.createDataFrame([(text,)], "t string"), "t", r'\{\s*"Key"\s*:').first()
    keys = [json.loads(x)["Key"] for x in got.records]
    if at == "none":
        assert keys == list("012345") and got.damaged == []
    elif at == "cut":
        assert keys == list("0123") and got.damaged == [recs[4][:8].strip()]
    else:
        assert sorted(keys) == list("01345") and got.damaged == [bad[2]]


def _page(root, offset, records, total, mangle=None):
    doc = envelope("ref", "airports", "2024-03-01 07:00:00", f"p{offset}", "AirportResource", "Airports", "Airport",
                   records, total=total, offset=offset, limit=5)
    text = json.dumps(doc, indent=2)
    write(root, "ref", "airports", "2024-03", f"airports_{offset}.json", None, raw=mangle(text) if mangle else text)


def _airport(code):
    return {"AirportCode": code, "Names": names(code.title()), "CountryCode": "DE"}


def test_refresh_keeps_good_records_of_bad_pages(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    codes = [f"A{a}{b}" for a in "ABCD" for b in "ABCDE"]
    recs = [_airport(c) for c in codes]
    _page(landing, 0, recs[:5], 20)
    _page(landing, 5, recs[5:10], 20, lambda t: t[:t.index('"ABD"')])  # three complete, one damaged, one lost
    _page(landing, 10, recs[10:15], 20, lambda t: t.replace('"AirportCode": "ACB",', '"AirportCode": "ACB', 1))
    _page(landing, 15, recs[15:], 20, lambda t: t[:30])  # cut inside the metadata
    layers = refresh(spark, landing, out, (AIRPORTS,), with_gold=False)
    kept = {r.airport_code for r in spark.read.parquet(layers.silver["airports"]).collect()}
    assert kept == set(codes) - {"ABD", "ABE", "ACB"} - set(codes[15:])
    pieces = spark.read.parquet(layers.damaged["airports"]).collect()
    assert len(pieces) == 3 and sum("ABD" in p.piece or "ACB" in p.piece for p in pieces) == 1
    audit = spark.read.parquet(layers.audits["airports"]["completeness"]).collect()
    assert [(r.n_pages, r.n_records, r.total_count, r.missing_records, r.n_recovered) for r in audit] == [(3, 12, 20, 8, 2)]
    # Nothing is counted twice when the layers are refreshed again.
    again = refresh(spark, landing, out, (AIRPORTS,), with_gold=False)
    assert spark.read.parquet(again.silver["airports"]).count() == len(kept)


def test_shape_is_bronze_s(spark, tmp):
    landing, out = f"{tmp}/landing", f"{tmp}/out"
    _page(landing, 0, [_airport("AAA")], 1, lambda t: t[:-2])  # only the envelope's end is missing
    layers = refresh(spark, landing, out, (AIRPORTS,), with_gold=False)
    bronze = read_bronze(spark, layers.bronze["airports"], AIRPORTS)
    both = with_salvaged(bronze, AIRPORTS)
    assert both.schema.simpleString() == bronze.schema.simpleString()
    assert both.count() == 2 and both.where(F.col(CORRUPT).isNull()).count() == 1
    assert [r.airport_code for r in flatten(both, AIRPORTS).collect()] == ["AAA"]
    assert damaged_records(bronze, AIRPORTS).count() == 0
    assert "Exchange" not in salvaged_documents(bronze, AIRPORTS)._jdf.queryExecution().toString()
