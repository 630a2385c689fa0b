"""Record salvage: complete records out of documents that do not parse (R3).

A page that was cut in transit, or has one garbled record, fails to parse as a
whole.  A brace-depth scan of its raw text finds where each record of the list
begins and ends: strings are skipped as units (escapes are masked first, in equal
length), every ``{`` goes one level down and every ``}`` one up, and a record is
what lies between level 0 and the return to it.  A list that does not end properly
leaves a damaged rest; as a record without its closing brace swallows all that
follow, the rest is cut again where a record can begin (``{`` and the record's first
declared field), and each piece is scanned on its own.  What is balanced but still
not JSON counts as damaged.

Everything is built from column expressions inside one projection: no shuffle, and
the work per document is bounded by its page.  The result has bronze's shape, so
staging, audits and quarantine need no second path.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.typed import parse_ingest_ts
from strata.sources.bronze import CORRUPT, METADATA_SCHEMA, UNKNOWN, UNKNOWN_SCHEMA, envelope_schema
from strata.spec import FeedSpec

DAMAGED = "damaged"

# Strings (also one that never ends), braces, a list's end, and everything between.
_TOKEN = r'"[^"]*+"?|[{}\]]|[^"{}\]]++'
_SPAN = "array<struct<start:int,stop:int>>"


def scan_objects(text: Column, lone: bool = False) -> Column:
    """struct(spans, rest, ended) of a list's text from its first element on.

    ``spans``: start and length-end (0-based, end exclusive) of every complete
    top-level object; ``rest``: where the text after the last one begins; ``ended``:
    the list was closed (``]``, or the brace that closes its parent).  With ``lone``
    the scan ends after the first object."""
    masked = F.regexp_replace(text, r"(?s)\\.", "__")
    tokens = F.regexp_extract_all(masked, F.lit(_TOKEN), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("start"), F.lit(0).alias("rest"),
                    F.array().cast(_SPAN).alias("spans"), F.lit(False).alias("ended"))

    def step(s, token):
        after = s.at + F.length(token)
        opens, closes = token == "{", token == "}"
        done = closes & (s.depth == 1)
        ends = (s.depth == 0) & (closes | (token == "]"))
        span = F.struct(s.start.alias("start"), after.alias("stop"))
        moved = F.struct(
            after.alias("at"),
            F.when(opens, s.depth + 1).when(closes & (s.depth > 0), s.depth - 1).otherwise(s.depth).alias("depth"),
            F.when(opens & (s.depth == 0), s.at).otherwise(s.start).alias("start"),
            F.when(done, after).otherwise(s.rest).alias("rest"),
            F.when(done, F.concat(s.spans, F.array(span))).otherwise(s.spans).alias("spans"),
            (ends | (done if lone else F.lit(False))).alias("ended"))
        return F.when(s.ended, s).otherwise(moved)

    end = F.aggregate(tokens, zero, step)
    return F.struct(end.spans.alias("spans"), end.rest.alias("rest"), end.ended.alias("ended"))


def _cuts(text: Column, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.substring(text, s.start + 1, s.stop - s.start))


def _bare(text: Column) -> Column:
    """Without the commas and white space between records."""
    return F.regexp_replace(text, r"^[\s,]+|[\s,]+$", "")


def _valid(record: Column) -> Column:
    return F.try_parse_json(record).isNotNull()


def split_records(df: DataFrame, text: str, opener: str) -> DataFrame:
    """Add ``records``, the complete records in the list text of column ``text`` (after
    its opening bracket), and ``damaged``, the pieces that are none.  ``opener`` is a
    regular expression for a record's beginning.  Steps are projections of their own,
    so each scan runs once."""
    cols = df.columns
    found = df.select("*", scan_objects(F.col(text)).alias("_f")).select("*", _cuts(F.col(text), F.col("_f.spans")).alias("_c"))
    # From the first object that is no JSON on, the scan's levels cannot be trusted.
    bad = F.array_position(F.transform("_c", _valid), F.lit(False)).cast("int")
    found = found.select("*", bad.alias("_bad"))
    begin = F.when(F.col("_bad") > 0, F.get("_f.spans", F.col("_bad") - 1).start).when(~F.col("_f.ended"), F.col("_f.rest"))
    rest = F.when(begin.isNotNull(), F.substring(F.col(text), begin + 1, F.length(text))).otherwise(F.lit(""))
    kept = F.when(F.col("_bad") > 0, F.slice("_c", F.lit(1), F.col("_bad") - 1)).otherwise(F.col("_c"))
    cut = found.select(*cols, kept.alias("_kept"), F.split(rest, f"(?={opener})").alias("_p"))
    scanned = cut.select("*", F.transform("_p", lambda p: F.struct(p.alias("piece"), scan_objects(p, lone=True).alias("s"))).alias("_q"))

    def judged(q):
        one = F.get(_cuts(q.piece, q.s.spans), F.lit(0))
        # A piece after the damage may close the list: what follows is the envelope's end.
        tail = _bare(F.substring(q.piece, q.s.rest + 1, F.length(q.piece)))
        return F.when(_valid(one), F.struct(one.alias("record"), F.when(tail.rlike(r"^[\]}]"), F.lit("")).otherwise(tail).alias("damaged"))
                      ).otherwise(F.struct(F.lit(None).cast("string").alias("record"), _bare(q.piece).alias("damaged")))

    done = scanned.select(*cols, "_kept", F.transform("_q", judged).alias("_j"))
    return done.select(*cols, F.concat("_kept", F.array_compact("_j.record")).alias("records"),
                       F.filter("_j.damaged", lambda d: d != "").alias("damaged"))


def salvaged_documents(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    """The unparsable documents of ``bronze`` in bronze's shape, with the records that
    are complete, the recovery flag set and the damaged pieces in ``damaged``.

    Metadata is taken from the envelope where it is complete; a document cut before
    its record list has no records and is damaged as a whole."""
    _, resource, plural, singular = spec.array_path.split(".")
    first = spec.node_schema.fields[0].name
    raw = F.col(CORRUPT)
    head = F.regexp_extract(raw, r'(?s)^(.*?"' + re.escape(plural) + r'"\s*:\s*\{\s*"' + re.escape(singular) + r'"\s*:\s*\[?)', 1)
    meta_head = F.regexp_extract(raw, r'(?s)^(.*?"ingestion_metadata"\s*:\s*)', 1)
    total = F.nullif(F.regexp_extract(raw, r'"TotalCount"\s*:\s*"?([0-9]+)', 1), F.lit(""))
    cut = bronze.where(raw.isNotNull()).select(
        raw.alias("_raw"), "source_file", F.substring(raw, F.length(head) + 1, F.length(raw)).alias("_list"),
        (F.length(head) > 0).alias("_listed"), total.alias("_total"),
        F.when(F.length(meta_head) > 0, F.substring(raw, F.length(meta_head) + 1, F.length(raw))).alias("_meta"))
    parts = split_records(cut, "_list", r'\{\s*"' + re.escape(first) + r'"\s*:')
    parts = parts.select("*", scan_objects(F.col("_meta"), lone=True).alias("_m"))
    parts = parts.select("*", _cuts(F.col("_meta"), F.col("_m.spans")).alias("_metas"))
    envelope = F.from_json(F.get("_metas", F.lit(0)), METADATA_SCHEMA)
    flagged = F.struct(*[(F.lit("true") if f.name == "poison_pill_recovered" else F.col(f"_e.{f.name}")).alias(f.name)
                         for f in METADATA_SCHEMA])
    records = F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))
    payload = F.struct(F.struct(F.struct(records.alias(singular)).alias(plural),
                                F.struct(F.col("_total").alias("TotalCount")).alias("Meta")).alias(resource))
    parts = parts.select("*", envelope.alias("_e"))
    out = parts.select(flagged.alias("ingestion_metadata"), F.when(F.col("_listed"), payload).alias("payload"),
                       F.lit(None).cast("string").alias(CORRUPT),
                       *([F.lit(None).cast(UNKNOWN_SCHEMA).alias(UNKNOWN)] if spec.keep_unknown else []), "source_file",
                       F.to_date(parse_ingest_ts(F.col("_e.ingested_at"))).alias("ingest_date"),
                       F.when(F.col("_listed"), F.col("damaged")).otherwise(F.array("_raw")).alias(DAMAGED))
    # The declared types, so that the result can be put under bronze itself.
    declared = envelope_schema(spec)
    return out.select(F.col("ingestion_metadata").cast(declared["ingestion_metadata"].dataType).alias("ingestion_metadata"),
                      F.col("payload").cast(declared["payload"].dataType).alias("payload"), *out.columns[2:])


def with_salvaged(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    """Bronze with the complete records of its unparsable documents as documents of
    their own; the unparsable ones stay, and staging skips them as before."""
    saved = salvaged_documents(bronze, spec).where(F.col("payload").isNotNull()).drop(DAMAGED)
    return bronze.unionByName(saved.select(*bronze.columns))


def damaged_records(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    """(source_file, batch_id, piece) per piece of an unparsable document that is no
    complete record: what salvage could not keep."""
    return salvaged_documents(bronze, spec).select(
        "source_file", F.col("ingestion_metadata.batch_id").alias("batch_id"), F.explode(DAMAGED).alias("piece"))
