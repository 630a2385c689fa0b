"""Audits over landed pages: sweep completeness and offset gaps.

Both work on page metadata (one row per landed document), never on records.
A sweep is one paging run over an endpoint (``SWEEP``).  Runs are found in the data
(``with_runs``): pages of an endpoint that follow each other closely are one run, so
two runs of a day or month are audited apart, and one past midnight stays whole.  A
document that names neither endpoint nor offset (a route lookup) is a sweep of its
own.  Inside a run, a page that was delivered again replaces the earlier one
(``newest_pages``).

Both audits look at the same intervals of offsets, so no sweep is both complete and
gapped, however pages overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from strata.functions.records import record_count
from strata.functions.typed import parse_ingest_ts
from strata.spec import FeedSpec

# What tells one sweep from another, after ``with_runs``.
SWEEP = ("category", "entity", "endpoint", "document", "run_start")
RUN_GAP_SECONDS = 1800


def landed_pages(bronze: DataFrame, spec: FeedSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per landed document with its page metadata: the input of both
    audits.  The record count comes from the declared array path (N5) and
    the announced total from ``Meta.TotalCount`` (N6)."""
    resource = spec.array_path.split(".")[1]
    docs = bronze.filter(F.col("_corrupt_record").isNull()) if "_corrupt_record" in bronze.columns else bronze
    return docs.select(
        F.col("ingestion_metadata.category").alias("category"),
        F.col("ingestion_metadata.entity").alias("entity"),
        F.col("ingestion_metadata.batch_id").alias("batch_id"),
        F.col("ingestion_metadata.ingested_at").alias("ingested_at"),
        F.col("ingestion_metadata.endpoint").alias("endpoint"),
        F.col("ingestion_metadata.offset").try_cast("bigint").alias("page_offset"),
        F.col("ingestion_metadata.limit").try_cast("int").alias("page_limit"),
        F.coalesce(F.col("ingestion_metadata.poison_pill_recovered").try_cast("boolean"),
                   F.lit(False)).alias("recovered"),
        record_count(F.col(spec.array_path)).alias("n_records"),
        F.col(f"payload.{resource}.Meta.TotalCount").try_cast("bigint").alias("total_count"),
        *[F.col(k) for k in keep],
    )


def with_runs(pages: DataFrame, keys: Sequence[str] = ("category", "entity", "endpoint"),
              gap_seconds: int = RUN_GAP_SECONDS) -> DataFrame:
    """Add ``document`` and ``run_start`` to ``landed_pages``.

    ``document`` is the batch id of a page without endpoint and offset, else NULL.  A
    run ends where the next page of its keys is ``gap_seconds`` or more away;
    ``run_start`` is its first ``ingested_at`` (NULL for pages without a readable one).

    Pages are first reduced to one row per key and stretch of ``gap_seconds`` - two pages
    in one stretch are always in one run - so session windows see a number of rows that
    follows time, not pages, and an endpoint with most pages is no hot key."""
    alone = F.col("endpoint").isNull() & F.col("page_offset").isNull()
    at = parse_ingest_ts("ingested_at")
    pages = pages.select("*", F.when(alone, F.coalesce("batch_id", F.lit(""))).alias("document"),
                         F.floor(F.unix_timestamp(at) / gap_seconds).alias("_stretch"))
    own = [*keys, "document"]
    stretches = pages.where(F.col("_stretch").isNotNull()).groupBy(*own, "_stretch").agg(
        F.min(at).alias("_first"), F.max(at).alias("_last"))
    length = F.unix_timestamp("_last") - F.unix_timestamp("_first") + gap_seconds
    runs = stretches.groupBy(*own, F.session_window("_first", F.concat(length.cast("string"), F.lit(" seconds")))).agg(
        F.min("_first").alias("run_start"), F.collect_set("_stretch").alias("_stretches"))
    # A run's stretches are consecutive: their number is its length in time.
    runs = runs.select(*[F.col(k).alias(f"_r_{k}") for k in own], "run_start", F.explode("_stretches").alias("_r_stretch"))
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in own]
    cond = F.col("_stretch") == F.col("_r_stretch")
    for c in same:
        cond = cond & c
    out = pages.join(runs, cond, "left")
    return out.select(*[c for c in pages.columns if c != "_stretch"], "run_start")


def newest_pages(pages: DataFrame, sweep: Sequence[str], offset: str = "page_offset",
                 newest: Sequence[str] = ("ingested_at", "batch_id")) -> DataFrame:
    """One page per (sweep, offset): the one delivered last.  Documents
    without an offset are single pages that start at 0."""
    rest = [c for c in pages.columns if c not in sweep and c != offset]
    at = F.coalesce(F.col(offset), F.lit(0).cast("bigint")).alias(offset)
    picked = pages.groupBy(*sweep, at).agg(
        F.max_by(F.struct(*rest), F.struct(*newest)).alias("_page"))
    return picked.select(*sweep, offset, *[F.col(f"_page.{c}").alias(c) for c in rest])


def _reaches(pages: DataFrame, sweep: Sequence[str], offset: str, limit: str, total: str | None, records: str,
             bucket_span: int, carry: Sequence = ()) -> DataFrame:
    """One row per (sweep, offset): ``_end`` of its page, ``_before`` (how far earlier
    pages reach, NULL for the first), ``_next`` (the next page's offset) and the sweep's
    ``_sweep_total``.

    A sweep may hold most of the pages, so the ordering is two-level.  Offsets fall into
    buckets of ``bucket_span``; one summary row per bucket gives the reach of all
    earlier buckets and the first offset of the next one (a window over ``range /
    bucket_span`` rows per sweep).  Joined back, a single window per bucket sees
    everything in one pass; no task orders more than one bucket's pages."""
    keys = list(sweep)
    held = [F.col(records)] if records in pages.columns else []
    base = pages.groupBy(*keys, offset).agg(
        F.max(F.col(offset) + F.coalesce(F.col(limit), *held, F.lit(0))).alias("_end"),
        (F.max(total) if total else F.lit(None).cast("bigint")).alias("_total"), *carry,
    ).withColumn("_b", F.floor(F.col(offset) / F.lit(bucket_span)))
    buckets = base.groupBy(*keys, "_b").agg(F.min(offset).alias("_first"), F.max("_end").alias("_last_end"),
                                            F.max("_total").alias("_btotal"))
    w2 = Window.partitionBy(*keys).orderBy("_b")
    summary = buckets.select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_b").alias("_s_b"),
        F.max("_last_end").over(w2.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev_reach"),
        F.lead("_first").over(w2).alias("_next_first"),
        F.max("_btotal").over(Window.partitionBy(*keys)).alias("_sweep_total"))
    cond = F.col("_b") == F.col("_s_b")
    for k in keys:  # sweeps without an endpoint are sweeps too
        cond = cond & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    w1 = Window.partitionBy(*keys, "_b").orderBy(offset)
    before = F.greatest(F.col("_prev_reach"), F.max("_end").over(w1.rowsBetween(Window.unboundedPreceding, -1)))
    after = F.coalesce(F.lead(offset).over(w1), F.col("_next_first"))
    joined = base.join(summary, cond).drop("_s_b", *[f"_s_{k}" for k in keys])
    return joined.withColumn("_before", before).withColumn("_next", after).drop("_b", "_prev_reach", "_next_first", "_total")


def completeness(pages: DataFrame, sweep: Sequence[str], records: str = "n_records",
                 total: str = "total_count", limit: str = "page_limit",
                 recovered: str | None = None, offset: str = "page_offset",
                 bucket_span: int = 1 << 20) -> DataFrame:
    """Per sweep: pages, records landed, the feed's announced total, how many
    records are missing (never below 0), and whether the sweep is complete
    (SURVEY R1).  ``pages`` holds one row per offset; see ``newest_pages``.

    What counts against the total is covered offsets, not a sum of page sizes: of a page
    that overlaps earlier ones, only as many records as it covers new offsets."""
    carry = [F.count(F.lit(1)).alias("_pages"), F.sum(records).alias("_records"), F.max(limit).alias("_limit"),
             F.count_if(F.coalesce(F.col(recovered), F.lit(False)) if recovered else F.lit(False)).alias("_recovered")]
    seen = _reaches(pages, sweep, offset, limit, total, records, bucket_span, carry)
    fresh = F.col("_end") - F.greatest(F.col(offset), F.col("_before"))
    agg = seen.groupBy(*sweep).agg(
        F.sum("_pages").alias("n_pages"), F.sum("_records").cast("bigint").alias("n_records"),
        F.max("_sweep_total").cast("bigint").alias("total_count"), F.max("_limit").cast("bigint").alias("page_limit"),
        F.sum(F.least(F.col("_records"), F.greatest(fresh, F.lit(0)))).cast("bigint").alias("_covered"),
        F.sum("_recovered").alias("n_recovered"))
    return agg.select(
        *sweep,
        "n_pages", "n_records", "total_count",
        F.ceil(F.col("total_count") / F.col("page_limit")).cast("bigint").alias("expected_pages"),
        F.greatest(F.col("total_count") - F.col("_covered"), F.lit(0).cast("bigint")).alias("missing_records"),
        (F.col("_covered") >= F.col("total_count")).alias("complete"),
        *(["n_recovered"] if recovered is not None else []),
    )


def offset_gaps(pages: DataFrame, sweep: Sequence[str], offset: str = "page_offset",
                limit: str = "page_limit", total: str | None = "total_count",
                bucket_span: int = 1 << 20, records: str = "n_records") -> DataFrame:
    """Record ranges ``[gap_start, gap_end)`` of a sweep covered by no landed
    page (SURVEY R2).  A page covers ``[offset, offset + limit)``; without a
    known limit it covers the records it holds (``records``).  Pages may
    overlap: after a bad record the feed lands bisected sub-batches and then
    resumes one past the bad offset with a full page, so coverage is tracked
    as the running maximum of page ends (the reach), not the previous page's
    end.  Gaps lie after a page, up to the next offset beyond the reach, before
    the first page, and between the reach and the announced total."""
    keys = list(sweep)
    seen = _reaches(pages, sweep, offset, limit, total, records, bucket_span).withColumn(
        "_reach", F.greatest("_before", "_end"))

    def gap(cond, start, end):
        return F.when(cond, F.struct(start.cast("bigint").alias("gap_start"),
                                     end.cast("bigint").alias("gap_end")))

    found = [
        gap(F.col("_before").isNull() & (F.col(offset) > 0), F.lit(0), F.col(offset)),
        gap(F.col("_next") > F.col("_reach"), F.col("_reach"), F.col("_next")),
    ]
    if total:
        found.append(gap(F.col("_next").isNull() & (F.col("_reach") < F.col("_sweep_total")),
                         F.col("_reach"), F.col("_sweep_total")))
    gaps = seen.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("g"))
    return gaps.select(*keys, "g.gap_start", "g.gap_end",
                       (F.col("g.gap_end") - F.col("g.gap_start")).alias("missing_records"))
