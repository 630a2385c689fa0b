"""Triggered bronze ingestion for a set of feeds (the table factory).

Every enabled feed gets its own file stream and checkpoint; the streams run
concurrently and each stops when its landed files are consumed
(``availableNow``).  Rerunning adds only files that landed since (ST3): the
checkpoint's seen-file log makes re-ingestion idempotent, and a restarted
query resumes from its last committed batch after an executor or driver loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from strata.sources.bronze import start_bronze
from strata.spec import FeedSpec


def landing_path(root: str, spec: FeedSpec) -> str:
    return f"{root.rstrip('/')}/{spec.category}/{spec.name}"


def bronze_path(root: str, spec: FeedSpec) -> str:
    return f"{root.rstrip('/')}/bronze/{spec.category}_{spec.name}"


def ingest_feeds(spark: SparkSession, specs: Sequence[FeedSpec], landing_root: str,
                 out_root: str, max_files_per_trigger: int | None = None,
                 archive_root: str | None = None) -> dict[str, str]:
    """Run one triggered stream per enabled feed; return bronze paths.
    ``archive_root`` moves consumed landing files out of the listed tree
    (one sub-folder per feed, see ``stream_landing``)."""
    started = {}
    for spec in specs:
        if not spec.enabled:
            continue
        archive = landing_path(archive_root, spec) if archive_root else None
        q = start_bronze(spark, spec, landing_path(landing_root, spec), bronze_path(out_root, spec),
                         f"{out_root.rstrip('/')}/_checkpoints/bronze_{spec.category}_{spec.name}",
                         max_files_per_trigger, archive)
        started[spec.name] = q
    for q in started.values():
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return {name: bronze_path(out_root, s) for s in specs if s.enabled for name in [s.name]}
