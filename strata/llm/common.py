"""Helpers shared by the training-data operators.

``stored`` cuts lineage with a table in the shared folder the session names
(``spark.checkpoint.dir``), so a lost executor rereads files instead of
recomputing earlier stages.  ``release`` lets Spark's cleaner drop the shuffle
files of finished steps.  ``components`` finds connected components by
alternating star contractions: rows and rounds only, no driver-side graph.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once a context, so that
    Python workers can import them wherever the job was started.  Batches sent
    to them hold at most ``BATCH_ROWS`` rows, as texts may be very long."""
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    handle, name = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")  # read by the driver only
    os.close(handle)
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)


_shipped: set[str] = set()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch area and reread it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def most_frequent(counts: DataFrame, rows: int) -> DataFrame:
    """The entries of stored ``counts`` with the largest ``n``, at most ``rows``.

    Counts fall into steps of a sixteenth of a doubling; the largest steps that
    fit together are taken whole, so no task sorts all entries."""
    step = F.floor(F.log2("n") * 16)
    sizes = {r.s: r["count"] for r in counts.groupBy(step.alias("s")).count().collect()}  # at most a thousand rows
    least, held = None, 0
    for s in sorted(sizes, reverse=True):
        held += sizes[s]
        if held > rows:
            break
        least = s
    return counts.where(F.lit(False) if least is None else step >= least)


HASH_RANGE = 2**40


def hash_share(count: int, wanted: int) -> int:
    """The part of ``HASH_RANGE`` that about twice ``wanted`` of ``count`` rows fall
    below: what tasks hand on for an exact choice does not grow with the table."""
    return int(min(1.0, 2 * wanted / max(1, count)) * HASH_RANGE)


def release(spark: SparkSession) -> None:
    """Collect driver garbage so that Spark's cleaner removes shuffle files of
    finished steps now, not at its half-hourly turn.  What one collection
    unlinks, the next one finds."""
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of undirected ``edges`` (``a``, ``b``, no nulls).

    Returns (``node``, ``root``) for every node of an edge; ``root`` is the
    component's smallest node.  Each round points all larger neighbours of a
    node to the smallest one (large star), then the smaller ones (small
    star); it ends when a round changes nothing, however many that takes.  Minima are pre-aggregated
    and stored before they are joined back, so a hub's edges can be split
    over tasks by adaptive skew handling.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                              F.least("a", "b").alias("b")).distinct(), f"{label}-e0")
    seen, i = None, 0
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), f"{label}-l{i}")
        large = (both.where("b > a").join(low, "a").where("b > m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = stored(large.unionByName(low.where("m < a").select("a", F.col("m").alias("b")))
                       .distinct(), f"{label}-g{i}")
        small = stored(large.groupBy("a").agg(F.min("b").alias("m")), f"{label}-s{i}")
        now = stored(large.join(small, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(small.select("a", F.col("m").alias("b"))).distinct(), f"{label}-e{i + 1}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen, i = state, i + 1
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    own = now.select(F.col("b").alias("node")).distinct().join(roots.select("node"), "node", "left_anti")
    return stored(roots.unionByName(own.select("node", F.col("node").alias("root"))), f"{label}-cc")
