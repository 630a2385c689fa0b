"""Change-driven silver and gold: each run's cost follows what landed, not the history.

``refresh_changes`` runs the bronze streams and then, per feed, a second triggered
stream over the bronze table.  Each of its epochs

1. stages the epoch's documents (complete records of damaged ones included), counting
   rule passes on the way (``observe``), and stores the rows;
2. finds which parts of the silver layer they touch - a ``Layout`` puts all versions of
   a key into one part;
3. merges them with the newest versions those parts hold and rewrites these parts only,
   by dynamic partition overwrite.  The table holds the newest version of every key and
   whether it passes the feed's checks; silver is those that pass;
4. adds the epoch's failing rows to quarantine and its counts to the metrics table.

Parts that nothing touches are neither read nor written.  Merging the same rows again
changes nothing and quarantine, metrics and changes are overwritten by epoch, so an
epoch that is repeated after a lost executor or driver ends in the same tables.  With
``evolving`` feeds, columns that appear in an epoch's documents are added first
(``sources.discover``); older parts read them as NULL.

A part is rewritten as a whole: choose a layout that keeps what arrives together in few
parts (a range of keys or days), and as many parts as keep one small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from strata.operators.dedupe import REST, latest
from strata.operators.flatten import flatten
from strata.operators.quality import all_pass, counts_table, observe_rules, quarantine
from strata.operators.salvage import with_salvaged
from strata.plans.feeds import gold_flights
from strata.session import scratch_path
from strata.sources.bronze import read_bronze
from strata.sources.discover import appeared, evolve, recall, remember
from strata.sources.tables import evolved_schema
from strata.spec import QUARANTINE, SILVER, FeedSpec
from strata.streaming.ingest import ingest_feeds

PART, EPOCH, PASSES = "_part", "_epoch", "_passes"

@dataclass(frozen=True)
class Layout:
    """Which part a row belongs to: ``by``, a SQL expression over staged columns that is
    the same for all versions of a key, or by default the key's hash over ``parts``."""

    by: str | None = None
    parts: int = 64

    def column(self, spec: FeedSpec):
        if self.by:
            return F.coalesce(F.expr(self.by).cast("bigint"), F.lit(-1).cast("bigint"))
        return F.pmod(F.xxhash64(*spec.key), F.lit(self.parts).cast("bigint"))


@dataclass
class Changed:
    """Tables of one feed, and the epochs this run applied."""

    newest: str
    quarantine: str
    metrics: str
    changes: str
    spec: FeedSpec
    epochs: list[int] = field(default_factory=list)

    def read(self, spark: SparkSession, checked: bool = True) -> DataFrame:
        """Silver, or with ``checked`` off the newest version of every key, by part."""
        rows = _parts(spark, self.newest, self.spec)
        return rows.where(PASSES).drop(PASSES) if checked else rows


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions ``df`` has rows of, and no other."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(*by).parquet(path))


def _exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.schema("x int").parquet(path)
        return True
    except AnalysisException:
        return False


def _parts(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    schema = StructType([*evolved_schema(spark, spec).fields, StructField(PASSES, BooleanType()), StructField(PART, LongType())])
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def rewrite_parts(spark: SparkSession, staged: DataFrame, spec: FeedSpec, layout: Layout, path: str) -> list[int]:
    """Merge staged rows into the table at ``path``; return the parts rewritten."""
    drop = [r for r in spec.rules if r.action == "drop" and SILVER in r.applies_to and r.sql]
    new = staged.withColumn(PASSES, all_pass(drop)).withColumn(PART, layout.column(spec))
    for k in spec.key if spec.null_key_prefilter else ():
        new = new.filter(F.col(k).isNotNull())
    touched = sorted(r[0] for r in new.select(PART).distinct().collect())  # a number a part
    if not touched:
        return []
    old = _parts(spark, path, spec).where(F.col(PART).isin(touched))
    both = old.unionByName(new.select(*old.columns))
    ties = [*(spec.tie_break if spec.tie_break is not None else [REST])]
    merged = latest(both, [PART, *spec.key], spec.order, ties)
    # Stored before its parts are replaced, as it is read from them.
    held = scratch_path(spark, f"parts-{spec.name}")
    merged.write.option("compression", "zstd").parquet(held)
    _overwrite(spark.read.schema(merged.schema).parquet(held), path, PART)
    return touched


def start_changes(spark: SparkSession, spec: FeedSpec, bronze: str, layout: Layout, tables: Changed, checkpoint: str,
                  columns: str | None = None):
    """The triggered stream from a feed's bronze table into its parts."""

    def apply(documents: DataFrame, epoch: int) -> None:
        now = tables.spec
        if columns:
            found = appeared(documents, now)
            remember(spark, columns, now, found)
            now = tables.spec = evolve(now, found)
        rules = [r for r in now.rules if r.sql]
        observed: Observation | None = None
        rows = flatten(with_salvaged(documents, now), now)
        if rules:
            rows, observed = observe_rules(rows, rules, f"{now.category}_{now.name}_{epoch}")
        path = scratch_path(spark, f"staged-{now.name}")
        rows.write.option("compression", "zstd").parquet(path)
        staged = spark.read.schema(rows.schema).parquet(path)
        touched = rewrite_parts(spark, staged, now, layout, tables.newest)
        at = F.lit(epoch).cast("bigint").alias(EPOCH)
        if any(QUARANTINE in r.applies_to for r in now.rules):
            _overwrite(quarantine(staged, now.rules).select("*", at), tables.quarantine, EPOCH)
        if observed is not None:
            _overwrite(counts_table(spark, now.name, observed.get, rules).select("*", at), tables.metrics, EPOCH)
        done = spark.createDataFrame([(p,) for p in touched], f"{PART} bigint").coalesce(1)
        _overwrite(done.select("*", at), tables.changes, EPOCH)
        tables.epochs.append(epoch)

    source = spark.readStream.schema(read_bronze(spark, bronze, spec).schema).parquet(bronze)
    return (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).queryName(f"changes_{spec.name}").start())


def refresh_changes(spark: SparkSession, landing_root: str, out_root: str, feeds: Sequence[FeedSpec],
                    layouts: Mapping[str, Layout] | None = None, evolving: Sequence[str] = (),
                    max_files_per_trigger: int | None = None, archive_root: str | None = None) -> dict[str, Changed]:
    """Bring every enabled feed's parts up to date with what has landed."""
    out = out_root.rstrip("/")
    bronze = ingest_feeds(spark, feeds, landing_root, out, max_files_per_trigger=max_files_per_trigger, archive_root=archive_root)
    done, queries = {}, []
    for spec in feeds:
        if spec.name not in bronze:
            continue
        at = f"{spec.category}_{spec.name}"
        columns = f"{out}/columns/{at}" if spec.name in evolving else None
        now = recall(spark, columns, spec) if columns else spec
        tables = Changed(f"{out}/silver_parts/{at}", f"{out}/quarantine_epochs/{at}", f"{out}/metrics/{at}", f"{out}/changes/{at}", now)
        layout = (layouts or {}).get(spec.name, Layout())
        queries.append(start_changes(spark, spec, bronze[spec.name], layout, tables, f"{out}/_checkpoints/changes_{at}", columns))
        done[spec.name] = tables
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return done


def touched_parts(spark: SparkSession, tables: Changed) -> list[int]:
    """Parts that the epochs of this run rewrote."""
    if not tables.epochs:
        return []
    rows = spark.read.schema(f"{PART} bigint, {EPOCH} bigint").parquet(tables.changes).where(F.col(EPOCH).isin(tables.epochs))
    return sorted(r[0] for r in rows.select(PART).distinct().collect())


def refresh_gold(spark: SparkSession, changed: Mapping[str, Changed], path: str) -> list[int]:
    """The flight fact in the flights' parts: those this run rewrote, or all of them when
    a dimension changed.  Returns the parts written; see ``read_gold``."""
    dims = ("airports", "airlines", "aircraft", "countries")
    flights = changed["flights"].read(spark, checked=False)
    parts = touched_parts(spark, changed["flights"])
    if any(touched_parts(spark, changed[d]) for d in dims) or not _exists(spark, path):
        parts = sorted(r[0] for r in flights.select(PART).distinct().collect())
    if parts:
        airports, airlines, aircraft, countries = [changed[d].read(spark).drop(PART) for d in dims]
        # Flights that fail their checks stay as flagged rows, so a part never runs empty.
        _overwrite(gold_flights(flights.where(F.col(PART).isin(parts)), airports, airlines, aircraft, countries,
                                keep=(PASSES, PART)), path, PART)
    return parts


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(PASSES).drop(PASSES, PART)
