"""Latest-wins on a stream (ST4).

Re-deliveries are resolved by recency, not event time.  Two sinks:

* ``complete``: a ``max_by`` aggregate per key is kept as state and the
  snapshot is rewritten each trigger - simple, for small key spaces.
* ``update``: no state.  Each trigger appends its own newest row per key, with
  the ordering it won by, to a change log tagged with the trigger epoch;
  readers resolve the log by that ordering (``read_latest``, a partial/final
  ``max_by``), so a late, older re-delivery loses there.  Work per trigger
  is O(changes), however many keys there are.
  ``compact_latest`` writes the resolved log as a versioned base; reads then
  combine the newest base with later epochs only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def latest_aggregate(stream: DataFrame, keys: Sequence[str], ordering: Sequence[str]) -> DataFrame:
    return _newest(stream, keys, ordering)


def _orderable(t: DataType) -> bool:
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return _orderable(t.elementType) if isinstance(t, ArrayType) else not isinstance(t, (MapType, VariantType))


def _newest(rows: DataFrame, keys: Sequence[str], ordering: Sequence[str]) -> DataFrame:
    """The row of the largest ``ordering`` per key.  The ordering leads one struct that
    holds every column once, and its maximum is the row: ``max_by`` would carry the
    ordering a second time through every shuffle.  It remains for columns that have no
    order (maps)."""
    rest = [c for c in rows.columns if c not in keys]
    first = [c for c in dict.fromkeys(ordering) if c in rest]
    after = [c for c in rest if c not in first]
    if all(_orderable(rows.schema[c].dataType) for c in after):
        # Key columns are equal inside a group and order nothing.
        row = F.max(F.struct(*first, *after)) if rest else F.first(F.struct(*keys))
    else:
        row = F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in ordering]))
    picked = rows.groupBy(*keys).agg(row.alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


EPOCH = "_epoch"
WON_BY = "_won_by"


def start_latest(spark: SparkSession, stream: DataFrame, keys: Sequence[str],
                 ordering: Sequence[str], out: str, checkpoint: str,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 mode: str = "complete") -> StreamingQuery:
    """Maintain the newest row per key at ``out`` (see the module doc)."""
    def write_snapshot(batch: DataFrame, _epoch: int) -> None:
        snap = transform(batch) if transform else batch
        snap.write.mode("overwrite").parquet(out)

    def append_changes(batch: DataFrame, epoch: int) -> None:
        # What a row won by is built from it after the shuffle.
        won_by = F.struct(*[F.col(c) for c in ordering]).alias(WON_BY)
        newest = latest_aggregate(batch, keys, ordering).select("*", won_by)
        changes = transform(newest) if transform else newest
        # Re-running an epoch after a failure overwrites its own partition.
        (changes.withColumn(EPOCH, F.lit(epoch).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(EPOCH).parquet(out))

    if mode not in ("complete", "update"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = latest_aggregate(stream, keys, ordering) if mode == "complete" else stream
    return (rows.writeStream.outputMode("complete" if mode == "complete" else "append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write_snapshot if mode == "complete" else append_changes)
            .trigger(availableNow=True)
            .start())


def _resolve(log: DataFrame, keys: Sequence[str], ordering: Sequence[str] | None = None) -> DataFrame:
    """The log's newest row per key.  ``ordering`` names the columns that ``WON_BY``
    repeats; then they alone are read and shuffled, and it is built again from them."""
    if ordering is None:
        return _newest(log, keys, [WON_BY, EPOCH]).drop(EPOCH)
    won_by = F.struct(*[F.col(c) for c in ordering]).alias(WON_BY)
    rows = _newest(log.drop(WON_BY), keys, [*ordering, EPOCH])
    return rows.select("*", won_by).select(*[c for c in log.columns if c != EPOCH])


UPTO = "upto"


def _version_path(base: str, upto: int) -> str:
    return f"{base.rstrip('/')}/epoch_{upto}"


def _marker_path(base: str) -> str:
    return f"{base.rstrip('/')}/_committed"


def _newest_base(spark: SparkSession, base: str) -> tuple[DataFrame, int] | None:
    """The newest compacted version whose commit marker exists, and the epoch
    it covers.  A compaction that died while writing has no marker and is
    never read."""
    try:
        markers = spark.read.parquet(_marker_path(base))
    except AnalysisException:
        return None
    upto = markers.agg(F.max(UPTO)).first()[0]
    if upto is None:
        return None
    rows = spark.read.parquet(_version_path(base, upto))
    return rows.withColumn(EPOCH, F.lit(upto).cast("bigint")), upto


def _on_base(spark: SparkSession, log: DataFrame, base: str | None) -> DataFrame:
    """Log epochs after the newest compacted version, plus that version."""
    found = _newest_base(spark, base) if base else None
    if found is None:
        return log
    rows, upto = found
    return log.filter(F.col(EPOCH) > F.lit(upto)).unionByName(rows.select(*log.columns))


def read_latest(spark: SparkSession, changes: str, keys: Sequence[str],
                base: str | None = None, ordering: Sequence[str] | None = None) -> DataFrame:
    """The newest row per key from an ``update``-mode change log: the row with
    the highest ordering, then epoch (an epoch holds one row per key).  With a
    compacted ``base`` (``compact_latest``), only epochs after the one it
    covers are read (a partition filter on the epoch), so the cost of a read
    follows the key count plus recent changes, not the whole history.  ``ordering``,
    that of ``start_latest``, may be given for logs written without a ``transform``:
    their rows hold these columns, so half of the log need not be read."""
    return _resolve(_on_base(spark, spark.read.parquet(changes), base), keys, ordering).drop(WON_BY)


def compact_latest(spark: SparkSession, changes: str, keys: Sequence[str],
                   base: str, ordering: Sequence[str] | None = None) -> int | None:
    """Write the resolved change log, up to its newest committed epoch, as a
    new version ``<base>/epoch_<n>``, then append its commit marker (one row
    in ``<base>/_committed``); return the epoch (None for an empty log).
    Readers only take marked versions, so a compaction lost half-way is
    invisible and is simply run again; versions are never rewritten with
    other rows, and older versions and epochs can be removed by retention.
    ``ordering`` is that of ``read_latest``."""
    log = spark.read.parquet(changes)
    upto = log.agg(F.max(EPOCH)).first()[0]
    if upto is None:
        return None
    # The marker table exists from the first compaction on (an empty append),
    # so looking for the newest base never probes a missing folder.
    spark.createDataFrame([], f"{UPTO} bigint").write.mode("append").parquet(_marker_path(base))
    committed = log.filter(F.col(EPOCH) <= F.lit(upto))
    _resolve(_on_base(spark, committed, base), keys, ordering) \
        .write.mode("overwrite").option("compression", "zstd").parquet(_version_path(base, upto))
    spark.range(1).select(F.lit(upto).cast("bigint").alias(UPTO)) \
        .coalesce(1).write.mode("append").parquet(_marker_path(base))
    return upto
