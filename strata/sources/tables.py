"""Table scans: the driver's parquet tables and written layer tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from strata.functions.typed import parse
from strata.spec import FeedSpec


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A parquet table ``<root>/<name>.parquet``; column pruning and filter
    pushdown reach the scan through Catalyst."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                mode: str = "overwrite") -> None:
    """Materialise a layer (full recompute, like a materialized view)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def evolved_schema(spark: SparkSession, spec: FeedSpec) -> StructType:
    """The types of a feed's staged columns, and of its computed key."""
    empty = spark.range(0).select(*[F.lit(None).cast("string").alias(f.name) for f in spec.fields])
    typed = empty.select(*[parse(f.kind, f.name).alias(f.name) for f in spec.fields])
    if spec.key_expr is not None:
        typed = typed.withColumn(spec.key[0], spec.key_expr())
    return StructType([StructField(f.name, f.dataType) for f in typed.schema])


def read_evolved(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """Staged rows that were appended while their feed gained columns: read under the
    feed's own columns and types, NULL where a file is older than a column.  No file
    footers are merged."""
    return spark.read.schema(evolved_schema(spark, spec)).parquet(path)


MARKERS = "_committed"
KEPT_VERSIONS = 3
_MARKER = "number bigint, slot int"


def _newest(spark: SparkSession, path: str):
    """(number, slot) of the newest committed version, or None."""
    try:
        rows = spark.read.schema(_MARKER).parquet(f"{path}/{MARKERS}")
    except AnalysisException:
        return None
    return rows.agg(F.max(F.struct("number", "slot"))).first()[0]


def write_version(df: DataFrame, path: str) -> str:
    """Materialise a layer as a new version of the table at ``path`` and return
    the version's folder.  The version counts once its commit marker is
    written, so readers keep the old one until then, and a failed run leaves
    it in place.  Versions are numbered and take turns in ``KEPT_VERSIONS``
    folders, so older ones go by themselves."""
    path = path.rstrip("/")
    spark = df.sparkSession
    last = _newest(spark, path)
    number = last.number + 1 if last else 0
    slot = number % KEPT_VERSIONS
    df.write.mode("overwrite").parquet(f"{path}/version-{slot}")
    marker = spark.range(1).select(F.lit(number).cast("bigint").alias("number"), F.lit(slot).alias("slot"))
    (marker.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("slot").parquet(f"{path}/{MARKERS}"))
    return f"{path}/version-{slot}"


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version of a table written by ``write_version``."""
    path = path.rstrip("/")
    newest = _newest(spark, path)
    if newest is None:
        raise ValueError(f"no committed version at {path}")
    return spark.read.parquet(f"{path}/version-{newest.slot}")
