"""Ingestion by a ledger of files: rewritten files are read again (S1, ST3).

The file stream remembers paths, so a page that is fetched again under its old name
is never reread.  Here a ledger table holds (path, modification time, size) of all
files read; a run reads the files that have no such entry.  Listing takes no file
contents, and of the date folders that hold a changed file only files of the changed
ones' times are opened.

Each run is a load: bronze rows and ledger entries carry its number, both written by
partition overwrite, bronze first.  A run that is lost before its ledger entry leaves
its number free, and the next run replaces its rows.  ``current_documents`` keeps, of
every document name or file, what its newest load brought.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strata.session import listing, small_files
from strata.sources.bronze import bronze_schema, documents
from strata.sources.landing import NAME_FOLDER
from strata.spec import FeedSpec

LOAD = "_load"
LEDGER = f"path string, modified timestamp, size bigint, {LOAD} bigint"


def document_key(path: Column) -> Column:
    """What a file is a version of: its name folder if it lies in one, else its path."""
    named = F.regexp_extract(path, f"^(.*/{NAME_FOLDER}=[^/]+)/", 1)
    return F.when(named != "", named).otherwise(path)


def _landed(spark: SparkSession, root: str) -> DataFrame:
    with listing(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def _plain(path: Column) -> Column:
    """One spelling for a path: the two readers differ in the slashes after its scheme."""
    return F.regexp_replace(path, "^(file|hdfs):/+", "$1:/")


def ingest_changed(spark: SparkSession, spec: FeedSpec, landing: str, bronze: str, ledger: str) -> int:
    """Read what is new or rewritten under ``landing`` into ``bronze``; the number of files."""
    with small_files(spark):
        return _ingest_changed(spark, spec, landing, bronze, ledger)


def _ingest_changed(spark: SparkSession, spec: FeedSpec, landing: str, bronze: str, ledger: str) -> int:
    known = _ledger(spark, ledger)
    changed = _landed(spark, landing).join(known.drop(LOAD), ["path", "modified", "size"], "left_anti")
    load = (known.agg(F.max(LOAD)).first()[0] or 0) + 1
    at = F.lit(load).cast("bigint").alias(LOAD)
    # The files of this run are settled by writing them; they count once bronze has their rows.
    todo_path = f"{ledger.rstrip('/')}_runs"
    _overwrite_load(changed.select("path", "modified", "size", at), todo_path)
    todo = spark.read.schema(LEDGER).parquet(todo_path).where(F.col(LOAD) == load)
    folders = todo.groupBy(F.regexp_extract("path", r"^(.*?)(/[^/]*=[^/]*)?/[^/]+$", 1).alias("folder")).agg(
        F.unix_micros(F.min("modified")).alias("since"), F.unix_micros(F.max("modified")).alias("until")).collect()
    if not folders:
        return 0
    entry = F.struct(_plain(F.col("path")).alias("file"), F.col("modified").alias("at"), F.col("size").alias("bytes"))
    with listing(spark):
        docs = documents(spark.read, spec, [r.folder for r in folders], also={
            "_file": _plain(F.col("_metadata.file_path")), "_at": F.col("_metadata.file_modification_time"), "_bytes": F.col("_metadata.file_size")})
    # Literal bounds of the listed times: files outside them are left out before any is opened.
    since, until = (F.timestamp_micros(F.lit(n)) for n in (min(r.since for r in folders), max(r.until for r in folders)))
    wanted = todo.select(entry.alias("e")).select("e.*")
    same = (F.col("_file") == F.col("file")) & (F.col("_at") == F.col("at")) & (F.col("_bytes") == F.col("bytes"))
    fresh = docs.where(F.col("_at").between(since, until)).join(wanted, same, "left_semi")
    _overwrite_load(fresh.drop("_file", "_at", "_bytes").select("*", at), bronze)
    _overwrite_load(todo, ledger)
    return todo.count()


def _overwrite_load(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(path)


def loaded_documents(spark: SparkSession, bronze: str, spec: FeedSpec) -> DataFrame:
    """Everything loaded, with its load number."""
    return spark.read.schema(bronze_schema(spec).add(LOAD, LongType())).parquet(bronze)


def current_documents(spark: SparkSession, bronze: str, spec: FeedSpec) -> DataFrame:
    """What every document's newest load brought."""
    rows = loaded_documents(spark, bronze, spec).withColumn("_doc", document_key(F.col("source_file")))
    newest = rows.groupBy("_doc").agg(F.max(LOAD).alias(LOAD))
    return rows.join(newest, ["_doc", LOAD], "left_semi").drop("_doc")
