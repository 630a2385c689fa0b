"""Bronze: landing JSON into raw tables under a declared envelope schema.

The record list is declared as a string, so the reader keeps it as raw JSON
whether it arrived as an array or as a lone object; staging parses it
(``strata.functions.records``).  This also keeps fields the schema does not
name, so new feed fields are never lost (SURVEY 1.4).  Unparsable documents
are kept with ``_corrupt_record`` set, instead of failing the batch (R3).
Side fields (offset, limit, total, recovery flag) are declared as text and cast
where they are used, so a mistyped one never costs a page its records.  Fields
outside the record list that the schema does not name stay readable in
``unknown``: raw JSON text by field name, for the envelope and its resource (S6).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, MapType, StringType, StructField, StructType

from strata.functions.typed import parse_ingest_ts
from strata.spec import FeedSpec

CORRUPT = "_corrupt_record"

METADATA_SCHEMA = StructType([
    StructField("ingested_at", StringType()),
    StructField("batch_id", StringType()),
    StructField("category", StringType()),
    StructField("entity", StringType()),
    StructField("script_name", StringType()),
    StructField("offset", StringType()),
    StructField("limit", StringType()),
    StructField("endpoint", StringType()),
    StructField("poison_pill_recovered", StringType()),
])


def envelope_schema(spec: FeedSpec, with_corrupt: bool = True) -> StructType:
    parts = spec.array_path.split(".")
    if len(parts) != 4 or parts[0] != "payload":
        raise ValueError("array_path must be payload.<Resource>.<Plural>.<Singular>")
    _, resource, plural, singular = parts
    payload = StructType([StructField(resource, StructType([
        StructField(plural, StructType([StructField(singular, StringType())])),
        StructField("Meta", StructType([StructField("TotalCount", StringType())])),
    ]))])
    fields = [StructField("ingestion_metadata", METADATA_SCHEMA), StructField("payload", payload)]
    if with_corrupt:
        fields.append(StructField(CORRUPT, StringType()))
    return StructType(fields)


UNKNOWN = "unknown"
_TEXT_MAP = MapType(StringType(), StringType())
UNKNOWN_SCHEMA = StructType([StructField("envelope", _TEXT_MAP), StructField("resource", _TEXT_MAP)])


def _unknown(document: str, spec: FeedSpec) -> Column:
    """All of a document but its payload's record list, as raw text by field:
    the envelope's own fields (metadata included) and those of its resource."""
    _, resource, plural, _ = spec.array_path.split(".")
    envelope = F.from_json(document, _TEXT_MAP)
    inner = F.from_json(F.get_json_object(document, f"$.payload.{resource}"), _TEXT_MAP)
    return F.struct(F.map_filter(envelope, lambda k, v: k != "payload").alias("envelope"),
                    F.map_filter(inner, lambda k, v: k != plural).alias("resource"))


def documents(reader, spec: FeedSpec, path: str | list[str], also: dict[str, Column] | None = None) -> DataFrame:
    """Landed documents under the declared schema, with lineage columns and those of
    ``also`` (expressions over ``_metadata``)."""
    lineage = [F.col("_metadata.file_path").alias("source_file"), *[c.alias(n) for n, c in (also or {}).items()]]
    names = ["source_file", *(also or {})]
    day = F.to_date(parse_ingest_ts(F.col("ingestion_metadata.ingested_at"))).alias("ingest_date")
    reader = reader.option("recursiveFileLookup", True)
    if not spec.keep_unknown:
        df = (reader.schema(envelope_schema(spec)).option("multiLine", spec.multiline)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path))
        return df.select("*", *lineage, day)
    text = reader.text(path, wholetext=spec.multiline)
    parsed = F.from_json("value", envelope_schema(spec),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (text.select("value", *lineage).where(F.length(F.trim("value")) > 0)
            .select(parsed.alias("_d"), _unknown("value", spec).alias(UNKNOWN), *names)
            .select("_d.*", UNKNOWN, *names).select("*", day))


def read_landing(spark: SparkSession, spec: FeedSpec, path: str, since: dt.date, until: dt.date) -> DataFrame:
    """Landed documents of the days (months, for reference feeds) from ``since`` to
    ``until``, both included: a backfill.  Only these folders are listed, whatever else
    the landing tree holds; folders may be plain or ``folder=`` ones."""
    days = [since + dt.timedelta(days=n) for n in range((until - since).days + 1)]
    folders = sorted({d.strftime("%Y-%m" if spec.category == "ref" else "%Y-%m-%d") for d in days})
    names = ",".join(f"{prefix}{f}" for f in folders for prefix in ("", "folder="))
    try:
        return documents(spark.read, spec, f"{path.rstrip('/')}/{{{names}}}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], bronze_schema(spec))


def stream_landing(spark: SparkSession, spec: FeedSpec, path: str,
                   max_files_per_trigger: int | None = None,
                   archive_dir: str | None = None) -> DataFrame:
    """Incremental read: each file is consumed once per checkpoint (ST3).

    The file source lists the whole landing tree on every trigger, and a feed
    of small pages grows by thousands of files a day.  With ``archive_dir``
    the source moves files of committed batches there (``cleanSource``; the
    files of one run are moved when the next run commits), so each listing
    covers about one run's files however long the feed has been running.
    ``archive_dir`` must lie outside ``path``.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return documents(r, spec, path)


def start_bronze(spark: SparkSession, spec: FeedSpec, landing: str, bronze: str,
                 checkpoint: str, max_files_per_trigger: int | None = None,
                 archive_dir: str | None = None) -> StreamingQuery:
    """Append-only bronze table, triggered run: process what has landed, stop
    (``availableNow``), partitioned by ingestion day for pruning."""
    return (stream_landing(spark, spec, landing, max_files_per_trigger, archive_dir)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .option("compression", "zstd")  # raw page text: half of what snappy leaves
            .partitionBy("ingest_date")
            .trigger(availableNow=True)
            .queryName(f"bronze_{spec.name}")
            .start(bronze))


def infer_schema(spark: SparkSession, path: str, multiline: bool = True,
                 sampling_ratio: float = 1.0) -> StructType:
    """Schema inferred from landed documents, to draft a declared schema.

    Inference is a development aid only: over files that mix an object and an
    array for one field it yields ``string``, and it cannot know fields no
    file contains yet (SURVEY 1.4), so feeds run on declared schemas.
    """
    return (spark.read.option("multiLine", multiline).option("recursiveFileLookup", True)
            .option("samplingRatio", sampling_ratio).json(path).schema)


def read_bronze(spark: SparkSession, path: str, spec: FeedSpec | None = None) -> DataFrame:
    """Bronze parquet.  With the feed's ``spec`` its declared schema is used
    and no file footer is opened for it; without, the schemas of older and
    newer files are merged (S6)."""
    if spec is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.read.schema(bronze_schema(spec)).parquet(path)


def bronze_schema(spec: FeedSpec) -> StructType:
    """The columns of a feed's bronze table."""
    unknown = [StructField(UNKNOWN, UNKNOWN_SCHEMA)] if spec.keep_unknown else []
    return StructType(envelope_schema(spec).fields + unknown + [
        StructField("source_file", StringType()), StructField("ingest_date", DateType())])


def corrupt_documents(bronze: DataFrame) -> DataFrame:
    """Documents that did not parse: the quarantine of the bronze layer.
    Apply it to stored bronze (``read_bronze``): Spark refuses to query a raw
    JSON scan on the corrupt-record column alone."""
    return bronze.filter(F.col(CORRUPT).isNotNull()).select("source_file", CORRUPT)

