"""Landing documents: records grouped into pages and wrapped in the envelope.

The envelope is ``{ingestion_metadata: {...}, payload: {<Resource>: {<Plural>:
{<Singular>: records}, Meta: {TotalCount}}}}``.  A page holding one record can
be written as a lone object (the feed's quirk, SURVEY N2/G17).  Everything is
built with column expressions, so landing files are produced by executors.

Pages are bounded by construction: a page is a group of records sharing a
page key, and callers choose keys that hold at most ``page_size`` records
(a key range over a unique integer key, or a record ordinal within a bounded
parent).  No group is ever the whole feed.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.keys import content_id
from strata.session import file_names, local_folder


def pages_by_key_range(df: DataFrame, key: str, page_size: int) -> Column:
    """Offset of the page holding ``key`` when pages cover key ranges of
    ``page_size``: with a unique key, no page exceeds ``page_size`` records."""
    return (F.floor(F.col(key) / F.lit(page_size)) * F.lit(page_size)).cast("bigint")


def with_position_pages(df: DataFrame, page_size: int, page_col: str = "page_id",
                        pos_col: str = "_pos") -> DataFrame:
    """Add a row position and a page id from it.  Positions are consecutive
    inside an input partition, so each page holds at most ``page_size`` rows
    however the keys are distributed, and the position is a cheap sort key
    inside the page.  Apply it directly over a scan (deterministic input
    splits) so a recomputed task produces the same pages."""
    pos = df.select("*", F.monotonically_increasing_id().alias(pos_col))
    return pos.withColumn(page_col, F.floor(F.col(pos_col) / F.lit(page_size)).cast("bigint"))


def to_pages(df: DataFrame, page_cols: Sequence[Column | str], record: Column,
             sort_key: Column, extra: Sequence[Column] = (), distinct: bool = False) -> DataFrame:
    """Group records into pages; records inside a page are sorted by
    ``sort_key`` so a page's text is deterministic.  ``extra`` aggregates
    (page attributes) are computed in the same pass.  ``distinct`` drops
    repeated records inside the aggregation buffer (map-side too), so a page
    holds at most its number of distinct records.  NULL records are skipped,
    so a page key without records gets an empty list."""
    item = F.when(record.isNotNull(), F.struct(sort_key.alias("k"), record.alias("r")))
    collect = F.collect_set if distinct else F.collect_list
    grouped = df.groupBy(*page_cols).agg(F.array_sort(collect(item)).alias("_items"), *extra)
    # Field access on an array of structs yields the array of that field.
    return grouped.withColumn("records", F.col("_items.r")).drop("_items")


def records_json(records: Column | str, single_as_object: bool = True) -> Column:
    arr = F.col(records) if isinstance(records, str) else records
    if not single_as_object:
        return F.to_json(arr)
    return F.when(F.size(arr) == 1, F.to_json(arr[0])).otherwise(F.to_json(arr))


def envelope_json(records: Column, resource: str, plural: str, singular: str,
                  metadata: Column, total_count: Column | None = None,
                  single_as_object: bool = True) -> Column:
    """The landing document as JSON text."""
    meta_block = F.to_json(F.struct(
        (total_count if total_count is not None else F.size(records).cast("bigint")).alias("TotalCount")))
    return F.format_string(
        '{"ingestion_metadata":%s,"payload":{"%s":{"%s":{"%s":%s},"Meta":%s}}}',
        F.to_json(metadata), F.lit(resource), F.lit(plural), F.lit(singular),
        records_json(records, single_as_object), meta_block)


def ingestion_metadata(category: str, entity: str, ingested_at: Column, script: str,
                       offset: Column | None = None, limit: int | None = None,
                       endpoint: str | None = None, batch_seed: Column | None = None) -> Column:
    """Envelope metadata; ``batch_id`` is a content hash of the document's
    identity (deterministic, unlike a random uuid, so reruns are idempotent)."""
    fields = [
        F.date_format(ingested_at, "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
        content_id(F.lit(category), F.lit(entity),
                   batch_seed if batch_seed is not None else F.lit(""),
                   offset if offset is not None else F.lit("")).alias("batch_id"),
        F.lit(category).alias("category"),
        F.lit(entity).alias("entity"),
        F.lit(script).alias("script_name"),
    ]
    if offset is not None:
        fields.append(offset.cast("bigint").alias("offset"))
    if limit is not None:
        fields.append(F.lit(limit).cast("int").alias("limit"))
    if endpoint is not None:
        fields.append(F.lit(endpoint).alias("endpoint"))
    return F.struct(*fields)


def partition_folder(category: str, ingested_at: Column) -> Column:
    """``ref`` feeds land in month folders, ``ops`` feeds in day folders."""
    return F.date_format(ingested_at, "yyyy-MM" if category == "ref" else "yyyy-MM-dd")


def document_name(*parts: Column | str) -> Column:
    """File-name stem of a document (hub + time, entity + day, route ...)."""
    return F.concat_ws("_", *[F.col(p) if isinstance(p, str) else p for p in parts])


LANDING_FILE_DOCUMENTS = 10_000


def write_landing(docs: DataFrame, path: str, text_col: str = "document",
                  folder_col: str = "folder", mode: str = "append") -> None:
    """Write documents as gzipped JSON lines under ``folder=<date>`` sub-folders.

    Pages repeat their field names in every record, so packing them (at gzip's
    fastest level) leaves a small part of the text to store and read.  A packed file
    is read by one task: a file holds at most ``LANDING_FILE_DOCUMENTS`` documents,
    whatever one task writes.  The bronze reader reads such feeds with
    ``multiline=False``.  Single pretty-printed files (``multiline=True``) are read
    the same way, one document per file.
    """
    (docs.select(F.col(text_col).alias("value"), F.col(folder_col))
         .write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
         .option("maxRecordsPerFile", LANDING_FILE_DOCUMENTS).partitionBy(folder_col).text(path))


NAME_FOLDER = "doc_name"


def write_named_landing(docs: DataFrame, path: str, name_col: str, text_col: str = "document",
                        folder_col: str = "folder") -> None:
    """Write every document as a file of its own under its date folder and name
    (``folder=<date>/doc_name=<name>/``), as the feed lands its pages.  A document that
    lands again under its name replaces the earlier file, and no other.

    Spark's writer does it wherever the folder is.  In a local (or mounted) one, Hadoop
    starts a ``chmod`` process for each folder and file it makes, so there the tasks make
    the same files themselves."""
    named = docs.select(F.col(text_col).alias("value"), F.col(folder_col).alias("folder"), F.col(name_col).alias(NAME_FOLDER))
    if (root := local_folder(docs.sparkSession, path)) is not None:
        _write_local(named, root)
        return
    (named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("folder", NAME_FOLDER).text(path))


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")
CHECKED_BYTES = 512


def _lander(staging: str, run: str, spelling: str = "UTF-8") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task of a local write does.  It goes to the workers whole, so that they need
    not have this package.  ``spelling`` is how the JVM spells file names, which it lists."""

    def folder_name(column: str, value: str | None) -> str:
        """The folder Spark's writer gives a partition value."""
        return f"{column}={ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', value) if value else NO_VALUE}"

    def write_text(folder: bytes, name: bytes, lines: Iterable[bytes | None]) -> None:
        """A text file, with the checksum file beside it by which Hadoop's local file
        system checks what it reads."""
        with open(b"%b/%b" % (folder, name), "wb") as out, open(b"%b/.%b.crc" % (folder, name), "wb") as sums:
            sums.write(b"crc\0" + CHECKED_BYTES.to_bytes(4, "big"))
            rest = b""
            for line in lines:
                data = (line or b"") + b"\n"
                out.write(data)
                rest += data
                whole = len(rest) - len(rest) % CHECKED_BYTES
                sums.write(b"".join(zlib.crc32(rest[i:i + CHECKED_BYTES]).to_bytes(4, "big") for i in range(0, whole, CHECKED_BYTES)))
                rest = rest[whole:]
            if rest:
                sums.write(zlib.crc32(rest).to_bytes(4, "big"))

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt = f"{staging}/{task.taskAttemptId()}"
        rows = ([c[i].as_py() for c in b.columns] for b in batches for i in range(b.num_rows))
        for (day, name), same in groupby(rows, key=lambda r: (r[1], r[2])):
            folder = f"{attempt}/{folder_name('folder', day)}/{folder_name(NAME_FOLDER, name)}".encode(spelling, "replace")
            os.makedirs(folder)
            write_text(folder, f"part-{task.partitionId():05d}-{run}.c000.txt".encode(), (r[0] for r in same))
        if os.path.isdir(attempt):
            yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    return land


def _write_local(named: DataFrame, root: str) -> None:
    """Tasks write under a folder of their attempt, which readers do not see; once all
    have ended, the driver moves the documents of the attempts that counted in place."""
    run = uuid.uuid4().hex
    staging = f"{root}/.landing-{run}"
    # Sorted, a task's documents of one name follow each other, empty names being none.
    texts = named.select(F.col("value").cast("binary").alias("value"),
                         *[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("folder", NAME_FOLDER)])
    os.makedirs(root, exist_ok=True)
    land = _lander(staging, run, file_names(named.sparkSession))
    try:
        attempts = texts.sortWithinPartitions("folder", NAME_FOLDER).mapInArrow(land, "attempt string").collect()  # a row a task
        placed = set()
        for attempt in (r.attempt for r in attempts):
            for day in sorted(os.listdir(attempt)):
                os.makedirs(f"{root}/{day}", exist_ok=True)
                for name in os.listdir(f"{attempt}/{day}"):
                    _place(f"{attempt}/{day}/{name}", f"{root}/{day}/{name}", keep=(day, name) in placed)
                    placed.add((day, name))
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def _place(folder: str, at: str, keep: bool) -> None:
    """Move a document's folder to ``at``, to what is there (``keep``) or in its place."""
    if keep:
        for file in os.listdir(folder):
            os.rename(f"{folder}/{file}", f"{at}/{file}")
        return
    if os.path.lexists(at):
        shutil.rmtree(at)
    os.rename(folder, at)


def name_of(path: Column) -> Column:
    """The document name that a landed file's path carries; NULL without one."""
    return F.nullif(F.regexp_extract(path, f"/{NAME_FOLDER}=([^/]+)/", 1), F.lit(""))


def write_landings(batches: Sequence[tuple[DataFrame, str]], **options) -> None:
    """Write several feeds' documents at once: each write is its own Spark
    job, submitted from its own driver thread, so the jobs share the cluster
    instead of queueing (small reference feeds are dominated by per-job
    overhead).  The first failure is raised."""
    if not batches:
        return
    with ThreadPoolExecutor(max_workers=len(batches)) as pool:
        for f in [pool.submit(write_landing, docs, path, **options) for docs, path in batches]:
            f.result()
