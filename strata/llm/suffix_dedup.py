"""Suffix-array dedup: repeated strings removed by distributed prefix doubling.

A byte goes when a ``length``-byte string that covers it also starts earlier
(smaller doc_id, or same document and earlier start).  Positions are ranked by
what follows them, at growing lengths, and leave as soon as they are decided:

1. Inside a task, ranks double: the name of 2L bytes at a position is made of
   the names of its two halves, up to 64 bytes; any length in between is a pair
   of overlapping names.  No shuffle is needed, as names are hashes and equal
   in all tasks.
2. Sorted by Spark at ``length / 2`` bytes.  A string is represented by the
   position of its smallest 50-byte name, so runs of neighbouring strings share
   one position and only about one position in 27 is sorted.  A name that is
   unique ends the matter for its run: no string of it repeats.
3. The next offset: name and name of the whole stretch the run covers are
   sorted as a pair.  All but the first of equal stretches repeat in full.  A
   first stretch whose name also occurs in another one stays undecided.
4. Past the threshold: every position of the undecided runs is sorted by the
   pair of its ranks at offsets 0 and ``length - 64``; all but the first of
   equal pairs repeat.

A literal doubling that sorts every byte position each round would move some
hundred bytes a byte of text; here most positions are decided before anything
moves.  Repeats inside a task are settled there, so a passage that a third of
all documents share is one row a task, not one a document.  Ranks are 128 bits
in step 3 and 96 bits in step 4.

A name that many documents share - a line shorter than ``length`` that a third of
them hold - keeps a row a document, as the stretches around it differ.  No task gets
them all: whether a name has several stretches comes from a pre-aggregated minimum
and maximum, names that occur once leave before any ranking, and ranks are taken
within (name, stretch).

Null and empty texts, and those shorter than ``length``, lose nothing.  A null
doc_id comes after all others.  Rows that share a doc_id (or lack one) count as
documents of their own, in the order of a hash of their text, equal texts next to
each other.  Very long texts are named in windows of ``WINDOW`` bytes, so a worker
needs a few copies of the text and about 60 MB besides.  An empty table gives an empty
result.  Other columns pass through ``remove_repeats`` untouched, whatever their
names; the result's name is a parameter, and one that a column already has is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import release, ship, stored
from strata.llm.hashing import U, mix

TOP = 64
FLUSH = 400_000
WINDOW = 1 << 19
LAST = 2**63 - 1
BYTE_NAMES = mix(np.arange(1, 257, dtype=U) * U(0x2545F4914F6CDD1D))


def names(data: np.ndarray, top: int = TOP) -> dict[int, np.ndarray]:
    """Names of all 1, 2, 4 ... ``top``-byte strings, by doubling."""
    out, size = {1: BYTE_NAMES[data]}, 1
    while size < top and len(out[size]) > size:
        h = out[size]
        out[2 * size] = mix(h[:-size] * U(3) + h[size:])
        size *= 2
    return out


def named(table: dict[int, np.ndarray], size: int, count: int) -> np.ndarray:
    """Names of the first ``count`` strings of ``size`` bytes: a pair of overlapping names."""
    half = 1 << (size.bit_length() - 1)
    h = table[half]
    return h[:count] if half == size else mix(h[:count] * U(5) + h[size - half:size - half + count])


def _lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    size, y = 1, x
    while 2 * size <= width:
        y = np.minimum(y[:-size], y[size:])
        size *= 2
    count = len(x) - width + 1
    return np.minimum(y[:count], y[width - size:width - size + count])


def runs(data: np.ndarray, length: int):
    """Runs of neighbouring ``length``-byte strings that one position stands for.

    Returns arrays (name, stretch name, start, strings in the run, whether
    the position's name occurs twice in the stretch).
    """
    n, gram = len(data), length // 2
    width = length - gram + 1
    table = names(data)
    g = named(table, gram, n - gram + 1)
    low = _lowest(g, width)
    start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    end = np.concatenate([start[1:], [len(low)]])
    # Long runs (periodic text) are cut so that a stretch stays within three names.
    pieces = -(-(end - start) // width)
    which = np.repeat(np.arange(len(start)), pieces)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start, stop = start[which] + nth * width, np.minimum(start[which] + (nth + 1) * width, end[which])
    first = start + g[start[:, None] + np.arange(width)].argmin(axis=1)
    last = stop - 2 + width - g[(stop - 2 + width)[:, None] - np.arange(width)].argmin(axis=1)
    size = stop - start + length - 1
    h = table[TOP]
    whole = mix(h[start] * U(7) + size.astype(U))
    whole = mix(whole * U(3) + h[start + np.minimum(TOP, size - TOP)])
    whole = mix(whole * U(3) + h[start + size - TOP])
    return low[start], whole, start, stop - start, first != last


def _firsts(keys: list[np.ndarray], place: list[np.ndarray]) -> np.ndarray:
    """True for the earliest row of every key."""
    order = np.lexsort(place[::-1] + keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    out = np.empty(len(order), dtype=bool)
    out[order] = new
    return out


def joined_spans(doc: np.ndarray, copy: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Maximal spans of every (doc, copy) from overlapping or touching ones."""
    order = np.lexsort((start, copy, doc))
    doc, copy, start, end = doc[order], copy[order], start[order], end[order]
    if not len(doc):
        return doc, copy, start, end
    other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1])])
    base = np.cumsum(other) * np.int64(2**33)  # keeps the reach of one document from the next
    reach = np.maximum.accumulate(end + base)
    new = np.concatenate([[True], (start + base)[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    stop = np.concatenate([at[1:], [len(doc)]]) - 1
    return doc[at], copy[at], start[at], (reach - base)[stop]


RUN_SCHEMA = "name long, whole long, doc long, copy long, start int, size int, kind byte"
FIRST, FIRST_TWICE, REPEAT = 0, 1, 2


def _run_rows(length: int):
    """Runs of a task's documents; repeats within the task leave as spans."""

    def flush(parts) -> pd.DataFrame:
        name, whole, doc, copy, start, size, twice = (np.concatenate(c) for c in zip(*parts))
        first = _firsts([name, whole], [doc, copy, start])
        d, c, s, e = joined_spans(doc[~first], copy[~first], start[~first], (start + size + length - 1)[~first])
        own = mix(d.astype(U) * U(3) + mix(s.astype(U) + (c.astype(U) << U(32))))
        return pd.DataFrame({
            "name": np.concatenate([name[first], own]).view(np.int64),
            "whole": np.concatenate([whole[first], own]).view(np.int64),
            "doc": np.concatenate([doc[first], d]), "copy": np.concatenate([copy[first], c]),
            "start": np.concatenate([start[first], s]).astype(np.int32),
            "size": np.concatenate([size[first], e - s]).astype(np.int32),
            "kind": np.concatenate([twice[first].astype(np.int8), np.full(len(d), REPEAT, np.int8)])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for batch in batches:
            for doc, copy, text in zip(batch["doc"], batch["copy"], batch["text"]):
                data = np.frombuffer(text.encode(), dtype=np.uint8) if text else np.empty(0, np.uint8)
                if len(data) < length:
                    continue
                # Strings that begin in a window; a string's name does not depend on where windows lie.
                for at in range(0, len(data) - length + 1, WINDOW):
                    name, whole, start, size, twice = runs(data[at:at + WINDOW + length - 1], length)
                    parts.append((name, whole, np.full(len(name), doc), np.full(len(name), copy), start + at, size, twice))
                    held += len(name)
                    if held >= FLUSH:
                        yield flush(parts)
                        parts, held = [], 0
        if parts:
            yield flush(parts)

    return run


COPY_PARTS = 4096
PLACE_SCHEMA = "r1 long, r2 int, doc long, copy long, start int, size int"


def _place_rows(length: int):
    """Rank pairs of all positions in the undecided runs of each document;
    repeats within the task leave as spans (``size`` above 0)."""

    def flush(parts) -> pd.DataFrame:
        r1, r2, doc, copy, start = (np.concatenate(c) for c in zip(*parts))
        first = _firsts([r1, r2], [doc, copy, start])
        d, c, s, e = joined_spans(doc[~first], copy[~first], start[~first], start[~first] + length)
        own = mix(d.astype(U) * U(3) + mix(s.astype(U) + (c.astype(U) << U(32))))
        return pd.DataFrame({
            "r1": np.concatenate([r1[first], own]).view(np.int64),
            "r2": np.concatenate([r2[first], own.astype(np.uint32)]).view(np.int32),
            "doc": np.concatenate([doc[first], d]), "copy": np.concatenate([copy[first], c]),
            "start": np.concatenate([start[first], s]).astype(np.int32),
            "size": np.concatenate([np.zeros(first.sum(), np.int64), e - s]).astype(np.int32)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for batch in batches:
            for doc, copy, text, begins, sizes in zip(batch["doc"], batch["copy"], batch["text"],
                                                      batch["begins"], batch["sizes"]):
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                begins, sizes = np.asarray(begins, dtype=np.int64), np.asarray(sizes, dtype=np.int64)
                window = begins // WINDOW
                for nth in np.unique(window).tolist():
                    b, z, low = begins[window == nth], sizes[window == nth], nth * WINDOW
                    h = names(data[low:int((b + z).max()) + length])[TOP]
                    at = np.repeat(b - np.cumsum(z) + z, z) + np.arange(z.sum())
                    left, right = h[at - low], h[at - low + length - TOP]
                    parts.append((mix(left * U(3) + right), mix(left + right * U(9)).astype(np.uint32),
                                  np.full(len(at), doc), np.full(len(at), copy), at))
                    held += len(at)
                    if held >= FLUSH:
                        yield flush(parts)
                        parts, held = [], 0
        if parts:
            yield flush(parts)

    return run


def _with_place(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_row, text, _doc, _copy): all of ``docs`` in a struct, whose names cannot clash,
    and a document key: the id (null last), and a number that tells rows sharing an id
    or lacking one apart."""
    rows = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_doc"))
    shared = docs.groupBy(id_col).count().where((F.col("count") > 1) | F.col(id_col).isNull())
    if shared.isEmpty():
        return rows.withColumn("_copy", F.lit(0).cast("long"))
    # Many parts: rows without an id may be a third of the table.
    part = F.pmod(F.xxhash64("text"), F.lit(COPY_PARTS))
    rank = F.row_number().over(Window.partitionBy("_doc", "_part").orderBy("text"))
    return stored(rows.withColumn("_part", part)
                  .withColumn("_copy", (F.col("_part") * F.lit(2**40) + rank).cast("long")).drop("_part"), "suffix-docs")


def repeated_spans(placed: DataFrame, length: int = 100) -> DataFrame:
    """(_doc, _copy, begins, ends): spans of repeats, possibly overlapping, by document."""
    if not TOP <= length <= 2 * TOP:
        raise ValueError("length must be between 64 and 128")
    spark = placed.sparkSession
    ship(spark)
    rows = (placed.select(F.col("_doc").alias("doc"), F.col("_copy").alias("copy"), "text")
            .where(F.octet_length("text") >= length))
    # Found twice, by the same tasks over the same files: cheaper than keeping all runs on disk.
    found = rows.mapInPandas(_run_rows(length), RUN_SCHEMA)
    alike = (found.groupBy("name").agg(F.min("whole").alias("lo"), F.max("whole").alias("hi"), F.count("*").alias("rows"),
                                       F.max(F.when(F.col("kind") != FIRST, 1)).alias("own")))
    # One row of its own kind: its run does not repeat, nothing is left to settle.
    alike = stored(alike.where("rows > 1 or own = 1").select("name", (F.col("lo") != F.col("hi")).alias("several")), "suffix-alike")
    release(spark)
    earliest = Window.partitionBy("name", "whole").orderBy("doc", "copy", "start")
    ranked = found.join(alike, "name").withColumn("nth", F.row_number().over(earliest))
    undecided = (F.col("kind") != REPEAT) & (F.col("nth") == 1) & (F.col("several") | (F.col("kind") == FIRST_TWICE))
    repeat = (F.col("kind") == REPEAT) | (F.col("nth") > 1)
    bytes_of = F.when(F.col("kind") == REPEAT, F.col("size")).otherwise(F.col("size") + length - 1)
    ranked = stored(ranked.where(undecided | repeat)
                    .select("doc", "copy", "start", F.when(undecided, F.col("size")).otherwise(bytes_of).alias("size"),
                            undecided.alias("undecided")), "suffix-runs")
    release(spark)
    todo = (ranked.where("undecided").groupBy("doc", "copy")
            .agg(F.collect_list(F.struct("start", "size")).alias("r"))
            .select("doc", "copy", F.col("r.start").alias("begins"), F.col("r.size").alias("sizes")))
    places = (rows.join(todo, ["doc", "copy"]).select("doc", "copy", "text", "begins", "sizes")
              .mapInPandas(_place_rows(length), PLACE_SCHEMA))
    nth = F.row_number().over(Window.partitionBy("r1", "r2").orderBy("doc", "copy", "start"))
    more = (places.withColumn("nth", nth).where("size > 0 or nth > 1")
            .select("doc", "copy", "start", F.when(F.col("size") > 0, F.col("size")).otherwise(length).alias("size")))
    more = stored(more, "suffix-places")
    release(spark)
    spans = ranked.where("not undecided").select("doc", "copy", "start", "size").unionByName(more)
    return (spans.groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "size")).alias("r"))
            .select(F.col("doc").alias("_doc"), F.col("copy").alias("_copy"), F.col("r.start").alias("_begins"),
                    F.transform("r", lambda x: x["start"] + x["size"]).alias("_ends")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   with_kept: bool = False, into: str = "_cut") -> DataFrame:
    """``docs`` with a struct column ``into``: n_bytes, n_removed, n_spans,
    kept_sha256 and, ``with_kept``, ``kept`` (the remaining bytes) and
    ``kept_text`` (the remaining whole characters)."""
    if into in docs.columns:
        raise ValueError(f"the input already has a column {into!r}")
    placed = _with_place(docs, id_col, text_col)
    spans = repeated_spans(placed, length)
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, kept_text string" * with_kept

    @F.pandas_udf(schema)
    def cut(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for text, b, e in zip(texts, begins, ends):
            data = text.encode() if text else b""
            pieces, spans_n = [data], 0
            if b is not None and len(b):
                b, e = np.asarray(b, dtype=np.int64), np.asarray(e, dtype=np.int64)
                zero = np.zeros(len(b), dtype=np.int64)
                _, _, b, e = joined_spans(zero, zero, b, e)
                edges = [0, *np.stack([b, e], axis=1).ravel().tolist(), len(data)]
                pieces = [data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)]
                spans_n = len(b)
            kept = b"".join(pieces)
            row = (len(data), len(data) - len(kept), spans_n, hashlib.sha256(kept).hexdigest())
            if with_kept:
                row += (kept, None if text is None else "".join(p.decode("utf-8", "ignore") for p in pieces))
            out.append(row)
        return pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])

    done = placed.join(spans, ["_doc", "_copy"], "left").select("_row", cut(F.col("text"), F.col("_begins"), F.col("_ends")).alias("_done"))
    return done.select("_row.*", F.col("_done").alias(into))
