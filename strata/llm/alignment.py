"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A is a byte-level BPE file of the tokenizers library, given a space and the text;
B is a sentencepiece model, given the text, before which it puts a space.  Both are
read as byte ranges of space + text.  Where tokens of both end, a group ends; an A
and a B token whose ranges overlap are a link.

How often an id pair is linked in the whole corpus is counted by external spill
counting.  Every task turns its documents' links into records (B id, A id, document,
times), sorts them side-major (B id first) in memory up to ``run_links`` links, deals
them out over ``radix`` parts by B id and writes each part as a zstd run: its pairs
with their sums, and its records.  Runs are a stored table.  The pair lists of a part
are then merged with a heap, at most ``fan_in`` runs at a time and pass after pass
until one is left, so memory follows the number of distinct pairs and not the corpus;
as B ids are in order, each B id's highest count is known when its pairs have passed.
Counts go back to the runs of their part, which stream each document's sums.  Runs
hold bounded work whatever they hold, so a B id with a third of all links is spread
over as many tasks as any other.

Null and empty texts, and texts whose tokens do not spell space + text (a text with
U+2581, say), have no tokens: zeros and an empty digest.  A text is encoded whole, so
a worker needs about 100 bytes a byte of its longest text.  Repeated rows and doc_ids
are rows of their own; ties for a B id's highest count all count as best.  An empty
table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship, stored
from strata.session import scratch_path

ID_BITS, SLOT_BITS = 20, 24  # a record's sort key: B id, A id, slot of the document in its run
RUN_DOCS = 16_384

# The split pattern of byte-level BPE files that name no other.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_SPACE = re.compile(r"\s{10000}")
FAST_UNCHECKED = 10_000

_loaded: dict[int, "Pair"] = {}


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 stands for
    itself, the other bytes for the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Two tokenizers and the bytes of their tokens."""

    def __init__(self, spec: str, model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        alphabet, vocab = byte_alphabet(), self.library.get_vocab(with_added_tokens=True)
        special = {t["content"] for t in json.loads(spec).get("added_tokens", [])}
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.bytes_a[i] = entry.encode() if entry in special else bytes(alphabet[c] for c in entry)
        self.fast = self._fast(json.loads(spec), special)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        p = self.pieces
        self.bytes_b = [bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i)
                        else p.id_to_piece(i).replace("▁", " ").encode() for i in range(p.get_piece_size())]
        self.len_a = np.array([len(b) for b in self.bytes_a])
        self.len_b = np.array([len(b) for b in self.bytes_b])
        self.offset = 2 * len(self.bytes_a)
        # Ids as text with what follows them: an A id is followed by a comma or, at a group's end, a bar; a B id by a
        # comma or a semicolon.
        self.text = [f"{i}{c}" for i in range(len(self.bytes_a)) for c in ",|"]
        self.text += [f"{i}{c}" for i in range(len(self.bytes_b)) for c in ",;"]

    def _fast(self, spec: dict, special: set[str]):
        """The same encoding by a rank table, four times as fast; None for files it does
        not hold for: merges must be numbered in the order they are applied, and nothing
        but the standard split may come before them."""
        import tiktoken

        m, pre = spec["model"], spec["pre_tokenizer"]
        merges = [x if isinstance(x, list) else x.split(" ") for x in m["merges"]]
        first = min((m["vocab"]["".join(x)] for x in merges), default=0)
        plain = (spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
                 and m["type"] == "BPE" and not m.get("dropout") and not m.get("ignore_merges") and first == 256
                 and all(m["vocab"]["".join(x)] == first + i for i, x in enumerate(merges)))
        if not plain:
            return None
        ranks = {self.bytes_a[i]: i for entry, i in m["vocab"].items() if entry not in special}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """A and B ids of ``text``; None when they do not spell space + text."""
        spaced = " " + text
        # The rank table's pattern fails on endless white space.
        if self.fast and (len(text) < FAST_UNCHECKED or not LONG_SPACE.search(text)):
            a = self.fast.encode_ordinary(spaced)
        else:
            a = self.library.encode(spaced, add_special_tokens=False).ids
        b = self.pieces.encode(text)
        want = spaced.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def match(self, a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, str]:
        """(groups, links as B id << ID_BITS | A id, digest) of two id lists."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        at = np.searchsorted(end_b, end_a)
        cut_a = end_b[at] == end_a  # both end with the text, so no place is beyond the last
        cut_b = np.zeros(len(b), dtype=bool)
        cut_b[at[cut_a]] = True
        # Every stretch between two ends of either side lies in one token of each: a link.
        ends = np.sort(np.concatenate([end_a, end_b[~cut_b]]))
        links = (b[np.searchsorted(end_b, ends)] << ID_BITS) | a[np.searchsorted(end_a, ends)]
        # Groups side by side: A ids of a group, then its B ids.
        stop_a, stop_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        out = np.empty(len(a) + len(b), dtype=np.int64)
        out[np.arange(len(a)) + np.concatenate([[0], stop_b])[group_a]] = 2 * a + cut_a
        out[np.arange(len(b)) + stop_a[group_b]] = self.offset + 2 * b + cut_b
        text = "".join(map(self.text.__getitem__, out.tolist()))[:-1]
        return len(stop_a), links, hashlib.sha256(text.encode()).hexdigest()


def _pair(spec: str, model: bytes) -> Pair:
    key = hash((spec, model))
    if key not in _loaded:
        _loaded[key] = Pair(spec, model)
    return _loaded[key]


def pack(*columns: np.ndarray) -> bytes:
    """Columns of integers as differences, compressed: sorted columns become small."""
    raw = [np.diff(c, prepend=0).astype(np.int64) for c in columns]
    head = np.array([len(c) for c in raw], dtype=np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, *(c.tobytes() for c in raw)]))


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.int64)
    return [np.cumsum(c) for c in np.split(raw[columns:], np.cumsum(raw[:columns])[:-1])]


def spill(keys: np.ndarray, radix: int) -> Iterator[tuple[int, bytes, bytes]]:
    """One run's records, from unsorted sort keys: (part, pairs, records) per part.
    ``pairs``: pair and times; ``records``: records a pair, slot and times a record."""
    keys = np.sort(keys)
    new = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    times = np.diff(new, append=len(keys))
    pair, slot = keys[new] >> SLOT_BITS, keys[new] & ((1 << SLOT_BITS) - 1)
    part = (pair >> ID_BITS) % radix
    order = np.argsort(part, kind="stable")  # each part stays in side-major order
    stops = np.searchsorted(part[order], np.arange(radix + 1))
    for i in range(radix):
        own = order[stops[i]:stops[i + 1]]
        if len(own):
            first = np.flatnonzero(np.diff(pair[own], prepend=-1))
            held = np.diff(first, append=len(own))
            yield i, pack(pair[own][first], np.add.reduceat(times[own], first)), pack(held, slot[own], times[own])


WORK = ("kind string, run long, slot long, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "part long, pairs binary, records binary")


def spilled(docs: DataFrame, shared, kind: str, run_links: int, radix: int) -> tuple[DataFrame, DataFrame]:
    """Encode all texts once: the stored (documents, runs)."""
    spark = docs.sparkSession

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = _pair(*shared.value)
        run, slot, held, keys = TaskContext.get().partitionId() << 32, 0, 0, []

        def runs() -> pd.DataFrame:
            rows = list(spill(np.concatenate(keys), radix))
            return pd.DataFrame({"kind": "run", "run": run, "slot": None, "doc_id": None, "n_a": None, "n_b": None, "n_groups": None,
                                 "n_links": None, "groups_sha256": None, "part": [r[0] for r in rows],
                                 "pairs": [r[1] for r in rows], "records": [r[2] for r in rows]})

        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = pair.encode(text) if text else None
                row = (0, 0, 0, 0, "")
                if ids:
                    groups, links, digest = pair.match(*ids)
                    keys.append((links << SLOT_BITS) | slot)
                    held += len(links)
                    row = (len(ids[0]), len(ids[1]), groups, len(links), digest)
                out.append(("doc", run, slot, doc_id, *row, None, None, None))
                slot += 1
                if held >= run_links or slot >= RUN_DOCS:
                    if keys:
                        yield runs()
                    run, slot, held, keys = run + 1, 0, 0, []
            yield pd.DataFrame(out, columns=["kind", "run", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links",
                                             "groups_sha256", "part", "pairs", "records"])
        if keys:
            yield runs()

    path = scratch_path(spark, "alignment-runs")
    # As text, since pandas would turn integer ids next to nulls into floats.
    docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(work, WORK).write.partitionBy("kind").parquet(path)
    done = spark.read.schema(WORK).parquet(path)
    return (done.where("kind = 'doc'").select("run", "slot", F.col("doc_id").cast(kind), "n_a", "n_b", "n_groups", "n_links", "groups_sha256"),
            done.where("kind = 'run'").select("part", "run", "pairs", "records"))


def merge(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (pair, times) lists as one, by a heap."""
    pairs, times, last = [], [], -1
    for pair, n in heapq.merge(*(zip(p.tolist(), t.tolist()) for p, t in lists)):
        if pair == last:
            times[-1] += n
        else:
            pairs.append(pair)
            times.append(n)
            last = pair
    return np.array(pairs, dtype=np.int64), np.array(times, dtype=np.int64)


def count_pairs(runs: DataFrame, fan_in: int) -> DataFrame:
    """(part, counts): every part's pairs with their corpus-wide counts and whether the
    count is its B id's highest, packed.  Passes of at most about ``fan_in`` runs."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        pair, n = merge([tuple(unpack(blob, 2)) for blob in rows["pairs"]])
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "run": [rows["run"].min()], "pairs": [pack(pair, n)]})

    def rated(rows: pd.DataFrame) -> pd.DataFrame:
        pair, n = merge([tuple(unpack(blob, 2)) for blob in rows["pairs"]])
        first = np.flatnonzero(np.diff(pair >> ID_BITS, prepend=-1))  # side-major: a B id's pairs are neighbours
        highest = np.repeat(np.maximum.reduceat(n, first), np.diff(first, append=len(pair)))
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "counts": [pack(pair, n, (n == highest).astype(np.int64))]})

    now, i = runs.select("part", "run", "pairs"), 0
    while True:
        most = now.groupBy("part").count().agg(F.max("count")).first()[0] or 0
        if most <= fan_in:
            return stored(now.groupBy("part").applyInPandas(rated, "part long, counts binary"), "alignment-counts")
        lots = -(-most * 2 // fan_in)
        lot = F.pmod(F.xxhash64("run"), F.lit(lots)).alias("lot")
        i += 1
        now = stored(now.groupBy("part", lot).applyInPandas(lambda rows: one(rows), "part long, run long, pairs binary"),
                     f"alignment-pass{i}")


def contributions(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, slot, n_best, count_sum): what every part's counts add to each document."""

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, known = None, None
        for batch in batches:
            for row in batch.itertuples():
                if row.part != part:
                    part, known = row.part, unpack(row.counts, 3)
                pair, _ = unpack(row.pairs, 2)
                held, slot, times = unpack(row.records, 3)
                at = np.repeat(np.searchsorted(known[0], pair), held)
                best, total = (np.zeros(slot.max() + 1, dtype=np.int64) for _ in range(2))
                np.add.at(best, slot, times * known[2][at])
                np.add.at(total, slot, times * known[1][at])
                own = np.flatnonzero(total)
                yield pd.DataFrame({"run": row.run, "slot": own, "n_best": best[own], "count_sum": total[own]})

    each = runs.join(counts, "part").mapInPandas(streamed, "run long, slot long, n_best long, count_sum long")
    return each.groupBy("run", "slot").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, path_a: str, path_b: str, run_links: int = 2_000_000, radix: int = 32,
          fan_in: int = 64) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_a, n_b, n_groups, n_links, n_best, count_sum
    and the digest of its groups ``a1,a2|b1;a3|b2,b3``."""
    spark = docs.sparkSession
    ship(spark)
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:  # a few MB, read on the driver only
        shared = spark.sparkContext.broadcast((f.read(), g.read()))
    done, runs = spilled(docs, shared, docs.schema["doc_id"].dataType.simpleString(), run_links, radix)
    sums = contributions(runs, count_pairs(runs, fan_in))
    zero = F.lit(0).cast("long")
    return done.join(sums, ["run", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
