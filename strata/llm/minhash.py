"""Near-duplicate documents by circulant MinHash and exact Jaccard.

A document's set holds its distinct 5-word shingles (A-Z lower-cased, words
split at space and \\x09-\\x0D) as 64-bit hashes.  Two permutations of the
64-bit numbers give all signature coordinates: the first scatters the set,
the second is shifted circularly by k for coordinate k.  Bands of ``rows``
coordinates make buckets.  Two sets at the threshold of 0.75 meet in no bucket
with probability (1 - 0.75^4)^32, five in a million.

Links are never guessed from signatures; every one is confirmed on full sets:

* equal sets form a class; one node stands for it, so exact copies (however
  many) never meet each other;
* each node is first checked against the bucket leader it shares most buckets
  with: one pair a node.  Components of these links are found;
* buckets that still hold several components are checked pair by pair across
  components, in blocks of ``block`` nodes: every pair of blocks is a group of
  its own, and only links that join components leave it.  So a bucket of any
  size is compared in full, yet no task holds more than two blocks and no
  row is made per pair.

Texts are shuffled once (distinct ones only) to bring the sets of nodes that
share a bucket together.  Bucket counts are pre-aggregated.

Null or empty texts, or texts of white space only, have no set: n_shingles 0,
component_id the own doc_id, kept.  Fewer than five words form one shingle.
Rows that share a doc_id are told apart by their sets.  A null doc_id links
like any other, but never names a component unless no member has an id (then
component_id is null); it is kept only in that case.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import components, release, ship, stored
from strata.llm.hashing import U, mix

class WordHashes(dict):
    """64-bit hash by word, computed once while it stays in this cache."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 300_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, hashes: WordHashes, gram: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, U)
    w = np.fromiter(map(hashes.__getitem__, words), U, len(words))
    size = min(gram, len(w))
    out = w[:len(w) - size + 1].copy()
    for j in range(1, size):
        out = mix(out + U(j)) + w[j:len(w) - size + 1 + j]
    return np.unique(mix(out + U(1000 + size)))


def signature(grams: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """``length`` coordinates from two permutations, the second one shifted."""
    shift = np.arange(length, dtype=U)
    low = np.full(length, U(2**64 - 1))
    for at in range(0, len(grams), 1024):
        # First permutation, then all shifts of its result at once.
        first = mix(grams[at:at + 1024] + U(seed), 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
        low = np.minimum(low, mix(first[:, None] - shift[None, :]).min(axis=0))
    return low


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = sig.reshape(bands, rows)
    key = np.arange(bands, dtype=U)
    for j in range(rows):
        key = mix(key + part[:, j])
    return key


def _signed(docs: DataFrame, gram: int, bands: int, rows: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = {"n": [], "f1": [], "f2": [], "bands": []}
            for text in batch["text"]:
                g = shingles(text, hashes, gram)
                out["n"].append(len(g))
                out["f1"].append(mix(g + U(7)).sum(dtype=U).astype(np.int64))
                out["f2"].append(np.bitwise_xor.reduce(mix(g + U(11)), initial=U(0)).astype(np.int64))
                keys = band_keys(signature(g, bands * rows), bands, rows) if len(g) else np.empty(0, U)
                out["bands"].append(keys.view(np.int64))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_key": batch["text_key"], **out})

    return (docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
            .mapInPandas(run, f"doc_id {kind}, text_key long, n long, f1 long, f2 long, bands array<long>"))


def _sets(docs: DataFrame, nodes: DataFrame, gram: int) -> DataFrame:
    """(node, grams) for ``nodes`` (node, text_key): one text a key is hashed anew."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"],
                                "grams": [shingles(t, hashes, gram).view(np.int64) for t in batch["text"]]})

    texts = docs.groupBy(F.xxhash64("text").alias("text_key")).agg(F.first("text").alias("text"))
    return texts.join(nodes, "text_key").select("node", "text").mapInPandas(run, "node long, grams array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets meet the threshold."""
    p = (pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
         .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b"))
    both = F.size(F.array_intersect("ga", "gb"))
    return p.where(den * both >= num * (F.size("ga") + F.size("gb") - both)).select("a", "b")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every left with every right set (sorted, distinct)."""
    rows = np.concatenate([np.full(len(x), i) for i, x in enumerate(left)] or [np.empty(0, int)])
    cols = np.concatenate([np.full(len(x), i) for i, x in enumerate(right)] or [np.empty(0, int)])
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    keep_a, keep_b = np.isin(a, shared), np.isin(b, shared)
    a, rows = np.searchsorted(shared, a[keep_a]), rows[keep_a].astype(np.int64)
    b, cols = np.searchsorted(shared, b[keep_b]), cols[keep_b].astype(np.int64)
    out = np.zeros((len(left), len(right)), np.float32)
    step = 4096
    for at in range(0, len(shared), step):
        x, y = (a >= at) & (a < at + step), (b >= at) & (b < at + step)
        p = np.zeros((len(left), step), np.float32)
        q = np.zeros((len(right), step), np.float32)
        p[rows[x], a[x] - at] = 1
        q[cols[y], b[y] - at] = 1
        out += p @ q.T
    return out


def _across(bucketed: DataFrame, sets: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """Links between nodes of different components in the same bucket.

    ``bucketed``: (key, size, node, root).  A bucket's nodes are dealt into
    blocks; each pair of blocks is compared in its own group.
    """
    n_blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    dealt = (bucketed.withColumn("blocks", n_blocks)
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                     "own", "node", "root"))
    schema = "a long, b long"

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(group["bi"].iloc[0]), int(group["bj"].iloc[0])
        left = group[group["own"] == lo]
        right = group[group["own"] == hi]
        if not len(left) or not len(right) or group["root"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        ls, rs = [np.asarray(x) for x in left["grams"]], [np.asarray(x) for x in right["grams"]]
        both = overlaps(ls, rs).astype(np.int64)
        union = np.array([len(x) for x in ls])[:, None] + np.array([len(x) for x in rs])[None, :] - both
        ra, rb = left["root"].to_numpy(), right["root"].to_numpy()
        i, j = np.nonzero((den * both >= num * union) & (ra[:, None] != rb[None, :]))
        # One link for each pair of components and left node is enough to join them.
        out = pd.DataFrame({"a": left["node"].to_numpy()[i], "b": right["node"].to_numpy()[j],
                            "ra": ra[i], "rb": rb[j]}).drop_duplicates(["ra", "rb"])
        return out[["a", "b"]]

    return (dealt.join(sets, "node").select("key", "bi", "bj", "own", "node", "root", "grams")
            .groupBy("key", "bi", "bj").applyInPandas(compare, schema))


def near_duplicates(docs: DataFrame, num: int = 75, den: int = 100, gram: int = 5, bands: int = 32,
                    rows: int = 4, block: int = 256) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key, root) for every row of
    ``docs`` (doc_id, text); links are sets with ``den * intersection >= num *
    union``.  ``text_key`` hashes the text, ``root`` tells components apart."""
    spark = docs.sparkSession
    ship(spark)
    sig = stored(_signed(docs, gram, bands, rows), "minhash-signatures")
    cls = (sig.where("n > 0").groupBy("n", "f1", "f2")
           .agg(F.min("doc_id").alias("min_id"), F.min("text_key").alias("text_key"), F.first("bands").alias("bands")))
    # A class's node is its smallest doc_id; a second class of that id, or one without ids, takes its hash.
    own = F.row_number().over(Window.partitionBy(F.coalesce("min_id", "f1")).orderBy("f1", "f2")) == 1
    cls = stored(cls.withColumn("node", F.when(F.col("min_id").isNotNull() & own, F.col("min_id")).otherwise(F.col("f1"))),
                 "minhash-classes")
    release(spark)
    banded = cls.select(F.explode("bands").alias("key"), "node", "n")
    buckets = stored(banded.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("size"))
                     .where("size > 1"), "minhash-buckets")
    members = stored(banded.join(buckets, "key"), "minhash-members")
    nodes = members.select("node").distinct()
    sets = stored(_sets(docs, cls.select("node", "text_key").join(nodes, "node"), gram), "minhash-sets")
    release(spark)
    best = (members.where("node <> lead").groupBy("node", "lead").agg(F.count("*").alias("shared"))
            .groupBy("node").agg(F.max_by("lead", F.struct("shared", -F.col("lead"))).alias("lead")))
    first = stored(_linked(best.select(F.col("node").alias("a"), F.col("lead").alias("b")), sets, num, den),
                   "minhash-links")
    release(spark)
    roots = components(first, "minhash-a")
    placed = (members.join(roots, "node", "left")
              .select("key", "size", "node", F.coalesce("root", "node").alias("root")))
    mixed = (placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo <> hi").select("key"))
    mixed = stored(mixed, "minhash-mixed")
    more = stored(_across(placed.join(mixed, "key"), sets, num, den, block), "minhash-more")
    release(spark)
    if not more.isEmpty():
        roots = components(first.unionByName(more), "minhash-b")
    named = cls.join(roots, "node", "left").select("n", "f1", "f2", "min_id", F.coalesce("root", "node").alias("root"))
    linked = cls.join(roots, "node").groupBy("root").agg(F.min("min_id").alias("least"))
    named = stored(named.join(linked, "root", "left").select(
        "n", "f1", "f2", "root", F.coalesce("least", "min_id").alias("component_id")), "minhash-named")
    out = sig.drop("bands").join(named, ["n", "f1", "f2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key", "root")
