"""Spelling variants: words one insertion, deletion or replacement apart.

The method is a dictionary of trie-node pairs.  Every distinct prefix of the
words is a node of a forward trie, every distinct suffix one of a reversed trie,
and nodes are plain integers.  A word of length L has L *skip* pairs (node before
position i, node after it) and L + 1 *gap* pairs (nodes on both sides of a
boundary).  Words with a common skip pair differ by one replacement; a skip pair
that equals another word's gap pair is one deletion.  Both nodes name their
strings exactly, so there is nothing to verify and nothing is missed.

Numbering: words are sorted by range over all tasks; a word adds one node for
each code point beyond what it shares with the word before it.  A node that
reaches over a task's border can only be a prefix of the task's first word, so
one row a task is enough to give it its earlier number.

A pair names all of a word but one code point, so a group of equal pairs holds at
most one word per code point of the alphabet (90 for the query's words) and one
gap: bounded groups, whatever the word counts.  Inside a group only counts and
the two best words are taken; pairs of words are never listed.

Null text: no words.  A null doc_id counts as an empty one.  Repeated rows count
as often as they occur.  Words may be as long as a text; a word of L code points
gives 2 L + 1 small rows.  Ties of count go to the smaller word in code-point
order.  An empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship, stored
from strata.llm.url_filter import LOWER, UPPER

RUN = "[A-Za-zÀ-ÿ]+"
ROOT = -1  # the empty prefix or suffix
TASK_NODES = 1 << 40
GAP, SKIP, LAST_SKIP = 0, 1, 2
OUT_ROWS = 100_000


def word_runs(docs: DataFrame, slip_every: int | None = None) -> DataFrame:
    """(word) per maximal run of letters.  With ``slip_every``, a run loses one code
    point when that number divides the crc32 ``h`` of ``<doc_id>:<run>``: the one at
    ``h % length``."""
    run = F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    if not slip_every:
        return runs.select(F.col("run").alias("word"))
    h = F.crc32(F.concat_ws(":", "id", "run"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.select(F.when(h % slip_every == 0, cut).otherwise(F.col("run")).alias("word"))


def count_words(runs: DataFrame, min_length: int, min_count: int) -> DataFrame:
    """(word, n): counts are made per task first, so a word with a third of all
    occurrences is one row a task."""
    return (runs.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


def _shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def trie_paths(keys: DataFrame, label: str) -> tuple[DataFrame, dict[int, tuple[int, list[int]]]]:
    """Number the trie of the distinct ``key`` strings.

    Returns the stored table (key, part, place, path) - ``path`` holds the
    task-local number of each prefix, shortest first - and for each task (its rank
    in key order, the final numbers of the nodes it shares with earlier tasks)."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        last, path, used, place = "", [], 0, 0
        for batch in batches:
            paths = []
            for key in batch["key"]:
                same = _shared(last, key)
                path = path[:same] + list(range(used, used + len(key) - same))
                used += len(key) - same
                paths.append(path)
                last = key
            yield pd.DataFrame({"key": batch["key"], "part": part, "place": range(place, place + len(paths)), "path": paths})
            place += len(paths)

    done = stored(keys.repartitionByRange("key").sortWithinPartitions("key")
                  .mapInPandas(number, "key string, part long, place long, path array<long>"), label)
    edges = done.groupBy("part").agg(F.min("key").alias("first"), F.max(F.struct("key", "path")).alias("last"))
    renamed: dict[int, tuple[int, list[int]]] = {}
    before, before_path = "", []  # the word before a task's first one, with final numbers
    for rank, e in enumerate(sorted(edges.collect(), key=lambda r: r.first)):  # one row a task
        renamed[e.part] = (rank, before_path[:_shared(before, e.first)])
        before, before_path = e.last.key, final_nodes(e.part, np.array(e.last.path), renamed).tolist()
    return done, renamed


def final_nodes(part: int, path: np.ndarray, renamed: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """A path's task-local numbers as numbers of the whole trie.  The first word of a
    task has the local numbers 0, 1, ..., so its shared nodes are the smallest."""
    old = np.array(renamed[part][1], dtype=np.int64)
    out = path + part * TASK_NODES
    if len(old):
        inside = path < len(old)
        out[inside] = old[path[inside]]
    return out


def node_pairs(words: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(id, word, n) and the dictionary (p, s, id, n, kind) of distinct words."""
    spark = words.sparkSession
    ship(spark)
    ahead, ahead_names = trie_paths(words.select(F.col("word").alias("key")), f"{label}-ahead")
    back, back_names = trie_paths(words.select(F.reverse("word").alias("key")), f"{label}-back")
    shared = spark.sparkContext.broadcast((ahead_names, back_names))
    schema = "id long, word string, n long, p array<long>, s array<long>"

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, names_back = shared.value
        for b in batches:
            root = np.array([ROOT], dtype=np.int64)
            p = [np.concatenate([root, final_nodes(part, np.asarray(path), names)]) for part, path in zip(b["part"], b["path"])]
            s = [np.concatenate([root, final_nodes(part, np.asarray(path), names_back)])[::-1]
                 for part, path in zip(b["back_part"], b["back_path"])]
            ids = [names[part][0] * TASK_NODES + place for part, place in zip(b["part"], b["place"])]
            yield pd.DataFrame({"id": ids, "word": b["word"], "n": b["n"], "p": p, "s": s})

    both = (words.join(ahead.withColumnRenamed("key", "word"), "word")
            .join(back.select(F.reverse("key").alias("word"), F.col("part").alias("back_part"),
                              F.col("path").alias("back_path")), "word"))
    nodes = stored(both.mapInPandas(numbered, schema), f"{label}-nodes")

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, held = [], 0
            for id_, word, n, p, s in zip(b["id"], b["word"], b["n"], b["p"], b["s"]):
                size = len(word)
                letters = np.array(list(word) + [""])
                # Of a run of equal letters only the last is skipped for deletions: the others give the same word.
                kind = np.where(letters[:-1] != letters[1:], LAST_SKIP, SKIP)
                out.append((np.concatenate([p[:-1], p]), np.concatenate([s[1:], s]), np.full(2 * size + 1, id_),
                            np.full(2 * size + 1, n), np.concatenate([kind, np.full(size + 1, GAP)])))
                held += 2 * size + 1
                if held >= OUT_ROWS:
                    yield pd.DataFrame(dict(zip(("p", "s", "id", "n", "kind"), map(np.concatenate, zip(*out)))))
                    out, held = [], 0
            if out:
                yield pd.DataFrame(dict(zip(("p", "s", "id", "n", "kind"), map(np.concatenate, zip(*out)))))

    pairs = nodes.mapInPandas(listed, "p long, s long, id long, n long, kind int")
    return nodes.select("id", "word", "n"), pairs


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are near, and the one of largest n as
    (n, -id); words without any are left out."""
    skip, last = F.col("kind") != GAP, F.col("kind") == LAST_SKIP
    group = Window.partitionBy("p", "s")
    ordered = group.orderBy((F.col("kind") == GAP).asc(), F.col("n").desc(), F.col("id"))
    entry = F.struct("n", (-F.col("id")).alias("minus_id"))

    def top(cond: Column) -> Column:
        return F.max(F.when(cond, entry)).over(group)

    at = F.row_number().over(ordered)
    g = pairs.select("*", at.alias("at")).select(
        "*", F.count_if(skip).over(group).alias("skips"), F.count_if(last).over(group).alias("lasts"),
        top(skip & (F.col("at") == 1)).alias("top1"), top(skip & (F.col("at") == 2)).alias("top2"),
        top(last).alias("top_last"), top(~skip).alias("whole"))
    other = F.when(F.col("at") == 1, F.col("top2")).otherwise(F.col("top1"))
    shorter = F.when(last, F.col("whole"))
    found = g.select(
        "id",
        F.when(skip, F.col("skips") - 1 + shorter.isNotNull().cast("long")).otherwise(F.col("lasts")).alias("near"),
        F.when(skip, F.greatest(other, shorter)).otherwise(F.col("top_last")).alias("best")).where("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame, label: str) -> DataFrame:
    """(id, root) of (id, form): follow forms to the last one.  Every round doubles the
    steps taken; counts grow at each step, so it ends after a few rounds."""
    now, i = stored(forms.select("id", F.col("form").alias("root")), f"{label}-r0"), 0
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        if not now.join(ahead, "root", "left_semi").limit(1).count():
            return now
        i += 1
        now = stored(now.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root")), f"{label}-r{i}")


def group_variants(words: DataFrame, factor: int = 5, label: str = "spelling") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct (word, n).  A word's form is
    its near word of largest n when that n is at least ``factor`` times its own."""
    words, pairs = node_pairs(stored(words.select("word", "n"), f"{label}-words"), label)
    near = stored(near_words(pairs), f"{label}-near")
    rated = words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best.n") >= factor * F.col("n"), -F.col("best.minus_id")).alias("form"))
    rated = stored(rated, f"{label}-rated")
    ends = roots(rated.where("form is not null").select("id", "form"), label)
    named = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    rooted = ends.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return (rated.join(named, "form", "left").join(rooted, "id", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"),
                    "n", "n_near", "form_n"))


ORACLE_SQL = rf"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '{RUN}')), '{UPPER}', '{LOWER}') AS run FROM documents) GROUP BY 1, 2),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
    CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195, ord(c)::BIGINT - 64] END))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h FROM runs, crc),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (SELECT word, substring(word, 1, i - 1) || '_' || substring(word, i + 1) AS hole,
                 substring(word, 1, i - 1) || substring(word, i + 1) AS short
          FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)),
pairs AS (SELECT a.word AS x, b.word AS y FROM holes a JOIN holes b USING (hole) WHERE a.word <> b.word
    UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.short
    UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.short),
near AS (SELECT x, count(*) AS n_near, first({{'y': y, 'n': n}} ORDER BY n DESC, y) AS best
         FROM pairs JOIN words ON word = y GROUP BY x),
rated AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 5 * n THEN best.y END AS form,
                 CASE WHEN best.n >= 5 * n THEN best.n END AS form_n FROM words LEFT JOIN near ON x = word),
steps AS (SELECT word, form AS root, 1 AS depth FROM rated WHERE form IS NOT NULL
    UNION ALL SELECT s.word, r.form, depth + 1 FROM steps s JOIN rated r ON r.word = s.root WHERE r.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, depth) AS root FROM steps GROUP BY word)
SELECT r.word, form, coalesce(e.root, r.word) AS root, n, n_near, form_n FROM rated r LEFT JOIN ends e USING (word)"""
