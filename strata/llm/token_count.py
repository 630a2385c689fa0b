"""Token counts with a map-side two-tier lookup.

A text's token count is the sum of its pre-tokens' counts, so whole texts are
never encoded.  First tier: a compact table of the corpus's most frequent
pre-tokens and their token counts, at most ``table_rows`` entries of at most
``MAX_KEY`` characters, broadcast to all tasks.  It is built from counts over
all texts, of which each task hands on its ``per_task`` most frequent ones; no
pre-token stream is shuffled.  Second tier: each worker encodes what it does not
find there with the tokenizer itself and keeps the count in a bounded cache.
The tiers only decide where a count comes from, never what it is.

Where pre-tokens come from: texts of printable Latin-1 characters and white space
are lower-cased and cut by the pattern below, which is fast.  Any other text is cut at
the tokenizer's special strings (one token each), then normalised and split by the
tokenizer's own normaliser and pre-tokenizer.  Both kinds of pre-tokens go through
the same two tiers: the table holds the most frequent of both.

Null and empty texts have 0 tokens.  Very long texts are processed whole, one
text at a time.  Repeated rows are counted alike; an empty table gives an
empty result.  Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import most_frequent, ship, stored

MAX_KEY = 64
CACHE_ROWS = 400_000

# The tokenizer's own pre-token pattern, with letters and numbers
# spelled out for Latin-1, and the characters it is used for.
LETTER = "a-zA-ZªµºÀ-ÖØ-öø-ÿ"
NUMBER = "0-9²³¹¼½¾"
PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\s{LETTER}{NUMBER}]+")
PLAIN = re.compile(r"[\t\n\x0b\x0c\r -~\xa0-\xff]*")
SPECIAL = "<|"

_loaded: dict[int, object] = {}


def _tokenizer(spec: str):
    """The tokenizer of ``spec`` (its file's JSON text), parsed once a worker."""
    key = hash(spec)
    if key not in _loaded:
        from tokenizers import Tokenizer

        _loaded[key] = Tokenizer.from_str(spec)
    return _loaded[key]


def _plain(text: str) -> bool:
    return SPECIAL not in text and PLAIN.fullmatch(text) is not None


class Splitter:
    """Pre-tokens of a text.  Those of the tokenizer's own making are in its byte
    alphabet and carry ``MARK``, as they must not be split again."""

    MARK = "\0"

    def __init__(self, spec: str):
        self.tokenizer = _tokenizer(spec)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        # Cut at specials only where they are plain strings to the tokenizer as well.
        self.simple = all(not (t.normalized or t.lstrip or t.rstrip or t.single_word)
                          for t in self.tokenizer.get_added_tokens_decoder().values())

    def __call__(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, special strings found)."""
        if _plain(text):
            return PRE_TOKEN.findall(text.lower()), 0
        parts = self.special.split(text) if self.special else [text]
        out: list[str] = []
        for part in filter(None, parts):
            normal = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
            out += [self.MARK + piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return out, len(parts) - 1


def _count(tokenizer, token: str) -> int:
    if token.startswith(Splitter.MARK):
        return len(tokenizer.model.tokenize(token[1:]))
    return len(tokenizer.encode(token, add_special_tokens=False).ids)


class Lengths(dict):
    """Token counts by pre-token: the broadcast table, then this worker's cache."""

    def __init__(self, spec: str, table: dict[str, int]):
        super().__init__()
        self.table, self.tokenizer, self.split = table, _tokenizer(spec), Splitter(spec)

    def __missing__(self, token: str) -> int:
        n = self.table.get(token)
        if n is None:
            n = _count(self.tokenizer, token)
        if len(token) <= MAX_KEY:
            if len(self) >= CACHE_ROWS:
                self.clear()
            self[token] = n
        return n


def count_text(text: str | None, lengths: Lengths) -> int:
    if not text:
        return 0
    if not lengths.split.simple and not _plain(text):
        return len(lengths.tokenizer.encode(text, add_special_tokens=False).ids)
    tokens, special = lengths.split(text)
    return sum(map(lengths.__getitem__, tokens)) + special


def frequent_lengths(docs: DataFrame, spec: str, table_rows: int, per_task: int) -> dict[str, int]:
    """The broadcast tier: counts of the ``table_rows`` most frequent pre-tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(spec)

    def tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        split = Splitter(sent.value)
        for batch in batches:
            for text in batch["text"]:
                if text and (split.simple or _plain(text)):
                    seen.update(split(text)[0])
            if len(seen) > 4 * CACHE_ROWS:  # bounded memory: rare ones go
                seen = Counter(dict(seen.most_common(CACHE_ROWS)))
        top = [(t, n) for t, n in seen.most_common(per_task) if len(t) <= MAX_KEY]
        if top:
            yield pd.DataFrame(top, columns=["token", "n"])

    top = most_frequent(stored(docs.select("text").mapInPandas(tops, "token string, n long")
                               .groupBy("token").agg(F.sum("n").alias("n")), "token-counts"), table_rows)
    tokenizer = _tokenizer(spec)
    tokens = [r.token for r in top.toLocalIterator()]  # at most table_rows short strings
    return {t: _count(tokenizer, t) for t in tokens}


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, table_rows: int = 32_768,
                 per_task: int = 16_384) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:  # a few MB, read on the driver only
        spec = f.read()
    shared = spark.sparkContext.broadcast((spec, frequent_lengths(docs, spec, table_rows, per_task)))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths = Lengths(*shared.value)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"],
                                "n_tokens": [count_text(t, lengths) for t in batch["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return (rows.mapInPandas(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
