"""SentencePiece encoding and decoding over a distinct-chunk table.

When no piece of the model continues past a white-space marker, a text's ids
are the ids of its marked words one after the other.  So words are segmented
once each and texts are joined back from a table:

1. every task counts the distinct words of its own texts; the counts are
   added up over all tasks, and the ``table_rows`` most frequent words (of at
   most ``MAX_KEY`` characters) are segmented once each as a Spark job.  That
   table has a fixed bound and is broadcast;
2. every task walks its texts word by word and takes each word's ids by
   position from that table, or from a table of the task's own rarer
   distinct words, each segmented when first met.

Texts never move: no text, position or id list is shuffled.  The distinct-word
counts are the only exchange, one row a word and task, for words that a task
holds at least twice.  A model with a piece that does cross a marker, or one
that normalises texts, is detected and its texts are segmented whole.

Null and empty texts encode to the begin and end ids alone and decode to an
empty text.  Very long texts and words are processed whole.  Repeated rows
are treated alike; an empty table gives an empty result; only the named
columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import most_frequent, ship, stored

MARK = "▁"
MAX_KEY = 64
CACHE_ROWS = 120_000
MARKED = re.compile(r" +[^ ]*")

_loaded: dict[int, object] = {}


def _model(proto: bytes):
    """The model of ``proto`` (its file's bytes), parsed once a worker."""
    key = hash(proto)
    if key not in _loaded:
        import sentencepiece

        _loaded[key] = sentencepiece.SentencePieceProcessor(model_proto=proto)
    return _loaded[key]


def words_stay_apart(proto: bytes) -> bool:
    """True if no piece holds a marker after another character and the model takes
    every character as it is, white space too, behind one marker."""
    model = _model(proto)
    every = "  " + "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000) + "  "
    if model.normalize(every) != MARK + every.replace(" ", MARK):
        return False
    return not any(re.search(f"[^{MARK}]{MARK}", model.id_to_piece(i)) for i in range(model.get_piece_size()))


def marked_words(text: str) -> list[str]:
    """Words of ``text`` without the one marker each of them starts with."""
    text = text.replace(MARK, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [w[1:] for w in MARKED.findall(" " + text)]


def word_ids(word: str, model) -> bytes:
    """Ids of one marked word as little-endian unsigned 32-bit integers."""
    ids = model.encode(word) if word else [model.piece_to_id(MARK)]
    return np.array(ids, dtype="<u4").tobytes()


class WordTable(dict):
    """Ids by word: the broadcast table, then the task's own distinct words."""

    def __init__(self, proto: bytes, table: dict[str, bytes]):
        super().__init__()
        self.table, self.model = table, _model(proto)

    def __missing__(self, word: str) -> bytes:
        ids = self.table.get(word)
        if ids is None:
            ids = word_ids(word, self.model)
        if len(word) <= MAX_KEY:
            if len(self) >= CACHE_ROWS:
                self.clear()
            self[word] = ids
        return ids


def encode_text(text: str | None, words: WordTable, apart: bool = True) -> bytes:
    """Ids of a whole text with begin and end ids, as bytes."""
    model = words.model
    if not text:
        body = b""
    elif apart:
        body = b"".join(map(words.__getitem__, marked_words(text)))
    else:
        body = np.array(model.encode(text), dtype="<u4").tobytes()
    begin, end = np.array([model.bos_id()], dtype="<u4"), np.array([model.eos_id()], dtype="<u4")
    return begin.tobytes() + body + end.tobytes()


def distinct_word_table(docs: DataFrame, proto: bytes, table_rows: int) -> dict[str, bytes]:
    """The ``table_rows`` most frequent marked words with their ids."""

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()

        def rows() -> Iterator[pd.DataFrame]:
            kept = [(w, n) for w, n in seen.items() if n > 1 and len(w) <= MAX_KEY]
            seen.clear()
            if kept:
                yield pd.DataFrame(kept, columns=["word", "n"])

        for batch in batches:
            for text in batch["text"]:
                if text:
                    seen.update(marked_words(text))
                if len(seen) > 2 * CACHE_ROWS:
                    yield from rows()
        yield from rows()

    def segmented(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(shared.value)
        for batch in batches:
            yield pd.DataFrame({"word": batch["word"], "ids": [word_ids(w, model) for w in batch["word"]]})

    shared = docs.sparkSession.sparkContext.broadcast(proto)
    counts = stored(docs.select("text").mapInPandas(distinct, "word string, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")), "piece-words")
    table = most_frequent(counts, table_rows).select("word").repartition(8).mapInPandas(segmented, "word string, ids binary")
    return {r.word: bytes(r.ids) for r in table.toLocalIterator()}  # at most table_rows short entries


def encode(docs: DataFrame, model_path: str, table_rows: int = 65_536, with_ids: bool = False) -> DataFrame:
    """Encode and decode every text of ``docs`` (doc_id, text).

    Returns doc_id, n_tokens, ids_sha256 and decoded_sha256; ``with_ids`` adds
    ``ids`` (array of int) and ``decoded`` (the text the ids decode to).
    """
    ship(docs.sparkSession)
    with open(model_path, "rb") as f:  # under a MB, read on the driver only
        proto = f.read()
    apart = words_stay_apart(proto)
    table = distinct_word_table(docs, proto, table_rows) if apart else {}
    shared = docs.sparkSession.sparkContext.broadcast((proto, table))

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordTable(*shared.value)
        for batch in batches:
            out = []
            for text in batch["text"]:
                raw = encode_text(text, words, apart)
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                decoded = words.model.decode(ids)
                row = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                out.append(row + ((ids, decoded) if with_ids else ()))
            names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
            rows = pd.DataFrame(out, columns=names)
            rows.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield rows

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInPandas(
        encoded, schema + ", ids array<int>, decoded string" * with_ids)
