"""Language identification: family first, then pairs within the family.

Features are hashed counts of 1- to 3-byte sequences of the whole lower-cased
text, dampened and scaled to length one.  A linear support vector machine per
family (one against the rest) picks the family; within it, one-versus-one
linear machines between its languages vote.  The score is the product of the
logistic confidences of both decisions, scaled on the training margins.

Learning uses a bounded sample of every language that has a learnable text: at
most ``per_lang`` texts each, and beyond ``full_langs`` languages as many fewer as
keeps the sample's size (one at least).  Texts are chosen by a hash of the id;
their features are made by Spark tasks and only those (4096 numbers a text) reach
the driver.  Prediction is one pass over all texts without a shuffle.

Null texts and texts without a letter are ``und`` with score 0.  Rows with a
null language are never learned from.  Without any learnable row all are
``und``; with one language, that language is predicted.  Repeated rows are
predicted alike; an empty table gives an empty result; other columns pass
through ``identify`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import HASH_RANGE, hash_share, ship

WIDTH = 4096
UNKNOWN = "und"

# Language families by ISO 639-1 code; others are a family of their own.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("es", "fr", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr", "mk"),
}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Hashed counts of 1- to 3-byte sequences, square-rooted, of length one."""
    a = np.frombuffer(text.lower().encode(), dtype=np.uint8).astype(np.uint32)
    two = a[:-1] * np.uint32(257) + a[1:]
    three = two[:-1] * np.uint32(257) + a[2:]
    out = np.zeros(WIDTH)
    for salt, grams in ((1, a), (2, two), (3, three)):
        slot = ((grams + np.uint32(salt << 26)) * np.uint32(2654435761)) >> np.uint32(20)
        out += np.bincount(slot, minlength=WIDTH)
    out = np.sqrt(out)
    return out / max(np.sqrt((out * out).sum()), 1e-12)


def linear_svm(x: np.ndarray, y: np.ndarray, strength: float = 1e-3, rounds: int = 12, seed: int = 2) -> np.ndarray:
    """Weights (with a bias last) of a linear SVM for y in {-1, 1}: averaged
    subgradient steps, both classes weighing the same."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w, mean, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    rng = np.random.default_rng(seed)
    for r in range(rounds):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 16)):
            t += 1
            wrong = at[y[at] * (x[at] @ w) < 1]
            step = 1 / (strength * (t + 20))
            w = (1 - strength * step) * w
            if len(wrong):
                w = w + step * (x[wrong] * (y[wrong] * weight[wrong])[:, None]).sum(axis=0) / len(at)
        mean += w * (r >= rounds // 2)
    return mean / max(1, rounds - rounds // 2)


def _slope(margins: np.ndarray) -> float:
    """Logistic slope that gives a typical right margin a confidence of 0.98."""
    return 4.0 / max(1e-9, float(np.median(np.abs(margins)))) if len(margins) else 1.0


@dataclass
class Model:
    """Families with their machines, and the pairs of languages in each."""

    families: list[str]
    langs: dict[str, list[str]]
    family_w: np.ndarray
    family_slope: float
    pairs: dict[str, list[tuple[int, int, np.ndarray, float]]]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        x = np.append(features(text), 1.0)
        sure, family = 1.0, self.families[0]
        if len(self.families) > 1:
            s = self.family_w @ x
            order = np.argsort(-s, kind="stable")
            family = self.families[order[0]]
            sure = 1 / (1 + np.exp(-self.family_slope * (s[order[0]] - s[order[1]]) / 2))
        langs = self.langs[family]
        if len(langs) == 1:
            return langs[0], float(sure)
        votes, least = np.zeros(len(langs)), np.ones(len(langs))
        for i, j, w, slope in self.pairs[family]:
            p = 1 / (1 + np.exp(-np.clip(slope * (w @ x), -50, 50)))
            votes[i if p >= 0.5 else j] += 1
            least[i], least[j] = min(least[i], p), min(least[j], 1 - p)
        best = int(np.lexsort((-least, -votes))[0])
        return langs[best], float(sure * least[best])


def fit(x: np.ndarray, lang: np.ndarray) -> Model:
    """Model from feature rows and their languages."""
    names = sorted(set(lang))
    langs: dict[str, list[str]] = {}
    for name in names:
        langs.setdefault(family_of(name), []).append(name)
    families = sorted(langs)
    fam = np.array([family_of(name) for name in lang])
    xb = np.hstack([x, np.ones((len(x), 1), x.dtype)]) if len(x) else np.empty((0, WIDTH + 1))
    w = np.array([linear_svm(x, np.where(fam == f, 1.0, -1.0)) for f in families]) if len(families) > 1 \
        else np.empty((len(families), WIDTH + 1))
    own = np.array([families.index(f) for f in fam], dtype=int)
    slope = _slope((xb @ w.T)[np.arange(len(x)), own]) if len(families) > 1 else 1.0
    pairs = {}
    for f, members in langs.items():
        pairs[f] = []
        for i in range(len(members)):
            for j in range(i + 1, len(members)):
                use = (lang == members[i]) | (lang == members[j])
                pw = linear_svm(x[use], np.where(lang[use] == members[i], 1.0, -1.0))
                pairs[f].append((i, j, pw, _slope(xb[use] @ pw)))
    return Model(families, langs, w, slope, pairs)


def train(docs: DataFrame, usable: Column, per_lang: int = 200, full_langs: int = 32, seed: int = 6) -> Model:
    """Fit on the languages of the ``usable`` rows of ``docs`` (doc_id, text, lang):
    at most ``per_lang`` texts each, together no more than ``full_langs`` languages
    would have (but one each)."""
    spark = docs.sparkSession
    # A character Java does not know may be a letter to Python.
    known = (docs.where(usable).where("lang is not null").where(F.col("text").rlike(r"[\p{L}\p{Cn}]"))
             .select("doc_id", "lang", "text"))
    ship(spark)
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(HASH_RANGE))
    langs = known.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")).collect()  # one row a language
    if not langs:
        return fit(np.empty((0, WIDTH)), np.array([], dtype=object))
    per_lang = max(1, min(per_lang, per_lang * full_langs // len(langs)))
    # Twice the wanted texts of each language by hash, its first one among them, then exactly the wanted ones.
    # An Arrow table is local data: rows would be made by Python workers of a second kind, which stay.
    share = spark.createDataFrame(pa.table({"lang": pa.array([r.lang for r in langs], pa.string()),
                                            "share": [max(r.least + 1, hash_share(r.n, per_lang)) for r in langs]}))
    keyed = (known.join(F.broadcast(share), "lang").withColumn("place", place).where("place < share")
             .select("lang", "place", F.xxhash64("doc_id", "text").alias("key"), "text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "key"))
    chosen = (keyed.select("lang", "place", "key").distinct().withColumn("rank", rank).where(F.col("rank") <= per_lang)
              .select("lang", "key"))
    # The chosen ones are at most per_lang a language; copies of a row are one text.
    texts = keyed.join(F.broadcast(chosen), ["lang", "key"]).dropDuplicates(["lang", "key"]).select("lang", "text")

    def rows(batches):
        for batch in batches:
            keep = [(lang, features(t).astype(np.float32)) for lang, t in zip(batch["lang"], batch["text"]) if has_letter(t)]
            if keep:
                yield pd.DataFrame({"lang": [k[0] for k in keep], "x": [k[1].tobytes() for k in keep]})

    got = texts.mapInPandas(rows, "lang string, x binary").toLocalIterator()
    got = sorted(((r.lang, bytes(r.x)) for r in got))
    x = np.array([np.frombuffer(b, np.float32) for _, b in got], dtype=np.float32).reshape(-1, WIDTH)
    return fit(x, np.array([lang for lang, _ in got], dtype=object))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_language`` (lang_pred, score)."""
    ship(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    # Spark would copy a deterministic function into a filter on its result and run it twice,
    # in two workers a task.
    return docs.withColumn("_language", predict.asNondeterministic()(F.col(text)))


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that is never learned from; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) != 2, F.lit(False))
