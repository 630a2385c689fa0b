"""License scans: ordered signature rules over the words of whole texts.

Words are runs of digits, a-z (A-Z lower-cased) and everything beyond ASCII.
Hundreds of rules are built from the license names and sentence templates
below.  A rule has a rank (1 wins over 2 over 3), an anchor - a word such as
``license`` or ``gplv3`` that every match contains, written ``~license`` in its
pattern - and a key word that must stand near.

* Prefilter: only texts that hold an anchor word are looked at further; each
  anchor with up to ``REACH`` words on both sides becomes one small row, and a
  rule is tried on it only when its key word is among them (a join by key word
  with the broadcast rule table, whose size the code fixes).
* A match is an interval of word places.  A detection is dropped when one of the
  same or a better rank contains its interval (of equal intervals the first in
  rule order stays).
* Counted phrases are rules of their own that nothing suppresses.

``score`` is the confidence of the best detection left (1.0, 0.9 or 0.7 by rank),
0.5 with counted phrases only, 0 without any.

All of it is DataFrame code.  Texts do not leave their task; what is shuffled are
detections, by row.  Null and empty texts: no words, no labels, score 0.  Very long
texts are read whole, in rows of at most 2 REACH + 1 words.  Repeated rows and
doc_ids are judged row by row; an empty table gives no rows.  Other columns of the
input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.url_filter import LOWER, UPPER

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "~"
REACH = 16
CONFIDENCE = {0: 0.5, 1: 1.0, 2: 0.9, 3: 0.7}

# License names in words, with their labels and key words.
NAMES = (
    ("mit", "mit", "mit"), ("mit", "expat", "expat"), ("x11", "x11", "x11"), ("isc", "isc", "isc"),
    ("apache", "apache", "apache"), ("apache", "apache software", "apache"),
    ("bsd", "bsd", "bsd"), ("bsd-2-clause", "bsd 2 clause", "bsd"), ("bsd-2-clause", "2 clause bsd", "bsd"),
    ("bsd-2-clause", "simplified bsd", "bsd"), ("bsd-3-clause", "bsd 3 clause", "bsd"),
    ("bsd-3-clause", "3 clause bsd", "bsd"), ("bsd-3-clause", "(?:new|modified|revised) bsd", "bsd"),
    ("bsd-4-clause", "bsd 4 clause", "bsd"), ("0bsd", "zero clause bsd", "bsd"),
    ("gpl", "(?:gnu )?general public", "general"), ("gpl", "gnu gpl", "gpl"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", "general"), ("lgpl", "gnu lgpl", "lgpl"),
    ("agpl", "(?:gnu )?affero general public", "affero"), ("agpl", "gnu agpl", "agpl"),
    ("gfdl", "(?:gnu )?free documentation", "documentation"),
    ("mpl", "mozilla public", "mozilla"), ("npl", "netscape public", "netscape"), ("epl", "eclipse public", "eclipse"),
    ("cddl", "common development and distribution", "distribution"), ("cpl", "common public", "common"),
    ("eupl", "european union public", "european"), ("ipl", "ibm public", "ibm"), ("zpl", "zope public", "zope"),
    ("osl", "open software", "software"), ("afl", "academic free", "academic"), ("ecl", "educational community", "educational"),
    ("artistic", "artistic", "artistic"), ("clarified-artistic", "clarified artistic", "artistic"),
    ("zlib", "zlib", "zlib"), ("zlib", "zlib libpng", "zlib"), ("boost", "boost software", "boost"),
    ("wtfpl", "do what the fuck you want to public", "fuck"), ("ofl", "sil open font", "font"), ("ofl", "open font", "font"),
    ("python", "python software foundation", "python"), ("python", "python", "python"), ("php", "php", "php"),
    ("ruby", "ruby", "ruby"), ("openssl", "openssl", "openssl"), ("ms-pl", "microsoft public", "microsoft"),
    ("ms-rl", "microsoft reciprocal", "microsoft"), ("ncsa", "university of illinois(?: ncsa)? open source", "illinois"),
    ("postgresql", "postgresql", "postgresql"), ("vim", "vim", "vim"), ("w3c", "w3c software", "w3c"),
    ("sleepycat", "sleepycat", "sleepycat"), ("odbl", "open (?:database|data commons)", "open"),
    ("upl", "universal permissive", "permissive"), ("sspl", "server side public", "server"),
    ("busl", "business source", "business"), ("elastic", "elastic", "elastic"), ("hippocratic", "hippocratic", "hippocratic"),
    ("cc-by", "creative commons attribution", "commons"),
    ("cc-by-sa", "creative commons attribution share ?alike", "commons"),
    ("cc-by-nc", "creative commons attribution non ?commercial", "commons"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:atives|s)?", "commons"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", "commons"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:atives|s)?", "commons"),
    ("cc", "creative commons", "commons"),
)

# Sentence templates with their ranks.  NAME is a license name, LICENSE the anchor.
VERSION = "(?: (?:version|v) ?[0-9]+(?: [0-9]+)?| v?[0-9]+(?: [0-9]+)?)"
TEMPLATES = (
    (1, "(?:licensed|released|distributed|available|provided|published|offered|covered|governed)(?: [^ ]+)?"
        " (?:under|by)(?: the)?(?: terms)?(?: and)?(?: conditions)?(?: of)?(?: the)? NAME LICENSE(?:" + VERSION + ")?"),
    (2, "NAME LICENSE" + VERSION + "(?: or(?: at your option)?(?: any)? later)?"),
    (2, "(?:see|read|refer to|subject to|per|accept|comply with|compliance with|copy of)(?: the)? NAME LICENSE"),
    (3, "NAME LICENSE"),
)
LICENSE = MARK + "licen[cs]es?"

# Short names that are anchors themselves, with their labels.
SHORT = (
    ("gpl", "gpl"), ("gpl", "gplv1"), ("gpl", "gplv2"), ("gpl", "gplv3"), ("lgpl", "lgpl"), ("lgpl", "lgplv2"),
    ("lgpl", "lgplv3"), ("agpl", "agpl"), ("agpl", "agplv3"), ("mpl", "mplv2"), ("cc0", "cc0"), ("gfdl", "gfdl"),
    ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("cddl", "cddl"), ("eupl", "eupl"), ("sspl", "sspl"),
)
SHORT_TEMPLATES = (
    (1, "(?:licensed|released|distributed|available|published)(?: [^ ]+)? under(?: the)?(?: terms)?(?: of)?(?: the)?"
        "(?: gnu)? NAME(?:" + VERSION + ")?"),
    (2, "(?:gnu )?NAME" + VERSION + "(?: or(?: any)? later)?"),
    (3, "(?:gnu )?NAME"),
)

# Identifiers of one-line license tags, in words, with their labels and key words.
TAGS = (
    ("mit", "mit", "mit"), ("apache", "apache 2 0", "apache"), ("bsd-2-clause", "bsd 2 clause", "bsd"),
    ("bsd-3-clause", "bsd 3 clause", "bsd"), ("gpl", "gpl [0-9] 0(?: only| or later)?", "gpl"),
    ("lgpl", "lgpl [0-9] [0-9](?: only| or later)?", "lgpl"), ("agpl", "agpl 3 0(?: only| or later)?", "agpl"),
    ("mpl", "mpl [0-9] [0-9]", "mpl"), ("epl", "epl [0-9] 0", "epl"), ("isc", "isc", "isc"), ("zlib", "zlib", "zlib"),
    ("boost", "bsl 1 0", "bsl"), ("cc0", "cc0 1 0", "cc0"), ("cc-by", "cc by [0-9] 0", "cc"),
    ("cc-by-sa", "cc by sa [0-9] 0", "cc"), ("unlicense", "unlicense", "unlicense"), ("artistic", "artistic 2 0", "artistic"),
)

# Sentences of license texts and notices: label, rank, key word, pattern.
SENTENCES = (
    ("mit", 1, "charge", "permission is ~hereby granted free of charge to any person obtaining a copy"),
    ("isc", 1, "distribute", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is ~hereby granted"),
    ("bsd", 1, "binary", "~redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", 1, "modify", "this program is free software you can ~redistribute it and or modify it under the terms of the gnu general public"),
    ("gpl", 2, "free", "free software you can ~redistribute it"),
    ("zlib", 1, "altered", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and ~redistribute it freely"),
    ("public-domain", 1, "public", "(?:released|placed|dedicated)(?: [^ ]+)? (?:in|into|to) the public ~domain"),
    ("public-domain", 3, "public", "public ~domain"),
    ("warranty-disclaimer", 2, "is", "provided as is without ~warranty of any kind"),
    ("warranty-disclaimer", 2, "without", "without any ~warranty"),
    ("proprietary", 2, "all", "all rights ~reserved"),
    ("copyright", 3, "c", "~copyright c [0-9][0-9][0-9][0-9]"),
    ("copyright", 3, "by", "~copyright(?: [0-9]+)? by"),
)

# Words that can be anchors: the marked words of all patterns, spelled out.
ANCHORS = ("license", "licence", "licenses", "licences", "hereby", "redistribution", "redistribute", "domain", "warranty",
           "reserved", "copyright") + tuple(word for _, word in SHORT)


@dataclass(frozen=True)
class Signature:
    """A rule: ``pattern`` (with one marked word) gives ``label``.  Rank 0: a counted phrase."""

    label: str
    rank: int
    key: str
    pattern: str


def signatures(phrases: Sequence[tuple[str, str]] = ()) -> list[Signature]:
    """All rules in order, the counted ``phrases`` (phrase, label) first.  A phrase's last
    word is its anchor; phrases hold lower-case letters and digits, at most ``REACH`` words."""
    for phrase, label in phrases:
        if not re.fullmatch("[0-9a-z]+( [0-9a-z]+)*", phrase) or len(phrase.split()) > REACH or not re.fullmatch("[^',]+", label):
            raise ValueError(f"not a phrase with a label: {phrase!r}, {label!r}")
    out = [Signature(label, 0, words[0], " ".join([*words[:-1], MARK + words[-1]]))
           for phrase, label in phrases for words in [phrase.split()]]
    out += [Signature(label, rank, key, pattern) for label, rank, key, pattern in SENTENCES]
    for label, name, key in NAMES:
        out += [Signature(label, rank, key, t.replace("NAME", name).replace("LICENSE", LICENSE)) for rank, t in TEMPLATES]
    for label, name in SHORT:
        out += [Signature(label, rank, name, t.replace("NAME", MARK + name)) for rank, t in SHORT_TEMPLATES]
    out += [Signature(label, 1, key, f"spdx {MARK}license identifier {tag}") for label, tag, key in TAGS]
    return out


def anchors(phrases: Sequence[tuple[str, str]] = ()) -> list[str]:
    return sorted({*ANCHORS, *(phrase.split()[-1] for phrase, _ in phrases)})


def _values(rules: Sequence[Signature]) -> str:
    """The rules as rows of SQL; patterns hold neither quotes nor backslashes."""
    rows = [f"({i}, {r.rank}, '{r.label}', '{r.key}', ' ({r.pattern}) ')" for i, r in enumerate(rules)]
    return "VALUES\n  " + ",\n  ".join(rows)


def _rule_table(spark, rules: Sequence[Signature]) -> DataFrame:
    return spark.sql(f"SELECT * FROM ({_values(rules)}) AS rules(rule, rank, label, key, pattern)")


def anchored(docs: DataFrame, words_at: Sequence[str], reach: int = REACH) -> DataFrame:
    """(row, doc_id, n_words, places): ``places`` holds (at, near) per anchor word, its
    place and the words around it with the anchor marked.  ``row`` numbers the rows."""
    marks = F.array(*[F.lit(w) for w in words_at])
    words = F.coalesce(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0)),
                       F.array().cast("array<string>"))
    split = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))

    def place(word, at):
        before = F.slice("words", F.greatest(at - reach, F.lit(0)) + 1, F.least(at, F.lit(reach)))
        near = F.concat_ws(" ", F.lit(""), before, F.concat(F.lit(MARK), word), F.slice("words", at + 2, F.lit(reach)), F.lit(""))
        return F.when(word.isin(*words_at), F.struct(at.alias("at"), near.alias("near")))

    found = F.when(F.arrays_overlap("words", marks), F.array_compact(F.transform("words", place)))
    return split.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), found.alias("places"))


def _spaces(text):
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def detections(found: DataFrame, rules: Sequence[Signature]) -> DataFrame:
    """(row, start, stop, rule, rank, label) per match of a rule, before suppression."""
    keys = F.array(*[F.lit(k) for k in sorted({r.key for r in rules})])
    spots = found.where("places is not null").select("row", F.explode("places").alias("p")).select("row", "p.at", "p.near")
    near_words = F.split(F.replace("near", F.lit(MARK), F.lit("")), " ")
    keyed = spots.select("*", F.explode(F.array_intersect(near_words, keys)).alias("key"))
    hits = (keyed.join(F.broadcast(_rule_table(found.sparkSession, rules)), "key")
            .withColumn("hit", F.expr("regexp_extract(near, pattern, 1)")).where("hit <> ''"))
    return hits.select("row", (F.col("at") - _spaces(F.substring_index("hit", MARK, 1))).alias("start"),
                       (F.col("at") + _spaces(F.substring_index("hit", MARK, -1))).alias("stop"), "rule", "rank", "label")


def standing(hits: DataFrame) -> DataFrame:
    """Detections that no other of the same or a better rank contains; rank 0 always stands."""
    order = Window.partitionBy("row").orderBy("start", F.desc("stop"), "rank", "rule")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("rank").between(1, r), F.col("stop"))).over(earlier).alias(f"reach{r}") for r in (1, 2, 3)]
    inside = F.lit(False)
    for r in (1, 2, 3):
        inside = inside | ((F.col("rank") == r) & (F.col(f"reach{r}") >= F.col("stop")))
    return hits.select("*", *reach).where(~F.coalesce(inside, F.lit(False))).drop("reach1", "reach2", "reach3")


def scan(docs: DataFrame, phrases: Sequence[tuple[str, str]], label: str = "licenses") -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, the counted phrases' places (n_base,
    first_word, last_word, base_labels), all labels and the score."""
    rules = signatures(phrases)
    found = stored(anchored(docs, anchors(phrases)), label)
    base = F.col("rank") == 0
    confidence = F.lit(0.0)
    for rank, c in CONFIDENCE.items():
        confidence = F.when(F.col("rank") == rank, c).otherwise(confidence)

    def names(cond=None):
        c = F.col("label") if cond is None else F.when(cond, F.col("label"))
        return F.array_join(F.array_sort(F.collect_set(c)), ",")

    kept = standing(detections(found, rules)).groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        names(base).alias("base_labels"), names().alias("labels"), F.max(confidence).alias("score"))
    return found.select("row", "doc_id", "n_words").join(kept, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def oracle(phrases: Sequence[tuple[str, str]]) -> str:
    """The same scan as DuckDB SQL over the documents table."""
    marks = ", ".join(f"'{w}'" for w in anchors(phrases))
    score = " ".join(f"WHEN {rank} THEN {c}" for rank, c in CONFIDENCE.items())
    return rf"""
WITH rules(rule, rank, label, key, pattern) AS ({_values(signatures(phrases))}),
w AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
        translate(text, '{UPPER}', '{LOWER}'), '{WORD}'), []::VARCHAR[]) AS ws FROM documents),
places AS (SELECT rid, i - 1 AS pos, ws[i] AS word, ws[greatest(i - {REACH}, 1):i - 1] AS before, ws[i + 1:i + {REACH}] AS after
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws))) AS i FROM w WHERE len(ws) > 0) WHERE ws[i] IN ({marks})),
spots AS (SELECT rid, pos, list_distinct(list_concat(before, [word], after)) AS near_words, ' ' ||
    array_to_string(list_concat(before, ['{MARK}' || word], after), ' ') || ' ' AS near FROM places),
hits AS (SELECT rid, pos, rule, rank, label, regexp_extract(near, pattern, 1) AS hit
  FROM (SELECT rid, pos, near, unnest(near_words) AS key FROM spots) JOIN rules USING (key)
  WHERE regexp_extract(near, pattern, 1) <> ''),
d AS (SELECT rid, rule, rank, label, pos - (len(string_split(string_split(hit, '{MARK}')[1], ' ')) - 1) AS start,
    pos + len(string_split(string_split(hit, '{MARK}')[2], ' ')) - 1 AS stop FROM hits),
kept AS (SELECT * FROM d a WHERE rank = 0 OR NOT EXISTS (SELECT 1 FROM d b WHERE b.rid = a.rid AND b.rank BETWEEN 1 AND a.rank
    AND b.start <= a.start AND b.stop >= a.stop AND (b.start, -b.stop, b.rank, b.rule) < (a.start, -a.stop, a.rank, a.rule))),
g AS (SELECT rid, count(*) FILTER (WHERE rank = 0) AS n_base, min(start) FILTER (WHERE rank = 0) AS first_word,
    max(start) FILTER (WHERE rank = 0) AS last_word,
    coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE rank = 0)), ','), '') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(CASE rank {score} END)::DOUBLE AS score FROM kept GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN g USING (rid)"""
