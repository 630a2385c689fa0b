"""Alignment against a plain walk over bytes and a dictionary of counts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import alignment
from strata.llm.queries import op12_alignment

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def ranges(ids, size):
    out, at = [], 0
    for i in ids:
        out.append((at, at + size(i), i))
        at += size(i)
    return out


def brute(rows):
    a_lib = Tokenizer.from_file(PATH_A)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    alphabet = alignment.byte_alphabet()
    bytes_a = lambda i: bytes(alphabet[c] for c in a_lib.id_to_token(i))

    def bytes_b(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()

    per_doc, counts = [], Counter()
    for doc_id, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if b"".join(map(bytes_a, a)) != want or b"".join(map(bytes_b, b)) != want:
            per_doc.append((doc_id, [], [], [], []))
            continue
        ra, rb = ranges(a, lambda i: len(bytes_a(i))), ranges(b, lambda i: len(bytes_b(i)))
        links = [(x[2], y[2]) for x in ra for y in rb if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in ra} & {y[1] for y in rb})
        groups, low = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for _, e, i in ra if low < e <= c) + "|" + ",".join(str(i) for _, e, i in rb if low < e <= c))
            low = c
        counts.update(links)
        per_doc.append((doc_id, a, b, links, groups))
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(d, len(a), len(b), len(g), len(ln), sum(counts[x] == top[x[1]] for x in ln), sum(counts[x] for x in ln),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, ln, g in per_doc]


def key(row):
    return tuple((v is not None, v) for v in row)


ROWS = [(1, "Hello  world, naïve café!"), (2, None), (3, ""), (4, "▁a piece mark"), (5, "<|endoftext|> and <s> stay text"),
        (5, "Hello  world, naïve café!"), (None, "same id none"), (6, "日本語 テキスト 🙂🙂‍\x00\x07"), (7, " "), (8, "\n\t x  "),
        (9, "a" * 3000), (10, "<0x41> <unk> �"), (11, "é é Ⅷ ½"), (11, "Hello")]


def test_same_as_brute_force(spark):
    r = random.Random(1)
    words = ["the", "theorem", "alignment", " ", "ünter", "über", "12", "345", "...", "\n"]
    rows = ROWS + [(100 + i, " ".join(r.choices(words, k=r.randint(1, 40)))) for i in range(150)]
    df = spark.createDataFrame([x + (9, "y") for x in rows], "doc_id long, text string, run long, part string").repartition(5)
    for options in ({}, {"run_links": 200, "radix": 3, "fan_in": 2}):
        got = [tuple(x) for x in alignment.align(df, PATH_A, PATH_B, **options).collect()]
        assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_whole_table(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 4000").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x) for x in alignment.align(df, PATH_A, PATH_B).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert op12_alignment(spark, SF).columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_fast_ids_are_the_library_s():
    with open(PATH_A, encoding="utf-8") as f, open(PATH_B, "rb") as g:
        pair = alignment.Pair(f.read(), g.read())
    assert pair.fast is not None
    texts = ["".join(map(chr, range(s, s + 64))) for s in range(0, 0x3000, 64) if not 0xD800 <= s < 0xE000]
    texts += [" " * 200_000 + "x", "x" + "\n" * 30_000, "don't we'LL 's  ", "a" * 50_000]
    for t in texts:
        ids = pair.library.encode(" " + t, add_special_tokens=False).ids
        found = pair.encode(t)
        assert found is None or found[0].tolist() == ids
        if "\n" not in t[:1] and not alignment.LONG_SPACE.search(t):
            assert pair.fast.encode_ordinary(" " + t) == ids


def test_runs_round_trip():
    r = np.random.default_rng(0)
    b, a, slot = r.integers(0, 50, 5000), r.integers(0, 60, 5000), r.integers(0, 30, 5000)
    keys = (((b << alignment.ID_BITS) | a) << alignment.SLOT_BITS) | slot
    seen = Counter()
    for part, pairs, records in alignment.spill(keys, 7):
        pair, total = alignment.unpack(pairs, 2)
        held, slots, times = alignment.unpack(records, 3)
        assert (np.diff(pair) > 0).all() and ((pair >> alignment.ID_BITS) % 7 == part).all()
        assert np.add.reduceat(times, np.cumsum(held) - held).tolist() == total.tolist()
        seen.update({(int(p), int(s)): int(n) for p, s, n in zip(np.repeat(pair, held), slots, times)})
    assert seen == Counter(zip(((b << alignment.ID_BITS) | a).tolist(), slot.tolist()))


def test_empty_table(spark, tmp):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    assert op12_alignment(spark, tmp).count() == 0
    only_null = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in alignment.align(only_null, PATH_A, PATH_B).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("lists", [[([1, 5], [2, 3]), ([1, 4, 5], [1, 1, 1])], [([], [])], [([7], [1])] * 5])
def test_merge(lists):
    pairs, times = alignment.merge([(np.array(p, dtype=np.int64), np.array(t, dtype=np.int64)) for p, t in lists])
    want = Counter()
    for p, t in lists:
        want.update(dict(zip(p, t)))
    assert list(zip(pairs.tolist(), times.tolist())) == sorted(want.items())
