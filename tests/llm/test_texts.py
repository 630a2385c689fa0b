"""Token counts and SentencePiece ids against the libraries themselves."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import pieces, token_count

BPE = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPEC = open(BPE, encoding="utf-8").read()
PROTO = open(MODEL, "rb").read()
ODD = ["", " ", "  ", "a", " a", "a ", "a  b   c", "\n", "a\nb\t c\r\n", "▁", "a▁b ▁", "I'll we've 'tis ''s",
       "ÄÖÜ ß é É µ ª º ² ¼", "ﬁ İ Σς ǅ", "é ​ x", "日本語 テスト", "🙂 ok 🙂🙂", "<|endoftext|> <|startoftext|>a",
       "<s> </s> <unk> <0x0A>", "\x00\x01\x1c\x1d\x85\xa0x", "word " * 30_000, "x" * 20_000, "123 4,567.8%", "…—“”"]
TEXT = st.one_of(st.text(max_size=60), st.text(alphabet=" \n\tabzAZ0²'tsÄß▁<|>é.,!", max_size=60))


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same_count(text, lengths, bpe):
    return token_count.count_text(text, lengths) == len(bpe.encode(text, add_special_tokens=False).ids)


def same_ids(text, words, model):
    want = [model.bos_id(), *model.encode(text), model.eos_id()]
    return np.frombuffer(pieces.encode_text(text, words), "<u4").tolist() == want


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text, bpe, model):
    assert same_count(text, token_count.Lengths(SPEC, {}), bpe)
    assert same_ids(text, pieces.WordTable(PROTO, {}), model)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_any_text(text):
    bpe, model = Tokenizer.from_file(BPE) if not _kept else _kept[0], pieces._model(PROTO)
    _kept.append(bpe)
    assert same_count(text, token_count.Lengths(SPEC, {}), bpe)
    assert same_ids(text, pieces.WordTable(PROTO, {}), model)


_kept: list = []


def rows(spark):
    data = [(i, t, "x") for i, t in enumerate(ODD)] + [(900, None, "x"), (None, "no id", None), (5, ODD[5], "x")]
    return spark.createDataFrame(data, "doc_id long, text string, n_tokens string")


def test_count_tokens(spark, bpe):
    got = token_count.count_tokens(rows(spark), BPE, limit=100, table_rows=5, per_task=3).collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        text = "no id" if r.doc_id is None else ODD[r.doc_id] if r.doc_id != 900 else ""
        n = len(bpe.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100)


def test_encode(spark, model):
    got = pieces.encode(rows(spark), MODEL, table_rows=3, with_ids=True).collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        text = "no id" if r.doc_id is None else ODD[r.doc_id] if r.doc_id != 900 else ""
        ids = [model.bos_id(), *model.encode(text), model.eos_id()]
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, model.decode(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_whole_text_path_for_models_whose_pieces_cross_words(model):
    words = pieces.WordTable(PROTO, {})
    assert pieces.words_stay_apart(PROTO)
    for text in ODD[:10]:
        assert pieces.encode_text(text, words, apart=False) == pieces.encode_text(text, words, apart=True)


@pytest.mark.parametrize("spec", [b"\x20\x01", b"\x18\x00"], ids=["extra spaces removed", "no marker in front"])
def test_whole_text_path_for_models_that_normalise(spec):
    # A second normalizer_spec field of a model file overrides the first one's values.
    proto = PROTO + b"\x1a" + bytes([len(spec)]) + spec
    assert not pieces.words_stay_apart(proto)
    words = pieces.WordTable(proto, {})
    for text in ("  two  spaces ", "one", " lead"):
        ids = np.frombuffer(pieces.encode_text(text, words, apart=False), dtype="<u4").tolist()
        assert ids[1:-1] == words.model.encode(text)
    assert words.model.encode(" a  b ") != pieces._model(PROTO).encode(" a  b ")


def test_empty_table(spark):
    none = rows(spark).where("false")
    assert token_count.count_tokens(none, BPE).count() == 0
    assert pieces.encode(none, MODEL).count() == 0


def test_other_scripts_go_through_both_tiers(spark, bpe, monkeypatch):
    r = random.Random(2)
    words = ["Привет", "мир", "—", "“цитата”", "日本語", "été", "don’t", "it's", "x", "<|endoftext|>", "ＡＢ", "I\u0307", "42"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 50)))) for i in range(120)] + [(None, None), (500, ""), (501, "<|startoftext|>" * 3)]
    df = spark.createDataFrame([x + ("tok", 1) for x in rows], "doc_id long, text string, token string, n int")
    want = sorted((str(i), len(bpe.encode(t, add_special_tokens=False).ids) if t else 0) for i, t in rows)
    got = token_count.count_tokens(df, BPE).collect()
    assert sorted((str(g.doc_id), g.n_tokens) for g in got) == want
    table = token_count.frequent_lengths(df, SPEC, 1000, 1000)
    assert any(k.startswith(token_count.Splitter.MARK) for k in table)
    # With the table no text is encoded at all.
    lengths = token_count.Lengths(SPEC, table)
    monkeypatch.setattr(token_count, "_count", None)
    assert sorted((str(i), token_count.count_text(t, lengths)) for i, t in rows) == want
