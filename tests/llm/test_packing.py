"""Packing against the tokenizer itself and against the rules of a sequence."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tessaria.llm.packing import END, WINDOW, Mixture, WordIds, pack, tokenizer_path

TEXTS = ["", None, "Hello, WORLD's 12 dogs!", "naïve café Straße", "é combining ΣΣ 你好", "<|endoftext|> a", "ab <|endoftext|> cd", "AB<|EndOfText|>x <|startoftext|>", "x" * 700, "a b\x1fc", "word " * 9000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_word_ids_equal_the_tokenizer(tokenizer):
    words = WordIds(tokenizer_path())
    for text in TEXTS:
        assert words.of(text or "").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def whole(rows, expected):
    """Each id lies in exactly one piece, and sequences are gapless."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, ids in expected.items():
        at = 0
        for r in sorted(docs.pop(doc), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert not docs
    short = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= WINDOW
        short += at < WINDOW
    return short


@pytest.mark.parametrize("weights", [None, {"a": 3, "b": 1, None: 1}, {"a": 1}])
def test_pack_is_whole_and_tight(spark, tokenizer, weights):
    rows = [(i, TEXTS[i % len(TEXTS)], ["a", "b", None][i % 3], "extra") for i in range(66)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens string").repartition(4)
    out = pack(df, tokenizer_path(), weights=weights).collect()
    expected = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, END] for i, t, *_ in rows}
    assert whole(out, expected) <= (1 if weights is None else 2)


def test_every_window_holds_the_mixture():
    totals = [50_000, 9_001, 123]
    mixture, by = Mixture(totals), defaultdict(lambda: [0, 0, 0])
    for i, t in enumerate(totals):
        for _, n, w, _ in mixture.pieces(i, 0, t):
            by[w][i] += n
    for w in range(sum(totals) // WINDOW):
        assert sum(by[w]) == WINDOW
        for i, t in enumerate(totals):
            assert abs(sum(by[v][i] for v in range(w + 1)) - (w + 1) * WINDOW * t / sum(totals)) < 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert pack(df, tokenizer_path()).count() == 0
