"""Language identification: Viterbi against all paths, scripts, held-out accuracy, odd rows."""

import itertools
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tests.llm.conftest import ODD

from tessaria.llm import langid as g

SAMPLES_OF = [("en", "the cat sat on the mat and the dog ran with the others over there " * 3), ("fr", "le chat est sur la table avec les autres et une maison dans la rue " * 3), ("ru", "кошка сидит на столе и собака бежит по улице с другими " * 3)]
SAMPLES = {lang: dict(Counter(g.WORD.findall(text))) for lang, text in SAMPLES_OF}


def test_viterbi_against_every_path():
    rng = np.random.default_rng(1)
    for _ in range(40):
        lengths = rng.integers(1, 7, 4)
        scores = rng.normal(0, 5, (lengths.sum(), 3)).astype(np.float32)
        out, at = g.viterbi(scores, lengths), 0
        for n in lengths:
            best = max(itertools.product(range(3), repeat=int(n)), key=lambda p: sum(scores[at + i, c] for i, c in enumerate(p)) - g.SWITCH * sum(a != b for a, b in itertools.pairwise(p)))
            assert tuple(out[at : at + n]) == best
            at += n


def test_spans_of_mixed_text():
    text = "The cat sat on the mat, and the dog ran. Кошка сидит на столе и собака! le chat est sur la table avec les autres"
    lang, score, spans = g.Labeller(g.Model(SAMPLES)).predict([text])[0]
    assert [s[0] for s in spans] == ["en", "ru", "fr"] and 0 < score < 0.6
    assert text[spans[1][1] : spans[1][2]] == "Кошка сидит на столе и собака"


def test_scripts_narrow():
    model = g.Model(SAMPLES)
    scores = model.words(["кот", "zzz"])
    assert scores[0][model.langs.index("ru")] > -1e3 and scores[0][model.langs.index("en")] <= -1e3
    assert scores[1][model.langs.index("ru")] <= -1e3
    assert [g.script(w) for w in ("a", "é", "ж", "漢", "か", "한", "ω")] == ["latin", "latin", "cyrillic", "han", "kana", "hangul", "greek"]


def test_undetermined():
    got = g.Labeller(g.Model(SAMPLES)).predict([None, "", "123 !?", "²", "漢字", "a"])
    assert [x[:2] for x in got[:4]] == [("und", 0.0)] * 4 and got[4][0] != "und" and got[5][0] in ("en", "fr")
    assert g.Labeller(g.Model({})).predict(["abc"]) == [("und", 0.0, [])]


def test_the_same_with_small_memory(monkeypatch):
    texts = [t for _, t in SAMPLES_OF] * 4
    want = g.Labeller(g.Model(SAMPLES)).predict(texts)
    monkeypatch.setattr(g, "KEPT", 5)
    monkeypatch.setattr(g, "AT_ONCE", 10)
    assert g.Labeller(g.Model(SAMPLES)).predict(texts) == want


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    out = g.op9_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(out) > 200 and np.mean([r.lang_pred == r.lang for r in out]) > 0.98


def test_odd_rows(documents):
    rows = documents(ODD)
    out = rows.select("doc_id", g.language(g.fitted(rows), F.col("text")).alias("l")).collect()
    assert {r.doc_id: r.l.lang for r in out}[0] == "und" and len(out) == len(ODD)
    assert g.fitted(rows.withColumn("lang", F.lit(None).cast("string"))).langs == []
