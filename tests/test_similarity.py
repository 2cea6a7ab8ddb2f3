"""Similarity joins against all pairs by the standard library's matcher."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tessaria.functions import vocab
from tessaria.operators import similarity as s


def frame(spark, texts, name="v"):
    return spark.createDataFrame([(t, i, "x", 1) for i, t in enumerate(texts)], f"{name} string, rank int, text string, n int").repartition(3)


def plain(a, b):
    return SequenceMatcher(None, a, b).ratio()


def words(n, seed, letters="abcdefgh "):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14))).strip() or "z" for _ in range(n)]


def mistyped(texts, seed):
    rnd = random.Random(seed)
    out = []
    for t in texts:
        at = rnd.randrange(len(t))
        out.append(rnd.choice([t[:at] + t[at + 1 :], t[:at] + "é" + t[at:], t[:at] + t[at:][::-1], t + " qq", t.upper()]) or "q")
    return out


def test_characters_share_what_texts_do(spark):
    rows = spark.createDataFrame([("abca",), ("",), ("ça 😀😀",)], "v string").select(s.characters(F.col("v")).alias("c")).collect()
    assert [r.c for r in rows] == [["a1", "a2", "b1", "c1"], [], sorted([" 1", "a1", "ç1", "😀1", "😀2"])]


@pytest.mark.parametrize("share", [9, 7, 5, 3])
def test_all_pairs_from_a_ratio_on(spark, share):
    right = sorted(set(words(60, 1)))
    left = sorted(set(mistyped(right, 2) + words(40, 3)))
    got = {(r.a, r.b): (r.ratio, r.bound) for r in s.similar(frame(spark, left), "v", frame(spark, right, "c"), "c", share, 10).collect()}
    fold = lambda t: " ".join(t.lower().replace("é", "e").split())
    want = {(a, b): plain(a, b) for a in {fold(x) for x in left} for b in {fold(x) for x in right} if plain(a, b) * 10 >= share}
    assert {k: v[0] for k, v in got.items()} == want and len(want) >= 30
    assert all(bound >= value for value, bound in got.values())


def best(value, candidates):
    """The earliest of the most similar candidates, as (candidate, score)."""
    top, score = "", 0.0
    for c in candidates:
        r = plain(value, c)
        if r > score:
            top, score = c, r
    return top, score


@pytest.mark.parametrize("tokens", [s.BROADCAST_TOKENS, 0])
def test_best_of_all_candidates(spark, monkeypatch, tokens):
    monkeypatch.setattr(s, "BROADCAST_TOKENS", tokens)
    candidates = list(dict.fromkeys(" ".join(w.split()) for w in words(80, 4)))
    random.Random(5).shuffle(candidates)
    values = sorted(set(words(60, 6) + candidates[:20] + ["xyz", "x a", "ihgfedcba" * 40, "", "  "]))
    got = {r.value: r for r in s.best_matches(frame(spark, [*values, None]), "v", frame(spark, candidates, "c"), "c", "rank").collect()}
    assert len(got) == len(values) + 1 and (got[None].canonical, got[None].score) == ("", 0.0)
    for v in values:
        folded = " ".join(v.split())
        assert (got[v].canonical, got[v].score) == (best(folded, candidates) if folded else ("", 0.0))
    assert 0 < sum(r.compared for r in got.values()) < len(values) * len(candidates) / 2


def test_shipped_vocabulary(spark):
    values = [*vocab.ALL_PRODUCTS[:10], "integracao ao login unico", "Integração ao Login Únic", "texto completamente diferente xyz"]
    got = {r.value: r for r in s.best_matches(frame(spark, values), "v", frame(spark, vocab.ALL_PRODUCTS, "c"), "c", "rank").collect()}
    assert got["integracao ao login unico"].canonical == "Integração ao Login Único" and got["integracao ao login unico"].score == 1.0
    assert got["Integração ao Login Únic"].canonical == "Integração ao Login Único" and 0.85 <= got["Integração ao Login Únic"].score < 1
    assert got["texto completamente diferente xyz"].score < 0.7


def test_no_rows(spark):
    some, none = frame(spark, ["a"]), frame(spark, ["a"]).filter("false")
    assert s.best_matches(none, "v", some, "v").count() == 0
    assert [tuple(r) for r in s.best_matches(some, "v", none, "v").collect()] == [("a", "", 0.0, 0)]
    assert s.similar(some, "v", none, "v").count() == 0
    with pytest.raises(ValueError, match="zero"):
        s.similar(some, "v", some, "v", 0, 1)
