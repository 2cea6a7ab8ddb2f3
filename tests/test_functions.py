"""Text functions and matching on hand-written cases."""

import pytest
from pyspark.sql import functions as F

from tessaria.functions import text as tx
from tessaria.functions import vocab
from tessaria.operators import match


def values(spark, rule, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(rule(F.col("v"))).collect()]


CASES = [
    (tx.normalize_text, [(None, ""), ("", ""), ("hello\t\n world", "hello world"), ("A) Evitar", "Evitar"), ("II. Probabilidade", "Probabilidade"), ("abcd) X", "abcd) X"), ("  A)  Reduzir  ", "Reduzir"), ("A) B) x", "B) x"), ("1-Alto", "1-Alto"), ("a​b", "ab"), ("é", "é"), ("x\x1fy", "x y")]),
    (tx.strip_accents, [("Integração", "Integracao"), ("MAÇÃ", "MACA"), ("ª½", "a1⁄2"), ("ŀ", "l·"), ("plain", "plain")]),
    (tx.parse_date, [("", None), (None, None), ("31/12/2025", "2025-12-31"), ("12/2025", "2025-12"), ("2025-01-02 x", "2025-01-02"), ("jun/25", "2025-06"), ("Mar.2026", "2026-03"), ("texto qualquer", "texto qualquer"), ("99/99/2025", "2025-99-99"), ("xyz/25", "xyz/25")]),
    (tx.parse_document_date, [("D:20260429120000-03'00'", "2026-04-29"), ("D:2026", ""), (None, "")]),
    (tx.is_fragment, [("Probabilidade-", True), ("-rência", True), ("de de Ocor", True), ("raro", False), ("", False), (None, False), ("a -", False), ("-", False)]),
    (tx.is_blank, [(None, True), (" NaN ", True), ("x", False), (" ", True)]),
    (lambda c: tx.is_literal(c, tx.RISK_HEADERS), [("Nível de Impacto", True), ("Ação", False), ("Ações", True), ("", False), (None, False)]),
    (tx.is_other, [("Outros –", True), ("OUTRO", True), ("outra", False), (None, False)]),
    (tx.line_count, [("", 0), ("a", 1), ("a\n", 1), ("a\nb", 2), (None, 0)]),
    (tx.slug, [("Muito Alto/X", "muito-alto-x")]),
]


@pytest.mark.parametrize(("rule", "cases"), CASES)
def test_rules(spark, rule, cases):
    assert values(spark, rule, [i for i, _ in cases]) == [o for _, o in cases]


def test_sizes(spark):
    rows = spark.createDataFrame([(5,), (2048,), (3 << 20,)], "n long").select(tx.size_text(F.col("n"))).collect()
    assert [r[0] for r in rows] == ["5 B", "2.0 KB", "3.0 MB"]


def matched(spark, inputs, *args, **kw):
    rows = spark.createDataFrame([(v,) for v in inputs], "v string")
    return {r.value: (r.canonical, r.score) for r in match.match_values(rows, "v", *args, **kw).collect()}


def test_scale_aliases_exact_and_similar(spark):
    got = matched(spark, ["Pouca", "1", "5", "baixa", "RARO", "provavel", "rarro", "", None, "  "], vocab.PROBABILITY, vocab.PROBABILITY_ALIASES)
    assert got["Pouca"] == ("pouco provável", 0.95)
    assert got["1"] == ("raro", 0.95) and got["5"] == ("praticamente certo", 0.95) and got["baixa"] == ("pouco provável", 0.95)
    assert got["RARO"] == ("raro", 1.0) and got["provavel"] == ("provável", 1.0)
    assert got["rarro"][0] == "raro" and got["rarro"][1] == pytest.approx(8 / 9)
    assert got[""] == ("", 0.0) and got[None] == ("", 0.0) and got["  "] == ("", 0.0)


def test_products_by_alias_order_and_ties(spark):
    got = matched(spark, ["Integração ao Login Unico", "implementacao do vlibras", "Integração ao Login Únic"], vocab.ALL_PRODUCTS, vocab.PRODUCT_ALIASES, (1.0, 0.98), by_key=False)
    assert got["Integração ao Login Unico"][0] == "Integração ao Login Único"
    assert got["implementacao do vlibras"] == ("Implementação do VLIBRAS", 0.98)
    assert 0.85 <= got["Integração ao Login Únic"][1] < 1
    assert matched(spark, ["ab"], ["xb", "ax"])["ab"] == ("xb", 0.5)


def test_method_buckets(spark):
    rows = spark.createDataFrame([("x", 0.999), ("x", 0.85), ("x", 0.84), ("x", 0.7), ("x", 0.69), ("", 0.95)], "v string, s double")
    assert [r[0] for r in rows.select(match.match_method(F.col("v"), F.col("s"))).collect()] == ["exact", "fuzzy_high", "fuzzy_low", "fuzzy_low", "unmatched", "unmatched"]
    assert rows.limit(1).select(match.match_method(F.lit("a"), F.lit(0.9), F.lit(True))).first()[0] == "alias"


def test_half_even(spark):
    assert spark.range(1).select(match.half_even(F.lit(0.0625))).first()[0] == 0.062


def test_unicode_forms(spark):
    """Ligatures, letters beyond Latin extended, marks in any order, full-width and circled letters, against the Unicode data."""
    import unicodedata

    texts = ["Uni\ufb01ca\u00e7\u00e3o", "\u1ea1 \u1ec7 e\u0323\u0302 e\u0302\u0323 a\u0301", "\u212b \u2126", "\u2460\u00bd\ufb03 \uff21\uff42", "plain", "\u03ac \u0439 \u1f04", "e\u0301 e\u0301\u0323"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.composed(F.col("t")).alias("c"), tx.strip_accents(F.col("t")).alias("s")).collect()
    for r in rows:
        assert r.c == unicodedata.normalize("NFC", r.t)
        assert r.s == "".join(x for x in unicodedata.normalize("NFKD", r.t) if not unicodedata.combining(x))


def test_sizes_round_half_to_even(spark):
    sizes = [0, 1023, 1024, 1280, 1331, 1536, 1048575, 1048576, 1310720, 10**9 + 3, *range(1024, 3000, 13)]
    want = {n: f"{n} B" if n < 1024 else f"{n / 1024:.1f} KB" if n < 1 << 20 else f"{n / (1 << 20):.1f} MB" for n in sizes}
    got = spark.createDataFrame([(n,) for n in [*sizes, None]], "n long").select("n", tx.size_text(F.col("n")).alias("r")).collect()
    assert {r.n: r.r for r in got} == want | {None: None}


def test_scores_round_as_their_binary_values_do(spark):
    from tessaria.operators import match

    values = [0.8625, 0.0625, 0.1875, 1.0, 0.0, 1 / 3, *[i / 2000 for i in range(2001)]]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", match.half_even(F.col("v")).alias("r")).collect()
    assert all(r.r == round(r.v, 3) for r in got)
