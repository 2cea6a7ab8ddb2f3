"""Audit of extracted risks: captured headers, fragments, bled columns, shifted columns, swaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaria.functions import text as tx
from tessaria.functions import vocab
from tessaria.operators import match

LONGEST = 30
SCALES = {"probabilidade": vocab.PROBABILITY, "impacto": vocab.IMPACT, "tratamento": vocab.TREATMENT}
OTHERS = {"probabilidade": ["impacto"], "impacto": ["probabilidade"], "tratamento": ["probabilidade", "impacto"]}


def scale_scores(df: DataFrame, value_col: str, scales: dict[str, list[str]]) -> DataFrame:
    """(value, score on each scale) of the distinct values; aliases do not count here."""
    values = df.select(F.col(value_col).alias("value")).distinct()
    out = values
    for name, scale in scales.items():  # each from the values themselves, so that plans add up and do not multiply
        m = match.match_values(values, "value", scale).select(F.col("value").alias("m_value"), F.col("score").alias(f"on_{name}"))
        out = out.join(m, F.col("value").eqNullSafe(F.col("m_value"))).drop("m_value")
    return out


def is_bleed(value: Column, own: Column) -> Column:
    """Too long for the scale, and like nothing on it."""
    return (F.length(tx.blank_as_empty(value)) > LONGEST) & (own < vocab.REVIEW)


def shifted_to(own: Column, others: dict[str, Column]) -> Column:
    """The first other scale that a value fits clearly better than its own, or null."""
    fits = [F.when((own < vocab.ACCEPT) & (s >= vocab.ACCEPT) & (s > own + 0.10), F.lit(n)) for n, s in others.items()]
    return F.coalesce(*fits)


def swapped(probability: Column, impact: Column, p_own: Column, i_own: Column, p_on_impact: Column, i_on_probability: Column) -> Column:
    """Whether the two columns stand in each other's place."""
    there = (tx.blank_as_empty(probability) != "") & (tx.blank_as_empty(impact) != "")
    fine = (p_own >= vocab.REVIEW) & (i_own >= vocab.REVIEW)
    return there & ~fine & (p_on_impact >= vocab.ACCEPT) & (i_on_probability >= vocab.ACCEPT)


def is_long_bleed(value: Column, score: Column) -> Column:
    """Over a hundred characters that match nothing."""
    return (F.length(tx.blank_as_empty(value)) > 100) & (score < vocab.REVIEW)


def audit_risks(df: DataFrame) -> DataFrame:
    """``df`` with the review triple extended, and audit: the categories found.

    Each field takes the first of: captured header, fragment, bleed, shift. Any reason marks the
    row for review with low confidence, after the reasons that it has.
    """
    rows, reasons, kinds = df, [], []
    for field, others in OTHERS.items():
        col = f"{field}_original"
        scores = scale_scores(df, col, {n: SCALES[n] for n in (field, *others)}).select(F.col("value").alias(f"v_{field}"), *[F.col(f"on_{n}").alias(f"{field}_on_{n}") for n in (field, *others)])
        rows = rows.join(scores, F.col(col).eqNullSafe(F.col(f"v_{field}"))).drop(f"v_{field}")
        v, own = F.col(col), F.col(f"{field}_on_{field}")
        cut = F.substring(v, 1, 30)
        shift = shifted_to(own, {n: F.col(f"{field}_on_{n}") for n in others})
        empty = tx.blank_as_empty(v) == ""
        cases = [
            (tx.is_literal(v, tx.AUDIT_HEADERS), "header_captured", F.concat(F.lit(f"{field}: header capturado ('"), cut, F.lit("')"))),
            (tx.is_fragment(v), "fragment", F.concat(F.lit(f"{field}: fragmento ('"), cut, F.lit("')"))),
            (is_bleed(v, own), "column_bleed", F.concat(F.lit(f"{field}: bleed de coluna ("), F.length(v).cast("string"), F.lit(" chars)"))),
            (shift.isNotNull(), "column_shift", F.concat(F.lit(f"{field}: column-shift (casa em '"), shift, F.lit("')"))),
        ]
        reason = kind = F.when(empty, F.lit(None).cast("string"))
        for test, name, told in cases:
            reason, kind = reason.when(test, told), kind.when(test, name)
        reasons.append(reason)
        kinds.append(kind)
    rows = rows.withColumns({"a_reasons": F.array_compact(F.array(*reasons)), "audit": F.array_compact(F.array(*kinds))})
    found = F.size("a_reasons") > 0
    old = F.when(tx.stripped(tx.blank_as_empty(F.col("review_reason"))) != "", tx.stripped(F.col("review_reason")))
    return rows.withColumns({
        "review_reason": F.when(found, F.concat_ws("; ", old, F.array_join("a_reasons", "; "))).otherwise(F.col("review_reason")),
        "needs_review": F.coalesce("needs_review", F.lit(False)) | found,
        "extraction_confidence": F.when(found, "low").otherwise(F.col("extraction_confidence")),
    }).select(*df.columns, "audit")


def audit_counts(audited: DataFrame) -> DataFrame:
    return audited.select(F.explode("audit").alias("category")).groupBy("category").agg(F.count("*").alias("n"))
