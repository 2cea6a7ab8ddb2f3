"""Standardising deliveries and risks: matched values, scores, methods and the review triple.

A value is matched once however often it occurs. Review marks of a value belong to its first
row; ``review_all`` gives them to every row. ``seq`` numbers the rows as they were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessaria.functions import text as tx
from tessaria.functions import vocab
from tessaria.operators import match

UNMATCHED = "UNMATCHED"


def _two(score: Column) -> Column:
    return F.format_number(score, 2)


def _matched(rows: DataFrame, base: DataFrame, value_col: str, name: str, candidates: list[str], alias_map: dict[str, str], scores: tuple[float, float], by_key: bool) -> DataFrame:
    """``rows`` with {name}_match, {name}_raw_score, {name}_method, {name}_first and {name}_first_value, all of the key's first row.

    Keys come from ``base``, so that a second column's plan does not hold the first one's.
    """
    key = tx.normalize_text(F.col(value_col))
    first = base.select(key.alias("j_key"), F.coalesce(value_col, F.lit("")).alias("f_value"), "seq").groupBy("j_key").agg(F.min_by("f_value", "seq").alias("f_value"), F.min("seq").alias("f_seq"))
    got = match.match_values(first, "f_value", candidates, alias_map, scores, by_key).withColumnRenamed("value", "g_value")
    keys = match.alias_keys(alias_map)
    first = first.join(got, F.col("f_value") == F.col("g_value")).select(
        "j_key", F.col("f_value").alias(f"{name}_first_value"), "f_seq",
        F.col("canonical").alias(f"{name}_match"), F.col("score").alias(f"{name}_raw_score"),
        match.match_method(F.col("f_value"), F.col("score"), tx.key(F.col("f_value")).isin(keys)).alias(f"{name}_method"),
    )
    joined = rows.withColumn("r_key", key).join(first, F.col("r_key") == F.col("j_key"))
    return joined.withColumn(f"{name}_first", F.col("seq") == F.col("f_seq")).drop("j_key", "r_key", "f_seq")


def standardize_deliveries(df: DataFrame, review_all: bool = False) -> DataFrame:
    """``df`` (seq, produto_original, eixo_original, needs_review, review_reason, extraction_confidence) standardised.

    Products from 0.85 on are set, from 0.70 on set for review, below UNMATCHED; axes from 0.70 on
    are set, below kept as the key's first row has them. A product's own axis overrides.
    """
    rows = _matched(df, df, "produto_original", "produto", vocab.ALL_PRODUCTS, vocab.PRODUCT_ALIASES, (1.0, 0.98), False)
    rows = _matched(rows, df, "eixo_original", "eixo", vocab.AXES, vocab.AXIS_ALIASES, (0.95, 0.93), False)
    p, first = F.col("produto_raw_score"), F.lit(True) if review_all else F.col("produto_first")
    product = F.when(p >= vocab.REVIEW, F.col("produto_match")).otherwise(UNMATCHED)
    weak = first & (p < vocab.ACCEPT)
    reason = F.when(~weak, F.col("review_reason")).when(p >= vocab.REVIEW, F.concat(F.lit("fuzzy match baixo ("), _two(p), F.lit(")"))).otherwise(F.concat(F.lit("produto não reconhecido (melhor score: "), _two(p), F.lit(")")))
    review = F.coalesce("needs_review", F.lit(False)) | weak
    axis = F.when(F.col("eixo_raw_score") >= vocab.REVIEW, F.col("eixo_match")).otherwise(F.col("eixo_first_value"))
    table = F.create_map(*[F.lit(x) for kv in vocab.PRODUCT_AXIS.items() for x in kv])
    own = F.element_at(table, product)
    wrong = own.isNotNull() & (axis != own)
    change = F.concat(F.lit("'"), axis, F.lit("' → '"), own, F.lit("'"))
    confidence = F.when(weak & (p >= vocab.REVIEW), "medium").when(weak, "low").otherwise(F.col("extraction_confidence"))
    return rows.select(
        *[c for c in df.columns if c not in ("needs_review", "review_reason", "extraction_confidence")],
        product.alias("produto_normalizado"), match.half_even(p).alias("produto_score"), "produto_method",
        F.when(wrong, own).otherwise(axis).alias("eixo_normalizado"), match.half_even(F.col("eixo_raw_score")).alias("eixo_score"), "eixo_method",
        confidence.alias("extraction_confidence"),
        (review | wrong).alias("needs_review"),
        F.when(wrong & ~review, F.concat(F.lit("eixo corrigido por cross-validation: "), change))
        .when(wrong & (tx.blank_as_empty(reason) != "") & ~F.contains(tx.blank_as_empty(reason), F.lit("eixo corrigido")), F.concat(reason, F.lit("; eixo corrigido: "), change))
        .otherwise(reason).alias("review_reason"),
    )


def drop_fragments(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): catch-all products whose service has under ten characters are fragments."""
    fragment = (F.coalesce("produto_normalizado", F.lit("")) == "Outros") & (F.length(tx.stripped(tx.blank_as_empty(F.col("servico_acao")))) < 10)
    return df.filter(~fragment), df.filter(fragment)


def _treatments(df: DataFrame) -> DataFrame:
    """(t_key, t_value, t_score, t_method, t_reasons, t_seq) of each treatment: parts matched alone, the worst score counts."""
    keyed = df.select("seq", tx.normalize_text(F.col("tratamento_original")).alias("t_key"), F.coalesce("tratamento_original", F.lit("")).alias("t_raw"))
    first = keyed.groupBy("t_key").agg(F.min("seq").alias("t_seq"), F.min_by("t_raw", "seq").alias("t_raw"))
    parts = first.select("t_key", F.posexplode(F.filter(F.transform(F.split("t_key", r"(?U)\s*[;,/]\s*"), tx.stripped), lambda x: x != "")).alias("at", "part"))
    got = match.match_values(parts, "part", vocab.TREATMENT, vocab.TREATMENT_ALIASES).withColumnRenamed("value", "g_part")
    each = parts.join(got, F.col("part") == F.col("g_part")).select(
        "t_key", "at", "score",
        F.when(F.col("score") >= vocab.REVIEW, F.col("canonical")).otherwise(F.col("part")).alias("value"),
        F.when(F.col("score") < vocab.REVIEW, F.concat(F.lit("tratamento '"), F.col("part"), F.lit("' não reconhecido (score: "), _two(F.col("score")), F.lit(")"))).alias("reason"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "value", "reason")))
    merged = each.groupBy("t_key").agg(ordered.alias("o"), F.min("score").alias("worst"))
    out = first.join(merged.withColumnRenamed("t_key", "m_key"), F.col("t_key") == F.col("m_key"), "left")
    score = F.when(F.col("t_key") == "", 0.0).otherwise(F.coalesce("worst", F.lit(1.0)))
    return out.select(
        "t_key", "t_seq",
        F.coalesce(F.array_join(F.transform("o", lambda x: x["value"]), "; "), F.col("t_key")).alias("t_value"),
        score.alias("t_score"),
        match.match_method(F.col("t_raw"), score, tx.key(F.col("t_raw")).isin(match.alias_keys(vocab.TREATMENT_ALIASES))).alias("t_method"),
        F.coalesce(F.filter(F.transform("o", lambda x: x.reason), lambda x: x.isNotNull()), F.array().cast("array<string>")).alias("t_reasons"),
    )


def standardize_risks(df: DataFrame, review_all: bool = False) -> DataFrame:
    """``df`` (seq, probabilidade_original, impacto_original, tratamento_original, review triple) standardised.

    Scales from 0.70 on are set, below kept as the key's first row has them; under 0.85 the first
    row gets a reason. The least of the three scores decides the confidence.
    """
    rows, reasons = df, []
    for name, label, scale, alias_map in (("probabilidade", "probabilidade", vocab.PROBABILITY, vocab.PROBABILITY_ALIASES), ("impacto", "impacto", vocab.IMPACT, vocab.IMPACT_ALIASES)):
        rows = _matched(rows, df, f"{name}_original", name, scale, alias_map, (0.95, 0.95), True)
        s, first = F.col(f"{name}_raw_score"), F.lit(True) if review_all else F.col(f"{name}_first")
        weak = F.when(s >= vocab.REVIEW, F.concat(F.lit(f"{label} fuzzy ("), _two(s), F.lit(")"))).otherwise(F.concat(F.lit(f"{label} não reconhecid{'a' if name == 'probabilidade' else 'o'} (score: "), _two(s), F.lit(")")))
        reasons.append(F.when(first & (s < vocab.ACCEPT), weak))
    t = _treatments(df).withColumnRenamed("t_key", "tk")
    rows = rows.withColumn("t_key", tx.normalize_text(F.col("tratamento_original"))).join(t, F.col("t_key") == F.col("tk"))
    t_first = F.lit(True) if review_all else F.col("seq") == F.col("t_seq")
    several = F.contains(F.col("t_value"), F.lit("; "))
    more = F.when(several, F.concat(F.lit("tratamento múltiplo/composto ('"), F.substring("t_value", 1, 40), F.lit("')")))
    found = F.concat(F.array_compact(F.array(*reasons)), F.when(t_first, F.col("t_reasons")).otherwise(F.array().cast("array<string>")), F.array_compact(F.array(more)))
    least = F.least("probabilidade_raw_score", "impacto_raw_score", "t_score")
    before = F.coalesce("needs_review", F.lit(False)) | several
    confidence = F.when(least >= vocab.ACCEPT, F.when(before, F.col("extraction_confidence")).otherwise("high")).when(least >= vocab.REVIEW, "medium").otherwise("low")
    value = lambda name: F.when(F.col(f"{name}_raw_score") >= vocab.REVIEW, F.col(f"{name}_match")).otherwise(F.col(f"{name}_first_value"))
    old = F.when(tx.blank_as_empty(F.col("review_reason")) != "", F.col("review_reason"))
    return rows.select(
        *[c for c in df.columns if c not in ("needs_review", "review_reason", "extraction_confidence")],
        value("probabilidade").alias("probabilidade_normalizada"), match.half_even(F.col("probabilidade_raw_score")).alias("probabilidade_score"), "probabilidade_method",
        value("impacto").alias("impacto_normalizado"), match.half_even(F.col("impacto_raw_score")).alias("impacto_score"), "impacto_method",
        F.col("t_value").alias("tratamento_normalizado"), match.half_even(F.col("t_score")).alias("tratamento_score"), F.col("t_method").alias("tratamento_method"),
        confidence.alias("extraction_confidence"),
        (before | (least < vocab.ACCEPT) | (F.size(found) > 0)).alias("needs_review"),
        F.when(F.size(found) > 0, F.concat_ws("; ", old, F.array_join(found, "; "))).otherwise(F.col("review_reason")).alias("review_reason"),
    )


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with seq: its rows' numbers by ``order``, made range by range so that no task holds all rows."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("n_part", F.spark_partition_id()).withColumn("n_at", F.monotonically_increasing_id())
    sizes = ranged.groupBy("n_part").agg(F.count("*").alias("n"), F.min("n_at").alias("n_first"))
    before = sizes.select(F.col("n_part").alias("b_part"), "n_first", (F.sum("n").over(W.orderBy("n_part")) - F.col("n")).alias("n_before"))  # a row for each partition
    return ranged.join(F.broadcast(before), F.col("n_part") == F.col("b_part")).withColumn("seq", F.col("n_before") + F.col("n_at") - F.col("n_first")).drop("n_part", "n_at", "b_part", "n_first", "n_before")
