"""Harmonising canonical columns: keep, deduplicate, or blank with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaria.functions import text as tx


def harmonize_cell(value: Column, allowed: list[str]) -> Column:
    """struct<value, reason>: reason is null, deduplicado, multiplos_valores or column_bleed."""
    known = F.array(*map(F.lit, allowed))
    split = lambda v: F.struct(v.alias("v"), F.filter(F.transform(F.split(v, "[;|]"), tx.stripped), lambda t: t != "").alias("tokens"))

    def cell(x: Column) -> Column:
        once, blank, keep = F.array_distinct(x.tokens), F.lower(x.v).isin("", "nan"), x.v.isin(allowed)
        fine = (F.size(x.tokens) > 0) & F.forall(x.tokens, lambda t: F.array_contains(known, t))
        single = fine & (F.size(once) == 1)
        return F.struct(
            F.when(blank, "").when(keep, x.v).when(single, F.get(once, F.lit(0))).otherwise("").alias("value"),
            F.when(blank | keep, F.lit(None).cast("string")).when(single, "deduplicado").when(fine, "multiplos_valores").otherwise("column_bleed").alias("reason"),
        )

    return tx.let(tx.let(tx.stripped(tx.blank_as_empty(value)), split), cell)


def harmonize_table(df: DataFrame, allowed: dict[str, list[str]], key: str = "orgao_sigla", row_col: str = "row") -> tuple[DataFrame, DataFrame]:
    """(harmonised table, change log) over those of the columns of ``allowed`` that ``df`` has.

    A blanked value marks its row for review and names the column and the reason.
    """
    columns = [c for c in allowed if c in df.columns]
    cells = {c: harmonize_cell(F.col(c), allowed[c]) for c in columns}
    marks = F.array_compact(F.array(*[F.when(cells[c].reason.isin("column_bleed", "multiplos_valores"), F.concat(F.lit(f"{c}:"), cells[c].reason)) for c in columns]))
    note = F.concat(F.lit("harmonizacao("), F.array_join(marks, ","), F.lit(")"))
    old = F.when(tx.blank_as_empty(F.col("review_reason")) != "", F.col("review_reason")) if "review_reason" in df.columns else F.lit(None).cast("string")
    was = F.col("needs_review") if "needs_review" in df.columns else F.lit(False)
    marked = F.size(marks) > 0
    table = df.select(
        *[cells[c].value.alias(c) if c in cells else F.col(c) for c in df.columns if c not in ("needs_review", "review_reason")],
        (F.coalesce(was, F.lit(False)) | marked).alias("needs_review"),
        F.when(marked, F.concat_ws("; ", old, note)).otherwise(old).alias("review_reason"),
    )
    each = F.array(*[F.struct(F.lit(c).alias("campo"), tx.stripped(tx.blank_as_empty(F.col(c))).alias("original_normalizado"), cells[c].value.alias("harmonizado"), cells[c].reason.alias("motivo")) for c in columns])
    log = df.select(row_col, F.col(key).alias("orgao"), F.explode(each).alias("x")).select(row_col, "orgao", "x.*")
    return table, log.filter(F.col("motivo").isNotNull() & (F.col("harmonizado") != F.col("original_normalizado")))


def report(log: DataFrame) -> DataFrame:
    """(motivo, n) of a change log."""
    return log.groupBy("motivo").agg(F.count("*").alias("n"))
