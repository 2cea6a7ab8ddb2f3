"""The catalogue of divergences from the vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaria.functions import text as tx

DELIVERY_FIELDS = {"produto": "produto_normalizado", "eixo": "eixo_normalizado"}
RISK_FIELDS = {"probabilidade": "probabilidade_normalizada", "impacto": "impacto_normalizado", "tratamento": "tratamento_normalizado"}


def variation_type(original: Column, normalized: Column, method: Column) -> Column:
    """exato, alias, aproximado, imputado or residual; the catch-all value is residual however it was met."""
    o, n = tx.stripped(tx.blank_as_empty(original)), tx.stripped(tx.blank_as_empty(normalized))
    inferred = (o == "") & (n != "")
    return (
        F.when(F.lower(n) == "outros", "residual")
        .when(method == "exact", "exato")
        .when(method == "alias", "alias")
        .when(method == "fuzzy_high", "aproximado")
        .when(inferred, "imputado")
        .when((method == "unmatched"), "residual")
        .when(o == n, "exato")
        .otherwise("residual")
    )


def variations(df: DataFrame, entry_type: str, fields: dict[str, str], key: str = "orgao_sigla") -> DataFrame:
    """A row for each categorical value that is not exact."""
    each = F.array(*[
        F.struct(F.lit(f).alias("field"), F.coalesce(f"{f}_original", F.lit("")).alias("original"), F.coalesce(n, F.lit("")).alias("normalizado"), F.coalesce(f"{f}_method", F.lit("")).alias("method"), F.col(f"{f}_score").alias("score"))
        for f, n in fields.items()
    ])
    rows = df.select(F.col(key).alias("orgao_sigla"), F.lit(entry_type).alias("entry_type"), F.explode(each).alias("x")).select("orgao_sigla", "entry_type", "x.*")
    return rows.withColumn("variation_type", variation_type(F.col("original"), F.col("normalizado"), F.col("method"))).filter("variation_type != 'exato'")


def catalogue(deliveries: DataFrame, risks: DataFrame) -> DataFrame:
    """Both kinds of entries, sorted."""
    both = variations(deliveries, "entrega", DELIVERY_FIELDS).unionByName(variations(risks, "risco", RISK_FIELDS))
    return both.orderBy("entry_type", "field", "variation_type", "orgao_sigla", "original")


def summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("field", "variation_type").agg(F.count("*").alias("n"))
