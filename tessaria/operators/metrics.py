"""Counts, rates, top lists, distributions, gates, and the validation report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessaria.functions import text as tx
from tessaria.functions import vocab
from tessaria.sources.files import cut


class GateFailed(Exception):
    """A run is below a floor or over a limit."""


def sorted_stable(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """By the keys as text, null as empty, in code point order; ties as they were read."""
    return df.orderBy(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], seq)


def top(df: DataFrame, value_col: str, seq: str, n: int = 20) -> DataFrame:
    """(value, n, first): the most frequent values; of ties the one met first."""
    counts = df.groupBy(F.col(value_col).alias("value")).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    return counts.orderBy(F.desc("n"), "first").limit(n)


def distribution(df: DataFrame, value_col: str) -> DataFrame:
    return df.groupBy(F.col(value_col).alias("value")).agg(F.count("*").alias("n"))


def canonical(value: Column, allowed: list[str], several: bool = False) -> Column:
    """Whether a value is on the scale; with ``several``, whether all of its parts at ; are."""
    if not several:
        return F.coalesce(value.isin(allowed), F.lit(False))
    parts = F.filter(F.transform(F.split(tx.blank_as_empty(value), ";"), tx.stripped), lambda p: p != "")
    known = F.array(*map(F.lit, allowed))
    return (F.size(parts) > 0) & F.forall(parts, lambda p: F.array_contains(known, p))


def canonical_rates(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row: total, and ok and rate for each named condition."""
    sums = df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(f"{n}_ok") for n, c in columns.items()])
    return sums.select("total", *[x for n in columns for x in (F.col(f"{n}_ok"), tx.ratio_of(F.col(f"{n}_ok"), F.col("total")).alias(f"{n}_rate"))])


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def checks(metrics: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """(name, actual, bound, limit, ok) for one row of metrics; bound is max or min."""
    each = F.array(*[
        F.struct(F.lit(m).alias("name"), F.col(m).cast("double").alias("actual"), F.lit(bound).alias("bound"), F.lit(float(limit)).alias("limit"), (F.col(m) <= limit if bound == "max" else F.col(m) >= limit).alias("ok"))
        for m, (bound, limit) in limits.items()
    ])
    return metrics.select(F.explode(each).alias("x")).select("x.*")


def gate(results: DataFrame) -> None:
    """Raises unless every check is ok."""
    bad = results.filter(~F.coalesce("ok", F.lit(False))).collect()
    if bad:
        raise GateFailed("; ".join(f"{r['name']}: {r['actual']} ({r['bound']} {r['limit']})" for r in bad))


def file_counts(meta: DataFrame, type_col: str = "tipo") -> DataFrame:
    """One row: total, diretivo and entregas files."""
    kind = F.lower(tx.stripped(tx.blank_as_empty(F.col(type_col))))
    return meta.agg(F.count("*").alias("total"), F.count_if(kind == "diretivo").alias("diretivo"), F.count_if(kind == "entregas").alias("entregas"))


#: Columns whose values the report counts, by table; and of the risks' the scale, its name and whether values have several parts.
REPORTED = {"deliveries": ("produto_normalizado", "eixo_normalizado"), "risks": ("probabilidade_normalizada", "impacto_normalizado", "tratamento_normalizado")}
SCALES = {"probabilidade_normalizada": ("probability", vocab.PROBABILITY, False), "impacto_normalizado": ("impact", vocab.IMPACT, False), "tratamento_normalizado": ("treatment", vocab.TREATMENT, True)}
#: Values of a top list.
LISTED = 20


def value_counts(organs: DataFrame, deliveries: DataFrame, risks: DataFrame, errors: DataFrame) -> DataFrame:
    """(tab, field, value, n, first) of every reported value, and of each table's rows and rows to review (fields rows, review).

    One grouped pass over all tables with their columns side by side as rows; ``first`` is the smallest seq.
    """
    none = F.lit(None).cast("string")
    out = None
    for name, df in (("organs", organs), ("deliveries", deliveries), ("risks", risks), ("errors", errors)):
        cells = [F.struct(F.lit("rows").alias("field"), none.alias("value"))]
        if name in REPORTED:
            cells.append(F.when(F.coalesce("needs_review", F.lit(False)), F.struct(F.lit("review").alias("field"), none.alias("value"))))
            cells += [F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in REPORTED[name]]
        seq = F.col("seq") if name in REPORTED else F.lit(None).cast("long")
        rows = df.select(F.lit(name).alias("tab"), seq.alias("seq"), F.explode(F.array_compact(F.array(*cells))).alias("c")).select("tab", "c.field", "c.value", "seq")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("tab", "field", "value").agg(F.count("*").alias("n"), F.min("seq").alias("first"))


def _on_scale() -> Column:
    """Whether a counted value is on its field's scale; null for fields without one."""
    out = F.lit(None).cast("boolean")
    for field, (_, allowed, several) in SCALES.items():
        out = F.when(F.col("field") == field, canonical(F.col("value"), allowed, several)).otherwise(out)
    return out


def _totals(counts: DataFrame) -> DataFrame:
    """One row: {table}_rows and {table}_review, and {scale}_ok and {scale}_rate."""
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    of = [total((F.col("tab") == t) & (F.col("field") == "rows")).alias(f"{t}_rows") for t in ("organs", "deliveries", "risks", "errors")]
    of += [total((F.col("tab") == t) & (F.col("field") == "review")).alias(f"{t}_review") for t in REPORTED]
    of += [total((F.col("field") == field) & _on_scale()).alias(f"{k}_ok") for field, (k, *_) in SCALES.items()]
    sums = counts.agg(*of)
    return sums.select("*", *[tx.ratio_of(F.col(f"{k}_ok"), F.col("risks_rows")).alias(f"{k}_rate") for k, *_ in SCALES.values()])


def _limits() -> list[Column]:
    """(name, actual, limit, passed) of every limit, over ``_totals``."""
    per = [F.struct(F.lit(t).alias("name"), F.col(f"{t}_rows").cast("double").alias("actual"), (F.col("organs_rows") * vocab.LIMITS[f"{t}_per_group"]).cast("double").alias("limit"), (F.col(f"{t}_rows") <= F.col("organs_rows") * vocab.LIMITS[f"{t}_per_group"]).alias("passed")) for t in REPORTED]
    return per + [F.struct(F.lit(k).alias("name"), F.col(f"{k}_rate").alias("actual"), F.lit(float(vocab.LIMITS[f"{k}_share"])).alias("limit"), (F.col(f"{k}_rate") >= vocab.LIMITS[f"{k}_share"]).alias("passed")) for k, *_ in SCALES.values()]


def _lists(counts: DataFrame) -> DataFrame:
    """(section, field, value, rank, n): the most frequent values of each field, and of each scale those that are not on it."""
    valued = counts.filter(~F.col("field").isin("rows", "review"))
    kinds = F.array_compact(F.array(F.lit("top"), F.when(~_on_scale(), F.lit("non_canonical_top"))))
    rank = F.row_number().over(W.partitionBy("section", "field").orderBy(F.desc("n"), "first", "value"))
    return valued.withColumn("section", F.explode(kinds)).withColumn("rank", rank).filter(F.col("rank") <= LISTED).select("section", "field", "value", "rank", "n")


def report_rows(counts: DataFrame) -> DataFrame:
    """The validation report as rows (section, field, name, rank, n, rate, passed), of ``value_counts``.

    Sections: counts, canonization, thresholds (``rate`` is the actual value), distributions (every value
    of every field), top and non_canonical_top (at most ``LISTED`` values of each field).
    """
    row = lambda section, field, name, n=None, rate=None, passed=None: F.struct(F.lit(section).alias("section"), F.lit(field).alias("field"), F.lit(name).alias("name"), F.lit(None).cast("int").alias("rank"), (F.lit(None) if n is None else n).cast("long").alias("n"), (F.lit(None) if rate is None else rate).cast("double").alias("rate"), (F.lit(None) if passed is None else passed).cast("boolean").alias("passed"))
    scalars = [row("counts", t, "rows", F.col(f"{t}_rows")) for t in ("organs", "deliveries", "risks", "errors")] + [row("counts", t, "review", F.col(f"{t}_review")) for t in REPORTED]
    scalars += [row("canonization", field, "ok", F.col(f"{k}_ok"), F.col(f"{k}_rate")) for field, (k, *_) in SCALES.items()]
    scalars += [row("thresholds", "", s["name"], None, s["actual"], s["passed"]) for s in _limits()]
    one = _totals(counts).select(F.inline(F.array(*scalars)))
    every = counts.filter(~F.col("field").isin("rows", "review")).select(F.lit("distributions").alias("section"), "field", F.col("value").alias("name"), F.lit(None).cast("int").alias("rank"), "n", F.lit(None).cast("double").alias("rate"), F.lit(None).cast("boolean").alias("passed"))
    lists = _lists(counts).select("section", "field", F.col("value").alias("name"), "rank", "n", F.lit(None).cast("double").alias("rate"), F.lit(None).cast("boolean").alias("passed"))
    return one.unionByName(every).unionByName(lists)


def validation_report(organs: DataFrame, deliveries: DataFrame, risks: DataFrame, errors: DataFrame) -> DataFrame:
    """One nested row: counts, canonical rates, the most frequent values of each field, those off their scale, and checks.

    The tables are read once (``value_counts``); distributions, which may be long, are ``report_rows``'.
    """
    counts = cut(value_counts(organs, deliveries, risks, errors))
    totals = _totals(counts)
    lists = _lists(counts).groupBy("section", "field").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("t"))  # LISTED values each
    listed = lambda section, field: F.coalesce(F.first(F.when((F.col("section") == section) & (F.col("field") == field), F.transform("t", lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n")))), ignorenulls=True), F.array().cast("array<struct<value: string, n: bigint>>"))
    tops = [listed("top", f).alias(f"top_{f}") for fields in REPORTED.values() for f in fields] + [listed("non_canonical_top", f).alias(f"non_canonical_{f}") for f in SCALES]
    nested = totals.select(
        F.struct(F.col("organs_rows").alias("n")).alias("organs"),
        *[F.struct(F.col(f"{t}_rows").alias("n"), F.col(f"{t}_review").alias("review")).alias(t) for t in REPORTED],
        F.struct(F.col("errors_rows").alias("n")).alias("errors"),
        F.struct(F.col("risks_rows").alias("total"), *[x for k, *_ in SCALES.values() for x in (F.col(f"{k}_ok"), F.col(f"{k}_rate"))]).alias("canonical"),
        F.struct(*[s["passed"].alias(k) for s, k in zip(_limits(), [*REPORTED, *[k for k, *_ in SCALES.values()]], strict=True)]).alias("checks"),
    )
    return nested.join(lists.agg(*tops))  # a row each
