"""Runs: from raw entries to published tables, in a fixed order, with gates; and whether what is published is current.

``python -m tessaria derive SOURCE OUT`` reads organs, deliveries, risks and errors (Parquet, or CSV
with a header) from SOURCE and makes every derived table below OUT that is not current. ``--check``
writes nothing and fails if a table is stale, ``--gate`` fails if a floor or a limit is broken,
``--csv`` exports the published tables as ordered CSV below OUT/csv.
"""

from __future__ import annotations

import subprocess
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaria.functions import vocab
from tessaria.operators import audit, coverage, harmonize, match, metrics, standardize, variations
from tessaria.plans import schema
from tessaria.plans.graph import Derivation, Table
from tessaria.sources import export as csv_export
from tessaria.sources import files

ALLOWED = {"probabilidade_normalizada": vocab.PROBABILITY, "impacto_normalizado": vocab.IMPACT, "tratamento_normalizado": vocab.TREATMENT, "eixo_normalizado": vocab.AXES}
#: Tables in the order in which they are derived, each with the columns that sort it.
ORDER = {
    "standardized_deliveries": ("seq",), "deliveries": ("seq",), "risks": ("seq",), "vocabulary": ("type", "original"), "coverage": ("sigla",), "harmonized_deliveries": ("seq",), "harmonized_risks": ("seq",),
    "changes": ("tabela", "row", "campo"), "variations": ("entry_type", "field", "variation_type", "orgao_sigla", "original"), "report": ("section", "field", "rank", "name"),
}
#: Tables that are exported, with the columns that sort the export.
PUBLISHED = {
    "deliveries": ("orgao_sigla", "eixo_normalizado", "produto_normalizado", "servico_acao"), "risks": ("orgao_sigla", "risco_texto"),
    "vocabulary": ("type", "original"), "coverage": ("sigla",), "report": ("section", "field", "rank", "name"),
}
#: To be changed with the tables' definitions, so that they are made again.
VERSION = "3"


def git_head(folder: str = ".") -> str:
    """The commit of a folder, empty without one."""
    try:
        return subprocess.run(["git", "-C", folder, "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10, check=True).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return ""


def load(spark: SparkSession, source: str, name: str, fields: list[schema.Field]) -> DataFrame:
    """A table of SOURCE with the field model's columns; those that it lacks are null."""
    try:
        df = spark.read.parquet(f"{source}/{name}")
    except AnalysisException:
        df = files.read_csv(spark, f"{source}/{name}.csv")
    typed = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.spark().dataType).alias(f.name) for f in fields]
    return df.select(*typed, *[F.col(c) for c in df.columns if c == "seq"])


def with_seq(df: DataFrame, *order: str) -> DataFrame:
    """Rows numbered by the columns that identify them, unless they carry their numbers."""
    return df.withColumn("seq", F.col("seq").cast("long")) if "seq" in df.columns else standardize.numbered(df, *order)


def mapping(rows: DataFrame, kind: str, original: str, normalized: str, score: str) -> DataFrame:
    """(type, original, normalized, score, count) of a standardised column."""
    from tessaria.functions import text as tx

    keyed = rows.withColumn("v_key", tx.normalize_text(F.col(original)))
    return match.vocabulary_report(keyed, "v_key", normalized, score, "seq").select(F.lit(kind).alias("type"), "original", "normalized", "score", "count")


def _standardized(raw: DataFrame) -> DataFrame:
    made = {"produto_normalizado", "produto_score", "produto_method", "eixo_normalizado", "eixo_score", "eixo_method"}
    return standardize.standardize_deliveries(files.cut(with_seq(raw, "orgao_sigla", "servico_acao", "produto_original").drop(*made)))


def _risks(raw: DataFrame) -> DataFrame:
    made = {f"{f}_{x}" for f in audit.SCALES for x in ("normalizada", "normalizado", "score", "method")}
    numbered = files.cut(with_seq(raw, "orgao_sigla", "risco_texto", "probabilidade_original").drop(*made))
    return standardize.standardize_risks(files.cut(audit.audit_risks(numbered).drop("audit")))


def _vocabulary(all_d: DataFrame, risks: DataFrame) -> DataFrame:
    out = mapping(all_d, "produto", "produto_original", "produto_normalizado", "produto_score").unionByName(mapping(all_d, "eixo", "eixo_original", "eixo_normalizado", "eixo_score"))
    for name, normalized in variations.RISK_FIELDS.items():
        out = out.unionByName(mapping(risks, name, f"{name}_original", normalized, f"{name}_score"))
    return out


def _harmonized(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return harmonize.harmonize_table(df.withColumn("row", F.col("seq")), ALLOWED)


def _changes(deliveries: DataFrame, risks: DataFrame) -> DataFrame:
    log = lambda df, name: _harmonized(df)[1].withColumn("tabela", F.lit(name))
    return log(deliveries, "deliveries").unionByName(log(risks, "risks"))


def _report(organs: DataFrame, deliveries: DataFrame, risks: DataFrame, errors: DataFrame) -> DataFrame:
    return metrics.report_rows(files.cut(metrics.value_counts(organs, deliveries, risks, errors)))


def tables() -> list[Table]:
    """Every derived table, each after what it is made from."""
    makes = {
        "standardized_deliveries": (("source_deliveries",), _standardized),
        "deliveries": (("standardized_deliveries",), lambda all_d: standardize.drop_fragments(all_d)[0]),
        "risks": (("source_risks",), _risks),
        "vocabulary": (("standardized_deliveries", "risks"), _vocabulary),
        "coverage": (("source_organs", "deliveries", "risks"), coverage.coverage),
        "harmonized_deliveries": (("deliveries",), lambda df: _harmonized(df)[0].drop("row")),
        "harmonized_risks": (("risks",), lambda df: _harmonized(df)[0].drop("row")),
        "changes": (("deliveries", "risks"), _changes),
        "variations": (("deliveries", "risks"), variations.catalogue),
        "report": (("source_organs", "deliveries", "risks", "source_errors"), _report),
    }
    return [Table(name, inputs, make, ORDER[name]) for name, (inputs, make) in makes.items()]


def derivation(spark: SparkSession, source: str, out: str) -> Derivation:
    """The derived tables below OUT, over what SOURCE has."""
    fields = {"organs": schema.ORGANS, "deliveries": schema.DELIVERIES, "risks": schema.RISKS, "errors": schema.ERRORS}
    return Derivation(spark, tables(), {f"source_{n}": (lambda n=n, f=f: load(spark, source, n, f)) for n, f in fields.items()}, out, VERSION)


def publish(spark: SparkSession, source: str, out: str) -> list[str]:
    """Makes every derived table that is not current, as sorted Parquet, and returns the names of those."""
    return derivation(spark, source, out).update(verify=True)


def stale(spark: SparkSession, source: str, out: str) -> list[str]:
    """Names of the tables below OUT that are not made from what SOURCE has, are damaged, or are missing."""
    return derivation(spark, source, out).stale()


def export(spark: SparkSession, out: str, to: str) -> dict[str, dict]:
    """The published tables as ordered CSV exports below ``to``: their manifests by name."""
    return {name: csv_export.write(spark.read.parquet(f"{out}/{name}"), f"{to}/{name}", *order) for name, order in PUBLISHED.items()}


def quality_gate(spark: SparkSession, source: str, out: str) -> None:
    """Raises if a floor of totals, or a limit of the validation report, is broken."""
    d, r = (spark.read.parquet(f"{out}/{n}") for n in ("deliveries", "risks"))
    report = metrics.validation_report(load(spark, source, "organs", schema.ORGANS), d, r, load(spark, source, "errors", schema.ERRORS))
    totals = report.select(F.col("organs.n").alias("groups"), F.col("deliveries.n").alias("deliveries"), F.col("risks.n").alias("risks"))
    metrics.gate(metrics.checks(totals, {k: ("min", v) for k, v in vocab.FLOORS.items()}))
    flags = report.select(*[F.col(f"checks.{k}").cast("int").alias(k) for k in ("deliveries", "risks", "probability", "impact", "treatment")])
    metrics.gate(metrics.checks(flags, {k: ("min", 1) for k in flags.columns}))


def manifest(files_map: dict[str, dict], previous: dict, keep: tuple[str, ...] = ("title", "license", "contact"), commit: str = "", date: str = "") -> dict:
    """Files with lines, bytes and hash; fields that people wrote are kept from the previous manifest."""
    return {k: previous[k] for k in keep if k in previous} | {"commit": commit, "date": date, "outputs": dict(sorted(files_map.items()))}


def comparable(value: dict) -> dict:
    """A manifest without what changes on every run."""
    return {k: v for k, v in value.items() if k not in ("commit", "date")}


def main(args: list[str]) -> int:
    flags, names = {a for a in args if a.startswith("--")}, [a for a in args if not a.startswith("--")]
    if len(names) != 3 or names[0] != "derive" or flags - {"--check", "--gate", "--csv"}:
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("tessaria").getOrCreate()
    _, source, out = names
    if "--check" in flags:
        bad = stale(spark, source, out)
        print("\n".join(f"stale: {n}" for n in bad) or "current")
        return int(bool(bad))
    print("\n".join(f"made: {n}" for n in publish(spark, source, out)) or "current")
    if "--csv" in flags:
        export(spark, out, f"{out}/csv")
    if "--gate" in flags:
        try:
            quality_gate(spark, source, out)
        except metrics.GateFailed as e:
            print(f"gate: {e}")
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
