"""One field model, compiled to Spark, Table Schema and JSON Schema, and checked as data frame predicates."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.functions import vocab

SPARK = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType()}

# Enumerations of the published schema.
METHODS = ["exact", "alias", "fuzzy_high", "fuzzy_low", "unmatched"]
CONFIDENCE = ["high", "medium", "low"]
TABLE_TYPES = ["pactuada", "concluida", "cancelada"]


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    title: str = ""
    description: str = ""
    required: bool = False
    enum: tuple | None = None
    format: str | None = None
    minimum: float | None = None
    maximum: float | None = None

    def spark(self) -> T.StructField:
        return T.StructField(self.name, SPARK[self.type], not self.required, {"title": self.title, "description": self.description})

    def table_schema(self) -> dict:
        out = {"name": self.name, "type": self.type, "title": self.title, "description": self.description}
        limits = {"required": self.required or None, "enum": list(self.enum) if self.enum else None, "minimum": self.minimum, "maximum": self.maximum}
        limits = {k: v for k, v in limits.items() if v is not None}
        return out | ({"format": self.format} if self.format else {}) | ({"constraints": limits} if limits else {})

    def json_schema(self) -> dict:
        """Fields that are not required may be null, and so may their enumerations."""
        out = {"type": self.type if self.required else [self.type, "null"], "title": self.title, "description": self.description}
        if self.enum:
            out["enum"] = [*self.enum, *([] if self.required else [None])]
        return out | {k: v for k, v in (("minimum", self.minimum), ("maximum", self.maximum), ("format", self.format)) if v is not None}

    def violation(self) -> Column:
        """The constraint that a row breaks, or null."""
        c = F.col(self.name)
        empty = c.isNull() | (c.cast("string") == "")
        out = F.when(empty, F.when(F.lit(self.required), "required"))
        if self.enum:
            out = out.when(~c.isin(list(self.enum)), "enum")
        if self.minimum is not None:
            out = out.when(c < self.minimum, "minimum")
        if self.maximum is not None:
            out = out.when(c > self.maximum, "maximum")
        return out


def score(name: str) -> Field:
    return Field(name, "number", f"Score: {name.removesuffix('_score')}", "Confidence of the match, from 0 to 1.", minimum=0.0, maximum=1.0)


def method(name: str) -> Field:
    return Field(name, "string", f"Method: {name.removesuffix('_method')}", "Tier of the match.", enum=tuple(METHODS))


def _categorical(name: str, canonical: str) -> list[Field]:
    return [Field(f"{name}_original", title=f"{name}, as read"), Field(canonical, title=f"{name}, canonical"), score(f"{name}_score"), method(f"{name}_method")]


_REVIEW = [Field("extraction_confidence", enum=tuple(CONFIDENCE)), Field("needs_review", "boolean"), Field("review_reason")]
ORGANS = [Field("sigla", required=True), Field("nome_completo"), Field("grupo"), Field("url_diretivo", format="uri"), Field("url_entregas", format="uri"), Field("pdf_path_diretivo"), Field("pdf_path_entregas")]
RISKS = [
    Field("orgao_sigla", required=True), Field("risco_texto"), *_categorical("probabilidade", "probabilidade_normalizada"), *_categorical("impacto", "impacto_normalizado"),
    *_categorical("tratamento", "tratamento_normalizado"), Field("acoes_tratamento"), *_REVIEW,
]
DELIVERIES = [
    Field("orgao_sigla", required=True), Field("tabela_tipo", enum=tuple(TABLE_TYPES)), Field("servico_acao"), *_categorical("produto", "produto_normalizado"),
    *[replace(f, enum=tuple(vocab.AXES)) if f.name == "eixo_normalizado" else f for f in _categorical("eixo", "eixo_normalizado")],
    Field("area_responsavel"), Field("data_pactuada"), Field("data_entrega"), Field("pactuado"), Field("justificativa"), *_REVIEW,
]
ERRORS = [Field(n, required=n == "orgao_sigla") for n in ("orgao_sigla", "document_type", "stage", "error_type", "error_message", "timestamp", "url")]
RESOURCES = {"organs": (ORGANS, "sigla", []), "risks": (RISKS, None, [("orgao_sigla", "organs", "sigla")]), "deliveries": (DELIVERIES, None, [("orgao_sigla", "organs", "sigla")])}


def struct(fields: list[Field]) -> T.StructType:
    return T.StructType([f.spark() for f in fields])


def strict(fields: list[Field], allowed: dict[str, list[str]]) -> list[Field]:
    """The fields with the canonical columns limited to their values: the contract of a harmonised table."""
    return [replace(f, enum=tuple(allowed[f.name])) if f.name in allowed else f for f in fields]


def header_fields(columns: list[str]) -> list[Field]:
    """All texts: the schema of a table that only has a header."""
    return [Field(c, title=c) for c in columns]


def violations(df: DataFrame, fields: list[Field], key: str) -> DataFrame:
    """(key, field, rule) of every broken constraint."""
    each = F.array(*[F.struct(F.lit(f.name).alias("field"), f.violation().alias("rule")) for f in fields if f.name in df.columns])
    return df.select(F.col(key).alias("key"), F.explode(each).alias("x")).select("key", "x.*").filter(F.col("rule").isNotNull())


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct foreign keys without a parent."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct().join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def dictionary(df: DataFrame, fields: list[Field]) -> DataFrame:
    """(position, column, type, title, description, required) of a table's columns."""
    by = {f.name: f for f in fields}
    rows = [(i, c, t, by[c].title if c in by else "", by[c].description if c in by else "", bool(c in by and by[c].required)) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, title string, description string, required boolean")


def column_widths(df: DataFrame, sample: int = 500) -> DataFrame:
    """(column, width): the longest text of the first rows and the header, and two; from 10 to 60."""
    first = df.limit(sample)
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)).alias("n")) for c in df.columns])
    lengths = first.select(F.explode(each).alias("x")).groupBy("x.column").agg(F.max("x.n").alias("n"))
    return lengths.select("column", F.least(F.lit(60), F.greatest(F.lit(10), F.greatest("n", F.length("column")) + 2)).alias("width"))


def data_package(name: str, resources: dict[str, tuple[list[Field], str | None, list]], files: dict[str, dict]) -> dict:
    """A data package: every resource with its schema, keys, size and hash."""
    out = []
    for resource, (fields, primary, foreign) in resources.items():
        schema = {"fields": [f.table_schema() for f in fields]}
        if primary:
            schema["primaryKey"] = primary
        if foreign:
            schema["foreignKeys"] = [{"fields": f, "reference": {"resource": r, "fields": k}} for f, r, k in foreign]
        about = files.get(f"{resource}.csv", {})
        out.append({"name": resource, "path": f"{resource}.csv", "format": "csv", "encoding": "utf-8", "schema": schema} | {k: about[k] for k in ("bytes", "sha256") if k in about})
    return {"profile": "tabular-data-package", "name": name, "resources": out}


def entry_schema(name: str, fields: list[Field]) -> dict:
    """JSON Schema of entries grouped by key, with their metadata."""
    item = {"type": "object", "properties": {f.name: f.json_schema() for f in fields}, "required": [f.name for f in fields if f.required]}
    data = {"type": "object", "additionalProperties": {"type": "array", "items": item}}
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": name, "type": "object", "properties": {"metadata": {"type": "object"}, "data": data}, "required": ["metadata", "data"]}


def dataset(name: str, description: str, url: str, license_url: str, authors: list[dict], files: dict[str, dict]) -> dict:
    """schema.org's view of the data."""
    parts = [{"@type": "DataDownload", "name": n, "contentUrl": f"{url}/{n}", "contentSize": str(f["bytes"]), "sha256": f["sha256"]} for n, f in sorted(files.items())]
    return {"@context": "https://schema.org/", "@type": "Dataset", "name": name, "description": description, "url": url, "license": license_url, "creator": authors, "distribution": parts}


def catalog(name: str, description: str, url: str, license_url: str, files: dict[str, dict]) -> dict:
    """DCAT's view of the data."""
    parts = [{"@type": "dcat:Distribution", "dct:title": n, "dcat:downloadURL": f"{url}/{n}", "dcat:byteSize": f["bytes"]} for n, f in sorted(files.items())]
    context = {"dcat": "http://www.w3.org/ns/dcat#", "dct": "http://purl.org/dc/terms/"}
    return {"@context": context, "@type": "dcat:Dataset", "dct:title": name, "dct:description": description, "dct:license": license_url, "dcat:distribution": parts}


def provenance(name: str, stages: list[tuple[str, list[str], list[str]]]) -> dict:
    """PROV-O: (activity, inputs, outputs) of each stage."""
    graph = []
    for activity, used, made in stages:
        graph.append({"@id": f"#{activity}", "@type": "prov:Activity", "prov:used": [f"#{u}" for u in used]})
        graph += [{"@id": f"#{m}", "@type": "prov:Entity", "prov:wasGeneratedBy": f"#{activity}"} for m in made]
    return {"@context": {"prov": "http://www.w3.org/ns/prov#"}, "@id": f"#{name}", "@graph": graph}


def portal_payload(name: str, title: str, notes: str, files: dict[str, dict], url: str) -> dict:
    """A CKAN package; it is made, never sent."""
    return {"name": name, "title": title, "notes": notes, "resources": [{"name": n, "url": f"{url}/{n}", "format": n.rpartition(".")[2].upper(), "size": f["bytes"], "hash": f["sha256"]} for n, f in sorted(files.items())]}


def inject(html: str, name: str, content: str) -> str:
    """``html`` with the content between its marks of that name, put before the head's end if there are none; again changes nothing."""
    begin, end = f"<!-- {name}:begin -->", f"<!-- {name}:end -->"
    block = f"{begin}\n{content}\n{end}"
    if begin in html and end in html:
        return html[: html.index(begin)] + block + html[html.index(end) + len(end) :]
    return html.replace("</head>", f"{block}\n</head>", 1)


def citation_authors(lines: list[str]) -> list[dict]:
    """Authors of a citation file's lines, without a YAML library: given and family names."""
    out, inside = [], False
    for line in lines:
        if line and not line.startswith((" ", "-")):
            inside = line.startswith("authors:")
        elif inside:
            key, _, value = line.strip().removeprefix("- ").partition(":")
            if line.strip().startswith("- "):
                out.append({})
            if out and value:
                out[-1][key.strip()] = value.strip().strip("\"'")
    return [{"@type": "Person", "name": f"{a.get('given-names', '')} {a.get('family-names', '')}".strip()} for a in out]


def concepts(mapping: DataFrame, ordered: dict[str, list[str]], canonical: dict[str, list[str]]) -> DataFrame:
    """(type, prefLabel, altLabels, notation): every canonical value with its variants; ordinals for ordered vocabularies.

    ``mapping`` has (type, normalized, variants). Canonical values that nothing met are added; values
    of an ordered vocabulary that are not on it are left out.
    """
    spark = mapping.sparkSession
    own = spark.createDataFrame([(t, v, i + 1, t in ordered) for t, vs in canonical.items() for i, v in enumerate(vs)], "c_type string, c_value string, c_at int, c_ordered boolean")
    met = mapping.select("type", "normalized", "variants")
    joined = met.join(F.broadcast(own), (F.col("type") == F.col("c_type")) & (F.col("normalized") == F.col("c_value")), "full_outer")
    rows = joined.select(
        F.coalesce("type", "c_type").alias("type"), F.coalesce("normalized", "c_value").alias("prefLabel"),
        F.array_sort(F.array_distinct(F.coalesce("variants", F.array().cast("array<string>")))).alias("altLabels"), F.when(F.col("c_ordered"), F.col("c_at")).alias("notation"),
    )
    return rows.filter(~F.col("type").isin(list(ordered)) | F.col("notation").isNotNull()) if ordered else rows


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
