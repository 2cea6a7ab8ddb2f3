"""Tables found in documents: their kind, their columns' roles, rows put together, carried headers.

A table is long: cells (doc, page, table, row, col, text), row -1 being the header.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.functions import text as tx

TABLE = ("doc", "page", "table")

# Keywords by which tables and columns are known.
RISK_WORDS = ["risco", "probabilidade", "impacto", "tratamento", "ocorrer"]
RISK_OTHER_WORDS = ["evento", "classificacao", "severidade", "resposta", "acao", "acoes", "id do risco", "descricao do risco", "opcao de tratamento"]
INFO_WORDS = ["orgao", "ministerio", "secretaria", "sigla", "cnpj", "responsavel", "gestor", "dirigente", "titular", "instituicao", "vinculacao"]
SIGNATURE_WORDS = ["assinatura", "assinado", "data", "nome", "cargo", "cpf"]
HEADER_SCALE_WORDS = ["raro", "pouco provavel", "provavel", "muito provavel", "praticamente certo", "baixo", "medio", "alto", "muito alto", "baixa", "media", "alta"]
SCALE_WORDS = ["raro", "pouco provavel", "provavel", "muito provavel", "praticamente certo", "muito baixo", "baixo", "medio", "alto", "muito alto", "mitigar", "eliminar", "transferir", "aceitar", "baixa", "media", "alta"]
TEMPLATE_ROWS = ["certo]", "certo ]", "ocorrer", "muito alto]", "muito alto ]", "tratamento do risco", "escolher entre"]
TEMPLATE_HEADERS = ["escolher entre", "certo]", "certo ]", "muito alto]", "muito alto ]", "ocorrer"]
RISK_COLUMNS = {
    "risco": ["risco", "evento", "descricao do risco", "descricao"],
    "probabilidade": ["probabilidade", "probabilidade de ocorrer", "prob", "classificacao de probabilidade"],
    "impacto": ["impacto", "severidade", "classificacao de impacto"],
    "tratamento": ["opcao de tratamento", "tratamento", "resposta", "tipo de tratamento", "estrategia"],
    "acoes": ["acoes de tratamento", "descrever acoes", "acoes", "acao", "medidas", "plano de acao"],
}
ID_HEADERS = ["id do risco", "id risco", "id", "n", "no", "num", "numero", "codigo", "cod"]
ACTION_MARKERS = [r"[Rr]eferencial\s+para\s+a[çc][õo]es\s+de\s+tratamento", r"[Aa][çc][õo]es\s+de\s+tratamento\s+do\s+risco\s*:"]


def hits(c: Column, words: list[str]) -> Column:
    """How many of the words a text contains."""
    return F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(c, w)))


def combined(headers: Column, first_row: Column) -> Column:
    """The text by which a table is classified, of arrays of its headers and first row."""
    return F.array_join(F.transform(F.concat(headers, F.coalesce(first_row, F.array().cast("array<string>"))), lambda c: tx.normalize_header(c)), " ")


def risk_document_table(text: Column, ncols: Column) -> Column:
    """risk_table, organ_info, signature or unknown, of ``combined`` text."""
    return tx.let(text, lambda t: _risk_document_table(t, ncols))


def _risk_document_table(text: Column, ncols: Column) -> Column:
    bounds = ncols.between(3, 8)
    risk = hits(text, RISK_WORDS)
    return (
        F.when(text.isNull() | (ncols == 0), "unknown")
        .when((risk >= 2) & bounds, "risk_table")
        .when((risk >= 1) & (hits(text, RISK_OTHER_WORDS) >= 1) & bounds, "risk_table")
        .when(hits(text, INFO_WORDS) >= 2, "organ_info")
        .when((hits(text, SIGNATURE_WORDS) >= 2) & (ncols <= 4), "signature")
        .otherwise("unknown")
    )


def delivery_table(text: Column) -> Column:
    """canceladas, concluidas, pactuadas or unknown, of ``combined`` text."""
    return tx.let(text, _delivery_table)


def _delivery_table(text: Column) -> Column:
    tight = F.replace(text, F.lit(" "), F.lit(""))
    has = lambda *words: F.coalesce(hits(text, list(words)) > 0, F.lit(False))
    return (
        F.when(has("justificativa"), "canceladas")
        .when(F.contains(tight, F.lit("dtentrega")) | has("data entrega", "data de entrega"), "concluidas")
        .when(has("pactuado?", "pactuado ?"), "concluidas")
        .when(F.contains(tight, F.lit("dtpactuada")) | has("data pactuada"), "pactuadas")
        .otherwise("unknown")
    )


def headers_are_data(headers: Column) -> Column:
    """Whether the first risk was taken for the header."""
    h0, h1 = tx.normalize_header(F.get(headers, F.lit(0))), tx.normalize_header(F.get(headers, F.lit(1)))
    named = h0.startswith("risco") | h0.startswith("col") | (h0 == "nan")
    return (F.size(headers) >= 4) & (F.length(h0) >= 10) & ~named & (hits(h1, HEADER_SCALE_WORDS) > 0)


def is_risk_data(all_text: Column, ncols: Column) -> Column:
    """Whether a table's cells hold values of a scale."""
    return (ncols >= 4) & (hits(tx.strip_accents(F.lower(tx.blank_as_empty(all_text))), SCALE_WORDS) >= 2)


def is_template_row(row_text: Column) -> Column:
    return hits(tx.strip_accents(F.lower(tx.blank_as_empty(row_text))), TEMPLATE_ROWS) > 0


def is_orphan(headers: Column, all_text: Column) -> Column:
    """Risk data under headers that say nothing."""
    n = F.size(headers)
    generic = F.filter(F.transform(headers, tx.normalize_header), lambda h: (h.startswith("col") & (F.length(h) <= 5)) | (hits(h, TEMPLATE_HEADERS) > 0))
    return n.between(4, 8) & is_risk_data(all_text, n) & (F.size(generic) >= F.greatest(F.lit(2), F.floor(n / 2)))


def shapes(cells: DataFrame) -> DataFrame:
    """One row for each table: headers, first row, number of columns and rows, all text."""
    at = lambda row: F.transform(F.array_sort(F.collect_list(F.when(F.col("row") == row, F.struct("col", F.coalesce("text", F.lit("")).alias("text"))))), lambda x: x["text"])
    body = F.when(F.col("row") >= 0, F.struct("row", "col", F.coalesce("text", F.lit("")).alias("text")))
    return cells.groupBy(*TABLE).agg(
        at(-1).alias("headers"), at(0).alias("first_row"),
        F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda x: x["text"]), " ").alias("all_text"),
        (F.max("row") + 1).alias("nrows"),
    ).withColumn("ncols", F.size("headers"))


def column_role(header: Column) -> Column:
    """The role of a delivery table's column, exact names before parts of names; null if it has none."""

    def role(h: Column) -> Column:
        s, tight = F.trim(h), F.replace(h, F.lit(" "), F.lit(""))
        has = lambda *words: hits(h, list(words)) > 0
        return (
            F.when(s.isin("status", "situacao"), "status")
            .when(s.isin("pactuado", "pactuado?", "entregue", "entregue?"), "pactuado")
            .when((s == "justificativa") | (has("motivo") & has("cancel")), "justificativa")
            .when(has("servico", "acao"), "servico")
            .when(s.isin("produto", "produto ptd", "entrega"), "produto")
            .when(has("eixo"), "eixo")
            .when(F.contains(tight, F.lit("dtpactuada")) | has("data pactuada", "prazo"), "data_pactuada")
            .when(F.contains(tight, F.lit("dtentrega")) | has("data entrega", "data conclusao"), "data_entrega")
        )

    return tx.let(tx.normalize_header(header), role)


def table_type(status: Column, roles: Column) -> Column:
    """concluida, cancelada or pactuada: a row's status first, then the columns that the table has."""
    has = lambda r: F.array_contains(roles, r)
    return tx.let(
        tx.stripped(F.lower(tx.normalize_text(status))),
        lambda s: F.when(F.contains(s, F.lit("conclu")) | s.isin("sim", "entregue", "finalizada"), "concluida")
        .when(F.contains(s, F.lit("cancel")) | s.isin("nao", "não"), "cancelada")
        .when(F.contains(s, F.lit("pactuada")) | (s == "em andamento"), "pactuada")
        .when(has("data_entrega") | has("pactuado"), "concluida")
        .when(has("justificativa"), "cancelada")
        .otherwise("pactuada"),
    )


@F.pandas_udf(T.DoubleType())
def _header_ratio(headers: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, h, w).ratio() for h, w in zip(headers, words, strict=True)], dtype="float64")


def map_risk_columns(headers: DataFrame) -> DataFrame:
    """(doc, page, table, field, col) for each field of a risk table that has a column.

    ``headers`` has (doc, page, table, col, text). From left to right the first header that has a
    keyword (its share of the header, 0.85 at least) or is similar to one (0.65 or more) takes the
    field; a later one only by a keyword that scores more. What is left takes its place in the usual
    order, one later if the first of six columns or more is a number.
    """
    spark = headers.sparkSession
    words = spark.createDataFrame([(f, i, w, j) for i, (f, ws) in enumerate(RISK_COLUMNS.items()) for j, w in enumerate(ws)], "field string, f_at int, word string, w_at int")
    h = headers.withColumn("norm", tx.normalize_header(F.col("text")))
    h = h.withColumn("is_id", F.col("norm").isin(ID_HEADERS) | F.col("norm").startswith("id "))
    # distinct headers meet the keywords, of which there are two dozen
    distinct = h.select("norm", "is_id").distinct().join(F.broadcast(words)).filter(~((F.col("field") == "risco") & F.col("is_id")))
    hit = F.when(F.contains(F.col("norm"), F.col("word")), F.greatest(F.length("word") / F.greatest(F.length("norm"), F.lit(1)), F.lit(0.85)))
    scored = distinct.withColumn("hit", hit).withColumn("near", _header_ratio(F.col("norm"), F.col("word"))).groupBy("norm", "is_id", "field", "f_at").agg(F.max("hit").alias("hit"), F.max(F.when(F.col("near") >= 0.65, F.col("near"))).alias("near"))
    each = h.select(*TABLE, "col", "norm", "is_id").join(scored, ["norm", "is_id"])
    seen = each.groupBy(*TABLE, "field").agg(F.array_sort(F.collect_list(F.struct("col", "hit", "near"))).alias("seen"))

    def step(best: Column, x: Column) -> Column:
        score = F.when(best.col.isNull(), F.coalesce(x.hit, x.near)).otherwise(x.hit)
        return F.when(F.coalesce(score > best.score, F.lit(False)), F.struct(x.col.alias("col"), score.alias("score"))).otherwise(best)

    start = F.struct(F.lit(None).cast("int").alias("col"), F.lit(0.0).alias("score"))
    named = seen.withColumn("seen", F.transform("seen", lambda x: F.struct(x.col.cast("int").alias("col"), x.hit.alias("hit"), x.near.alias("near"))))
    named = named.select(*TABLE, "field", F.aggregate("seen", start, step)["col"].alias("col")).filter(F.col("col").isNotNull())
    per_table = h.groupBy(*TABLE).agg(F.count("*").alias("n"), F.max(F.when(F.col("col") == 0, F.col("is_id") | (F.col("norm") == "col0"))).alias("numbered"), F.collect_set(F.when(F.col("is_id"), F.col("col"))).alias("ids"))
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(i).alias("at")) for i, f in enumerate(RISK_COLUMNS)])
    usual = per_table.withColumn("x", F.explode(fields)).select(*TABLE, "ids", "n", F.col("x.field").alias("field"), (F.col("x.at") + F.when((F.col("n") >= 6) & F.col("numbered"), 1).otherwise(0)).alias("col"))
    taken = named.groupBy(*TABLE).agg(F.collect_set("field").alias("fields"), F.collect_set("col").alias("cols"))
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    free = usual.join(taken, list(TABLE), "left").filter(
        ~F.array_contains(F.coalesce("fields", empty("string")), F.col("field")) & ~F.array_contains(F.coalesce("cols", empty("int")), F.col("col")) & ~F.array_contains("ids", F.col("col")) & (F.col("col") < F.col("n"))
    )
    return named.unionByName(free.select(*TABLE, "field", "col"))


def _filled(c: Column) -> Column:
    s = tx.stripped(tx.blank_as_empty(c))
    return (s != "") & ~F.lower(s).isin("nan", "none")


def consolidate_rows(rows: DataFrame) -> DataFrame:
    """Tables whose rows a document broke, put together: from each numbered row to the next.

    ``rows`` has (doc, page, table, row, cells: array). It applies from three numbered rows on, if
    they are under 40 % of all. Rows before the first number go, but for the one just before it,
    if its second cell has text. Parts are joined by a bar if one is a bullet or, of several, has
    a semicolon, else by a space.
    """
    t = W.partitionBy(*TABLE)
    by = t.orderBy("row")
    is_id = _filled(F.get("cells", F.lit(0)))
    marked = rows.withColumn("is_id", is_id).withColumns({
        "n": F.count("*").over(t), "ids": F.count_if("is_id").over(t), "width": F.size("cells"),
        "block": F.count_if("is_id").over(by.rowsBetween(W.unboundedPreceding, W.currentRow)), "next_id": F.lead("is_id").over(by),
    })
    applies = (F.col("width") >= 4) & (F.col("ids") >= 3) & (F.col("ids") < 0.4 * F.col("n"))
    lead_in = (F.col("block") == 0) & F.col("next_id") & _filled(F.get("cells", F.lit(1)))
    kept = marked.withColumn("applies", applies).filter(~F.col("applies") | (F.col("block") > 0) | lead_in)
    kept = kept.withColumn("block", F.when(F.col("applies"), F.greatest("block", F.lit(1))).otherwise(F.col("row")))
    gathered = kept.groupBy(*TABLE, "block", "applies").agg(F.array_sort(F.collect_list(F.struct("row", "cells"))).alias("r"), F.max("width").alias("width"))

    def merged(col: Column) -> Column:
        parts = F.filter(F.transform("r", lambda x: tx.stripped(tx.blank_as_empty(F.get(x.cells, col)))), _filled)
        bullets = F.exists(parts, lambda p: F.regexp_like(p, F.lit(r"^[-•*]")))
        several = F.exists(parts, lambda p: F.contains(p, F.lit(";"))) & (F.size(parts) > 1)
        return F.when(bullets | several, F.array_join(parts, " | ")).otherwise(F.array_join(parts, " "))

    joined = F.transform(F.sequence(F.lit(0), F.col("width") - 1), merged)
    return gathered.select(*TABLE, F.col("block").alias("row"), F.when(F.col("applies"), joined).otherwise(F.get("r", F.lit(0)).cells).alias("cells"))


def action_list(text: Column) -> Column:
    """map<number, text> of the numbered actions after a marker; the list ends at a line without a number once it has over three."""

    def after(marker: str) -> Column:
        rest = F.regexp_extract(text, rf"(?s)^.*?{marker}(.*)$", 1)
        lines = F.transform(F.split(rest, "\n"), tx.stripped)
        form = r"^(\d{1,2})\s*[.\-)]\s*(.+)"
        start = F.struct(F.array().cast("array<struct<k:string,v:string>>").alias("out"), F.lit(False).alias("over"))

        def step(acc: Column, line: Column) -> Column:
            number = F.regexp_extract(line, form, 1)
            entry = F.struct(number.alias("k"), tx.stripped(F.regexp_extract(line, form, 2)).alias("v"))
            ends = (number == "") & ~F.regexp_like(line, F.lit("^[0-9]")) & (F.size(acc.out) > 3)
            others = F.filter(acc.out, lambda x: x.k != number)
            return F.struct(F.when(acc["over"] | (number == ""), acc.out).otherwise(F.concat(others, F.array(entry))).alias("out"), (acc["over"] | ends).alias("over"))

        return F.aggregate(lines, start, step, lambda acc: acc.out)

    first, second = map(after, ACTION_MARKERS)
    return F.map_from_entries(F.when(F.size(first) > 0, first).otherwise(second))


def resolve_actions(text: Column, actions: Column) -> Column:
    """References such as "1, 2, 9" as "n. text", joined by bars, if half of the tokens or more are numbers."""
    tokens = F.split(tx.stripped(tx.blank_as_empty(text)), r"[,;\s]+")
    share = F.size(F.filter(tokens, lambda t: F.regexp_like(t, F.lit(r"^\d+$")))) / F.greatest(F.size(tokens), F.lit(1))
    refs = F.filter(F.regexp_extract_all(tx.blank_as_empty(text), F.lit(r"\d+"), F.lit(0)), lambda r: F.element_at(actions, r).isNotNull())
    found = F.array_join(F.transform(refs, lambda r: F.concat(r, F.lit(". "), F.element_at(actions, r))), " | ")
    return F.when(F.coalesce(F.size(actions), F.lit(0)) <= 0, text).when((share >= 0.5) & (F.size(refs) > 0), found).otherwise(text)


def carry_headers(tables: DataFrame, kind: Column, doc: str = "doc") -> DataFrame:
    """``tables`` with state (header, data_as_header, continuation, orphan, skip), carried (the headers that hold for it) and numbered.

    In page order the width of the last risk table, be it one with a header, with data for a header
    or an orphan, makes later tables of that width continuations; ``carried`` are the last headers
    of a table that has its own. ``numbered`` tells that columns come in the usual order after a
    number: the first of these tables had six columns or more and no header, and no header came since.
    """
    order = W.partitionBy(doc).orderBy("page", "table")
    before, so_far = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = tables.withColumn("kind", kind).withColumns({"as_data": headers_are_data(F.col("headers")), "lost": is_orphan(F.col("headers"), F.col("all_text"))})
    head = F.col("kind") == "risk_table"
    # an orphan that turns out to be a continuation has the width that holds already
    marked = marked.withColumns({
        "width": F.last(F.when(head | F.col("as_data") | F.col("lost"), F.col("ncols")), ignorenulls=True).over(before),
        "last": F.last(F.when(head, F.struct("headers")), ignorenulls=True).over(before),
        "first": F.first(F.when(head | F.col("as_data") | F.col("lost"), F.col("ncols")), ignorenulls=True).over(so_far), "had": F.max(head).over(so_far),
    })
    state = (
        F.when(head, "header")
        .when(F.col("as_data"), "data_as_header")
        .when((F.col("ncols") == F.col("width")) & is_risk_data(F.col("all_text"), F.col("ncols")), "continuation")
        .when(F.col("lost"), "orphan")
        .otherwise("skip")
    )
    marked = marked.withColumn("state", state)
    carried = F.when(head, F.col("headers")).when(F.col("state").isin("continuation", "data_as_header"), F.col("last.headers"))
    return marked.withColumns({"carried": carried, "numbered": ~F.col("had") & F.coalesce(F.col("first") >= 6, F.lit(False))}).drop("as_data", "lost", "width", "last", "first", "had")


def broken_down(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tables, rows) of cells: one row for each table with rows put together (``shapes``' columns), and its rows (doc, page, table, row, cells)."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda x: x["text"])
    lines = cells.groupBy(*TABLE, "row").agg(texts.alias("cells"))
    heads = lines.filter("row = -1").select(*TABLE, F.transform("cells", tx.blank_as_empty).alias("headers"))
    wide = heads.filter(F.size("headers") >= 4).select(*TABLE)
    rows = consolidate_rows(lines.filter("row >= 0").join(wide, list(TABLE), "left_semi"))
    plain = F.transform("cells", tx.blank_as_empty)
    bodies = rows.groupBy(*TABLE).agg(
        F.min_by(plain, "row").alias("first_row"), F.count("*").alias("nrows"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", F.array_join(plain, " ").alias("t")))), lambda x: x["t"]), " ").alias("all_text"),
    )
    return heads.join(bodies, list(TABLE), "left").withColumn("ncols", F.size("headers")), rows
