"""Entries from table rows and text lines: risks, deliveries, and the better of two readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessaria.functions import text as tx
from tessaria.functions import vocab
from tessaria.operators import audit, match, tables
from tessaria.sources import files

#: Names of the service column, as pages that repeat their header have them (fixed values).
SERVICE_HEADERS = ["servico/acao", "servico", "serviço /ação"]
MONTH = rf"^(?:{'|'.join(tx.MONTHS)})"
DELIVERY_ROLES = ("servico", "produto", "eixo", "data_pactuada", "data_entrega", "pactuado", "justificativa", "status")


def _cell(row: Column, col: Column) -> Column:
    return tx.let(tx.normalize_text(F.get(row, col)), lambda v: F.when(F.lower(v).isin("nan", "none"), "").otherwise(v))


def risk_rows(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """(doc, page, table, row, state, risco, probabilidade, impacto, tratamento, acoes) of all risk tables.

    ``rows`` has (doc, page, table, row, cells), ``shapes`` a row for each table. A table with a
    header of its own is read by it. Others are read by the usual order, one later where a number
    comes first (``carry_headers``), and one later again if they are wider than that order and the
    first three rows begin with a number or nothing. Data taken for a header are a row of their own, -1.
    """
    kind = tables.risk_document_table(tables.combined(F.col("headers"), F.col("first_row")), F.col("ncols"))
    state = tables.carry_headers(shapes.filter("ncols >= 4"), kind).filter("state != 'skip'")
    heads = state.filter("state = 'header'").select(*tables.TABLE, F.posexplode("headers").alias("col", "text"))
    named = tables.map_risk_columns(heads).groupBy(*tables.TABLE).agg(F.map_from_entries(F.collect_list(F.struct("field", "col"))).alias("map"))
    template = tables.is_template_row(F.array_join("cells", " "))
    body = rows.select(*tables.TABLE, F.col("row").cast("long").alias("row"), "cells", template.alias("template"))
    starts = body.groupBy(*tables.TABLE).agg(F.array_sort(F.collect_list(F.struct("row", "template", tx.stripped(F.coalesce(F.get("cells", F.lit(0)), F.lit("None"))).alias("v")))).alias("starts"))
    state = state.join(starts, list(tables.TABLE), "left")
    # a template row at the top does not count, unless the header is data
    drop = F.when((F.col("state") != "data_as_header") & F.coalesce(F.get("starts", F.lit(0))["template"], F.lit(False)), 1).otherwise(0)
    firsts = F.filter(F.slice("starts", drop + 1, F.lit(3)), lambda x: x.v != "")
    number = F.forall(firsts, lambda x: (F.length(x.v) <= 3) & ~F.lower(x.v).isin("nan", "none"))
    some = F.coalesce(F.size("starts") > drop, F.lit(False)) & F.col("starts").isNotNull()
    usual = F.when(F.col("numbered"), 6).otherwise(5)
    offset = F.when(F.col("numbered"), 1).otherwise(0) + F.when((F.col("ncols") > usual) & some & F.coalesce(number, F.lit(False)), 1).otherwise(0)
    state = state.select(*tables.TABLE, "state", "headers", offset.alias("offset"))
    recovered = state.filter("state = 'data_as_header'").select(*tables.TABLE, F.lit(-1).cast("long").alias("row"), F.col("headers").alias("cells"), tables.is_template_row(F.array_join("headers", " ")).alias("template"))
    placed = body.unionByName(recovered).join(state.drop("headers"), list(tables.TABLE)).join(named, list(tables.TABLE), "left").filter(~F.col("template"))
    offset = F.when(F.col("row") == -1, 0).otherwise(F.col("offset"))
    by_name = lambda f: F.coalesce(F.element_at("map", f), F.lit(0)) if f == "risco" else F.element_at("map", f)
    fields = {f: _cell(F.col("cells"), F.when(F.col("state") == "header", by_name(f)).otherwise(F.lit(i) + offset)) for i, f in enumerate(tables.RISK_COLUMNS)}
    out = placed.select(*tables.TABLE, "row", "state", *[F.coalesce(c, F.lit("")).alias(f) for f, c in fields.items()])
    literal = F.lit(False)
    for f in ("risco", "probabilidade", "impacto", "tratamento"):
        literal = literal | tx.is_literal(F.col(f), tx.RISK_HEADERS)
    some = (F.col("risco") != "") | (F.col("probabilidade") != "") | (F.col("impacto") != "")
    return out.filter(F.when(F.col("row") == -1, F.col("risco") != "").otherwise(some & ~literal))


def risk_document_entries(cells: DataFrame, texts: DataFrame) -> DataFrame:
    """Risk entries of documents' tables, end to end: rows put together, tables told apart, entries read and matched.

    ``cells`` has (doc, page, table, row, col, text), row -1 being the header; ``texts`` (doc, text)
    the whole text of each, whose list of actions its entries refer to.
    """
    shapes, rows = tables.broken_down(cells)
    actions = texts.select("doc", tables.action_list(F.col("text")).alias("actions"))
    # every field is matched on its own, so the rows are written once and not computed for each
    return risk_entries(files.cut(risk_rows(rows, shapes)), actions)


def documents_without_entries(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """(doc, document_type, stage, error_type) of the documents in which no risk table was found."""
    return docs.select("doc").join(entries.select("doc").distinct(), "doc", "left_anti").select("doc", F.lit("diretivo").alias("document_type"), F.lit("extraction").alias("stage"), F.lit("no_risk_table").alias("error_type"))


def _scored(df: DataFrame, base: DataFrame, col: str, scales: dict[str, tuple[list[str], dict[str, str]]]) -> DataFrame:
    """``df`` with {col}_on_{scale} (struct canonical, score), aliases included; ``base`` has the values, each matched once."""
    for name, (scale, alias_map) in scales.items():
        m = match.match_values(base, col, scale, alias_map).select(F.col("value").alias("m_value"), F.struct("canonical", "score").alias(f"{col}_on_{name}"))
        df = df.join(m, F.col(col).eqNullSafe(F.col("m_value"))).drop("m_value")
    return df


def risk_entries(rows: DataFrame, actions: DataFrame | None = None) -> DataFrame:
    """Risk entries of ``risk_rows``: swapped columns put right, scales matched, reasons and confidence.

    ``actions`` has (doc, actions: map) for references to a document's list of actions.
    """
    p, i, t = (vocab.PROBABILITY, vocab.PROBABILITY_ALIASES), (vocab.IMPACT, vocab.IMPACT_ALIASES), (vocab.TREATMENT, vocab.TREATMENT_ALIASES)
    r = rows
    for col, scales in (("probabilidade", {"p": p, "i": i}), ("impacto", {"i": i, "p": p}), ("tratamento", {"t": t})):
        r = _scored(r, rows, col, scales)
    swap = audit.swapped(F.col("probabilidade"), F.col("impacto"), F.col("probabilidade_on_p.score"), F.col("impacto_on_i.score"), F.col("probabilidade_on_i.score"), F.col("impacto_on_p.score"))
    header = F.col("state").eqNullSafe("data_as_header") & (F.col("row") == -1) if "state" in rows.columns else F.lit(False)
    r = r.withColumn("swap", swap & ~header)
    r = r.withColumns({
        "po": F.when(F.col("swap"), F.col("impacto")).otherwise(F.col("probabilidade")), "io": F.when(F.col("swap"), F.col("probabilidade")).otherwise(F.col("impacto")),
        "pm": F.when(F.col("swap"), F.col("impacto_on_p")).otherwise(F.col("probabilidade_on_p")), "im": F.when(F.col("swap"), F.col("probabilidade_on_i")).otherwise(F.col("impacto_on_i")),
    })
    long = lambda label, v, s: F.when(audit.is_long_bleed(v, s), F.concat(F.lit(f"{label}: bleed de coluna ("), F.length(v).cast("string"), F.lit(" chars)")))
    weak = lambda label, v, s: F.when((v != "") & (s < vocab.REVIEW), F.concat(F.lit(f"{label}: '"), F.substring(v, 1, 40), F.lit("'")))
    reasons = F.array_compact(F.array(
        F.when(F.col("swap"), "swap automático prob↔impacto (column-shift corrigido)"),
        weak("probabilidade", F.col("po"), F.col("pm.score")), weak("impacto", F.col("io"), F.col("im.score")),
        F.when(F.col("risco") == "", "risco vazio"),
        long("impacto", F.col("io"), F.col("im.score")), long("tratamento", F.col("tratamento"), F.col("tratamento_on_t.score")),
    ))
    r = r.withColumn("reasons", F.when(header, F.array(F.lit("recuperado de header de coluna"))).otherwise(reasons))
    set_if = lambda m: F.when(F.col(f"{m}.score") >= vocab.REVIEW, F.col(f"{m}.canonical")).otherwise("")
    if actions is not None:
        r = r.join(actions, "doc", "left").withColumn("acoes", tables.resolve_actions(F.col("acoes"), F.col("actions"))).drop("actions")
    return r.select(
        "doc", *[c for c in ("page", "table", "row") if c in rows.columns], F.col("risco").alias("risco_texto"),
        F.col("po").alias("probabilidade_original"), set_if("pm").alias("probabilidade_normalizada"),
        F.col("io").alias("impacto_original"), set_if("im").alias("impacto_normalizado"),
        F.col("tratamento").alias("tratamento_original"), set_if("tratamento_on_t").alias("tratamento_normalizado"),
        F.col("acoes").alias("acoes_tratamento"),
        F.when(header, "medium").when(F.size("reasons") == 0, "high").when(F.size("reasons") == 1, "medium").otherwise("low").alias("extraction_confidence"),
        (F.size("reasons") > 0).alias("needs_review"), F.when(F.size("reasons") > 0, F.array_join("reasons", "; ")).alias("review_reason"),
    )


def _with_matches(df: DataFrame, products: str, axes: str) -> DataFrame:
    """``df`` with pm and em: the product match of one column and the axis match of another."""
    out = df
    for col, name, known, alias_map, scores in ((products, "pm", vocab.ALL_PRODUCTS, vocab.PRODUCT_ALIASES, (1.0, 0.98)), (axes, "em", vocab.AXES, vocab.AXIS_ALIASES, (0.95, 0.93))):
        m = match.match_values(df, col, known, alias_map, scores, by_key=False).select(F.col("value").alias("m_value"), F.struct("canonical", "score").alias(name))
        out = out.join(m, F.col(col).eqNullSafe(F.col("m_value"))).drop("m_value")
    return out


def _delivery_marks(other: Column, with_score: bool) -> list[Column]:
    s = F.col("pm.score")
    reason = F.when(other, "produto Outros")
    return [
        F.when(s >= 0.95, "high").when(s >= vocab.ACCEPT, "medium").otherwise("low").alias("extraction_confidence"),
        ((s < 0.95) | other).alias("needs_review"),
        (reason.when(s < 0.95, F.concat(F.lit("fuzzy="), F.format_number(s, 2))) if with_score else reason).alias("review_reason"),
    ]


def delivery_entries(rows: DataFrame) -> DataFrame:
    """Delivery entries of table rows (doc, seq, roles: array, servico, produto, eixo, data_pactuada, data_entrega, pactuado, justificativa, status).

    A row needs a product from 0.85 on, or the catch-all; the axis is the product's own, else one
    matched from 0.80 on. A row that is ``recovered`` (optional), a header in place of data, is to be reviewed.
    """
    r = rows.withColumns({c: _cell(F.array(F.col(c)), F.lit(0)) for c in DELIVERY_ROLES})
    r = r.filter((F.col("produto") != "") & ~tx.is_literal(F.col("produto"), tx.DELIVERY_HEADERS))
    r = _with_matches(r, "produto", "eixo")
    other = tx.is_other(F.col("produto"))
    fits = F.col("pm.score") >= vocab.ACCEPT
    r = r.filter(fits | other)
    name = F.when(fits, F.col("pm.canonical")).otherwise("Outros")
    own = F.element_at(F.create_map(*[F.lit(x) for kv in vocab.PRODUCT_AXIS.items() for x in kv]), name)
    date = lambda c: tx.parse_date(F.when(~F.lower(c).isin("dtpactuada", "dtentrega"), F.col(c)))
    text = lambda c, n=500: F.when(F.col(c) != "", F.substring(c, 1, n))
    recovered = F.col("recovered") if "recovered" in rows.columns else F.lit(False)
    confidence, review, reason = _delivery_marks(other, True)
    return r.select(
        "doc", "seq", tables.table_type(F.col("status"), F.col("roles")).alias("tabela_tipo"),
        F.when(F.lower("servico").isin(SERVICE_HEADERS), "").otherwise(F.substring("servico", 1, 250)).alias("servico_acao"),
        F.substring("produto", 1, 250).alias("produto_original"), name.alias("produto_normalizado"),
        F.when(F.lower("eixo") == "eixo", "").when(recovered, F.substring("eixo", 1, 100)).otherwise(F.col("eixo")).alias("eixo_original"),
        F.coalesce(own, F.when(F.col("em.score") >= 0.80, F.col("em.canonical")), F.lit("")).alias("eixo_normalizado"),
        date("data_pactuada").alias("data_pactuada"), date("data_entrega").alias("data_entrega"), text("pactuado").alias("pactuado"), text("justificativa").alias("justificativa"),
        F.when(recovered, "medium").otherwise(confidence).alias("extraction_confidence"), (review | recovered).alias("needs_review"),
        F.when(recovered, "recuperado de header multi-página").otherwise(reason).alias("review_reason"),
    )


def _products(cells: DataFrame) -> DataFrame:
    """The cells that are a product or the catch-all; each text is matched once."""
    texts = cells.select("text").distinct()
    known = match.match_values(texts, "text", vocab.ALL_PRODUCTS, vocab.PRODUCT_ALIASES, (1.0, 0.98), by_key=False)
    known = known.filter((F.col("score") >= vocab.ACCEPT) | tx.is_other(F.col("value"))).select(F.col("value").alias("p_value"))
    return cells.join(known, F.col("text") == F.col("p_value"), "left_semi")


def delivery_rows(cells: DataFrame) -> DataFrame:
    """Rows of all delivery tables, as ``delivery_entries`` takes them, with page, table, row and recovered.

    ``cells`` has (doc, page, table, row, col, text), row -1 being the header; tables of under three
    columns or without rows are left out. In page order a header with a product, or with a service
    and one more role, sets the columns for its own and later tables. Until there is one, the first
    table whose first row names roles sets them (that row is no data), or else whose cells hold a
    product: the service stands before it, the axis after. Later tables are read by the names of
    these columns, or by the usual places (service, product, axis, then the date in the fifth column,
    or in the fourth of four) if the product's name is not among theirs. Where such a table has as
    many columns as there are roles and a product second in its header, that header is an entry (row -1).
    """
    text = F.coalesce("text", F.lit(""))
    lines = cells.groupBy(*tables.TABLE, F.col("row").cast("long").alias("row")).agg(F.transform(F.array_sort(F.collect_list(F.struct("col", text.alias("text")))), lambda x: x["text"]).alias("cells"))
    names = F.transform("cells", lambda c, i: F.when(tx.stripped(c) == "", F.concat(F.lit("Col"), i.cast("string"))).otherwise(c))
    heads = lines.filter("row = -1").select(*tables.TABLE, names.alias("headers"))
    body = lines.filter("row >= 0")
    firsts = body.groupBy(*tables.TABLE).agg(F.min_by("cells", "row").alias("first_row"), F.min("row").alias("first_at"))
    hits = _products(cells.select(*tables.TABLE, F.col("row").cast("long").alias("row"), F.col("col").cast("int").alias("col"), "text"))
    hits = hits.groupBy(*tables.TABLE, "row").agg(F.min(F.struct("col", "text")).alias("hit"), F.max(F.col("col") == 1).alias("second"))
    found = hits.groupBy(*tables.TABLE).agg(F.min(F.when(F.col("row") >= 0, F.struct("row", "hit"))).alias("found"), F.max(F.when(F.col("row") == -1, F.col("second"))).alias("in_header"))
    t = heads.join(firsts, list(tables.TABLE)).join(found, list(tables.TABLE), "left").withColumn("ncols", F.size("headers")).filter("ncols >= 3")

    def roles(texts: str) -> Column:
        each = F.filter(F.transform(texts, lambda c, i: F.struct(tables.column_role(c).alias("role"), i.alias("col"), F.get(F.col("headers"), i).alias("name"))), lambda x: x.role.isNotNull())
        start = F.array().cast("array<struct<role:string,col:int,name:string>>")
        return F.aggregate(each, start, lambda acc, x: F.when(F.exists(acc, lambda y: y.role == x.role), acc).otherwise(F.concat(acc, F.array(x))))

    at = F.col("found.hit.col")
    near = F.filter(
        F.array(*[F.struct(F.lit(r).alias("role"), (at + d).alias("col"), F.get(F.col("headers"), F.greatest(at + d, F.lit(0))).alias("name")) for r, d in (("produto", 0), ("servico", -1), ("eixo", 1))]),
        lambda x: (x.col >= 0) & (x.col < F.col("ncols")),
    )
    t = t.withColumns({"by_head": roles("headers"), "by_row": roles("first_row")})
    has = lambda name: F.exists("by_head", lambda x: x.role == name)
    t = t.withColumn("by_head", F.when(has("produto") | (has("servico") & (F.size("by_head") >= 2)), F.col("by_head")))
    t = t.withColumn("guess", F.when(F.size("by_row") > 0, F.struct(F.col("by_row").alias("map"), F.lit(True).alias("from_row"))).when(F.col("found").isNotNull(), F.struct(near.alias("map"), F.lit(False).alias("from_row"))))
    order = W.partitionBy("doc").orderBy("page", "table")
    so_far, before = order.rowsBetween(W.unboundedPreceding, W.currentRow), order.rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumns({f"{k}_{n}": f(c, ignorenulls=True).over(w) for n, w in (("now", so_far), ("before", before)) for k, f, c in (("head", F.last, "by_head"), ("guess", F.first, "guess.map"))})
    known = F.coalesce("head_before", "guess_before")
    t = t.withColumns({"map": F.coalesce("head_now", "guess_now"), "own": F.col("by_head").isNotNull() | known.isNull(), "carried": known})
    t = t.filter(F.col("map").isNotNull())
    first_text = tx.normalize_text(F.get("headers", F.lit(0)))
    t = t.withColumn("recovers", ~F.col("own") & (F.size("carried") == F.col("ncols")) & F.coalesce("in_header", F.lit(False)) & ~F.lower(first_text).isin("nan", "none", ""))
    t = t.withColumn("skips", F.when(F.col("own") & F.col("by_head").isNull() & F.col("guess.from_row"), F.col("first_at")))
    product = F.get(F.filter("map", lambda x: x.role == "produto"), F.lit(0))
    t = t.withColumn("placed", ~F.col("own") & product["name"].isNotNull() & ~F.array_contains("headers", product["name"]))

    def place(role: str) -> Column:
        own = F.get(F.filter("map", lambda x: x.role == role), F.lit(0))
        named = F.when(F.col("own"), own["col"]).otherwise(F.nullif(F.array_position("headers", own["name"]).cast("int"), F.lit(0)) - 1)
        usual = {"servico": F.lit(0), "produto": F.lit(1), "eixo": F.lit(2), "data_pactuada": F.when(F.col("ncols") >= 5, 4).when(F.col("ncols") == 4, 3)}
        return F.coalesce(F.when(F.col("placed"), usual[role]), named) if role in usual else named

    state = t.select(*tables.TABLE, "headers", "ncols", "skips", "recovers", F.transform("map", lambda x: x.role).alias("roles"), *[place(r).alias(f"at_{r}") for r in DELIVERY_ROLES])
    value = lambda r: F.coalesce(F.get("cells", F.col(f"at_{r}")), F.lit(""))
    read = body.join(state.drop("headers"), list(tables.TABLE)).filter(F.col("skips").isNull() | (F.col("row") != F.col("skips"))).join(hits.drop("second"), [*tables.TABLE, "row"], "left")
    named = tx.stripped(F.lower(tx.normalize_text(value("produto"))))
    own_product = F.when(named.isin("", "nan", "none", "produto", "produto ptd"), F.col("hit.text")).otherwise(value("produto"))
    read = read.select(*tables.TABLE, "row", "roles", F.lit(False).alias("recovered"), *[(own_product if r == "produto" else value(r)).alias(r) for r in DELIVERY_ROLES])
    # what a header in place of data holds, by the usual places
    at = {"servico": 0, "produto": 1, "eixo": 2, "data_pactuada": 4}
    head = state.filter("recovers").select(*tables.TABLE, F.lit(-1).cast("long").alias("row"), F.array().cast("array<string>").alias("roles"), F.lit(True).alias("recovered"), *[(F.coalesce(F.get("headers", F.lit(at[r])), F.lit("")) if r in at else F.lit("")).alias(r) for r in DELIVERY_ROLES])
    return read.unionByName(head).withColumn("seq", F.struct("page", "table", "row"))


def delivery_document_entries(cells: DataFrame, lines: DataFrame) -> DataFrame:
    """Delivery entries of documents, end to end, with method (tables or text): of each document the reading with more entries, tables if they are as many.

    ``cells`` has (doc, page, table, row, col, text), row -1 being the header; ``lines`` (doc, page, line, text).
    """
    # rows are written once, not computed again for each field that is matched
    tabular = delivery_entries(files.cut(delivery_rows(cells))).withColumn("method", F.lit("tables"))
    textual = delivery_lines(lines, ["doc", "page"]).withColumn("method", F.lit("text"))
    tabular = tabular.withColumns({"page": F.col("seq.page"), "table": F.col("seq.table"), "row": F.col("seq.row")}).drop("seq")
    return better_reading(tabular.unionByName(textual.withColumnRenamed("line", "row"), allowMissingColumns=True), "doc", "method", {"tables": 1, "text": 0})


def neighbours(lines: DataFrame, by: list[str], ahead: int = 4) -> DataFrame:
    """``lines`` (line, text) with prev, and next_1 to next_{ahead}, within ``by``."""
    w = W.partitionBy(*by).orderBy("line")
    return lines.withColumns({"prev": F.lag("text").over(w), **{f"next_{k}": F.lead("text", k).over(w) for k in range(1, ahead + 1)}})


def first_date(columns: list[str]) -> Column:
    """The first of the columns that is a month and a year."""
    fits = lambda c: F.regexp_like(F.lower(c), F.lit(rf"{MONTH}[\-/]\d{{2,4}}$")) | F.regexp_like(F.col(c), F.lit(r"^\d{2}/\d{2,4}$"))
    return F.coalesce(*[F.when(fits(c), F.col(c)) for c in columns])


def text_lines(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` without the text, a row for each line that is not blank: line, text."""
    lines = F.filter(F.transform(F.split(tx.blank_as_empty(F.col(text_col)), "\n"), tx.stripped), lambda x: x != "")
    rest = [c for c in docs.columns if c != text_col]
    return docs.select(*rest, F.posexplode(lines).alias("line", "text"))


def delivery_lines(lines: DataFrame, by: list[str]) -> DataFrame:
    """Delivery entries of text lines: a line that is a product; the one before is its service, one of the next four its date."""
    near = neighbours(lines, by)
    distinct = _with_matches(lines.select("text").distinct(), "text", "text").select(F.col("text").alias("d_text"), "pm", "em")
    at = near.join(distinct, F.col("text") == F.col("d_text")).drop("d_text")
    for name in ("prev", "next_1"):
        at = at.join(distinct.select(F.col("d_text"), F.struct("pm", "em").alias(f"m_{name}")), F.col(name) == F.col("d_text"), "left").drop("d_text")
    other, fits = tx.is_other(F.col("text")), F.col("pm.score") >= vocab.ACCEPT
    at = at.filter(fits | other)
    name = F.when(fits, F.col("pm.canonical")).otherwise("Outros")
    own = F.element_at(F.create_map(*[F.lit(x) for kv in vocab.PRODUCT_AXIS.items() for x in kv]), name)
    service = (F.col("m_prev.pm.score") < 0.80) & (F.col("m_prev.em.score") < 0.80) & (F.length("prev") > 5) & ~F.regexp_like(F.lower("prev"), F.lit(MONTH))
    return at.select(
        *by, "line", F.when(service, F.substring("prev", 1, 250)).otherwise("").alias("servico_acao"),
        F.substring("text", 1, 250).alias("produto_original"), name.alias("produto_normalizado"), F.lit("").alias("eixo_original"),
        F.coalesce(own, F.when(F.col("m_next_1.em.score") >= 0.80, F.col("m_next_1.em.canonical")), F.lit("")).alias("eixo_normalizado"),
        tx.parse_date(first_date([f"next_{k}" for k in range(1, 5)])).alias("data_pactuada"),
        *_delivery_marks(other, False),
    )


def better_reading(df: DataFrame, doc: str, method: str, preference: dict[str, int]) -> DataFrame:
    """``df`` with only each document's method that has most rows; of ties the one preferred most."""
    table = F.create_map(*[x for k, v in preference.items() for x in (F.lit(k), F.lit(v))])
    counts = df.groupBy(doc, method).agg(F.count("*").alias("n"))
    best = counts.groupBy(F.col(doc).alias("b_doc")).agg(F.max_by(method, F.struct("n", F.element_at(table, F.col(method)))).alias("b_method"))
    return df.join(best, (F.col(doc) == F.col("b_doc")) & (F.col(method) == F.col("b_method")), "left_semi")
