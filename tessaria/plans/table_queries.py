"""More reference operators over the driver's tables: found tables, audits, extraction, files, schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessaria.functions import text as tx
from tessaria.functions import vocab
from tessaria.operators import audit, extract, match, tables
from tessaria.plans import schema, sql
from tessaria.plans.queries import _LABELS, _SCALE_SQL, pick, pick_sql, query, read
from tessaria.sources import files
from tessaria.streaming import incremental

# ---- tables ----

_HEADERS = [
    "ID do Risco|Probabilidade|Impacto|Tratamento", "Órgão|Sigla|CNPJ", "Nome|Cargo|Assinatura", "A|B", "Evento|Classificação do risco|Resposta", "Serviço/Ação|Produto|Eixo|Dt Pactuada",
    "Produto|Data Entrega|Justificativa", "Produto|Pactuado?|Área", "Risco", "Serviço|Produto|Data Pactuada",
]
_COMBINED = f"SELECT o_orderkey, string_split({pick_sql('o_orderkey', _HEADERS)}, '|') AS hs, {sql.header(f'replace({pick_sql("o_orderkey", _HEADERS)}, chr(124), chr(32))')} AS t FROM orders"


def _headers(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.split(pick(F.col("o_orderkey"), _HEADERS), r"\|").alias("headers"))
    return rows.withColumn("t", tables.combined(F.col("headers"), F.array().cast("array<string>")))


@query(f"""
WITH c AS ({_COMBINED}), k AS (SELECT *, {sql.hits('t', tables.RISK_WORDS)} AS risk, {sql.hits('t', tables.RISK_OTHER_WORDS)} AS alt, {sql.hits('t', tables.INFO_WORDS)} AS info, {sql.hits('t', tables.SIGNATURE_WORDS)} AS sig, len(hs) AS n FROM c)
SELECT o_orderkey, CASE WHEN risk >= 2 AND n BETWEEN 3 AND 8 THEN 'risk_table' WHEN risk >= 1 AND alt >= 1 AND n BETWEEN 3 AND 8 THEN 'risk_table' WHEN info >= 2 THEN 'organ_info' WHEN sig >= 2 AND n <= 4 THEN 'signature' ELSE 'unknown' END AS risk_kind,
 CASE WHEN contains(t, 'justificativa') THEN 'canceladas' WHEN contains(replace(t, ' ', ''), 'dtentrega') OR contains(t, 'data entrega') OR contains(t, 'data de entrega') THEN 'concluidas' WHEN contains(t, 'pactuado?') OR contains(t, 'pactuado ?') THEN 'concluidas'
  WHEN contains(replace(t, ' ', ''), 'dtpactuada') OR contains(t, 'data pactuada') THEN 'pactuadas' ELSE 'unknown' END AS delivery_kind FROM k
""")
def classify_table(spark, sf_dir):
    """TBL1, TBL2: the kind of a table by keywords."""
    rows = _headers(spark, sf_dir)
    return rows.select("o_orderkey", tables.risk_document_table(F.col("t"), F.size("headers")).alias("risk_kind"), tables.delivery_table(F.col("t")).alias("delivery_kind"))


_ROLE_NAMES = ["Situação", "Pactuado?", "Prazo", "Coluna Aleatória", "Serviço/Ação", "Produto PTD", "Eixo", "Motivo do cancelamento", "Data de Conclusão", "dt Entrega", "Dt  Pactuada", "Justificativa", "Data Conclusao"]


def _role_sql(v: str) -> str:
    h = sql.header(v)
    has = lambda *ws: "(" + " OR ".join(f"contains({h}, '{w}')" for w in ws) + ")"
    return (
        f"CASE WHEN trim({h}) IN ('status', 'situacao') THEN 'status' WHEN trim({h}) IN ('pactuado', 'pactuado?', 'entregue', 'entregue?') THEN 'pactuado' "
        f"WHEN trim({h}) = 'justificativa' OR ({has('motivo')} AND {has('cancel')}) THEN 'justificativa' WHEN {has('servico', 'acao')} THEN 'servico' "
        f"WHEN trim({h}) IN ('produto', 'produto ptd', 'entrega') THEN 'produto' WHEN {has('eixo')} THEN 'eixo' "
        f"WHEN contains(replace({h}, ' ', ''), 'dtpactuada') OR {has('data pactuada', 'prazo')} THEN 'data_pactuada' "
        f"WHEN contains(replace({h}, ' ', ''), 'dtentrega') OR {has('data entrega', 'data conclusao')} THEN 'data_entrega' END"
    )


@query(f"SELECT p_partkey, {_role_sql('v')} AS role FROM (SELECT p_partkey, {pick_sql('p_partkey', _ROLE_NAMES)} AS v FROM part)")
def column_roles(spark, sf_dir):
    """TBL11: the role of a column, exact names before parts of names."""
    return read(spark, sf_dir, "part").select("p_partkey", tables.column_role(pick(F.col("p_partkey"), _ROLE_NAMES)).alias("role"))


_STATUS = ["Concluído", "Cancelado", "Não", "sim", "em andamento", "pactuada", "", "outro"]
_ROLE_SETS = ["produto,data_entrega", "produto,justificativa", "produto", "pactuado,justificativa"]


@query(f"""
WITH t AS (SELECT p_partkey, lower({pick_sql('p_partkey', _STATUS)}) AS s, {pick_sql('p_size', _ROLE_SETS)} AS r FROM part)
SELECT p_partkey, CASE WHEN contains(s, 'conclu') OR s IN ('sim', 'entregue', 'finalizada') THEN 'concluida' WHEN contains(s, 'cancel') OR s IN ('nao', 'não') THEN 'cancelada' WHEN contains(s, 'pactuada') OR s = 'em andamento' THEN 'pactuada'
  WHEN contains(r, 'data_entrega') OR contains(r, 'pactuado') THEN 'concluida' WHEN contains(r, 'justificativa') THEN 'cancelada' ELSE 'pactuada' END AS kind FROM t
""")
def delivery_table_type(spark, sf_dir):
    """TBL12: a row's status first, then the table's columns."""
    return read(spark, sf_dir, "part").select("p_partkey", tables.table_type(pick(F.col("p_partkey"), _STATUS), F.split(pick(F.col("p_size"), _ROLE_SETS), ",")).alias("kind"))


_FIRST_HEADERS = ["Risco de atraso na entrega|Provável|Alto|Mitigar", "Risco|Provável|a|b", "Col0|Col1|Col2|Col3", "Col0|certo]|Col2|muito alto]", "Perda de dados sensíveis|Raro|Alto|Aceitar", "curto|raro|a|b", "a|b"]
_BODIES = ["R1 Provável Alto Mitigar", "texto livre", "muito alto e raro", "[praticamente certo ] escolher entre"]


@query(f"""
WITH t AS (SELECT p_partkey, string_split({pick_sql('p_partkey', _FIRST_HEADERS)}, '|') AS hs, {sql.plain(f'lower({pick_sql("p_size", _BODIES)})')} AS body FROM part),
h AS (SELECT *, list_transform(hs, lambda x: {sql.plain('lower(x)')}) AS ns, len(hs) >= 4 AND {sql.hits('body', tables.SCALE_WORDS)} >= 2 AS risk_data FROM t)
SELECT p_partkey, len(hs) >= 4 AND length(ns[1]) >= 10 AND NOT (starts_with(ns[1], 'risco') OR starts_with(ns[1], 'col') OR ns[1] = 'nan') AND {sql.hits('ns[2]', tables.HEADER_SCALE_WORDS)} > 0 AS as_data,
  risk_data, len(hs) BETWEEN 4 AND 8 AND risk_data AND len(list_filter(ns, lambda x: (starts_with(x, 'col') AND length(x) <= 5) OR contains(x, 'escolher entre') OR contains(x, 'certo]') OR contains(x, 'certo ]') OR contains(x, 'muito alto]') OR contains(x, 'muito alto ]') OR contains(x, 'ocorrer'))) >= greatest(2, len(hs) // 2) AS orphan,
  {sql.hits('body', tables.TEMPLATE_ROWS)} > 0 AS template FROM h
""")
def table_shapes(spark, sf_dir):
    """TBL3 to TBL6: headers that are data, data of scales, template rows, orphans."""
    h, body = F.split(pick(F.col("p_partkey"), _FIRST_HEADERS), r"\|"), pick(F.col("p_size"), _BODIES)
    rows = read(spark, sf_dir, "part").select("p_partkey", h.alias("h"), body.alias("b"))
    return rows.select("p_partkey", tables.headers_are_data(F.col("h")).alias("as_data"), tables.is_risk_data(F.col("b"), F.size("h")).alias("risk_data"), tables.is_orphan(F.col("h"), F.col("b")).alias("orphan"), tables.is_template_row(F.col("b")).alias("template"))


_STORY = f"SELECT doc_id, line, CASE WHEN line % 4 = 1 THEN 'R' || line ELSE '' END AS c0, text AS c1, CASE WHEN line % 3 = 0 THEN '' ELSE substring(text, 5) END AS c2, CASE WHEN line % 5 = 2 THEN 'a;b' WHEN line % 7 = 0 THEN '- x' ELSE 'nan' END AS c3 FROM ({sql.lines()})"


def _part_sql(c: str) -> str:
    ok = f"trim({c}) <> '' AND lower(trim({c})) NOT IN ('nan', 'none')"
    parts = f"list(trim({c}) ORDER BY line) FILTER ({ok})"
    return f"""CASE WHEN coalesce(len({parts}), 0) = 0 THEN '' WHEN len(list_filter({parts}, lambda x: x[1] IN ('-', '•', '*'))) > 0 OR (len({parts}) > 1 AND len(list_filter({parts}, lambda x: contains(x, ';'))) > 0)
      THEN array_to_string({parts}, ' | ') ELSE array_to_string({parts}, ' ') END"""


@query(f"""
WITH s AS ({_STORY}), m AS (SELECT *, c0 <> '' AS is_id, count(*) OVER (PARTITION BY doc_id) AS n, count(*) FILTER (c0 <> '') OVER (PARTITION BY doc_id) AS ids,
  count(*) FILTER (c0 <> '') OVER (PARTITION BY doc_id ORDER BY line) AS block, lead(c0 <> '') OVER (PARTITION BY doc_id ORDER BY line) AS nxt FROM s),
a AS (SELECT *, ids >= 3 AND ids < 0.4 * n AS applies FROM m),
k AS (SELECT *, CASE WHEN applies THEN greatest(block, 1) ELSE line END AS b FROM a WHERE NOT applies OR block > 0 OR (nxt AND trim(c1) <> '' AND lower(trim(c1)) NOT IN ('nan', 'none')))
SELECT doc_id, b AS row, CASE WHEN first(applies) THEN {' || chr(1) || '.join(_part_sql(c) for c in ('c0', 'c1', 'c2', 'c3'))} ELSE first(c0 || chr(1) || c1 || chr(1) || c2 || chr(1) || c3) END AS cells FROM k GROUP BY doc_id, b
""")
def consolidate_blocks(spark, sf_dir):
    """TBL7: broken rows put together, from each numbered row to the next."""
    line = F.col("line")
    cells = F.array(
        F.when(line % 4 == 1, F.concat(F.lit("R"), line)).otherwise(""), F.col("text"), F.when(line % 3 == 0, "").otherwise(F.expr("substring(text, 5)")),
        F.when(line % 5 == 2, "a;b").when(line % 7 == 0, "- x").otherwise("nan"),
    )
    rows = extract.text_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    rows = rows.select(F.col("doc_id").alias("doc"), F.lit(1).alias("page"), F.lit(1).alias("table"), line.cast("long").alias("row"), cells.alias("cells"))
    return tables.consolidate_rows(rows).select(F.col("doc").alias("doc_id"), F.col("row").cast("long").alias("row"), F.array_join("cells", "\x01").alias("cells"))


_ACTIONS = {"1": "treinar equipe", "2": "rever contrato", "9": "monitorar"}
_REFS = ["1, 2, 9", "1; 7", "ver item 2 do plano", "9", "", "3,4"]


@query(f"""
WITH t AS (SELECT event_id, {pick_sql('event_id', _REFS)} AS v FROM events), r AS (SELECT *, regexp_extract_all(v, '\\d+') AS refs, regexp_split_to_array(trim(v), '[,;\\s]+') AS toks FROM t),
m AS (SELECT *, list_filter(list_transform(refs, lambda x: x || '. ' || (MAP {{'1': 'treinar equipe', '2': 'rever contrato', '9': 'monitorar'}})[x]), lambda x: x IS NOT NULL) AS f FROM r)
SELECT event_id, CASE WHEN len(list_filter(toks, lambda x: regexp_full_match(x, '\\d+'))) / len(toks) >= 0.5 AND len(f) > 0 THEN array_to_string(f, ' | ') ELSE v END AS resolved FROM m
""")
def action_refs(spark, sf_dir):
    """TBL8, TBL9: a document's numbered actions, and references to them."""
    listed = "Intro\nReferencial para ações de tratamento\n" + "\n".join(f"{k}. {v}" for k, v in _ACTIONS.items()) + "\nfim"
    rows = read(spark, sf_dir, "events").select("event_id", pick(F.col("event_id"), _REFS).alias("v"))
    actions = spark.range(1).select(tables.action_list(F.lit(listed)).alias("actions"))
    return rows.join(F.broadcast(actions)).select("event_id", tables.resolve_actions(F.col("v"), F.col("actions")).alias("resolved"))


@query("""
WITH n AS (SELECT s_suppkey AS doc, CASE s_suppkey % 4 WHEN 0 THEN ['ID do risco', 'Evento', 'Probabilidade', 'Impacto', 'Tratamento', 'Ações'] WHEN 1 THEN ['Col0', 'Col1', 'Col2', 'Col3', 'Col4'] WHEN 2 THEN ['Descrição do risco', 'Probab', 'Severidade', 'Resposta', 'Medidas'] ELSE ['Nº', 'Col1', 'Col2', 'Col3', 'Col4', 'Col5'] END AS h FROM supplier)
SELECT doc, unnest(['risco', 'probabilidade', 'impacto', 'tratamento', 'acoes']) AS field, unnest(CASE doc % 4 WHEN 0 THEN [1, 2, 3, 4, 5] WHEN 1 THEN [0, 1, 2, 3, 4] WHEN 2 THEN [0, 1, 2, 3, 4] ELSE [1, 2, 3, 4, 5] END) AS col FROM n
""")
def map_risk_columns(spark, sf_dir):
    """TBL10: a risk table's columns by name, by similarity, then by place."""
    sets = [["ID do risco", "Evento", "Probabilidade", "Impacto", "Tratamento", "Ações"], ["Col0", "Col1", "Col2", "Col3", "Col4"], ["Descrição do risco", "Probab", "Severidade", "Resposta", "Medidas"], ["Nº", "Col1", "Col2", "Col3", "Col4", "Col5"]]
    names = F.array(*[F.array(*map(F.lit, s)) for s in sets])
    rows = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc"), F.lit(1).alias("page"), F.lit(1).alias("table"), F.posexplode(F.element_at(names, (F.col("s_suppkey") % 4 + 1).cast("int"))).alias("col", "text"))
    return tables.map_risk_columns(rows).select("doc", "field", "col")


@query("""
WITH t AS (SELECT conv_id AS doc, turn, role, row_number() OVER (PARTITION BY conv_id, turn ORDER BY md5(text)) AS dup, text FROM conversations), d AS (SELECT * FROM t WHERE dup = 1),
k AS (SELECT *, turn % 3 = 0 AS head, CASE WHEN turn % 4 = 1 THEN 5 ELSE 4 END AS nc FROM d),
c AS (SELECT *, last_value(CASE WHEN head THEN nc END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_n FROM k)
SELECT doc, turn, CASE WHEN head THEN 'header' WHEN last_n = nc THEN 'continuation' ELSE 'skip' END AS state FROM c
""")
def carry_headers(spark, sf_dir):
    """TBL13: the last risk table's headers hold for later tables of the same width."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5("text").alias("m")).groupBy("conv_id", "turn").agg(F.min("m").alias("m"))
    n = F.when(F.col("turn") % 4 == 1, 5).otherwise(4)
    t = rows.select(F.col("conv_id").alias("doc"), F.lit(1).alias("page"), F.col("turn").alias("table"), n.alias("ncols"), F.array_repeat(F.lit("x"), n).alias("headers"), F.lit("raro e alto").alias("all_text"))
    return tables.carry_headers(t, F.when(F.col("table") % 3 == 0, "risk_table").otherwise("unknown")).select("doc", F.col("table").alias("turn"), "state")


# ---- audit and extraction ----

_AUDIT = ["Probabilidade", "raro", "de de Ocor-", "alto", "um texto muito longo que não cabe numa escala qualquer", "zzz", ""]


@query(f"""
WITH RECURSIVE x AS (SELECT DISTINCT v FROM (SELECT {pick_sql('o_orderkey', _AUDIT)} AS v FROM orders)), k AS (SELECT v, {sql.plain(f"lower({sql.normalize('v')})")} AS key FROM x),
p(v) AS (VALUES {sql.values([(v,) for v in vocab.PROBABILITY])}), i(v) AS (VALUES {sql.values([(v,) for v in vocab.IMPACT])}),
{sql.ratio("SELECT key AS a FROM k WHERE key <> ''", f"SELECT {sql.plain('v')} AS b FROM p UNION SELECT {sql.plain('v')} FROM i")},
s AS (SELECT k.v, key, coalesce(max(r) FILTER (b0 IN (SELECT {sql.plain('v')} FROM p)), 0) AS own, coalesce(max(r) FILTER (b0 IN (SELECT {sql.plain('v')} FROM i)), 0) AS other FROM k LEFT JOIN r ON a0 = key GROUP BY ALL)
SELECT o_orderkey, CASE WHEN v = '' THEN NULL WHEN list_contains({sql.array(tx.AUDIT_HEADERS)}, key) THEN 'header_captured' WHEN regexp_matches(v, '\\S-$') OR v = 'de de Ocor-' THEN 'fragment' WHEN length(v) > 30 AND own < 0.7 THEN 'column_bleed'
  WHEN own < 0.85 AND other >= 0.85 AND other > own + 0.1 THEN 'column_shift' END AS audit FROM orders JOIN s ON s.v = {pick_sql('o_orderkey', _AUDIT)}
""")
def column_shift(spark, sf_dir):
    """AUD1, AUD2, AUD3: the first finding of a probability."""
    k = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(
        k, pick(k, _AUDIT).alias("probabilidade_original"), F.lit("alto").alias("impacto_original"), F.lit("mitigar").alias("tratamento_original"), F.lit(False).alias("needs_review"), F.lit(None).cast("string").alias("review_reason"), F.lit("high").alias("extraction_confidence")
    )
    return audit.audit_risks(rows).select("o_orderkey", F.get("audit", F.lit(0)).alias("audit"))


@query(f"""
SELECT category, count(*) AS n FROM (SELECT CASE {pick_sql('o_orderkey', _AUDIT)} WHEN 'Probabilidade' THEN 'header_captured' WHEN 'de de Ocor-' THEN 'fragment' WHEN 'um texto muito longo que não cabe numa escala qualquer' THEN 'column_bleed' WHEN 'alto' THEN 'column_shift' END AS category FROM orders)
WHERE category IS NOT NULL GROUP BY category
""")
def audit_counts(spark, sf_dir):
    """AUD3: counts by category."""
    rows = column_shift(spark, sf_dir).withColumn("audit", F.array_compact(F.array("audit")))
    return audit.audit_counts(rows)


_PAIRS_P, _PAIRS_I = ["Alto", "raro", "Médio", "zz", ""], ["Raro", "alto", "1", "raro"]


@query(f"""
WITH t AS (SELECT o_orderkey, {pick_sql('o_orderkey', _PAIRS_P)} AS p, {pick_sql('o_orderkey', _PAIRS_I)} AS i FROM orders)
SELECT o_orderkey, CASE WHEN p IN ('Alto', 'Médio') AND i IN ('Raro', '1', 'raro') THEN i ELSE p END AS probabilidade_original, CASE WHEN p IN ('Alto', 'Médio') AND i IN ('Raro', '1', 'raro') THEN p ELSE i END AS impacto_original FROM t
""")
def swap_detect(spark, sf_dir):
    """EXT1, EXT2, EXT3: swapped columns put right before a risk is written."""
    k = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(k.alias("doc"), F.lit("r").alias("risco"), pick(k, _PAIRS_P).alias("probabilidade"), pick(k, _PAIRS_I).alias("impacto"), F.lit("mitigar").alias("tratamento"), F.lit("").alias("acoes"))
    return extract.risk_entries(rows).select(F.col("doc").alias("o_orderkey"), "probabilidade_original", "impacto_original")


@query(f"""
WITH l AS ({sql.lines()}), w AS (SELECT *, lag(text) OVER v AS prev, lead(text) OVER v AS next_1, lead(text, 4) OVER v AS next_4 FROM l WINDOW v AS (PARTITION BY doc_id ORDER BY line))
SELECT doc_id, line, md5(prev) AS prev, md5(next_1) AS next_1, md5(next_4) AS next_4 FROM w
""")
def neighbour_line(spark, sf_dir):
    """EXT5: a line's neighbours."""
    rows = extract.neighbours(extract.text_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), "text"), ["doc_id"])
    return rows.select("doc_id", F.col("line").cast("long").alias("line"), *[F.md5(c).alias(c) for c in ("prev", "next_1", "next_4")])


_PAGE = ["Sistema de protocolo", "Integração ao Login Único", "Segurança e Privacidade", "jun/25", "linha solta", "Outros", "Governança e Gestão de Dados", "12/2025"]


@query("""
SELECT s_suppkey AS doc, unnest([1, 5]) AS line, unnest(['Sistema de protocolo', '']) AS servico_acao, unnest(['Integração ao Login Único', 'Outros']) AS produto_normalizado, unnest(['Unificação de Canais Digitais', 'Projetos Especiais']) AS eixo_normalizado,
  unnest(['2025-06', '2025-12']) AS data_pactuada, unnest([false, true]) AS needs_review FROM supplier
""")
def delivery_lines(spark, sf_dir):
    """EXT5: deliveries of text lines (the line before the catch-all is under six characters short of a service: it is a product's)."""
    page = F.when(F.lit(True), F.lit("\n".join(_PAGE).replace("linha solta", "solta")))
    lines = extract.text_lines(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc"), page.alias("t")), "t")
    return extract.delivery_lines(lines, ["doc"]).select("doc", "line", "servico_acao", "produto_normalizado", "eixo_normalizado", "data_pactuada", "needs_review")


@query(f"""
SELECT p_partkey AS seq, 'Adequação à LGPD' AS produto_normalizado, 'Governança e Gestão de Dados' AS eixo_normalizado, CASE WHEN p_partkey % 8 IN (0, 3) THEN 'concluida' WHEN p_partkey % 8 IN (1, 2) THEN 'cancelada' ELSE 'pactuada' END AS tabela_tipo, '2026-03' AS data_pactuada
FROM part
""")
def delivery_rows(spark, sf_dir):
    """EXT4: deliveries of table rows."""
    k = F.col("p_partkey")
    empty = F.lit("")
    rows = read(spark, sf_dir, "part").select(
        F.lit("d").alias("doc"), k.alias("seq"), F.array(F.lit("produto")).alias("roles"), F.col("p_name").alias("servico"), F.lit("A) Adequação à LGPD").alias("produto"), F.lit("x").alias("eixo"), F.lit("mar/2026").alias("data_pactuada"),
        F.lit("nan").alias("data_entrega"), empty.alias("pactuado"), empty.alias("justificativa"), pick(k, _STATUS).alias("status"),
    )
    return extract.delivery_entries(rows).select("seq", "produto_normalizado", "eixo_normalizado", "tabela_tipo", "data_pactuada")


@query("""
WITH c AS (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY ALL), b AS (SELECT conv_id, arg_max(role, (n, CASE role WHEN 'user' THEN 1 ELSE 0 END)) AS role FROM c GROUP BY conv_id)
SELECT conv_id, role, count(*) AS n FROM conversations SEMI JOIN b USING (conv_id, role) GROUP BY ALL
""")
def hybrid_pick(spark, sf_dir):
    """EXT6: the reading with more rows; of ties the one preferred."""
    rows = read(spark, sf_dir, "conversations").filter(F.col("role").isNotNull())
    return extract.better_reading(rows, "conv_id", "role", {"user": 1, "assistant": 0, "system": 0}).groupBy("conv_id", "role").agg(F.count("*").alias("n"))


_RISK_HEADER = ["ID do risco", "Risco", "Probabilidade", "Impacto", "Tratamento", "Ações"]
#: Documents as (headers, rows) of their tables, one a page.
_RISK_DOCUMENTS = [
    [(_RISK_HEADER, [["1", "Atraso", "Raro", "Alto", "Mitigar", "1, 2"], ["2", "Perda", "Alto", "Raro", "Aceitar", ""]]), (["x", "y", "z", "w", "v", "u"], [["Falha do sistema", "Raro", "Alto", "Mitigar", "9", "ele"]])],
    [(["Perda total de dados", "Raro", "Alto", "Aceitar", "nada"], [["Vazamento", "Provável", "Médio", "Evitar", ""]]), (["p", "q", "r", "s", "t"], [["Greve", "Raro", "Baixo", "Mitigar", ""], ["Risco", "Probabilidade", "", "", ""]])],
    [(["Col0", "certo]", "Col2", "muito alto]", "Col4", "Col5", "Col6"], [["1", "7", "Incêndio", "Raro", "Alto", "Mitigar", ""], ["2", "8", "Fraude", "Provável", "Alto", "Aceitar", ""]]), (["a", "b", "c", "d"], [["só texto", "", "", ""]])],
    [(["Órgão", "Sigla", "CNPJ", "x"], [["Nada", "N", "0", ""]])],
]
_RISK_TEXT = "Referencial para ações de tratamento\n1. treinar\n2. rever\n9. monitorar\nfim"


@query("""
WITH e(doc, risco_texto, probabilidade_normalizada, impacto_normalizado, tratamento_normalizado, acoes_tratamento, needs_review) AS (VALUES
  (0, 'Atraso', 'raro', 'alto', 'mitigar', '1. treinar | 2. rever', false), (0, 'Perda', 'raro', 'alto', 'aceitar', '', true), (0, 'Falha do sistema', 'raro', 'alto', 'mitigar', '9. monitorar', false),
  (1, 'Perda total de dados', 'raro', 'alto', 'aceitar', 'nada', true), (1, 'Vazamento', 'provável', 'médio', 'eliminar', '', false), (1, 'Greve', 'raro', 'baixo', 'mitigar', '', false),
  (2, 'Incêndio', 'raro', 'alto', 'mitigar', '', false), (2, 'Fraude', 'provável', 'alto', 'aceitar', '', false))
SELECT s_suppkey AS doc, e.* EXCLUDE (doc) FROM supplier JOIN e ON e.doc = s_suppkey % 4
""")
def risk_document_entries(spark, sf_dir):
    """EXT1 end to end: a six-column continuation, data for a header with a continuation, an orphan with numbers, and a document without risks."""
    cells = [(d, page, row, col, text) for d, pages in enumerate(_RISK_DOCUMENTS) for page, (headers, rows) in enumerate(pages, 1) for row, line in enumerate([headers, *rows], -1) for col, text in enumerate(line)]
    fixed = spark.createDataFrame(cells, "kind int, page int, row int, col int, text string").withColumn("table", F.lit(1))
    docs = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc"), (F.col("s_suppkey") % 4).cast("int").alias("kind"))
    out = extract.risk_document_entries(docs.join(F.broadcast(fixed), "kind").drop("kind"), docs.select("doc", F.lit(_RISK_TEXT).alias("text")))
    return out.select("doc", "risco_texto", "probabilidade_normalizada", "impacto_normalizado", "tratamento_normalizado", "acoes_tratamento", "needs_review")


_NAMED = ["Serviço", "Produto", "Eixo", "Data Pactuada"]
#: Documents as (headers, rows) of their tables, one a page, and their text.
_DELIVERY_DOCUMENTS = [
    ([(_NAMED, [["Portal", "Adequação à LGPD", "e", "mar/2026"], _NAMED]), (["App", "Integração ao Login Único", "Canais", "mai/2026"], [["Balcão", "Outros", "", "jun/25"]])], []),
    ([(["Col0", "Col1", "Col2", "Col3"], [["Serviço", "Produto", "Eixo", "Prazo"], ["Portal", "Integração ao Login Único", "x", "12/2025"]]), (["Col0", "Col1", "Col2", "Col3"], [["App", "nan", "Adequação à LGPD", "mar/2026"]])], []),
    ([(["a", "b", "c"], [["nada", "zzz", "yyy"], ["Sistema", "Outros", "q"]]), (["k", "l", "m", "n", "o"], [["Guia", "Adequação à LGPD", "w", "DTI", "mar/2026"]]), (["x", "y"], [["Integração ao Login Único", "z"]])], ["Integração ao Login Único"]),
    ([], ["Sistema de protocolo", "Integração ao Login Único", "Segurança e Privacidade", "jun/25"]),
]


@query("""
WITH e(doc, page, "row", method, servico_acao, produto_normalizado, eixo_normalizado, data_pactuada, needs_review, review_reason) AS (VALUES
  (0, 1, 0, 'tables', 'Portal', 'Adequação à LGPD', 'Governança e Gestão de Dados', '2026-03', false, NULL), (0, 2, -1, 'tables', 'App', 'Integração ao Login Único', 'Unificação de Canais Digitais', NULL, true, 'recuperado de header multi-página'),
  (0, 2, 0, 'tables', 'Balcão', 'Outros', 'Projetos Especiais', '2025-06', true, 'produto Outros'), (1, 1, 1, 'tables', 'Portal', 'Integração ao Login Único', 'Unificação de Canais Digitais', '2025-12', false, NULL),
  (1, 2, 0, 'tables', 'App', 'Adequação à LGPD', 'Governança e Gestão de Dados', '2026-03', false, NULL), (2, 1, 1, 'tables', 'Sistema', 'Outros', 'Projetos Especiais', NULL, true, 'produto Outros'),
  (2, 2, 0, 'tables', 'Guia', 'Adequação à LGPD', 'Governança e Gestão de Dados', '2026-03', false, NULL), (3, 1, 1, 'text', 'Sistema de protocolo', 'Integração ao Login Único', 'Unificação de Canais Digitais', '2025-06', false, NULL))
SELECT s_suppkey AS doc, e.* EXCLUDE (doc) FROM supplier JOIN e ON e.doc = s_suppkey % 4
""")
def delivery_document_entries(spark, sf_dir):
    """EXT4, EXT6, TBL13 end to end: carried columns, a header in place of data, names in the first row, columns found by a product, and a document of text alone."""
    cells = [(d, page, 1, row, col, text) for d, (pages, _) in enumerate(_DELIVERY_DOCUMENTS) for page, (headers, rows) in enumerate(pages, 1) for row, line in enumerate([headers, *rows], -1) for col, text in enumerate(line)]
    lines = [(d, 1, i, text) for d, (_, texts) in enumerate(_DELIVERY_DOCUMENTS) for i, text in enumerate(texts)]
    docs = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc"), (F.col("s_suppkey") % 4).cast("int").alias("kind"))
    of = lambda rows, kind: docs.join(F.broadcast(spark.createDataFrame(rows, kind)), "kind").drop("kind")
    out = extract.delivery_document_entries(of(cells, "kind int, page int, table int, row int, col int, text string"), of(lines, "kind int, page int, line int, text string"))
    return out.select("doc", "page", F.col("row").cast("int").alias("row"), "method", "servico_acao", "produto_normalizado", "eixo_normalizado", "data_pactuada", "needs_review", "review_reason")


# ---- files, schemas, descriptors ----


@query("""
SELECT n_regionkey AS region, string_agg(n_name, ',' ORDER BY n_nationkey) AS names, count(*) AS n FROM nation GROUP BY 1
""")
def nested_json(spark, sf_dir):
    """SNK2: rows grouped by key, read back from the JSON."""
    rows = read(spark, sf_dir, "nation").withColumn("key", F.col("n_regionkey").cast("string"))
    out = files.nested_json(rows, "key", "n_nationkey", ["n_name", "n_nationkey"])
    back = out.select(F.explode(F.from_json("data", "map<string, array<struct<n_name: string, n_nationkey: int>>>")).alias("region", "rows"))
    return back.select(F.col("region").cast("int").alias("region"), F.array_join("rows.n_name", ",").alias("names"), F.size("rows").cast("long").alias("n"))


@query("SELECT 'region' AS name, true AS has_bytes, 64 AS sha256_length, 32 AS md5_length UNION ALL SELECT 'nation', true, 64, 32")
def manifest_files(spark, sf_dir):
    """SRC3, SRC12, MET1, HSH1: an inventory of files with their checksums."""
    found = files.checksums(files.inventory(spark, sf_dir, "{region,nation}.parquet"))
    return found.select(F.regexp_replace("name", r"\.parquet$", "").alias("name"), (F.col("bytes") > 0).alias("has_bytes"), F.length("sha256").alias("sha256_length"), F.length("md5").alias("md5_length"))


@query("WITH h AS (SELECT sha1('{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}') AS h, row_number() OVER (ORDER BY n_nationkey) - 1 AS i FROM nation), b AS (SELECT i // 10000 AS b, sha1(string_agg(h, '' ORDER BY i)) AS h FROM h GROUP BY 1) SELECT substring(sha1(string_agg(h, '' ORDER BY b)), 1, 12) AS fingerprint FROM b")
def fingerprint(spark, sf_dir):
    """HSH1, MET15: one mark of an ordered state."""
    return files.fingerprint(read(spark, sf_dir, "nation"), ["n_name", "n_regionkey"], "n_nationkey")


@query("""
WITH a AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 10 <> 3), b AS (SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN -1 ELSE c_nationkey END AS c_nationkey FROM customer WHERE c_custkey % 10 <> 4)
SELECT *, 'fresh' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'committed' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
""")
def staleness(spark, sf_dir):
    """SNK4, MET2: what a regenerated table and a committed one do not share."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    return files.differences(c.filter(k % 10 != 3), c.filter(k % 10 != 4).withColumn("c_nationkey", F.when(k % 50 == 0, -1).otherwise(F.col("c_nationkey"))))


@query("SELECT unnest(['organs.csv', 'risks.csv']) AS name")
def bundle_check(spark, sf_dir):
    """SNK7: expected files that are missing."""
    return files.missing_files(files.inventory(spark, sf_dir, "nation.parquet").select("name"), ["organs.csv", "nation.parquet", "risks.csv"])


@query("SELECT o_orderkey FROM orders WHERE o_custkey % 4 <> 1")
def pending_work(spark, sf_dir):
    """BAT1, SRC14, SNK8: inputs without a result yet."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return incremental.pending(orders, orders.filter("o_custkey % 4 = 1"), "o_orderkey").select("o_orderkey")


_FIELDS = [schema.Field("p_partkey", "integer", required=True), schema.Field("p_type", enum=("ECONOMY", "SMALL")), schema.Field("p_size", "integer", minimum=5, maximum=45), schema.Field("p_name", required=True)]


@query("""
SELECT p_partkey AS key, 'p_type' AS field, 'enum' AS rule FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL')
UNION ALL SELECT p_partkey, 'p_size', 'minimum' FROM part WHERE p_size < 5 UNION ALL SELECT p_partkey, 'p_size', 'maximum' FROM part WHERE p_size > 45 UNION ALL SELECT p_partkey, 'p_name', 'required' FROM part WHERE p_partkey % 13 = 0
""")
def schema_violations(spark, sf_dir):
    """The field model's constraints as predicates."""
    rows = read(spark, sf_dir, "part").withColumn("p_name", F.when(F.col("p_partkey") % 13 != 0, F.col("p_name")))
    return schema.violations(rows, _FIELDS, "p_partkey")


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 <> 0)")
def foreign_keys(spark, sf_dir):
    """Foreign keys without a parent."""
    return schema.orphans(read(spark, sf_dir, "lineitem"), "l_suppkey", read(spark, sf_dir, "supplier").filter("s_suppkey % 7 != 0"), "s_suppkey")


@query("""
SELECT * FROM (VALUES (0, 'p_partkey', 'bigint', '', '', true), (1, 'p_name', 'string', '', '', true), (2, 'p_brand', 'string', '', '', false), (3, 'p_type', 'string', '', '', false), (4, 'p_size', 'int', '', '', false), (5, 'p_retailprice', 'double', '', '', false))
 v(position, "column", type, title, description, required)
""")
def data_dictionary(spark, sf_dir):
    """MET12, MET13, SNK5: a table's columns with what the field model says of them."""
    return schema.dictionary(read(spark, sf_dir, "part"), _FIELDS)


@query("""
WITH m AS (SELECT 'tipo' AS type, p_type AS normalized, list(DISTINCT p_brand) AS vs FROM part GROUP BY ALL UNION ALL SELECT 'marca', p_brand, list(DISTINCT p_type) FROM part GROUP BY ALL),
c(type, v, o) AS (VALUES ('tipo', 'SMALL', 1), ('tipo', 'ECONOMY', 2), ('tipo', 'NEVER MET', 3), ('marca', 'Brand#1', NULL))
SELECT coalesce(m.type, c.type) AS type, coalesce(normalized, v) AS prefLabel, coalesce(array_to_string(list_sort(vs), ','), '') AS altLabels, o AS notation
FROM m FULL JOIN c ON c.type = m.type AND c.v = normalized WHERE coalesce(m.type, c.type) <> 'tipo' OR o IS NOT NULL
""")
def skos_labels(spark, sf_dir):
    """MET6: concepts with variants, ordinals for ordered vocabularies."""
    part = read(spark, sf_dir, "part")
    one = lambda t, a, b: part.groupBy(F.lit(t).alias("type"), F.col(a).alias("normalized")).agg(F.collect_set(b).alias("variants"))
    out = schema.concepts(one("tipo", "p_type", "p_brand").unionByName(one("marca", "p_brand", "p_type")), {"tipo": []}, {"tipo": ["SMALL", "ECONOMY", "NEVER MET"], "marca": ["Brand#1"]})
    return out.withColumn("altLabels", F.array_join("altLabels", ","))


@query(f"""
WITH RECURSIVE {_SCALE_SQL} SELECT o_orderkey, canonical, CAST(ordinal AS INT) AS ordinal FROM orders JOIN m ON m.value = {pick_sql('o_orderkey', _LABELS)} JOIN (VALUES {sql.values([(v, i) for i, v in enumerate(vocab.PROBABILITY)])}) x(v, ordinal) ON x.v = canonical
""")
def ordinal_scale(spark, sf_dir):
    """Ordered vocabularies: a matched value's place on its scale."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", pick(F.col("o_orderkey"), _LABELS).alias("v"))
    m = match.match_values(rows, "v", vocab.PROBABILITY, vocab.PROBABILITY_ALIASES)
    scale = vocab.vocabulary(spark, vocab.PROBABILITY).withColumnRenamed("canonical", "s_value")
    return rows.join(m, F.col("v") == F.col("value")).join(F.broadcast(scale), F.col("canonical") == F.col("s_value")).select("o_orderkey", "canonical", "ordinal")
