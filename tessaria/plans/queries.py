"""The reference operators over the driver's tables, each with its SQL.

A query binds an operator to columns of the test tables that have the shape it needs: equal
documents play shared files, part names a vocabulary, conversations entries in order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaria.functions import text as tx
from tessaria.functions import vocab
from tessaria.operators import coverage, dedup, errors, extract, harmonize, match, metrics, scrape, similarity, standardize, variations
from tessaria.plans import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a query under its name, with its SQL."""

    def wrap(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return wrap


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(number: Column, items: list[str]) -> Column:
    """One of the items, by a number."""
    return F.element_at(F.array(*map(F.lit, items)), (number % len(items) + 1).cast("int"))


def pick_sql(number: str, items: list[str]) -> str:
    return f"({sql.array(items)})[{number} % {len(items)} + 1]"


# ---- coverage and shared files ----

_SHARE_SQL = "SELECT url, count(*) AS n_sharing, bool_or(n > 0) AS any_data FROM o GROUP BY url"
_ORGANS_SQL = "o AS (SELECT doc_id, md5(coalesce(text, '')) AS url, (SELECT count(*) FROM labels l WHERE l.doc_id = d.doc_id) AS n FROM documents d)"


def _organs(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.md5(tx.blank_as_empty(F.col("text"))).alias("url"))
    return coverage.with_count(docs, read(spark, sf_dir, "labels"), "doc_id", "doc_id", "n")


@query(f"""
WITH {_ORGANS_SQL}, s AS ({_SHARE_SQL})
SELECT doc_id, n AS n_entries,
       CASE WHEN n > 0 THEN 'ok' WHEN n_sharing > 1 AND any_data THEN 'compartilhado' ELSE 'sem_dados' END AS status_entregas,
       CASE WHEN n > 0 THEN 'ok' WHEN n_sharing > 1 AND any_data THEN 'compartilhado' ELSE 'no_risk_table' END AS status_riscos
FROM o JOIN s USING (url)
""")
def coverage_status(spark, sf_dir):
    """COV1, COV3, COV4: labelled documents are data; equal texts share a file."""
    o = coverage.with_share(_organs(spark, sf_dir), "url", "n")
    n, k, any_data = F.col("n"), F.col("n_sharing"), F.col("any_data")
    return o.select("doc_id", n.alias("n_entries"), coverage.delivery_status(n, k, any_data).alias("status_entregas"), coverage.risk_status(F.col("url"), n, k, any_data).alias("status_riscos"))


@query(f"WITH {_ORGANS_SQL} {_SHARE_SQL}")
def share_index(spark, sf_dir):
    """COV2."""
    return coverage.share_index(_organs(spark, sf_dir), "url", "n")


@query("""
WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS h, min(doc_id) OVER (PARTITION BY text) AS owner, count(*) OVER (PARTITION BY text) AS shared FROM documents)
SELECT doc_id, owner, shared, CASE WHEN doc_id = owner THEN h END AS path FROM d
""")
def shared_file_owner(spark, sf_dir):
    """DED1, DED2: of equal contents the smallest key keeps its path."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.md5(tx.blank_as_empty(F.col("text"))).alias("h")).withColumn("path", F.col("h"))
    return dedup.own_by_content(docs, "h", "doc_id", "path").select("doc_id", "owner", "shared", "path")


@query("""
SELECT doc_id, 'extraction' AS stage, 'file_not_found' AS error_type, 'no label' AS error_message FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def error_channel(spark, sf_dir):
    """CHK1, ERR1: documents without a label are errors."""
    return dedup.missing(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels"), "doc_id", "extraction", "file_not_found", "no label")


@query("SELECT DISTINCT l_suppkey % 100 AS k FROM lineitem WHERE l_suppkey % 100 NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 = 0)")
def set_difference(spark, sf_dir):
    """AGG3: keys of one table that another lacks."""
    a = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 100).alias("k"))
    return metrics.set_difference(a, read(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("k")), "k")


@query("SELECT min(url) AS url, count(*) AS n FROM (SELECT DISTINCT url FROM pages) GROUP BY url")
def fetch_once(spark, sf_dir):
    """SRC4: each address once."""
    return dedup.drop_fetched(read(spark, sf_dir, "pages").select("url")).groupBy("url").agg(F.count("*").alias("n"))


# ---- text ----


def _lines(spark, sf_dir) -> DataFrame:
    return extract.text_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query(f"SELECT doc_id, line, {sql.normalize('text')} AS normalized FROM ({sql.lines()})")
def normalize_text(spark, sf_dir):
    """STR1, SRC6: every line that is not blank."""
    return _lines(spark, sf_dir).select("doc_id", F.col("line").cast("long").alias("line"), tx.normalize_text(F.col("text")).alias("normalized"))


@query(f"SELECT doc_id, md5({sql.plain('coalesce(text, chr(32))')}) AS plain_md5 FROM documents")
def strip_accents(spark, sf_dir):
    """STR2 over whole texts."""
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(tx.strip_accents(F.coalesce("text", F.lit(" ")))).alias("plain_md5"))


#: Code points by rule: the first and the number of those that rows take their letters from (Latin to Devanagari, Hangul, kana, CJK forms, Arabic forms, mathematical letters).
_SCRIPTS = [(0xC0, 0x500), (0x900, 0x400), (0x1100, 0x100), (0x1E00, 0x200), (0x2100, 0x90), (0x3040, 0xC0), (0x3300, 0x100), (0xAC00, 0x2BA4), (0xF900, 0x16E), (0xFB00, 0x3FE), (0xFF01, 0xE5), (0x1D400, 0x3FF)]
#: Marks of many combining classes, some of which compose and some of which come out of order.
_MARKS = [0x301, 0x327, 0x308, 0x323, 0x302, 0x345, 0x93C, 0x5B0, 0x1161, 0x11A8, 0x3099, 0x309A, 0x64B, 0x654, 0x338, 0x31B, 0x1D165]


def _points(k: Column) -> list[Column]:
    """A letter of one of the scripts and three marks, by a number."""
    at = F.element_at(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(n).alias("n")) for a, n in _SCRIPTS]), (k % len(_SCRIPTS) + 1).cast("int"))
    marks = F.array(*map(F.lit, _MARKS))
    return [(at["a"] + F.floor(k / len(_SCRIPTS)) * 37 % at["n"]).cast("int"), *[F.element_at(marks, (F.floor(k / by) % len(_MARKS) + 1).cast("int")) for by in (1, 5, 11)]]


def _character(point: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


_POINTS_SQL = (
    f"list_extract({[a for a, _ in _SCRIPTS]}, CAST(k % {len(_SCRIPTS)} + 1 AS INT)) + (k // {len(_SCRIPTS)}) * 37 % list_extract({[n for _, n in _SCRIPTS]}, CAST(k % {len(_SCRIPTS)} + 1 AS INT))",
    *[f"list_extract({_MARKS}, CAST((k // {by}) % {len(_MARKS)} + 1 AS INT))" for by in (1, 5, 11)],
)


@query(f"SELECT k AS o_orderkey, md5(nfc_normalize({' || '.join(f'chr(CAST({p} AS INT))' for p in _POINTS_SQL)})) AS composed_md5 FROM (SELECT o_orderkey AS k FROM orders)")
def unicode_composed(spark, sf_dir):
    """STR1 in any script: a letter and three marks for each order, composed in canonical order."""
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(k, F.concat(*map(_character, _points(k))).alias("s")).select("o_orderkey", F.md5(tx.composed(F.col("s"))).alias("composed_md5"))


#: Words whose compatible forms are other characters, several, or none, with marks of every kind.
_WORDS = ["Integração", "각하", "ｶﾞｷﾞ", "㎏ e ㌔", "ﷺ", "𝐀𝕭𝟘", "ऩई क़लम", "Ἀθῆναι", "й Ё", "ﬁnal ﬀ", "①②③", "ΐ", "ẛ̣", "q\u0307\u0323", "שָׁלוֹם", "עִבְרִית", "لَا", "กำ", "Å Ω K", "½ ª º", "ữ", "㌀", "豈更", "が", "𑂚", "e\u0301\u0327", "ㅎㅏㄴ", "㈜", "µm", "plain", ""]


@query(f"SELECT l_orderkey, l_linenumber, w.b AS plain FROM (SELECT *, (l_orderkey + l_linenumber) % {len(_WORDS)} AS k FROM lineitem) JOIN (VALUES {sql.values([(i, sql.bare(w)) for i, w in enumerate(_WORDS)])}) w(i, b) ON w.i = k")
def unicode_plain(spark, sf_dir):
    """STR2 in any script, against the standard library's forms."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pick(F.col("l_orderkey") + F.col("l_linenumber"), _WORDS).alias("w"))
    return rows.select("l_orderkey", F.col("l_linenumber"), tx.strip_accents(F.col("w")).alias("plain"))


@query(f"SELECT doc_id, {sql.header('text')} AS header FROM ({sql.lines()}) WHERE line = 0")
def header_norm(spark, sf_dir):
    """STR3 over first lines."""
    return _lines(spark, sf_dir).filter("line = 0").select("doc_id", tx.normalize_header(F.col("text")).alias("header"))


_DATES = ["dd/MM/yyyy", "MM/yyyy", "yyyy-MM-dd", "mmm/yy", "text", "empty"]


@query(f"""
WITH t AS (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 6 AS k FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y-%m') WHEN 2 THEN strftime(d, '%Y-%m-%d')
  WHEN 3 THEN CASE WHEN year(d) % 100 < 10 THEN '200' ELSE '20' END || (year(d) % 100) || '-' || strftime(d, '%m') WHEN 4 THEN 'sem data' END AS parsed FROM t
""")
def parse_date_mixed(spark, sf_dir):
    """STR4: order dates written in five forms."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    named = F.concat(F.element_at(F.array(*map(F.lit, tx.MONTHS)), F.month(d)), F.lit("/"), F.date_format(d, "yy"))
    raw = F.when(k == 0, F.date_format(d, "dd/MM/yyyy")).when(k == 1, F.date_format(d, "MM/yyyy")).when(k == 2, F.date_format(d, "yyyy-MM-dd")).when(k == 3, named).when(k == 4, "a)  sem   data").otherwise("")
    return read(spark, sf_dir, "orders").select("o_orderkey", tx.parse_date(raw).alias("parsed"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS created FROM events")
def pdf_date_like(spark, sf_dir):
    """STR5: document date marks."""
    raw = F.when(F.col("event_id") % 5 == 0, "D:2026").otherwise(F.concat(F.lit("D:"), F.date_format("ts", "yyyyMMddHHmmss"), F.lit("-03'00'")))
    return read(spark, sf_dir, "events").select("event_id", tx.parse_document_date(raw).alias("created"))


_W = r"[\p{L}\p{N}_]"
_PAIRS = f"list_transform(range(1, len(ws)), lambda i: regexp_extract(ws[i], '(?:^|[^\\p{{L}}\\p{{N}}_])({_W}{{1,3}})$', 1) <> '' AND regexp_extract(ws[i], '(?:^|[^\\p{{L}}\\p{{N}}_])({_W}{{1,3}})$', 1) = regexp_extract(ws[i + 1], '^({_W}{{1,3}})(?:[^\\p{{L}}\\p{{N}}_]|$)', 1))"


@query(f"""
SELECT doc_id, line, regexp_matches(text, '\\S-$') OR regexp_matches(text, '^-[a-záéíóúâêôãõç]') OR coalesce(list_bool_or({_PAIRS}), false) AS fragment
FROM (SELECT *, regexp_split_to_array(lower(text), '\\s+') AS ws FROM ({sql.lines()}))
""")
def fragment_flag(spark, sf_dir):
    """STR8 over lines."""
    return _lines(spark, sf_dir).select("doc_id", F.col("line").cast("long").alias("line"), tx.is_fragment(F.col("text")).alias("fragment"))


_NAMES = ["Risco", " NÍVEL DE IMPACTO ", "Ações", "Eixo", "Serviço/Ação", "provável", "1) Impacto", ""]


@query(f"""
WITH t AS (SELECT o_orderkey, {pick_sql('o_orderkey', _NAMES)} AS v FROM orders), k AS (SELECT o_orderkey, v, {sql.key('v')} AS key FROM t)
SELECT o_orderkey, v <> '' AND list_contains({sql.array(tx.RISK_HEADERS)}, key) AS risk, v <> '' AND list_contains({sql.array(tx.AUDIT_HEADERS)}, key) AS audit,
       v <> '' AND list_contains({sql.array(tx.DELIVERY_HEADERS)}, key) AS delivery FROM k
""")
def header_literal_filter(spark, sf_dir):
    """STR7: names of columns captured as data, by three lists."""
    v = pick(F.col("o_orderkey"), _NAMES)
    return read(spark, sf_dir, "orders").select("o_orderkey", tx.is_literal(v, tx.RISK_HEADERS).alias("risk"), tx.is_literal(v, tx.AUDIT_HEADERS).alias("audit"), tx.is_literal(v, tx.DELIVERY_HEADERS).alias("delivery"))


_OTHERS = ["Outros", " OUTRO ", "Outros –", "outros -", "Outra coisa", "nan", "  "]


@query(f"""
WITH t AS (SELECT p_partkey, {pick_sql('p_partkey', _OTHERS)} AS v, p_name FROM part)
SELECT p_partkey, list_contains({sql.array(tx.OTHER)}, trim(lower(trim(v)))) AS other, trim(v) = '' OR lower(trim(v)) = 'nan' AS blank, translate(lower(p_name), ' /', '--') AS slug,
       substring(p_name, 1, 7) AS short FROM t
""")
def small_text_rules(spark, sf_dir):
    """STR6, STR9, STR11, STR12: catch-all, blank, slug, truncation."""
    v = pick(F.col("p_partkey"), _OTHERS)
    return read(spark, sf_dir, "part").select("p_partkey", tx.is_other(v).alias("other"), tx.is_blank(v).alias("blank"), tx.slug(F.col("p_name")).alias("slug"), F.substring("p_name", 1, 7).alias("short"))


@query("""
SELECT doc_id, CASE WHEN n < 1024 THEN CAST(n AS VARCHAR) || ' B' WHEN n < 1048576 THEN format('{:.1f} KB', n / 1024) ELSE format('{:.1f} MB', n / 1048576) END AS size,
       length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + CASE WHEN text <> '' AND NOT ends_with(text, chr(10)) THEN 1 ELSE 0 END AS lines,
       md5(text) AS md5, sha256(text) AS sha256, trim(regexp_replace(text, '\\s+', ' ', 'g')) = trim(text) AS one_line
FROM (SELECT doc_id, text, strlen(text) AS n FROM documents)
""")
def sizes_and_hashes(spark, sf_dir):
    """STR10, STR13, HSH1, CNT1."""
    t, n = F.col("text"), F.octet_length("text")
    return read(spark, sf_dir, "documents").select("doc_id", tx.size_text(n).alias("size"), tx.line_count(t).alias("lines"), tx.digest(t, "md5").alias("md5"), tx.digest(t, "sha256").alias("sha256"), (tx.collapsed(t) == F.trim(t)).alias("one_line"))


# ---- pages ----

_A = r'(?i)<a\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>'
_LINKS = f"""
SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS href, trim(unnest(t)) AS anchor
FROM (SELECT page_id, regexp_extract_all(html, '{_A}', 1) AS h, regexp_extract_all(html, '{_A}', 2) AS t FROM pages)"""
_TYPED = f"""
SELECT page_id, pos, CASE WHEN starts_with(href, '/') THEN 'https://host' || href ELSE href END AS href, anchor,
       CASE WHEN pos % 4 = 1 THEN 'Anexo de Entregas ' || anchor WHEN pos % 4 = 2 THEN 'Documento DIRETIVO ' || anchor ELSE anchor END AS label FROM ({_LINKS})"""


def _typed_links(spark, sf_dir) -> DataFrame:
    rows = scrape.links(read(spark, sf_dir, "pages").select("page_id", "html"), host="https://host")
    label = F.when(F.col("at") % 4 == 1, F.concat(F.lit("Anexo de Entregas "), "anchor")).when(F.col("at") % 4 == 2, F.concat(F.lit("Documento DIRETIVO "), "anchor")).otherwise(F.col("anchor"))
    return rows.withColumn("label", label).withColumn("at", F.col("at").cast("long"))


_KIND = f"""CASE WHEN contains({sql.key('label')}, 'diretivo') THEN 'diretivo' WHEN contains({sql.key('label')}, 'entregas') THEN 'entregas'
 WHEN contains({sql.plain("lower(regexp_extract(href, '([^/]*)$', 1))")}, 'diretiv') THEN 'diretivo'
 WHEN contains({sql.plain("lower(regexp_extract(href, '([^/]*)$', 1))")}, 'entregas') OR contains({sql.plain("lower(regexp_extract(href, '([^/]*)$', 1))")}, 'anexo') THEN 'entregas' ELSE 'unknown' END"""


@query(f"SELECT page_id, pos, href, anchor, {_KIND} AS kind FROM ({_TYPED})")
def link_extract(spark, sf_dir):
    """SRC2, SCR1, SCR2, SCR5: a page's links, made absolute and typed."""
    rows = _typed_links(spark, sf_dir)
    return rows.select("page_id", F.col("at").alias("pos"), "href", "anchor", scrape.link_type_or_file(F.col("label"), F.col("href")).alias("kind"))


@query(f"""
WITH t AS (SELECT *, {_KIND} AS kind FROM ({_TYPED})),
d AS (SELECT page_id, min(pos) FILTER (kind = 'diretivo') AS d1, min(pos) FILTER (kind = 'entregas') AS e1, list(pos ORDER BY pos) FILTER (kind = 'unknown') AS u FROM t GROUP BY page_id),
p AS (SELECT page_id,
  CASE WHEN u IS NULL OR d1 < u[1] THEN d1 ELSE u[1] END AS da,
  CASE WHEN u IS NULL OR d1 < u[1] THEN list_filter(coalesce(u, []), lambda x: x > -1) ELSE u[2:] END AS left_u, d1, e1, u FROM d)
SELECT p.page_id, a.href AS diretivo, b.href AS entregas FROM p
LEFT JOIN t a ON a.page_id = p.page_id AND a.pos = da
LEFT JOIN t b ON b.page_id = p.page_id AND b.pos = CASE WHEN len(left_u) = 0 THEN e1 WHEN e1 < left_u[1] THEN e1 ELSE left_u[1] END
""")
def slot_fill(spark, sf_dir):
    """SCR6: the first link of each type, unknown ones fill what is free."""
    rows = _typed_links(spark, sf_dir).withColumn("kind", scrape.link_type_or_file(F.col("label"), F.col("href")))
    return scrape.fill_slots(rows, "page_id", "kind", "href", "at")


@query(r"""
WITH h AS (SELECT p_partkey, 'AA' || (p_size % 7) || ' / BB' || (p_size % 3) || ' (NOVO)/ c' || (p_size % 2) || ' / SG-PR:' AS t, p_size FROM part)
SELECT p_partkey, 'AA' || (p_size % 7) || ',BB' || (p_size % 3) || ',SG-PR' AS siglas FROM h
QUALIFY row_number() OVER (PARTITION BY p_size % 7, p_size % 3 ORDER BY p_partkey) = 1
""")
def header_acronyms(spark, sf_dir):
    """SCR3, SCR4: acronyms of headers; the first header of each set of them."""
    s = F.col("p_size").cast("string")
    title = F.concat(F.lit("Plano de Transformação  DIGITAL AA"), F.col("p_size") % 7, F.lit(" / BB"), F.col("p_size") % 3, F.lit(" (NOVO)/ c"), F.col("p_size") % 2, F.lit(" / SG-PR:"))
    rows = read(spark, sf_dir, "part").select("p_partkey", scrape.header_acronyms(title).alias("siglas"), s)
    return scrape.first_per_set(rows, "siglas", "p_partkey").select("p_partkey", F.array_join("siglas", ",").alias("siglas"))


_LISTING = """
SELECT c_custkey AS k, c_custkey // 50 AS page, CASE c_custkey % 11 WHEN 0 THEN 'MEC' WHEN 1 THEN 'CAPES' ELSE 'S' || (c_custkey % 13) END AS s1, 'T' || (c_custkey % 4) || (c_custkey % 3) AS s2,
 CASE c_custkey % 4 WHEN 0 THEN 'https://host/m/' || c_custkey || '-a.pdf' WHEN 1 THEN 'https://host/m/' || c_custkey || '-diretiv.pdf' ELSE 'https://host/m/' || c_custkey || '-u1.pdf' END AS d,
 CASE c_custkey % 4 WHEN 0 THEN 'http://other/m/' || c_custkey || '-b.PDF' WHEN 1 THEN 'https://host/m/' || c_custkey || '-entregas.pdf' WHEN 3 THEN 'https://host/m/' || c_custkey || '-u&2.pdf' END AS e
FROM customer WHERE c_custkey % 5 <> 4"""


@query(f"""
WITH c AS ({_LISTING}), n AS (SELECT *, 'Plano de Transformação Digital ' || s1 || ' / ' || s2 || ' :' AS nome FROM c QUALIFY row_number() OVER (PARTITION BY page, s1, s2 ORDER BY k) = 1),
x AS (SELECT page, k, 0 AS i, s1 AS sigla, nome, d, e FROM n UNION ALL SELECT page, k, 1, s2, nome, d, e FROM n),
f AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY page, sigla ORDER BY k, i) = 1),
g(member, head) AS (VALUES ('CAPES', 'MEC'), ('INEP', 'MEC'), ('S1', 'S2'), ('T99', 'S99')),
h AS (SELECT page, member, nome, d, e FROM f JOIN g ON sigla = head),
o AS (SELECT coalesce(f.page, h.page) AS page, coalesce(sigla, member) AS sigla, coalesce(f.nome, h.nome) AS nome_completo, coalesce(f.d, h.d) AS url_diretivo, coalesce(f.e, h.e) AS url_entregas FROM f FULL JOIN h ON f.page = h.page AND sigla = member)
SELECT o.*, head AS grupo FROM o LEFT JOIN g ON sigla = member
""")
def organ_listing(spark, sf_dir):
    """SRC2, SCR1-7, GRP1, GRP2: listing pages read as a whole, titles with the links of the element around them."""
    k = F.col("c_custkey")
    s1 = F.when(k % 11 == 0, "MEC").when(k % 11 == 1, "CAPES").otherwise(F.concat(F.lit("S"), k % 13))
    names = F.concat(s1, F.lit(" / T"), k % 4, k % 3)
    title = F.when(k % 5 == 4, F.concat(F.lit("<b>Outro plano "), names, F.lit(":</b>"))).when(k % 2 == 0, F.concat(F.lit("<strong>Plano de Transformação <em>Digital</em>\n "), names, F.lit("<br/> : </strong>")))
    title = title.otherwise(F.concat(F.lit("<B class='x'><b>Plano de Transforma&ccedil;&atilde;o Digital "), names, F.lit("</b> :</B>")))
    link = lambda end, anchor, q='"', at="/m/": F.concat(F.lit(f"<a x=1 href={q}{at}"), k, F.lit(f"{end}{q}>{anchor}</a> / "))
    links = F.when(k % 4 == 0, F.concat(link("-a.pdf", "Documento <i>Diretivo</i>"), link("-b.PDF", "Anexo de Entregas", "'", "http://other/m/")))
    links = links.when(k % 4 == 1, F.concat(link("-entregas.pdf", "Arquivo"), link("-diretiv.pdf", "Arquivo")))
    links = links.when(k % 4 == 2, F.concat(link("-u1.pdf", "um"), link("-e.pdf", "Entregas", at="/no/"), link(".html", "Entregas"), F.lit("<a name=x>Entregas.pdf</a><!-- <a href='/m/x.pdf'>Entregas</a> -->")))
    links = links.otherwise(F.concat(link("-u1.pdf", "um"), link("-u&amp;2.pdf", "dois")))
    cell = F.concat(F.lit("<td><p></i>"), title, links, F.lit("<script>'<b>Transformação Digital</b>'</script></td>"))
    cells = read(spark, sf_dir, "customer").select(F.floor(k / 50).alias("page"), k.alias("k"), cell.alias("cell"))
    pages = cells.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "cell"))), lambda x: x.cell), "\n").alias("html"))
    return scrape.organ_listing(pages, "page", host="https://host", markers=("/m/", "/n/"), groups={"MEC": ["MEC", "CAPES", "INEP"], "S2": ["S1"], "S99": ["T99"]})


@query("SELECT conv_id, turn, role, md5(text) AS md5 FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, md5(text)) = 1")
def first_per_key(spark, sf_dir):
    """SCR7: the first turn of each conversation."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.md5("text").alias("md5"))
    return scrape.first_per_key(rows, ["conv_id"], "turn", "md5")


@query("""
WITH r AS (SELECT n_name AS sigla, CASE WHEN n_nationkey % 3 = 0 OR n_nationkey < 5 THEN 'u' || n_nationkey END AS url FROM nation WHERE n_nationkey % 4 <> 3 OR n_nationkey < 5),
g AS (SELECT n_name AS member, 'NATION_' || n_regionkey AS head FROM nation WHERE n_name <> 'NATION_' || n_regionkey)
SELECT coalesce(r.sigla, x.member) AS sigla, coalesce(r.url, x.url) AS url, x.head AS grupo
FROM r FULL JOIN (SELECT member, head, h.url FROM g JOIN r h ON h.sigla = g.head) x ON r.sigla = x.member
""")
def group_inherit(spark, sf_dir):
    """GRP1, GRP2: nations inherit from the nation that heads their region; absent ones are added."""
    k = F.col("n_nationkey")
    n = read(spark, sf_dir, "nation")
    rows = n.filter((k % 4 != 3) | (k < 5)).select(F.col("n_name").alias("sigla"), F.when((k % 3 == 0) | (k < 5), F.concat(F.lit("u"), k)).alias("url"))
    groups = n.select(F.col("n_name").alias("member"), F.concat(F.lit("NATION_"), "n_regionkey").alias("head")).filter("member != head")
    return scrape.inherit_from_heads(rows, groups, "sigla", ["url"])


# ---- canonicalisation ----

_LABELS = ["Baixa", "MÉDIA", " alta", "3", "raros", "Certo", "Muito  provável", "RARO", "1-Alto", "praticamente cert", "Médio", "zzz", ""]
_SCALE_SQL = f"""
c(v, o) AS (VALUES {sql.values([(v, i) for i, v in enumerate(vocab.PROBABILITY)])}), al(a, v, o) AS (VALUES {sql.values([(a, v, i) for i, (a, v) in enumerate(vocab.PROBABILITY_ALIASES.items())])}),
x AS (SELECT DISTINCT v FROM (SELECT {pick_sql('o_orderkey', _LABELS)} AS v FROM orders)), k AS (SELECT v, {sql.key('v')} AS key FROM x),
{sql.ratio("SELECT key AS a FROM k WHERE key <> ''", f"SELECT {sql.plain('v')} AS b FROM c")},
best AS (SELECT a0, arg_max(v, (r, -o)) AS v, max(r) AS r FROM r JOIN c ON {sql.plain('c.v')} = b0 WHERE r > 0 GROUP BY a0),
m AS (SELECT k.v AS value, key, coalesce((SELECT v FROM al WHERE {sql.plain('a')} = key ORDER BY o LIMIT 1), (SELECT v FROM c WHERE {sql.plain('c.v')} = key ORDER BY o LIMIT 1), best.v, '') AS canonical,
  CASE WHEN key = '' THEN 0.0 WHEN EXISTS (SELECT 1 FROM al WHERE {sql.plain('a')} = key) THEN 0.95 WHEN EXISTS (SELECT 1 FROM c WHERE {sql.plain('c.v')} = key) THEN 1.0 ELSE coalesce(best.r, 0.0) END AS score
  FROM k LEFT JOIN best ON a0 = key)"""


def _scale_match(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", pick(F.col("o_orderkey"), _LABELS).alias("v"))
    return rows, match.match_values(rows, "v", vocab.PROBABILITY, vocab.PROBABILITY_ALIASES)


@query(f"WITH RECURSIVE {_SCALE_SQL} SELECT value, canonical, CAST(score AS DOUBLE) AS score FROM m")
def alias_lookup(spark, sf_dir):
    """FZ1, FZ2, FZ5: labels met by alias, exactly, or by similarity."""
    return _scale_match(spark, sf_dir)[1]


@query(f"""
WITH RECURSIVE {_SCALE_SQL}
SELECT o_orderkey, canonical, CAST(score AS DOUBLE) AS score, {sql.method('value', 'score', f"list_contains({sql.array(match.alias_keys(vocab.PROBABILITY_ALIASES))}, key)")} AS method
FROM orders JOIN m ON m.value = {pick_sql('o_orderkey', _LABELS)}
""")
def match_method(spark, sf_dir):
    """FZ6: the tier of every row's match, joined back from distinct values."""
    rows, m = _scale_match(spark, sf_dir)
    keys = match.alias_keys(vocab.PROBABILITY_ALIASES)
    return rows.join(m, F.col("v") == F.col("value")).select("o_orderkey", "canonical", "score", match.match_method(F.col("value"), F.col("score"), tx.key(F.col("value")).isin(keys)).alias("method"))


@query(f"""
WITH RECURSIVE n AS (SELECT DISTINCT p_name AS b FROM part), u AS (SELECT DISTINCT substring(b, 1, length(b) - 2) AS a FROM n),
{sql.ratio("SELECT a FROM u", "SELECT b FROM n")}
SELECT a0 AS value, arg_max(b0, (r, -o)) AS canonical, CAST(max(r) AS DOUBLE) AS score
FROM r JOIN (SELECT b, row_number() OVER (ORDER BY b) AS o FROM n) x ON x.b = b0 WHERE a0 NOT IN (SELECT b FROM n) AND r > 0 GROUP BY a0
""")
def fuzzy_best(spark, sf_dir):
    """FZ1, FZ2: truncated part names against all part names, an exact similarity join."""
    names = read(spark, sf_dir, "part").select("p_name").distinct()
    cut = names.select(F.expr("substring(p_name, 1, length(p_name) - 2)").alias("a"))
    return similarity.best_matches(cut, "a", names, "p_name").filter("score < 1.0").drop("compared")


_PRODUCT_FORMS = [*vocab.ALL_PRODUCTS[:20], "integração AO login único", "Integração ao Login Unico", "Implementacao do VLibras", "eIntegração ao Login Único", "A) Adequação à LGPD"]
_PRODUCT_MATCH = f"""
c(v, o) AS (VALUES {sql.values([(v, i) for i, v in enumerate(vocab.ALL_PRODUCTS)])}), al(a, v, o) AS (VALUES {sql.values([(a, v, i) for i, (a, v) in enumerate(vocab.PRODUCT_ALIASES.items())])}),
x AS (SELECT DISTINCT {pick_sql('p_partkey', _PRODUCT_FORMS)} AS v FROM part), k AS (SELECT v, lower({sql.normalize('v')}) AS low, {sql.plain(f"lower({sql.normalize('v')})")} AS pl FROM x),
a1 AS (SELECT k.v AS value, arg_min(al.v, o) AS v, arg_min(CASE WHEN lower({sql.normalize('a')}) = low THEN 1.0 ELSE 0.98 END, o) AS s FROM k JOIN al ON {sql.plain(f"lower({sql.normalize('a')})")} = pl GROUP BY k.v),
c1 AS (SELECT k.v AS value, arg_min(c.v, o) AS v FROM k JOIN c ON {sql.plain(f"lower({sql.normalize('c.v')})")} = pl GROUP BY k.v),
m AS (SELECT k.v AS value, coalesce(a1.v, c1.v) AS canonical, CAST(coalesce(s, 1.0) AS DOUBLE) AS score FROM k LEFT JOIN a1 ON a1.value = k.v LEFT JOIN c1 ON c1.value = k.v)"""


@query(f"WITH {_PRODUCT_MATCH} SELECT p_partkey, value, canonical, score FROM part JOIN m ON m.value = {pick_sql('p_partkey', _PRODUCT_FORMS)}")
def exact_ci_match(spark, sf_dir):
    """FZ3, FZ4: products by alias in order, then equal but for case or accents."""
    rows = read(spark, sf_dir, "part").select("p_partkey", pick(F.col("p_partkey"), _PRODUCT_FORMS).alias("v"))
    m = match.match_values(rows, "v", vocab.ALL_PRODUCTS, vocab.PRODUCT_ALIASES, (1.0, 0.98), by_key=False)
    return rows.join(m, F.col("v") == F.col("value")).select("p_partkey", "value", "canonical", "score")


_AXIS_FORMS = [*vocab.AXES, "Governo Inteligente", "governaca e gestao de dados"]


def _deliveries(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        k.alias("seq"), F.col("p_brand").alias("orgao_sigla"), pick(k, _PRODUCT_FORMS).alias("produto_original"), pick(k, _AXIS_FORMS).alias("eixo_original"), F.col("p_name").alias("servico_acao"),
        (k % 11 == 0).alias("needs_review"), F.when(k % 11 == 0, "visto").alias("review_reason"), F.lit("high").alias("extraction_confidence"),
    )


_AXIS_CANON = dict(zip(_AXIS_FORMS, [*vocab.AXES, "Projetos Especiais", "Governança e Gestão de Dados"], strict=True))


@query(f"""
WITH {_PRODUCT_MATCH}, ax(f, v) AS (VALUES {sql.values(list(_AXIS_CANON.items()))}), own(p, e) AS (VALUES {sql.values(list(vocab.PRODUCT_AXIS.items()))}),
t AS (SELECT p_partkey AS seq, canonical, ax.v AS axis, own.e AS own, p_partkey % 11 = 0 AS review FROM part JOIN m ON m.value = {pick_sql('p_partkey', _PRODUCT_FORMS)}
  JOIN ax ON ax.f = {pick_sql('p_partkey', _AXIS_FORMS)} LEFT JOIN own ON own.p = canonical)
SELECT seq, canonical AS produto_normalizado, coalesce(own, axis) AS eixo_normalizado, review OR coalesce(own <> axis, false) AS needs_review,
  CASE WHEN own <> axis AND NOT review THEN 'eixo corrigido por cross-validation: ''' || axis || ''' → ''' || own || ''''
       WHEN own <> axis THEN 'visto; eixo corrigido: ''' || axis || ''' → ''' || own || '''' WHEN review THEN 'visto' END AS review_reason FROM t
""")
def cross_validate_axis(spark, sf_dir):
    """STD1: deliveries standardised; a product's own axis overrides."""
    return standardize.standardize_deliveries(_deliveries(spark, sf_dir)).select("seq", "produto_normalizado", "eixo_normalizado", "needs_review", "review_reason")


@query("SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type, user_id % 50 ORDER BY event_id) = 1 AS is_first FROM events")
def standardize_first_seen(spark, sf_dir):
    """STD2: the first row of every key."""
    rows = read(spark, sf_dir, "events").select("event_id", "event_type", F.concat_ws(":", "event_type", (F.col("user_id") % 50).cast("string")).alias("key"))
    return match.first_seen(rows, "key", "event_id").select("event_id", "event_type", "is_first")


@query(f"""
WITH RECURSIVE {_SCALE_SQL}
SELECT CASE WHEN score = 1.0 THEN 'exact' WHEN score >= 0.7 THEN 'fuzzy' ELSE 'unmatched' END AS bucket, count(*) AS n FROM orders JOIN m ON m.value = {pick_sql('o_orderkey', _LABELS)} GROUP BY 1
""")
def match_stats(spark, sf_dir):
    """STD3."""
    rows, m = _scale_match(spark, sf_dir)
    return match.match_stats(rows.join(m, F.col("v") == F.col("value")))


@query(f"""
WITH RECURSIVE {_SCALE_SQL}
SELECT {sql.normalize('value')} AS original, canonical AS normalized, CAST(score AS DOUBLE) AS score, count(*) AS count FROM orders JOIN m ON m.value = {pick_sql('o_orderkey', _LABELS)} GROUP BY ALL
""")
def vocab_report(spark, sf_dir):
    """STD4: what every key was matched to, and how often it occurs."""
    rows, m = _scale_match(spark, sf_dir)
    keyed = rows.join(m, F.col("v") == F.col("value")).withColumn("key", tx.normalize_text(F.col("v")))
    return match.vocabulary_report(keyed, "key", "canonical", "score", "o_orderkey")


@query(f"SELECT doc_id, line, length(text) < 10 AND line % 2 = 0 AS dropped FROM ({sql.lines()})")
def fragment_drop(spark, sf_dir):
    """STD5: both halves of the fragment filter."""
    rows = _lines(spark, sf_dir).select("doc_id", F.col("line").cast("long").alias("line"), F.when(F.col("line") % 2 == 0, "Outros").otherwise("x").alias("produto_normalizado"), F.col("text").alias("servico_acao"))
    kept, dropped = standardize.drop_fragments(rows)
    return kept.select("doc_id", "line", F.lit(False).alias("dropped")).unionByName(dropped.select("doc_id", "line", F.lit(True).alias("dropped")))


_P, _I = ["raro", "Provável", "baixa", "xq"], ["alto", "3", "Médio", "crítico", "yk"]
_T = ["mitigar", "Mitigar/Transferir", "aceitar ; reduzir", "compartilhar", "kx"]
_RISK_REASONS = f"""
WITH t AS (SELECT o_orderkey AS seq, {pick_sql('o_orderkey', _P)} AS p, {pick_sql('o_orderkey', _I)} AS i, {pick_sql('o_orderkey', _T)} AS t FROM orders),
f AS (SELECT *, seq = min(seq) OVER (PARTITION BY p) AS p1, seq = min(seq) OVER (PARTITION BY i) AS i1, seq = min(seq) OVER (PARTITION BY t) AS t1 FROM t),
n AS (SELECT *, (MAP {{'raro': 'raro', 'Provável': 'provável', 'baixa': 'pouco provável', 'xq': 'xq'}})[p] AS pn, (MAP {{'alto': 'alto', '3': 'médio', 'Médio': 'médio', 'crítico': 'muito alto', 'yk': 'yk'}})[i] AS inn,
  (MAP {{'mitigar': 'mitigar', 'Mitigar/Transferir': 'mitigar; transferir', 'aceitar ; reduzir': 'aceitar; mitigar', 'compartilhar': 'transferir', 'kx': 'kx'}})[t] AS tn FROM f),
r AS (SELECT *, list_filter([CASE WHEN p = 'xq' AND p1 THEN 'probabilidade não reconhecida (score: ' || '0.10)' END, CASE WHEN i = 'yk' AND i1 THEN 'impacto não reconhecido (score: 0.00)' END,
  CASE WHEN t = 'kx' AND t1 THEN 'tratamento ''kx'' não reconhecido (score: 0.00)' END, CASE WHEN contains(tn, '; ') THEN 'tratamento múltiplo/composto (''' || tn || ''')' END], lambda x: x IS NOT NULL) AS rs FROM n)"""


@query(f"""
{_RISK_REASONS}
SELECT seq, pn AS probabilidade_normalizada, inn AS impacto_normalizado, tn AS tratamento_normalizado,
  p = 'xq' OR i = 'yk' OR t = 'kx' OR contains(tn, '; ') AS needs_review, len(rs) AS n_reasons,
  CASE WHEN p = 'xq' OR i = 'yk' OR t = 'kx' THEN 'low' WHEN contains(tn, '; ') THEN 'medium' ELSE 'high' END AS extraction_confidence
FROM r
""")
def review_reasons(spark, sf_dir):
    """STD6, STD7: risks standardised, with reasons and confidence."""
    k = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(
        k.alias("seq"), pick(k, _P).alias("probabilidade_original"), pick(k, _I).alias("impacto_original"), pick(k, _T).alias("tratamento_original"),
        F.lit(False).alias("needs_review"), F.lit(None).cast("string").alias("review_reason"), F.lit("medium").alias("extraction_confidence"),
    )
    out = standardize.standardize_risks(rows)
    n = F.when(F.col("review_reason").isNull(), 0).otherwise(F.size(F.regexp_extract_all("review_reason", F.lit(r"não reconhecid|múltiplo"), F.lit(0)))).cast("long")
    return out.select("seq", "probabilidade_normalizada", "impacto_normalizado", "tratamento_normalizado", "needs_review", n.alias("n_reasons"), "extraction_confidence")


@query("""
SELECT p_type AS type, p_name AS normalized, array_to_string(list_sort(list(DISTINCT p_brand) FILTER (p_brand <> p_name)), ',') AS variants, CAST(sum(p_size) AS BIGINT) AS count FROM part GROUP BY ALL
""")
def vocab_group(spark, sf_dir):
    """VOC1: variants and counts of every canonical value."""
    rows = read(spark, sf_dir, "part").select(F.col("p_type").alias("type"), F.col("p_brand").alias("original"), F.col("p_name").alias("normalized"), F.col("p_size").cast("string").alias("count"))
    return match.read_vocabulary(rows).withColumn("variants", F.array_join("variants", ","))


# ---- harmonisation and variations ----

_FLAGS = """SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN array_to_string(x, '; ') ELSE array_to_string(x, '|') END AS v
  FROM (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_returnflag) AS x FROM lineitem GROUP BY l_orderkey)"""
_CELL = """
SELECT *, list_filter(list_transform(regexp_split_to_array(trim(v), '[;|]'), lambda x: trim(x)), lambda x: x <> '') AS ts FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 17 = 0 THEN ' nan ' ELSE v END AS v FROM f)"""
_HARMONIZED = f"""
WITH f AS ({_FLAGS}), c AS ({_CELL}),
h AS (SELECT l_orderkey, trim(v) AS v, CASE WHEN trim(v) = '' OR lower(trim(v)) = 'nan' THEN 'blank' WHEN trim(v) IN ('A', 'N') THEN 'keep' WHEN len(list_filter(ts, lambda x: x NOT IN ('A', 'N'))) > 0 THEN 'column_bleed'
  WHEN len(list_distinct(ts)) = 1 THEN 'deduplicado' ELSE 'multiplos_valores' END AS k, ts FROM c)"""


def _flags(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("x"))
    v = F.when(F.col("l_orderkey") % 2 == 0, F.array_join("x.l_returnflag", "; ")).otherwise(F.array_join("x.l_returnflag", "|"))
    return rows.select("l_orderkey", F.when(F.col("l_orderkey") % 17 == 0, " nan ").otherwise(v).alias("v"))


@query(f"{_HARMONIZED} SELECT l_orderkey, CASE k WHEN 'keep' THEN v WHEN 'deduplicado' THEN ts[1] ELSE '' END AS value, CASE WHEN k NOT IN ('keep', 'blank') THEN k END AS reason FROM h")
def harmonize_cell(spark, sf_dir):
    """HAR1 over the return flags of every order."""
    cell = harmonize.harmonize_cell(F.col("v"), ["A", "N"])
    return _flags(spark, sf_dir).select("l_orderkey", cell.value.alias("value"), cell.reason.alias("reason"))


@query(f"{_HARMONIZED} SELECT l_orderkey AS row, 'o' || (l_orderkey % 5) AS orgao, 'v' AS campo, v AS original_normalizado, CASE k WHEN 'deduplicado' THEN ts[1] ELSE '' END AS harmonizado, k AS motivo FROM h WHERE k NOT IN ('keep', 'blank')")
def harmonize_log(spark, sf_dir):
    """HAR2: the log of changes."""
    rows = _flags(spark, sf_dir).withColumns({"row": F.col("l_orderkey"), "orgao_sigla": F.concat(F.lit("o"), F.col("l_orderkey") % 5)})
    return harmonize.harmonize_table(rows, {"v": ["A", "N"]})[1]


@query(f"{_HARMONIZED} SELECT k AS motivo, count(*) AS n FROM h WHERE k NOT IN ('keep', 'blank') GROUP BY k")
def harmonize_report(spark, sf_dir):
    """HAR3."""
    return harmonize.report(harmonize_log(spark, sf_dir))


@query(f"{_HARMONIZED} SELECT l_orderkey, k IN ('column_bleed', 'multiplos_valores') AS needs_review, CASE WHEN k IN ('column_bleed', 'multiplos_valores') THEN 'harmonizacao(v:' || k || ')' END AS review_reason FROM h")
def multi_value_split(spark, sf_dir):
    """HAR2, HAR4: blanked values mark their rows; the strict schema then holds."""
    rows = _flags(spark, sf_dir).withColumns({"row": F.col("l_orderkey"), "orgao_sigla": F.lit("o")})
    return harmonize.harmonize_table(rows, {"v": ["A", "N"]})[0].select("l_orderkey", "needs_review", "review_reason")


_METHODS = ["exact", "alias", "fuzzy_high", "fuzzy_low", "unmatched", ""]
_VAR_SQL = f"""
u AS (SELECT p_brand AS orgao_sigla, 'entrega' AS entry_type, 'produto' AS field, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS original, CASE WHEN p_partkey % 5 = 0 THEN 'Outros' WHEN p_partkey % 3 = 0 THEN p_name ELSE upper(p_name) END AS normalizado,
   {pick_sql('p_partkey', _METHODS)} AS method, p_size / 50.0 AS score FROM part
  UNION ALL SELECT p_brand, 'entrega', 'eixo', p_type, p_type, {pick_sql('p_size', _METHODS)}, p_size / 50.0 FROM part),
v AS (SELECT *, CASE WHEN lower(normalizado) = 'outros' THEN 'residual' WHEN method = 'exact' THEN 'exato' WHEN method = 'alias' THEN 'alias' WHEN method = 'fuzzy_high' THEN 'aproximado'
  WHEN original = '' AND normalizado <> '' THEN 'imputado' WHEN method = 'unmatched' THEN 'residual' WHEN original = normalizado THEN 'exato' ELSE 'residual' END AS variation_type FROM u)"""


def _variations(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey")
    rows = read(spark, sf_dir, "part").select(
        F.col("p_brand").alias("orgao_sigla"), F.when(k % 7 == 0, "").otherwise(F.col("p_name")).alias("produto_original"),
        F.when(k % 5 == 0, "Outros").when(k % 3 == 0, F.col("p_name")).otherwise(F.upper("p_name")).alias("produto_normalizado"), pick(k, _METHODS).alias("produto_method"), (F.col("p_size") / 50.0).alias("produto_score"),
        F.col("p_type").alias("eixo_original"), F.col("p_type").alias("eixo_normalizado"), pick(F.col("p_size"), _METHODS).alias("eixo_method"), (F.col("p_size") / 50.0).alias("eixo_score"),
    )
    return variations.variations(rows, "entrega", variations.DELIVERY_FIELDS)


@query(f"WITH {_VAR_SQL} SELECT orgao_sigla, entry_type, field, original, normalizado, method, CAST(score AS DOUBLE) AS score, variation_type FROM v WHERE variation_type <> 'exato'")
def variations_long(spark, sf_dir):
    """VAR1, VAR2."""
    return _variations(spark, sf_dir)


@query(f"WITH {_VAR_SQL} SELECT field, variation_type, count(*) AS n FROM v WHERE variation_type <> 'exato' GROUP BY ALL")
def variations_summary(spark, sf_dir):
    """VAR3."""
    return variations.summary(_variations(spark, sf_dir))


# ---- metrics ----


@query("SELECT value, n, first FROM (SELECT c_mktsegment AS value, count(*) AS n, min(c_custkey) AS first FROM customer GROUP BY 1 ORDER BY n DESC, first LIMIT 20)")
def topn_stable(spark, sf_dir):
    """TOP1, TOP2."""
    return metrics.top(read(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey")


@query("SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY coalesce(c_mktsegment, ''), c_custkey) - 1 AS seq FROM customer")
def sorted_stable(spark, sf_dir):
    """SRT1, SRT2: rows numbered in the order of the export."""
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.coalesce("c_mktsegment", F.lit("")).alias("c_mktsegment"))
    return standardize.numbered(rows, "c_mktsegment", "c_custkey").select("c_custkey", "c_mktsegment", "seq")


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def value_distribution(spark, sf_dir):
    """AGG2."""
    return metrics.distribution(read(spark, sf_dir, "events"), "event_type")


_RATE_SQL = f"""
WITH f AS ({_FLAGS}), n AS (SELECT CASE WHEN l_orderkey % 17 = 0 THEN ' nan ' ELSE v END AS v FROM f), t AS (SELECT v, v IN ('A', 'N') AS one, len(list_filter(string_split(v, ';'), lambda x: trim(x) <> '' AND trim(x) NOT IN ('A', 'N'))) = 0 AS many FROM n),
s AS (SELECT count(*) AS total, count(*) FILTER (one) AS one_ok, count(*) FILTER (many) AS many_ok FROM t)"""


def _rates(spark, sf_dir) -> DataFrame:
    rows = _flags(spark, sf_dir)
    return metrics.canonical_rates(rows, {"one": metrics.canonical(F.col("v"), ["A", "N"]), "many": metrics.canonical(F.col("v"), ["A", "N"], several=True)})


@query(f"{_RATE_SQL} SELECT total, one_ok, CAST(round(one_ok / total, 4) AS DOUBLE) AS one_rate, many_ok, CAST(round(many_ok / total, 4) AS DOUBLE) AS many_rate FROM s")
def canon_rate(spark, sf_dir):
    """AGG4, MAT2."""
    return _rates(spark, sf_dir)


@query(f"""
{_RATE_SQL}, x(name, bound, lim) AS (VALUES ('total', 'max', 20000.0), ('one_rate', 'min', 0.85), ('many_rate', 'min', 0.1))
SELECT name, CAST(a AS DOUBLE) AS actual, bound, CAST(lim AS DOUBLE) AS "limit", CASE bound WHEN 'max' THEN a <= lim ELSE a >= lim END AS ok
FROM (SELECT x.*, CASE name WHEN 'total' THEN total WHEN 'one_rate' THEN round(one_ok / total, 4) ELSE round(many_ok / total, 4) END AS a FROM s, x)
""")
def threshold_gate(spark, sf_dir):
    """GATE1, GATE2: checks of one row of metrics."""
    return metrics.checks(_rates(spark, sf_dir), {"total": ("max", 20000.0), "one_rate": ("min", 0.85), "many_rate": ("min", 0.1)})


@query("SELECT count(*) AS total, count(*) FILTER (role = 'user') AS diretivo, count(*) FILTER (role = 'assistant') AS entregas FROM conversations")
def file_counts(spark, sf_dir):
    """AGG1, AGG5: rows by kind, whatever case and space the kind has."""
    kind = F.when(F.col("role") == "user", " Diretivo ").when(F.col("role") == "assistant", "ENTREGAS").otherwise(F.col("role"))
    return metrics.file_counts(read(spark, sf_dir, "conversations").select(kind.alias("tipo")))


def _report_tables(spark, sf_dir) -> tuple[DataFrame, ...]:
    k = F.col("o_orderkey")
    risks = read(spark, sf_dir, "orders").select(
        k.alias("seq"), pick(k, ["raro", "provável", "muito provável", "xx"]).alias("probabilidade_normalizada"), F.col("o_orderpriority").alias("impacto_normalizado"),
        pick(k, ["mitigar", "Mitigar; Evitar", "Aceitar"]).alias("tratamento_normalizado"), (k % 9 == 0).alias("needs_review"),
    )
    deliveries = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("produto_normalizado"), F.col("p_type").alias("eixo_normalizado"), F.lit(False).alias("needs_review"))
    return read(spark, sf_dir, "nation"), deliveries, risks, read(spark, sf_dir, "region")


@query("""
SELECT (SELECT count(*) FROM nation) AS organs, (SELECT count(*) FROM part) AS deliveries, (SELECT count(*) FROM orders) AS risks, (SELECT count(*) FROM orders WHERE o_orderkey % 9 = 0) AS risks_review,
  CAST((SELECT round(count(*) FILTER (o_orderkey % 4 < 3) / count(*), 4) FROM orders) AS DOUBLE) AS probability_rate, (SELECT count(*) FROM part) <= 100 * (SELECT count(*) FROM nation) AS deliveries_ok,
  (SELECT first(p_name ORDER BY n DESC, f) FROM (SELECT p_name, count(*) AS n, min(p_partkey) AS f FROM part GROUP BY 1)) AS top_product
""")
def validation_report(spark, sf_dir):
    """RPT1: the nested report, some of its values."""
    r = metrics.validation_report(*_report_tables(spark, sf_dir))
    return r.select(
        F.col("organs.n").alias("organs"), F.col("deliveries.n").alias("deliveries"), F.col("risks.n").alias("risks"), F.col("risks.review").alias("risks_review"),
        F.col("canonical.probability_rate").alias("probability_rate"), F.col("checks.deliveries").alias("deliveries_ok"), F.get("top_produto_normalizado", F.lit(0))["value"].alias("top_product"),
    )


_ON_SCALE_SQL = {
    "probabilidade_normalizada": f"value IN ({', '.join(map(sql.quoted, vocab.PROBABILITY))})", "impacto_normalizado": f"value IN ({', '.join(map(sql.quoted, vocab.IMPACT))})",
    "tratamento_normalizado": f"len(list_filter(string_split(value, ';'), lambda x: trim(x) <> '' AND NOT list_contains({sql.array(vocab.TREATMENT)}, trim(x)))) = 0",
}
_IS_CANONICAL = "CASE field " + " ".join(f"WHEN '{f}' THEN coalesce({x}, false)" for f, x in _ON_SCALE_SQL.items()) + " END"


@query(f"""
WITH r AS (SELECT o_orderkey AS k, {pick_sql('o_orderkey', ["raro", "provável", "muito provável", "xx"])} AS p, o_orderpriority AS i, {pick_sql('o_orderkey', ["mitigar", "Mitigar; Evitar", "Aceitar"])} AS t FROM orders),
v AS (SELECT 'probabilidade_normalizada' AS field, p AS value, k FROM r UNION ALL SELECT 'impacto_normalizado', i, k FROM r UNION ALL SELECT 'tratamento_normalizado', t, k FROM r
      UNION ALL SELECT 'produto_normalizado', p_name, p_partkey FROM part UNION ALL SELECT 'eixo_normalizado', p_type, p_partkey FROM part),
c AS (SELECT field, value, count(*) AS n, min(k) AS f FROM v GROUP BY 1, 2),
l AS (SELECT 'top' AS section, * FROM c UNION ALL SELECT 'non_canonical_top', * FROM c WHERE {_IS_CANONICAL} = false),
ranked AS (SELECT *, row_number() OVER (PARTITION BY section, field ORDER BY n DESC, f, value) AS rank FROM l),
ok AS (SELECT field, sum(CASE WHEN {_IS_CANONICAL} THEN n ELSE 0 END) AS n, sum(n) AS total FROM c WHERE field IN ({', '.join(map(sql.quoted, _ON_SCALE_SQL))}) GROUP BY 1),
w AS (SELECT (SELECT count(*) FROM nation) AS o, (SELECT count(*) FROM part) AS d, (SELECT count(*) FROM orders) AS r)
SELECT 'distributions' AS section, field, value AS name, NULL::INT AS rank, n::BIGINT AS n, NULL::DOUBLE AS rate, NULL::BOOLEAN AS passed FROM c
UNION ALL SELECT section, field, value, rank::INT, n::BIGINT, NULL, NULL FROM ranked WHERE rank <= 20
UNION ALL SELECT 'canonization', field, 'ok', NULL, n::BIGINT, round(n / total, 4), NULL FROM ok
UNION ALL SELECT 'counts', 'organs', 'rows', NULL, o, NULL, NULL FROM w UNION ALL SELECT 'counts', 'deliveries', 'rows', NULL, d, NULL, NULL FROM w UNION ALL SELECT 'counts', 'risks', 'rows', NULL, r, NULL, NULL FROM w
UNION ALL SELECT 'counts', 'errors', 'rows', NULL, count(*), NULL, NULL FROM region UNION ALL SELECT 'counts', 'deliveries', 'review', NULL, 0, NULL, NULL
UNION ALL SELECT 'counts', 'risks', 'review', NULL, count(*), NULL, NULL FROM orders WHERE o_orderkey % 9 = 0
UNION ALL SELECT 'thresholds', '', 'deliveries', NULL, NULL, d, d <= {vocab.LIMITS["deliveries_per_group"]} * o FROM w UNION ALL SELECT 'thresholds', '', 'risks', NULL, NULL, r, r <= {vocab.LIMITS["risks_per_group"]} * o FROM w
UNION ALL SELECT 'thresholds', '', CASE field WHEN 'probabilidade_normalizada' THEN 'probability' WHEN 'impacto_normalizado' THEN 'impact' ELSE 'treatment' END, NULL, NULL, round(n / total, 4),
  round(n / total, 4) >= CASE field WHEN 'probabilidade_normalizada' THEN {vocab.LIMITS["probability_share"]} WHEN 'impacto_normalizado' THEN {vocab.LIMITS["impact_share"]} ELSE {vocab.LIMITS["treatment_share"]} END FROM ok
""")
def report_values(spark, sf_dir):
    """RPT1: every value of the report, distributions, lists, rates and thresholds, of one grouped pass."""
    return metrics.report_rows(metrics.value_counts(*_report_tables(spark, sf_dir)))


@query("""
WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS orgao_sigla, coalesce(lang, '?') AS document_type, 'doc:' || doc_id AS url, '2025-01-01T00:00:00' AS "timestamp", coalesce(text, '') AS t, n_chars, source, lang FROM documents),
e AS (
  SELECT *, 1 AS o, 'download' AS stage, 'empty_document' AS error_type, 'no text' AS error_message FROM d WHERE trim(t) = ''
  UNION ALL SELECT *, 2, 'download', 'small_document', length(t) || ' characters' FROM d WHERE length(t) < 200 AND trim(t) <> ''
  UNION ALL SELECT *, 3, 'extraction', 'length_mismatch', length(t) || ' <> ' || n_chars FROM d WHERE length(t) >= 200 AND trim(t) <> '' AND length(t) <> n_chars
  UNION ALL SELECT *, 4, 'extraction', 'no_heading', 'one line' FROM d WHERE length(t) >= 200 AND trim(t) <> '' AND NOT contains(t, chr(10))
  UNION ALL SELECT *, 5, 'standardization', 'foreign', lang FROM d WHERE length(t) >= 200 AND trim(t) <> '' AND contains(t, chr(10)) AND lang <> 'en'
)
SELECT orgao_sigla, document_type, stage, error_type, error_message, "timestamp", url FROM e
""")
def error_table(spark, sf_dir):
    """ERR1: errors of three stages and five kinds, in one table, of one scan."""
    t = F.coalesce("text", F.lit(""))
    checks = [
        errors.Check("download", "empty_document", F.trim(t) == "", F.lit("no text")),
        errors.Check("download", "small_document", F.length(t) < 200, F.concat(F.length(t), F.lit(" characters"))),
        errors.Check("extraction", "length_mismatch", F.length(t) != F.col("n_chars"), F.concat(F.length(t), F.lit(" <> "), F.col("n_chars")), fatal=False),
        errors.Check("extraction", "no_heading", ~F.contains(t, F.lit("\n")), F.lit("one line")),
        errors.Check("standardization", "foreign", F.col("lang") != "en", F.col("lang"), fatal=False),
    ]
    key = F.col("doc_id").cast("string")
    return errors.channel(read(spark, sf_dir, "documents"), checks, key, F.coalesce("lang", F.lit("?")), F.lit("2025-01-01T00:00:00"), F.concat(F.lit("doc:"), key))[1]
