"""Personal data: base identifiers, and terms that disclose them, in DataFrame functions only.

Base identifiers (emails, addresses, cards, phones) are protected entities. A term that stands
near an entity discloses it if it carries most of the entity's information: with document counts
over the whole corpus, PMI(t, e) = log(N * C(t, e) / (C(t) * C(e))) is at most IC(e) = log(N / C(e)),
and reaches it when t occurs only with e. C(t, e) counts the documents in which t stands within
``REACH`` characters of e (whole documents would make every rare word of a copied document
disclose the addresses in it); a term needs a support of two of these. It is removed from a share
of ``REMOVE`` on and generalised from ``GENERALISE`` on, at every place in every document that
holds the entity.

Positions come from a text's pieces between matches. Texts are read twice: for identifiers with
the words around them, and for the document counts of the terms that have the support.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaria.llm.common import LOWER, UPPER, ascii_lower, named_columns, numbered_columns, stored, table, text_of

KINDS = ("email", "ip", "card", "phone")
#: Java patterns: possessive, so they neither backtrack nor recurse, and anchored so that no start is tried inside a run; they find the same as SQL_PATTERNS.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of the gate holds no such identifier.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
OCTET = r"^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])){3}$"
#: Characters of context on either side, words, and what a term has: a letter, two characters besides trailing full stops, and no "@".
REACH, TOKEN, LETTER, SHORTEST = 48, r"[\p{L}\p{N}_.@%+\-]+", r"\p{L}", 2
SUPPORT, REMOVE, GENERALISE = 2, 0.9, 0.7
#: Terms whose document counts are looked up through a broadcast; with more, all terms are counted and joined.
BROADCAST_TERMS = 200_000
CHUNK = 256


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<s,e,v>>: leftmost non-overlapping matches with code point positions, ends exclusive.

    The running position goes over chunks, so many matches cost no quadratic copying.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    both = F.zip_with(between, found, lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("n"), b.alias("v")))
    chunks = F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(both) - 1) / CHUNK).cast("int")), lambda c: F.slice(both, c * CHUNK + 1, F.lit(CHUNK)))
    chunks = F.when(F.size(found) > 0, chunks).otherwise(F.array().cast("array<array<struct<gap:int,n:int,v:string>>>"))
    span = "struct<s:int,e:int,v:string>"

    def place(at: Column, chunk: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            s = acc.pos + x.gap
            return F.struct((s + x.n).alias("pos"), F.concat(acc.out, F.array(F.struct(s.alias("s"), (s + x.n).alias("e"), x.v.alias("v")))).alias("out"))

        return F.aggregate(chunk, F.struct(at.alias("pos"), F.array().cast(f"array<{span}>").alias("out")), step, lambda acc: acc.out)

    def over(acc: Column, chunk: Column) -> Column:
        return F.struct(
            (acc.pos + F.aggregate(chunk, F.lit(0), lambda n, x: n + x.gap + x.n)).alias("pos"),
            F.concat(acc.out, F.array(place(acc.pos, chunk))).alias("out"),
        )

    return F.flatten(F.aggregate(chunks, F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<array<{span}>>").alias("out")), over, lambda acc: acc.out))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass: every second from the right is doubled, less 9 above 9."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return F.regexp_like(v, F.lit(OCTET))
    if kind == "card":
        return F.length(_digits(v)).between(14, 19) & _luhn(_digits(v))
    if kind == "phone":
        return F.length(_digits(v)).between(10, 15)
    return F.lit(True)


def _entity(kind: str, v: Column) -> Column:
    """What is protected: one value, however it is written."""
    return F.concat(F.lit(kind + ":"), ascii_lower(v) if kind in ("email", "ip") else _digits(v))


def _kind_spans(text: Column, kind: str) -> Column:
    """array<struct<s,rank,kind,e,entity>> of the valid matches of a kind."""
    valid = F.filter(_matches(text, PATTERNS[kind]), lambda x: _valid(kind, x.v))
    rank = F.lit(KINDS.index(kind)).alias("rank")
    spans = F.transform(valid, lambda x: F.struct(x.s.alias("s"), rank, F.lit(kind).alias("kind"), x.e.alias("e"), _entity(kind, x.v).alias("entity")))
    has = F.contains(text, F.lit("@")) if kind == "email" else F.regexp_like(text, F.lit(GATES[kind]))
    return F.when(has, spans).otherwise(F.array().cast("array<struct<s:int,rank:int,kind:string,e:int,entity:string>>"))


def _is_term(v: Column) -> Column:
    return F.regexp_like(v, F.lit(LETTER)) & ~F.contains(v, F.lit("@")) & (F.length(F.rtrim(v, F.lit("."))) >= SHORTEST)


def _term(v: Column) -> Column:
    return F.rtrim(ascii_lower(v), F.lit("."))


def _context(text: Column, base: Column) -> Column:
    """array<struct<entity,term>>: the terms near each span; a word that the reach cuts does not count."""

    def words(entity: Column, start: Column, n: Column, cut_left: Column, cut_right: Column) -> Column:
        tokens = F.filter(_matches(F.substring(text, start + 1, n), TOKEN), lambda w: _is_term(w.v) & ~(cut_left & (w.s == 0)) & ~(cut_right & (w.e == n)))
        return F.transform(tokens, lambda w: F.struct(entity.alias("entity"), _term(w.v).alias("term")))

    def near(x: Column) -> Column:
        left = F.greatest(x.s - REACH, F.lit(0))
        n = F.least(F.length(text) - x.e, F.lit(REACH))
        return F.concat(words(x.entity, left, x.s - left, left > 0, F.lit(False)), words(x.entity, x.e, n, F.lit(False), x.e + n < F.length(text)))

    return F.array_distinct(F.flatten(F.transform(base, near)))


def _words(text: Column) -> Column:
    """The different words of a text, as terms are written."""
    return F.array_distinct(F.transform(F.regexp_extract_all(ascii_lower(text), F.lit(TOKEN), F.lit(0)), lambda w: F.rtrim(w, F.lit("."))))


def _places(text: Column, marks: Column) -> Column:
    """array<struct<s,rank,kind,e,treatment>>: all places of the terms in the map ``marks``, in order."""
    found = F.filter(_matches(text, TOKEN), lambda w: _is_term(w.v) & F.map_contains_key(marks, _term(w.v)))
    return F.transform(found, lambda w: F.struct(w.s.alias("s"), F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), (w.s + F.length(F.rtrim(w.v, F.lit(".")))).alias("e"), F.element_at(marks, _term(w.v)).alias("treatment")))


def _joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, of array<struct<s,rank,kind,e>> by start, then kind."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x.kind, x.s, x.e)), ",")


def _term_counts(df: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """(term, t_docs): in how many documents each of ``terms`` is a word, over all documents."""
    each = df.select(F.explode(_words(text_of(text_col))).alias("term"))
    if terms.count() <= BROADCAST_TERMS:
        return each.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("t_docs"))
    return each.groupBy("term").agg(F.count("*").alias("t_docs")).join(terms, "term", "left_semi")


NOTHING = "array<struct<s:int,rank:int,kind:string,e:int,treatment:string>>"
OWN = ("n_email", "n_ip", "n_card", "n_phone", "base", "terms")


def _found(df: DataFrame, text_col: str) -> DataFrame:
    """The ``numbered_columns`` of ``df`` and those of ``OWN``."""
    own, text = [f"r{i}" for i in range(len(df.columns))], F.coalesce(F.col(f"r{df.columns.index(text_col)}"), F.lit(""))
    rows = df.select(*numbered_columns(df), F.monotonically_increasing_id().alias("nr"))
    rows = rows.select("*", *[_kind_spans(text, k).alias(k) for k in KINDS])
    rows = rows.select(*own, "nr", F.array_sort(F.concat(*KINDS)).alias("base"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS])
    rows = stored(rows.withColumn("context", F.when(F.size("base") > 0, _context(text, F.col("base")))), "identifiers")
    entities = F.array_distinct(F.transform("base", lambda x: x.entity))
    context = rows.select(F.explode("context").alias("c")).select("c.*")  # each once a document
    pairs = stored(context.groupBy("entity", "term").agg(F.count("*").alias("both")).filter(F.col("both") >= SUPPORT), "pairs")
    holders = rows.select("nr", F.explode(entities).alias("entity"))
    counts = holders.groupBy("entity").agg(F.count("*").alias("e_docs"))
    total = rows.agg(F.count("*").alias("docs"))  # one row
    share = F.ln(F.col("docs") * F.col("both") / (F.col("t_docs") * F.col("e_docs"))) / F.ln(F.col("docs") / F.col("e_docs"))
    telling = stored(
        pairs.join(_term_counts(df, text_col, pairs.select("term").distinct()), "term")
        .join(counts, "entity")
        .join(F.broadcast(total))
        .filter(F.col("docs") > F.col("e_docs"))
        .withColumn("share", share)
        .filter(F.col("share") >= GENERALISE)
        .select("entity", "term", F.when(F.col("share") >= REMOVE, F.lit("remove")).otherwise(F.lit("generalise")).alias("treatment")),
        "telling",
    )
    few = telling.count() <= BROADCAST_TERMS
    # from a document's words to what they tell of, then only to what it holds: an entity that many documents hold is never joined by itself
    words = rows.filter(F.size("base") > 0).select("nr", F.explode(_words(text)).alias("term"))
    told = words.join(F.broadcast(telling) if few else telling, "term").join(holders, ["nr", "entity"])
    marks = told.groupBy("nr", "term").agg(F.max("treatment").alias("treatment")).groupBy(F.col("nr").alias("m_nr")).agg(F.map_from_entries(F.collect_list(F.struct("term", "treatment"))).alias("marks"))
    none = F.array().cast(NOTHING)
    # texts without an identifier hold no term, and are not shuffled
    placed = rows.filter(F.size("base") > 0).join(marks, F.col("nr") == F.col("m_nr"), "left")
    placed = placed.select(*own, *OWN[:-1], F.when(F.col("marks").isNull(), none).otherwise(_places(text, F.col("marks"))).alias("terms"))
    return placed.unionByName(rows.filter(F.size("base") == 0).select(*own, *OWN[:-1], none.alias("terms")))


def _with_row(df: DataFrame, found: DataFrame, *more: Column) -> DataFrame:
    return found.select(*[c for c, name in zip(named_columns(df), df.columns, strict=True) if name.lower() not in OWN], *OWN, *more)


def find(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with n_email, n_ip, n_card, n_phone, base (spans), terms (spans with their treatment).

    Spans are structs (s, rank, kind, e) in code points, ends exclusive. Null and empty texts have
    none; very long ones are searched whole. Repeated rows are documents of their own. A column of
    ``df`` that has one of the result's names is replaced; all others stay. An empty table gives an
    empty result.
    """
    return _with_row(df, _found(df, text_col))


def sanitise(df: DataFrame, text_col: str = "text", out_col: str = "sanitised") -> DataFrame:
    """``find`` with the text in which identifiers and removed terms are replaced by their kind, generalised terms by their first letter."""
    found, text = _found(df, text_col), F.coalesce(F.col(f"r{df.columns.index(text_col)}"), F.lit(""))
    mark = "struct<s:int,e:int,put:string>"
    base = F.transform("base", lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), F.concat(F.lit("["), x.kind, F.lit("]")).alias("put")))
    terms = F.transform("terms", lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), F.when(x.treatment == "remove", F.lit("[term]")).otherwise(F.concat(F.substring(text, x.s + 1, F.lit(1)), F.lit("."))).alias("put")))
    marks = F.array_sort(F.concat(base, terms)).cast(f"array<{mark}>")

    def step(acc: Column, x: Column) -> Column:
        inside = x.s < acc.pos
        return F.struct(F.greatest(acc.pos, x.e).alias("pos"), F.when(inside, acc.out).otherwise(F.concat(acc.out, F.substring(text, acc.pos + 1, x.s - acc.pos), x.put)).alias("out"))

    built = F.aggregate(marks, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step, lambda acc: F.concat(acc.out, F.substring(text, acc.pos + 1, F.length(text))))
    out = _with_row(df, found, built.alias("sanitised_text"))
    return out.select(*[c for c in out.columns[:-1] if c != out_col], F.col("sanitised_text").alias(out_col))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers and disclosing terms of every document."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    short = lambda c: F.transform(c, lambda x: F.struct(x.s.alias("s"), x["rank"].alias("rank"), x.kind.alias("kind"), x.e.alias("e")))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(_joined(short("base")), 256).alias("base_sha256"), _joined(F.concat(short("base"), short("terms"))).alias("spans"))


def _sql_kind(rank: int, kind: str, where: str) -> str:
    p = SQL_PATTERNS[kind]
    return f"""
  SELECT rid, {rank} AS rank, '{kind}' AS kind, e - length(v) AS s, e, v FROM (
    SELECT rid, v, CAST(sum(gap + length(v)) OVER (PARTITION BY rid ORDER BY i) AS BIGINT) AS e FROM (
      SELECT rid, unnest(regexp_extract_all(t, '{p}')) AS v,
             unnest(list_transform(regexp_split_to_array(t, '{p}')[1:len(regexp_extract_all(t, '{p}'))], lambda x: length(x))) AS gap,
             unnest(range(len(regexp_extract_all(t, '{p}')))) AS i
      FROM d)) WHERE {where}"""


_D = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(length({_D})), lambda i: CASE WHEN i % 2 = 0 THEN CAST(reverse({_D})[i + 1] AS INT) WHEN CAST(reverse({_D})[i + 1] AS INT) > 4 THEN 2 * CAST(reverse({_D})[i + 1] AS INT) - 9 ELSE 2 * CAST(reverse({_D})[i + 1] AS INT) END)) % 10 = 0"
_WHERE = {"email": "true", "ip": f"regexp_matches(v, '{OCTET}')", "card": f"length({_D}) BETWEEN 14 AND 19 AND {_LUHN}", "phone": f"length({_D}) BETWEEN 10 AND 15"}
_IS_TERM = f"regexp_matches(v, '{LETTER}') AND NOT contains(v, '@') AND length(rtrim(v, '.')) >= {SHORTEST}"
_LOWERED = f"translate(%s, '{UPPER}', '{LOWER}')"

SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
b AS MATERIALIZED ({" UNION ALL ".join(_sql_kind(i, k, _WHERE[k]) for i, k in enumerate(KINDS))}),
ent AS MATERIALIZED (
  SELECT rid, s, e, kind || ':' || CASE WHEN kind IN ('email', 'ip') THEN {_LOWERED % "v"} ELSE {_D} END AS entity FROM b
), win AS (
  SELECT rid, entity, greatest(s - {REACH}, 0) AS p0, s - greatest(s - {REACH}, 0) AS n, s > {REACH} AS cl, false AS cr FROM ent
  UNION ALL
  SELECT ent.rid, entity, e, least(length(t) - e, {REACH}), false, e + {REACH} < length(t) FROM ent JOIN d USING (rid)
), part AS (
  SELECT rid, entity, p0, n, cl, cr, substring(t, CAST(p0 + 1 AS BIGINT), CAST(n AS BIGINT)) AS p FROM win JOIN d USING (rid)
), tok AS (
  SELECT row_number() OVER () AS pid, rid, entity, p0, n, cl, cr, regexp_extract_all(p, '{TOKEN}') AS vs, regexp_split_to_array(p, '{TOKEN}') AS gs FROM part
), tok2 AS (
  SELECT pid, rid, entity, p0, n, cl, cr, unnest(vs) AS v, unnest(list_transform(gs[1:len(vs)], lambda x: length(x))) AS gap, unnest(range(len(vs))) AS i FROM tok
), tok3 AS (
  SELECT rid, entity, p0, n, cl, cr, v, CAST(sum(gap + length(v)) OVER (PARTITION BY pid ORDER BY i) AS BIGINT) AS te FROM tok2
), ctx AS MATERIALIZED (
  SELECT DISTINCT rid, entity, rtrim({_LOWERED % "v"}, '.') AS term
  FROM tok3 WHERE {_IS_TERM} AND NOT (cl AND te = length(v)) AND NOT (cr AND te = n)
), pr AS (
  SELECT entity, term, count(*) AS both_n FROM ctx GROUP BY ALL HAVING count(*) >= {SUPPORT}
), td AS (
  SELECT term, count(*) AS t_docs FROM (
    SELECT DISTINCT rid, rtrim(unnest(regexp_extract_all({_LOWERED % "t"}, '{TOKEN}')), '.') AS term FROM d) WHERE term IN (SELECT term FROM pr) GROUP BY term
), ed AS (
  SELECT entity, count(DISTINCT rid) AS e_docs FROM ent GROUP BY entity
), tell AS (
  SELECT entity, term FROM pr JOIN td USING (term) JOIN ed USING (entity), (SELECT count(*) AS docs FROM d)
  WHERE docs > e_docs AND ln(docs * both_n / (t_docs * e_docs)) / ln(docs / e_docs) >= {GENERALISE}
), whole AS (
  SELECT rid, regexp_extract_all(t, '{TOKEN}') AS vs, regexp_split_to_array(t, '{TOKEN}') AS gs FROM d WHERE rid IN (SELECT rid FROM ent)
), whole2 AS (
  SELECT rid, unnest(vs) AS v, unnest(list_transform(gs[1:len(vs)], lambda x: length(x))) AS gap, unnest(range(len(vs))) AS i FROM whole
), whole3 AS (
  SELECT rid, v, rtrim({_LOWERED % "v"}, '.') AS term, CAST(sum(gap + length(v)) OVER (PARTITION BY rid ORDER BY i) AS BIGINT) - length(v) AS s FROM whole2
), sp AS (
  SELECT rid, rank, kind, s, e FROM b
  UNION ALL
  SELECT rid, {len(KINDS)}, 'term', s, s + length(rtrim(v, '.')) FROM whole3
  WHERE {_IS_TERM} AND (rid, term) IN (SELECT rid, term FROM ent JOIN tell USING (entity))
), agg AS (
  SELECT rid, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (rank < {len(KINDS)}) AS base
  FROM sp GROUP BY rid
)
SELECT d.doc_id,
       (SELECT count(*) FROM b WHERE b.rid = d.rid AND kind = 'email') AS n_email,
       (SELECT count(*) FROM b WHERE b.rid = d.rid AND kind = 'ip') AS n_ip,
       (SELECT count(*) FROM b WHERE b.rid = d.rid AND kind = 'card') AS n_card,
       (SELECT count(*) FROM b WHERE b.rid = d.rid AND kind = 'phone') AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg ON agg.rid = d.rid
"""
