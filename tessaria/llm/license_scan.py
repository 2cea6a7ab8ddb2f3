"""License scans by ordered signature rules, in DataFrame functions only.

A document that the rules' common gate does not let through is read once, for its number of
words. In the others each place of a keyword is an anchor: only the rules of that keyword are tried, on the
next words. What they find has a span of words, a priority and a label. A detection inside
another of the same or a higher priority is suppressed; the base phrases always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaria.llm.common import LOWER, UPPER, ascii_lower, no_clash, table, text_of
from tessaria.llm.license_rules import BASE, REACH, gate, rules

#: Words are runs of these; all else separates.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The score of a document's best detection, by priority.
WEIGHTS = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.5}


def _keywords() -> list[str]:
    return sorted({r[3] for r in rules()})


def _by_keyword() -> Column:
    """A constant map: keyword to its rules in order."""
    groups: dict[str, list] = {}
    for _, label, priority, word, pattern in rules():
        groups.setdefault(word, []).append(F.struct(F.lit(label).alias("label"), F.lit(priority).alias("priority"), F.lit(pattern).alias("pattern")))
    return F.create_map(*[x for word, rs in sorted(groups.items()) for x in (F.lit(word), F.array(*rs))])


def _words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), BREAK), lambda w: w != "")


def _detections(words: Column, table: Column) -> Column:
    """The spans that rules find, as array<struct<start,end,priority,label>>, ends exclusive."""
    anchors = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda x: x.word.isin(_keywords()))

    def at(x: Column) -> Column:
        context = F.array_join(F.slice(words, x["at"] + 1, REACH), " ")
        found = F.filter(F.element_at(table, x.word), lambda r: F.regexp_like(context, r.pattern))
        return F.transform(
            found,
            lambda r: F.struct(
                x["at"].alias("start"),
                (x["at"] + F.size(F.split(F.rtrim(F.regexp_substr(context, r.pattern)), " "))).alias("end"),
                r.priority.alias("priority"),
                r.label.alias("label"),
            ),
        )

    return F.flatten(F.transform(anchors, at))


def _standing(found: Column) -> Column:
    """The labels that containment leaves, with their priorities.

    In order of start, the longer first, a detection lies in an earlier one exactly if it ends no
    later than the furthest end so far; one running end is kept for each priority.
    """
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(d.start.alias("start"), (-d.end).alias("back"), d.priority.alias("priority"), d.label.alias("label"))))
    kinds = sorted(WEIGHTS)
    nothing = F.array().cast("array<struct<label:string,priority:int>>")

    def step(acc: Column, d: Column) -> Column:
        inside = F.lit(False)
        for p in kinds:
            inside = inside | ((d.priority >= p) & (acc[f"e{p}"] >= -d.back))
        return F.struct(
            *[F.when(d.priority == p, F.greatest(acc[f"e{p}"], -d.back)).otherwise(acc[f"e{p}"]).alias(f"e{p}") for p in kinds],
            F.when(inside, acc.labels).otherwise(F.array_union(acc.labels, F.array(F.struct(d.label.alias("label"), d.priority.alias("priority"))))).alias("labels"),
        )

    return F.aggregate(ordered, F.struct(*[F.lit(0).alias(f"e{p}") for p in kinds], nothing.alias("labels")), step, lambda acc: acc.labels)


def _base_places(words: Column) -> Column:
    """array<struct<at,label>> of the places where a base phrase's words stand consecutively."""
    def hit(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for label, phrase in BASE:
            parts = phrase.split(" ")
            same = F.lit(True)
            for j, part in enumerate(parts):
                same = same & (F.get(words, i + j) == part)
            out = F.when(same, F.lit(label)).otherwise(out)
        return out

    firsts = sorted({p.split(" ")[0] for _, p in BASE})
    starts = F.filter(F.transform(words, lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())
    return F.filter(F.transform(starts, lambda i: F.struct(i.alias("at"), hit(i).alias("label"))), lambda x: x.label.isNotNull())


def scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with n_words, n_base, first_word, last_word, base_labels, labels and score.

    Null and empty texts have no words and no labels, and score 0. A column of ``df`` that has one
    of the result's names is replaced; all others stay. Rows that repeat are scanned alike.
    """
    n = no_clash(df, "words", "found", "base", "left")
    text = text_of(text_col)
    has = F.regexp_like(text, F.lit(gate()))
    words = F.when(has, _words(text))
    rows = df.withColumns({n["words"]: words, "n_words": F.when(has, F.lit(None)).otherwise(F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))})
    rows = rows.withColumns({n["found"]: _detections(F.col(n["words"]), _by_keyword()), n["base"]: _base_places(F.col(n["words"]))})
    rows = rows.withColumn(n["left"], _standing(F.col(n["found"])))
    base_labels = F.array_distinct(F.transform(F.coalesce(n["base"], F.array().cast("array<struct<at:int,label:string>>")), lambda x: x.label))
    left = F.coalesce(F.col(n["left"]), F.array().cast("array<struct<label:string,priority:int>>"))
    best = F.array_min(F.transform(left, lambda x: x.priority))
    score = F.lit(0.0)
    for p, w in sorted(WEIGHTS.items(), reverse=True):
        score = F.when(best == p, F.lit(w)).otherwise(score)
    return rows.withColumns(
        {
            "n_words": F.coalesce("n_words", F.size(n["words"]), F.lit(0)).cast("long"),
            "n_base": F.coalesce(F.size(n["base"]), F.lit(0)).cast("long"),
            "first_word": F.array_min(F.transform(n["base"], lambda x: x["at"])).cast("long"),
            "last_word": F.array_max(F.transform(n["base"], lambda x: x["at"])).cast("long"),
            "base_labels": F.array_join(F.array_sort(base_labels), ","),
            "labels": F.array_join(F.array_sort(F.array_union(base_labels, F.transform(left, lambda x: x.label))), ","),
            "score": F.greatest(score, F.when(F.size(n["base"]) > 0, F.lit(WEIGHTS[2])).otherwise(F.lit(0.0))),
        }
    ).drop(*n.values())


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every document."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _values() -> str:
    return ", ".join(f"('{label}', {priority}, '{word}', '{pattern}')" for _, label, priority, word, pattern in rules())


SQL = f"""
WITH r(label, priority, keyword, pattern) AS (VALUES {_values()}),
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), t AS (
  SELECT doc_id, words, unnest(range(len(words))) AS i FROM w
), b AS (
  SELECT doc_id, i, CASE
    WHEN words[i + 1] = 'mit' AND words[i + 2] = 'license' THEN 'mit'
    WHEN words[i + 1] = 'apache' AND words[i + 2] = 'license' THEN 'apache'
    WHEN words[i + 1] = 'general' AND words[i + 2] = 'public' AND words[i + 3] = 'license' THEN 'gpl' END AS label
  FROM t
), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS ls FROM b WHERE label IS NOT NULL GROUP BY doc_id
), c AS (
  SELECT doc_id, i, words[i + 1] AS word, array_to_string(words[i + 1 : i + {REACH}], ' ') AS context FROM t
), f AS (
  SELECT doc_id, i AS s, i + len(string_split(rtrim(regexp_extract(context, pattern)), ' ')) AS e, priority, label
  FROM c JOIN r ON c.word = r.keyword WHERE regexp_matches(context, pattern)
), kept AS (
  SELECT x.doc_id, x.label, x.priority FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s, e DESC, priority, label) AS n FROM f) x
  WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s, e DESC, priority, label) AS n FROM f) y
    WHERE y.doc_id = x.doc_id AND y.n < x.n AND y.e >= x.e AND y.priority <= x.priority)
), lab AS (
  SELECT doc_id, list(DISTINCT label) AS ls, min(priority) AS best FROM kept GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.ls), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(lab.ls, [])))), ','), '') AS labels,
       CAST(greatest(CASE best WHEN 1 THEN 1.0 WHEN 2 THEN 0.9 WHEN 3 THEN 0.7 WHEN 4 THEN 0.5 ELSE 0.0 END,
                     CASE WHEN n_base > 0 THEN 0.9 ELSE 0.0 END) AS DOUBLE) AS score
FROM w LEFT JOIN base ON base.doc_id = w.doc_id LEFT JOIN lab ON lab.doc_id = w.doc_id
"""
