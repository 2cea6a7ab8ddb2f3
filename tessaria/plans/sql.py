"""Fragments of DuckDB SQL that say what the column functions say."""

from __future__ import annotations

import unicodedata

from tessaria.functions import text as tx


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    """Rows of a VALUES list."""
    return ", ".join("(" + ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def array(items: list[str]) -> str:
    return "[" + ", ".join(map(quoted, items)) + "]"


def normalize(x: str) -> str:
    return rf"regexp_replace(trim(regexp_replace(coalesce({x}, ''), '\s+', ' ', 'g')), '^[A-Za-z0-9]{{1,3}}\s*[).\-]\s+', '')"


def bare(s: str) -> str:
    """NFKD without combining characters, as the standard library has it."""
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def plain(x: str) -> str:
    one = {c: bare(c) for c in map(chr, range(0xA0, 0x250)) if len(bare(c)) == 1 and bare(c) != c}
    out = f"translate({x}, {quoted(''.join(one))}, {quoted(''.join(one.values()))})"
    return out


def key(x: str) -> str:
    return plain(f"trim(lower({normalize(x)}))")


def header(x: str) -> str:
    return plain(f"replace(lower({normalize(x)}), '- ', '')")


def lines(docs: str = "documents", key_col: str = "doc_id") -> str:
    """(key, line, text) of the lines that are not blank."""
    stripped = "list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    return f"SELECT {key_col}, unnest(range(len(ls))) AS line, unnest(ls) AS text FROM (SELECT {key_col}, {stripped} AS ls FROM {docs})"


def hits(x: str, words: list[str]) -> str:
    return f"len(list_filter({array(words)}, lambda w: contains({x}, w)))"


def method(value: str, score: str, alias: str = "false") -> str:
    return (
        f"CASE WHEN coalesce({value}, '') = '' OR {score} <= 0 THEN 'unmatched' WHEN {score} >= 0.999 THEN 'exact' WHEN {alias} THEN 'alias' "
        f"WHEN {score} >= 0.85 THEN 'fuzzy_high' WHEN {score} >= 0.70 THEN 'fuzzy_low' ELSE 'unmatched' END"
    )


def ratio(values_sql: str, candidates_sql: str, name: str = "r") -> str:
    """CTEs ending with {name}(a0, b0, r): the Ratcliff-Obershelp ratio of every pair of folded texts.

    ``values_sql`` gives a column a, ``candidates_sql`` a column b. The longest common substring (of
    ties the earliest in a, then in b) counts once; both remainders follow.
    """
    return f"""
{name}_v AS (SELECT DISTINCT b FROM ({candidates_sql})), {name}_u AS (SELECT DISTINCT a FROM ({values_sql})),
{name}_w(a0, b0, a, b, m) AS (
  SELECT a, b, a, b, 0 FROM {name}_u, {name}_v
  UNION ALL
  SELECT a0, b0,
    CASE WHEN s = 1 THEN substring(a, 1, (-x.i)::INT - 1) ELSE substring(a, (-x.i)::INT + x.l::INT) END,
    CASE WHEN s = 1 THEN substring(b, 1, (-x.j)::INT - 1) ELSE substring(b, (-x.j)::INT + x.l::INT) END,
    CASE WHEN s = 1 THEN x.l::INT ELSE 0 END
  FROM (SELECT a0, b0, a, b, list_sort(flatten([flatten(
          [[{{'l': l, 'i': -i, 'j': -j}} FOR l IN range(1, least(length(a) - i, length(b) - j) + 2)
            IF substring(a, i, l) = substring(b, j, l)] FOR j IN range(1, length(b) + 1)])
          FOR i IN range(1, length(a) + 1)]), 'DESC')[1] AS x
        FROM {name}_w WHERE length(a) > 0 AND length(b) > 0) z, (VALUES (1), (2)) sd(s)
  WHERE x IS NOT NULL),
{name} AS (SELECT a0, b0, 2.0 * sum(m) / (length(a0) + length(b0)) AS r FROM {name}_w GROUP BY a0, b0)"""


def months() -> str:
    return array(tx.MONTHS)
