"""Text functions as Catalyst expressions: normalisation, accents, dates, shapes.

Classes of characters are made from the Unicode data, once, when a plan is built; texts meet
built-in expressions only. Normal forms of text beyond ASCII are the JVM's own.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode and the information separators have it.
SPACE = r"[\s\x1c-\x1f]"
PREFIX = r"^[A-Za-z0-9]{1,3}(?U:\s)*[).\-](?U:\s)+"

# Months, and the literals that mark captured headers and template rows.
MONTHS = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
OTHER = ["outros", "outro", "outros -", "outros –"]
RISK_HEADERS = ["risco", "probabilidade", "impacto", "tratamento", "acoes", "probabilidade de ocorrencia", "nivel de impacto", "id risco", "id do risco", "id"]
AUDIT_HEADERS = ["probabilidade", "impacto", "tratamento", "risco", "probabilidade de ocorrencia", "nivel de impacto"]
DELIVERY_HEADERS = ["servico", "servico/acao", "acao", "produto", "produto ptd", "eixo", "data pactuada", "data entrega", "area responsavel", "id", "id entrega"]


#: The class with Unicode's normal forms that Spark itself brings along, for its collations.
_NORMALIZER = "com.ibm.icu.text.Normalizer"


def _ranges(points: list[int]) -> str:
    """Code points as the inside of a character class."""
    out, start = [], None
    for at, p in enumerate(points):
        start = p if start is None else start
        if at + 1 == len(points) or points[at + 1] != p + 1:
            out.append(rf"\x{{{start:X}}}" if start == p else rf"\x{{{start:X}}}-\x{{{p:X}}}")
            start = None
    return "".join(out)


@lru_cache(maxsize=1)
def _marks_and_formats() -> tuple[str, str]:
    """Character classes of what combines (any class but zero, whatever its category) and of format characters."""
    every = range(sys.maxunicode + 1)
    return f"[{_ranges([c for c in every if unicodedata.combining(chr(c))])}]", f"[{_ranges([c for c in every if unicodedata.category(chr(c)) == 'Cf'])}]"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    An expression that is repeated is repeated in the plan; nested rules would grow it without bound.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_as_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def stripped(c: Column) -> Column:
    """Without white space of any kind at the ends (``trim`` drops spaces only)."""
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def collapsed(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"(?U){SPACE}+", " "))


def _normal(c: Column, method: str, compatible: bool) -> Column:
    """A normal form of ``c``; texts of ASCII characters pass as they are, as null does.

    Spark takes such a call for one that may differ from time to time, so it can't stand in a join's
    condition, a grouping or an aggregate: project it first.
    """
    return F.when(F.octet_length(c) > F.length(c), F.reflect(F.lit(_NORMALIZER), F.lit(method), c, F.lit(compatible))).otherwise(c)


def composed(c: Column) -> Column:
    """NFC, in any script: marks in canonical order, letters with marks as single characters where there is one."""
    return let(c, lambda x: _normal(x, "compose", False))


def decomposed(c: Column) -> Column:
    """NFKD, in any script: characters as those they are compatible with, marks apart and in canonical order."""
    return let(c, lambda x: _normal(x, "decompose", True))


def strip_accents(c: Column) -> Column:
    """NFKD without combining characters, in any script; texts of ASCII characters pass as they are."""
    marks, _ = _marks_and_formats()
    return let(c, lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(F.regexp_replace(_normal(x, "decompose", True), marks, "")))


def normalize_text(c: Column) -> Column:
    """No format characters, composed, white space collapsed, one leading enumeration mark dropped; null is empty."""
    _, formats = _marks_and_formats()
    bare = let(blank_as_empty(c), lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(F.regexp_replace(x, formats, "")))
    return F.regexp_replace(collapsed(composed(bare)), PREFIX, "")


def key(c: Column) -> Column:
    """What values are looked up by: normalised, lower case, without accents."""
    return strip_accents(stripped(F.lower(normalize_text(c))))


def normalize_header(c: Column) -> Column:
    """As ``key``, with words that a hyphen broke put together."""
    return strip_accents(F.replace(F.lower(normalize_text(c)), F.lit("- "), F.lit("")))


def parse_date(c: Column) -> Column:
    """YYYY-MM-DD or YYYY-MM of the first date found, else the normalised text; null and empty give null."""
    return let(normalize_text(c), lambda t: _parsed(blank_as_empty(c), t))


def _parsed(raw: Column, t: Column) -> Column:
    day = F.regexp_extract(t, r"(\d{2})/(\d{2})/(\d{4})", 0)
    month = F.regexp_extract(t, r"(\d{2})/(\d{4})", 0)
    iso = F.regexp_extract(t, r"\d{4}-\d{2}-\d{2}", 0)
    low = F.lower(t)
    named = r"^([a-záéíóú]{3})[./\-](\d{2,4})"
    number = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(low, named, 1))
    year = F.regexp_extract(low, named, 2)
    return (
        F.when(raw == "", F.lit(None).cast("string"))
        .when(day != "", F.concat_ws("-", F.substring(day, 7, 4), F.substring(day, 4, 2), F.substring(day, 1, 2)))
        .when(month != "", F.concat_ws("-", F.substring(month, 4, 4), F.substring(month, 1, 2)))
        .when(iso != "", iso)
        .when(number > 0, F.concat(F.when(F.length(year) == 2, F.lit("20")).otherwise(F.lit("")), year, F.lit("-"), F.lpad(number.cast("string"), 2, "0")))
        .otherwise(t)
    )


def parse_document_date(c: Column) -> Column:
    """ISO date of a document's ``D:YYYYMMDD...`` mark, else empty."""
    digits = F.regexp_extract(F.regexp_replace(blank_as_empty(c), "^D:", ""), r"^(\d{4})(\d{2})(\d{2})", 0)
    return F.when(digits != "", F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))).otherwise("")


def is_other(c: Column) -> Column:
    """Whether a product is the catch-all."""
    return stripped(F.lower(normalize_text(c))).isin(OTHER)


def is_literal(c: Column, literals: list[str]) -> Column:
    """Whether a value is the name of a column, captured as data."""
    return (blank_as_empty(c) != "") & key(c).isin(literals)


def is_blank(c: Column) -> Column:
    """Null, white space, or the text nan."""
    return F.lower(stripped(blank_as_empty(c))).isin("", "nan")


def is_fragment(c: Column) -> Column:
    """A value that hyphenation broke: a hyphen at either end, or a short word twice in a row."""
    return let(
        stripped(blank_as_empty(c)),
        lambda s: F.regexp_like(s, F.lit(r"(?U)[^\s]-$"))
        | F.regexp_like(s, F.lit("^-[a-záéíóúâêôãõç]"))
        | F.regexp_like(F.lower(s), F.lit(r"(?U)\b(\w{1,3})\s+\1\b")),
    )


def size_text(c: Column) -> Column:
    """Bytes, kilobytes or megabytes, with one decimal from kilobytes on, rounded half to even; null is null."""

    def decimal(unit: int, name: str) -> Column:
        tenths, rest = F.floor(c * 10 / unit), (c * 10) % unit  # below 2 ** 53 the quotient by a power of two is exact
        up = F.when((rest * 2 > unit) | ((rest * 2 == unit) & (tenths % 2 == 1)), 1).otherwise(0)
        return let(tenths + up, lambda t: F.concat(F.floor(t / 10).cast("string"), F.lit("."), (t % 10).cast("string"), F.lit(f" {name}")))

    return F.when(c < 1024, F.format_string("%d B", c)).when(c < 1024 * 1024, decimal(1024, "KB")).when(c.isNotNull(), decimal(1024 * 1024, "MB"))


def slug(c: Column) -> Column:
    return F.translate(F.lower(c), " /", "--")


def line_count(c: Column) -> Column:
    """Lines of a text; a last line without an end counts."""
    text = blank_as_empty(c)
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (ends + F.when((text != "") & ~text.endswith("\n"), 1).otherwise(0)).cast("long")


def digest(c: Column, kind: str = "md5") -> Column:
    """MD5, SHA-256, or the first twelve hex digits of SHA-1."""
    return {"md5": F.md5(c), "sha256": F.sha2(c, 256), "sha1": F.substring(F.sha1(c), 1, 12)}[kind]


def ratio_of(ok: Column, total: Column, digits: int = 4) -> Column:
    return F.when(total > 0, F.round(ok / total, digits)).otherwise(0.0)
