"""Listing pages: classify links, find acronyms, fill each group's documents, inherit from heads."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaria.functions import text as tx
from tessaria.functions import vocab

# The title before the acronyms, and what an acronym looks like.
TITLE = r"(?i)Plano\s+de\s+Transforma[çc][ãa]o\s+Digital\s*"
TITLE_WORDS = ("transformação digital", "transformacao digital")
ACRONYM = r"^[A-ZÁÉÍÓÚÂÊÔÃÕÇ][A-ZÁÉÍÓÚÂÊÔÃÕÇ0-9\-]{1,14}$"


def link_type(anchor: Column) -> Column:
    """diretivo, entregas or null, by an anchor's text."""
    t = tx.strip_accents(F.lower(tx.normalize_text(anchor)))
    return F.when(F.contains(t, F.lit("diretivo")), "diretivo").when(F.contains(t, F.lit("entregas")), "entregas")


def link_type_or_file(anchor: Column, href: Column) -> Column:
    """``link_type``; where the text tells nothing, the file's name does; else unknown."""
    name = tx.strip_accents(F.lower(F.regexp_extract(tx.blank_as_empty(href), r"([^/]*)$", 1)))
    by_file = F.when(F.contains(name, F.lit("diretiv")), "diretivo").when(F.contains(name, F.lit("entregas")) | F.contains(name, F.lit("anexo")), "entregas").otherwise("unknown")
    return F.coalesce(link_type(anchor), by_file)


def header_acronyms(header: Column) -> Column:
    """The acronyms that a header names, in order."""
    rest = tx.stripped(F.regexp_replace(tx.normalize_text(header), TITLE, ""))
    rest = tx.stripped(F.regexp_replace(rest, r"[\s:–\-]+$", ""))
    parts = F.transform(F.split(rest, "/"), lambda p: tx.stripped(F.regexp_replace(tx.stripped(p), r"\s*\(.*?\)\s*", "")))
    return F.filter(parts, lambda p: F.regexp_like(p, F.lit(ACRONYM)))


def links(pages: DataFrame, html_col: str = "html", suffix: str = "", marker: str = "", host: str = "") -> DataFrame:
    """(columns of ``pages`` but the html, at, href, anchor) for each link whose address has suffix and marker; a leading slash gets the host.

    Links are read by a parser: quotes of any kind or none, tags in any case, entities resolved, none in
    comments or scripts. Texts of an anchor are joined by spaces. A null or empty page has none.
    """
    found = F.pandas_udf(lambda pages: pd.Series([_anchors(p) for p in pages], dtype=object), "array<struct<href: string, anchor: string>>")
    rows = pages.select(*[c for c in pages.columns if c != html_col], F.posexplode(found(F.col(html_col))).alias("at", "l"))
    rows = rows.select(*[c for c in rows.columns if c != "l"], F.col("l.href").alias("href"), F.col("l.anchor").alias("anchor"))
    rows = rows.filter(F.lower("href").endswith(suffix) & F.contains(F.col("href"), F.lit(marker)))
    return rows.withColumn("href", F.when(F.col("href").startswith("/"), F.concat(F.lit(host), F.col("href"))).otherwise(F.col("href")))


def first_per_set(df: DataFrame, array_col: str, *order: str, within: tuple[str, ...] = ()) -> DataFrame:
    """The first row, by ``order``, of each set of array elements, among rows that agree in ``within``."""
    return _first(df, [*within, F.array_sort(array_col)], order)


def first_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row, by ``order``, of each key."""
    return _first(df, keys, order)


def _first(df: DataFrame, keys: list, order: tuple[str, ...]) -> DataFrame:
    """Firsts combine before the shuffle, so that a frequent key is no hot spot."""
    named = [F.col(k).alias(f"k{i}") if isinstance(k, str) else k.alias(f"k{i}") for i, k in enumerate(keys)]
    rows = df.select(*named, F.struct(*order).alias("o"), F.struct(*df.columns).alias("r"))
    return rows.groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.min_by("r", "o").alias("r")).select("r.*")


def _fill(acc: Column, x: Column) -> Column:
    """Slots (d, e) after a link (t, v) in order: a type's first link takes its slot, an unknown one what is free."""
    to_d = acc.d.isNull() & x.t.isin("diretivo", "unknown")
    to_e = acc.e.isNull() & ((x.t == "entregas") | ((x.t == "unknown") & ~to_d))
    return F.struct(F.when(to_d, x.v).otherwise(acc.d).alias("d"), F.when(to_e, x.v).otherwise(acc.e).alias("e"))


def _no_slots() -> Column:
    return F.struct(F.lit(None).cast("string").alias("d"), F.lit(None).cast("string").alias("e"))


def fill_slots(df: DataFrame, key: str, type_col: str, value_col: str, *order: str) -> DataFrame:
    """(key, diretivo, entregas): the first link of each type; unknown links fill what is free, diretivo first, in order."""
    typed = F.struct(*[F.col(o) for o in order])
    first = lambda t: F.min_by(F.when(F.col(type_col) == t, F.col(value_col)), F.when(F.col(type_col) == t, typed))
    # a link of a type that is met before an unknown link takes its slot; the unknown ones are walked in order
    walked = F.array_sort(F.collect_list(F.struct(typed.alias("o"), F.col(type_col).alias("t"), F.col(value_col).alias("v"))))
    unknown = F.max(F.col(type_col) == "unknown")
    grouped = df.groupBy(key).agg(first("diretivo").alias("d1"), first("entregas").alias("e1"), F.when(unknown, F.aggregate(walked, _no_slots(), _fill)).alias("s"))
    return grouped.select(key, F.coalesce("s.d", "d1").alias("diretivo"), F.coalesce("s.e", "e1").alias("entregas"))


def inherit_from_heads(rows: DataFrame, groups: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``rows`` with members of a group completed from its head, and absent members added.

    ``groups`` has (member, head). A member's null columns take the head's; a member without a row
    gets one, if its head has one.
    """
    heads = rows.join(groups, F.col(key) == F.col("head")).select(F.col("member"), F.col("head"), *[F.col(c).alias(f"head_{c}") for c in columns])
    joined = rows.join(heads, F.col(key) == F.col("member"), "full_outer")
    return joined.select(F.coalesce(key, "member").alias(key), *[F.coalesce(c, f"head_{c}").alias(c) for c in columns], F.col("head").alias("grupo"), *[c for c in rows.columns if c != key and c not in columns])


class _Page(HTMLParser):
    """A page as flat lists: elements (tag, parent, from, to), texts and links by the event at which they stand.

    A closing tag closes everything up to its element, one without an element is left out, and what
    is never closed ends with the page.
    """

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
    SILENT = frozenset(("script", "style", "template"))

    def __init__(self, html: str) -> None:
        super().__init__()
        self.elements, self.texts, self.links, self.open, self.at, self.last = [["", 0, 0, None]], [], [], [0], 0, None
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.at += 1
        self.last = None
        href = dict(attrs).get("href")
        if tag in self.VOID:
            return
        self.elements.append([tag, self.open[-1], self.at, None])
        self.open.append(len(self.elements) - 1)
        if tag == "a" and href is not None:
            self.links.append((self.open[-1], href))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.at += 1
        self.last = None
        if any(self.elements[i][0] == tag for i in self.open[1:]):
            while True:
                i = self.open.pop()
                self.elements[i][3] = self.at
                if self.elements[i][0] == tag:
                    return

    def handle_data(self, data):
        if self.elements[self.open[-1]][0] in self.SILENT:
            return
        if self.last is None:
            self.at += 1
            self.last = self.at
            self.texts.append([self.at, data])
        else:
            self.texts[-1][1] += data

    def span(self, i: int) -> tuple[int, float]:
        start, end = self.elements[i][2:]
        return start, float("inf") if end is None else end

    def text(self, i: int) -> str:
        """The texts inside an element, each stripped, joined by spaces."""
        start, end = self.span(i)
        at = lambda x: x[0]  # noqa: E731  texts are in the order in which they stand
        inside = self.texts[bisect_left(self.texts, start, key=at) : bisect_left(self.texts, end, key=at)]
        return " ".join(t for t in (x.strip() for _, x in inside) if t)


def _anchors(html: str | None) -> list[dict]:
    """The links of a page in order."""
    page = _Page(html or "")
    return [{"href": href, "anchor": page.text(i)} for i, href in page.links]


def _listed(html: str | None, markers: list[str]) -> list[dict]:
    """(at, header, links) of a page's bold titles; the links are those of the element that holds the title."""
    page = _Page(html or "")
    wanted = [(page.span(i)[0], href, page.text(i)) for i, href in page.links if href.lower().endswith(".pdf") and (not markers or any(m in href for m in markers))]
    place = lambda x: x[0]
    out = []
    for i, (tag, parent, _, _) in enumerate(page.elements):
        if tag not in ("strong", "b"):
            continue
        header = page.text(i)
        if any(w in header.lower() for w in TITLE_WORDS):
            start, end = page.span(parent)
            inside = wanted[bisect_right(wanted, start, key=place) : bisect_left(wanted, end, key=place)]
            out.append({"at": i, "header": header, "links": [{"href": href, "anchor": anchor} for _, href, anchor in inside]})
    return out


def organ_listing(pages: DataFrame, key: str, html_col: str = "html", host: str = "", markers: tuple[str, ...] = (), groups: dict[str, list[str]] | None = None) -> DataFrame:
    """(key, sigla, nome_completo, grupo, url_diretivo, url_entregas) for each acronym that a listing page names.

    Bold titles name acronyms; the PDF links of the element around the title fill its two slots. Of
    titles with the same acronyms, and of records of one acronym, the first stays. Members of a group
    take what they lack from its head, and those without a title get the head's record. Pages are
    read one by one and stand for themselves; a null or empty page, or one without titles, has no
    rows. ``markers``: a link's address must have one of them; a leading slash gets ``host``.
    """
    known = list(markers)
    listed = F.pandas_udf(lambda pages: pd.Series([_listed(p, known) for p in pages], dtype=object), "array<struct<at: int, header: string, links: array<struct<href: string, anchor: string>>>>")
    found = pages.select(F.col(key).alias("page"), F.explode(listed(F.col(html_col))).alias("h"))
    rows = found.select("page", "h.at", F.col("h.header").alias("nome"), F.col("h.links").alias("links"), header_acronyms(F.col("h.header")).alias("siglas"))
    rows = first_per_set(rows.filter(F.size("siglas") > 0), "siglas", "at", within=("page",))
    absolute = lambda h: F.when(h.startswith("/"), F.concat(F.lit(host), h)).otherwise(h)
    typed = F.transform("links", lambda x: F.struct(link_type_or_file(x.anchor, x.href).alias("t"), absolute(x.href).alias("v")))
    rows = rows.select("page", "at", "nome", "siglas", F.aggregate(typed, _no_slots(), _fill).alias("s"))
    each = rows.select("page", "at", "nome", F.posexplode("siglas").alias("i", "sigla"), F.col("s.d").alias("d"), F.col("s.e").alias("e"))
    each = first_per_key(each, ["page", "sigla"], "at", "i")
    pairs = [(m, h) for h, members in (vocab.GROUPS if groups is None else groups).items() for m in members if m != h]
    table = F.broadcast(pages.sparkSession.createDataFrame(pairs, "member string, head string"))  # a fixed vocabulary
    heads = each.join(table, F.col("sigla") == F.col("head")).select(F.col("page").alias("h_page"), "member", *[F.col(c).alias(f"h_{c}") for c in ("nome", "d", "e")])
    full = each.join(heads, (F.col("page") == F.col("h_page")) & (F.col("sigla") == F.col("member")), "full_outer")
    full = full.select(F.coalesce("page", "h_page").alias(key), F.coalesce("sigla", "member").alias("sigla"), *[F.coalesce(c, f"h_{c}").alias(c) for c in ("nome", "d", "e")])
    grouped = full.join(table, F.col("sigla") == F.col("member"), "left")
    return grouped.select(key, "sigla", F.col("nome").alias("nome_completo"), F.col("head").alias("grupo"), F.col("d").alias("url_diretivo"), F.col("e").alias("url_entregas"))
