"""Operators on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from tessaria.functions import vocab
from tessaria.operators import audit, coverage, dedup, extract, harmonize, match, metrics, scrape, standardize, tables, variations
from tessaria.plans import schema
from tessaria.sources import files
from tessaria.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_links_and_acronyms(spark):
    names = lambda t: one(spark, scrape.header_acronyms(F.lit(t)))
    assert names("Plano de Transformação Digital SUSEP / ANTAQ:") == ["SUSEP", "ANTAQ"]
    assert names("Plano de transformacao digital ANATEL (NOVO):") == ["ANATEL"]
    assert names("Plano de Transformação Digital SG-PR:") == ["SG-PR"] and names("minúscula") == []
    assert one(spark, scrape.link_type(F.lit("Anexo de ENTREGAS"))) == "entregas"
    assert one(spark, scrape.link_type_or_file(F.lit("x"), F.lit("/a/Anexo_1.pdf"))) == "entregas"
    assert one(spark, scrape.link_type_or_file(F.lit("x"), F.lit(None).cast("string"))) == "unknown"
    page = spark.createDataFrame([(1, '<A class="k" href="/m/a.PDF"><b>Documento</b> Diretivo</A><a href="b.html">x</a>')], "id int, html string")
    assert scrape.links(page, suffix=".pdf", marker="/m/", host="https://h").collect()[0][1:] == (0, "https://h/m/a.PDF", "Documento Diretivo")


def test_slots(spark):
    rows = spark.createDataFrame([("a", 0, "unknown", "u0"), ("a", 1, "diretivo", "d1"), ("a", 2, "unknown", "u2"), ("b", 0, "entregas", "e0"), ("b", 1, "entregas", "e1")], "k string, at int, t string, v string")
    got = {r.k: (r.diretivo, r.entregas) for r in scrape.fill_slots(rows, "k", "t", "v", "at").collect()}
    assert got == {"a": ("u0", "u2"), "b": (None, "e0")}


def test_inherit(spark):
    rows = spark.createDataFrame([("MD", "u"), ("CM", None), ("X", None)], "sigla string, url string")
    groups = spark.createDataFrame([("CM", "MD"), ("HFA", "MD"), ("RFB", "MF")], "member string, head string")
    assert {r.sigla: r.url for r in scrape.inherit_from_heads(rows, groups, "sigla", ["url"]).collect()} == {"MD": "u", "CM": "u", "X": None, "HFA": "u"}


def test_owner(spark):
    rows = spark.createDataFrame([("B", "h", "pb"), ("A", "h", "pa"), ("C", None, "pc")], "sigla string, h string, path string")
    assert {r.sigla: r.path for r in dedup.own_by_content(rows, "h", "sigla", "path").collect()} == {"A": "pa", "B": None, "C": "pc"}


def test_coverage(spark):
    organs = spark.createDataFrame([("A", None, "d1", "u1"), ("B", "g", "d1", "u1"), ("C", None, None, "u2"), ("D", None, "d2", "u2")], "sigla string, grupo string, url_diretivo string, url_entregas string")
    d = spark.createDataFrame([("A",)] * 3, "orgao_sigla string")
    r = spark.createDataFrame([("B",), ("C",)], "orgao_sigla string")
    got = [(x.sigla, x.entregas_extraidas, x.status_entregas, x.status_riscos) for x in coverage.coverage(organs, d, r).collect()]
    assert got == [("A", 3, "ok", "compartilhado"), ("B", 0, "compartilhado", "ok"), ("C", 0, "sem_dados", "sem_pdf"), ("D", 0, "sem_dados", "no_risk_table")]


@pytest.mark.parametrize(("value", "kept", "reason"), [("raro", "raro", None), (None, "", None), ("nan", "", None), ("raro; raro", "raro", "deduplicado"), ("raro|provável", "", "multiplos_valores"), ("de de Ocor-", "", "column_bleed"), (" raro ", "raro", None), (";", "", "column_bleed")])
def test_harmonize(spark, value, kept, reason):
    assert tuple(one(spark, harmonize.harmonize_cell(F.lit(value).cast("string"), vocab.PROBABILITY))) == (kept, reason)


@pytest.mark.parametrize(("o", "n", "m", "kind"), [("a", "b", "alias", "alias"), ("a", "b", "fuzzy_high", "aproximado"), ("", "X", "unmatched", "imputado"), ("1-Alto", "1-Alto", "unmatched", "residual"), ("x", "Outros", "exact", "residual"), ("x", "x", "fuzzy_low", "exato"), ("x", "y", "", "residual")])
def test_variation_types(spark, o, n, m, kind):
    assert one(spark, variations.variation_type(F.lit(o), F.lit(n), F.lit(m))) == kind


def test_risk_columns(spark):
    def names(headers):
        rows = spark.createDataFrame([("d", 1, 1, i, h) for i, h in enumerate(headers)], "doc string, page int, `table` int, col int, text string")
        return {r.field: r.col for r in tables.map_risk_columns(rows).collect()}

    assert names(["ID do risco", "Risco", "Probabilidade", "Impacto", "Tratamento", "Ações"]) == {"risco": 1, "probabilidade": 2, "impacto": 3, "tratamento": 4, "acoes": 5}
    assert names(["Col0", "Col1", "Col2", "Col3", "Col4"]) == {"risco": 0, "probabilidade": 1, "impacto": 2, "tratamento": 3, "acoes": 4}


def test_consolidation_looks_back_for_the_first_block_only(spark):
    cells = [("", "lead", "", ""), ("1", "a", "", ""), ("", "b", "- x", ""), ("", "c", "", ""), ("2", "d", "", ""), ("", "e", "", "p;q"), ("", "f", "", "r"), ("3", "g", "", ""), ("", "h", "", "")]
    rows = spark.createDataFrame([("d", 1, 1, i, list(c)) for i, c in enumerate(cells)], "doc string, page int, `table` int, row int, cells array<string>")
    got = [r.cells for r in tables.consolidate_rows(rows).orderBy("row").collect()]
    assert got == [["1", "lead a b c", "- x", ""], ["2", "d e f", "", "p;q | r"], ["3", "g h", "", ""]]


def test_actions(spark):
    text = "x\nReferencial para ações de tratamento:\n1. um\n2) dois\n3 - três\n4. quatro\nfim\n5. cinco"
    assert one(spark, tables.action_list(F.lit(text))) == {"1": "um", "2": "dois", "3": "três", "4": "quatro"}
    actions = F.create_map(F.lit("1"), F.lit("um"), F.lit("2"), F.lit("dois"))
    assert one(spark, tables.resolve_actions(F.lit("1, 2, 9"), actions)) == "1. um | 2. dois"
    assert one(spark, tables.resolve_actions(F.lit("ver item 2"), actions)) == "ver item 2"


@pytest.mark.parametrize(("header", "role"), [("Situação", "status"), ("Pactuado?", "pactuado"), ("Prazo", "data_pactuada"), ("Coluna Aleatória", None), ("Serviço/Ação", "servico")])
def test_roles(spark, header, role):
    assert one(spark, tables.column_role(F.lit(header))) == role


def test_extraction_end_to_end(spark):
    shapes = spark.createDataFrame([
        ("d", 1, 1, ["Risco", "Probabilidade", "Impacto", "Tratamento", "Ações"], [], "", 5),
        ("d", 2, 1, ["Perda total de dados", "Raro", "Alto", "Aceitar", "2"], ["x"], "raro alto", 5),
        ("d", 3, 1, ["Nome", "Cargo", "Data", "CPF"], [], "", 4),
    ], "doc string, page int, `table` int, headers array<string>, first_row array<string>, all_text string, ncols int")
    rows = spark.createDataFrame([("d", 1, 1, 0, ["Atraso", "Alto", "Raro", "mitigar", "1"]), ("d", 1, 1, 1, ["Risco", "Probabilidade", "", "", ""]), ("d", 2, 1, 0, ["Falha", "xyz", "Médio", "evitar", ""])], "doc string, page int, `table` int, row int, cells array<string>")
    actions = spark.createDataFrame([("d", {"1": "treinar", "2": "rever"})], "doc string, actions map<string,string>")
    got = {r.risco_texto: r for r in extract.risk_entries(extract.risk_rows(rows, shapes), actions).collect()}
    assert set(got) == {"Atraso", "Falha", "Perda total de dados"}
    assert (got["Atraso"].probabilidade_normalizada, got["Atraso"].impacto_normalizado, got["Atraso"].acoes_tratamento) == ("raro", "alto", "1. treinar") and got["Atraso"].needs_review
    assert got["Falha"].tratamento_normalizado == "eliminar" and got["Falha"].review_reason == "probabilidade: 'xyz'"
    assert got["Perda total de dados"].review_reason == "recuperado de header de coluna" and got["Perda total de dados"].extraction_confidence == "medium"


def test_audit(spark):
    rows = spark.createDataFrame([(1, "Probabilidade", "alto", "mitigar", False, "antes", "high"), (2, "raro", "alto", "aceitar", False, None, "high"), (3, "alto", None, "-rência", False, None, "high")], "id int, probabilidade_original string, impacto_original string, tratamento_original string, needs_review boolean, review_reason string, extraction_confidence string")
    got = {r.id: r for r in audit.audit_risks(rows).collect()}
    assert got[1].audit == ["header_captured"] and got[1].review_reason.startswith("antes; probabilidade: header") and got[1].extraction_confidence == "low"
    assert got[2].audit == [] and not got[2].needs_review and got[2].extraction_confidence == "high"
    assert got[3].audit == ["column_shift", "fragment"]


def test_standardize_marks_first_rows_only(spark):
    rows = spark.createDataFrame([(0, "zzzz", "", "s"), (1, "zzzz", "", "s"), (2, "Adequação à LGPD", "Projetos Especiais", "s")], "seq long, produto_original string, eixo_original string, servico_acao string")
    rows = rows.withColumns({"needs_review": F.lit(False), "review_reason": F.lit(None).cast("string"), "extraction_confidence": F.lit("high")})
    got = {r.seq: r for r in standardize.standardize_deliveries(rows).collect()}
    assert got[0].produto_normalizado == got[1].produto_normalizado == "UNMATCHED"
    assert got[0].needs_review and not got[1].needs_review and got[0].extraction_confidence == "low"
    assert got[2].eixo_normalizado == "Governança e Gestão de Dados" and "cross-validation" in got[2].review_reason
    assert all(r.needs_review for r in standardize.standardize_deliveries(rows, review_all=True).collect())


@pytest.mark.parametrize(("value", "normal"), [("Mitigar/Transferir", "mitigar; transferir"), ("transferir; transferir", "transferir; transferir"), ("evitar", "eliminar"), ("", ""), (";", ";")])
def test_treatments(spark, value, normal):
    rows = spark.createDataFrame([(0, "raro", "alto", value, False, None, "medium")], "seq long, probabilidade_original string, impacto_original string, tratamento_original string, needs_review boolean, review_reason string, extraction_confidence string")
    r = standardize.standardize_risks(rows).first()
    assert r.tratamento_normalizado == normal and r.needs_review == (";" in normal[1:] or value == "")


def test_metrics_and_gate(spark):
    rows = spark.createDataFrame([("b", 0), ("a", 1), ("a", 2), ("b", 3), ("c", 4)], "v string, seq int")
    assert [r["value"] for r in metrics.top(rows, "v", "seq", 2).collect()] == ["b", "a"]
    checks = metrics.checks(spark.createDataFrame([(5,)], "n int"), {"n": ("min", 6)})
    with pytest.raises(metrics.GateFailed):
        metrics.gate(checks)
    metrics.gate(metrics.checks(spark.createDataFrame([(5,)], "n int"), {"n": ("max", 6)}))
    empty = metrics.canonical_rates(spark.createDataFrame([], "v string"), {"x": metrics.canonical(F.col("v"), ["a"])}).first()
    assert empty.total == 0 and empty.x_rate == 0.0


def test_files(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('﻿a,b\n"x\ny",\n"q""r",2\n'.encode())
    assert [tuple(r) for r in files.read_csv(spark, str(path)).collect()] == [("x\ny", ""), ('q"r', "2")]
    found = files.checksums(files.inventory(spark, str(tmp_path), "*.csv")).first()
    assert found.linhas == 4 and len(found.sha256) == 64
    files.archive(str(tmp_path / "a.zip"), {"b": b"2", "a": b"1"})
    files.archive(str(tmp_path / "b.zip"), {"a": b"1", "b": b"2"})
    assert (tmp_path / "a.zip").read_bytes() == (tmp_path / "b.zip").read_bytes()
    nested = files.nested_json(spark.createDataFrame([("A", 1, "x"), ("A", 0, "y"), (None, 2, "z")], "k string, seq int, v string"), "k", "seq", ["v"]).first()
    assert json.loads(nested.data) == {"A": [{"v": "y"}, {"v": "x"}], "UNKNOWN": [{"v": "z"}]} and json.loads(nested.metadata)["total"] == 3


class Answer:
    def __init__(self, status, body=b""):
        self.status, self.body = status, body

    def read(self):
        return self.body


def test_fetch_retries():
    waits, answers = [], [Answer(503), OSError(), Answer(200, b"ok")]

    def opener(url):
        a = answers.pop(0)
        if isinstance(a, OSError):
            raise a
        return a

    assert files.fetch("u", opener, waits.append) == b"ok" and waits == [2, 2, 2, 4, 2]
    assert files.fetch("u", lambda u: Answer(503), waits.append, tries=2) is None
    assert files.preflight("u", lambda u: Answer(200)) and not files.preflight("u", lambda u: Answer(404))


def test_documents(spark):
    rows = spark.createDataFrame([("a.pdf", bytearray(b"%PDF-1.7 /CreationDate (D:20260429120000) /ModDate(D:2026)")), ("b.pdf", bytearray(b"<html>"))], "name string, content binary").withColumn("length", F.length("content"))
    got = {r.name: r for r in files.document_metadata(rows).collect()}
    assert got["a.pdf"].data_criacao_pdf == "2026-04-29" and got["b.pdf"].data_criacao_pdf == ""
    assert {r.name: r.error_type for r in files.document_checks(rows).collect()} == {"a.pdf": "small_pdf", "b.pdf": "invalid_pdf"}


def test_incremental(spark, tmp_path):
    inputs, seen = spark.createDataFrame([(1,), (2,)], "k int"), []

    def work(df):
        seen.append(df.count())
        return df.withColumn("r", F.col("k") * 2)

    path = str(tmp_path / "store")
    assert incremental.run_new(inputs, work, path, "k", "f1").count() == 2
    assert incremental.run_new(inputs.union(spark.createDataFrame([(3,)], "k int")), work, path, "k", "f1").count() == 3
    assert seen == [2, 1]
    assert incremental.load(spark, path, "other") is None


def test_stream_works_on_each_key_once(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([(1,), (1,), (2,)], "k int").write.parquet(str(source))
    stream = spark.readStream.schema("k int").parquet(str(source))
    incremental.stream_new(stream, lambda df: df, str(tmp_path / "out"), "k", str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_schema(spark):
    assert schema.struct(schema.RISKS)["probabilidade_score"].dataType.simpleString() == "double" and len(schema.RISKS) == 18 and len(schema.DELIVERIES) == 19
    strict = schema.strict(schema.RISKS, {"impacto_normalizado": vocab.IMPACT})
    assert next(f for f in strict if f.name == "impacto_normalizado").json_schema()["enum"] == [*vocab.IMPACT, None]
    package = schema.data_package("p", schema.RESOURCES, {"organs.csv": {"bytes": 3, "sha256": "x"}})
    assert package["resources"][0]["schema"]["primaryKey"] == "sigla" and package["resources"][1]["schema"]["foreignKeys"][0]["reference"]["resource"] == "organs"
    page = schema.inject("<head></head>", "d", "1")
    assert schema.inject(page, "d", "1") == page and "2" in schema.inject(page, "d", "2") and schema.inject(page, "d", "2").count("d:begin") == 1
    assert schema.citation_authors(["title: x", "authors:", "  - family-names: Silva", '    given-names: "Ana"', "date: y"]) == [{"@type": "Person", "name": "Ana Silva"}]
    assert {r.key: r.n for r in schema.duplicate_keys(spark.createDataFrame([("a",), ("a",), ("b",)], "key string"), "key").collect()} == {"a": 2}
    widths = {r.column: r.width for r in schema.column_widths(spark.createDataFrame([("x" * 30, "y")], "a string, b string")).collect()}
    assert widths == {"a": 32, "b": 10}


def test_numbered_is_gapless(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    got = standardize.numbered(rows, "v").collect()
    assert sorted((r.v, r.seq) for r in got) == [(i, i) for i in range(1000)]


def plain_risk_columns(headers):
    """A risk table's columns, one header after another."""
    from difflib import SequenceMatcher

    norm = [match.folded(h) for h in headers]
    ids = {i for i, h in enumerate(norm) if h in tables.ID_HEADERS or h.startswith("id ")}
    out = {}
    for field, words in tables.RISK_COLUMNS.items():
        best, top = None, 0.0
        for i, h in enumerate(norm):
            if field == "risco" and i in ids:
                continue
            for w in words:
                if w in h and max(len(w) / max(len(h), 1), 0.85) > top:
                    best, top = i, max(len(w) / max(len(h), 1), 0.85)
            if best is None:
                near = [r for r in (SequenceMatcher(None, h, w).ratio() for w in words) if r >= 0.65]
                if near:
                    best, top = i, max(near)
        if best is not None:
            out[field] = best
    offset = int(len(headers) >= 6 and (0 in ids or norm[0] == "col0"))
    for at, field in enumerate(tables.RISK_COLUMNS):
        if field not in out and at + offset < len(headers) and at + offset not in out.values() and at + offset not in ids:
            out[field] = at + offset
    return out


def test_risk_columns_against_a_plain_version(spark):
    cases = [
        ["Coisa", "impct", "impacta", "x"], ["ID do risco", "Evento", "Probab.", "Impacto", "Opção de tratamento", "Ações"], ["Nº", "Col1", "Col2", "Col3", "Col4", "Col5"], ["Risco", "Risco identificado", "Prob", "Severidade", "Medidas"],
        ["Tratamento", "Resposta ao risco", "Acao", "Classificação de impacto", "Descricao"], ["a", "b", "c", "d"], ["Descrição", "probabildade", "impato", "tratamentos", "acoes", "z"],
    ]
    rows = spark.createDataFrame([(str(d), 1, 1, i, h) for d, hs in enumerate(cases) for i, h in enumerate(hs)], "doc string, page int, `table` int, col int, text string")
    got = {}
    for r in tables.map_risk_columns(rows).collect():
        got.setdefault(int(r.doc), {})[r.field] = r.col
    assert got == {d: plain_risk_columns(hs) for d, hs in enumerate(cases)}
    assert got[0]["impacto"] == 1


def test_risk_documents_end_to_end(spark):
    from tessaria.plans.table_queries import _RISK_DOCUMENTS, _RISK_TEXT

    more = [(["Perda total de dados", "Raro", "Alto", "Aceitar"], [["Risco X", "Raro", "Baixo", "Mitigar"]]), (["k", "l", "m", "n"], [["Risco Y", "Alto", "Raro", "Mitigar"], [None, "", "", ""]]), (["k", "l", "m"], [["fora", "raro", "alto"]])]
    docs = [*_RISK_DOCUMENTS, more]
    cells = [(d, p, 1, row, col, text) for d, pages in enumerate(docs) for p, (headers, rows) in enumerate(pages, 1) for row, line in enumerate([headers, *rows], -1) for col, text in enumerate(line)]
    texts = spark.createDataFrame([(d, _RISK_TEXT) for d in range(len(docs))], "doc int, text string")
    out = extract.risk_document_entries(spark.createDataFrame(cells, "doc int, page int, `table` int, row int, col int, text string"), texts)
    rows = {(r.doc, r.risco_texto): r for r in out.collect()}
    assert [k for k in sorted(rows)] == sorted([(0, "Atraso"), (0, "Perda"), (0, "Falha do sistema"), (1, "Perda total de dados"), (1, "Vazamento"), (1, "Greve"), (2, "Incêndio"), (2, "Fraude"), (4, "Perda total de dados"), (4, "Risco X"), (4, "Risco Y")])
    six = rows[0, "Falha do sistema"]  # six columns, first cells no numbers: read from the first column on
    assert (six.probabilidade_original, six.impacto_original, six.tratamento_original, six.acoes_tratamento) == ("Raro", "Alto", "Mitigar", "9. monitorar")
    swapped = rows[4, "Risco Y"]
    assert (swapped.probabilidade_original, swapped.impacto_original) == ("Raro", "Alto") and "swap" in swapped.review_reason
    assert rows[2, "Fraude"].tratamento_normalizado == "aceitar"  # an orphan of seven columns, numbers first
    lost = extract.documents_without_entries(texts, out).collect()
    assert [(r.doc, r.error_type) for r in lost] == [(3, "no_risk_table")]


def test_checksums_of_files_that_are_no_text(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\xff\n\x00\n\xfe")
    row = files.checksums(files.inventory(spark, str(tmp_path))).first()
    assert row.linhas == 3 and row.bytes == 5


def test_large_vocabularies_go_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(match, "LARGEST", 2)
    df = spark.createDataFrame([("abcx",), ("zzzz",), ("",)], "v string")
    got = {r.value: (r.canonical, r.score) for r in match.match_values(df, "v", ["abcd", "abce", "zzzy", "zzyz", "abcf"]).collect()}
    assert got == {"abcx": ("abcd", 0.75), "zzzz": ("zzzy", 0.75), "": ("", 0.0)}


def test_links_of_any_spelling(spark):
    html = """<a href='/x.pdf'>One</a> <A HREF=/z.pdf>Two <b>bold</b></A><!-- <a href="/no.pdf">no</a> --><a name="n">no</a>
    <script>"<a href='/s.pdf'>s</a>"</script><a href="/a.pdf?x=1&amp;y=2">A&ccedil;&atilde;o</a><a class="k" href="https://h/Q.PDF">  q </a><a href>empty</a>"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string")
    got = [(r.at, r.href, r.anchor) for r in scrape.links(pages, host="https://w").collect()]
    assert got == [(0, "https://w/x.pdf", "One"), (1, "https://w/z.pdf", "Two bold"), (2, "https://w/a.pdf?x=1&y=2", "Ação"), (3, "https://h/Q.PDF", "q")]
    assert [r.at for r in scrape.links(pages, suffix=".pdf", marker="h/").collect()] == [3]


def test_listing_is_linear_in_titles():
    import time

    page = "".join(f"<div><b>Plano de Transformação Digital T{i}</b><a href='/t{i}.pdf'>Entregas</a></div>" for i in range(6000))
    began = time.time()
    got = scrape._listed(page, [])
    assert len(got) == 6000 and got[7]["links"] == [{"href": "/t7.pdf", "anchor": "Entregas"}] and time.time() - began < 6
