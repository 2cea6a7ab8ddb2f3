"""A run from raw entries to published tables."""

import pytest

from tessaria.operators import metrics
from tessaria.plans import run


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("source")
    spark.createDataFrame([("A", "u1", "u1"), ("B", None, "u2")], "sigla string, url_diretivo string, url_entregas string").write.parquet(str(path / "organs"))
    d = [("A", "Sistema de protocolo", "Integração ao Login Unico", "Segurança e Privacidade"), ("A", "x", "Outros", ""), ("A", "Outro sistema qualquer", "nada parecido", "")]
    spark.createDataFrame(d, "orgao_sigla string, servico_acao string, produto_original string, eixo_original string").write.parquet(str(path / "deliveries"))
    r = [("A", "risco um", "1-Alto", "Alto", "Mitigar/Transferir"), ("A", "risco dois", "Raro", "médio", "evitar")]
    spark.createDataFrame(r, "orgao_sigla string, risco_texto string, probabilidade_original string, impacto_original string, tratamento_original string").write.parquet(str(path / "risks"))
    (path / "errors.csv").write_text("orgao_sigla,error_type\nB,no_risk_table\n")
    return str(path)


def test_publish_check_and_gate(spark, source, tmp_path):
    out = str(tmp_path)
    run.publish(spark, source, out)
    spark.read.parquet(f"{out}/coverage").limit(1).write.parquet(f"{out}/other")
    (tmp_path / "coverage").rename(tmp_path / "kept")
    (tmp_path / "other").rename(tmp_path / "coverage")
    assert run.stale(spark, source, out) == ["coverage"]
    (tmp_path / "coverage").rename(tmp_path / "other")
    (tmp_path / "kept").rename(tmp_path / "coverage")
    read = lambda n: spark.read.parquet(f"{out}/{n}").collect()
    assert {r.produto_normalizado for r in read("deliveries")} == {"Integração ao Login Único", "UNMATCHED"}  # the short catch-all is a fragment
    assert {r.motivo for r in read("changes")} == {"column_bleed", "multiplos_valores"}
    assert {(r.sigla, r.status_entregas, r.status_riscos) for r in read("coverage")} == {("A", "ok", "ok"), ("B", "sem_dados", "sem_pdf")}
    assert {r["count"] for r in read("vocabulary") if r.type == "tratamento"} == {1}
    assert any(r.variation_type == "alias" and r.field == "tratamento" for r in read("variations"))
    with pytest.raises(metrics.GateFailed, match="groups: 2"):
        run.quality_gate(spark, source, out)


def test_manifest():
    m = run.manifest({"b": {"bytes": 1}, "a": {"bytes": 2}}, {"title": "t", "commit": "old"}, commit="c", date="d")
    assert m == {"title": "t", "commit": "c", "date": "d", "outputs": {"a": {"bytes": 2}, "b": {"bytes": 1}}}
    assert run.comparable(m) == run.comparable({**m, "commit": "x", "date": "y"})


def test_usage(capsys):
    assert run.main(["derive"]) == 2 and "SOURCE" in capsys.readouterr().out
    assert run.git_head("/nonexistent") == ""
