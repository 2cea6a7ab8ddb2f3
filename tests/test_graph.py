"""Derivations: exactly what depends on a change is made again, and a check compares digests."""

import pytest
from pyspark.sql import functions as F

from tessaria.operators import errors
from tessaria.plans import graph


class World:
    """Two sources and four tables that count how often each is made."""

    def __init__(self, spark, out, version=""):
        self.made, self.fail = [], None
        self.data = {"a": [(1, "x"), (2, "y"), (2, "y")], "b": [(1, "u")]}
        frame = lambda name: spark.createDataFrame(self.data[name], "k long, v string")

        def table(name, inputs, make, order=()):
            def run(*dfs):
                self.made.append(name)
                df = make(*dfs)
                return df.withColumn("v", F.raise_error(F.lit("stop"))) if self.fail == name else df

            return graph.Table(name, inputs, run, order)

        tables = [
            table("big", ("a",), lambda a: a.filter("k > 1"), ("k",)),
            table("other", ("b",), lambda b: b.withColumn("w", F.upper("v"))),
            table("joined", ("big", "b"), lambda x, y: x.unionByName(y)),
            table("last", ("joined", "other"), lambda x, y: x.groupBy("v").agg(F.count("*").alias("n"))),
        ]
        self.d = graph.Derivation(spark, tables, {"a": lambda: frame("a"), "b": lambda: frame("b")}, str(out), version)

    def update(self, **k):
        self.made.clear()
        assert self.d.update(**k) == self.made
        return list(self.made)


def test_only_what_depends_on_a_change_is_made(spark, tmp_path):
    w = World(spark, tmp_path)
    assert w.d.stale() == ["big", "other", "joined", "last"]
    assert w.update() == ["big", "other", "joined", "last"]
    assert w.update() == [] and w.d.stale() == []
    assert {(r.table, r.input) for r in w.d.lineage().collect()} == {("big", "a"), ("other", "b"), ("joined", "big"), ("joined", "b"), ("last", "joined"), ("last", "other")}
    w.data["a"] = [(2, "y"), (2, "z"), (1, "x")]
    assert w.d.stale() == ["big", "joined", "last"]
    assert w.update() == ["big", "joined", "last"]
    w.data["a"] = [(2, "z"), (2, "y"), (0, "changed")]  # big comes out the same, in another order
    assert w.update() == ["big"]
    w.data["b"] = [(1, "U")]
    assert w.update() == ["other", "joined", "last"] and w.d.read("last").count() == 3


def test_damage_failure_and_version(spark, tmp_path):
    w = World(spark, tmp_path)
    w.update()
    w.d.read("other").limit(0).write.parquet(str(tmp_path / "empty"))
    (tmp_path / "other").rename(tmp_path / "kept")
    (tmp_path / "empty").rename(tmp_path / "other")
    assert w.d.stale() == ["other"] and w.update() == [] and w.update(verify=True) == ["other"]
    (tmp_path / "joined").rename(tmp_path / "gone")
    assert w.d.stale() == ["joined"] and w.update(verify=True) == ["joined"]
    w.data["a"] = [(5, "q")]
    w.fail = "joined"
    with pytest.raises(Exception, match="stop"):
        w.d.update()
    w.fail = None
    assert w.d.stale() == ["joined", "last"] and w.update() == ["joined", "last"]
    assert World(spark, tmp_path, "2").update() == ["big", "other", "joined", "last"]


def test_order_of_tables(spark, tmp_path):
    t = graph.Table("x", ("y",), lambda y: y)
    with pytest.raises(ValueError, match="before its inputs"):
        graph.Derivation(spark, [t], {}, str(tmp_path))
    with pytest.raises(ValueError, match="twice"):
        graph.Derivation(spark, [t, t], {"y": lambda: None}, str(tmp_path))


def test_digests_of_tables(spark):
    rows = [(i % 5, f"v{i % 9}", None if i % 4 else i / 3) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b string, c double")
    same = spark.createDataFrame(rows[::-1], "a long, b string, c double").repartition(7).select("c", "a", "b")
    assert graph.digest(df) == graph.digest(same) and graph.differing_buckets(df, same.select("a", "b", "c")) == []
    for other in (rows[1:], [*rows, rows[0]], [(9, *rows[0][1:]), *rows[1:]]):
        changed = spark.createDataFrame(other, "a long, b string, c double")
        assert graph.digest(changed) != graph.digest(df) and 1 <= len(graph.differing_buckets(df, changed)) <= 2
    assert graph.digest(df.limit(0)) != graph.digest(df.limit(0).withColumn("d", F.lit(1)))


def test_rows_and_errors_of_one_scan(spark):
    rows = [("A", 5, "pdf"), ("B", None, "pdf"), ("C", -1, "zip"), (None, -2, "pdf"), ("E", 7, None)]
    df = spark.createDataFrame(rows, "errors string, n int, kept string")
    checks = [
        errors.Check("download", "missing", F.col("n").isNull(), F.lit("nothing")),
        errors.Check("extraction", "odd_kind", F.col("kept") != "pdf", F.concat(F.lit("is "), F.col("kept")), fatal=False),
        errors.Check("standardization", "negative", F.col("n") < 0, F.col("n")),
    ]
    kept, wrong, counts = errors.channel(df, checks, F.col("errors"), F.lit("entregas"), F.lit("2025"), F.col("kept"))
    assert kept.columns == df.columns and {r.errors for r in kept.collect()} == {"A", "E"}
    got = sorted((tuple(r) for r in wrong.collect()), key=repr)
    assert wrong.columns == errors.COLUMNS and got == sorted([
        ("B", "entregas", "download", "missing", "nothing", "2025", "pdf"), ("C", "entregas", "extraction", "odd_kind", "is zip", "2025", "zip"),
        ("C", "entregas", "standardization", "negative", "-1", "2025", "zip"), (None, "entregas", "standardization", "negative", "-2", "2025", "pdf"),
    ], key=repr)
    assert counts.get == {"rows": 5, "kept": 2, "download.missing": 1, "extraction.odd_kind": 1, "standardization.negative": 2}
    both = errors.together(wrong, spark.createDataFrame([("Z", "listing")], "orgao_sigla string, stage string"))
    assert both.count() == 5 and both.filter("stage = 'listing'").first().url is None
    assert errors.channel(df.limit(0), checks, F.col("errors"), F.lit("x"), F.lit("t"))[1].count() == 0
