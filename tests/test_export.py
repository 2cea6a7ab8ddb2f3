"""Ordered exports: byte for byte what one sorted writer makes, published at once."""

import io

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessaria.sources import export

SCHEMA = "sigla string, texto string, n long, score double, ok boolean"


def rows():
    odd = [("B", 'quoted "x", y', 1, 0.5, True), (None, "line\nend", None, None, None), ("", "\r", 2, 1.0, False), ("Á", "ç;😀", 3, 0.8625, True), ("A", None, 4, float("nan"), False), ("A", "", 5, 1e-9, True)]
    return odd + [(f"s{i % 7}", f"t{i % 31}", i, i / 8, i % 2 == 0) for i in range(500)]


def one_file(order):
    """The rows by a stable sort, null as empty, written by a single writer."""
    rank = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)  # noqa: E731  equal keys never meet two kinds of values
    table = sorted(rows(), key=lambda r: (*[(r[i] or "").encode() for i in order], *[rank(r[i]) for i in range(5) if i not in order]))
    frame = pd.DataFrame(table, columns=["sigla", "texto", "n", "score", "ok"], dtype=object)
    out = io.BytesIO()
    frame.to_csv(out, index=False, encoding="utf-8-sig", lineterminator="\n")
    return out.getvalue()


def test_parts_make_one_sorted_file(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    found = export.write(df, str(tmp_path / "out"), "sigla", "texto", parts=4)
    got = b"".join(export.chunks(str(tmp_path / "out"), 100))
    assert got == one_file([0, 1]) and got.startswith(b"\xef\xbb\xbfsigla,texto")
    assert found["rows"] == 506 and found["bytes"] == len(got) and len(found["parts"]) == 5
    again = export.write(df.repartition(2), str(tmp_path / "out2"), "sigla", "texto")
    assert b"".join(export.chunks(str(tmp_path / "out2"))) == got and again["rows"] == 506


def test_a_new_export_replaces_the_old_one(spark, tmp_path):
    path = "file://" + str(tmp_path / "out")
    df = spark.createDataFrame(rows(), SCHEMA)
    first = export.write(df, path, "sigla")
    second = export.write(df.limit(3), path, "sigla", mark=False)
    assert first["run"] != second["run"] and second["rows"] == 3
    assert [p.name for p in (tmp_path / "out").iterdir() if p.is_dir()] == [second["run"]]
    assert not next(export.chunks(path)).startswith(b"\xef\xbb\xbf") and export.damaged(path) == []


def test_a_failed_export_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(rows(), SCHEMA)
    export.write(df, path, "sigla")
    before = b"".join(export.chunks(path))
    broken = df.withColumn("n", F.when(F.col("n") == 400, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="stop"):
        export.write(broken.repartition(3), path)
    assert b"".join(export.chunks(path)) == before


def test_damage_is_found(spark, tmp_path):
    path = tmp_path / "out"
    found = export.write(spark.createDataFrame(rows(), SCHEMA).repartition(3), str(path), "n")
    last = path / found["run"] / found["parts"][-1]["name"]
    last.write_bytes(last.read_bytes() + b"x")
    assert export.damaged(str(path)) == [last.name]
    last.unlink()
    assert export.damaged(str(path)) == [last.name]


def test_no_rows(spark, tmp_path):
    found = export.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "out"), "sigla")
    assert b"".join(export.chunks(str(tmp_path / "out"))) == b"\xef\xbb\xbfsigla,texto,n,score,ok\n" and found["rows"] == 0


def test_digests_of_many():
    leaves = [str(i) for i in range(200)]
    assert export.digest_tree(leaves) != export.digest_tree(leaves[::-1])
    assert export.digest_tree(["a"]) == "a" and len(export.digest_tree([])) == 64
