"""The Merkle manifest against a plain tree, with odd rows, several rounds and other arities."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import ODD

from tessaria.llm import merkle

NAMES = "doc_id long, text string, lang string, source string, n_chars long, g string, at long, digest string, level int, size long, before string, place long, i int, c0 string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def path(tree, at, arity):
    """(before, after) of a leaf, level by level."""
    out = []
    for nodes in tree[:-1]:
        first = at // arity * arity
        run = nodes[first : first + arity]
        out.append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
        at //= arity
    return out


def expected(rows, arity=2):
    """doc_id, leaf, subroot, root, before, after of each row: (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for d, t, lang, s, n in rows:
        groups.setdefault(lang, []).append((d is not None, d or 0, leaf(d, s, lang, n, t), d))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], arity) for g in langs}
    top = levels([trees[g][-1][0] for g in langs], arity)
    out = []
    for k, g in enumerate(langs):
        for at, (_, _, own, d) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = path(trees[g], at, arity) + path(top, k, arity)
            out.append((d, own, trees[g][-1][0], top[-1][0], tuple(b for b, _ in steps), tuple(a for _, a in steps)))
    return out


def documents(spark, rows):
    """The rows, in three partitions, with extra columns that the operator's own helpers might clash with."""
    return spark.createDataFrame([(*r, "g", 1, "d", 2, 3, "b", 4, 5, "c") for r in rows], NAMES).repartition(3)


def odd_rows():
    rnd = random.Random(5)
    rows = [(i, t, None if i % 5 == 0 else f"l{i % 3}", "é" if i % 2 else None, None if i % 4 == 0 else i) for i, t in enumerate(ODD)]
    rows += [(100 + i, f"text {rnd.random()}", "hot", "s", i) for i in range(150)]
    rows += [(7, "again", "l1", "s", 1), (7, "again", "l1", "s", 1), (7, "other", "l1", "s", 1), (None, "no id", "l1", None, None), (None, None, None, None, None), (-3, "alone", "Ünique", "s", 3)]
    return rows


@pytest.mark.parametrize(("arity", "span"), [(2, 8), (2, 2), (3, 1)])
def test_against_a_plain_tree(spark, monkeypatch, arity, span):
    monkeypatch.setattr(merkle, "SPAN", span)
    rows = odd_rows()
    got = merkle.manifest(documents(spark, rows), merkle.FIELDS, "lang", "doc_id", arity).select("doc_id", "leaf", "subroot", "root", "before", "after").collect()
    assert sorted(((*r[:4], tuple(r[4]), tuple(r[5])) for r in got), key=repr) == sorted(expected(rows, arity), key=repr)


def test_offsets_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_RUNS", 0)
    rows = odd_rows()[:20]
    got = merkle.manifest(documents(spark, rows), merkle.FIELDS, "lang", "doc_id").select("doc_id", "root").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], r[3]) for r in expected(rows)), key=repr)


def test_tampered_rows_do_not_verify(spark):
    import zlib

    rows = odd_rows()
    got = merkle.tampered(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    proofs = {}
    for d, own, sub, root, before, after in expected(rows):
        proofs.setdefault((d, own), set()).add((sub, root, h(*itertools.chain.from_iterable(zip(before, after, strict=True)))))
    n_chars = {(r[0], leaf(r[0], r[3], r[2], r[4], r[1])): r[4] for r in rows}
    seen = 0
    for r in got:
        assert (r.subroot, r.root, r.proof_sha256) in proofs[r.doc_id, r.leaf]
        forged = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and n_chars[r.doc_id, r.leaf] is not None
        seen += forged
        assert r.verified == (not forged) == (r.folded_root == r.root)
    assert seen > 5


def test_one_row_and_none(spark):
    rows = [(1, "only", None, None, 4)]
    (r,) = merkle.tampered(documents(spark, rows)).collect()
    assert r.leaf == r.subroot == r.root == leaf(1, None, None, 4, "only") and r.proof_sha256 == h()
    assert merkle.tampered(documents(spark, rows).filter("false")).count() == 0


def test_children_in_any_order():
    leaves = [h(str(i)) for i in range(11)]
    for seed in range(5):
        partials = merkle.Partials(2, 8)
        order = list(enumerate(leaves))
        random.Random(seed).shuffle(order)
        for at, d in order:
            partials.add("g", 11, 0, at, d, ())
        assert partials.rest() == [] and len(partials.rows) == 11 + 6 + 3 + 2 + 1
        assert [r[4] for r in partials.rows if r[5] is None] == levels(leaves, 2)[-1]


def test_fold_of_a_proof(spark):
    df = spark.createDataFrame([("x", ["a", ""], ["", "b"])], "d string, b array<string>, a array<string>")
    assert df.select(merkle.fold(F.col("d"), F.col("b"), F.col("a"))).first()[0] == h(h("a", "x"), "b")
