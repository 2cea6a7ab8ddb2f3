"""Personal data: base spans against Python's regular expressions, disclosure, sanitising, and the SQL."""

import hashlib
import re

import duckdb
from tests.llm.conftest import ODD

from tessaria.llm import pii

TEXTS = [
    "mail a.b+c@x-y.example.com, x@y.z_x@y.z a@b.c@d.e.f @no no@ a@b",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.3.255 1.2.3 9.9.9.999",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5500000000000004 1" + "2" * 40,
    "call +49 (30) 1234-5678. or +1 2 or ++49 30 1234 5678 +123456789012345678",
    "+49 4111111111111111 é漢字 x@é.com ü@a.bc",
    "1" * 9000 + " " + "a" * 9000 + " " + "1 " * 3000 + "q@" + "x" * 3000,
    "a@b.cc " * 700,
]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def expected(text):
    out = []
    for rank, (kind, p) in enumerate(pii.SQL_PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def test_base_spans(documents):
    texts = TEXTS + ODD
    for r in pii.find(documents(texts)).collect():
        want = expected(texts[r.doc_id])
        assert [(b.s, b["rank"], b.kind, b.e) for b in r.base] == want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[2] == k for w in want) for k in pii.KINDS]


def corpus():
    telling = "Our colleague Zaphod writes from me@corp.example every day about things"
    return [telling + f" number {i}" for i in range(3)] + [f"every day there are things to write about, number {i}" for i in range(60)] + ["me@corp.example alone here, Quagmire"]


def test_terms_that_disclose(documents):
    texts = corpus()
    got = {r.doc_id: r for r in pii.sanitise(documents(texts)).collect()}
    words = {texts[0][t.s : t.e]: t.treatment for t in got[0].terms}
    assert words.get("Zaphod") == "remove" and words.get("colleague") == "remove"
    assert "things" not in words and "every" not in words  # common words tell nothing
    assert got[63].terms == []  # one document is no support
    assert all(not got[i].terms and got[i].sanitised == texts[i] for i in range(3, 63))
    assert "Zaphod" not in got[0].sanitised and "@" not in got[0].sanitised and "[email]" in got[0].sanitised
    assert got[0].sanitised.endswith("about things number 0")


def test_every_place_in_documents_with_the_entity(documents):
    """A term that discloses goes wherever it stands in a document with its entity, near or not, short or with digits."""
    near = "Zaphod and Li of X-42B (me@corp.example)"
    texts = [f"{near} wrote this. " + "many plain words follow here " * 20 + f"Zaphod signed it, says Li, {i}; x-42b." for i in range(3)]
    texts += ["many plain words follow here"] * 60 + ["me@corp.example: " + "words " * 30 + "Zaphod", "Zaphod without the address"] + ["words"] * 60
    got = {r.doc_id: r for r in pii.sanitise(documents(texts)).collect()}
    for i in range(3):
        assert not any(w in got[i].sanitised for w in ("Zaphod", "Li", "X-42B", "x-42b")) and "many plain words" in got[i].sanitised
    marked = {texts[0][t.s : t.e] for t in got[0].terms}
    assert {"Zaphod", "Li", "X-42B", "x-42b"} <= marked and "plain" not in marked
    assert "Zaphod" not in got[63].sanitised  # far from the address, but in a document that holds it
    assert got[64].sanitised == texts[64]


def test_both_ways_of_counting_terms(documents, monkeypatch):
    want = [tuple(r) for r in pii.find(documents(corpus())).select("doc_id", "terms").orderBy("doc_id").collect()]
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)
    assert [tuple(r) for r in pii.find(documents(corpus())).select("doc_id", "terms").orderBy("doc_id").collect()] == want


def test_repeated_and_null_ids_and_clashes(documents):
    rows = documents(["a@b.cc", "a@b.cc", None], [1, 1, None]).withColumnRenamed("score", "base")
    out = pii.find(rows).collect()
    assert sorted((r.doc_id is None, r.n_email) for r in out) == [(False, 1), (False, 1), (True, 0)]
    assert pii.find(rows.limit(0)).count() == 0


def test_against_sql(spark):
    d = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    got = pii.op7_pii(spark, d)
    rows = got.collect()
    assert sorted(map(tuple, rows)) == sorted(duckdb.sql(pii.SQL).project(", ".join(got.columns)).fetchall())
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(",".join(s for s in r.spans.split(",") if not s.startswith("term")).encode()).hexdigest()
