"""License scan: places, suppression, odd rows, and the SQL."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import ODD

from tessaria.llm import license_rules, license_scan

TEXTS = [
    "Released under the MIT License. mit\nlicense; MIT-license",
    "GNU Lesser General Public License",
    "general public license general public license",
    "SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "_mit_license_ émit license mit éicense",
    "mitlicense gplv3 GPL v2 cc by-nc 4.0",
    "permission is hereby granted, free of charge",
    "license",
]


def scan(documents, texts):
    return {r.doc_id: r for r in license_scan.scan(documents(texts)).collect()}


def test_places_and_labels(documents):
    got = scan(documents, TEXTS + ODD)
    assert (got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (3, 3, 7, "mit")
    assert got[1].base_labels == "gpl" and got[1].labels == "gpl,lgpl" and got[1].first_word == 2
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 0, 3)
    assert got[3].labels == "apache" and got[3].score == 1.0
    assert got[4].labels == "gpl" and got[4].first_word == 7
    assert got[5].n_base == 1 and got[5].first_word == 0
    assert got[6].labels == "cc-by-nc,gpl" and got[6].n_base == 0 and got[6].first_word is None
    assert got[7].labels == "permission-notice" and got[8].labels == "" and got[8].score == 0.0
    for i in (len(TEXTS), len(TEXTS) + 1, len(TEXTS) + 2):
        assert got[i].n_words == 0 and got[i].labels == ""
    assert got[len(TEXTS) + 6].n_words == 4


def test_counts_against_the_definition(documents):
    texts = TEXTS + ODD
    for i, r in scan(documents, texts).items():
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (texts[i] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        places = [k for _, phrase in license_rules.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(places, default=None), max(places, default=None))


def test_every_rule_passes_the_gate_and_its_keyword():
    rules = license_rules.rules()
    assert len(rules) > 250 and len({r[1] for r in rules}) > 50
    gate = re.compile(license_rules.gate())
    for _, _, _, keyword, pattern in rules:
        sample = re.sub(r"\(\?: \|\$\)$", "", pattern).removeprefix("^(?:").removesuffix(")")
        sample = re.sub(r"\((?:\?:)?([^|()]*)[^()]*\)\??", r"\1", sample)
        sample = re.sub(r"\[(.)[^]]*\]", r"\1", sample).replace("\\d", "1").replace("?", "")
        if sample.split(" ")[0] == keyword:
            assert gate.search(sample), pattern


def test_containment_needs_the_same_or_a_higher_priority(spark):
    found = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(p).alias("priority"), F.lit(x).alias("label")) for a, b, p, x in [(0, 9, 3, "long"), (2, 5, 2, "inner"), (3, 5, 4, "weak"), (8, 12, 3, "next")]])
    assert sorted(x.label for x in spark.range(1).select(license_scan._standing(found)).first()[0]) == ["inner", "long", "next"]


def test_empty(documents):
    assert license_scan.scan(documents(["a"]).limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_against_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    got = license_scan.op1_license_scan(spark, d)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(duckdb.sql(license_scan.SQL).project(", ".join(got.columns)).fetchall(), key=repr)
