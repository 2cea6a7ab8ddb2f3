"""The registered queries: names, and a few of them against their SQL on the smallest tables."""

import duckdb
import pytest

from tessaria.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else int(v) if v.__class__.__name__ == "Decimal" else v


def same(spark, con, f, sql):
    df = f(spark, SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    want = sorted((tuple(map(plain, r)) for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall()), key=repr)
    return got == want


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) and len(catalog.QUERIES) > 60


@pytest.mark.parametrize("name", ["coverage_status", "shared_file_owner", "normalize_text", "parse_date_mixed", "slot_fill", "organ_listing", "header_acronyms", "first_per_key", "validation_report", "harmonize_cell", "variations_long", "consolidate_blocks", "carry_headers", "delivery_document_entries", "fuzzy_best"])
def test_against_sql(spark, duck, name):
    assert same(spark, duck, catalog.QUERIES[name], catalog.ORACLES[name])
