"""Delivery tables of whole documents against a plain loop over their tables."""

import random

from tessaria.operators import extract

ROLES = {"Serviço": "servico", "Produto": "produto", "Eixo": "eixo", "Data Pactuada": "data_pactuada", "Prazo": "data_pactuada", "Justificativa": "justificativa", "Status": "status"}
PRODUCTS = ["Adequação à LGPD", "Integração ao Login Único", "Outros"]
PLAIN = ["alfa", "", "nan", "kappa zeta", "mar/2026"]
KEEP = ("servico", "produto", "eixo", "data_pactuada", "justificativa")
CELLS = "doc int, page int, table int, row int, col int, text string"


def role(text):
    return ROLES.get(text) or ("servico" if "ação" in text else None)  # such products name a service


def plain_rows(tables):
    """(page, row, recovered, the five fields) of one document's (headers, rows)."""
    known, out = None, []
    for page, (heads, rows) in enumerate(tables):
        n = len(heads)
        if n < 3 or not rows:
            continue
        heads = [h or f"Col{i}" for i, h in enumerate(heads)]
        named = {}
        for i, h in enumerate(heads):
            if role(h):
                named.setdefault(role(h), i)
        at, skip = None, False
        if "produto" in named or ("servico" in named and len(named) >= 2):
            at = named
        elif known and n == len(known) and heads[1] in PRODUCTS and heads[0].lower() not in ("nan", "none", ""):
            out.append((page, -1, True, heads[0], heads[1], heads[2], heads[4] if n > 4 else "", ""))
        if at is None and known is None:
            first = {}
            for i, c in enumerate(rows[0]):
                if role(c):
                    first.setdefault(role(c), i)
            if first:
                at, skip = first, True
            else:
                hit = next((i for r in rows for i, c in enumerate(r) if c in PRODUCTS), None)
                if hit is not None:
                    at = {r: i for r, i in (("produto", hit), ("servico", hit - 1), ("eixo", hit + 1)) if 0 <= i < n}
        if at is not None:
            known = {r: heads[i] for r, i in at.items()}
        elif known is None:
            continue
        else:
            at = {r: heads.index(h) for r, h in known.items() if h in heads}
            if "produto" in known and known["produto"] not in heads:
                at |= {"servico": 0, "produto": 1, "eixo": 2} | ({"data_pactuada": 4} if n >= 5 else {"data_pactuada": 3} if n == 4 else {})
        for i, r in enumerate(rows):
            if skip and i == 0:
                continue
            v = {f: r[at[f]] if f in at else "" for f in KEEP}
            if v["produto"].lower() in ("", "nan", "none", "produto"):
                v["produto"] = next((c for c in r if c in PRODUCTS), None)
            out.append((page, i, False, *[v[f] for f in KEEP]))
    return out


def document(rng):
    tables = []
    for _ in range(rng.randint(1, 4)):
        n = rng.choice([2, 3, 4, 4, 5])
        names = rng.sample(list(ROLES), n)
        unlike = [f"c{rng.randint(0, 3)}x{i}" for i in range(n)]
        body = lambda: [rng.choice(PRODUCTS if rng.random() < 0.3 else PLAIN) for _ in range(n)]  # noqa: B023, E731
        heads = rng.choice([names, unlike, ["alfa", rng.choice(PRODUCTS), *unlike[2:]], ["Col" + str(i) for i in range(n)], [""] * n])
        rows = [body() for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.3:
            rows.insert(0, rng.sample(list(ROLES), n))
        tables.append((heads, rows))
    return tables


def test_rows_against_a_loop(spark):
    rng = random.Random(7)
    docs = [document(rng) for _ in range(150)]
    cells = [(d, page, 1, row, col, text) for d, ts in enumerate(docs) for page, (heads, rows) in enumerate(ts) for row, line in enumerate([heads, *rows], -1) for col, text in enumerate(line)]
    got = extract.delivery_rows(spark.createDataFrame(cells, CELLS)).select("doc", "page", "row", "recovered", *KEEP).collect()
    want = [(d, *r) for d, ts in enumerate(docs) for r in plain_rows(ts)]
    assert len(want) > 200 and any(r[3] for r in want)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_nulls_and_empty_tables(spark):
    cells = [(1, 1, 1, -1, c, h) for c, h in enumerate(["Serviço", "Produto", None])] + [(1, 1, 1, 0, 0, None), (1, 1, 1, 0, 1, "Outros"), (1, 1, 1, 0, 2, None), (1, 1, 1, 1, 0, "x" * 5000), (1, 1, 1, 1, 1, None), (1, 1, 1, 1, 2, None)]
    lines = spark.createDataFrame([], "doc int, page int, line int, text string")
    got = extract.delivery_document_entries(spark.createDataFrame(cells, CELLS), lines).collect()
    assert [(r.method, r.servico_acao, r.produto_normalizado) for r in got] == [("tables", "", "Outros")]
    assert extract.delivery_document_entries(spark.createDataFrame([], CELLS), lines).count() == 0
