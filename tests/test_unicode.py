"""Normal forms in any script, against the standard library."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessaria.functions import text as tx


def bare(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


ASSIGNED = [c for c in range(1, 0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
MARKS = [c for c in ASSIGNED if unicodedata.combining(chr(c))]


def random_runs(n, seed):
    """A letter, then marks in any order, some of them after another letter."""
    rnd = random.Random(seed)
    return ["".join(chr(rnd.choice(ASSIGNED)) + "".join(chr(rnd.choice(MARKS)) for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 3))) for _ in range(n)]


@pytest.mark.parametrize(
    ("rule", "plain"),
    [
        (tx.composed, lambda s: unicodedata.normalize("NFC", s)),
        (tx.decomposed, lambda s: unicodedata.normalize("NFKD", s)),
        (tx.strip_accents, bare),
        (lambda c: tx.normalize_text(F.concat(F.lit("x"), c, F.lit("y"))), lambda s: " ".join(unicodedata.normalize("NFC", "".join(c for c in f"x{s}y" if unicodedata.category(c) != "Cf")).split())),
    ],
)
def test_every_character_and_runs_of_marks(spark, rule, plain):
    texts = [chr(c) for c in ASSIGNED] + random_runs(20_000, 1)
    rows = spark.createDataFrame([(t,) for t in texts], "s string").repartition(4)
    wrong = [(r.s, r.got) for r in rows.select("s", rule(F.col("s")).alias("got")).toLocalIterator() if r.got != plain(r.s)]
    assert not wrong[:5]


def test_null_and_where_it_may_stand(spark):
    rows = spark.createDataFrame([(None, 1), ("é", 2), ("é", 3), ("E", 4)], "s string, n int")
    assert [r[0] for r in rows.orderBy("n").select(tx.composed(F.col("s"))).collect()] == [None, "é", "é", "E"]
    assert rows.select(tx.key(F.col("s")).alias("k")).groupBy("k").count().filter("k = 'e'").first()["count"] == 3
    assert rows.filter(tx.key(F.col("s")) == "e").count() == 3
