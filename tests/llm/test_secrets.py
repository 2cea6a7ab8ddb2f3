"""Secret scans: the forest, unseen labelled findings, whole texts, odd rows."""

import hashlib
import re
from collections import Counter

import numpy as np
from tests.llm.conftest import ODD

from tessaria.llm import secrets
from tessaria.llm.forest import Forest

PROSE = ["the quick brown fox jumps over lazy dogs and other animals in the forest while people watch them quietly", "information about development and organisation of large documents with paragraphs"] * 4
KEY = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"


def counted(texts):
    """The dictionary's words, pairs and firsts of a corpus, counted plainly."""
    docs, pairs, firsts = Counter(), Counter(), Counter()
    for text in texts:
        words = {"".join(w) for w in re.findall(r"[^\W\d_]+", (text or "").lower())}
        docs.update(words)
        for w in words:
            pairs.update(w[i : i + 2] for i in range(len(w) - 1) if re.fullmatch("[a-z]{2}", w[i : i + 2]))
            firsts.update(c for c in w[:-1] if c in "abcdefghijklmnopqrstuvwxyz")
    return {w: n for w, n in docs.items() if re.fullmatch("[a-z]{4,24}", w)}, pairs, firsts


def known():
    words, pairs, firsts = counted(PROSE)
    return secrets.Words(words, pairs, firsts)


def test_dictionary_of_all_documents(documents, monkeypatch):
    texts = PROSE + ["naïve Straße zebra Zebra ab", "zebra giraffe a", None, "", "word " * 50_000 + "zebra giraffe", "giraffe", *["quick brown lazy animals"] * 3]
    words, pairs, firsts = counted(texts)
    want = secrets.Words([w for w, n in words.items() if n >= 3], pairs, firsts)
    got = secrets.corpus_words(documents(texts))
    assert got.words == want.words and got.pairs == want.pairs and "zebra" in got.words and "word" not in got.words
    monkeypatch.setattr(secrets, "DICTIONARY", 20)
    few = secrets.corpus_words(documents(texts)).words - {*secrets.FOR, *secrets.AGAINST}
    assert few == {"quick", "brown", "lazy", "animals"} and len([w for w, n in words.items() if n >= 3]) > 20  # the next words tie and do not fit
    assert secrets.corpus_words(documents(["a"]).limit(0)).pairs == {}


def test_candidates_and_features_against_a_plain_version(documents):
    """Every maximal run of 16 or more key characters of every text is a candidate, with the score of its features."""
    words = known()
    forest = secrets.trained(words, secrets.labelled_findings(words))
    texts = [*ODD, "a" * 15, "a" * 16 + "== b", f"({KEY}) and {KEY}=", "é" + "Z9" * 600 + "漢" + "q" * 17, "x-y_z/w+" * 3 + "===", *PROSE]
    want = []
    for i, t in enumerate(texts):
        for m in re.finditer("[A-Za-z0-9+/_-]+", t or ""):
            if len(m[0]) >= 16:
                end = m.end() + len(re.match("={0,2}", t[m.end() :])[0])
                p = forest.predict(np.array([secrets.features(words, t, m.start(), end)]))[0]
                want.append((i, m.start(), end, hashlib.sha256(t[m.start() : end].encode()).hexdigest(), p >= secrets.THRESHOLD))
    got = secrets.scan(documents(texts), words).collect()
    assert sorted((r.doc_id, r.start, r.end, r.digest, r.is_secret) for r in got) == sorted(want)


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = secrets.op10_secret_scan(spark, d).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    planted = {(i, m.start(1)) for i, t in texts.items() for m in re.finditer(r'token = "([A-Za-z0-9]{16,})"', t or "")}
    assert {(r.doc_id, r.start) for r in rows if r.is_secret} == planted


def test_forest_learns_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    p = Forest().fit(x[:400], y[:400]).predict(x[400:])
    assert ((p >= 0.5) == y[400:]).mean() > 0.9 and Forest().predict(x[:0]).shape == (0,)


def test_unseen_findings():
    words = known()
    forest = secrets.trained(words, secrets.labelled_findings(words))
    unseen = secrets.labelled_findings(words, 500, seed=77)
    p = forest.predict(np.array([secrets.features(words, t, s, e) for t, s, e, _ in unseen]))
    assert np.mean((p >= secrets.THRESHOLD) == [label for *_, label in unseen]) > 0.95


def test_scan(documents):
    texts = PROSE + [f'x {"a " * 30_000}token = "{KEY}" z', f"commit {KEY} merged", "https://x.org/some-long-path-of-words-here", *ODD]
    rows = secrets.scan(documents(texts), known()).collect()
    by = {r.doc_id: r for r in rows}
    n = len(PROSE)
    assert by[n].is_secret and texts[n][by[n].start : by[n].end] == KEY and by[n].digest == hashlib.sha256(KEY.encode()).hexdigest()
    assert not by[n + 1].is_secret and not by[n + 2].is_secret
    assert secrets.redact(texts[n], [(by[n].start, by[n].end)]).endswith('token = "[secret]" z')
    assert not {n + 3, n + 4, n + 5} & set(by)


def test_empty_and_null_ids(documents):
    assert secrets.scan(documents(["a"]).limit(0)).count() == 0
    assert secrets.scan(documents([f'token = "{KEY}"'] * 2, [None, None])).count() == 2


def test_own_findings(documents):
    own = [(f"k: {'a' * 20}", 3, 23, 1), (f"k: {'1' * 20}", 3, 23, 0)] * 20
    rows = secrets.scan(documents(["k: " + "a" * 20, "k: " + "1" * 20]), known(), own).collect()
    assert {r.doc_id: r.is_secret for r in rows} == {0: True, 1: False}
