"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is a maximal run of ``LEAST`` or more characters of keys and tokens. Its features are
its length, its mix of characters and transitions between them, how well its characters follow
one another as in words, how much of it a dictionary covers, whether it stands in a path or an
address, and the words and marks beside it.

The forest is trained on labelled findings: a fixed set in which secrets of common formats, in
assignments and headers, are label 1, and checksums, versions, identifiers, paths, words and
numbers in their usual places are label 0 (``labelled_findings``). Callers with findings of their
own pass these instead. Dictionary and transitions are counted over all documents and their whole
texts: the dictionary has the words that most documents hold, as many as fit into ``DICTIONARY``.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.llm.common import shared_dir, stored, table, text_of
from tessaria.llm.forest import Forest

LEAST, NEAR = 16, 32
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_\-]{{{LEAST},}}={{0,2}}")
WORD = r"\p{L}+"
THRESHOLD = 0.5
#: The words of the dictionary are held by at least so many documents, and are so many at most: those that most documents hold.
DOCUMENTS, DICTIONARY = 3, 200_000
#: Letters of a word in the dictionary. Candidates are ASCII, so other words cover nothing.
SHORTEST, LONGEST = 4, 24

#: Words beside a candidate that speak for a secret, and against one.
FOR = ("secret", "token", "password", "passwd", "pwd", "key", "apikey", "auth", "authorization", "bearer", "credential", "credentials", "private", "access", "client", "login")
AGAINST = ("sha", "md5", "checksum", "hash", "commit", "revision", "digest", "uuid", "guid", "version", "build", "integrity", "etag", "page", "isbn", "order", "invoice", "phone", "blob", "tree", "parent")


class Words:
    """A dictionary and the log probabilities of pairs of the letters a to z.

    ``pairs`` counts two letters that follow one another in a word, ``firsts`` a letter that any follows.
    """

    def __init__(self, words: Iterable[str], pairs: dict[str, int], firsts: dict[str, int]):
        self.words = {*words, *FOR, *AGAINST}
        self.longest = max(map(len, self.words))
        self.pairs = {(p[0], p[1]): math.log((n + 0.5) / (firsts[p[0]] + 15)) for p, n in pairs.items()}
        self.unseen = math.log(1e-4)

    def flow(self, s: str) -> float:
        """Mean log probability of the candidate's neighbouring characters, as in words."""
        s = s.lower()
        return sum(self.pairs.get(p, self.unseen) for p in zip(s, s[1:], strict=False)) / max(1, len(s) - 1)

    def coverage(self, s: str) -> float:
        """Share of the characters inside dictionary words, longest first from the left."""
        s, at, got = s.lower(), 0, 0
        while at < len(s):
            for n in range(min(self.longest, len(s) - at), 3, -1):
                if s[at : at + n] in self.words:
                    at, got = at + n, got + n
                    break
            else:
                at += 1
        return got / max(1, len(s))


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


#: Characters of very long candidates beyond which transitions and coverage are taken in this many pieces' mean.
LONG = 512


def features(words: Words, text: str, start: int, end: int) -> list[float]:
    """The numbers that the forest sees of the candidate text[start:end]."""
    s = text[start:end]
    n = len(s)
    kinds = [_class(c) for c in s]
    counts = np.bincount(kinds, minlength=4) / n
    letters = Counter(s)
    entropy = -sum(k / n * math.log2(k / n) for k in letters.values())
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1)
    pieces = [s[i : i + LONG] for i in range(0, n, LONG)]
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    line = before.rpartition("\n")[2]
    beside = [w.lower() for w in re.findall(r"[A-Za-z]+", before)][-4:]
    own = [w.lower() for w in re.findall(r"[A-Za-z]{3,}", re.split(r"[=]", s)[0])][:4] if n < 64 else []
    tail = before.rstrip(" \t\"'`(")[-1:]
    return [
        math.log(n), float(n % 4 == 0), float(n in (32, 40, 56, 64, 96, 128)), *counts.tolist(), entropy, entropy / math.log2(max(2, n)), changes,
        sum(map(words.flow, pieces)) / len(pieces), sum(map(words.coverage, pieces)) / len(pieces),
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", s))), float(bool(re.fullmatch(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", s))), float(s.isdigit()), float(s.isalpha()),
        float(s.count("/")), float(s.count("-") + s.count("_")) / n, float(before.endswith(("/", ".", "@", "\\"))), float(after.startswith((".", "@", "/", "("))), float("://" in line or "www." in line),
        float(tail in ("=", ":")), float(before.endswith(('"', "'", "`"))), float(any(w.endswith(FOR) for w in beside)), float(bool(beside) and beside[-1].endswith(FOR)), float(any(w in AGAINST for w in beside)), float(any(w in FOR for w in own)),
        max(len(g[0]) for g in re.findall(r"((.)\2*)", s)) / n,
    ]


def labelled_findings(words: Words, n: int = 1500, seed: int = 5) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): secrets and look-alikes in their usual places, the same for the same words."""
    rng = random.Random(seed)
    vocabulary = sorted(words.words)
    hexa, b64, low = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789"
    of = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    word = lambda: rng.choice(vocabulary)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    secrets = [
        lambda: of(hexa, rng.choice((32, 40, 64))), lambda: of(b64, rng.choice((24, 32, 40, 44, 64))), lambda: "AKIA" + of(upper, 16), lambda: "ghp_" + of(b64[:-2], 36),
        lambda: "sk-" + of(b64[:-2], 48), lambda: "xoxb-" + of("0123456789", 12) + "-" + of(b64[:-2], 24), lambda: of(low, rng.choice((20, 24, 32))), lambda: of(b64[:-2] + "-_", rng.randint(20, 43)), lambda: of(upper, rng.choice((32, 40))),
    ]
    lures = [
        lambda: "".join(word() for _ in range(rng.randint(3, 6))), lambda: "".join(word().capitalize() for _ in range(rng.randint(3, 5))), lambda: "_".join(word() for _ in range(rng.randint(3, 5))), lambda: "-".join(word() for _ in range(rng.randint(3, 5))),
        lambda: "/".join(word() for _ in range(rng.randint(3, 6))), lambda: of("0123456789", rng.randint(16, 20)), lambda: "-".join(of(hexa, k) for k in (8, 4, 4, 4, 12)), lambda: rng.choice("-=_") * rng.randint(16, 60) + "-", lambda: (word() * 12)[: rng.randint(16, 60)], lambda: "_".join(word().upper() for _ in range(3)),
    ]
    marks = ['{k} = "{s}"', "{k}: {s}", "{k}={s}", "{k}='{s}'", 'export {k}="{s}"', "Authorization: Bearer {s}", '"{k}": "{s}"', '{k} = "{s}"']
    digests = ["commit {s}", "sha256:{s}", "md5 {s}", "checksum: {s}", "revision {s}", 'integrity="{s}"', "tree {s} parent", "uuid {s}", "etag: {s}"]
    plain = ["{s}", "{w} {s} {w}", "{w}, {s}.", "https://{w}.org/{s}", "/usr/{w}/{s}.py", "{w} ({s})", '"{s}"', "{w} = {s}", "{w}: {s}"]
    out = []
    while len(out) < n:
        secret = rng.random() < 0.45
        if secret:
            s, form, label = rng.choice(secrets)(), rng.choice(marks), 1
        elif rng.random() < 0.35:
            s, form, label = of(hexa, rng.choice((32, 40, 64))), rng.choice(digests), 0
        else:
            s, form, label = rng.choice(lures)(), rng.choice(plain + marks[:2]), 0
        name = rng.choice(FOR[:8])
        name = rng.choice((name, name.upper(), f"{word()}_{name}", f"api_{name}"))
        line = form.replace("{k}", name)
        while "{w}" in line:
            line = line.replace("{w}", word(), 1)
        lead, _, rest = line.partition("{s}")
        lead, rest = f"{word()} {word()} {lead}", f"{rest} {word()} {word()}"
        text = lead + s + rest
        found = next((m for m in CANDIDATE.finditer(text) if m.start() <= len(lead) < m.end()), None)
        if found:
            out.append((text, found.start(), found.end(), label))
    return out


def corpus_words(docs: DataFrame, text_col: str = "text") -> Words:
    """Dictionary and transitions of all documents, whole texts; null and empty texts have no words.

    Every word counts once a document. At most ``DICTIONARY`` words and 26 * 27 counts come to the driver.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_of(text_col)), F.lit(WORD), F.lit(0)))
    counts = stored(docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("docs")), "words")
    known = counts.filter((F.col("docs") >= DOCUMENTS) & F.regexp_like("word", F.lit(f"^[a-z]{{{SHORTEST},{LONGEST}}}$")))
    # the words above the greatest count at which they fit: ties go in or stay out together
    levels = known.groupBy("docs").agg(F.count("*").alias("n"))
    letter = "abcdefghijklmnopqrstuvwxyz"
    each = counts.select("docs", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("word") - 1, F.lit(1))), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"))
    pairs = each.filter((F.length("pair") == 2) & F.substring("pair", 1, 1).isin(*letter)).groupBy(F.substring("pair", 1, 1).alias("a"), F.when(F.substring("pair", 2, 1).isin(*letter), F.substring("pair", 2, 1)).alias("b")).agg(F.sum("docs").alias("n"))
    found, firsts = {}, Counter()
    for r in pairs.collect():
        firsts[r.a] += r.n
        if r.b is not None:
            found[r.a + r.b] = r.n
    room, least = DICTIONARY, None
    for r in levels.orderBy(F.desc("docs")).limit(DICTIONARY + 1).collect():  # each level has a word at least
        room -= r.n
        if room < 0:
            break
        least = r.docs
    dictionary = [] if least is None else [r.word for r in known.filter(F.col("docs") >= least).select("word").collect()]
    return Words(dictionary, found, firsts)


def trained(words: Words, findings: list[tuple[str, int, int, int]]) -> Forest:
    x = np.array([features(words, t, s, e) for t, s, e, _ in findings])
    return Forest().fit(x, np.array([label for *_, label in findings]))


def _findings(words: Words, forest: Forest, text: Column) -> Column:
    """array<struct<start,end,digest,score>> of the candidates of each text."""

    def run(texts: pd.Series) -> pd.Series:
        spots = [(i, m.start(), m.end()) for i, t in enumerate(texts) for m in CANDIDATE.finditer(t or "")]
        got: list[list] = [[] for _ in range(len(texts))]
        values = list(texts)
        for at in range(0, len(spots), 4096):
            part = spots[at : at + 4096]
            scores = forest.predict(np.array([features(words, values[i], s, e) for i, s, e in part]))
            for (i, s, e), p in zip(part, scores, strict=True):
                got[i].append({"start": s, "end": e, "digest": hashlib.sha256(values[i][s:e].encode("utf-8", "surrogatepass")).hexdigest(), "score": float(p)})
        return pd.Series(got, dtype=object)

    span = T.StructType().add("start", "long").add("end", "long").add("digest", "string").add("score", "double")
    return F.pandas_udf(run, T.ArrayType(span))(text)


def scan(df: DataFrame, words: Words | None = None, findings: list[tuple[str, int, int, int]] | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per candidate: id, start, end (code points, end exclusive), digest, score, is_secret.

    Null and empty texts, and texts without a candidate, give no row. Repeated rows are scanned
    alike, and each counts for the dictionary. A very long candidate is one candidate. An empty
    table gives an empty result; other columns of ``df`` are not read and may have any names. The
    digest is the candidate's SHA-256, so that a report holds no secret.
    """
    shared_dir(df.sparkSession)
    words = words or corpus_words(df, text_col)
    forest = trained(words, findings or labelled_findings(words))
    found = df.select(F.col(id_col).alias("doc_id"), F.explode(_findings(words, forest, F.col(text_col))).alias("f"))
    return found.select("doc_id", "f.start", "f.end", "f.digest", "f.score", (F.col("f.score") >= THRESHOLD).alias("is_secret"))


def redact(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with the spans replaced."""
    for start, end in sorted(spans, reverse=True):
        text = text[:start] + "[secret]" + text[end:]
    return text


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document, with the forest's score and decision."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
