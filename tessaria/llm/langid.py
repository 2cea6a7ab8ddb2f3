"""Language identification: script ranges, word scores, and Viterbi over a text's words.

A word's script (by its first letter's code point) leaves the languages whose training text uses
that script. Each of these scores the word by its character n-grams and as a whole. Viterbi with
a penalty for every switch labels spans of one language; the language with most letters is the
text's, its share of the letters the score.

The n-gram tables are fitted on the words of a bounded sample: at most ``SAMPLE`` documents of
each language, their whole texts. Their words are counted where they are, and only the counts come
to the driver. Every word of every text is labelled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.llm.common import fold, table, text_of

FOLDS, HELD_OUT = 3, 1
#: Documents of each language that the model is fitted on.
SAMPLE = 150
GRAMS, SMOOTH, SWITCH = (2, 3), 0.5, 6.0
#: A language uses a script if that has this share of its words.
USES = 0.01
UNKNOWN = "und"
#: Words whose scores a worker keeps; words labelled at once.
KEPT, AT_ONCE = 300_000, 400_000
WORD = re.compile(r"[^\W\d_]+")
#: First code points of script ranges, and the scripts; -1 is all that has no range of its own.
SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0x20000, "han"),
)
_STARTS = [s for s, _ in SCRIPTS]


def script(word: str) -> str:
    return SCRIPTS[max(0, bisect_right(_STARTS, ord(word[0])) - 1)][1]


def grams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1)] + [f"={word}"]


class Model:
    """Log probabilities of n-grams by language, and the scripts of each language."""

    def __init__(self, samples: dict[str, dict[str, int]]):
        """samples: by language, how often each lower-case word occurs. Languages come in order of their names."""
        self.langs = sorted(samples)
        counts, words = [Counter() for _ in self.langs], [Counter() for _ in self.langs]
        for i, lang in enumerate(self.langs):
            for w, n in samples[lang].items():
                for g in grams(w):
                    counts[i][g] += n
                words[i][script(w)] += n
        seen = sorted({g for c in counts for g, n in c.items() if n > 1})
        totals = {k: np.array([sum(n for g, n in c.items() if self._kind(g) == k) for c in counts], dtype=np.float64) for k in (*GRAMS, 0)}
        sizes = {k: max(1, sum(self._kind(g) == k for g in seen)) for k in totals}
        rows = [np.log((np.array([c[g] for c in counts]) + SMOOTH) / (totals[self._kind(g)] + SMOOTH * sizes[self._kind(g)])) for g in seen]
        # the most likely language costs nothing; n-grams that no language has, and words not seen as a whole, cost nothing in any
        self.index = {g: i + 1 for i, g in enumerate(seen)}
        self.rows = np.array([np.zeros(len(self.langs)), *(v - v.max() for v in rows)], dtype=np.float32)
        self.scripts = {s: np.array([c[s] >= USES * max(1, sum(c.values())) for c in words]) for s in {s for c in words for s in c}}

    @staticmethod
    def _kind(gram: str) -> int:
        return 0 if gram[0] == "=" else len(gram)

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of lower-case words by language; a language without the word's script is out, if any has it."""
        if not words:
            return np.zeros((0, len(self.langs)), dtype=np.float32)
        get, ids, starts = self.index.get, [], []
        for w in words:
            starts.append(len(ids))
            ids += [get(g, 0) for g in grams(w)]
        total = np.add.reduceat(self.rows[ids], starts, axis=0)
        kinds = [script(w) for w in words]
        for kind in set(kinds):
            uses = self.scripts.get(kind)
            if uses is not None and uses.any() and not uses.all():
                total[np.ix_([k == kind for k in kinds], ~uses)] = -1e4
        return total


def viterbi(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best language of each word of texts that lie one after another, each switch at a cost.

    All texts advance together, a word at a time, in order of length, so that a step only touches
    texts that still have words.
    """
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    live = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")  # texts with more than t words
    came = np.zeros(scores.shape, dtype=bool)  # whether the best way to here switched
    top = np.zeros(len(scores), dtype=np.int16)  # the best label of the word before
    best = scores[starts[: live[0]]].copy() if len(live) else scores[:0]
    ends = best.copy()
    for t in range(1, len(live)):
        n = live[t]
        best = best[:n]
        at = starts[:n] + t
        lead = best.argmax(axis=1)
        switched = best[np.arange(n), lead][:, None] - SWITCH
        came[at], top[at] = best < switched, lead
        best = np.maximum(best, switched) + scores[at]
        ends[:n] = best
    out = np.zeros(len(scores), dtype=np.int16)
    label = ends.argmax(axis=1) if len(live) else np.zeros(0, dtype=np.int64)
    now = label.astype(np.int16)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = starts[:n] + t
        out[at] = now[:n]
        now[:n] = np.where(came[at, now[:n]], top[at], now[:n])
    return out


class Labeller(dict):
    """Labels the words of many texts; the scores of words met before are kept, by number."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.scores = np.zeros((0, len(model.langs)), dtype=np.float32)

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n

    @staticmethod
    def words(text: str | None) -> list[str]:
        """The words, lower-cased."""
        text = text or ""
        low = text.lower()
        return WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]

    def label(self, texts: list[str | None]) -> list[tuple[list[int], np.ndarray]]:
        """(the words' lengths, their labels) of each text."""
        done, at = [], 0
        while at < len(texts):
            group, ids = [], []
            while at < len(texts) and (not group or len(ids) < AT_ONCE):
                words = self.words(texts[at])
                group.append(list(map(len, words)))
                ids += map(self.__getitem__, words)
                at += 1
            if self.new:
                self.scores = np.concatenate([self.scores, self.model.words(self.new)])
                self.new = []
            lengths = np.array([len(x) for x in group], dtype=np.int64)
            labels = viterbi(self.scores[ids], lengths[lengths > 0]) if ids and self.model.langs else np.zeros(len(ids), dtype=np.int16)
            ends = np.cumsum(lengths)
            done += [(x, labels[e - k : e]) for x, e, k in zip(group, ends, lengths, strict=True)]
            if len(self) > KEPT:
                self.clear()
                self.scores = self.scores[:0]
        return done

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
        """(language, its share of the letters, spans (language, start, end)) of each text."""
        out, langs = [], self.model.langs
        for (letters, labels), text in zip(self.label(texts), texts, strict=True):
            if not letters or not langs or not any(map(str.isalpha, text)):
                out.append((UNKNOWN, 0.0, []))
                continue
            by = np.bincount(labels, weights=letters, minlength=len(langs))
            cuts = (np.flatnonzero(np.diff(labels)) + 1).tolist()
            if cuts:
                found = [(m.start(), m.end()) for m in WORD.finditer(text)]
                spans = [(langs[labels[i]], found[i][0], found[j - 1][1]) for i, j in zip([0, *cuts], [*cuts, len(found)], strict=True)]
            else:
                end = len(text) - re.search(r"[^\W\d_]", text[::-1]).start()
                spans = [(langs[labels[0]], WORD.search(text).start(), end)]
            out.append((langs[int(by.argmax())], float(by.max() / by.sum()), spans))
        return out


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, word, n) of (lang, text), summed up by task."""
    by: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            by.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
    for lang, words in by.items():
        yield pd.DataFrame({"lang": lang, "word": list(words), "n": list(words.values())})


def fitted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """The model of ``SAMPLE`` documents of each language outside the held-out fold, picked by a hash of the id.

    Their whole texts count; null and empty texts count nothing. Of rows that repeat an id the one
    whose language, then text, comes first counts. Rows without language or id are left out, and
    without any row left the model knows no language.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text_of(text_col).alias("text")).filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & (fold("id", FOLDS) != HELD_OUT))
    names = rows.groupBy("id").agg(F.min("lang").alias("l"))
    # a language is first cut into cells, so that no task sorts all of a hot one
    cell = F.pmod(F.xxhash64("id", F.lit("cell")), F.lit(64))
    nth = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy(F.xxhash64("id"), "id"))
    few = names.withColumn("cell", cell).withColumn("nth", nth("l", "cell")).filter(F.col("nth") <= SAMPLE)
    picked = few.withColumn("nth", nth("l")).filter(F.col("nth") <= SAMPLE).select(F.col("id").alias("p_id"), "l")
    sampled = rows.join(F.broadcast(picked), (F.col("id") == F.col("p_id")) & (F.col("lang") == F.col("l")))  # SAMPLE ids for each language
    one = sampled.groupBy("id").agg(F.min(F.struct("lang", "text")).alias("r")).select("r.lang", "r.text")
    counts = one.mapInPandas(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    samples: dict[str, dict[str, int]] = {}
    for r in sorted(counts.collect()):
        samples.setdefault(r.lang, {})[r.word] = r.n
    for r in picked.select("l").distinct().collect():  # a language whose sampled texts have no word is known all the same
        samples.setdefault(r.l, {})
    return Model(samples)


def language(model: Model, text: Column) -> Column:
    """struct<lang, score, spans> of each text; ``und`` with score 0 if it is null or has no letter.

    Every row is labelled on its own: rows that repeat are labelled alike, an empty table stays
    empty. Words of a very long text are labelled together, in one pass over all of them.
    """
    kept: list[Labeller] = []

    def predict(texts: pd.Series) -> pd.DataFrame:
        if not kept:
            kept.append(Labeller(model))
        rows = kept[0].predict(list(texts))
        spans = [[{"lang": a, "start": b, "end": c} for a, b, c in s] for _, _, s in rows]
        return pd.DataFrame({"lang": [r[0] for r in rows], "score": [r[1] for r in rows], "spans": spans})

    span = T.StructType().add("lang", "string").add("start", "integer").add("end", "integer")
    return F.pandas_udf(predict, T.StructType().add("lang", "string").add("score", "double").add("spans", T.ArrayType(span)))(text)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, from its whole text alone, and its number of spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), language(fitted(docs), F.col("text")).alias("l"))
    return found.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"), F.size("l.spans").alias("n_spans"))
