"""Language identification: known words by log frequency, else the longest known character n-grams."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galenus.llm.shared import as_table, bounded_batches

#: Fit bounds: training rows of each language (the lowest hashes of doc_id), and entries of the word and the n-gram tables,
#: those in the most rows first. What a table leaves out counts as unseen and is scored by shorter n-grams.
MAX_ROWS_PER_LANG, MAX_WORDS, MAX_GRAMS = 1500, 60_000, 40_000

#: Scored words that a task keeps; words beyond so many letters aren't kept. Neither changes a result.
CACHE_WORDS, KEPT_LETTERS = 200_000, 100

MIN_WORD_ROWS, GRAM_SIZES, SMOOTH = 3, (5, 4, 3, 2, 1), 0.5
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class BackoffModel:
    """Log-probabilities of words and n-grams for each language: rows of one table, found by word or by n-gram."""

    def __init__(self, langs: list[str], prior: list[float], words: dict[str, list[int]], shorter: dict[str, list[int]]):
        self.langs = langs
        self.prior = np.array(prior)
        self.words = {w: i for i, w in enumerate(words)}
        self.grams = {g: i for i, g in enumerate(shorter)}
        self.word_logs = self._logs(words, lambda w: 0)
        self.gram_logs = self._logs(shorter, len)
        self.forget()

    def forget(self) -> None:
        """Empty the cache of scored words, which is bounded by CACHE_WORDS."""
        self._known: dict[str, int] = {}
        self._scores = np.zeros((0, len(self.langs)))

    def _logs(self, counts: dict[str, list[int]], group) -> np.ndarray:
        """Smoothed within each group (n-grams of one size)."""
        total: dict[int, np.ndarray] = {}
        size: Counter = Counter()
        for k, c in counts.items():
            g = group(k)
            total[g] = total.get(g, 0) + np.array(c, dtype=float)
            size[g] += 1
        rows = [np.log(np.array(c) + SMOOTH) - np.log(total[group(k)] + SMOOTH * (size[group(k)] + 1)) for k, c in counts.items()]
        return np.array(rows).reshape(len(rows), len(self.langs))

    def _backoff(self, w: str) -> list[int]:
        """Rows of the known n-grams of a word, of the longest size of which one is known, down to one letter."""
        get, padded = self.grams.get, f" {w} "
        for n in GRAM_SIZES:
            found = [i for at in range(len(padded) - n + 1) if (i := get(padded[at : at + n])) is not None]
            if found:
                return found
        return []

    def score_words(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words: a word's own, or the mean over its n-grams."""
        out = np.zeros((len(words), len(self.langs)))
        own, at, grams, sizes, unseen = [], [], [], [], []
        for k, w in enumerate(words):
            if (i := self.words.get(w)) is not None:
                own.append(i)
                at.append(k)
            elif found := self._backoff(w):
                grams += found
                sizes.append(len(found))
                unseen.append(k)
        if own:
            out[at] = self.word_logs[own]
        if unseen:
            n = np.array(sizes)
            out[unseen] = np.add.reduceat(self.gram_logs[grams], np.concatenate(([0], np.cumsum(n)[:-1])), axis=0) / n[:, None]
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """For each text the likeliest language, ties to the first by name, and its share of the likelihood.

        Distinct words of all the texts are scored at once. A word's score is the
        same whether it was kept from earlier texts or not.
        """
        counts = [Counter(WORD.findall((t or "").lower())) if self.langs else Counter() for t in texts]
        new = dict.fromkeys(w for c in counts for w in c if w not in self._known)
        if len(self._known) + len(new) > CACHE_WORDS:
            self.forget()
            new = dict.fromkeys(w for c in counts for w in c)
        known = self._known
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        self._scores = np.concatenate([self._scores, self.score_words(list(new))])
        out = []
        for t, c in zip(texts, counts, strict=True):
            if not c or not any(map(str.isalpha, t)):  # words may be numerals such as a superscript two
                out.append((UNKNOWN, 0.0))
                continue
            score = self.prior + np.fromiter(c.values(), float, len(c)) @ self._scores[[known[w] for w in c]]
            odds = np.exp(score - score.max())
            best = int(score.argmax())
            out.append((self.langs[best], float(odds[best] / odds.sum())))
        if any(len(w) > KEPT_LETTERS for w in new) or len(known) > CACHE_WORDS:
            self.forget()
        return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (lang, text): each word with its occurrences and rows, and how often each n-gram occurs in the distinct words of a row."""
    for b in batches:
        words: dict[str, Counter] = {}
        rows: dict[str, Counter] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            found = Counter(WORD.findall((text or "").lower()))
            words.setdefault(lang, Counter()).update(found)
            rows.setdefault(lang, Counter()).update(found.keys())
        for lang, found in words.items():
            short: dict[str, int] = {}
            for w, n in rows[lang].items():
                for size in GRAM_SIZES:
                    for g in grams(w, size):
                        short[g] = short.get(g, 0) + n
            keys = [*("w" + w for w in found), *("g" + g for g in short)]
            n, seen = [*found.values(), *short.values()], [*(rows[lang][w] for w in found), *short.values()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.string()), pa.array(n, pa.int64()), pa.array(seen, pa.int64())], names=["lang", "key", "n", "rows"])


def fit_language(docs: DataFrame) -> BackoffModel:
    """Learn from text and lang of a bounded sample of ``docs`` (doc_id, text, lang) outside the held-out rows."""
    spark = docs.sparkSession
    bounded_batches(spark)
    usable = docs.filter("lang is not null and text is not null").filter(~held_out(F.col("doc_id")))
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return BackoffModel([], [], {}, {})
    langs = sorted(sizes)
    # a hash threshold picks about MAX_ROWS_PER_LANG rows of each language without a sort
    share = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, MAX_ROWS_PER_LANG / n)))))
    picked = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
    table = picked.select("lang", "text").mapInArrow(_counted, "lang string, key string, n long, rows long").groupBy("lang", "key").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    table = table.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang"), F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    table = as_table(table.filter(F.col("rows") >= MIN_WORD_ROWS), "language_counts")

    def top(mark: str, most: int) -> dict[str, list[int]]:
        rows = table.filter(F.col("key").startswith(mark)).orderBy(F.desc("rows"), "key").limit(most).select("key", "by_lang").toLocalIterator()
        return {r.key[1:]: [r.by_lang.get(x, 0) for x in langs] for r in rows}

    n = sum(sizes.values())
    return BackoffModel(langs, [math.log(sizes[x] / n) for x in langs], top("w", MAX_WORDS), top("g", MAX_GRAMS))


def identify_languages(docs: DataFrame, model: BackoffModel | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row's whole text.

    A null text, or one without a letter, is ``und`` with score 0; without any
    training row every text is. A null doc_id is in no held-out part. Repeated
    rows each get their result.
    """
    spark = docs.sparkSession
    model = model or fit_language(docs)
    model.forget()
    shared = spark.sparkContext.broadcast(model)  # bounded by MAX_WORDS and MAX_GRAMS

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = m.predict(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")
