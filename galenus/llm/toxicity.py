"""Ordinal toxicity: a cumulative-link model grades severity from sparse text features."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.llm.shared import as_table, bounded_batches, maybe_broadcast

#: Fit bounds: labelled rows of each class (the lowest hashes of doc_id), and features (those that separate the classes best).
MAX_ROWS_PER_CLASS, MAX_FEATURES = 3000, 600

#: A feature enters the model if it separates the classes at this two-sample z and occurs in so many labelled rows.
MIN_Z, MIN_ROWS = 5.0, 5

#: Parts of the labelled rows: the evidence of a row comes from a model that the other parts fit.
FOLDS = 2

PREFIXES = (5, 6, 7)
WORD = re.compile(r"[^\W\d_]+")


def text_features(text: str | None) -> Counter:
    """Occurrences of each word (lower case) and of each word beginning of 5 to 7 letters."""
    out: Counter = Counter()
    for w, n in Counter(WORD.findall((text or "").lower())).items():
        out[w] += n
        for k in PREFIXES:
            if len(w) >= k:
                out[w[:k] + "~"] += n
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(x.w - cut[k]) with one weight vector for all cuts and ascending cuts."""

    features: list[str]
    weights: np.ndarray
    cuts: np.ndarray
    index: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        self.index = {f: i for i, f in enumerate(self.features)}
        self._of_word: dict[str, tuple[int, ...]] = {}

    def row(self, text: str | None) -> tuple[list[int], list[float]]:
        """Sparse features 1 + log(count) of a whole text."""
        counts: dict[int, int] = {}
        for w, n in Counter(WORD.findall((text or "").lower())).items():
            at = self._of_word.get(w)
            if at is None:
                names = [w, *(w[:k] + "~" for k in PREFIXES if len(w) >= k)]
                at = tuple(self.index[x] for x in names if x in self.index)
                if len(self._of_word) > 300_000:
                    self._of_word.clear()
                self._of_word[w] = at
            for i in at:
                counts[i] = counts.get(i, 0) + n
        return list(counts), [1.0 + math.log(n) for n in counts.values()]

    def exceed(self, text: str | None) -> np.ndarray:
        """P(grade > k) for each cut; they fall with k."""
        at, x = self.row(text)
        score = float(np.dot(self.weights[at], x)) if at else 0.0
        return _sigmoid(score - self.cuts)


def fit_ordinal(x: np.ndarray, grades: np.ndarray, features: list[str], l1: float = 1e-4, l2: float = 1e-4, steps: int = 400) -> OrdinalModel:
    """Penalised likelihood by accelerated proximal gradient steps. Grades are 0..K-1; a lone grade gives a constant model."""
    top = int(grades.max(initial=0))
    if top == 0 or len(grades) == 0:
        return OrdinalModel(features, np.zeros(len(features)), np.full(max(top, 1), 30.0))
    n, k = len(grades), np.arange(top)
    over = grades[:, None] > k
    share = np.clip(over.mean(axis=0), 1e-3, 1 - 1e-3)
    cuts = np.log((1 - share) / share)
    w = np.zeros(x.shape[1])
    rate = 1 / (0.25 * top * max(1.0, np.linalg.norm(x, 2) ** 2 / n + 1) + l2)
    yw, yc, t = w.copy(), cuts.copy(), 1.0

    def gradient(w: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean of -log P(y), P(y) = P(>y-1) - P(>y) with P(>-1) = 1 and P(>top-1+1) = 0."""
        p = _sigmoid((x @ w)[:, None] - cuts)
        slope = p * (1 - p)
        ends = np.hstack([np.ones((n, 1)), p, np.zeros((n, 1))])
        likely = np.maximum(ends[np.arange(n), grades] - ends[np.arange(n), grades + 1], 1e-9)
        d = np.zeros((n, top))
        low, high = grades > 0, grades < top
        d[low, grades[low] - 1] -= (slope[low, grades[low] - 1]) / likely[low]
        d[high, grades[high]] += (slope[high, grades[high]]) / likely[high]
        return x.T @ d.sum(axis=1) / n + l2 * w, -d.mean(axis=0)

    for _ in range(steps):
        gw, gc = gradient(yw, yc)
        w2 = yw - rate * gw
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - rate * l1, 0)
        c2 = np.maximum.accumulate(yc - rate * gc + np.arange(top) * 1e-9)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        yw, yc = w2 + (t - 1) / t2 * (w2 - w), np.maximum.accumulate(c2 + (t - 1) / t2 * (c2 - cuts))
        w, cuts, t = w2, c2, t2
    return OrdinalModel(features, w, cuts)


def cross_fitted_grades(x: np.ndarray, toxic: np.ndarray, features: list[str]) -> np.ndarray:
    """Grades 0 to 2 of binary labels: a toxic row is of grade 2 if its evidence is above the median of the toxic rows.

    A row's evidence is its score by a binary model that the other folds' rows
    fit, less that model's cut; rows are dealt to folds in turn. So no row is
    graded by what was learnt from it. Ties at the median are grade 1. Where a
    fold has one class only, all toxic rows are grade 1.
    """
    grades = toxic.astype(int)
    fold = np.zeros(len(toxic), dtype=int)
    for c in (0, 1):
        own = np.flatnonzero(grades == c)
        fold[own] = np.arange(len(own)) % FOLDS
    evidence = np.zeros(len(toxic))
    for k in range(FOLDS):
        rest, own = fold != k, fold == k
        if len(set(grades[rest].tolist())) < 2 or not (own & (grades == 1)).any():
            return grades
        model = fit_ordinal(x[rest], grades[rest], features)
        evidence[own] = x[own] @ model.weights - model.cuts[0]
    middle = np.median(evidence[grades == 1])
    grades[(grades == 1) & (evidence > middle)] = 2
    return grades


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, text) of the bounded training rows: per class the labels of the lowest doc_id hash, of each the least text; equal texts once."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.filter(c).orderBy(*order).limit(MAX_ROWS_PER_CLASS) for c in ("toxic > 0", "toxic <= 0")]
    picked = as_table(picked[0].unionByName(picked[1]), "toxicity_sample")
    rows = docs.select("doc_id", "text").filter("text is not null").join(maybe_broadcast(picked, 32), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))  # repeated doc_ids are one row
    return rows.groupBy(F.sha2("text", 256).alias("sha")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")).select("toxic", "text")


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [text_features(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([list(f.items()) for f in found], type=pa.map_(pa.string(), pa.int32()))], names=["toxic", "f"])


def fit_severity(docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    """Fit on a bounded sample of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers.

    The labels are binary; ``cross_fitted_grades`` parts the toxic rows in two
    grades. No labels, or none toxic, give a model that rejects nothing.
    """
    bounded_batches(docs.sparkSession)
    rows = as_table(_labelled(docs, labels).mapInArrow(_featurised, "toxic int, f map<string,int>"), "toxicity_rows")
    size = rows.groupBy().agg(F.count_if(F.col("toxic") > 0).alias("t"), F.count_if(F.col("toxic") <= 0).alias("c")).head()
    if not size.t or not size.c:
        return fit_ordinal(np.zeros((0, 0)), np.zeros(0, dtype=int), [])
    seen = rows.select("toxic", F.explode("f").alias("feature", "n")).groupBy("feature").agg(F.count_if(F.col("toxic") > 0).alias("a"), F.count_if(F.col("toxic") <= 0).alias("b"))
    p, q, all_ = F.col("a") / size.t, F.col("b") / size.c, (F.col("a") + F.col("b")) / (size.t + size.c)
    z = (p - q) / F.sqrt(F.greatest(all_ * (1 - all_), F.lit(1e-9)) * (1 / size.t + 1 / size.c))
    chosen = seen.filter(F.col("a") + F.col("b") >= MIN_ROWS).select("feature", z.alias("z")).filter(F.abs("z") >= MIN_Z)
    chosen = chosen.orderBy(F.abs("z").desc(), "feature").limit(MAX_FEATURES).collect()
    features = [r.feature for r in chosen]
    if not features:
        return fit_ordinal(np.zeros((0, 0)), np.zeros(0, dtype=int), [])
    wanted = F.map_filter("f", lambda k, _: k.isin(features))
    got = sorted(rows.select("toxic", wanted.alias("f")).collect(), key=lambda r: (r.toxic, sorted(r.f.items())))
    at = {f: i for i, f in enumerate(features)}
    counts = np.zeros((len(got), len(features)))
    for i, r in enumerate(got):
        for f, n in r.f.items():
            counts[i, at[f]] = n
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0)
    grades = cross_fitted_grades(x, np.array([int(r.toxic > 0) for r in got]), features)
    return fit_ordinal(x, grades, features)


def severity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, grade, severity, toxic) of every row's whole text.

    severity is the expected grade, rounded to 6 places; grade the number of
    cuts that the text exceeds with probability 0.5; toxic is P(grade > 0) >=
    ``threshold``. Null and empty texts have no features and get the base rate,
    never toxic; repeated rows each get their result; an empty table none.
    """
    model = fit_severity(docs, labels)
    model._of_word.clear()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            over = [model.exceed(t) for t in b.column(1).to_pylist()]
            out = [
                b.column(0),
                pa.array([int((p >= 0.5).sum()) for p in over], type=pa.int32()),
                pa.array([round(float(p.sum()), 6) for p in over], type=pa.float64()),
                pa.array([bool(p[0] >= threshold) for p in over], type=pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "grade", "severity", "toxic"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, grade int, severity double, toxic boolean")


def keep_civil(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose doc_id has no row graded toxic. Rows without a doc_id stay."""
    gone = as_table(severity(docs, labels, threshold).filter("toxic and doc_id is not null").select("doc_id").distinct(), "toxic")
    return docs.join(maybe_broadcast(gone, 32), "doc_id", "left_anti").select(*docs.columns)
