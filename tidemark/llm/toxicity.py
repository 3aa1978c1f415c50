"""Toxicity: cumulative-link ordinal regression over sparse text features.

Grades 0 < 1 < ... < K-1 share one weight per feature; K-1 ordered thresholds part them:
P(grade >= k) = sigmoid(w.x - t_k). The expected severity is the sum of these over k. Features are the words of
a text (A-Z lower-cased, punctuation at either end cut off) and the starts of longer words, so that inflected and
compound words meet under their stem. A feature is chosen if the labels of its rows differ from all others' by
more than chance (a score test), whatever other features say the same: a strong penalty would keep the few most
frequent ones and lose the words of a language with few labelled rows. x has equal shares that add up to one over
the chosen features a text holds, so w.x is their mean weight: neither a long text nor one that repeats itself in
many words is more toxic for it. A weak ridge penalty fits the weights of the chosen, which are what the tasks get.

Fitting takes at most ``max_rows`` labelled rows, those with the smallest hash of their id, a bound that is
part of the contract; features are counted by the tasks, and the driver gets the chosen ones of each of these
rows. Scoring reads every text whole.

Rows: a text without any chosen feature, so also a NULL or empty one, says nothing either way: its severity is 0.
Labels with a NULL grade or id, and those without a document, teach nothing. Several labels of one document teach
each, as do several documents of one id; the bound holds for the rows that teach. With fewer than two grades among
the labels nothing can be told apart and every severity is 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import bounded_sample, id_and_bytes, written

MAX_ROWS = 6_000
# A word is a feature if it occurs in at least so many of the labelled rows, and in at most this share of them.
LEAST_ROWS = 4
MOST_SHARE = 0.3
# So many code points begin a longer word and are a feature too.
STARTS = (5, 6, 7, 8)
# Standard deviations that the grades of a chosen feature's rows are off those of as many rows by chance.
OFF_CHANCE = 6.0
RIDGE = 1e-5
STEPS = 2_000
# Expected severity from which a text is called toxic.
TOXIC_FROM = 0.5
EDGES = b".,;:!?\"'()[]{}<>*-_"


def words(text: bytes | None) -> set[bytes]:
    return {w.strip(EDGES) for w in set((text or b"").lower().split())} - {b""}


def features(text: bytes | None) -> set[bytes]:
    """Words, and starts of longer words with a space behind, which no word has."""
    whole = words(text)
    found = set(whole)
    for word in whole:
        letters = word if word.isascii() else word.decode("utf-8", "surrogateescape")
        for n in STARTS:
            if n >= len(letters):
                break
            start = letters[:n]
            found.add((start if isinstance(start, bytes) else start.encode("utf-8", "surrogateescape")) + b" ")
    return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    """Weights of the features that matter, the ordered thresholds, and the least grade."""

    weights: dict[bytes, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)
    least: float = 0.0

    def at_least(self, text: bytes | None) -> np.ndarray:
        """P(grade >= k) for k above the least grade; no element for a text without any chosen feature."""
        keys = self.weights.keys() & features(text)
        if not keys:
            return np.zeros(0)
        mean = sum(map(self.weights.__getitem__, sorted(keys))) / len(keys)
        return sigmoid(mean - np.array(self.thresholds))

    def severity(self, text: bytes | None) -> float:
        above = self.at_least(text)
        return self.least + float(above.sum()) if len(above) else 0.0


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, n_columns: int, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the penalized likelihood, by accelerated steps.

    ``rows`` and ``columns`` are the places of a sparse matrix that are not zero; a row's are equal and add up to one.
    """
    above = (grades[:, None] >= np.unique(grades)[1:]).astype(float)
    n, levels = above.shape
    part = 1.0 / np.maximum(np.bincount(rows, minlength=n), 1)[rows]
    direction = np.ones(n_columns) / np.sqrt(n_columns)
    curvature = 1.0
    for _ in range(12):  # the largest eigenvalue of the features' second moments, by power iteration
        image = np.bincount(columns, part * np.bincount(rows, part * direction[columns], n)[rows], n_columns) / n
        curvature = max(float(np.linalg.norm(image)), 1e-9)
        direction = image / curvature
    step = 1.0 / (0.3 * levels * (curvature + 1.0) + RIDGE)
    share = above.mean(axis=0)
    weights, thresholds = np.zeros(n_columns), np.log((1 - share) / share)
    ahead_w, ahead_t, momentum = weights, thresholds, 1.0
    for _ in range(STEPS):
        scores = np.bincount(rows, part * ahead_w[columns], n)
        error = (sigmoid(scores[:, None] - ahead_t) - above) / n
        new_w = ahead_w - step * (np.bincount(columns, part * error.sum(axis=1)[rows], n_columns) + RIDGE * ahead_w)
        new_t = np.maximum.accumulate(ahead_t + step * error.sum(axis=0))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = (momentum - 1) / following
        ahead_w, ahead_t = new_w + push * (new_w - weights), new_t + push * (new_t - thresholds)
        weights, thresholds, momentum = new_w, new_t, following
    return weights, thresholds


def telling(texts: DataFrame, per_grade: dict[int, int]) -> list[bytes]:
    """The features whose rows' grades are off by more than chance; ``texts`` has text and grade."""
    level = {grade: at for at, grade in enumerate(sorted(per_grade))}
    rows = sum(per_grade.values())
    mean = sum(level[g] * n for g, n in per_grade.items()) / rows
    spread = np.sqrt(sum((level[g] - mean) ** 2 * n for g, n in per_grade.items()) / rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[bytes, list[int]] = {}
            for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for feature in features(text):
                    sums = counts.setdefault(feature, [0, 0])
                    sums[0] += 1
                    sums[1] += level[grade]
            n, total = zip(*counts.values()) if counts else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.binary()), pa.array(n, pa.int64()), pa.array(total, pa.int64())], ["feature", "n", "total"])

    counted = texts.mapInArrow(work, "feature binary, n long, total long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    common = counted.where((F.col("n") >= LEAST_ROWS) & (F.col("n") <= max(LEAST_ROWS, MOST_SHARE * rows)) & (F.col("n") < rows))
    off = F.abs(F.col("total") - F.col("n") * mean) / (spread * F.sqrt(F.col("n") * (1 - F.col("n") / rows)))
    return sorted(bytes(r["feature"]) for r in common.where(off > OFF_CHANCE).select("feature").collect())


def fit(docs: DataFrame, labels: DataFrame, grade: Column, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """A model from the labelled rows; ``grade`` is an expression over the columns of ``labels``."""
    graded = labels.select(F.col(id_col).cast("long").alias("doc_id"), grade.cast("int").alias("grade"))
    taught = bounded_sample(graded.where("doc_id IS NOT NULL AND grade IS NOT NULL"), "doc_id", "grade", rows=max_rows)

    texts = id_and_bytes(docs, id_col, text_col).join(F.broadcast(taught), "doc_id").select("text", "grade")
    texts = written(texts, "taught")
    if texts.count() > max_rows:  # documents of one id
        texts = written(bounded_sample(texts, "text", "grade", rows=max_rows), "taught")

    per_grade = {r["grade"]: r["count"] for r in texts.groupBy("grade").count().collect()}
    if len(per_grade) < 2:
        return OrdinalModel()
    chosen = telling(texts, per_grade)
    place = {feature: at for at, feature in enumerate(chosen)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(place[f] for f in place.keys() & features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], ["features", "grade"])

    # Bounded: the chosen features of each labelled row. In order here, where equal rows crowd no task.
    placed = texts.mapInArrow(held, "features array<int>, grade int").collect()
    placed.sort(key=lambda r: (r["grade"], r["features"]))
    grades = np.array([r["grade"] for r in placed])
    rows = np.repeat(np.arange(len(placed)), [len(r["features"]) for r in placed])
    columns = np.array([at for r in placed for at in r["features"]], np.int64)
    weights, thresholds = fit_ordinal(rows, columns, max(1, len(chosen)), grades)
    # A grade that no label has shares the threshold of the next one, so that severity still counts in grades.
    levels = np.unique(grades)
    return OrdinalModel(dict(zip(chosen, weights.tolist())), np.repeat(thresholds, np.diff(levels)).tolist(), float(levels[0]))


def verdict(model: OrdinalModel, toxic_from: float = TOXIC_FROM) -> Callable[[Column], Column]:
    """A column function over texts: (severity, toxic)."""

    @F.pandas_udf("severity double, toxic boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        severity = np.array([model.severity(t) for t in texts], float)
        return pd.DataFrame({"severity": severity, "toxic": severity >= toxic_from})

    return lambda text: judge(text.cast("binary"))


def score(docs: DataFrame, model: OrdinalModel, toxic_from: float = TOXIC_FROM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, toxic) for every row."""
    judged = docs.select(F.col(id_col).cast("long").alias("doc_id"), verdict(model, toxic_from)(F.col(text_col)).alias("v"))
    return judged.select("doc_id", "v.severity", "v.toxic")
