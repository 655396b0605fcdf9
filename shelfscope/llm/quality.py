"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by naive Bayes log-count ratios.

Features say which byte trigrams (hashed to a fixed number of columns) a whole text has, and how often its word pairs
are one word twice. Each indicator is multiplied by the log ratio of its share among good and among bad texts, the vector is
scaled to about length one (short texts stay shorter, so little evidence gives small margins), and the model is fitted
by dual coordinate descent. Margins become probabilities by a logistic curve fitted on rows that the model did not see.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.blocks import free_name

TRIGRAMS = 1 << 18
#: Shares of doubled words that have an indicator each. A column is repeated so that it counts as much as many trigrams.
DOUBLED = tuple(x for x in (0.02, 0.05, 0.1, 0.2, 0.4) for _ in range(20))
COLUMNS = TRIGRAMS + len(DOUBLED)
#: Labelled rows that the fit uses at most, the first ones by a hash of their id (documented bound; about 4 kB each).
FIT_ROWS = 8000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
DAMPING = 0.1
THRESHOLD = 0.3
BLOCK = 1 << 20


def text_columns_of(text: bytes) -> np.ndarray:
    """The distinct columns of a text, sorted; the last ones tell of doubled words."""
    data = np.frombuffer(text, np.uint8)
    if len(text) <= BLOCK:
        found = np.unique(_columns(data))
    else:
        present = np.zeros(TRIGRAMS, bool)
        for at in range(0, len(data), BLOCK):
            present[_columns(data[at : at + BLOCK + 2])] = True
        found = np.flatnonzero(present).astype(np.int32)
    words = text.split()
    share = sum(map(eq, words, words[1:])) / len(words) if words else 0.0
    return np.append(found, np.int32(TRIGRAMS) + np.flatnonzero(share >= np.array(DOUBLED)).astype(np.int32))


def _columns(data: np.ndarray) -> np.ndarray:
    code = data.astype(np.uint32)
    code = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(14)).astype(np.int32)


def text_columns(texts: pa.Array) -> Iterator[np.ndarray]:
    for text in texts.fill_null("").cast(pa.large_binary()):
        yield text_columns_of(text.as_py())


@dataclass
class Model:
    weights: np.ndarray
    squares: np.ndarray
    damping: float
    bias: float
    slope: float
    shift: float

    def score(self, columns: np.ndarray) -> float:
        margin = self.bias + float(self.weights[columns].sum()) / (float(self.squares[columns].sum()) + self.damping) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = np.full((2, COLUMNS), SMOOTHING)
    for columns, label in zip(rows, good, strict=True):
        counts[int(label), columns] += 1
    counts /= counts.sum(1, keepdims=True)
    return np.log(counts[1] / counts[0])


def typical_square(rows: list[np.ndarray], ratio: np.ndarray) -> float:
    """What is added under the root when a row is scaled: a share of a row's usual squared length, never 0."""
    return DAMPING * float(np.mean([(ratio[c] ** 2).sum() for c in rows])) + 1e-9


def scaled(columns: np.ndarray, ratio: np.ndarray, damping: float) -> np.ndarray:
    values = ratio[columns]
    return values / ((values**2).sum() + damping) ** 0.5


def hinge_by_dual_descent(
    rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray, damping: float, seed: int = 5
) -> tuple[np.ndarray, float]:
    """Weights (on scaled indicators) and bias that minimise |w|^2 / 2 + the cost-weighted hinge losses.

    The rarer class costs more per row, so that both classes weigh the same.
    """
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.empty(ends[-1])  # one array: small ones would stay with the driver's process after the fit
    values = [flat[a:b] for a, b in itertools.pairwise(ends)]
    for c, v in zip(rows, values, strict=True):
        v[:] = scaled(c, ratio, damping)
    share = np.where(sign > 0, (sign < 0).sum(), (sign > 0).sum()) * 2 / len(sign)
    cost = COST * share
    alpha, w, bias = np.zeros(len(rows)), np.zeros(COLUMNS), 0.0
    size = np.array([1 + (v**2).sum() for v in values])
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / size[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return w, bias


def logistic_curve(margin: np.ndarray, good: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope (at least 0.1) and shift of P(good | margin), by Newton steps with targets drawn in from 0 and 1."""
    n1, n0 = good.sum(), (1 - good).sum()
    target = np.where(good > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta - np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * beta)
    return max(float(beta[0]), 0.1), float(beta[1])


def fit(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """With fewer than two rows of either class, every text gets the smoothed share of good rows."""
    good = np.asarray(good, float)
    n1, n0 = int(good.sum()), int((1 - good).sum())
    if min(n1, n0) < 2:
        share = (n1 + 1) / (n1 + n0 + 2)
        return Model(np.zeros(COLUMNS), np.zeros(COLUMNS), 1.0, 0.0, 1.0, float(np.log(share / (1 - share))))
    sign = np.where(good > 0, 1.0, -1.0)
    margins = np.zeros(len(rows))
    fold = np.empty(len(rows), int)
    for label in (0, 1):  # each half gets its share of both classes
        at = np.flatnonzero(good == label)
        fold[at] = np.arange(len(at)) % 2
    for k in (0, 1):
        inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        part = [rows[i] for i in inside]
        ratio = log_count_ratios(part, good[inside])
        damping = typical_square(part, ratio)
        w, bias = hinge_by_dual_descent(part, sign[inside], ratio, damping)
        for i in outside:
            margins[i] = bias + w[rows[i]] @ scaled(rows[i], ratio, damping)
    slope, shift = logistic_curve(margins, good)
    ratio = log_count_ratios(rows, good)
    damping = typical_square(rows, ratio)
    w, bias = hinge_by_dual_descent(rows, sign, ratio, damping)
    return Model(w * ratio, ratio**2, damping, bias, slope, shift)


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fits on at most `fit_rows` rows of `labels` (doc_id, quality 0 or 1; others are left out) with a document.

    A document that is repeated, or labelled repeatedly, counts as often. Other columns of both tables are not read, whatever their names.
    """
    chosen = (
        labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").alias("_label_id"), "quality")
        .orderBy(F.xxhash64("_label_id"), "_label_id", "quality").limit(fit_rows)
    )

    def features(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label_id"), batch.column("quality"), pa.array([c.tobytes() for c in text_columns(batch.column("text"))], pa.binary())],
                ["_label_id", "quality", "columns"],
            )

    texts = docs.select(F.col("doc_id").alias("_doc_id"), F.col("text").cast("string").alias("text"))
    rows = (
        texts.join(F.broadcast(chosen), F.col("_doc_id") == F.col("_label_id"))
        .select("_label_id", F.col("quality").cast("int").alias("quality"), "text")
        .mapInArrow(features, "_label_id long, quality int, columns binary")
        .orderBy(F.xxhash64("_label_id"), "_label_id", "quality", "columns").limit(fit_rows).toArrow()
    )
    return fit([np.frombuffer(c.as_buffer(), np.int32) for c in rows.column("columns")], np.array(rows.column("quality").to_pylist()))


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of `docs`, and score (0 to 1) and predicted (1 from `threshold` on). Only `text` is looked at.

    A NULL or empty text, or one of fewer than three bytes, gets the score of the bias alone. Existing columns score and predicted are
    replaced, all others may have any name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*[F.col(f"`{c}`") for c in names]).withColumn(free_name(names, "_text"), F.col("text").cast("string"))

    def score(batches):
        for batch in batches:
            scores = np.array([shared.value.score(c) for c in text_columns(batch.column(batch.num_columns - 1))], float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))], [*names, "score", "predicted"]
            )

    return rows.mapInArrow(score, docs.select(*[F.col(f"`{c}`") for c in names]).schema.add("score", "double").add("predicted", "integer"))
