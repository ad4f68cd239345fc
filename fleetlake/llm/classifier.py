"""Ordinal quality classifier: cumulative-link regression on hashed text features.

Grades are ordered (0 lowest). One weight vector is shared by all grades and ordered
thresholds cut its score: ``P(grade <= j) = sigmoid(threshold_j - score)``. The score is a sum
over words, each counted as its own hashed features (the word, two prefixes, its shape), plus a
few hashed features of the whole text. Every text is scored whole.

The fit uses a sample of at most ``fit_rows`` labelled rows (documented bound, chosen by a keyed
hash of the id). Each fifth of it is scored by a model fitted on the other four. The cut-off of the
tail probability is the one with the fewest errors on those scores, bad rows kept and good ones
rejected alike; what it keeps of each grade there is reported with the model (``held_out``). A text
is scored by the mean of the five models, which falls for unseen bad texts as it does there or more.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import arrow_rows, documents, labels, release, stage

DIMS = 1 << 16
PER_WORD = 4
TEXT_FEATURES = 6
SLICE_CHARS = 1_000_000  # characters scored at a time
FIT_BLOCK = 1_000_000  # entries of the fit that are multiplied at a time
MIN_ROWS = 10  # graded documents below which nothing is fitted and no text is rejected

_OUTER = re.compile(r"^\W+|\W+$")
_RUNS = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^\W\d_A-Za-z]+")


def _bucket(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) % DIMS


def _shape_part(match: re.Match) -> str:
    head = match.group()[0]
    return "9" if head.isdigit() else "A" if "A" <= head <= "Z" else "a"


class _WordFeatures(dict):
    """Row numbers of a growing table of word features; cleared when it holds ``LIMIT`` words."""

    LIMIT = 150_000

    def __init__(self) -> None:
        super().__init__()
        self.rows = np.zeros((1024, PER_WORD), dtype=np.int32)

    def __missing__(self, word: str) -> int:
        n = len(self)
        if n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        core = _OUTER.sub("", word).lower()
        shape = _RUNS.sub(_shape_part, word)
        self.rows[n] = [_bucket("w" + core), _bucket("4" + core[:4]), _bucket("5" + core[:5]), _bucket("s" + shape)]
        self[word] = n
        return n

    def drop(self) -> None:
        self.clear()
        self.rows = np.zeros((1024, PER_WORD), dtype=np.int32)


_WORDS = _WordFeatures()


def _text_features(text: str, words: list[str]) -> list[int]:
    n = len(words)
    lines = [x for x in text.split("\n") if x]
    letters = max(sum(map(len, words)), 1)
    upper = sum(map(str.isupper, words))
    return [
        _bucket(f"distinct{10 * len(set(words)) // max(n, 1)}/{min(n.bit_length(), 8)}"),
        _bucket(f"upper{10 * upper // max(n, 1)}"),
        _bucket(f"length{n.bit_length()}"),
        _bucket(f"mean{letters // max(n, 1)}"),
        _bucket(f"lines{10 * len(set(lines)) // max(len(lines), 1)}"),
        _bucket("any"),
    ]


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) entries of the texts and the number of words of each.

    A word's features weigh ``1 / sqrt(words)``, the features of the whole text 1.
    """
    if len(_WORDS) > _WORDS.LIMIT:
        _WORDS.clear()
    split = [(t or "").split() for t in texts]
    n_words = np.array([len(w) for w in split], dtype=np.int64)
    ids = np.fromiter((_WORDS[w] for words in split for w in words), dtype=np.int64, count=int(n_words.sum()))
    doc = np.repeat(np.arange(len(texts)), n_words)
    whole = np.array([_text_features(t or "", w) for t, w in zip(texts, split)], dtype=np.int64).reshape(-1, TEXT_FEATURES)
    feature = np.concatenate([_WORDS.rows[ids].ravel(), whole.ravel()])
    rows = np.concatenate([np.repeat(doc, PER_WORD), np.repeat(np.arange(len(texts)), TEXT_FEATURES)])
    scale = 1 / np.sqrt(np.maximum(n_words, 1))
    value = np.concatenate([np.repeat(scale[doc], PER_WORD), np.ones(whole.size)])
    return rows, feature, value, n_words


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class OrdinalModel:
    """Shared weights, ordered thresholds, and the tail probability below which a text is rejected.

    ``held_out`` has the number of held-out rows of each grade and the share of them above the cut-off.
    """

    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.0
    held_out: dict[int, tuple[int, float]] = field(default_factory=dict)

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade >= j)`` for j = 1 .. top grade, one column each."""
        return 1 - sigmoid(self.thresholds[None, :] - scores[:, None])

    def score(self, texts: list[str | None]) -> np.ndarray:
        rows, feature, value, _ = features(texts)
        return np.bincount(rows, weights=self.weights[feature] * value, minlength=len(texts))


@dataclass
class FitSettings:
    fit_rows: int = 6000
    steps: int = 160
    rate: float = 0.08
    ridge: float = 1e-4
    folds: int = 5
    seed: str = "ordinal"
    grades: int = field(default=3)


def thresholds_of(first: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Ordered thresholds from the first one and the logarithms of the distances to the next ones."""
    return np.concatenate([first, first + np.cumsum(np.exp(gaps))])


def likelihood(params: list[np.ndarray], rows, feature, value, grade: np.ndarray, settings: FitSettings) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood with its ridge, and the gradient in weights, first threshold and log distances."""
    n, top = len(grade), settings.grades - 1
    weights, first, gaps = params
    low, high = np.maximum(grade - 1, 0), np.minimum(grade, top - 1)
    cuts = thresholds_of(first, gaps)
    # Entry by entry the arrays are the largest things of a fit, so products are made for a block of them at a time.
    blocks = [slice(a, a + FIT_BLOCK) for a in range(0, len(rows), FIT_BLOCK)]
    score = np.zeros(n)
    for b in blocks:
        score += np.bincount(rows[b], weights=weights[feature[b]] * value[b], minlength=n)
    upper = np.where(grade == top, 1.0, sigmoid(cuts[high] - score))
    lower = np.where(grade == 0, 0.0, sigmoid(cuts[low] - score))
    p = np.maximum(upper - lower, 1e-12)
    loss = float(-np.log(p).mean() + settings.ridge / 2 * (weights @ weights))
    d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
    slope = d_upper - d_lower  # of the negative log-likelihood in the score
    g_cuts = np.bincount(low, weights=d_lower, minlength=top) - np.bincount(high, weights=d_upper, minlength=top)
    g_weights = settings.ridge * weights
    for b in blocks:
        g_weights += np.bincount(feature[b], weights=slope[rows[b]] * value[b], minlength=len(weights)) / n
    tail = np.cumsum(g_cuts[::-1])[::-1] / n
    return loss, [g_weights, tail[:1], tail[1:] * np.exp(gaps)]


def fit_arrays(rows, feature, value, grade: np.ndarray, settings: FitSettings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by full-batch Adam on the penalised cumulative-link likelihood."""
    share = np.array([np.mean(grade <= j) for j in range(settings.grades - 1)]).clip(0.01, 0.99)
    base = np.log(share / (1 - share))
    params = [np.zeros(DIMS), base[:1].copy(), np.log(np.maximum(np.diff(base), 0.05))]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, settings.steps + 1):
        _, gradients = likelihood(params, rows, feature, value, grade, settings)
        for i, g in enumerate(gradients):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            params[i] = params[i] - settings.rate * (first[i] / (1 - 0.9**step)) / (
                np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8
            )
    return params[0], thresholds_of(params[1], params[2])


def choose_cut(tail: np.ndarray, good: np.ndarray) -> float:
    """The cut-off with the fewest bad rows kept and good rows rejected in total; of equal ones the lowest.

    It lies midway between two rows. Without good or without bad rows there is nothing to choose: 0.
    """
    if good.all() or not good.any():
        return 0.0
    values, where = np.unique(tail, return_inverse=True)
    good_at = np.bincount(where[good], minlength=len(values))
    bad_at = np.bincount(where[~good], minlength=len(values))
    # Errors when the first k values are rejected, k = 0 .. all of them.
    errors = np.concatenate([[0], np.cumsum(good_at)]) + bad_at.sum() - np.concatenate([[0], np.cumsum(bad_at)])
    k = int(np.argmin(errors))
    if k == 0:
        return 0.0
    return float((values[k - 1] + values[k]) / 2) if k < len(values) else float(np.nextafter(values[-1], 2.0))


def fit_folds(rows, feature, value, grade: np.ndarray, fold: np.ndarray, settings: FitSettings) -> OrdinalModel:
    """The mean of the models fitted without one fold each, and the cut-off from the held-out rows of all folds.

    Scores are linear, so the mean of the weights and thresholds gives the mean of the scores.
    """
    top, fits, tail = settings.grades - 1, [], np.zeros(len(grade))
    for k in np.unique(fold).tolist():
        held = fold == k
        keep = ~held[rows]
        new = (np.cumsum(~held) - 1).astype(np.int32)
        weights, cuts = fit_arrays(new[rows[keep]], feature[keep], value[keep], grade[~held], settings)
        keep = ~keep
        score = np.bincount(rows[keep], weights=weights[feature[keep]] * value[keep], minlength=len(grade))
        tail[held] = OrdinalModel(weights, cuts).probabilities(score[held])[:, -1]
        fits.append((weights, cuts))
    cut = choose_cut(tail, grade == top)
    kept = {g: (int((grade == g).sum()), float(np.mean(tail[grade == g] >= cut))) for g in np.unique(grade).tolist()}
    return OrdinalModel(np.mean([w for w, _ in fits], axis=0), np.mean([c for _, c in fits], axis=0), cut, kept)


def graded(rated: DataFrame) -> DataFrame:
    """Grade of a rating row: 0 low quality, 1 toxic but well written, 2 neither."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return rated.select("doc_id", grade.cast("int").alias("grade")).where("doc_id is not null and grade is not null")


def _sample(docs: DataFrame, grades: DataFrame, settings: FitSettings) -> DataFrame:
    """At most ``fit_rows`` graded ids, the lowest by keyed hash, each with one text (the least of repeated rows)."""
    key = F.xxhash64(F.lit(settings.seed), F.col("doc_id"))
    ids = stage(
        grades.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(key, "doc_id").limit(settings.fit_rows),
        "graded",
    )
    # The broadcast side has at most fit_rows rows of two numbers.
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, grades: DataFrame, settings: FitSettings | None = None) -> OrdinalModel:
    """Fit on the graded documents. With fewer than ``MIN_ROWS`` of them the model keeps everything."""
    settings = settings or FitSettings()

    def step(cols: dict[str, list]) -> pa.RecordBatch:
        rows, feature, value, _ = features(cols["text"])
        pairs, where = np.unique(rows * DIMS + feature, return_inverse=True)
        total = np.bincount(where, weights=value, minlength=len(pairs))
        bounds = np.searchsorted(pairs, np.arange(len(cols["text"]) + 1) * DIMS)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(cols["doc_id"], pa.int64()),
                pa.array(cols["grade"], pa.int32()),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(pairs % DIMS, pa.int32())),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(total, pa.float32())),
            ],
            names=["doc_id", "grade", "feature", "value"],
        )

    schema = "doc_id long, grade int, feature array<int>, value array<float>"
    got = arrow_rows(_sample(docs, grades, settings), ["doc_id", "grade", "text"], step, schema, done=_WORDS.drop).toArrow()
    n = got.num_rows
    if n < MIN_ROWS:
        return OrdinalModel(np.zeros(DIMS), np.full(settings.grades - 1, -50.0))
    got = got.take(pa.array(np.argsort(got["doc_id"].to_numpy(), kind="stable")))
    grade = got["grade"].to_numpy().astype(np.int64)
    lists, values = (got[c].combine_chunks() for c in ("feature", "value"))
    del got
    # Entries stay in the types they came in; there are some hundreds for every fitted row.
    rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    feature, value = lists.flatten().to_numpy(), values.flatten().to_numpy()
    fold = np.arange(n) % settings.folds
    if fold.min() == fold.max():
        return OrdinalModel(np.zeros(DIMS), np.full(settings.grades - 1, -50.0))
    try:
        return fit_folds(rows, feature, value, grade, fold, settings)
    finally:
        del rows, feature, value, lists, values
        release()


def predict(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, score, expected_grade, tail_probability (of the top grade) and kept, one row per document.

    A null text counts as empty; repeated rows get equal results; ids may be null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(cols: dict[str, list]) -> pa.RecordBatch:
        m = shared.value
        score = m.score(cols["text"])
        p = m.probabilities(score)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(cols["doc_id"], pa.int64()),
                pa.array(score, pa.float64()),
                pa.array(p.sum(axis=1), pa.float64()),
                pa.array(p[:, -1], pa.float64()),
                pa.array(p[:, -1] >= m.cut, pa.bool_()),
            ],
            names=["doc_id", "score", "expected_grade", "tail_probability", "kept"],
        )

    schema = "doc_id long, score double, expected_grade double, tail_probability double, kept boolean"
    return arrow_rows(docs, ["doc_id", "text"], step, schema, batch_chars=SLICE_CHARS, done=_WORDS.drop)


def keep_good(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of ``docs`` whose text the model keeps, unchanged and with all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def kept(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        try:
            for texts in batches:
                sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
                out, start, total = [], 0, 0
                for i in range(len(sizes) + 1):
                    if i == len(sizes) or total > SLICE_CHARS:
                        values = texts.slice(start, i - start).to_pylist()
                        out.append(m.probabilities(m.score(values))[:, -1] >= m.cut)
                        start, total = i, 0
                    if i < len(sizes):
                        total += sizes[i]
                yield pa.array(np.concatenate(out), pa.bool_())
        finally:
            _WORDS.drop()
            release()

    return docs.where(kept(F.col("text")))


def op7_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, fit(docs, graded(labels(spark, sf_dir))))
