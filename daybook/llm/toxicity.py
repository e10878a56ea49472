"""Toxicity by non-negative positive-unlabelled learning.

The classifier learns from confirmed toxic texts and from unlabelled ones, which hold some toxic
texts too. Its risk is  pi * loss+(P) + max(0, loss-(U) - pi * loss-(P)),  where pi is the share of
toxic texts; where the second term falls below zero, the step climbs back up instead. Features are the
words, and beginnings of longer words, that tell the two sets apart, by whether a text has them once or
more often; the model is logistic and fitted in numpy.

Fitting takes at most about ``POSITIVES`` toxic and ``UNLABELLED`` other texts, chosen by a hash of the text; the
bound does not grow with the corpus. pi is counted over all labelled rows that may teach. Scoring
reads whole texts where they lie, without a shuffle.

Defined results: a NULL or empty text scores what the model gives a text without known words. Without a
confirmed toxic text every score is 0. Labels of a NULL id, and labels of ids that the caller holds out,
teach nothing; if an id has several labels, the highest counts. Columns of the table are kept; one with a
result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import with_arrow_columns
from daybook.llm.tokens import Words, mix, slices, span_hashes, text_buffers

POSITIVES, UNLABELLED = 3_000, 6_000
VOCABULARY = 512
#: Bytes of a longer word that count as its beginning, and the counts from which a term weighs more.
STEM, LEVELS = 6, (1, 2, 4)
THRESHOLD = 0.3

RESULTS = [("score", T.DoubleType()), ("predicted", T.IntegerType())]


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted feature hashes
    weights: np.ndarray     # level by level, then the vocabulary
    bias: float

    def scores(self, words: Words) -> np.ndarray:
        text, feature = terms(words)
        counts = np.zeros((words.n_texts, len(self.vocabulary)))
        if len(self.vocabulary) and len(feature):
            at = np.minimum(np.searchsorted(self.vocabulary, feature), len(self.vocabulary) - 1)
            known = self.vocabulary[at] == feature
            flat = np.bincount(text[known] * len(self.vocabulary) + at[known], minlength=counts.size)
            counts = flat.reshape(counts.shape)
        return 1 / (1 + np.exp(-(levels(counts) @ self.weights + self.bias)))


def terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word, and of the beginning of every longer word."""
    long = np.flatnonzero(words.end - words.start > STEM)
    stems = mix(span_hashes(words.prefix, words.start[long], words.start[long] + STEM))
    return np.concatenate([words.text, words.text[long]]), np.concatenate([words.hash, stems])


def levels(counts: np.ndarray) -> np.ndarray:
    return np.hstack([counts >= n for n in LEVELS]).astype(np.float32)


def telling_terms(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int) -> np.ndarray:
    """Hashes of the terms whose share of texts differs most between the two sets, in standard errors."""
    every, which = np.unique(np.concatenate(positive + unlabelled + [np.zeros(0, dtype=np.uint64)]), return_inverse=True)
    split = sum(map(len, positive))
    p = np.bincount(which[:split], minlength=len(every)) / max(1, len(positive))
    u = np.bincount(which[split:], minlength=len(every)) / max(1, len(unlabelled))
    both = (p * len(positive) + u * len(unlabelled) + 1) / (len(positive) + len(unlabelled) + 2)
    z = np.abs(p - u) / np.sqrt(both * (1 - both) * (1 / max(1, len(positive)) + 1 / max(1, len(unlabelled))))
    often = np.flatnonzero((p * len(positive) + u * len(unlabelled) >= 4) & (z > 4))
    return np.sort(every[often[np.argsort(-z[often], kind="stable")][:size]])


def fit(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by Adam over all rows."""
    theta = np.zeros(xp.shape[1] + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    xp, xu = (np.hstack([x, np.ones((len(x), 1), dtype=np.float32)]) for x in (xp, xu))
    for t in range(1, steps + 1):
        single = theta.astype(np.float32)  # as the matrices, which would be converted in every step otherwise
        zp, zu = xp @ single, xu @ single
        up, uu = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))  # derivatives of the loss of calling a row negative
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        pull_negative = xu.T @ uu / len(xu) - prior * (xp.T @ up) / len(xp)
        if negative >= 0:
            g = prior * (xp.T @ (up - 1)) / len(xp) + pull_negative
        else:
            g = -pull_negative
        g = g + decay * np.append(theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _term_counts(sample: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct terms of each text of a bounded sample and how often each occurs, on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body, offsets = text_buffers(b.column(0))
            for i, j in slices(offsets):
                text, feature = terms(Words(body, offsets, i, j))
                order = np.lexsort((feature, text))
                text, feature = text[order], feature[order]
                first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])])) if len(text) else order
                count = np.minimum(np.diff(np.append(first, len(text))), 255).astype(np.uint8)
                at = np.searchsorted(text[first], np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array([feature[first[a:z]].tobytes() for a, z in zip(at[:-1], at[1:])], pa.binary()),
                    pa.array([count[a:z].tobytes() for a, z in zip(at[:-1], at[1:])], pa.binary())], names=["terms", "counts"])

    got = sample.mapInArrow(run, "terms binary, counts binary").toArrow()
    both = sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    return [(np.frombuffer(t, dtype=np.uint64), np.frombuffer(c, dtype=np.uint8)) for t, c in both]


def _as_matrix(texts: list[tuple[np.ndarray, np.ndarray]], vocabulary: np.ndarray) -> np.ndarray:
    counts = np.zeros((len(texts), len(vocabulary)), dtype=np.uint8)
    for row, (term, count) in zip(counts, texts):
        at = np.minimum(np.searchsorted(vocabulary, term), max(0, len(vocabulary) - 1))
        known = vocabulary[at] == term if len(vocabulary) else np.zeros(len(term), dtype=bool)
        row[at[known]] = count[known]
    return levels(counts)


def train(
    df: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
    teaches: Column | None = None, prior: float | None = None,
) -> Model | None:
    """A model from the labels equal to 1 and from unlabelled rows; ``teaches`` is a condition on the id column."""
    may = F.lit(True) if teaches is None else teaches
    known = labels.where(may & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("_toxic"))
    total, toxic = known.agg(F.count("_toxic"), F.count_if(F.col("_toxic") == 1)).first()
    if not toxic:
        return None
    prior = float(np.clip(toxic / total, 1e-4, 0.9)) if prior is None else prior

    def part(rows: int, of: int, *by: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(3), F.col(doc_id), *by), F.lit(1 << 30)) < min(1.0, rows / max(1, of)) * (1 << 30)

    # at most about POSITIVES ids of a few bytes: the one side that is sent to all tasks
    ids = F.broadcast(known.where((F.col("_toxic") == 1) & part(POSITIVES, toxic)).select(F.col(doc_id).alias("_id")))
    rows = df.where(F.col(text).isNotNull() & F.col(doc_id).isNotNull())
    # copies of a text count once, so that the bounds hold whatever share of the rows they are
    positive = _term_counts(rows.join(ids, F.col(doc_id) == F.col("_id"), "left_semi").select(text).distinct())
    n = df.where(may).count()
    unlabelled = _term_counts(rows.where(may & part(UNLABELLED, n, F.col(text))).select(text).distinct())
    if not positive or not unlabelled:
        return None
    vocabulary = telling_terms([t for t, _ in positive], [t for t, _ in unlabelled], VOCABULARY)
    weights, bias = fit(_as_matrix(positive, vocabulary), _as_matrix(unlabelled, vocabulary), prior)
    return Model(vocabulary, weights, bias)


def score(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with score (0 to 1) and predicted (1 from ``THRESHOLD`` on)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # VOCABULARY words at most

    def each(batches: Iterator[pa.RecordBatch]):
        model = shared.value
        for b in batches:
            body, offsets = text_buffers(b.column(text))
            parts = [np.zeros(0)]
            for i, j in slices(offsets):
                parts.append(model.scores(Words(body, offsets, i, j)) if model else np.zeros(j - i))
            s = np.concatenate(parts)
            yield [pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32), pa.int32())]

    return with_arrow_columns(df, RESULTS, each)
