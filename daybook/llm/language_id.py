"""Language identification with error-correcting output codes over byte n-grams.

Every language has a codeword of +1 and -1. One logistic classifier per bit, over hashed counts
of byte 1- to 3-grams, predicts it; a text gets the language whose codeword loses least, where
each bit's loss counts by how well that bit did in training. A text whose best two codewords
are close is flagged ambiguous.

Fitting takes about ``SAMPLE_ROWS`` labelled rows (spread evenly over the languages, chosen by a
hash of the text), a bound that does not grow with the corpus; their features come to the driver.
Texts are scored whole, where they lie, without a shuffle.

Defined results: ``und`` with score 0 for a NULL text or one without a letter, and for every text if there
is no labelled row. With one language all other texts get it. Rows with NULL labels, and rows
that the caller holds out, teach nothing. Columns of the table are kept; one with a result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import with_arrow_columns
from daybook.llm.tokens import slices, text_buffers

UNKNOWN = "und"
DIMENSIONS = 1 << 12
SAMPLE_ROWS = 4_000
#: Languages up to which all ways to split them in two are used as bits.
ALL_SPLITS_UP_TO = 6
AMBIGUOUS_BELOW = 0.6

RESULTS = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType()), ("letter", T.BooleanType())]

_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Letters in lower case, other ASCII as a space, bytes of other characters as they are.
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_GRAM_SLICE = 1 << 20
#: Texts whose n-grams are counted together.
_AT_ONCE = 64


def features(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of hashed n-gram counts, scaled to length 1, one row per text."""
    n = len(offsets) - 1
    out = np.empty((n, DIMENSIONS), dtype=np.float32)
    for i in range(0, n, _AT_ONCE):  # the counts are four dense rows of 8 bytes a slot per text
        out[i: i + _AT_ONCE] = _features(body, offsets[i: i + _AT_ONCE + 1])
    return out


def _features(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    part = _FOLD[body[offsets[0]: offsets[-1]]].astype(np.uint32)
    at = offsets - offsets[0]
    row = np.repeat(np.arange(n, dtype=np.int64) * DIMENSIONS, np.diff(at))
    counts = np.zeros(n * DIMENSIONS, dtype=np.float64)
    gram, last = np.zeros(len(part), dtype=np.uint32), np.repeat(at[1:], np.diff(at))
    here = np.arange(len(part))
    for size in (1, 2, 3):
        gram[: len(part) - size + 1] = gram[: len(part) - size + 1] * np.uint32(256) + part[size - 1:]
        whole = here + size <= last
        slot = (gram[whole] + np.uint32(size << 24)) * np.uint32(2_654_435_761) >> np.uint32(20)
        counts += np.bincount(row[whole] + slot, minlength=n * DIMENSIONS)
    x = np.sqrt(counts.reshape(n, DIMENSIONS))
    return (x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)).astype(np.float32)


def has_letter(column: pa.Array, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script; only texts without an ASCII letter are searched one by one."""
    low, high = offsets[0], offsets[-1]
    total = np.concatenate([[0], np.cumsum(_ASCII_LETTER[body[low:high]])])
    found = total[offsets[1:] - low] > total[offsets[:-1] - low]
    for i in np.flatnonzero(~found):
        text = column[int(i)].as_py()
        found[i] = bool(text and _LETTER.search(text))
    return found


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """A row of +1 and -1 per language: all splits for few languages, else far-apart random words with unequal columns."""
    if n <= 1:
        return np.zeros((n, 0))
    if n <= ALL_SPLITS_UP_TO:
        bits = [[1 if (c >> i) & 1 else -1 for i in range(n)] for c in range(1, 1 << (n - 1))]
        return np.array(bits).T
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(50):
        words = rng.choice([-1, 1], size=(n, int(10 * np.ceil(np.log2(n)))))
        words = words[:, np.abs(words.sum(axis=0)) < n]
        apart = (words.shape[1] - words @ words.T) // 2 + np.eye(n, dtype=int) * words.shape[1]
        if apart.min() > far:
            best, far = words, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray    # language x bit
    weights: np.ndarray  # feature x bit
    bias: np.ndarray
    trust: np.ndarray    # per bit

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and probability of the nearest codeword."""
        if len(self.languages) == 1:
            return np.zeros(len(x), dtype=int), np.ones(len(x))
        margin = x @ self.weights + self.bias
        loss = np.stack([(np.logaddexp(0, -margin * word) * self.trust).sum(axis=1) for word in self.words], axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        return best, share[np.arange(len(x)), best]


def fit(x: np.ndarray, labels: list[str], steps: int = 300, rate: float = 30.0, decay: float = 1e-4) -> Model:
    """Logistic regression per bit by accelerated gradient steps, each language with equal total weight."""
    languages = sorted(set(labels))
    which = np.searchsorted(languages, labels)
    words = codewords(len(languages))
    y = words[which].astype(np.float32)
    share = (1 / np.bincount(which, minlength=len(languages)))[which] / max(1, len(languages))
    share = share.astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], words.shape[1]), dtype=np.float32), np.zeros(words.shape[1], dtype=np.float32)
    dw, db = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps if words.shape[1] else 0):
        pull = y * share / (1 + np.exp(y * (x @ w + b)))
        dw = 0.9 * dw + x.T @ pull - decay * w
        db = 0.9 * db + pull.sum(axis=0)
        w += rate * 0.1 * dw
        b += rate * 0.1 * db
    right = ((np.sign(x @ w + b) == y) * share).sum(axis=0)
    odds = np.log(np.clip(right, 0.5, 0.999) / (1 - np.clip(right, 0.5, 0.999)))
    return Model(languages, words, w, b, odds / odds.max() if len(odds) and odds.max() > 0 else np.ones(words.shape[1]))


def labelled_sample(df: DataFrame, text: str, lang: str, teaches: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most about ``rows`` different texts with a label, evenly over the languages, by a hash of the text; copies count once."""
    known = df.where(teaches & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    each = rows / max(1, len(counts))
    part = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, each / n))]) if counts else None
    if part is None:
        return known.select(F.col(text).alias("text"), F.col(lang).alias("lang")).limit(0)
    drawn = F.pmod(F.xxhash64(F.lit(5), F.col(text)), F.lit(1 << 20)) < part[F.col(lang)] * (1 << 20)
    return known.where(drawn).select(F.col(text).alias("text"), F.col(lang).alias("lang")).distinct()


def train(df: DataFrame, text: str = "text", lang: str = "lang", teaches: Column | None = None) -> Model | None:
    """A model from a bounded sample of the rows for which ``teaches`` holds, or None if there are none."""
    sample = labelled_sample(df, text, lang, F.lit(True) if teaches is None else teaches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body, offsets = text_buffers(b.column(0))
            for i, j in slices(offsets, _GRAM_SLICE):
                x = features(body, offsets[i: j + 1]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b.column(1).slice(i, j - i)], names=["x", "lang"])

    got = sample.mapInArrow(run, "x binary, lang string").toArrow()
    if not got.num_rows:
        return None
    got = got.sort_by([("lang", "ascending"), ("x", "ascending")]).combine_chunks()  # the same model whatever order the rows came in
    langs, rows = got.column("lang").to_pylist(), got.column("x").chunk(0)
    ends = np.frombuffer(rows.buffers()[1], dtype=np.int32)[rows.offset: rows.offset + len(rows) + 1]
    x = np.frombuffer(rows.buffers()[2], dtype=np.uint8)[ends[0]: ends[-1]].view(np.float16).reshape(len(rows), -1).astype(np.float32)
    del got, rows
    pa.default_memory_pool().release_unused()
    return fit(x, langs)


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score (probability of that language among the learned ones), ambiguous and letter (whether it has one)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # features x bits floats

    def judged(b: pa.RecordBatch) -> list[pa.Array]:
        model, column = shared.value, b.column(text)
        body, offsets = text_buffers(column)
        names, scores, letters = [], [], [np.zeros(0, dtype=bool)]
        for i, j in slices(offsets, _GRAM_SLICE):
            # a slice of many short texts is cut further: its features are one dense row per text
            for k in range(i, j, 256):
                end = min(j, k + 256)
                at = offsets[k: end + 1]
                letters.append(has_letter(column.slice(k, end - k), body, at))
                known = letters[-1] & (model is not None)
                if model is None:
                    best, score, langs = np.zeros(end - k, dtype=int), np.zeros(end - k), [UNKNOWN]
                else:
                    (best, score), langs = model.decode(features(body, at)), model.languages
                names += [langs[n] if ok else UNKNOWN for n, ok in zip(best, known)]
                scores.append(np.where(known, score, 0.0))
        score = np.concatenate(scores) if scores else np.zeros(0)
        return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(score < AMBIGUOUS_BELOW, pa.bool_()),
                pa.array(np.concatenate(letters), pa.bool_())]

    return with_arrow_columns(df, RESULTS, lambda batches: map(judged, batches))
