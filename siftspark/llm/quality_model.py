"""Quality classifier: regularised quadratic discriminant analysis.

Each whole text becomes a short vector of transformed statistics. For good and
bad documents the mean and the covariance are taken over all labelled training
rows, as sums that each partition forms by itself; the covariances are shrunk
towards the pooled diagonal. A score compares the two normal log-densities,
whose Mahalanobis distances use Cholesky factors that are computed once.

Defined results: null text counts as empty, and empty texts are scored from
their (zero) statistics like all others. Where the labels are all of one class
the score is that class's smoothed share; without labels it is 0.5. Repeated
rows are scored alike; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.labelled import held_out, labels_by_document
from siftspark.llm.tokens import hashed, mixed, pieces, texts_of, words
from siftspark.session import find_package

FEATURES = (
    "log_words",
    "word_length",
    "symbols",
    "exclamations",
    "upper",
    "digits",
    "new_words",
    "same_as_before",
    "repeated_windows",
    "top_word",
    "repeated_lines",
    "line_length",
    "sentence_ends",
    "commas",
)


@dataclass(frozen=True)
class Params:
    """``shrinkage``: share of the pooled diagonal in each class covariance."""

    threshold: float = 0.7
    folds: int = 4
    held_out_fold: int = 2
    shrinkage: float = 0.1
    ridge: float = 1e-3
    #: Log-odds are cut here, so that no score is exactly 0 or 1.
    most_log_odds: float = 30.0


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for k, chars in enumerate((b"#*$%&|<>", b"!", bytes(range(65, 91)), b"0123456789", b".?", b",;"), 1):
        table[list(chars)] = k
    return table


_CLASSES = _byte_classes()


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the stretches between the offsets; empty stretches give 0."""
    out = np.zeros(len(offsets) - 1)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=np.float64)
    return out


def _distinct(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """keys: row << 48 | hash. Distinct keys of each row and the count of the most frequent."""
    keys = np.sort(keys)
    count, most = np.zeros(n), np.zeros(n)
    if len(keys):
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        run = np.diff(np.append(start, len(keys)))
        row = (keys[start] >> np.uint64(48)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        count[row[first]] = np.diff(np.append(first, len(row)))
        most[row[first]] = np.maximum.reduceat(run, first)
    return count, most


def features_of(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text; at most 65,536 texts at once."""
    n = len(texts)
    flat, off = words(texts, lower=False)
    n_words = np.diff(off).astype(np.float64)
    at_least_one = np.maximum(n_words, 1)
    row = np.repeat(np.arange(n, dtype=np.uint64), np.diff(off))
    h = hashed(flat)
    lengths = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.float64)
    chars = _sums(lengths, off)
    some_chars = np.maximum(chars, 1)

    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    raw = np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)
    kind = _CLASSES[raw]
    # Upper-case Latin letters beyond ASCII: C3 80 to C3 9E in UTF-8.
    wide = np.zeros(len(raw), bool)
    if len(raw) > 1:
        wide[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    per = {k: _sums(kind == k, ends) for k in range(1, 7)}
    per[3] = per[3] + _sums(wide, ends)

    distinct, top = _distinct(row << np.uint64(48) | h >> np.uint64(16), n)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    windows = mixed(mixed(mixed(h[:-2]) + h[1:-1]) + h[2:]) if len(h) > 2 else np.zeros(0, np.uint64)
    inside = row[:-2] == row[2:] if len(h) > 2 else np.zeros(0, bool)
    different, _ = _distinct(row[:-2][inside] << np.uint64(48) | windows[inside] >> np.uint64(16), n) if len(h) > 2 else (np.zeros(n), None)
    n_windows = np.maximum(n_words - 2, 0)

    lines = pc.split_pattern(texts, "\n")
    line_off = np.concatenate([[0], np.cumsum(pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64))])
    every = lines.flatten()
    line_row = np.repeat(np.arange(n, dtype=np.uint64), np.diff(line_off))
    filled = pc.greater(pc.binary_length(every), 0).to_numpy(zero_copy_only=False)
    n_lines = _sums(filled, line_off)
    unlike, _ = _distinct(line_row[filled] << np.uint64(48) | hashed(every)[filled] >> np.uint64(16), n)

    some = lambda share: np.log(share + 1e-3)
    return np.column_stack([
        np.log1p(n_words),
        chars / at_least_one,
        some(per[1] / some_chars),
        some(per[2] / at_least_one),
        some(per[3] / some_chars),
        some(per[4] / some_chars),
        np.log1p(distinct) / np.log1p(at_least_one),
        some(_sums(same, off) / at_least_one),
        some((n_windows - different) / np.maximum(n_windows, 1)),
        some(top / at_least_one),
        some((n_lines - unlike) / np.maximum(n_lines, 1)),
        np.log1p(n_words / np.maximum(n_lines, 1)),
        some(per[5] / at_least_one),
        some(per[6] / at_least_one),
    ])


def document_features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the transformed statistics of each whole text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for at in range(0, batch.num_rows, 1 << 15):
                part = batch.slice(at, 1 << 15)
                x = features_of(texts_of(part))
                arrays = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.record_batch([part.column("doc_id"), arrays], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(make, f"doc_id {dict(docs.dtypes)['doc_id']}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


def class_moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, mean and scatter about zero of each class, from (x, _label). What comes back has a fixed size."""
    d = len(FEATURES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
        for batch in batches:
            x, y = _matrix(batch.column("x")), batch.column("_label").to_numpy(zero_copy_only=False)
            for k, total in sums.items():
                mine = x[y == k]
                total += np.concatenate([[len(mine)], mine.sum(0), (mine.T @ mine).ravel()])
        for k, total in sums.items():
            yield pa.record_batch([pa.array([k] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["k", "i", "v"])

    rows = labelled.select("x", "_label").mapInArrow(partial, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect()
    out = {}
    for k in (0, 1):
        total = np.zeros(1 + d + d * d)
        for r in rows:
            if r["k"] == k:
                total[r["i"]] = r["v"]
        out[k] = (total[0], total[1 : 1 + d], total[1 + d :].reshape(d, d))
    return out


class Discriminant:
    """Two normal densities with their Cholesky factors, and the prior log-odds of the label 1."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], params: Params) -> None:
        n = {k: m[0] for k, m in moments.items()}
        self.prior = float(np.log((n[1] + 1) / (n[0] + 1)))
        self.most = params.most_log_odds
        self.parts: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
        if min(n.values()) < 2:
            return
        mean = {k: s / c for k, (c, s, _) in moments.items()}
        cov = {k: q / c - np.outer(mean[k], mean[k]) for k, (c, _, q) in moments.items()}
        pooled = np.diag(sum(n[k] * np.diag(cov[k]) for k in n) / sum(n.values()))
        self.scale = np.sqrt(np.diag(pooled) + 1e-6)
        for k in n:
            shrunk = (1 - params.shrinkage) * cov[k] + params.shrinkage * pooled
            shrunk = shrunk / np.outer(self.scale, self.scale) + params.ridge * np.eye(len(FEATURES))
            factor = np.linalg.cholesky(shrunk)
            self.parts[k] = (mean[k], np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()))

    def scores(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.prior)
        for k, (mean, inverse, log_det) in self.parts.items():
            z = (x - mean) / self.scale @ inverse.T
            odds += (0.5 if k == 0 else -0.5) * ((z * z).sum(1) + log_det)
        return 1 / (1 + np.exp(-np.clip(odds, -self.most, self.most)))


def quality_scores(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document: held_out, score and predicted."""
    from siftspark.session import checkpointed

    find_package(docs.sparkSession)
    features = checkpointed(document_features(docs).withColumn("held_out", held_out(F.col("doc_id"), params.folds, params.held_out_fold)))
    labelled = features.filter(~F.col("held_out")).join(labels_by_document(labels, "quality"), "doc_id")
    model = Discriminant(class_moments(labelled), params)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(model.scores(_matrix(batch.column("x"))))], names=["doc_id", "held_out", "score"])

    scored = features.mapInArrow(score, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= params.threshold).cast("int"))
