"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are computed in numpy for a slice of texts at a time. Trees are grown on the driver from at most
``SAMPLE_ROWS`` labelled documents, then laid out as complete binary trees in flat arrays, so that all documents of a slice
walk down all trees in ``DEPTH`` vectorised steps. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, WORD_BYTES, Texts, mix, span_hashes, texts, word_bounds
from .labelled import remainder, sampled_documents, sigmoid

#: The bound on labelled rows that trees are grown from.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAST_HESSIAN, PENALTY = 80, 5, 64, 0.15, 2.0, 1.0
ACCEPT = 0.5
MODULUS, HELD_OUT = 3, 1

_SPACE = np.array([b in b" \t\n\r\x0b\x0c" for b in range(256)])
_KINDS = {
    "upper": [65 <= b <= 90 for b in range(256)], "digit": [48 <= b <= 57 for b in range(256)], "space": list(_SPACE), "stop": [chr(b) in ".?!" for b in range(256)],
    "comma": [chr(b) in ",;:" for b in range(256)], "symbol": [chr(b) in "#$%&*@^~<>=+_\\/{}[]" for b in range(256)], "bar": [chr(b) == "|" for b in range(256)],
    "bang": [chr(b) == "!" for b in range(256)], "beyond_ascii": [b >= 128 for b in range(256)], "line": [b == 10 for b in range(256)],
}
_KINDS = {k: np.array(v) for k, v in _KINDS.items()}
STATISTICS = [
    "log_bytes", "log_words", "word_bytes", "token_bytes", *(f"share_{k}" for k in _KINDS), "short_words", "distinct_words", "repeats_previous", "repeated_threes", "repeated_lines", "line_words",
    "symbol_tokens", "capital_tokens",
]


def _per_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=rows)


def _repeated(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Share of a row's keys that occurred in the row before."""
    mixed = mix(keys + mix(row.astype(np.uint64) + np.uint64(7)))
    first = np.zeros(len(keys), bool)
    first[np.unique(mixed, return_index=True)[1]] = True
    return _per_row((~first).astype(float), row, rows) / np.maximum(np.bincount(row, minlength=rows), 1)


def statistics(part: Texts) -> np.ndarray:
    """One row of :data:`STATISTICS` per text; an empty text has zeros."""
    rows, data, at = len(part), part.data, part.at
    size = np.diff(at).astype(float)
    some = np.maximum(size, 1)
    lower = LOWER[data]
    starts, ends = word_bounds(WORD_BYTES[lower], at)
    row = np.searchsorted(at, starts, side="right") - 1
    words = np.bincount(row, minlength=rows)
    many = np.maximum(words, 1)
    t0, t1 = word_bounds(~_SPACE[data], at)
    trow = np.searchsorted(at, t0, side="right") - 1
    tokens = np.maximum(np.bincount(trow, minlength=rows), 1)
    out = [np.log1p(size), np.log1p(words), _per_row(ends - starts, row, rows) / many, _per_row(t1 - t0, trow, rows) / tokens]
    for kind in _KINDS.values():
        sums = np.r_[0, np.cumsum(kind[data])]
        out.append((sums[at[1:]] - sums[at[:-1]]) / some)
        if kind is _KINDS["line"]:
            lines = sums[at[1:]] - sums[at[:-1]] + 1
    hashes = span_hashes(lower, starts, ends)
    out.append(_per_row(ends - starts <= 3, row, rows) / many)
    out.append(1 - _repeated(hashes, row, rows))
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    out.append(_per_row(same, row, rows) / many)
    threes = mix(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(11)) if len(hashes) > 2 else hashes[:0]
    inside = row[:-2] == row[2:] if len(hashes) > 2 else np.zeros(0, bool)
    out.append(_repeated(threes[inside], row[:-2][inside] if len(hashes) > 2 else row[:0], rows))
    l0, l1 = word_bounds(data != 10, at)
    lrow = np.searchsorted(at, l0, side="right") - 1
    out.append(_repeated(span_hashes(data, l0, l1), lrow, rows))
    out.append(words / lines)
    symbol = np.r_[0, np.cumsum(_KINDS["symbol"][data] | _KINDS["bar"][data])]
    out.append(_per_row(symbol[t1] > symbol[t0], trow, rows) / tokens)
    upper = np.r_[0, np.cumsum(_KINDS["upper"][data])]
    out.append(_per_row(upper[t1] - upper[t0] > 1, trow, rows) / tokens)
    return np.column_stack(out) if rows else np.zeros((0, len(STATISTICS)))


@dataclass
class Forest:
    """``TREES`` complete binary trees: node i's children are 2i+1 (at or below the threshold) and 2i+2."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.leaf))
        rows = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(trees)), np.int64)
        for _ in range(DEPTH if len(trees) else 0):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        return sigmoid(self.start + self.leaf[trees, node - (2**DEPTH - 1)].sum(axis=1))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for the logistic loss. Without rows of both classes, a constant: the share of ones, or one half."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Forest(start, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    binned = np.column_stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)])
    flat = binned + np.arange(x.shape[1]) * BINS
    raw = np.full(len(y), start)
    feature, threshold, leaf = np.zeros((TREES, inner), int), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves))
    for tree in range(TREES):
        p = sigmoid(raw)
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, count = 2**depth - 1, 2**depth
            place = (node - first)[:, None] * (x.shape[1] * BINS) + flat
            g, h = (np.bincount(place.ravel(), weights=np.repeat(v, x.shape[1]), minlength=count * x.shape[1] * BINS).reshape(count, x.shape[1], BINS) for v in (grad, hess))
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            ga, ha = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + PENALTY) + (ga - gl) ** 2 / (ha - hl + PENALTY) - ga**2 / (ha + PENALTY)
            gain[(hl < LEAST_HESSIAN) | (ha - hl < LEAST_HESSIAN)] = -np.inf
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-6 and b < len(cuts[f]):
                    feature[tree, first + k], threshold[tree, first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[tree, node]] > threshold[tree, node])
        at = node - inner
        g, h = np.bincount(at, weights=grad, minlength=leaves), np.bincount(at, weights=hess, minlength=leaves)
        leaf[tree] = -RATE * g / (h + PENALTY)
        raw += leaf[tree][at]
    return Forest(start, feature, threshold, leaf)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees from a bounded sample of labelled documents outside the held-out third; only their statistics reach the driver."""
    names = ", ".join(f"{s} double" for s in STATISTICS)

    def run(batches):
        for batch in batches:
            for part in texts(batch.column(1)):
                x = statistics(part)
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(part.first, len(part)), *(pa.array(c) for c in x.T)], names=["y", *STATISTICS])

    seen = sampled_documents(docs, labels, "quality", sample_rows, MODULUS, HELD_OUT).mapInArrow(run, f"y int, {names}").toPandas()
    seen = seen.sort_values(list(seen.columns))  # the order of rows must not matter to sums
    return grow(seen[STATISTICS].to_numpy(float), seen["y"].to_numpy(float))


def score(docs: DataFrame, forest: Forest, column: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 in ``column`` (replacing one of that name). Null texts score as empty ones."""
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema, T.StructField(column, T.DoubleType())])

    def run(batches):
        for batch in batches:
            got = [forest.score(statistics(part)) for part in texts(batch.column(batch.schema.get_field_index(text_col)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(got) if got else [], pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, forest: Forest, least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``."""
    return score(docs, forest, "__quality").filter(F.col("__quality") >= least).drop("__quality")


def op7(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = score(docs.select("doc_id", "text"), train(docs, labels)).drop("text")
    held = F.coalesce(remainder("doc_id", MODULUS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
