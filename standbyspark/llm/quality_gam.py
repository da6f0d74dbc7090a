"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a row of numbers, worked out for a whole Arrow batch at once.  On a bounded labelled sample,
cyclic boosting visits one feature after another and adds a shallow tree over that feature's bins to its look-up
table; then the pairs whose residual gain is largest get two-dimensional tables the same way.  A text's log odds are
the sum of its bins' entries.

Defined results: null and empty texts have all-zero features; held-out rows, null labels and null ids are not learned
from; of several labels of an id the smallest counts; without two classes the score is the rate of class 1 (0.5
without labels); repeated rows score alike; only doc_id and text of documents are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import crc_mod, ship, small
from .quality_rules import _CODEPOINT, _DIGIT, _LOWER, _SHOUT, _SYMBOL, _UPPER, _mark, duplicate_lines, repeated_words

SAMPLE_DOCS = 12_000  #: labelled documents that the tables are learned from, about
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 150, 60, 0.15, 2.0

FEATURES = ("log_words", "word_length", "symbols", "shouting", "capitals", "digits", "dup_lines", "repeats", "stutter", "distinct", "pipes", "stops", "line_words", "beyond_ascii", "commas")
_PIPE, _STOP, _COMMA, _NEWLINE, _HIGH = _mark(b"|"), _mark(b"."), _mark(b",;:"), _mark(b"\n"), _mark(range(0xC2, 0xF5))


def features_of(column: pa.Array) -> np.ndarray:
    """One row per text, one column per name in ``FEATURES``."""
    w = tk.words(column)
    n = np.maximum(w.counts, 1).astype(float)
    h = w.hashes(fold=False)
    raw, o = w.data, w.offsets
    chars = np.maximum(w.row_sums(_CODEPOINT), 1).astype(float)
    row = w.row_of_word()
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    with np.errstate(over="ignore"):
        key = np.unique(tk.mix(h + tk.mix(row.astype(np.uint64))), return_index=True)[1]
    lines = w.row_sums(_NEWLINE) + 1.0
    per_row = lambda marks: np.bincount(row[marks], minlength=len(n)).astype(float)
    dup = np.array([duplicate_lines(raw[a:b].tobytes()) for a, b in zip(o[:-1], o[1:], strict=True)], dtype=float)
    return np.column_stack([
        np.log1p(w.counts), chars / n, w.row_sums(_SYMBOL) / n, w.row_sums(_SHOUT) / n, w.row_sums(_UPPER) / (w.row_sums(_UPPER) + w.row_sums(_LOWER) + 1.0),
        w.row_sums(_DIGIT) / chars, dup / lines, repeated_words(h, w.rows) / n, per_row(same) / n, per_row(key) / n, w.row_sums(_PIPE) / n, w.row_sums(_STOP) / n,
        n / lines, w.row_sums(_HIGH) / chars, w.row_sums(_COMMA) / n,
    ])


@dataclass(frozen=True)
class Tables:
    """cuts and values per feature; pairs: (feature, feature, cuts, cuts, values)."""

    intercept: float
    cuts: tuple[np.ndarray, ...]
    values: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray, np.ndarray, np.ndarray], ...]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (cuts, values) in enumerate(zip(self.cuts, self.values, strict=True)):
            out += values[np.searchsorted(cuts, x[:, j], side="right")]
        for a, b, cuts_a, cuts_b, values in self.pairs:
            out += values[np.searchsorted(cuts_a, x[:, a], side="right"), np.searchsorted(cuts_b, x[:, b], side="right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values, bin by bin, of the best tree of up to three leaves over ordered bins."""
    up, uh = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    i, j = np.triu_indices(len(g) + 1)
    total = _gain(up[i], uh[i]) + _gain(up[j] - up[i], uh[j] - uh[i]) + _gain(up[-1] - up[j], uh[-1] - uh[j])
    k = int(np.argmax(total))
    edges = [0, int(i[k]), int(j[k]), len(g)]
    return np.concatenate([np.full(b - a, (up[b] - up[a]) / (uh[b] - uh[a] + RIDGE)) for a, b in zip(edges[:-1], edges[1:], strict=True)])


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree that cuts each of two features once."""
    best, values = -1.0, np.zeros_like(g)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, None)), (slice(i, None), slice(0, j)), (slice(i, None), slice(j, None))]
            sums = [(float(g[p].sum()), float(h[p].sum())) for p in parts]
            gain = sum(a * a / (b + RIDGE) for a, b in sums)
            if gain > best:
                best, values = gain, np.zeros_like(g)
                for p, (a, b) in zip(parts, sums, strict=True):
                    values[p] = a / (b + RIDGE)
    return best, values


def learned(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Tables:
    """Cyclic boosting of ``y`` in {0, 1}."""
    rate = float((y * weight).sum() / weight.sum()) if len(y) else 0.5
    if not len(y) or rate in (0.0, 1.0):
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        return Tables(float(np.log(rate / (1 - rate))), (), (), ())
    intercept = float(np.log(rate / (1 - rate)))
    cuts = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    values = [np.zeros(len(c) + 1) for c in cuts]
    logit = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return (y - p) * weight, np.maximum(p * (1 - p), 1e-6) * weight

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            if len(values[j]) > 1:
                g, h = slopes()
                step = RATE * _tree(np.bincount(b, g, len(values[j])), np.bincount(b, h, len(values[j])))
                values[j] += step
                logit += step[b]
    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    small_bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(coarse)]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell = small_bins[a] * shape[1] + small_bins[b]
        g, h = slopes()
        return np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape)

    able = [j for j in range(x.shape[1]) if len(coarse[j])]
    ranked = sorted(((_quadrants(*grid(a, b))[0], a, b) for i, a in enumerate(able) for b in able[i + 1 :]), reverse=True)[:PAIRS]
    tables = {(a, b): np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for _, a, b in ranked}
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in tables.items():
            step = RATE * _quadrants(*grid(a, b))[1]
            table += step
            logit += step[small_bins[a], small_bins[b]]
    return Tables(intercept, tuple(cuts), tuple(values), tuple((a, b, coarse[a], coarse[b], t) for (a, b), t in tables.items()))


def _featured(docs: DataFrame, keep: str) -> DataFrame:
    """(keep, f) with the feature row as an array; ``docs`` has the columns (keep, text)."""

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch):
                x = features_of(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], names=[keep, "f"])

    return docs.mapInArrow(run, f"{keep} int, f array<double>")


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Tables:
    """Learn from ``labels(doc_id, quality)`` of ids whose crc32 modulo 4 is not 2."""
    ids = labels.filter("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    ids = ids.filter(crc_mod(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sizes = {r["quality"]: r["count"] for r in ids.groupBy("quality").count().collect()}
    chance = {c: min(1.0, sample_docs / 2 / max(sizes.get(c, 0), 1)) for c in (0, 1)}
    share = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 11) / F.lit(float(1 << 53))
    sampled = ids.filter(share < F.when(F.col("quality") == 1, chance[1]).otherwise(chance[0]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = sorted((tuple(r["f"]), r["quality"]) for r in _featured(texts.join(small(sampled), "doc_id").select("quality", "text"), "quality").collect())
    x, y = np.array([r[0] for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r[1] for r in rows], dtype=float)
    weight = np.where(y == 1, 1 / chance[1], 1 / chance[0])
    return learned(x, y, weight / weight.mean() if len(y) else weight)


def scored(docs: DataFrame, tables: Tables) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", held_out.alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch):
                s = tables.scores(features_of(part.column(2)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
