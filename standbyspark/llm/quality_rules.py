"""Quality rules as a short-circuit cascade.

Counts of whole texts, which the result reports for every row, come from one vectorised pass per Arrow batch.  Executors time
every rule and measure how often it rejects on rows sampled by hash over the whole table; the driver gets a few sums, sorts
the rules by rejections per second, and each rule is evaluated only on rows that no earlier rule has rejected.  The order
changes the cost, never a verdict.

Defined results: null and empty texts have zero counts and fail the base rule; a null id is carried through;
repeated rows are judged one by one; the counts do not depend on other columns, whose names may clash with ours
(only ``doc_id`` and ``text`` are read); an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import ship

SAMPLE_ROWS = 2_000  #: about so many rows on which cost and selectivity are estimated; any order gives the same verdicts
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _mark(chars: bytes | range) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL = _mark(b"#*$%&|<>")
_CODEPOINT = ~(_mark(range(0x80, 0xC0)) | tk._SPACE)


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def repeated_words(h: np.ndarray, rows: np.ndarray, width: int = 3) -> np.ndarray:
    """Per row, the words inside windows of ``width`` words that occur twice or more in the row."""
    out = np.zeros(len(rows) - 1, dtype=np.int64)
    if len(h) < width:
        return out
    counts = np.diff(rows)
    row = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    with np.errstate(over="ignore"):
        key = tk.mix(tk.mix(h[:-2] * np.uint64(3) + np.uint64(1)) + h[1:-1])
        key = tk.mix(tk.mix(key * np.uint64(5) + h[2:]) + row[:-2] * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(row[:-2] == row[2:])
    key = key[at]
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        found = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        hit = at[twice[found] == key]
        covered = np.zeros(len(h), dtype=bool)
        for i in range(width):
            covered[hit + i] = True
        total = np.concatenate([[0], np.cumsum(covered)])
        out = total[rows[1:]] - total[rows[:-1]]
    return out


def counts_of(column: pa.Array) -> dict[str, np.ndarray]:
    w = tk.words(column)
    raw, o = w.data, w.offsets
    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": w.row_sums(_CODEPOINT),
        "n_symbols": w.row_sums(_SYMBOL),
        "n_dup_lines": np.array([duplicate_lines(raw[a:b].tobytes()) for a, b in zip(o[:-1], o[1:], strict=True)], dtype=np.int64),
        "n_repeat_words": repeated_words(w.hashes(fold=False), w.rows).astype(np.int64),
    }


@dataclass(frozen=True)
class Rule:
    """``rejects(view)`` gets an object with ``text`` (list of bytes) and ``count(name)``, and returns a boolean array."""

    name: str
    rejects: Callable[[View], np.ndarray]


class View:
    """The rows a rule is asked about."""

    def __init__(self, column: pa.Array, counts: dict[str, np.ndarray], rows: np.ndarray):
        self.column, self.counts, self.rows = column, counts, rows

    def count(self, name: str) -> np.ndarray:
        return self.counts[name][self.rows]

    def marked(self, table: np.ndarray) -> np.ndarray:
        """Per row, the bytes that the 256-entry ``table`` marks."""
        data, offsets = tk.buffers(self.column.take(pa.array(self.rows)))
        return tk.sums_between(table, data, offsets)

    def sizes(self) -> np.ndarray:
        return self.marked(np.ones(256, dtype=bool))


_UPPER, _LOWER = _mark(range(65, 91)), _mark([*range(97, 123)])
_DIGIT = _mark(range(48, 58))
_SHOUT = _mark(b"!?")


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


#: The production rules. Each names the part of a text that makes it unfit for training.
RULES = (
    Rule("symbols", lambda v: 10 * v.count("n_symbols") > v.count("n_words")),
    Rule("word_length", lambda v: (_ratio(v.count("word_chars"), v.count("n_words")) > 15) | (v.count("word_chars") < 2 * v.count("n_words"))),
    Rule("repetition", lambda v: 10 * v.count("n_repeat_words") > 3 * v.count("n_words")),
    Rule("shouting", lambda v: 4 * v.marked(_SHOUT) > v.count("n_words")),
    Rule("capitals", lambda v: v.marked(_UPPER) > v.marked(_LOWER)),
    Rule("digits", lambda v: 5 * v.marked(_DIGIT) > v.count("word_chars")),
)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def measured(column: pa.Array, rules: tuple[Rule, ...] = RULES) -> tuple[int, list[tuple[str, float, int]]]:
    """(rows that pass the base rule, and of each rule the seconds for them and how many it rejects)."""
    counts = counts_of(column)
    view, found = View(column, counts, np.flatnonzero(~base_failed(counts))), []
    for rule in rules:
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            rejected = rule.rejects(view)
            runs.append(time.perf_counter() - began)
        found.append((rule.name, min(runs), int(np.sum(rejected))))
    return len(view.rows), found


def ranked(sums: dict[str, tuple[int, float, int]], rules: tuple[Rule, ...] = RULES) -> list[tuple[str, float, float]]:
    """(rule, seconds per row, share rejected) in the order of most rejections per second, from sums of (rows, seconds, rejected)."""
    none = (0, 0.0, 0)
    found = [(r.name, sums.get(r.name, none)[1] / max(sums.get(r.name, none)[0], 1), sums.get(r.name, none)[2] / max(sums.get(r.name, none)[0], 1)) for r in rules]
    return sorted(found, key=lambda x: -(x[2] + 1e-6) / (x[1] + 1e-9))


def measured_order(texts: list[str | None], rules: tuple[Rule, ...] = RULES) -> list[tuple[str, float, float]]:
    """``ranked`` for one list of texts."""
    if not texts:
        return ranked({}, rules)
    n, found = measured(pa.array(texts, type=pa.string()), rules)
    return ranked({name: (n, seconds, rejected) for name, seconds, rejected in found}, rules)


def sampled_order(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int) -> list[str]:
    """The names of the rules in the order that a sample of ``docs(doc_id, text)`` by hash suggests; measured where the rows are."""
    share = F.shiftrightunsigned(F.xxhash64(F.lit(9), "doc_id", F.length("text")), 11) / F.lit(float(1 << 53))
    sample = docs.filter(share < sample_rows / max(docs.select("doc_id").count(), 1)).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch):
                n, found = measured(part.column(0), rules)
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found]), pa.array([n] * len(found), pa.int64()), pa.array([x[1] for x in found]), pa.array([x[2] for x in found], pa.int64())], names=["rule", "n", "seconds", "rejected"])

    sums = sample.mapInArrow(run, "rule string, n long, seconds double, rejected long").groupBy("rule").agg(F.sum("n").alias("n"), F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
    return [x[0] for x in ranked({r["rule"]: (r["n"], r["seconds"], r["rejected"]) for r in sums.collect()}, rules)]


def judge(column: pa.Array, order: list[str], rules: tuple[Rule, ...] = RULES) -> dict[str, np.ndarray]:
    """The counts, base verdict, final verdict and first rejecting rule (null if none) of each row."""
    counts, by_name = counts_of(column), {r.name: r for r in rules}
    failed = base_failed(counts)
    kept, why = ~failed, np.full(len(failed), None, dtype=object)
    left = np.flatnonzero(kept)
    for name in order:
        if not len(left):
            break
        rejected = by_name[name].rejects(View(column, counts, left))
        why[left[rejected]] = name
        kept[left[rejected]] = False
        left = left[~rejected]
    return counts | {"base_failed": failed, "kept": kept, "rejected_by": why}


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"


def apply(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Judge ``docs(doc_id, text)``: one row out for each row in."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = sampled_order(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch):
                out = judge(part.column(1), order, rules)
                arrays = [part.column(0), *(pa.array(out[c]) for c in (*COUNTS, "base_failed", "kept")), pa.array(out["rejected_by"], type=pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *COUNTS, "base_failed", "kept", "rejected_by"])

    return docs.mapInArrow(run, SCHEMA)
