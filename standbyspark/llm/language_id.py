"""Language identification by cross-parsing entropy.

Each language gets a suffix automaton of a bounded sample of its labelled text.  A text is parsed greedily into
the longest phrases that occur in the sample; c phrases against a sample of n symbols estimate the cross entropy
as c log2(n) bits.  The language that needs the fewest bits wins, ties going to the first name.

Symbols are UTF-8 bytes: letters lower-cased (A-Z and the capitals of Latin-1), bytes of other scripts as they are,
and every run of anything else as one blank.  Texts are parsed whole, from end to end: blocks of ``BLOCK`` symbols advance
together, one table look-up a symbol and language, each from the state in which the block before it was left; blocks
are parsed again until these states stand, which is soon, as parses from different states fall into step.

Every language with labelled text is learned.  The samples are bounded: about ``SAMPLE_DOCS`` documents of a language, of each
a span of ``SAMPLE_CHARS`` characters at a place chosen by hash, and ``ALL_SYMBOLS`` symbols shared out over the languages.

Defined results: null texts and texts without a letter are ``und`` with score 0; null ids are never held out; with
no labelled text at all everything is ``und``; repeated rows are predicted alike; only doc_id, text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import crc_mod, ship

SAMPLE_SYMBOLS = 48_000  #: of each language's automaton
SAMPLE_DOCS, SAMPLE_CHARS = 120, 3_000  #: about so many documents of a language are sampled, a span of so many characters of each
ALL_SYMBOLS = 64 * SAMPLE_SYMBOLS  #: of all automata together, so that their tables fit into a worker however many languages there are
BLOCK = 512
BATCH_BYTES = 1 << 22


def _symbol_codes() -> np.ndarray:
    codes = np.zeros(256, dtype=np.uint8)
    codes[97:123] = codes[65:91] = np.arange(1, 27)
    codes[128:256] = np.arange(27, 155)
    return codes


_CODES = _symbol_codes()
_WIDTH = 156  #: symbols, and one for padding
_PAD = 155


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all rows, row offsets)."""
    codes = _CODES[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        codes[1:][capital] += 0x20
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0
    total = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    return codes[keep], total[offsets]


def suffix_automaton(text: bytes) -> tuple[list[dict[int, int]], int]:
    """Transitions of every state (0 is the root) of the automaton that reads all substrings of ``text``."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text:
        state, p = len(following), last
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and symbol not in following[p]:
            following[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = following[p][symbol]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                twin = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(symbol) == q:
                    following[p][symbol] = twin
                    p = link[p]
                link[q] = link[state] = twin
        last = state
    return following, len(text)


@lru_cache(maxsize=1)
def parser(samples: tuple[tuple[str, bytes], ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table, start states, bits a phrase) of all languages in one space of states.

    An entry is 2 * next state + 1 if a new phrase starts with the symbol.  Each language has one more state, entered
    by a symbol that its sample lacks, from which any symbol starts a phrase.
    """
    tables, starts, bits, base = [], [], [], 0
    for _, text in samples:
        following, n = suffix_automaton(text)
        states = len(following) + 1
        lone = base + states - 1
        root = np.full(_WIDTH, 2 * lone + 1, dtype=np.int32)
        for symbol, to in following[0].items():
            root[symbol] = 2 * (base + to) + 1
        table = np.tile(root, (states, 1))
        for state, out in enumerate(following):
            for symbol, to in out.items():
                table[state, symbol] = 2 * (base + to)
        table[:, _PAD] = 2 * (base + np.arange(states))
        tables.append(table)
        starts.append(lone)
        bits.append(np.log2(max(n, 2)))
        base += states
    return np.concatenate(tables).ravel(), np.array(starts, dtype=np.int64), np.array(bits)


def phrases(codes: np.ndarray, offsets: np.ndarray, table: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Phrase counts, one row per text and one column per language."""
    n_blocks = -(-np.diff(offsets) // BLOCK)
    row = np.repeat(np.arange(len(n_blocks)), n_blocks)
    first = np.repeat(offsets[:-1], n_blocks) + BLOCK * (np.arange(len(row)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks))
    size = np.minimum(np.repeat(offsets[1:], n_blocks) - first, BLOCK)
    out = np.zeros((len(n_blocks), len(starts)), dtype=np.int64)
    if not len(row):
        return out
    padded = np.concatenate([codes, np.full(BLOCK, _PAD, dtype=np.uint8)])
    entry = np.repeat(starts[:, None], len(row), axis=1)
    leave, count = np.empty_like(entry), np.zeros(entry.shape, dtype=np.int64)
    todo = np.arange(len(row))
    while len(todo):
        todo = todo[np.argsort(-size[todo], kind="stable")]
        active = len(todo) - np.searchsorted(size[todo][::-1], np.arange(size[todo[0]]), side="right")
        state, found = entry[:, todo], np.zeros((len(starts), len(todo)), dtype=np.int64)
        for t in range(int(size[todo[0]])):
            k = int(active[t])
            step = table.take(state[:, :k] * _WIDTH + padded[first[todo[:k]] + t])
            found[:, :k] += step & 1
            state[:, :k] = step >> 1
        leave[:, todo], count[:, todo] = state, found
        after = np.flatnonzero(row[1:] == row[:-1]) + 1  # blocks inside a text
        moved = (leave[:, after - 1] != entry[:, after]).any(axis=0)
        todo = after[moved]
        entry[:, todo] = leave[:, todo - 1]
    for language in range(len(starts)):
        out[:, language] = np.bincount(row, weights=count[language], minlength=len(out)).astype(np.int64)
    return out


def samples_of(docs: DataFrame) -> tuple[tuple[str, bytes], ...]:
    """(language, sample symbols) from the rows of ``docs(doc_id, text, lang)`` that may be learned from."""
    usable = docs.filter("lang is not null")
    sizes = usable.groupBy("lang").count().collect()  # one row a language
    if not sizes:
        return ()
    most = min(SAMPLE_SYMBOLS, max(ALL_SYMBOLS // len(sizes), 1))
    chance = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], min(1.0, SAMPLE_DOCS / r["count"]))))
    order = F.xxhash64(F.lit(11), F.col("doc_id"))
    share = F.shiftrightunsigned(order, 11) / F.lit(float(1 << 53))
    place = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    rows = usable.withColumn("order", order).filter(share < F.element_at(chance, F.col("lang"))).filter("text is not null").select("lang", F.substring("text", place, F.lit(SAMPLE_CHARS)).alias("text"), "order").collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r["order"], r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"].encode())
    out = []
    for lang in sorted(texts):
        data = np.frombuffer(b" ".join(texts[lang]), dtype=np.uint8)
        codes, _ = symbols(data, np.array([0, len(data)]))
        if (codes > 0).any():
            out.append((lang, codes[:most].tobytes()))
    return tuple(out)


def predictions(column: pa.Array, samples: tuple[tuple[str, bytes], ...]) -> tuple[list[str], np.ndarray]:
    data, offsets = tk.buffers(column)
    codes, at = symbols(data, offsets)
    names, scores = np.full(len(column), "und", dtype=object), np.zeros(len(column))
    if samples and len(column):
        table, starts, bits = parser(samples)
        cost = phrases(codes, at, table, starts) * bits
        best = cost.argmin(axis=1)
        margin = np.exp2(-np.minimum((cost - cost.min(axis=1, keepdims=True)) / 8, 1000.0))
        total = np.concatenate([[0], np.cumsum((codes > 0) & (codes < 27))])
        plain = total[at[1:]] > total[at[:-1]]
        lettered = [bool(p) or (b > a and any(c.isalpha() for c in column[i].as_py() or "")) for i, (p, a, b) in enumerate(zip(plain, offsets[:-1], offsets[1:], strict=True))]
        names = np.where(lettered, np.array([s[0] for s in samples], dtype=object)[best], "und")
        scores = np.where(lettered, 1 / margin.sum(axis=1), 0.0)
    return names.tolist(), scores


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs(doc_id, text, lang)``; rows with remainder 1 are not learned from."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    samples = samples_of(docs.filter(~held_out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch, most=BATCH_BYTES):
                names, scores = predictions(part.column(2), samples)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
