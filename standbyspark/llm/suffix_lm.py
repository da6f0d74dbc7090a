"""Language-model scoring with a probabilistic suffix tree.

A text is read as the UTF-8 bytes of its lower-cased words, one blank between words and one end symbol, so the model
gives a probability to each sequence of words.  All training texts are counted: (up to ``DEPTH`` preceding bytes,
next byte) and whole words.  A context is retained if it makes up at least ``MIN_SHARE`` of all positions and its next
symbols diverge from those of its longest proper suffix (Kullback-Leibler divergence times count over
``MIN_BITS``).  Next-symbol distributions are smoothed towards the suffix's.  The retained contexts, closed under
prefixes, make an automaton whose state is the longest retained suffix of what was read; scoring is two table look-ups
a byte, for all blocks of a batch together.  Next-word shares of known words smooth what the tree spells.

Both scores need each token's training count.  Frequent words (at least ``WORD_SHARE`` of all tokens, so at most
1 / WORD_SHARE of them) go to the workers; occurrences of the others are joined by a shuffle, with what the tree gives
their spelling, and added to the texts' sums after that, so every training word is known to both scores.

Defined results: null texts are empty texts (one end symbol); null ids are training rows; repeated rows are scored
alike and each counts; words are compared by 64-bit hashes; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import checkpointed, crc_mod, ship

DEPTH = 5
MIN_SHARE = 5e-6  #: at most 1 / MIN_SHARE contexts of a depth
MIN_BITS = 2e-7  #: of divergence, per counted position
PRIOR = 3.0  #: weight of the suffix's distribution
WORD_SHARE = 4e-7
BLOCK = 512
CHUNK = 1 << 22  #: symbols that are counted at once
SUMS = ("spelled_sum", "half_sum", "named_sum")  #: a text's log10 probability at each share of names
END_WORD = np.int64(0x454E44)
_U = np.uint64
_END, _BLANK = 0x0A, 0x20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def stream(w: tk.Words) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts as the model reads them, row offsets)."""
    size = w.ends - w.starts + 1
    none = w.counts == 0
    at = np.cumsum(size) - size
    total = int(size.sum())
    source = np.repeat(w.starts - at, size) + np.arange(total)
    out = _FOLD[w.data[np.minimum(source, len(w.data) - 1)]] if total else np.empty(0, dtype=np.uint8)
    out[at + size - 1] = _BLANK
    ends = np.concatenate([[0], np.cumsum(size)])[w.rows[1:]]  # end of each row before rows without words get theirs
    out[ends[~none] - 1] = _END
    out = np.insert(out, ends[none], _END)
    return out, np.concatenate([[0], ends + np.cumsum(none)])


def gram_codes(symbols: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """(context, next) of positions lo..hi as numbers, 8 bits a symbol, next lowest; before a text comes one end, then zeros."""
    row = np.searchsorted(offsets, np.arange(lo, hi), side="right") - 1
    place = np.arange(lo, hi) - offsets[row]
    code = symbols[lo:hi].astype(np.uint64)
    for back in range(1, DEPTH + 1):
        at = np.maximum(np.arange(lo, hi) - back, 0)
        before = np.where(back <= place, symbols[at], np.where(back == place + 1, _END, 0)).astype(np.uint64)
        code |= before << _U(8 * back)
    return code


class Tally:
    """Counts by 64-bit code, merged as they come."""

    def __init__(self) -> None:
        self.codes, self.counts, self.waiting = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), []
        self.size = 0

    def add(self, codes: np.ndarray) -> None:
        found = np.unique(codes, return_counts=True)
        self.waiting.append(found)
        self.size += len(found[0])
        if self.size > 2 * len(self.codes) + 1_000_000:
            self.merge()

    def merge(self) -> None:
        codes = np.concatenate([self.codes, *(c for c, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(n for _, n in self.waiting)])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, dtype=np.int64)
        self.codes, self.counts = codes[first], np.add.reduceat(counts, first) if len(first) else counts
        self.waiting, self.size = [], 0


def counted(texts: DataFrame) -> DataFrame:
    """(kind, code, n) over all rows of ``texts(text)``: kind 0 contexts and next bytes, kind 1 words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = (Tally(), Tally())

        def out() -> Iterator[pa.RecordBatch]:
            for kind, tally in enumerate(tallies):
                tally.merge()
                for i in range(0, len(tally.codes), 100_000):
                    codes, counts = tally.codes[i : i + 100_000], tally.counts[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), kind, dtype=np.int8)), pa.array(codes.view(np.int64)), pa.array(counts)], names=["kind", "code", "n"])

        for batch in batches:
            for part in tk.slices(batch):
                w = tk.words(part.column(0))
                symbols, offsets = stream(w)
                for lo in range(0, len(symbols), CHUNK):
                    tallies[0].add(gram_codes(symbols, offsets, lo, min(lo + CHUNK, len(symbols))))
                tallies[1].add(np.concatenate([w.hashes(), np.full(part.num_rows, END_WORD, dtype=np.int64).view(np.uint64)]))
                if max(len(t.codes) for t in tallies) > 3_000_000:
                    yield from out()
                    tallies = (Tally(), Tally())
        yield from out()

    return texts.select("text").mapInArrow(run, "kind byte, code long, n long").groupBy("kind", "code").agg(F.sum("n").alias("n"))


Counts = tuple[np.ndarray, np.ndarray, np.ndarray]  #: depth << 56 | context, next byte, count


def retained(grams: DataFrame, positions: int) -> Counts:
    """The counts of the contexts that pass the tests, and of the empty context."""
    nexts = F.col("code").bitwiseAND(F.lit(255))
    found: list[pa.Table] = []
    parent = None
    for depth in range(DEPTH + 1):
        mask = (1 << 8 * depth) - 1
        level = grams.groupBy(F.shiftrightunsigned("code", 8).bitwiseAND(F.lit(mask)).alias("ctx"), nexts.alias("nxt")).agg(F.sum("n").alias("n"))
        if depth:  # contexts that reach before the start of a text hold zero bytes; the end that stands there is enough
            level = level.filter(F.shiftrightunsigned("ctx", 8 * (depth - 1)) != 0)
        totals = level.groupBy("ctx").agg(F.sum("n").alias("total")).filter(F.col("total") >= max(MIN_SHARE * positions, 2.0))
        level = checkpointed(level.join(totals, "ctx"), narrow=True)  # at most 1 / MIN_SHARE contexts
        good = level
        if depth:
            suffix = F.col("ctx").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1))
            above = parent.select(F.col("ctx").alias("suffix"), "nxt", F.col("n").alias("n_above"), F.col("total").alias("total_above"))
            bits = F.sum(F.col("n") * F.log2((F.col("n") / F.col("total")) / (F.col("n_above") / F.col("total_above"))))
            telling = level.withColumn("suffix", suffix).join(above, ["suffix", "nxt"]).groupBy("ctx").agg(bits.alias("bits")).filter(F.col("bits") >= MIN_BITS * positions)
            good = level.join(telling.select("ctx"), "ctx", "left_semi")
        found.append(good.select((F.lit(depth << 56) + F.col("ctx")).alias("ctx"), "nxt", "n").toArrow())
        parent = level
    rows = pa.concat_tables(found)
    ctx, nxt, n = (rows.column(c).to_numpy() for c in ("ctx", "nxt", "n"))
    order = np.lexsort((nxt, ctx))
    return ctx[order], nxt[order], n[order]


@dataclass(frozen=True)
class Automaton:
    """Per (state, class): the next state and log10 probability; ``classes`` maps bytes, ``alone`` is log10 of a byte's share of its class."""

    following: np.ndarray
    logs: np.ndarray
    classes: np.ndarray
    alone: np.ndarray
    start: int


def automaton(counts: Counts) -> Automaton:
    contexts, nexts, numbers = counts
    root = dict(zip(nexts[contexts == 0].tolist(), numbers[contexts == 0].tolist(), strict=True))
    common = sorted({_END, _BLANK} | {b for b, _ in sorted(root.items(), key=lambda x: (-x[1], x[0]))[:110]})
    classes = np.full(256, len(common), dtype=np.int64)
    classes[common] = np.arange(len(common))
    width = len(common) + 1
    rare = 256 - len(common)
    alone = np.where(classes == len(common), -np.log10(rare), 0.0)
    by_context: dict[tuple[int, ...], np.ndarray] = {}
    for ctx, nxt, n in zip(contexts.tolist(), nexts.tolist(), numbers.tolist(), strict=True):
        depth, code = ctx >> 56, ctx & (1 << 56) - 1
        key = tuple(int(classes[code >> 8 * i & 255]) for i in range(depth - 1, -1, -1))
        by_context.setdefault(key, np.zeros(width))[classes[nxt]] += n
    weights = np.where(np.arange(width) == len(common), rare, 1) / 256.0
    prefixes = {key[:i] for key in by_context for i in range(len(key) + 1)}
    order = sorted(prefixes, key=lambda k: (len(k), k))
    index = {key: i for i, key in enumerate(order)}
    following, probs = np.zeros((len(order), width), dtype=np.int32), np.zeros((len(order), width), dtype=np.float32)
    fail = np.zeros(len(order), dtype=np.int64)
    for key, i in index.items():
        own = by_context.get(key)
        if i:
            fail[i] = following[fail[index[key[:-1]]], key[-1]] if len(key) > 1 else 0
            following[i] = following[fail[i]]
            probs[i] = probs[fail[i]]
        else:
            probs[i] = weights
        if own is not None:
            prior = PRIOR if i else 128.0
            probs[i] = (own + prior * probs[i]) / (own.sum() + prior)
        for c in range(width):
            child = index.get((*key, c))
            if child is not None:
                # a child is entered only after its own fail link is known: links lead to shorter keys
                following[i, c] = child
    return Automaton(following.ravel(), np.log10(probs, out=probs).ravel(), classes, alone, index.get((int(classes[_END]),), 0))


_built: dict[str, Automaton] = {}


def shared_automaton(name: str, counts: Counts) -> Automaton:
    """The automaton of a run, built once in each worker."""
    if name not in _built:
        _built.clear()
        _built[name] = automaton(counts)
    return _built[name]


def log_probabilities(symbols: np.ndarray, offsets: np.ndarray, model: Automaton) -> np.ndarray:
    """log10 probability of each symbol, after those before it in its row."""
    width = int(model.classes.max()) + 1
    n_blocks = -(-np.diff(offsets) // BLOCK)
    row = np.repeat(np.arange(len(n_blocks)), n_blocks)
    out = np.empty(len(symbols))
    if not len(row):
        return out
    first = np.repeat(offsets[:-1], n_blocks) + BLOCK * (np.arange(len(row)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks))
    size = np.minimum(np.repeat(offsets[1:], n_blocks) - first, BLOCK)
    codes = model.classes[symbols]
    state = np.full(len(row), model.start, dtype=np.int64)
    inner = np.flatnonzero(first > offsets[row])  # blocks inside a text: a state depends on DEPTH symbols at most
    warm = np.zeros(len(inner), dtype=np.int64)
    for back in range(DEPTH, 0, -1):
        warm = model.following.take(warm * width + codes[first[inner] - back])
    state[inner] = warm
    order = np.argsort(-size, kind="stable")
    first, size, state = first[order], size[order], state[order]
    active = len(row) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")
    for t in range(int(size[0])):
        k = int(active[t])
        place = first[:k] + t
        at = state[:k] * width + codes[place]
        out[place] = model.logs.take(at)
        state[:k] = model.following.take(at)
    return out + model.alone[symbols]


def mixture_shares(novelty: float) -> tuple[float, ...]:
    return 0.0, 0.5, 1 - novelty


def unit_logs(symbol_logs: np.ndarray, offsets: np.ndarray, w: tk.Words, end_share: float) -> tuple[np.ndarray, np.ndarray]:
    """Per unit, a word with the blank or end after it: (log10 of its spelling by the tree, log10 of the share of such ends)."""
    filled = w.counts > 0
    if not len(w.starts):
        return np.empty(0), np.empty(0)
    size = w.ends - w.starts + 1
    starts = np.cumsum(size) - size
    shift = np.concatenate([[0], np.cumsum(~filled)])[:-1]  # ends of rows without words stand between the units
    starts = starts + np.repeat(shift, w.counts)
    spelled = np.add.reduceat(np.append(symbol_logs, 0.0), np.column_stack([starts, starts + size]).ravel())[::2]
    last = np.zeros(len(starts), dtype=bool)
    last[w.rows[1:][filled] - 1] = True
    return spelled, np.where(last, np.log10(max(end_share, 1e-12)), np.log10(max(1 - end_share, 1e-12)))


def mixture_sums(spelled: np.ndarray, named: np.ndarray, row: np.ndarray, n_rows: int, novelty: float) -> np.ndarray:
    """Per share of names and row, the log10 probability of the row's units."""
    sums = []
    for share in mixture_shares(novelty):
        own = spelled
        if share > 0:
            high = np.maximum(named, spelled)
            with np.errstate(divide="ignore"):
                own = high + np.log10(share * np.exp2((named - high) * np.log2(10)) + (1 - share) * np.exp2((spelled - high) * np.log2(10)))
        sums.append(np.bincount(row, weights=own, minlength=n_rows))
    return np.array(sums, dtype=float)


def text_scores(symbol_logs: np.ndarray, offsets: np.ndarray, w: tk.Words, word_logs: np.ndarray, end_share: float, novelty: float) -> np.ndarray:
    """log10 probability of each row under the whole model.

    The tree spells every unit; a known word's share among the training words (``word_logs``, -inf if unknown) smooths
    that at three weights, and the rows' probabilities under the three are averaged, which is again a probability of
    token sequences.
    """
    spelled, after = unit_logs(symbol_logs, offsets, w, end_share)
    if not len(spelled):
        return symbol_logs
    totals = mixture_sums(spelled, word_logs + after, w.row_of_word(), len(offsets) - 1, novelty)
    best = np.max(totals, axis=0)
    out = best + np.log10(np.mean(np.exp2((totals - best) * np.log2(10)), axis=0))
    return np.where(w.counts > 0, out, symbol_logs[offsets[:-1]])


def scored(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 1, F.lit(False))
    counts = checkpointed(counted(docs.filter(~held_out)))
    words = counts.filter("kind = 1").select("code", "n")
    facts = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).collect()}
    n_tokens, n_distinct = (facts[1]["total"], facts[1]["distinct"]) if 1 in facts else (0, 0)
    norm = float(np.log10(n_tokens + 0.5 * (n_distinct + 1)))
    none = np.empty(0, dtype=np.int64)
    model = retained(counts.filter("kind = 0").select("code", "n"), facts[0]["total"]) if 0 in facts else (none, none, none)
    least = max(WORD_SHARE * n_tokens, 1.0)
    frequent = words.filter(F.col("n") >= least).toArrow()
    codes = frequent.column("code").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(codes)
    known = codes[order], np.log10(frequent.column("n").to_numpy().astype(float)[order] + 0.5)
    n_ends = sum(r["n"] for r in words.filter(F.col("code") == int(END_WORD)).collect())
    n_words = max(n_tokens - n_ends, 1)
    once = words.filter("n = 1").count()
    end_share, novelty = n_ends / (n_words + n_ends), min(max(once / n_words, 1e-4), 0.5)
    shared, name = docs.sparkSession.sparkContext.broadcast((model, known)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, (codes, logs) = shared.value
        own = shared_automaton(name, tree)
        for batch in batches:
            for part in tk.slices(batch):
                w = tk.words(part.column(2))
                symbols, offsets = stream(w)
                h = np.concatenate([w.hashes(), np.full(part.num_rows, END_WORD).view(np.uint64)])
                row = np.concatenate([w.row_of_word(), np.arange(part.num_rows)])
                at = np.minimum(np.searchsorted(codes, h), max(len(codes) - 1, 0))
                hit = codes[at] == h if len(codes) else np.zeros(len(h), dtype=bool)
                base = np.bincount(row[hit], weights=logs[at[hit]] if len(codes) else None, minlength=part.num_rows)
                n_known = np.bincount(row[hit], minlength=part.num_rows)
                symbol_logs, n = log_probabilities(symbols, offsets, own), len(w.starts)
                spelled, after = unit_logs(symbol_logs, offsets, w, end_share)
                common = hit[:n]
                named = logs[at[:n][common]] - np.log10(n_words) + after[common] if len(codes) else np.empty(0)
                sums = mixture_sums(spelled[common], named, row[:n][common], part.num_rows, novelty)
                # of a seldom word's mixture, the share of its end can be taken out beforehand
                sums += np.bincount(row[:n][~common], weights=after[~common], minlength=part.num_rows)
                bare = np.flatnonzero(w.counts == 0)
                sums[:, bare] = symbol_logs[offsets[bare]]
                miss = np.flatnonzero(~hit)[np.argsort(row[~hit], kind="stable")]
                relative = np.append(spelled - after, np.zeros(part.num_rows))[miss]
                ends = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=part.num_rows))])
                rare = pa.StructArray.from_arrays([pa.array(h[miss].view(np.int64)), pa.array(relative, mask=miss >= n)], names=["code", "spelled"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(w.counts + 1), pa.array(n_known), pa.array(base.astype(float)), *(pa.array(x.astype(float)) for x in sums), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)],
                    names=["doc_id", "held_out", "n_tokens", "n_common", "base", *SUMS, "rare"],
                )

    sums_type = ", ".join(f"{c} double" for c in SUMS)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, f"doc_id long, held_out boolean, n_tokens long, n_common long, base double, {sums_type}, rare array<struct<code:long,spelled:double>>")
    rows = checkpointed(rows).withColumn("row", F.monotonically_increasing_id())
    spread = rows.select("row", F.inline("rare"))
    seldom = words.filter(F.col("n") < least)
    unseen = F.log10(F.lit(0.5))
    name_log = F.log10(F.col("n") + 0.5) - F.lit(float(np.log10(n_words)))

    def mixed(share: float) -> Column:
        if share == 0:
            return F.col("spelled")
        high = F.greatest(name_log, F.col("spelled"))
        both = high + F.log10(share * F.pow(F.lit(10.0), name_log - high) + (1 - share) * F.pow(F.lit(10.0), F.col("spelled") - high))
        return F.when(F.col("n").isNull(), F.col("spelled") + float(np.log10(1 - share))).otherwise(both)

    totals = [F.sum(F.when(F.col("spelled").isNotNull(), mixed(share))).alias(f"rest_{c}") for c, share in zip(SUMS, mixture_shares(novelty), strict=True)]
    rest = spread.join(seldom, "code", "left").groupBy("row").agg(F.sum(F.coalesce(F.log10(F.col("n") + 0.5), unseen)).alias("rest"), F.count("n").alias("n_rest"), *totals)
    whole = rows.drop("rare").join(rest, "row", "left").select("*", *((F.col(c) + F.coalesce(f"rest_{c}", F.lit(0.0))).alias(f"whole_{c}") for c in SUMS))
    best = F.greatest(*(F.col(f"whole_{c}") for c in SUMS))
    score = F.col("best") + F.log10(sum((F.pow(F.lit(10.0), F.col(f"whole_{c}") - F.col("best")) for c in SUMS), F.lit(0.0)) / len(SUMS))
    return whole.withColumn("best", best).select("doc_id", "held_out", "n_tokens", (F.col("n_common") + F.coalesce("n_rest", F.lit(0))).alias("n_known"), F.lit(n_tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"), score.alias("score"))
