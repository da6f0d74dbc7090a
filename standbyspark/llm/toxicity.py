"""Toxicity scores behind a noisy-channel decoder.

*Restoring.*  A stretch of text is a character lattice: each character may stand for itself or for letters that it
resembles (leetspeak), a repeated letter may be one, a separator or a blank may be dropped or end a word, and a word may
begin without any blank.  Viterbi search finds the likeliest words under a character model (five letters, Witten-Bell
smoothing) of the training words and the channel's costs; runs of over three equal characters count as three.

*Where to decode.*  Texts are also read with look-alikes merged, runs made one and everything else left out.  A lattice can
restore a lexicon word only where its reading of that kind occurs, so only the stretches around such places (whole tokens,
at most ``CONTEXT`` characters to each side) are decoded; elsewhere no path gives a lexicon word.  Undisguised tokens are
their own restoration.

*Scoring.*  Features are words, beginnings of words, and beginnings that two different words of a text have.  The lexicon
has those of high precision whose number of toxic documents chance does not explain: hypergeometric tails, false discovery rate
``FDR``, and of related features (one beginning) only those significant on documents that a better one leaves.  Disguised tokens of the training texts are restored before they are counted; families of near copies count once,
so words that merely stand in copied toxic texts are not learned.  A text's score is the noisy-or of its restored
words' precisions over the rate without any.

*Learning.*  All labelled documents that are not held out are learned from, none is sampled.  Their words, the character
model's counts and the features' counts are summed by shuffles; the driver gets the character model, how many features have
which counts (which fixes the false discovery rate's cut), and the significant features.  Toxic near copies are those that share
one of ``BANDS`` pairs of least hashes of three-word shingles with a toxic document of more words (or, if as many, a lesser digest).

Defined results: null and empty texts get the base rate; labels that are null, and held-out rows, are not learned
from; of several labels of an id the largest counts, of several texts of an id the one of the least hash is learned from;
null ids are never held out; equal rows score alike, and ties between readings go to the first in alphabetical order.
"""

from __future__ import annotations

import gc
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import checkpointed, crc_mod, forgotten, ship, small, staged

THRESHOLD = 0.3
BEGINNINGS = (4, 5, 6)
MIN_PRECISION, FDR, MIN_DOCS = 0.6, 0.05, 4
ORDER = 5
CONTEXT = 64  #: characters beside a place that are decoded with it
CACHE = 50_000  #: tokens a worker remembers
PARTIAL, ROWS = 200_000, 500  #: names a worker counts before it hands their counts on to be summed; rows it takes from Arrow at once
SHINGLE, BANDS = 3, 16  #: words of a shingle; pairs of least hashes, of which near copies share one

#: Characters and the letters they may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
EDGE = ".,;:!?\"'()[]{}<>*#%&$|…«»“”‘’-_=/\\"
#: Log costs: a look-alike, a dropped mark, a dropped blank between single characters and elsewhere, a dropped digit, a letter of a
#: run of three, of a pair, a word that ends at a mark, and one that begins without anything between.
_LEET, _DROP, _SPELLED, _JOIN, _LOSE, _REPEAT, _DOUBLE, _MARK, _GLUE = -1.2, -0.7, -0.3, -6.0, -4.2, -0.4, -3.0, -1.0, -10.0
_RUN, _LONG_RUN = re.compile(r"(.)\1+", re.DOTALL), re.compile(r"(.)\1{3,}", re.DOTALL)
_START = "^" * (ORDER - 1)
_ONLY_EDGE = "".join(x for x in EDGE if x not in LEET)


def _merged(c: str) -> str | None:
    """What a character is read as when look-alikes are merged; None if it is left out."""
    c = LEET.get(c, c)[0]
    return ("i" if c == "l" else c) if c.isalpha() else None


class _Merge(dict):
    def __missing__(self, code: int) -> str | None:
        self[code] = found = _merged(chr(code))
        return found


_MERGE = _Merge()


def squeezed(text: str) -> str:
    """A lower-case text with look-alikes merged, all but letters left out, and runs made one."""
    return _RUN.sub(r"\1", text.translate(_MERGE))


def places(text: str) -> tuple[str, list[int], list[int]]:
    """(squeezed text, first and last place in ``text`` of what each of its letters stands for)."""
    out, first, last = [], [], []
    for i, c in enumerate(text):
        m = _MERGE[ord(c)]
        if m is None:
            continue
        if out and out[-1] == m:
            last[-1] = i
        else:
            out.append(m)
            first.append(i)
            last.append(i)
    return "".join(out), first, last


@dataclass(frozen=True)
class Model:
    """lexicon: (w: word, p: beginning of a word, or m: beginning of two different words, precision); grams: counts of the
    character model; base: the rate without any feature."""

    lexicon: tuple[tuple[str, float], ...]
    grams: tuple[tuple[str, int], ...]
    base: float


class CharModel:
    """log probability of a letter (or the end, ``$``) after up to four others."""

    def __init__(self, grams: dict[str, int]):
        self.counts: Counter[str] = Counter()
        self.totals: Counter[str] = Counter()
        self.kinds: Counter[str] = Counter()
        for gram, n in grams.items():
            for k in range(1, ORDER + 1):
                part = gram[-k:]
                if part not in self.counts:
                    self.kinds[part[:-1]] += 1
                self.counts[part] += n
                self.totals[part[:-1]] += n
        self.known: dict[str, float] = {}

    def share(self, gram: str) -> float:
        if not gram[:-1]:
            return (self.counts[gram] + self.kinds[""] / 200) / (self.totals[""] + self.kinds[""] + 1)
        total, kinds = self.totals[gram[:-1]], self.kinds[gram[:-1]]
        shorter = self.share(gram[1:])
        return (self.counts[gram] + kinds * shorter) / (total + kinds) if total else shorter

    def log(self, context: str, symbol: str) -> float:
        gram = context + symbol
        found = self.known.get(gram)
        if found is None:
            if len(self.known) > CACHE:
                self.known.clear()
            found = self.known[gram] = math.log(max(self.share(gram), 1e-12))
        return found


def grams_of(words: Counter[str]) -> Counter[str]:
    out: Counter[str] = Counter()
    for word, n in words.items():
        padded = _START + word + "$"
        for i in range(len(padded) - ORDER + 1):
            out[padded[i : i + ORDER]] += n
    return out


def steps(text: str, i: int) -> tuple[list[tuple[str, float]], float | None, float | None, float, float | None]:
    """The ways to read character i: (letters and costs, cost of dropping it, of ending a word, of a repeat, of a word beginning here)."""
    c = text[i]
    before, after = text[i - 1 : i], text[i + 1 : i + 2]
    letters = [(c, 0.0)] if c.isalpha() else [(x, _LEET) for x in LEET.get(c, "")]
    triple = (before == c == after) or text[max(0, i - 2) : i] == c * 2 or text[i + 1 : i + 3] == c * 2
    if c.isspace():
        single = (i < 2 or text[i - 2].isspace()) and (i + 2 >= len(text) or text[i + 2].isspace())
        return [], _SPELLED if single else _JOIN, 0.0, 0.0, None
    drop = None if c.isalpha() else _LOSE if c.isdigit() else _DROP
    end = None if c.isalpha() or c.isdigit() else _MARK
    begin = _GLUE if before and not before.isspace() else None
    return letters, drop, end, _REPEAT if triple else _DOUBLE, begin


def restored(text: str, chars: CharModel) -> tuple[float, str]:
    """The likeliest words (blanks between) behind a lower-case stretch of text, and their log probability with the channel's costs."""
    best: dict[str, tuple[float, str]] = {_START: (0.0, "")}  # last letters of the word -> log probability, letters so far
    for i in range(len(text)):
        letters, drop, end, repeat, begin = steps(text, i)
        after: dict[str, tuple[float, str]] = {}

        def offer(key: str, value: float, out: str, after: dict[str, tuple[float, str]] = after) -> None:
            old = after.get(key)
            if old is None or old[0] < value or old[0] == value and out < old[1]:
                after[key] = (value, out)

        for key, (score, out) in best.items():
            inside = key != _START
            for letter, cost in letters:
                offer((key + letter)[1:], score + cost + chars.log(key, letter), out + letter)
                if inside and key[-1] == letter:
                    offer(key, score + cost + repeat, out)
                if inside and begin is not None:
                    offer((_START + letter)[1:], score + cost + begin + chars.log(key, "$") + chars.log(_START, letter), out + " " + letter)
            if drop is not None:
                offer(key, score + drop, out)
            if end is not None:
                offer(_START, score + end + (chars.log(key, "$") if inside else 0.0), out + " " if inside else out)
        best = after
    return max(((score + (chars.log(key, "$") if key != _START else 0.0), out.strip()) for key, (score, out) in best.items()), key=lambda x: (x[0], [-ord(c) for c in x[1]]))


def is_plain(token: str) -> bool:
    """Whether a token without outer marks is its own restoration: letters only, none twice in a row."""
    return token.isalpha() and not _RUN.search(token)


class Scorer:
    def __init__(self, model: Model):
        self.weights, self.base, self.chars = dict(model.lexicon), model.base, CharModel(dict(model.grams))
        self.words = {f[2:] for f in self.weights if f[0] == "w"}
        self.beginnings = {f[2:] for f in self.weights if f[0] != "w"}
        self.sizes = sorted({len(b) for b in self.beginnings})
        self.squeezed_beginnings = tuple(sorted({squeezed(b) for b in self.beginnings}))
        self.index = ahocorasick.Automaton()
        self.meant: dict[str, set[str]] = {}
        for word in sorted(self.words):
            key = squeezed(word)
            self.meant.setdefault(key, set()).add(word)
            self.index.add_word(key, key)
        if self.words:
            self.index.make_automaton()
        self.tokens: dict[str, tuple[str, ...]] = {}
        self.readings: dict[str, tuple[str, ...]] = {}

    def telling(self, words: Iterable[str]) -> tuple[str, ...]:
        """Those of ``words`` that the lexicon holds or has a beginning of."""
        return tuple(w for w in words if w in self.words or any(w[:k] in self.beginnings for k in self.sizes))

    def reading(self, stretch: str) -> tuple[str, ...]:
        """The telling words of a stretch's likeliest reading."""
        stretch = _LONG_RUN.sub(r"\1\1\1", stretch)
        found = self.readings.get(stretch)
        if found is None:
            if len(self.readings) > CACHE:
                self.readings.clear()
            found = self.readings[stretch] = self.telling(set(restored(stretch, self.chars)[1].split()))
        return found

    def token(self, token: str) -> tuple[str, ...]:
        """The telling words of one token; of disguised ones only beginnings need a look, words being found by the index."""
        plain = token.strip(EDGE)
        found = self.telling([plain])
        if found or not self.beginnings or is_plain(plain):
            return found
        for form in {plain, token.strip(_ONLY_EDGE)}:
            if squeezed(form[: 4 * CONTEXT]).startswith(self.squeezed_beginnings):
                found += self.reading(form[:CONTEXT])
        return found

    def told(self, text: str) -> set[str]:
        """The telling words of a text, restored."""
        low = text.lower()
        out: set[str] = set()
        known = self.tokens
        for token in set(low.split()):
            words = known.get(token)
            if words is None:
                if len(known) > CACHE:
                    known.clear()
                words = known[token] = self.token(token)
            if words:
                out.update(words)
        if not self.words:
            return out
        wanted = {key for _, key in self.index.iter(squeezed(low)) if not self.meant[key] <= out}
        if wanted:
            short, first, last = places(low)
            for end, key in self.index.iter(short):
                if key not in wanted or self.meant[key] <= out:
                    continue
                a, b = first[end - len(key) + 1], last[end]
                if len(_LONG_RUN.sub(r"\1\1\1", low[a : b + 1])) > 8 * CONTEXT:
                    continue  # marks and blanks by the hundred inside one word are no disguise of it
                lo = max(a - CONTEXT, max(low.rfind(s, max(0, a - CONTEXT), a + 1) for s in " \t\n\r") + 1)
                stop = [x for s in " \t\n\r" if (x := low.find(s, b, b + CONTEXT)) >= 0]
                out.update(self.reading(low[lo : min(stop, default=min(b + CONTEXT, len(low)))]))
        return out

    def found(self, text: str) -> set[str]:
        """The lexicon's features in a text."""
        words = self.told(text)
        out = {"w:" + w for w in words if w in self.words}
        if self.beginnings and words:
            starts = Counter(w[:k] for w in words for k in self.sizes if len(w) >= k)
            out.update(f for b, n in starts.items() for f in (("p:" + b, "m:" + b) if n > 1 else ("p:" + b,)))
        return {f for f in out if f in self.weights}

    def score(self, text: str | None) -> float:
        left = 1.0 - self.base
        for feature in sorted(self.found(text or "")):
            left *= 1.0 - self.weights[feature]
        return 1.0 - left


@contextmanager
def scorer(model: Model) -> Iterator[Scorer]:
    """A scorer for one task; idle workers keep nothing of it, since later stages need the memory."""
    own = Scorer(model)
    try:
        yield own
    finally:
        own.__dict__.clear()
        del own
        gc.collect()
        tk.release()


def _choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def log_tail(hits: int, n: int, rate: float, total: int | None = None) -> float:
    """log of the chance of at least ``hits`` toxic documents among ``n`` at this rate (its first term and a geometric bound).

    With ``total``, the ``n`` are drawn from so many documents, of which the rate is toxic (hypergeometric, not binomial).
    """
    if hits <= n * rate:
        return 0.0
    if total is None:
        first = _choose(n, hits) + hits * math.log(rate) + (n - hits) * math.log(1 - rate)
        ratio = (n - hits) / (hits + 1) * rate / (1 - rate)
    else:
        toxic = round(rate * total)
        first = _choose(toxic, hits) + _choose(total - toxic, n - hits) - _choose(total, n)
        ratio = (toxic - hits) * (n - hits) / (hits + 1) / (total - toxic - n + hits + 1)
    return min(first - math.log(1 - ratio), 0.0)


def cut_of(tails: Iterable[tuple[float, int]], fdr: float = FDR) -> float:
    """The largest log tail that passes Benjamini and Hochberg's procedure, of (log tail, number of names that have it)."""
    able = sorted(tails)
    total, at, cut = sum(n for _, n in able), 0, -math.inf
    for p, n in able:
        at += n
        if p <= math.log(fdr * at / total):
            cut = p
    return cut


def significant(counts: dict[str, tuple[int, int]], rate: float, fdr: float = FDR, total: int | None = None) -> tuple[set[str], float]:
    """The names of ``counts`` (toxic and clean documents) that pass Benjamini and Hochberg's procedure, and the largest log tail among them.

    Names in under ``MIN_DOCS`` documents of either kind take no part: hardly any could pass, and leaving them out by
    their total, which says nothing of their share of toxic documents, does not bias the others.
    """
    able = {name: log_tail(a, a + b, rate, total) for name, (a, b) in counts.items() if a + b >= MIN_DOCS}
    cut = cut_of(((p, 1) for p in able.values()), fdr)
    return {name for name, p in able.items() if p <= cut}, cut


def kinds(tokens: Iterable[str]) -> tuple[set[str], set[str]]:
    """The words among lower-case tokens, and the tokens that may be disguised words."""
    plain, hidden = set(), set()
    for token in tokens:
        bare = token.strip(EDGE)
        if bare.isalpha():
            plain.add(bare)
        elif len(token) <= CONTEXT and not any(c.isspace() for c in token):
            hidden.add(token)
    return plain, hidden


def digest(plain: set[str], hidden: set[str]) -> int:
    """What copies of one text agree in, as a signed 64-bit number."""
    return int(np.uint64(xxhash.xxh64_intdigest("\n".join([*sorted(plain), *("?" + t for t in sorted(hidden))]))).astype(np.int64))


_SEEDS = tk.mix(np.arange(1, 2 * BANDS + 1, dtype=np.uint64))


def bands(tokens: list[str]) -> list[int]:
    """A text's pairs of least hashes: of ``BANDS`` pairs of permutations, over the shingles of its tokens in order."""
    if not tokens:
        return []
    shingles = {" ".join(tokens[i : i + SHINGLE]) for i in range(max(len(tokens) - SHINGLE + 1, 1))}
    hashes = np.fromiter((xxhash.xxh64_intdigest(x) for x in shingles), dtype=np.uint64, count=len(shingles))
    least = np.array([tk.mix(hashes ^ seed).min() for seed in _SEEDS], dtype=np.uint64)
    return tk.mix(tk.mix(least[:BANDS] ^ _SEEDS[:BANDS]) ^ least[BANDS:]).astype(np.int64).tolist()


def features(words: Iterable[str]) -> list[str]:
    """The features of a text's distinct words: words (w), beginnings (p) and beginnings of two different words (m)."""
    begin = Counter(w[:k] for w in words for k in BEGINNINGS if len(w) >= k)
    return ["w:" + w for w in words] + ["p:" + b for b in begin] + ["m:" + b for b, n in begin.items() if n > 1]


def family(name: str) -> str:
    """What related features have in common; those of a word belong to the family of its own beginning."""
    return name[2 : 2 + BEGINNINGS[0]]


def related(words: Iterable[str], families: set[str] | dict) -> list[str]:
    """The features of the words that belong to ``families``."""
    return features([w for w in words if w[: BEGINNINGS[0]] in families])


def precision(toxic: int, clean: int, weight_clean: float = 1.0, weight_toxic: float = 1.0) -> float:
    return weight_toxic * toxic / (weight_toxic * toxic + weight_clean * (clean + 0.5))


def chosen(counts: dict[str, tuple[int, int]], held: Iterable[tuple[frozenset[str], int]], rate: float, total: int, cut: float, weights: tuple[float, float] = (1.0, 1.0)) -> dict[str, float]:
    """The features of one family that enter the lexicon, and their precisions: the most significant ones first, and of the others those
    that are still significant on the documents that these leave.  ``counts``: toxic and clean documents of the significant features;
    ``held``: which of them toxic documents hold, and how many documents."""
    lexicon: dict[str, float] = {}
    left, order = list(held), {"w": 0, "m": 1, "p": 2}
    for _, _, _, f in sorted((log_tail(a, a + b, rate, total), order[f[0]], -len(f), f) for f, (a, b) in counts.items()):
        precise = precision(*counts[f], *weights)
        hits = sum(n for own, n in left if f in own) if precise >= MIN_PRECISION else 0
        if hits and log_tail(hits, hits + counts[f][1], rate, total) <= cut:
            lexicon[f] = precise
            left = [x for x in left if f not in x[0]]
    return lexicon


def rate_of(toxic: int, clean: int) -> float:
    return min(max(toxic / max(toxic + clean, 1), 1e-6), 1 - 1e-6)


def model_of(lexicon: dict[str, float], grams: dict[str, int], missed: float, quiet: float) -> Model:
    """``missed``, ``quiet``: toxic and clean documents without a feature of the lexicon."""
    return Model(tuple(sorted(lexicon.items())), tuple(sorted(grams.items())), min((missed + 0.1) / (missed + quiet + 1.0), 0.25))


def undisguised(token: str, chars: CharModel) -> str:
    return restored(_LONG_RUN.sub(r"\1\1\1", token), chars)[1]


def learned(rows: Iterable[tuple[list[str], int]], weight_clean: float, weight_toxic: float) -> Model:
    """The model of (lower-case tokens in order, label) rows in memory, each standing for so many rows of its class; with weights of 1, what
    ``fit`` learns from the same documents."""
    docs: dict[int, dict[int, tuple[set[str], set[str], list[int]]]] = {0: {}, 1: {}}  # by digest, so that copies of one text count once
    spread: Counter[str] = Counter()
    for tokens, label in rows:
        plain, hidden = kinds(tokens)
        spread.update(plain)
        docs[label].setdefault(digest(plain, hidden), (plain, hidden, bands(tokens) if label else []))
    first: dict[int, tuple[int, int]] = {}
    for key, (plain, hidden, own) in docs[1].items():
        for band in own:
            first[band] = min(first.get(band, (1, 0)), (-len(plain) - len(hidden), key))
    for key in [k for k, (_, _, own) in docs[1].items() if any(first[band][1] != k for band in own)]:
        del docs[1][key]
    # a disguised token restores to one training word only if both are the same when squeezed
    grams, looks = grams_of(spread), {squeezed(w) for w in spread if len(w) > 3}
    chars = CharModel(grams)
    meant = {t: undisguised(t, chars) for t in {t for own in docs.values() for _, hidden, _ in own.values() for t in hidden} if squeezed(t) in looks}
    toxic, clean = ([{w for w in plain | {meant[t] for t in hidden if meant.get(t) in spread} if len(w) > 1} for plain, hidden, _ in docs[c].values()] for c in (1, 0))
    in_toxic, in_clean = (Counter(f for own in side for f in features(own)) for side in (toxic, clean))
    rate, total = rate_of(len(toxic), len(clean)), len(toxic) + len(clean)
    passed, cut = significant({f: (n, in_clean[f]) for f, n in in_toxic.items()}, rate, total=total)
    lexicon: dict[str, float] = {}
    for group in sorted({family(f) for f in passed}):
        counts = {f: (in_toxic[f], in_clean[f]) for f in passed if family(f) == group}
        lexicon |= chosen(counts, [(frozenset(related(own, {group})), 1) for own in toxic], rate, total, cut, (weight_clean, weight_toxic))
    missed, quiet = (sum(1 for own in side if lexicon.keys().isdisjoint(features(own))) for side in (toxic, clean))
    return model_of(lexicon, grams, weight_toxic * missed, weight_clean * quiet)


def _tallies(names: Iterable[Iterable[str]]) -> Iterator[Counter[str]]:
    """Counts of names, handed on whenever they are over ``PARTIAL``."""
    counts: Counter[str] = Counter()
    for some in names:
        counts.update(some)
        if len(counts) > PARTIAL:
            yield counts
            counts = Counter()
    if counts:
        yield counts


def _batch(schema: str, *columns: list) -> pa.RecordBatch:
    """A batch of the columns of a schema as Spark writes it (long, int, double and string, and arrays of long)."""
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _mapped(df: DataFrame, schema: str, run: Callable[[Iterator[tuple]], Iterator[tuple[list, ...]]]) -> DataFrame:
    """``df`` through a function from its rows, one after another, to columns of ``schema``."""

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS))
        rows = (row for part in parts for row in zip(*(c.to_pylist() for c in part.columns), strict=True))
        for columns in run(rows):
            yield _batch(schema, *columns)
        gc.collect()
        tk.release()

    return df.mapInArrow(batched, schema)


def read(texts: DataFrame) -> DataFrame:
    """Of ``texts(doc_id, toxic, text)`` what is learned from: words and possibly disguised tokens, a line each, and what tells copies."""
    schema = "doc_id long, toxic int, hash long, digest long, size int, bands array<long>, plain string, hidden string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch):
                out: list[tuple] = []
                for toxic, text in zip(part.column(1).to_pylist(), part.column(3).to_pylist(), strict=True):
                    tokens = (text or "").lower().split()
                    plain, hidden = kinds(set(tokens))
                    out.append((digest(plain, hidden), len(plain) + len(hidden), bands(tokens) if toxic else [], "\n".join(sorted(plain)), "\n".join(sorted(hidden))))
                yield _batch(schema, *(part.column(i) for i in range(3)), *map(list, zip(*out, strict=True)))

    return texts.select("doc_id", "toxic", F.xxhash64("text").alias("hash"), "text").mapInArrow(run, schema)


def later(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """``row`` of the rows that are not the first of their key."""
    firsts = rows.groupBy(key).agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1").select(key, "first")
    return rows.join(small(firsts), key).filter(order != F.col("first")).select("row")


def _strings(*columns: str) -> Column:
    """Bytes of a row of strings, about."""
    return sum((F.octet_length(c) for c in columns), F.lit(16)).cast("long")


def _texts(rows: Iterable[tuple[int, str, str | None]]) -> Iterator[tuple[int, set[str]]]:
    """(label, distinct words of two letters or more, restored ones too) of (label, words, restored words) rows."""
    for toxic, plain, extra in rows:
        yield toxic, {w for w in (plain + "\n" + extra if extra else plain).split("\n") if len(w) > 1}


def words_of(rows: DataFrame) -> DataFrame:
    """(word, n, key) of ``rows(plain)``: the number of rows, and how words of over three letters read when squeezed."""
    counted = _mapped(rows.select("plain"), "word string, n long", lambda own: ((list(c), list(c.values())) for c in _tallies(plain.split("\n") for (plain,) in own if plain)))
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield _batch("word string, n long, key string", batch.column(0), batch.column(1), [squeezed(w) if len(w) > 3 else None for w in words])

    return total.mapInArrow(keyed, "word string, n long, key string")


def grams_in(words: DataFrame) -> dict[str, int]:
    """The counts of the character model, of all words."""

    def run(rows: Iterator[tuple[str, int]]) -> Iterator[tuple[list, ...]]:
        for counts in _tallies(grams_of(Counter({word: n})) for word, n in rows):
            yield list(counts), list(counts.values())

    found = _mapped(words.select("word", "n"), "gram string, n long", run).groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(found.column("gram").to_pylist(), found.column("n").to_pylist(), strict=True))


def undisguised_words(seen: DataFrame, words: DataFrame, grams: dict[str, int]) -> DataFrame:
    """(row, extra): the training words, a line each, that the tokens of ``seen(row, token)`` restore to.

    A token restores to a training word only if both are the same when squeezed.
    """

    def keyed(rows: Iterator[tuple[str]]) -> Iterator[tuple[list, ...]]:
        for counts in _tallies(rows):
            yield list(counts), [squeezed(t) for t in counts]

    def decoded(rows: Iterator[tuple[str]]) -> Iterator[tuple[list, ...]]:
        chars = None
        for counts in _tallies(rows):
            chars = chars or CharModel(grams)
            yield list(counts), [undisguised(t, chars) for t in counts]

    alike = _mapped(seen.select("token").distinct(), "token string, key string", keyed).join(words.select("key"), "key", "left_semi")
    meant = _mapped(alike.select("token"), "token string, word string", decoded).filter("char_length(word) > 1").join(words.select("word"), "word", "left_semi")
    meant = checkpointed(meant.select("token", "word"), narrow=True)
    return seen.join(small(meant, size=_strings("token", "word")), "token").groupBy("row").agg(F.concat_ws("\n", F.sort_array(F.collect_set("word"))).alias("extra"))


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, n_toxic, n_clean) of ``rows(toxic, plain, extra)``: those of toxic rows that are in ``MIN_DOCS`` rows or more."""

    def run(own: Iterator[tuple]) -> Iterator[tuple[list, ...]]:
        for counts in _tallies(zip(features(words), repeat(toxic)) for toxic, words in _texts(own)):
            names, labels = zip(*counts, strict=True)
            yield list(names), [n if t else 0 for t, n in zip(labels, counts.values(), strict=True)], [0 if t else n for t, n in zip(labels, counts.values(), strict=True)]

    parts = _mapped(rows.select("toxic", "plain", "extra"), "feature string, n_toxic long, n_clean long", run)
    total = parts.groupBy("feature").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    return total.filter((F.col("n_toxic") > 0) & (F.col("n_toxic") + F.col("n_clean") >= MIN_DOCS))


def lexicon_of(rows: DataFrame, counts: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """The lexicon from ``rows(toxic, plain, extra)``, so many of each label, and the counts of their features."""
    rate, total = rate_of(n_toxic, n_clean), n_toxic + n_clean
    hopeful = counts.filter(F.col("n_toxic") > (F.col("n_toxic") + F.col("n_clean")) * rate)
    pairs = [(r["n_toxic"], r["n_clean"], r["count"]) for r in hopeful.groupBy("n_toxic", "n_clean").count().collect()]
    tails = {(a, b): log_tail(a, a + b, rate, total) for a, b, _ in pairs}
    others = counts.count() - sum(n for _, _, n in pairs)
    cut = cut_of([*((tails[a, b], n) for a, b, n in pairs), *([(0.0, others)] if others else [])])
    passing = [p for p, tail in tails.items() if tail <= cut]
    if not passing:
        return {}
    own = hopeful.join(F.broadcast(counts.sparkSession.createDataFrame(passing, "n_toxic long, n_clean long")), ["n_toxic", "n_clean"]).collect()
    groups: dict[str, dict[str, tuple[int, int]]] = {}
    for r in own:
        groups.setdefault(family(r["feature"]), {})[r["feature"]] = (r["n_toxic"], r["n_clean"])

    def held(rows: Iterator[tuple]) -> Iterator[tuple[list, ...]]:
        def sets(words: set[str]) -> Iterator[tuple[str, str]]:
            by: dict[str, list[str]] = {}
            for f in related(words, groups):
                if f in groups[family(f)]:
                    by.setdefault(family(f), []).append(f)
            return ((group, "\n".join(sorted(found))) for group, found in by.items())

        for tally in _tallies(sets(words) for _, words in _texts(rows)):
            yield [g for g, _ in tally], [x for _, x in tally], list(tally.values())

    def choose(table: pa.Table) -> pa.Table:
        sets = [(frozenset(x.split("\n")), n) for x, n in zip(table.column("held").to_pylist(), table.column("n").to_pylist(), strict=True)]
        found = chosen(groups[table.column("family")[0].as_py()], sets, rate, total, cut)
        return pa.table({"feature": pa.array(list(found), pa.string()), "weight": pa.array(list(found.values()), pa.float64())})

    sets = _mapped(rows.filter("toxic = 1").select("toxic", "plain", "extra"), "family string, held string, n long", held).groupBy("family", "held").agg(F.sum("n").alias("n"))
    return {r["feature"]: r["weight"] for r in sets.groupBy("family").applyInArrow(choose, "feature string, weight double").collect()}


def without(rows: DataFrame, lexicon: dict[str, float]) -> dict[int, int]:
    """Of each label how many of ``rows(toxic, plain, extra)`` have no feature of the lexicon."""
    families = {family(f) for f in lexicon}

    def run(own: Iterator[tuple]) -> Iterator[tuple[list, ...]]:
        n = Counter(toxic for toxic, words in _texts(own) if lexicon.keys().isdisjoint(related(words, families)))
        yield list(n), list(n.values())

    return {r["toxic"]: r["n"] for r in _mapped(rows.select("toxic", "plain", "extra"), "toxic int, n long", run).groupBy("toxic").agg(F.sum("n").alias("n")).collect()}


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from all ``labels(doc_id, toxic)`` of ids whose crc32 modulo 4 is not 2, and the whole texts of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    ship(spark)
    ids = labels.filter("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.filter(crc_mod(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(crc_mod(F.col("doc_id"), 4) != 2)
    paths: list[str] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        out, path = staged(df, f"toxicity-{name}")
        paths.append(path)
        return out

    try:
        every = kept(read(texts.join(small(ids), "doc_id")).withColumn("row", F.monotonically_increasing_id()), "texts")
        repeats = checkpointed(later(every, "doc_id", F.struct("hash", "row")), narrow=True)
        one = every.join(small(repeats), "row", "left_anti")
        copies = checkpointed(later(one.withColumn("text_key", F.struct("toxic", "digest")), "text_key", F.struct("hash", "doc_id")), narrow=True)
        unlike = one.join(small(copies), "row", "left_anti")
        near = checkpointed(later(unlike.filter("toxic = 1").select("row", F.explode("bands").alias("band"), (-F.col("size")).alias("least"), "digest"), "band", F.struct("least", "digest")).distinct(), narrow=True)
        words = kept(words_of(one), "words")
        grams = grams_in(words)
        seen = one.filter("hidden <> ''").select("row", F.explode(F.split("hidden", "\n")).alias("token"))
        extra = checkpointed(undisguised_words(seen, words, grams), narrow=True)
        rows = unlike.join(small(near), "row", "left_anti").join(small(extra, size=_strings("extra")), "row", "left").select("toxic", "plain", "extra")
        sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        lexicon = lexicon_of(rows, kept(feature_counts(rows), "features"), sizes.get(1, 0), sizes.get(0, 0))
        left = without(rows, lexicon)
    finally:
        for path in paths:
            forgotten(spark, path)
    return model_of(lexicon, grams, left.get(1, 0), left.get(0, 0))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", held_out.alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with scorer(model) as own:
            for part in (part for batch in batches for part in tk.slices(batch)):
                scores = [own.score(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, training_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns unchanged."""
    ship(docs.sparkSession)
    model, at = fit(training_docs, labels), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with scorer(model) as own:
            for part in (part for batch in batches for part in tk.slices(batch)):
                yield part.filter(pa.array([own.score(t) < THRESHOLD for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
