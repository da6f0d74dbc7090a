"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

Tokens are lower-cased runs of characters other than blanks and punctuation.  A mask keeps some of consecutive token positions and ignores the others, so a seed still agrees when a token
at an ignored position was substituted.  However the substitutions fall that the comparison accepts, some mask at
some shift inside the window keeps none of them; tests enumerate all of them.
Seed hashes of all documents are joined with those of the benchmark; each agreement fixes a diagonal (document
position minus item position), on which the aligned tokens are compared: a pair counts if some window of
``WINDOW`` aligned tokens (the whole item, if shorter) agrees in at least ``SHARE`` percent of them.

Short sides have no spaced seeds and are compared exactly: an item of ``LEAST`` to ``SPAN`` - 1 tokens matches wherever all
its tokens stand one after another, a document of ``LEAST`` to ``WINDOW`` - 1 tokens if it stands as a whole in a longer item,
and shorter ones only if document and item are equal.

Plan: a bitset of ``BITS`` bits over the benchmark's seeds reaches every task as a scalar subquery, at every size of the
benchmark, another marks the pairs of tokens that they begin with; seeds of documents are made only at marked pairs, and
those that are marked themselves are spread into rows and joined exactly.

Defined results: null texts and texts without tokens never match; null ids are carried; rows that agree in ``doc_id`` and
``text`` are one document; other columns are ignored or carried whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fresh, small

#: Kept positions of each mask: every 13 aligned tokens of which 10 agree have a seed.
MASKS = ((0, 2, 6, 7, 8), (0, 1, 2, 4, 5), (0, 1, 2, 5, 8))
#: Used too if there are items of 10 to 12 tokens, for which the others leave a few cases out.
SHORT_MASK = (0, 2, 3, 4)
PAIR = 2  #: every mask keeps positions 0 and PAIR, so only places whose pair the benchmark has need a look
SPAN, WINDOW, SHARE = 10, 13, 75
LEAST = 5  #: tokens of a passage that is compared at all inside something longer
BITS = 1 << 23
PUNCTUATION = ".,;:!?\"'()[]{}<>*#%&$|…«»“”‘’"
_BETWEEN = "[ \\n\\t\\r\\x0b\\x0c" + PUNCTUATION.replace("[", r"\[").replace("]", r"\]").replace("&", r"\&") + "]+"


def pieces(text: Column) -> Column:
    """Lower-cased runs of characters other than blanks and punctuation."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _run(t: Column, size: Column | int, salt: int = 9) -> Column:
    """(pos, h) of all runs of ``size`` tokens, each hashed with its size."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.transform(F.sequence(F.lit(0), F.size(t) - size), lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(salt), size, F.slice(t, i + 1, size)).alias("h")))


def _pair(t: Column, i: Column) -> Column:
    """The two positions that every mask keeps."""
    return F.xxhash64(F.lit(7), F.get(t, i), F.get(t, i + PAIR))


def _pairs(t: Column) -> Column:
    """Places at which a seed may begin."""
    least = min(mask[-1] for mask in (*MASKS, SHORT_MASK)) + 1
    return F.when(F.size(t) >= SPAN, F.sequence(F.lit(0), F.size(t) - least)).otherwise(F.array().cast("array<int>"))


def _seeds(t: Column, at: Column, masks: tuple[tuple[int, ...], ...]) -> Column:
    """(pos, h) of the seeds of all masks that begin at the places ``at``."""

    def seeds_of(mask: tuple[int, ...], salt: int) -> Column:
        inside = F.filter(at, lambda i: i < F.size(t) - mask[-1])
        return F.transform(inside, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(salt), *(F.get(t, i + k) for k in mask)).alias("h")))

    return F.concat(*(seeds_of(mask, salt) for salt, mask in enumerate(masks)))


def _runs(t: Column, lengths: tuple[int, ...]) -> list[Column]:
    """(pos, h) of the runs of each of the given lengths."""
    none = F.array().cast("array<struct<pos:int,h:bigint>>")
    return [F.when(F.size(t) >= n, _run(t, n)).otherwise(none) for n in lengths]


def _whole(t: Column) -> Column:
    """The one run of a short text as a whole, among those of its own kind."""
    none = F.array().cast("array<struct<pos:int,h:bigint>>")
    return F.when(F.size(t).between(1, WINDOW - 1), _run(t, F.size(t), 8)).otherwise(none)


def _inner_runs(t: Column) -> Column:
    """Runs of an item that a short document may be as a whole."""
    none = F.array().cast("array<struct<pos:int,h:bigint>>")
    sizes = [F.when(F.size(t) >= n, _run(t, n, 8)).otherwise(none) for n in range(LEAST, WINDOW)]
    return F.concat(*sizes, F.when(F.size(t).between(1, LEAST - 1), _run(t, F.size(t), 8)).otherwise(none))


def _places(h: Column) -> list[Column]:
    return [F.pmod(h, F.lit(BITS)), F.pmod(F.shiftright(h, 31), F.lit(BITS))]


def _bitset(seeds: DataFrame) -> Column:
    """A scalar subquery: 64-bit words of a set of ``BITS`` bits in which the ``h`` of ``seeds`` are marked, each at two places."""
    places = seeds.select(F.explode(F.array(*_places(F.col("h")))).alias("place"))
    marked = places.select(F.expr("place div 64").alias("word"), F.expr("shiftleft(1L, cast(place % 64 as int))").alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = seeds.sparkSession.range(BITS // 64).withColumnRenamed("id", "word").join(marked, "word", "left")
    return words.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).cast("long").alias("bits")))).alias("all")).select(F.col("all.bits")).scalar()


def _marked(h: Column, marks: Column) -> Column:
    first, second = (F.getbit(F.get(marks, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int")) != 0 for p in _places(h))
    return first & second


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, item_id, doc_pos, n_aligned, n_equal) for each contaminated pair, the best diagonal of each."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = docs.select(F.xxhash64(F.lit(1), "doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id", F.lit(2)).alias("k2"), "doc_id", "text")
    # a generator in between: the optimizer would else put the making of t into the lambdas, once for each token
    located = keyed.select("k1", "k2", F.explode(F.array(pieces(F.col("text")))).alias("t"))
    items = benchmark.select("item_id", F.xxhash64("item_id", "text").alias("item"), F.col("text").cast("string").alias("text")).dropDuplicates(["item"]).select("item_id", "item", F.explode(F.array(pieces(F.col("text")))).alias("t"))
    sizes = {r["n"] for r in items.select(F.size("t").alias("n")).filter(f"n < {WINDOW}").distinct().collect()}  # at most WINDOW values
    masks = (*MASKS, SHORT_MASK) if any(n >= SPAN for n in sizes) else MASKS
    lengths = tuple(sorted(n for n in sizes if LEAST <= n < SPAN))
    spread = lambda df, *keys: df.select(*keys, F.inline("seeds"))
    own_run = F.when(F.size("t").isin(list(lengths)), _run(F.col("t"), F.size("t"))).otherwise(F.array().cast("array<struct<pos:int,h:bigint>>"))
    item_seeds = F.concat(_seeds(F.col("t"), F.col("at"), masks), own_run, _inner_runs(F.col("t")))
    placed = items.select("item", "t", F.explode(F.array(_pairs(F.col("t")))).alias("at"))
    seeds = checkpointed(spread(placed.withColumn("seeds", item_seeds), "item").withColumnRenamed("pos", "item_pos").distinct(), narrow=True)
    pairs = placed.select(F.explode(F.transform("at", lambda i: _pair(F.col("t"), i))).alias("h"))
    own = located.select("k1", "k2", "t", _bitset(pairs).alias("pair_marks"))
    own = own.select("k1", "k2", "t", F.explode(F.array(F.filter(_pairs(F.col("t")), lambda i: _marked(_pair(F.col("t"), i), F.col("pair_marks"))))).alias("at"))
    if not lengths:  # longer documents match by spaced seeds only
        own = own.filter((F.size("at") > 0) | (F.size("t") < WINDOW))
    own = own.select("k1", "k2", "t", "at", _bitset(seeds).alias("marks"))
    rows = own.select("k1", "k2", F.inline(F.filter(F.concat(_seeds(F.col("t"), F.col("at"), masks), *_runs(F.col("t"), lengths), _whole(F.col("t"))), lambda s: _marked(s.h, F.col("marks")))))
    hits = checkpointed(rows.join(small(seeds), "h").select("k1", "k2", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct(), narrow=True)
    found = keyed.join(small(hits.select("k1", "k2").distinct()), ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("k1", "k2", "doc_id", F.explode(F.array(pieces(F.col("text")))).alias("d"))
    lo, hi = F.greatest(F.lit(0), -F.col("shift")), F.least(F.size("b"), F.size("d") - F.col("shift")) - 1
    item_tokens = items.select("item", "item_id", F.col("t").alias("b"))
    pairs = hits.join(found, ["k1", "k2"]).join(small(item_tokens, size=F.aggregate("b", F.lit(64).cast("long"), lambda a, x: a + F.octet_length(x) + 16)), "item")
    aligned = pairs.select("k1", "k2", "doc_id", "item", "item_id", "shift", "b", F.size("d").alias("n_doc"), lo.alias("lo"), hi.alias("hi"), F.slice("d", lo + F.col("shift") + 1, F.greatest(F.lit(0), hi - lo + 1)).alias("own")).filter("hi >= lo")
    equal = F.zip_with("own", F.slice("b", F.col("lo") + 1, F.size("own")), lambda x, y: (x == y).cast("int"))
    compared = aligned.select("k1", "k2", "doc_id", "item", "item_id", "n_doc", (F.col("lo") + F.col("shift")).alias("at"), F.size("b").alias("n_item"), F.explode(F.array(equal)).alias("eq"))
    width = F.least(F.lit(WINDOW), F.size("eq"))
    count = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + x)
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.size("eq") - width), lambda i: count(F.slice("eq", i + 1, width))))
    figures = F.struct(width.alias("width"), best.alias("best"), F.size("eq").alias("n_aligned"), count(F.col("eq")).alias("n_equal"))
    scored = compared.select("k1", "k2", "doc_id", "item", "item_id", "n_doc", "n_item", "at", F.inline(F.array(figures)))
    whole_item, whole_doc = F.col("width") == F.col("n_item"), F.col("width") == F.col("n_doc")
    near = (F.col("width") >= F.least(F.lit(WINDOW), F.col("n_item"))) & (F.col("width") >= SPAN) & (F.col("best") * 100 >= F.col("width") * SHARE)
    exact = (F.col("best") == F.col("width")) & (((F.col("width") >= LEAST) & (whole_item | whole_doc)) | (whole_item & whole_doc))
    good = scored.filter(near | exact)
    ranked = F.struct("n_equal", "n_aligned", (-F.col("at")).alias("at"))
    one = good.groupBy("k1", "k2", "item").agg(F.first("doc_id").alias("doc_id"), F.first("item_id").alias("item_id"), F.max(ranked).alias("m"))
    return one.select("k1", "k2", "doc_id", "item_id", (-F.col("m.at")).cast("long").alias("doc_pos"), F.col("m.n_aligned").cast("long").alias("n_aligned"), F.col("m.n_equal").cast("long").alias("n_equal"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a contaminated pair, all columns unchanged."""
    k1, k2 = fresh(docs, "key_1"), fresh(docs, "key_2")
    bad = checkpointed(matches(docs, benchmark).select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct(), narrow=True)
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    keyed = docs.withColumn(k1, F.xxhash64(F.lit(1), doc_id, text)).withColumn(k2, F.xxhash64(text, doc_id, F.lit(2)))
    return keyed.join(small(bad), [k1, k2], "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
