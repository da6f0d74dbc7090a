"""Line deduplication by overlapping windows of three lines, with DataFrame functions only.

A text is split at newlines; blank lines take no part.  Each run of three consecutive lines is a window; a run of one or
two lines is a window too if it has over ``long_words`` words, so that a long passage is seen on however few lines it
stands.  Windows are compared by 128 bits of hash over the trimmed lines.  The first occurrence of a window in (doc_id,
nulls last; text hash; position) order stays; the lines covered by any later occurrence are removed, overlapping
covers being merged first.

Defined results: null texts stay null, texts without a repeated window stay byte for byte as they are; rows that
agree in ``doc_id`` and ``text`` are one document and get one result; other columns are carried and may have any name.

Plan: windows are reduced to (hash, first, count) with partial aggregation, so a window that a third of all
documents share costs one row a task.  Only windows seen twice are joined back, and AQE can split that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

WIDTH, LONG_WORDS = 3, 50


def _keys(doc_id: Column, text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), doc_id, text), F.xxhash64(text, doc_id, F.lit(2))]


def windows(docs: DataFrame, width: int = WIDTH, long_words: int = LONG_WORDS) -> DataFrame:
    """(k1, k2, doc_id, lo, hi, h1, h2): the windows of each document, lo and hi being line positions."""
    trimmed = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("pos"), F.btrim(x, F.lit(" \t\r\x0b\x0c")).alias("line")))
    n_words = lambda s: F.size(F.filter(F.split(s.line, " "), lambda w: w != ""))
    counted = F.transform(F.filter(trimmed, lambda s: s.line != ""), lambda s: F.struct(s.pos.alias("pos"), s.line.alias("line"), n_words(s).alias("n")))
    lines = docs.select(*(k.alias(n) for k, n in zip(_keys(F.col("doc_id"), F.col("text")), ("k1", "k2"), strict=True)), "doc_id", counted.alias("lines"))
    at = lambda i, k: F.get(F.col("lines"), i + F.lit(k))
    none = F.array().cast("array<struct<lo:int,hi:int,h1:bigint,h2:bigint>>")

    def runs(n: int) -> Column:
        start = F.sequence(F.lit(0), F.size("lines") - n)
        if n < width:
            start = F.filter(start, lambda i: sum((at(i, k).n for k in range(1, n)), at(i, 0).n) > long_words)
        run = lambda i, seed: F.xxhash64(F.lit(seed + 2 * n), *(at(i, k).line for k in range(n)))
        return F.when(F.size("lines") >= n, F.transform(start, lambda i: F.struct(at(i, 0).pos.alias("lo"), at(i, n - 1).pos.alias("hi"), run(i, 3).alias("h1"), run(i, 4).alias("h2")))).otherwise(none)

    return lines.select("k1", "k2", "doc_id", F.inline(F.concat(*(runs(n) for n in range(width, 0, -1)))))


def covered(docs: DataFrame, width: int = WIDTH, long_words: int = LONG_WORDS) -> DataFrame:
    """(k1, k2, cut): the sorted line positions that each document loses."""
    all_windows = windows(docs, width, long_words)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2", "lo")
    repeated = all_windows.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1").select("h1", "h2", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2"), F.col("first.lo").alias("flo"))
    later = all_windows.select("k1", "k2", "lo", "hi", "h1", "h2").join(repeated, ["h1", "h2"]).filter("not (k1 = f1 and k2 = f2 and lo = flo)")
    spans = later.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return spans.select("k1", "k2", F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s.lo, s.hi))))).alias("cut"))


def deduplicated(docs: DataFrame, width: int = WIDTH, long_words: int = LONG_WORDS, counts: tuple[str, str] | None = None, least_left: float | None = None) -> DataFrame:
    """``docs`` with the later occurrences cut out of ``text``; ``counts`` names added columns (lines, lines removed).

    With ``least_left``, a text goes if it lost lines and under that share of its characters (or nothing but blanks) is left.
    """
    k1, k2, cut = (fresh(docs, x) for x in ("key_1", "key_2", "cut_lines"))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gone = covered(plain, width, long_words).toDF(k1, k2, cut)
    keys = _keys(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    joined = docs.withColumn(k1, keys[0]).withColumn(k2, keys[1]).join(gone, [k1, k2], "left")
    lines = F.split(F.col("text").cast("string"), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(cut))
    text = F.when(F.col(cut).isNull(), F.col("text").cast("string")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    out = [text.alias("text") if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        total = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
        out += [total.cast("long").alias(counts[0]), F.coalesce(F.size(F.col(cut)), F.lit(0)).cast("long").alias(counts[1])]
    if least_left is not None:
        rest = F.length(F.btrim(text, F.lit(" \t\r\n\x0b\x0c")))
        joined = joined.filter(F.col(cut).isNull() | ((rest > 0) & (rest >= F.length(F.col("text").cast("string")) * least_left)))
    return joined.select(out)
