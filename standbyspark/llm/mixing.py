"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

The rows of each source, in hashed order, form blocks of ``block_rows``.  With an integer weight n out of a period
of P slots, block k of a source is released at slot floor(k P / n) and due by slot ceil((k + 1) P / n).  At each
slot, earliest deadline first picks among the released blocks.  The weights add up to P, so every block meets its
window: after t slots a source has had t n / P blocks, give or take less than one.  The schedule repeats every
period, so it is worked out once for P slots, by a fold on one row, and block k takes slot
``P (k div n) + slot of block (k mod n)``.  Sources that run out leave their slots empty; positions close the gaps.

Rows are ranked inside a source in two steps: by buckets of the hash, whose counts give offsets, and inside each
bucket, so a source with a third of all rows is spread over many tasks.

Defined results: every row is kept, once; sources without a weight of their own and null sources share the weight
of ``other``; rows with one doc_id are ordered among themselves arbitrarily; an empty table gives an empty result;
added columns are named by the caller so that they cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, checkpointed, fresh

MAX_PERIOD = 20_000  #: slots of one period, weights having been divided by what they have in common; more is refused, as the schedule is made on one row
BLOCK_ROWS = 16

#: Production weights in parts of 100: the largest source is held to a tenth, the other sources share alike.
WEIGHTS = {"src0": 10, **{f"src{i}": 4 for i in range(1, 20)}}
OTHER = 14


def period_of(weights: dict[str, int], other: int) -> int:
    if other < 1 or any(w < 1 for w in weights.values()):
        raise ValueError("weights are whole numbers of at least 1")
    total = (sum(weights.values()) + other) // math.gcd(other, *weights.values())
    if total > MAX_PERIOD:
        raise ValueError(f"weights add up to {total}; at most {MAX_PERIOD} slots are scheduled")
    return total


def schedule(spark: SparkSession, weights: list[int]) -> DataFrame:
    """(slot, grp, nth, before): which group's nth block of the period has the slot, and the blocks of each group before it."""
    period, n = sum(weights), ",".join(map(str, weights))
    due = f"""array_min(transform(filter(sequence(0, {len(weights) - 1}),
        g -> get(s.done, g) < get(n, g) and get(s.done, g) * {period} div get(n, g) <= t),
        g -> struct((((get(s.done, g) + 1) * {period} + get(n, g) - 1) div get(n, g)) as deadline, g as grp))).grp"""
    fold = f"""aggregate(sequence(0, {period - 1}), struct(transform(n, x -> 0) as done, cast(array() as array<int>) as picks),
        (s, t) -> transform(array({due}), p -> struct(transform(s.done, (x, g) -> x + if(g = p, 1, 0)) as done, array_append(s.picks, p) as picks))[0]).picks"""
    picks = spark.sql(f"select {fold} as picks from (select array({n}) as n)")
    slots = picks.select("picks", F.posexplode("picks").alias("slot", "grp"))
    earlier = F.slice("picks", F.lit(1), F.col("slot"))
    before = F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), lambda g: F.size(F.filter(earlier, lambda x: x == g)).cast("long"))
    return slots.select("slot", "grp", before.alias("before")).withColumn("nth", F.get("before", F.col("grp"))).select("slot", "grp", "nth", "before")


def mixed(docs: DataFrame, weights: dict[str, int], other: int, block_rows: int = BLOCK_ROWS, seed: int = 7) -> DataFrame:
    """``docs`` plus mix_group, mix_block, mix_release, mix_deadline, mix_slot and mix_pos (order by it to read the mix).

    An added name that ``docs`` has already gets underscores at its end.
    """
    spark, period, names = docs.sparkSession, period_of(weights, other), sorted(weights)
    common = math.gcd(other, *weights.values())
    parts = [weights[x] // common for x in names] + [other // common]
    group_of = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for i, name in enumerate(names) for x in (name, i))), F.col("source").cast("string")) if names else F.lit(None).cast("int"), F.lit(len(names)))
    grp, bucket, order, rank = (fresh(docs, x) for x in ("mix_grp", "mix_bucket", "mix_order", "mix_rank"))
    added = [fresh(docs, x) for x in ("mix_group", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_pos")]
    buckets = max(1, math.isqrt(docs.select("source").count()))
    placed = docs.withColumn(grp, group_of).withColumn(order, F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    lead = F.conv(F.substring(order, 1, 8), 16, 10).cast("long")
    placed = placed.withColumn(bucket, F.shiftright(lead * F.lit(buckets), 32).cast("int"))
    counts = checkpointed(placed.groupBy(grp, bucket).agg(F.count("*").alias("n")))
    totals = {r[grp]: r["n"] for r in counts.groupBy(grp).agg(F.sum("n").alias("n")).collect()}
    ahead = Window.partitionBy(grp).orderBy(bucket)
    start = fresh(docs, "mix_start")
    offsets = counts.select(grp, bucket, (F.sum("n").over(ahead) - F.col("n")).alias(start))
    within = F.row_number().over(Window.partitionBy(grp, bucket).orderBy(order, F.col("doc_id").cast("long")))
    ranked = placed.withColumn(rank, within.cast("long") - 1).join(offsets, [grp, bucket]).withColumn(rank, F.col(rank) + F.col(start))
    n_of = F.get(F.array(*(F.lit(x).cast("long") for x in parts)), F.col(grp))
    block, nth, cycle = fresh(docs, "mix_k"), fresh(docs, "mix_nth"), fresh(docs, "mix_cycle")
    ranked = ranked.withColumn(block, F.expr(f"`{rank}` div {block_rows}")).withColumn(nth, F.col(block) % n_of).withColumn(cycle, F.floor(F.col(block) / n_of))
    plan = schedule(spark, parts).select(F.col("grp").alias(grp), F.col("nth").cast("long").alias(nth), F.col("slot").alias("slot_"), F.col("before").alias("before_"))
    slot_, before_ = fresh(docs, "mix_slot_in"), fresh(docs, "mix_before")
    plan = plan.toDF(grp, nth, slot_, before_)
    timed = ranked.join(F.broadcast(plan) if period * len(parts) * 8 <= BROADCAST_BYTES else plan, [grp, nth])
    have = F.array(*(F.struct(F.lit(p).cast("long").alias("n"), F.lit(totals.get(i, 0)).cast("long").alias("rows")) for i, p in enumerate(parts)))
    rows_before = F.aggregate(F.zip_with(have, F.col(before_), lambda h, b: F.least(h.rows, (F.col(cycle) * h.n + b) * block_rows)), F.lit(0).cast("long"), lambda a, x: a + x)
    label = F.get(F.array(*(F.lit(x) for x in names), F.lit("other")), F.col(grp))
    values = [label, F.col(block), F.floor(F.col(block) * period / n_of), F.ceil((F.col(block) + 1) * period / n_of), F.col(cycle) * period + F.col(slot_), rows_before + F.col(rank) % block_rows]
    return timed.select(*(F.col(f"`{c}`") for c in docs.columns), *(v.alias(a) for v, a in zip(values, added, strict=True)))
