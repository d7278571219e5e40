"""Mixing sources to target weights by entropy balancing.

Of all document rates r_d that meet a source's token constraint sum(r_d * size_d) =
target, entropy balancing takes the ones nearest to one copy each in relative entropy:
the exponential tilt r_d = exp(l * size_d / mean), held to at most ``most`` copies. The
multiplier l solves the convex dual, by Newton steps that fall back to bisection of a
bracket. A step is a distributed aggregation over (source, size) counts, which carry
all there is to know: a hot source adds up in partial sums.

Rates become copies by systematic rounding: within a source, documents in order of
size, a running sum of the rates' fractions gives a copy each time it passes a whole
number. Sums of sizes then stray by about the largest document at most. The place in
the order comes from counts of (source, size, salt) and a rank within such a cell, so
no task orders a whole source. What a source still lacks or has too much is then made
up for by one copy of the document whose size comes closest, twice over.

Sums are decimals and multipliers are rounded, so that reruns agree whatever the order
of partial sums. All steps are DataFrame operations.

Defined results: null and empty texts have size 0 and take nothing; a null source is a
source of its own, the last; sources without a word have target 0; rows that repeat
are documents of their own; an empty table gives an empty mix.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from talentlake.llm.common import SPACE, forget, row_key, written

EXACT = "decimal(38,6)"
SALTS = 64
SMALL = 100_000  # sources up to which a row for each is broadcast, after counting them


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, source, size) of every row."""
    n = F.size(F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), SPACE), ""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rid"), F.col("source").cast("string").alias("source"), n.cast("long").alias("size"))


def targets(sources: DataFrame, weights: list[float], most: float) -> DataFrame:
    """Adds ``target``: weights by order of the source, repeated, share all sizes; what
    goes beyond ``most`` times a source's size is shared again among the others. That
    ends at one level a unit of weight, found from the order in which sources fill.
    sources: a row each, with its ``source_size``."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    x = sources.withColumn("weight", weight).withColumn("room", F.col("source_size") * F.lit(float(most)))
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    fill = W.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    full = F.coalesce(F.sum("room").over(fill), F.lit(0.0))
    gone = F.coalesce(F.sum("weight").over(fill), F.lit(0.0))
    x = x.withColumn("level", (F.sum("source_size").over(every) - full) / (F.sum("weight").over(every) - gone))
    holds = F.max(F.when(F.col("room") / F.col("weight") >= F.col("level"), F.col("level"))).over(every)  # beyond the first such source levels only fall
    return x.withColumn("target", F.least("room", F.col("weight") * F.coalesce(holds, F.lit(float("inf"))))).drop("level", "room")


def tilt(most: float):
    """Rate of a document: the tilted one, at most ``most``; 0 where there is nothing to take."""
    return F.when(F.col("size") > 0, F.least(F.lit(float(most)), F.exp(F.try_divide(F.col("l") * F.col("size"), F.col("mean"))))).otherwise(F.lit(0.0))


def multipliers(counts: DataFrame, sources: DataFrame, most: float, tolerance: float = 1e-9, rounds: int = 60) -> DataFrame:
    """Adds ``l`` to sources: the root of the dual's gradient, by safeguarded Newton steps.
    counts: (source, size, n)."""
    cap = log(most) + 1e-9
    start = F.coalesce(F.greatest(F.lit(-30.0), F.least(F.lit(cap), F.log(F.try_divide(F.col("target"), F.col("source_size"))))), F.lit(0.0))
    # every rate is at the cap above, and the least positive size takes next to nothing below
    state = sources.withColumn("hi", F.when(F.col("least") > 0, F.lit(cap) * F.try_divide(F.col("mean"), F.col("least"))).otherwise(F.lit(0.0)))
    state = state.withColumn("lo", F.when(F.col("least") > 0, F.lit(-45.0) * F.try_divide(F.col("mean"), F.col("least"))).otherwise(F.lit(0.0)))
    # a source that is to be taken whole, as often as may be, starts where all rates are at the cap
    start = F.when(F.col("target") >= F.col("source_size") * F.lit(float(most)), F.col("hi")).otherwise(start)
    state = written(state.withColumn("l", start).withColumn("off", F.lit(1.0)))
    for _ in range(rounds):
        each = counts.join(state.select("key", "l", "mean"), "key").withColumn("r", tilt(most))
        grown = F.when(F.col("r") < F.lit(float(most)), F.col("r") * F.try_divide(F.col("size"), F.col("mean"))).otherwise(F.lit(0.0))
        took = F.col("n") * F.col("size") * F.col("r")
        sums = each.groupBy("key").agg(F.sum(took.cast(EXACT)).cast("double").alias("took"), F.sum((F.col("n") * F.col("size") * grown).cast(EXACT)).cast("double").alias("slope"))
        now = state.join(sums, "key").withColumn("off", F.when(F.col("target") > 0, F.abs(F.try_divide(F.col("took"), F.col("target")) - 1)).otherwise(F.lit(0.0)))
        now = now.withColumn("hi", F.when(F.col("took") >= F.col("target"), F.col("l")).otherwise(F.col("hi")))
        now = now.withColumn("lo", F.when(F.col("took") < F.col("target"), F.col("l")).otherwise(F.col("lo")))
        # Newton on log(took), which is close to a line in l
        step = F.when((F.col("slope") > 0) & (F.col("took") > 0) & (F.col("target") > 0), F.col("l") - F.try_divide(F.log(F.try_divide(F.col("took"), F.col("target"))) * F.col("took"), F.col("slope")))
        inside = step.isNotNull() & (step > F.col("lo")) & (step < F.col("hi"))
        moved = F.when(F.col("off") <= tolerance, F.col("l")).when(inside, step).otherwise((F.col("lo") + F.col("hi")) / 2)
        after = written(now.withColumn("l", F.round(moved, 13)).drop("took", "slope"))
        forget(state)
        state = after
        if (state.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    return state


def mix(docs: DataFrame, weights: list[float] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row, with its row key ``rid``,
    ``rate`` and ``copies``."""
    rows = written(sized(docs))
    rows_keyed = rows.withColumn("key", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()))
    counts = written(rows_keyed.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    stats = counts.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), (F.sum(F.col("size") * F.col("n")) / F.greatest(F.sum(F.when(F.col("size") > 0, F.col("n"))), F.lit(1))).alias("mean"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    state = multipliers(counts, targets(stats, list(weights), most), most)
    by_source = state.select("key", "l", "mean", "source_size", "target")
    cells = counts.join(by_source, "key").withColumn("rate", tilt(most)).withColumn("part", F.round(F.col("rate") - F.floor("rate"), 9))
    before = W.partitionBy("key").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("run", F.coalesce(F.sum((F.col("part") * F.col("n")).cast("decimal(38,9)")).over(before), F.lit(0).cast("decimal(38,9)")))
    salt = F.pmod(F.xxhash64(F.col("rid")), F.lit(SALTS))
    salted = rows_keyed.withColumn("salt", salt)
    held = salted.groupBy("key", "size", "salt").agg(F.count(F.lit(1)).alias("m"))
    up_to = W.partitionBy("key", "size").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    held = held.withColumn("first", F.coalesce(F.sum("m").over(up_to), F.lit(0).cast("long"))).drop("m")
    place = F.row_number().over(W.partitionBy("key", "size", "salt").orderBy("doc_id", "rid")) - 1
    ranked = salted.withColumn("place", place).join(held, ["key", "size", "salt"]).withColumn("k", (F.col("first") + F.col("place")).cast("decimal(20,0)"))
    out = ranked.join(cells.select("key", "size", "rate", "part", "run", "source_size", "target"), ["key", "size"])
    step = F.col("part").cast("decimal(12,9)")
    passed = lambda k: F.floor(F.col("run") + step * k + F.lit(0.5).cast("decimal(2,1)"))
    copies = (F.floor("rate") + passed(F.col("k") + 1) - passed(F.col("k"))).cast("long")
    out = out.withColumn("copies", copies).select("key", "k", "rid", "doc_id", "size", "source_size", "target", "rate", "copies")
    few = state.count() <= SMALL
    for _ in range(2):
        out = settled(written(out), most, few)
    return out.select("rid", "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")


def settled(rows: DataFrame, most: int, few: bool) -> DataFrame:
    """One copy more or less of one document of each source, where that brings the
    source nearer to its target. few: sources are few enough to be broadcast, so that rows
    are not dealt by source."""
    each = F.broadcast if few else (lambda x: x)
    lacks = rows.groupBy("key").agg((F.max("target") - F.sum(F.col("copies") * F.col("size")).cast("double")).alias("lack"))
    both = rows.join(each(lacks), "key").where(F.col("size") > 0)
    change = lambda by, may: F.when(may & (F.abs(F.col("lack") - by * F.col("size")) < F.abs("lack")), F.struct(F.abs(F.col("lack") - by * F.col("size")).alias("off"), F.col("size").alias("s"), F.col("k").alias("at"), F.lit(by).alias("by")))
    best = F.least(change(1, F.col("copies") < most), change(-1, F.col("copies") > 0))
    chosen = both.groupBy("key").agg(F.min(best).alias("best")).where("best is not null").select("key", F.col("best.s").alias("size"), F.col("best.at").alias("k"), F.col("best.by").alias("by"))
    return rows.join(each(chosen), ["key", "size", "k"], "left").withColumn("copies", F.col("copies") + F.coalesce("by", F.lit(0))).drop("by")
