"""Exact percentiles of a distributed sort: no value map in one buffer.

``percentile`` holds every distinct value of a group in one aggregation buffer. Here the
(group, value) counts are range-partitioned and sorted; each range's total per group tells
which range holds a wanted rank, and only there are counts accumulated, value by value. Memory
depends neither on the distinct values of a group nor on its rows, and a group that holds a
third of all rows is spread over as many ranges as its values fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talentlake.session import materialize


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], ranges: int | None = None, weight: str | None = None) -> DataFrame:
    """(keys, n, q0, q1, ...): for each group the count of its non-NULL values and the linearly
    interpolated percentiles at ``shares``, as ``percentile`` has them (rank (n - 1) * share). A row
    stands for ``weight`` equal ones (a column of counts). Groups without a value have no row; a NULL key is a group.

    The sorted counts are written once (they are read twice). ranges: partitions of the sort,
    ``spark.sql.shuffle.partitions`` if None."""
    spark, keys = df.sparkSession, list(keys)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(n.cast("bigint").alias("_n"))
    counts = materialize(counts.repartitionByRange(ranges, *keys, "_v").withColumn("_range", F.spark_partition_id()))

    per_range = counts.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in"))
    group = Window.partitionBy(*keys)
    # groups x ranges: as few rows as there are ranges and groups together
    before = F.sum("_in").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    placed = per_range.select(*keys, "_range", "_in", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_in").over(group).alias("n"))

    # the one or two ranks that each share lies between
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), (F.col("n") - 1) * F.lit(float(s))) .cast("struct<i:int,at:double>") for i, s in enumerate(shares)])
    asked = placed.select("*", F.explode(wanted).alias("_w")).select("*", F.explode(F.array_distinct(F.array(F.floor("_w.at"), F.ceil("_w.at")))).alias("_rank"))
    asked = asked.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_in")))
    asked = asked.groupBy(*keys, "_range", "_before", "n").agg(F.collect_list(F.struct(F.col("_w.i").alias("i"), F.col("_w.at").alias("at"), F.col("_rank").alias("rank"))).alias("_asked"))

    inside = Window.partitionBy(*keys, "_range").orderBy("_v")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"a.{k}")) for k in [*keys, "_range"]]
    here = counts.alias("c").join(asked.alias("a"), same).select(*[F.col(f"c.{k}").alias(k) for k in [*keys, "_range", "_v", "_n"]], "n", "_asked", "_before")
    upto = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("_before")
    met = here.withColumn("_upto", upto).select(*keys, "n", "_v", F.explode(F.filter("_asked", lambda x: (x["rank"] < F.col("_upto")) & (x["rank"] >= F.col("_upto") - F.col("_n")))).alias("_r"))
    # between two ranks, the share of each is what the other lies away
    part = F.when(F.floor("_r.at") == F.ceil("_r.at"), F.lit(1.0)).when(F.col("_r.rank") == F.floor("_r.at"), F.ceil("_r.at") - F.col("_r.at")).otherwise(F.col("_r.at") - F.floor("_r.at"))
    each = [F.sum(F.when(F.col("_r.i") == i, F.col("_v") * part)).alias(f"q{i}") for i in range(len(shares))]
    return met.groupBy(*keys, "n").agg(*each)
