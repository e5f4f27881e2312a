"""Exact quantiles by distributed selection.

``percentile`` keeps every distinct value of a group in one buffer. Here the rank
is narrowed by radix: a level counts, per group, the values by their next
``DIGIT`` bits (a partial aggregate), finds the digit that holds the rank by a
running sum over at most 2**DIGIT counts, and the next level counts only
values with that prefix. The last level's prefix is the value itself. No task
holds more than the counts of one digit, whatever the number of values or the
size of a group; the plan is lazy, nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 17


def _same(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(p).eqNullSafe(F.col(q)) for p, q in zip(a, b)])


def exact_quantiles(df: DataFrame, groups: list[str], value: str, percents: list[int], max_bits: int = 63) -> DataFrame:
    """Per group the continuous quantiles (interpolated between neighbouring
    ranks) of an integer column, as doubles ``p<percent>``.

    Values must lie within +-2**max_bits; NULL values don't count, and a group
    without values gives no row. NULL group keys form a group. Percents are
    integers of 0 to 100, so ranks and weights are exact.
    """
    levels = -(-max_bits // DIGIT)
    step = -(-max_bits // levels)
    g = [f"_g{i}" for i in range(len(groups))] or ["_g0"]
    keys = [F.col(c).alias(a) for c, a in zip(groups, g)] or [F.lit(0).alias("_g0")]
    v = df.select(*keys, F.col(value).cast("long").alias("_v")).where(F.col("_v").isNotNull())
    wanted = prefix = None
    for level in range(levels - 1, -1, -1):
        digit = F.shiftright("_v", step * level).alias("_d")
        some = v
        if wanted is not None:  # only values with a prefix that holds a rank
            t = wanted.select(*[F.col(c).alias(f"{c}t") for c in g], F.col("_d").alias("_dt")).distinct()
            some = v.join(t, _same(g, [f"{c}t" for c in g]) & (F.shiftright("_v", prefix) == F.col("_dt"))).drop(*[f"{c}t" for c in g])
        place = [*g, *(["_dt"] if wanted is not None else [])]
        counts = some.groupBy(*place, digit).agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy(*place).orderBy("_d")
        counts = counts.withColumn("_to", F.sum("_n").over(w))
        if wanted is None:
            total = F.sum("_n").over(Window.partitionBy(*g))
            at = F.expr("_total - 1")
            ranks = F.array(*[x for p in percents for x in (
                F.struct(F.lit(p).alias("p"), F.lit(0).alias("up"), F.floor(at * p / 100).alias("r")),
                F.struct(F.lit(p).alias("p"), F.lit(1).alias("up"), F.ceil(at * p / 100).alias("r")))])
            counts = counts.withColumn("_total", total)
            hit = (counts.withColumn("_q", F.explode(F.filter(ranks, lambda q: (q["r"] < F.col("_to")) & (q["r"] >= F.col("_to") - F.col("_n")))))
                   .select(*g, "_d", "_total", "_q.p", "_q.up", (F.col("_q.r") - (F.col("_to") - F.col("_n"))).alias("r")))
        else:
            old = wanted.select(*[F.col(c).alias(f"{c}o") for c in g], F.col("_d").alias("_do"), "_total", "p", "up", "r")
            inside = (F.col("r") < F.col("_to")) & (F.col("r") >= F.col("_to") - F.col("_n"))
            hit = (counts.join(old, _same(g, [f"{c}o" for c in g]) & (F.col("_dt") == F.col("_do")) & inside)
                   .select(*g, "_d", "_total", "p", "up", (F.col("r") - (F.col("_to") - F.col("_n"))).alias("r")))
        wanted, prefix = hit, step * level

    def quantile(p: int) -> Column:
        low, high = (F.max(F.when((F.col("p") == p) & (F.col("up") == up), F.col("_d"))) for up in (0, 1))
        part = F.max((F.col("_total") - 1) * p % 100)  # hundredths of the way to the next rank
        whole = (low.cast("decimal(20,0)") * (100 - part) + high.cast("decimal(20,0)") * part).cast("decimal(38,0)")
        return (whole / F.lit(100).cast("decimal(3,0)")).cast("double")

    out = wanted.groupBy(*g).agg(*[quantile(p).alias(f"p{p}") for p in percents])
    return out.select(*[F.col(a).alias(c) for a, c in zip(g, groups)], *[f"p{p}" for p in percents])
