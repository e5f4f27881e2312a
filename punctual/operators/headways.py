"""Headway regularity: gaps between consecutive arrivals (W3, W4, P15, F10,
F11, A9, A14, A15, O-3).

Headways are gaps between consecutive arrivals at the same (route, stop,
direction). A busy stop must not land in one task, so the ``lag`` window is
partitioned by (group, time chunk) and the first arrival of each chunk takes
the last arrival of the group's previous non-empty chunk from a small
per-chunk table (one row per group and chunk). Medians come from a distributed
selection (:mod:`punctual.operators.quantiles`), so no buffer holds a group's
values; the group's is joined back on the group key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (BUNCH_FACTOR, GAP_FACTOR, HEADWAY_HIST_CAP, HEADWAY_MIN_HI,
                      HEADWAY_MIN_LO, MIN_BUNCH_HEADWAYS)
from ..functions.rounding import round_ratio
from .quantiles import exact_quantiles
from .panels import filter_view, share_pct, with_hour

GROUP = ["route_id", "stop_id", "direction_id"]
US_PER_MIN = 60_000_000


def headways(fact: DataFrame, lo: float = HEADWAY_MIN_LO, hi: float = HEADWAY_MIN_HI,
             bunch: float = BUNCH_FACTOR, gap: float = GAP_FACTOR,
             chunk_s: int = 3_600, agency_tz: str | None = None) -> DataFrame:
    """Per arrival: minutes since the previous arrival of its group, the
    group's median headway, and bunched / gapped flags.

    Order of steps: diff -> drop missing -> keep lo..hi minutes -> median of
    the kept headways -> flags. Rows with a NULL group key are dropped.
    """
    f = fact
    for k in GROUP:
        f = f.where(F.col(k).isNotNull())
    f = with_hour(f, agency_tz)
    f = (f.select("trip_stop_id", *GROUP, "actual_arrival", "hour")
         .withColumn("_us", F.unix_micros("actual_arrival"))
         .withColumn("_ck", F.floor(F.col("_us") / F.lit(chunk_s * 1_000_000)).cast("long")))
    # equal times: the lowest key takes the gap, later peers get 0 (dropped)
    w = Window.partitionBy(*GROUP, "_ck").orderBy("_us", "trip_stop_id")
    # three branches read this frame with different projections, which
    # defeats exchange reuse; materialise it once (one row per arrival,
    # recomputed from lineage if an executor is lost)
    f = f.withColumn("_prev", F.lag("_us").over(w)).persist()
    f.count()
    last_in_chunk = f.groupBy(*GROUP, "_ck").agg(F.max("_us").alias("_mx"))
    wc = Window.partitionBy(*GROUP).orderBy("_ck")
    prev_chunk = last_in_chunk.select(*GROUP, "_ck", F.lag("_mx").over(wc).alias("_pmx"))
    f = (f.join(prev_chunk, GROUP + ["_ck"])
         .withColumn("headway_us", F.col("_us") - F.coalesce("_prev", "_pmx"))
         .where(F.col("headway_us").isNotNull())
         .where(F.col("headway_us").between(int(lo * US_PER_MIN), int(hi * US_PER_MIN))))
    bits = int(hi * US_PER_MIN).bit_length()
    med = exact_quantiles(f, GROUP, "headway_us", [50], bits).withColumnRenamed("p50", "_med_us")
    return (f.join(med, GROUP)
            .select("trip_stop_id", *GROUP, "actual_arrival", "hour", "headway_us",
                    (F.col("headway_us") / F.lit(float(US_PER_MIN))).alias("headway_min"),
                    (F.col("_med_us") / F.lit(float(US_PER_MIN))).alias("hw_median"),
                    (F.col("headway_us") < F.lit(bunch) * F.col("_med_us")).alias("bunched"),
                    (F.col("headway_us") > F.lit(gap) * F.col("_med_us")).alias("gapped")))


def headway_stats(hw: DataFrame, route: str | None = None,
                  hours: tuple[int, int] | None = None) -> DataFrame:
    """Bunched %, gapped %, median headway and CV (sample std / mean).

    The sums of the gaps and of their squares are exact decimals at any number
    of rows; the CV formula is then a fixed sequence of double operations.
    """
    h = filter_view(hw, route, hours)
    x = F.col("headway_us").cast("decimal(19,0)")
    g = h.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.col("bunched").cast("int")).alias("_b"),
              F.sum(F.col("gapped").cast("int")).alias("_g"),
              F.sum(x).cast("decimal(38,0)").alias("_s1"), F.sum((x * x).cast("decimal(38,0)")).cast("decimal(38,0)").alias("_s2"),
              F.median("headway_us").alias("_med"))
    n = F.col("n").cast("double")
    # in seconds; the divisions are exact decimal ones
    s1 = F.expr("cast(_s1 / cast(1000000 as decimal(7,0)) as double)")
    s2 = F.expr("cast(_s2 / cast(1000000000000 as decimal(13,0)) as double)")
    var = (s2 - s1 * s1 / n) / (n - F.lit(1.0))
    cv = F.when(F.col("n") > 1, F.sqrt(var) / (s1 / n))
    return g.select(share_pct(F.col("_b"), F.col("n")).alias("bunched_pct"),
                    share_pct(F.col("_g"), F.col("n")).alias("gapped_pct"),
                    (F.col("_med") / F.lit(float(US_PER_MIN))).alias("median_headway_min"),
                    cv.alias("headway_cv"), "n")


def headway_histogram(hw: DataFrame, route: str | None = None,
                      hours: tuple[int, int] | None = None,
                      cap: float = HEADWAY_HIST_CAP) -> DataFrame:
    """Counts of headways <= cap minutes, rounded half-even to whole minutes."""
    h = filter_view(hw, route, hours).where(F.col("headway_min") <= cap)
    return (h.select(F.bround("headway_min", 0).alias("headway_bucket"))
            .groupBy("headway_bucket").agg(F.count(F.lit(1)).alias("headways")).orderBy("headway_bucket"))


def route_bunching(hw: DataFrame, route: str | None = None,
                   hours: tuple[int, int] | None = None,
                   min_n: int = MIN_BUNCH_HEADWAYS, k: int = 10) -> DataFrame:
    """Most bunching-prone routes with >= min_n headways (top-k report)."""
    h = filter_view(hw, route, hours)
    g = (h.groupBy("route_id")
         .agg(F.count(F.lit(1)).alias("observed_headways"),
              F.sum(F.col("bunched").cast("int")).alias("_b"))
         .where(F.col("observed_headways") >= min_n))
    top = g.orderBy((F.col("_b") / F.col("observed_headways")).desc(),
                    F.col("route_id").asc()).limit(k)
    return top.select("route_id", "observed_headways",
                      round_ratio(F.col("_b") * 100, F.col("observed_headways"), 1, True)
                      .alias("bunched_pct"))
