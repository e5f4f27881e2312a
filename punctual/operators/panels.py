"""Dashboard panels as DataFrame operators (A3-A10, A13, A16, A25, F5, F9,
P11-P17).

Each panel is a function of the delay fact and its parameters. Filters are
plain predicates, so a route / hour choice is pushed into the fact scan.
Shares are computed as ``count / n * 100`` and means of 1-dp delays as
``sum(tenths) / (10 n)`` so that they do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (COLOR_BEST, COLOR_HI_Q, COLOR_LO_Q, COLOR_WORST, DELAY_CLIP_MIN,
                      MIN_STOP_ARRIVALS, ON_TIME_EARLY_MIN, ON_TIME_LATE_MIN)
from ..functions.flags import clip, delay_state, lerp_int, on_time_flag, robust_score
from ..functions.timefns import local_ts
from ..functions.rounding import exact_mean, int_div, round_ratio
from .joins import broadcast_if_small
from .reliability import tenths


def share_pct(cond_count, n) -> F.Column:
    """count / n * 100 as a double (NULL when n = 0)."""
    n = F.when(n > 0, n.cast("double"))
    return cond_count.cast("double") / n * F.lit(100.0)


def with_hour(fact: DataFrame, agency_tz: str | None = None) -> DataFrame:
    """Adds ``hour`` of arrival (in the agency's zone) unless it is there."""
    if "hour" in fact.columns:
        return fact
    return fact.withColumn("hour", F.hour(local_ts("actual_arrival", agency_tz)))


def filter_view(fact: DataFrame, route: str | None = None,
                hours: tuple[int, int] | None = None, agency_tz: str | None = None) -> DataFrame:
    """Route equality and hour-of-arrival range (both optional)."""
    f = with_hour(fact, agency_tz)
    if hours is not None:
        f = f.where(F.col("hour").between(hours[0], hours[1]))
    if route is not None:
        f = f.where(F.col("route_id") == route)
    return f


def scale_stats(fact: DataFrame) -> DataFrame:
    """Arrivals, distinct routes / stops, and span in whole 24-h periods + 1."""
    g = fact.agg(F.count(F.lit(1)).alias("total_arrivals"),
                 F.count_distinct("route_id").alias("total_routes"),
                 F.count_distinct("stop_id").alias("total_stops"),
                 F.min("actual_arrival").alias("_mn"), F.max("actual_arrival").alias("_mx"))
    span_us = F.unix_micros("_mx") - F.unix_micros("_mn")
    return g.select("total_arrivals", "total_routes", "total_stops",
                    (int_div(span_us, F.lit(86_400_000_000).cast("long")) + 1).alias("span_days"))


def filtered_kpis(fact: DataFrame, route: str | None = None,
                  hours: tuple[int, int] | None = None,
                  early: float = ON_TIME_EARLY_MIN, late: float = ON_TIME_LATE_MIN) -> DataFrame:
    """On-time, early and late shares, mean delay and count in the view."""
    f = filter_view(fact, route, hours)
    d = F.col("delay_minutes")
    g = f.agg(F.count(F.lit(1)).alias("n"),
              F.sum(on_time_flag(d, early, late)).alias("_c"),
              F.sum(F.when(d < -early, 1).otherwise(0)).alias("_e"),
              F.sum(F.when(d > late, 1).otherwise(0)).alias("_l"),
              F.sum(tenths()).alias("_s10"))
    n = F.col("n")
    return g.select(share_pct(F.col("_c"), n).alias("on_time_pct"),
                    share_pct(F.col("_e"), n).alias("early_pct"),
                    share_pct(F.col("_l"), n).alias("late_pct"),
                    F.when(n > 0, exact_mean(F.col("_s10"), n, 10.0)).alias("avg_delay"),
                    "n")


def delay_histogram(fact: DataFrame, route: str | None = None,
                    hours: tuple[int, int] | None = None, clip_min: float | None = None,
                    rounded: bool = True) -> DataFrame:
    """Arrival counts per delay value, in its order: optionally clipped, rounded half-even."""
    f = filter_view(fact, route, hours) if (route or hours) else fact
    x = F.col("delay_minutes")
    if clip_min is not None:
        x = clip(x, -clip_min, clip_min)
    if rounded:
        x = F.bround(x, 0)
    return (f.where(F.col("delay_minutes").isNotNull()).select(x.alias("delay_bucket"))
            .groupBy("delay_bucket").agg(F.count(F.lit(1)).alias("arrivals")).orderBy("delay_bucket"))


def clipped_delay_histogram(fact: DataFrame, route: str | None = None,
                            hours: tuple[int, int] | None = None) -> DataFrame:
    return delay_histogram(fact, route, hours, clip_min=DELAY_CLIP_MIN, rounded=True)


def with_delay_state(fact: DataFrame, early: float = ON_TIME_EARLY_MIN,
                     late: float = ON_TIME_LATE_MIN) -> DataFrame:
    """Adds ``is_on_time`` (inclusive) and ``state`` (right-closed bins)."""
    d = F.col("delay_minutes")
    return (fact.withColumn("is_on_time", on_time_flag(d, early, late))
                .withColumn("state", delay_state(d, early, late)))


def on_time_by_hour(fact: DataFrame, route: str | None = None,
                    hours: tuple[int, int] | None = None, early: float = ON_TIME_EARLY_MIN,
                    late: float = ON_TIME_LATE_MIN, agency_tz: str | None = None) -> DataFrame:
    """On-time share per hour of arrival, in hour order."""
    f = filter_view(fact, route, hours, agency_tz)
    g = f.groupBy("hour").agg(F.count(F.lit(1)).alias("_n"),
                              F.sum(on_time_flag(F.col("delay_minutes"), early, late)).alias("_c"))
    return g.select("hour", share_pct(F.col("_c"), F.col("_n")).alias("on_time_pct")).orderBy("hour")


def stop_map(fact: DataFrame, coords: DataFrame, route: str | None = None,
             hours: tuple[int, int] | None = None, min_n: int = MIN_STOP_ARRIVALS,
             early: float = ON_TIME_EARLY_MIN, late: float = ON_TIME_LATE_MIN,
             broadcast_max_bytes: int = 64_000_000) -> DataFrame:
    """Per-stop on-time % joined to stop coordinates (stops with >= min_n).

    ``stop_name`` is the smallest name seen for the stop (deterministic).
    """
    f = filter_view(fact, route, hours).where(F.col("stop_id").isNotNull())
    g = (f.groupBy("stop_id")
         .agg(F.count(F.lit(1)).alias("arrivals"),
              F.sum(on_time_flag(F.col("delay_minutes"), early, late)).alias("_c"),
              F.min("stop_name").alias("stop_name"))
         .where(F.col("arrivals") >= min_n))
    c = broadcast_if_small(coords.select("stop_id", "stop_lat", "stop_lon"), broadcast_max_bytes)
    return (g.join(c, "stop_id")
            .select("stop_id", "stop_name", "arrivals",
                    round_ratio(F.col("_c") * 100, F.col("arrivals"), 1, True).alias("on_time_pct"),
                    "stop_lat", "stop_lon"))


def color_scale(geo: DataFrame, lo_q: float = COLOR_LO_Q, hi_q: float = COLOR_HI_Q) -> DataFrame:
    """Red-to-teal colour per row, scaled between two percentiles of the view.

    Both percentiles (linear interpolation) come from one scalar subquery
    returning an array, so no row is ever paired with another and the view
    is aggregated once for them. The view (one row per stop) is cached because
    both the subquery and the projection read it.
    """
    geo = geo.persist()
    geo.count()
    qs = geo.select(F.percentile("on_time_pct", F.array(F.lit(lo_q), F.lit(hi_q)))).scalar()
    lo, hi = qs[0], qs[1]
    t = robust_score(F.col("on_time_pct"), lo, hi)
    (r0, g0, b0), (r1, g1, b1) = COLOR_WORST, COLOR_BEST
    return geo.select("stop_id", "on_time_pct", lerp_int(r0, r1, t).alias("r"),
                      lerp_int(g0, g1, t).alias("g"), lerp_int(b0, b1, t).alias("b"))


def map_center(geo: DataFrame) -> DataFrame:
    """Mean latitude / longitude of the mapped stops.

    Summed as decimal(18, 9) so the mean does not depend on row order.
    """
    def mean(c):
        return (F.sum(F.col(c).cast("decimal(18,9)")).cast("double")
                / F.count(F.col(c)).cast("double"))
    return geo.agg(mean("stop_lat").alias("center_lat"), mean("stop_lon").alias("center_lon"))
