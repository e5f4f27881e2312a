"""Reliability marts and route/stop rankings (P10, A2, A3, A6, A11, A12, A17,
O-1, O-2, O-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (MIN_ROUTE_ARRIVALS, MIN_STOP_ARRIVALS, ON_TIME_EARLY_MIN,
                      ON_TIME_LATE_MIN)
from ..functions.flags import on_time_flag
from ..functions.rounding import round_ratio

def tenths(col: str = "delay_minutes"):
    """Whole tenths of a minute of a 1-dp delay (exact integer)."""
    return F.round(F.col(col) * 10).cast("long")


def route_reliability(fact: DataFrame, early: float = ON_TIME_EARLY_MIN,
                      late: float = ON_TIME_LATE_MIN) -> DataFrame:
    """Per (route, stop name, direction): arrivals, delay stats, on-time share."""
    return finish_mart(fact.groupBy(*MART_KEY).agg(*mart_sums(early, late)))


MART_KEY = ["route_id", "stop_name", "direction_id"]


def mart_sums(early: float = ON_TIME_EARLY_MIN, late: float = ON_TIME_LATE_MIN) -> list:
    """Aggregates of fact rows that the mart is made of; all of them merge."""
    return [F.count(F.lit(1)).alias("total_arrivals"),
            F.sum(tenths()).alias("_s10"),
            F.min("delay_minutes").alias("_mn"),
            F.max("delay_minutes").alias("_mx"),
            F.sum(on_time_flag(F.col("delay_minutes"), early, late)).cast("long").alias("on_time_count")]


def merge_mart(parts: DataFrame) -> DataFrame:
    """Aggregates of several parts of the fact as those of their union."""
    return parts.groupBy(*MART_KEY).agg(
        F.sum("total_arrivals").alias("total_arrivals"), F.sum("_s10").alias("_s10"), F.min("_mn").alias("_mn"),
        F.max("_mx").alias("_mx"), F.sum("on_time_count").alias("on_time_count"))


def finish_mart(g: DataFrame) -> DataFrame:
    return g.select(
        *MART_KEY, "total_arrivals",
        round_ratio(F.col("_s10"), F.col("total_arrivals") * 10, 2).alias("avg_delay_min"),
        F.round("_mn", 2).alias("earliest_min"),
        F.round("_mx", 2).alias("latest_min"),
        "on_time_count",
        round_ratio(F.col("on_time_count") * 100, F.col("total_arrivals"), 1).alias("on_time_pct"),
    )


def network_kpis(fact: DataFrame, early: float = ON_TIME_EARLY_MIN,
                 late: float = ON_TIME_LATE_MIN) -> DataFrame:
    """Headline numbers: routes, arrivals, on-time %, mean delay (half-even)."""
    g = fact.agg(F.count_distinct("route_id").alias("routes"),
                 F.count(F.lit(1)).alias("arrivals"),
                 F.sum(on_time_flag(F.col("delay_minutes"), early, late)).alias("_c"),
                 F.sum(tenths()).alias("_s10"))
    return g.select("routes", "arrivals",
                    round_ratio(F.col("_c") * 100, F.col("arrivals"), 1, True).alias("on_time_pct"),
                    round_ratio(F.col("_s10"), F.col("arrivals") * 10, 2, True)
                    .alias("avg_delay_min"))


def route_kpis(fact: DataFrame, route: str, early: float = ON_TIME_EARLY_MIN,
               late: float = ON_TIME_LATE_MIN) -> DataFrame:
    """One route's arrivals, on-time % and mean delay; 0 when it has no rows."""
    f = fact.where(F.col("route_id") == route)
    g = f.agg(F.count(F.lit(1)).alias("r_total"),
              F.sum(on_time_flag(F.col("delay_minutes"), early, late)).alias("_c"),
              F.sum(tenths()).alias("_s10"))
    return g.select(
        F.lit(route).alias("route_id"), "r_total",
        F.coalesce(round_ratio(F.col("_c") * 100, F.col("r_total"), 1, True), F.lit(0.0))
        .alias("r_on_time"),
        F.coalesce(round_ratio(F.col("_s10"), F.col("r_total") * 10, 2, True), F.lit(0.0))
        .alias("r_avg"))


def route_summary(fact: DataFrame, early: float = ON_TIME_EARLY_MIN,
                  late: float = ON_TIME_LATE_MIN) -> DataFrame:
    """Per route: arrivals, mean delay (2 dp), on-time % (1 dp), half-even."""
    g = (fact.where(F.col("route_id").isNotNull()).groupBy("route_id")
         .agg(F.count(F.lit(1)).alias("arrivals"),
              F.sum(tenths()).alias("_s10"),
              F.sum(on_time_flag(F.col("delay_minutes"), early, late)).alias("_c")))
    return g.select("route_id", "arrivals",
                    round_ratio(F.col("_s10"), F.col("arrivals") * 10, 2, True)
                    .alias("avg_delay_min"),
                    round_ratio(F.col("_c") * 100, F.col("arrivals"), 1, True)
                    .alias("on_time_pct"))


def worst_routes(fact: DataFrame, min_n: int = MIN_ROUTE_ARRIVALS, k: int = 15,
                 early: float = ON_TIME_EARLY_MIN, late: float = ON_TIME_LATE_MIN) -> DataFrame:
    """Least reliable routes with at least ``min_n`` arrivals (top-k report)."""
    s = route_summary(fact, early, late).where(F.col("arrivals") >= min_n)
    return s.orderBy(F.col("on_time_pct").asc(), F.col("route_id").asc()).limit(k)


def worst_stops_mart(mart: DataFrame, min_n: int = MIN_STOP_ARRIVALS, k: int = 10,
                     route: str | None = None) -> DataFrame:
    """Lowest on-time % rows of the reliability mart (top-k report)."""
    m = mart.where(F.col("total_arrivals") >= min_n)
    if route is not None:
        m = m.where(F.col("route_id") == route)
    return (m.orderBy(F.col("on_time_pct").asc(), F.col("route_id").asc(),
                      F.col("stop_name").asc(), F.col("direction_id").asc_nulls_first())
            .limit(k)
            .select("route_id", "stop_name", "direction_id", "total_arrivals",
                    "avg_delay_min", "on_time_pct"))


def worst_stops_view(fact: DataFrame, min_n: int = MIN_STOP_ARRIVALS, k: int = 25,
                     early: float = ON_TIME_EARLY_MIN,
                     late: float = ON_TIME_LATE_MIN) -> DataFrame:
    """Per (stop name, direction) over the filtered fact, worst on-time first.

    NULL keys are dropped; sorting uses the unrounded share, output is rounded
    half-even to 1 dp.
    """
    f = fact.where(F.col("stop_name").isNotNull() & F.col("direction_id").isNotNull())
    g = (f.groupBy("stop_name", "direction_id")
         .agg(F.count(F.lit(1)).alias("arrivals"),
              F.sum(on_time_flag(F.col("delay_minutes"), early, late)).alias("_c"),
              F.sum(tenths()).alias("_s10"))
         .where(F.col("arrivals") >= min_n))
    top = g.orderBy((F.col("_c") / F.col("arrivals")).asc(), F.col("stop_name").asc(),
                    F.col("direction_id").asc()).limit(k)
    return top.select("stop_name", "direction_id", "arrivals",
                      round_ratio(F.col("_c") * 100, F.col("arrivals"), 1, True)
                      .alias("on_time_pct"),
                      round_ratio(F.col("_s10"), F.col("arrivals") * 10, 1, True)
                      .alias("avg_delay_min"))


def mart_rollup(mart: DataFrame) -> DataFrame:
    """Stop/direction combos, mean of the mean delays, weighted on-time %."""
    g = mart.agg(F.count(F.lit(1)).alias("stop_dir_combos"),
                 F.sum(F.round(F.col("avg_delay_min") * 100).cast("long")).alias("_s100"),
                 F.sum("on_time_count").alias("_c"),
                 F.sum("total_arrivals").alias("_n"))
    return g.select("stop_dir_combos",
                    round_ratio(F.col("_s100"), F.col("stop_dir_combos") * 100, 2)
                    .alias("route_avg_delay"),
                    round_ratio(F.col("_c") * 100, F.col("_n"), 1).alias("on_time_pct"))


def route_list(fact: DataFrame) -> DataFrame:
    """Distinct routes in natural order (shorter ids first)."""
    return (fact.select("route_id").where(F.col("route_id").isNotNull()).distinct()
            .orderBy(F.length("route_id"), F.col("route_id")))


# fixed values: the display headers of the worst-routes table
WORST_ROUTE_HEADERS = {"route_id": "Route", "arrivals": "Arrivals",
                       "avg_delay_min": "Avg delay (min)", "on_time_pct": "On-time %"}


def worst_routes_table(fact: DataFrame, min_n: int = MIN_ROUTE_ARRIVALS, k: int = 15) -> DataFrame:
    """``worst_routes`` with presentation column names."""
    return worst_routes(fact, min_n, k).withColumnsRenamed(WORST_ROUTE_HEADERS)
