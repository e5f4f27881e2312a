"""End-to-end plans: inputs -> arrivals -> delay fact -> marts.

Each function only composes lazy DataFrames; nothing is collected. The
physical strategy per step is documented on the operators.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import PipelineConfig
from ..operators import arrivals as arr
from ..operators import reliability as rel
from ..operators import schedule as sch
from ..sources import fixtures as fx


@dataclass
class Inputs:
    stops: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    routes: DataFrame
    pings: DataFrame


def fixture_inputs(spark: SparkSession, sf_dir: str, routes: int = 5) -> Inputs:
    return Inputs(stops=fx.stops(spark, sf_dir), trips=fx.trips(spark, sf_dir, routes),
                  stop_times=fx.stop_times(spark, sf_dir), routes=fx.routes(spark, sf_dir),
                  pings=fx.pings(spark, sf_dir, routes))


def route_stops(inp: Inputs, cfg: PipelineConfig) -> DataFrame:
    return arr.route_stops(inp.stops, inp.stop_times, inp.trips, cfg.target_route)


def candidates(inp: Inputs, cfg: PipelineConfig) -> DataFrame:
    return arr.proximity_join(inp.pings, route_stops(inp, cfg), cfg)


def nearest(inp: Inputs, cfg: PipelineConfig) -> DataFrame:
    return arr.nearest_stop(candidates(inp, cfg))


def arrivals(inp: Inputs, cfg: PipelineConfig) -> DataFrame:
    return arr.actual_arrivals(nearest(inp, cfg), cfg.by_service_date, cfg.agency_tz)


def schedule(inp: Inputs) -> DataFrame:
    return sch.schedule_seconds(inp.stop_times, inp.trips)


def matched(inp: Inputs, cfg: PipelineConfig) -> DataFrame:
    return sch.match_schedule(arrivals(inp, cfg), schedule(inp), cfg)


def fact(inp: Inputs, cfg: PipelineConfig) -> DataFrame:
    return sch.stop_performance(matched(inp, cfg))


def mart(inp: Inputs, cfg: PipelineConfig) -> DataFrame:
    return rel.route_reliability(fact(inp, cfg), cfg.early, cfg.late)


def build(spark: SparkSession, sf_dir: str, cfg: PipelineConfig | None = None) -> dict:
    """All layers of the model as lazy DataFrames, keyed by model name."""
    cfg = cfg or PipelineConfig()
    inp = fixture_inputs(spark, sf_dir)
    a = arrivals(inp, cfg)
    f = sch.stop_performance(sch.match_schedule(a, schedule(inp), cfg))
    return {"stg_positions": inp.pings, "int_actual_arrivals": a,
            "fct_stop_performance": f,
            "fct_route_reliability": rel.route_reliability(f, cfg.early, cfg.late)}


def _past_mark(spark: SparkSession, inp: Inputs, mark, lookback, cfg: PipelineConfig) -> Inputs:
    """Inputs with only the pings that can produce a fact row newer than the mark:
    every grouping of the model includes the vehicle, so rows past the mark come
    only from vehicles with pings past the mark, and their whole history gives
    exactly the rows a full rebuild would. With dated arrivals
    (``by_service_date``) only days from the mark's day on are read."""
    from pyspark.sql import functions as F

    from ..functions.timefns import local_ts
    pings = inp.pings
    if mark is not None:
        since = mark - lookback if lookback else mark
        if cfg.by_service_date:
            # from the start of the mark's day: a plain comparison with a
            # literal, which reaches the scan of a stored ping table
            day = spark.range(1).select(F.date_trunc("day", local_ts(F.lit(since), cfg.agency_tz)).alias("d"))
            start = day.select(F.to_utc_timestamp("d", cfg.agency_tz) if cfg.agency_tz else F.col("d")).first()[0]
            pings = pings.where(F.col("recorded_at") >= F.lit(start))
        active = (pings.where(F.col("recorded_at") > F.lit(since))
                  .select(F.col("vehicle_id").alias("_active")).distinct())
        # a NULL vehicle is a vehicle like any other
        pings = pings.join(active, F.col("vehicle_id").eqNullSafe(F.col("_active")), "left_semi")
    return Inputs(inp.stops, inp.trips, inp.stop_times, inp.routes, pings)


def incremental_fact(spark: SparkSession, inp: Inputs, path: str,
                     cfg: PipelineConfig | None = None, lookback=None) -> int:
    """Append the fact past the target's high-water mark (K3, O6), see
    ``_past_mark``. The first run (no target) is a full build. Returns the rows
    taken."""
    from ..sinks.materialize import append_incremental, high_water_mark
    cfg = cfg or PipelineConfig()
    mark = high_water_mark(spark, path)
    restricted = _past_mark(spark, inp, mark, lookback, cfg)
    return append_incremental(spark, fact(restricted, cfg), path, lookback=lookback, since=mark)


def upsert_fact(spark: SparkSession, inp: Inputs, path: str, cfg: PipelineConfig | None = None, lookback=None) -> int:
    """The incremental fact as a log table: rows past the high-water mark (read
    from the manifests) replace the rows of their keys in whatever file they are,
    in one atomic commit. Returns the committed version."""
    from pyspark.sql import functions as F

    from ..streaming.arrival_state import fact_table
    cfg = cfg or PipelineConfig()
    table = fact_table(spark, path)
    mark = table.greatest("actual_arrival")
    rows = fact(_past_mark(spark, inp, mark, lookback, cfg), cfg)
    if mark is not None:
        rows = rows.where(F.col("actual_arrival") > F.lit(mark - lookback if lookback else mark))
    return table.upsert(rows)


def load_build_test(spark: SparkSession, inp: Inputs, landing: str, raw_path: str, out: str,
                    checkpoint: str, cfg: PipelineConfig) -> DataFrame:
    """Load landed snapshots into the raw table, build the fact and the mart
    from it as tables, run the declared tests and raise on any violation
    (D4); each step runs only after the one before it has succeeded. Both tables
    are replaced by one atomic commit each: readers see the old one until then."""
    from ..operators import quality as dq
    from ..operators.staging import flatten_positions
    from ..sinks.tablelog import LogTable
    from ..streaming.arrival_state import fact_table
    from ..sources.snapshots import RAW_SCHEMA
    from ..streaming.positions import load_raw_snapshots

    load_raw_snapshots(spark, landing, raw_path, checkpoint).awaitTermination()
    pings = flatten_positions(spark.read.schema(RAW_SCHEMA).parquet(raw_path))
    loaded = Inputs(inp.stops, inp.trips, inp.stop_times, inp.routes, pings)
    facts = fact_table(spark, f"{out}/fct_stop_performance")
    facts.replace(fact(loaded, cfg))
    f = facts.read()
    mart_table = LogTable(spark, f"{out}/fct_route_reliability", ["route_id", "stop_name", "direction_id"])
    mart_table.replace(rel.route_reliability(f, cfg.early, cfg.late))
    m = mart_table.read()
    results = dq.run_checks(f, "fct_stop_performance", [
        dq.not_null("trip_stop_id"), dq.unique("trip_stop_id"), dq.not_null("stop_name"),
        dq.not_null("delay_minutes"), dq.accepted_range("delay_minutes", -30, 30)])
    results = results.unionByName(dq.run_checks(m, "fct_route_reliability", [
        dq.not_null("on_time_pct"), dq.accepted_range("on_time_pct", 0, 100)]))
    dq.assert_passing(results)
    return results
