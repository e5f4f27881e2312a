"""DuckDB oracle SQL for every registered query.

Written from the model's definition (SURVEY 1.1), apart from the Spark plans:
the nearest stop is the least (distance, stop, ...) struct of a ping, and the
nearest timetable point of an arrival is the nearer of two one-sided ASOF
matches over the distinct points, the earlier one on a tie. Tie-breaks and
exact integer rounding follow the same rules on both sides.
"""

from __future__ import annotations

# ---------------------------------------------------------------- helpers


def rr(num: str, den: str, digits: int, half_even: bool = False) -> str:
    """SQL for round(num/den, digits) in exact integer arithmetic."""
    scale = 10 ** digits
    a = f"(abs(cast({num} as bigint)) * {scale})"
    d = f"cast({den} as bigint)"
    q = f"({a} // {d})"
    r = f"({a} - {q} * {d})"
    if half_even:
        up = f"(2 * {r} > {d} or (2 * {r} = {d} and {q} % 2 = 1))"
    else:
        up = f"(2 * {r} >= {d})"
    mag = f"({q} + case when {up} then 1 else 0 end)"
    signed = f"(case when cast({num} as bigint) < 0 then -{mag} else {mag} end)"
    return f"(case when {d} > 0 then cast({signed} as double) / {float(scale)!r}::double end)"


def tenths_sql(sec: str) -> str:
    mag = f"((abs({sec}) * 2 + 6) // 12)"
    return f"(case when {sec} < 0 then -{mag} else {mag} end)"


def ten(col: str = "delay_minutes") -> str:
    return f"cast(round({col} * 10) as bigint)"


def flag(col: str = "delay_minutes", early: int = 1, late: int = 5) -> str:
    return f"(case when {col} between -{early} and {late} then 1 else 0 end)"


# ---------------------------------------------------------------- fixtures

FX = {
    "fx_stops": """
select cast(1000 + n_nationkey as varchar) stop_id, concat('Stop ', n_name) stop_name,
       cast(43.6 + 0.0008 * (n_nationkey // 5) as double) stop_latitude,
       cast(-79.4 + 0.01 * n_regionkey as double) stop_longitude
from nation""",
    "fx_routes": """
select cast(100 + r_regionkey as varchar) route_id, cast(100 + r_regionkey as varchar) route_short_name,
       r_name route_long_name
from region""",
    "fx_trips": """
select cast(o_orderkey as varchar) trip_id, cast(100 + o_custkey % 5 as varchar) route_id,
       o_orderpriority service_id, o_orderstatus trip_headsign, cast(o_custkey % 2 as int) direction_id
from orders""",
    "fx_stop_times": """
select cast(l_orderkey as varchar) trip_id,
       cast(1000 + (l_linenumber % 5) * 5 + o_custkey % 5 as varchar) stop_id,
       cast(l_linenumber as int) stop_sequence,
       concat(lpad(cast(l_partkey % 27 as varchar), 2, '0'), ':',
              lpad(cast(l_suppkey * 7 % 60 as varchar), 2, '0'), ':',
              lpad(cast((l_partkey + l_suppkey) % 60 as varchar), 2, '0')) scheduled_arrival_str
from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_pings": """
select cast(100 + user_id % 5 as varchar) route_id,
       case when event_type = 'error' then null else concat(user_id, '-', event_id // 64) end trip_id,
       cast(user_id as varchar) vehicle_id,
       cast(43.6 + 0.0008 * (event_id % 5) as double) + ((event_id * 37) % 140 - 70) / 111000.0::double latitude,
       cast(-79.4 + 0.01 * (user_id % 5) as double) longitude,
       make_timestamp((1704067200 + (epoch_us(ts) // 1000000 - 1704067200) // 20) * 1000000) recorded_at
from events""",
}

# metres per degree, radius, match window: fixed values of the model
PIPE = {
    "route_stops": """
select distinct served.route_id, fx_stops.stop_id, stop_name, stop_latitude, stop_longitude
from (select route_id, stop_id from fx_trips join fx_stop_times using (trip_id) group by all) served
join fx_stops using (stop_id)""",
    "cand": """
with offsets as (
  select p.vehicle_id, p.route_id, p.trip_id, p.recorded_at, r.stop_id, r.stop_name,
         (p.latitude - r.stop_latitude) * 111000.0::double north,
         (p.longitude - r.stop_longitude) * 81000.0::double east
  from route_stops r join fx_pings p on r.route_id = p.route_id)
select * exclude (north, east), sqrt(north * north + east * east) distance_m
from offsets where sqrt(north * north + east * east) <= 50""",
    "near": """
select vehicle_id, best.route_id route_id, trip_id, recorded_at, best.stop_id stop_id,
       best.stop_name stop_name, best.distance_m distance_m
from (select vehicle_id, trip_id, recorded_at,
             min({'distance_m': distance_m, 'stop_id': stop_id, 'route_id': route_id,
                  'stop_name': stop_name}) best
      from cand group by all)""",
    "arr": """
select vehicle_id, route_id, trip_id, stop_id, stop_name,
       arg_min(recorded_at, recorded_at) actual_arrival, min(distance_m) closest_distance_m
from near group by all""",
    "sched": """
with parts as (
  select route_id, stop_id, scheduled_arrival_str, direction_id, trip_id, stop_sequence,
         string_split(scheduled_arrival_str, ':')::integer[] hms
  from fx_trips join fx_stop_times using (trip_id))
select * exclude (hms), hms[1] * 3600 + hms[2] * 60 + hms[3] sched_secs from parts""",
    "actual": """
select vehicle_id, route_id, stop_id, stop_name, actual_arrival,
       cast(epoch_us(actual_arrival) // 1000000 % 86400 as integer) actual_secs from arr""",
    # of the points of one second the lowest direction (none first), then text
    "points": """
select route_id, stop_id, sched_secs,
       min({'d': coalesce(direction_id, -1), 's': scheduled_arrival_str}) point
from sched where sched_secs is not null group by all""",
    "sides": """
select a.*, s.sched_secs, s.point
from actual a asof join points s
  on a.route_id = s.route_id and a.stop_id = s.stop_id and s.sched_secs <= a.actual_secs
union all
select a.*, s.sched_secs, s.point
from actual a asof join points s
  on a.route_id = s.route_id and a.stop_id = s.stop_id and s.sched_secs >= a.actual_secs""",
    "matched": """
select vehicle_id, m.route_id route_id, stop_id, m.stop_name stop_name, actual_arrival,
       m.actual_secs actual_secs, m.point.s scheduled_arrival_str, m.sched_secs sched_secs,
       cast(case when m.point.d >= 0 then m.point.d end as integer) direction_id
from (select vehicle_id, stop_id, actual_arrival,
             min({'gap': abs(actual_secs - sched_secs), 'sched_secs': sched_secs, 'point': point,
                  'route_id': route_id, 'stop_name': stop_name, 'actual_secs': actual_secs}) m
      from sides where abs(actual_secs - sched_secs) <= 1800 group by all)""",
    "fact": f"""
with late as (select *, cast(actual_secs - sched_secs as bigint) s from matched)
select concat_ws('-', vehicle_id, stop_id, actual_arrival::varchar) trip_stop_id,
       vehicle_id, route_id, stop_id, stop_name, actual_arrival, scheduled_arrival_str, direction_id,
       s delay_seconds, {tenths_sql('s')}::double / 10.0::double delay_minutes
from late""",
    "mart": f"""
select route_id, stop_name, direction_id, count(*) total_arrivals,
       {rr(f'sum({ten()})', 'count(*) * 10', 2)} avg_delay_min,
       round(min(delay_minutes), 2) earliest_min, round(max(delay_minutes), 2) latest_min,
       count(*) filter ({flag()} = 1) on_time_count,
       {rr(f'sum({flag()}) * 100', 'count(*)', 1)} on_time_pct
from fact group by all""",
}

ORDER = ["fx_stops", "fx_routes", "fx_trips", "fx_stop_times", "fx_pings",
         "route_stops", "cand", "near", "arr", "sched", "actual", "points", "sides", "matched",
         "fact", "mart"]


def with_ctes(body: str, upto: str = "mart", extra: dict | None = None) -> str:
    """``WITH`` every fixture/pipeline CTE up to ``upto`` (plus ``extra``)."""
    defs = {**FX, **PIPE}
    names = ORDER[: ORDER.index(upto) + 1]
    parts = [f"{n} AS ({defs[n]}\n)" for n in names]
    for n, q in (extra or {}).items():
        parts.append(f"{n} AS ({q}\n)")
    if body.lstrip().startswith("with "):
        body = f"select * from ({body}\n)"
    return "WITH " + ",\n".join(parts) + "\n" + body


def suffixed(body: str, suffix: str, names: tuple, renames: dict | None = None) -> str:
    """``body`` with the CTEs ``names`` renamed by ``suffix``, and ``renames``."""
    import re
    for m in names:
        body = re.sub(rf"\b(from|join) {m}\b", rf"\1 {m}{suffix}", body)
    for old, new in (renames or {}).items():
        body = re.sub(rf"\b{old}\b", new, body)
    return body


def chain(suffix: str, pings_view: str, upto: str = "fact") -> dict:
    """The pipeline CTEs renamed with ``suffix`` over another pings view."""
    names = ORDER[ORDER.index("route_stops"): ORDER.index(upto) + 1]
    return {f"{n}{suffix}": suffixed(PIPE[n], suffix, tuple(names), {"fx_pings": pings_view}) for n in names}


HMS = ("concat(lpad(cast(l_partkey % 27 as varchar), 2, '0'), ':', "
       "lpad(cast({minute} as varchar), 2, '0'), ':', "
       "lpad(cast((l_partkey + l_suppkey) % 60 as varchar), 2, '0'))")

SCHEDULE_VERSIONS = f"""
select cast(l_orderkey as varchar) trip_id,
       cast(1000 + (l_linenumber % 5) * 5 + o_custkey % 5 as varchar) stop_id,
       cast(l_linenumber as int) stop_sequence,
       {HMS.format(minute='l_suppkey * 7 % 60')} t1,
       {HMS.format(minute='(l_suppkey * 7 + 1) % 60')} talt,
       l_returnflag f, l_linenumber ln,
       row_number() over (partition by l_orderkey, l_linenumber % 5, o_custkey % 5, l_linenumber
                          order by t1, talt, l_returnflag) occurrence
from lineitem join orders on l_orderkey = o_orderkey"""
