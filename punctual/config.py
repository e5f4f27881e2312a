"""Pipeline parameters.

Fixed values that must equal the behaviour being rebuilt are listed together
here, in natural order, so every operator reads them from one place.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must match the original pipeline's results) -------------
RADIUS_M = 50.0            # a ping within 50 m of a stop counts as "at" the stop
METRES_PER_DEG_LAT = 111000.0
METRES_PER_DEG_LON = 81000.0
MATCH_WINDOW_S = 1800      # nearest schedule must lie within 30 minutes
ON_TIME_EARLY_MIN = 1      # up to 1 minute early ...
ON_TIME_LATE_MIN = 5       # ... and up to 5 minutes late is "on time"
BUNCH_FACTOR = 0.5         # headway < 0.5 x stop median  -> bunched
GAP_FACTOR = 1.5           # headway > 1.5 x stop median  -> gapped
HEADWAY_MIN_LO = 1         # headways outside 1..90 minutes are collection gaps
HEADWAY_MIN_HI = 90
HEADWAY_HIST_CAP = 40      # headway histogram shows <= 40 minutes
DELAY_CLIP_MIN = 15        # delay histogram clipped to +-15 minutes
MIN_STOP_ARRIVALS = 3      # stop tables need >= 3 arrivals
MIN_BUNCH_HEADWAYS = 50    # bunching table needs >= 50 headways per route
MIN_ROUTE_ARRIVALS = 100   # worst-route table needs >= 100 arrivals
DQ_DELAY_RANGE = (-30, 30)
DQ_PCT_RANGE = (0, 100)
COLOR_LO_Q = 0.10          # map colour scale spans the 10th..90th percentile
COLOR_HI_Q = 0.90
COLOR_WORST = (218, 41, 28)    # red: unreliable
COLOR_BEST = (31, 158, 140)    # teal: reliable
DEFAULT_HOURS = (6, 20)    # dashboard default hour-of-arrival filter
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class ScaleConfig:
    """Knobs that decide physical strategy, not results."""

    # broadcast the (route, grid-cell) stop table only below this many bytes
    broadcast_max_bytes: int = 64_000_000
    # an as-of key (route, stop, time bucket) holding more arrivals than this
    # is split into salted sub-partitions, each with its own schedule copy
    asof_skew_rows: int = 2_000_000
    # as-of time bucket (>= 2 x match window); timetable rows within a window
    # of a bucket edge are copied into the neighbouring bucket
    asof_bucket_s: int = 14_400
    # headway lag windows are computed per (group, time chunk) so one busy
    # stop never lands in one task; chunk length in seconds
    headway_chunk_s: int = 3_600


@dataclass(frozen=True)
class PipelineConfig:
    radius_m: float = RADIUS_M
    m_lat: float = METRES_PER_DEG_LAT
    m_lon: float = METRES_PER_DEG_LON
    window_s: int = MATCH_WINDOW_S
    target_route: str | None = None
    agency_tz: str | None = None
    wrap_midnight: bool = False
    by_service_date: bool = False
    early: int = ON_TIME_EARLY_MIN
    late: int = ON_TIME_LATE_MIN
    scale: ScaleConfig = field(default_factory=ScaleConfig)
