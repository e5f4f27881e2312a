"""Derived flags and presentation columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def on_time_flag(delay_minutes, early: float = 1, late: float = 5) -> Column:
    """1 when -early <= delay <= late (inclusive both ends), else 0."""
    c = delay_minutes if isinstance(delay_minutes, Column) else F.col(delay_minutes)
    return F.when(c.between(-early, late), 1).otherwise(0)


def delay_state(delay_minutes, early: float = 1, late: float = 5) -> Column:
    """Right-closed bins: Early (d <= -early], On time (-early, late], Late."""
    c = delay_minutes if isinstance(delay_minutes, Column) else F.col(delay_minutes)
    return (F.when(c <= -early, "Early")
             .when(c <= late, "On time")
             .when(c > late, "Late"))


def clip(c: Column, lo: float, hi: float) -> Column:
    """c limited to lo..hi; NULL stays NULL (least and greatest skip NULLs)."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(hi)), F.lit(lo)))


def robust_score(x: Column, lo: Column, hi: Column) -> Column:
    """clip((x - lo) / max(hi - lo, 1e-9), 0, 1)."""
    span = F.greatest(hi - lo, F.lit(1e-9))
    return clip((x - lo) / span, 0.0, 1.0)


def lerp_int(a: int, b: int, t: Column) -> Column:
    """int(a + (b - a) * t), truncating toward zero."""
    return (F.lit(float(a)) + F.lit(float(b - a)) * t).cast("int")
