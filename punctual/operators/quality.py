"""Data-quality tests (D1-D4): not_null, unique, accepted_range and a suite
runner. Column tests on one table run as a single aggregate pass; the unique
test is one grouped aggregate. Results are a small DataFrame of
(model, column_name, test, violations)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    test: str
    column: str
    lo: float | None = None
    hi: float | None = None


def not_null(c: str) -> Check:
    return Check("not_null", c)


def unique(c: str) -> Check:
    return Check("unique", c)


def accepted_range(c: str, lo: float, hi: float) -> Check:
    """Inclusive bounds; NULL passes."""
    return Check("accepted_range", c, lo, hi)


def _violation(ch: Check) -> F.Column:
    c = F.col(ch.column)
    if ch.test == "not_null":
        bad = c.isNull()
    elif ch.test == "accepted_range":
        bad = (c < F.lit(ch.lo)) | (c > F.lit(ch.hi))
    else:
        raise ValueError(ch.test)
    return F.sum(F.when(bad, 1).otherwise(0)).cast("long")


def run_checks(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """Violations per check. Row checks share one aggregate over ``df``; a
    unique check is a second pass, so persist ``df`` when it is costly."""
    row_checks = [c for c in checks if c.test != "unique"]
    parts = []
    if row_checks:
        g = df.agg(*[_violation(c).alias(f"_v{i}") for i, c in enumerate(row_checks)])
        stack = F.explode(F.array(*[
            F.struct(F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"),
                     F.coalesce(F.col(f"_v{i}"), F.lit(0).cast("long")).alias("violations"))
            for i, c in enumerate(row_checks)]))
        parts.append(g.select(stack.alias("r")).select("r.*"))
    for c in checks:
        if c.test == "unique":
            dup = (df.where(F.col(c.column).isNotNull()).groupBy(c.column).count()
                   .where(F.col("count") > 1)
                   .agg(F.count(F.lit(1)).alias("violations")))
            parts.append(dup.select(F.lit(c.column).alias("column_name"),
                                    F.lit("unique").alias("test"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(model).alias("model"), "column_name", "test", "violations")


class DataQualityError(RuntimeError):
    pass


def assert_passing(results: DataFrame) -> None:
    """Raise when any check has violations (the suite's fail step)."""
    bad = results.where(F.col("violations") > 0).collect()  # one row per declared check
    if bad:
        raise DataQualityError("; ".join(
            f"{r.model}.{r.column_name} {r.test}: {r.violations}" for r in bad))
