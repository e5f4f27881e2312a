"""Incremental marts from stored aggregates.

The state is a log table with the mergeable aggregates of every (day, route,
stop name, direction). A refresh finds the days whose fact rows changed since the
fact version it last saw, aggregates only those days' rows anew and replaces
their states in one commit that also records the fact version. The mart is the
merge of the days' states; the fact is not read for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ON_TIME_EARLY_MIN, ON_TIME_LATE_MIN
from ..operators import reliability as rel
from ..sinks.tablelog import LogTable, Version, _names

MICROS_A_DAY = 86_400_000_000


def day_of(c: str) -> Column:
    """Number of the UTC day, whatever the session's zone."""
    return F.floor(F.unix_micros(c) / MICROS_A_DAY).cast("long")


class DailyMart:
    """The reliability mart over a fact log table whose ``stats`` hold ``time``.

    One process refreshes a mart at a time; readers may read meanwhile. Rows
    without a time make a day of their own.
    """

    def __init__(self, spark: SparkSession, path: str, facts: LogTable, time: str = "actual_arrival",
                 early: float = ON_TIME_EARLY_MIN, late: float = ON_TIME_LATE_MIN):
        self.spark, self.facts, self.time, self.early, self.late = spark, facts, time, early, late
        self.state = LogTable(spark, path, ["day", *rel.MART_KEY], ["day"])

    def _files(self, v: Version, runs) -> set[str]:
        found = self.facts.files(Version(v.number, v.schema, tuple(runs), v.txns))
        return set() if found is None else {r.file for r in found.select("file").collect()}

    def changed_days(self, old: Version, new: Version) -> list[int | None]:
        """Days whose rows differ between two fact versions: rows of added and of
        removed files are compared by a count and an exclusive-or of hashes for
        each day, so rows that were only moved to another file cancel out."""
        before = self._files(old, [r for r in old.runs if r not in new.runs])
        after = self._files(new, [r for r in new.runs if r not in old.runs])

        def digest(files: set[str], name: str) -> DataFrame:
            df = self.facts._load(sorted(files), new.schema)
            cells = [x for c in df.columns for x in (F.col(c), F.col(c).isNull())]
            return df.groupBy(day_of(self.time).alias(f"{name}_day")).agg(
                F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*cells)), F.bit_xor(F.xxhash64(F.lit(7), *cells))).alias(name))

        a, b = digest(before - after, "a"), digest(after - before, "b")
        j = a.join(b, F.col("a_day").eqNullSafe(F.col("b_day")), "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        # a row per day of the calendar
        return sorted((r[0] for r in j.select(F.when(F.col("b").isNotNull(), F.col("b_day")).otherwise(F.col("a_day"))).collect()),
                      key=lambda d: (d is None, d))

    def rows_of(self, v: Version, days: list[int | None]) -> DataFrame:
        """Fact rows of some days, from the files that can hold them."""
        wanted = F.broadcast(self.spark.createDataFrame([(d,) for d in days], "wanted long"))
        found = self.facts.files(v)
        if found is not None and None not in days:  # the files' bounds tell nothing about nulls
            found = found.join(wanted, (day_of(f"hi.{self.time}") >= F.col("wanted")) & (day_of(f"lo.{self.time}") <= F.col("wanted")), "left_semi")
        files = [] if found is None else sorted(r.file for r in found.select("file").collect())
        return self.facts._load(files, v.schema).join(wanted, day_of(self.time).eqNullSafe(F.col("wanted")), "left_semi")

    def refresh(self) -> list[int | None] | None:
        """Bring the state to the fact's last version; the days that were
        aggregated anew, None for all of them (first run, or files of the version
        seen before are gone)."""
        new, seen = self.facts.version(), self.state.version().txns.get("fact", 0)
        if new.number == seen:
            return []
        days = None
        if seen:
            old = self.facts.version(seen)
            there = set(_names(self.spark, f"{self.facts.path}/data"))
            if all(r["run"] in there for r in old.runs):
                days = self.changed_days(old, new)
        rows = self.facts.read(new.number) if days is None else self.rows_of(new, days)
        parts = rows.groupBy(day_of(self.time).alias("day"), *rel.MART_KEY).agg(*rel.mart_sums(self.early, self.late))
        told = ("fact", new.number)
        if days is None:
            self.state.replace(parts, txn=told)
        else:
            known = [d for d in days if d is not None]
            held = self.state.read(between={"day": (known[0], known[-1])} if known and None not in days else None)
            wanted = F.broadcast(self.spark.createDataFrame([(d,) for d in days], "wanted long"))
            self.state.upsert(parts, held.join(wanted, F.col("day").eqNullSafe(F.col("wanted")), "left_semi"), txn=told)
        return days

    def read(self) -> DataFrame | None:
        """The mart, equal to ``reliability.route_reliability`` of the fact version
        last seen; None before the first refresh."""
        parts = self.state.read()
        return None if parts is None else rel.finish_mart(rel.merge_mart(parts))
