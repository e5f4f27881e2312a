"""Join helpers: size-checked broadcast and a skew-safe two-sided as-of join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast ``df`` only when its size is proven <= ``max_bytes``.

    The side is computed once into a reliable checkpoint (the shared folder
    of ``spark.checkpoint.dir``); the size (bytes of the rows as JSON text) and
    the join both read it, so the side is neither recomputed nor lost with an
    executor. Above the bound the checkpointed DataFrame is returned un-hinted
    and Spark shuffles both sides on the join keys (AQE splits skewed
    partitions). It is not left cached: a cached relation inside a plan blocks
    exchange reuse between the plan's branches. The check is a job that runs
    while the frame is built.
    """
    from ..session import shared_dir
    shared_dir(df.sparkSession)           # checkpoint folder (set only when unset)
    cached = df.persist()
    side = cached.checkpoint(eager=True)
    cached.unpersist()
    size = side.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(side) if size <= max_bytes else side


def nearest_asof(left: DataFrame, right: DataFrame, keys: list[str], left_t: str,
                 right_t: str, right_payload: list[str], window: int | None,
                 skew_rows: int, salt_cols: list[str], bucket_s: int = 14_400,
                 right_tiebreak: list | None = None) -> DataFrame:
    """For each left row, the right rows nearest in time on the same keys.

    Returns the left rows (only those with a right row within ``window``
    seconds when a window is given) with ``_prev`` / ``_next``: structs
    (``t`` + ``right_payload``) of the latest right row at or before and the
    earliest at or after the left time. Among right rows with equal time the
    smallest by ``right_tiebreak`` (columns, ascending, NULL first) is taken. The
    caller picks between ``_prev`` and ``_next``.

    Physical plan: left and right rows are unioned and every partition is
    scanned twice in time order (ascending, then descending) with a running
    ``last(..., ignorenulls)``; no pair of rows is ever built and no
    ``unboundedFollowing`` frame is used. With a ``window`` the partition key
    adds a time bucket of ``bucket_s`` seconds; a right row is copied into
    every bucket whose left rows can reach it (its own, and a neighbour when
    it lies within ``window`` of the edge: about 1 + 2 * window / bucket_s
    copies). Buckets holding more than ``skew_rows`` left rows are salted:
    their left rows are hashed into ``ceil(n / skew_rows)`` sub-partitions and
    the bucket's right rows are copied into each (callers pass distinct right
    points, so a bucket has at most one per second and payload). The hot-bucket
    table has at most (left rows / skew_rows) rows of four short columns: with
    skew_rows = 2,000,000 a million million left rows give 500,000 of them,
    about 20 MB, which is the bound on what is broadcast.
    """
    lt, rt = F.col(left_t), F.col(right_t)
    if window:
        if bucket_s < 2 * window:
            raise ValueError("bucket_s must be at least twice the window")
        bk = lambda c: F.floor(c / F.lit(bucket_s)).cast("long")
        left = left.withColumn("_bk", bk(lt))
        right = right.withColumn("_bk", F.explode(F.array_distinct(F.array(
            bk(rt - F.lit(window)), bk(rt), bk(rt + F.lit(window))))))
    else:
        left = left.withColumn("_bk", F.lit(0).cast("long"))
        right = right.withColumn("_bk", F.lit(0).cast("long"))
    pkeys = keys + ["_bk"]

    hot = (left.groupBy(*pkeys).count()
           .where(F.col("count") > F.lit(skew_rows))
           .select(*pkeys, F.ceil(F.col("count") / F.lit(skew_rows)).cast("int").alias("_ns")))
    hot = F.broadcast(hot)
    left = (left.join(hot, pkeys, "left")
            .withColumn("_salt", F.when(F.col("_ns").isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(*salt_cols), F.col("_ns")).cast("int")))
            .drop("_ns"))
    right = (right.join(hot, pkeys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0),
                                                       F.coalesce(F.col("_ns"), F.lit(1)) - 1)))
             .drop("_ns"))
    pkeys = pkeys + ["_salt"]

    ties = list(right_tiebreak or [])
    tie_names = [f"_tb{i}" for i in range(len(ties))]
    payload = F.struct(rt.alias("t"), *[F.col(c) for c in right_payload])
    r = right.select(*pkeys, rt.alias("_t"), F.lit(0).alias("_kind"), payload.alias("_r"),
                     *[e.alias(n) for e, n in zip(ties, tie_names)])
    lcols = [c for c in left.columns if c not in pkeys]
    l_ = left.select(*pkeys, lt.alias("_t"), F.lit(1).alias("_kind"),
                     F.lit(None).cast(r.schema["_r"].dataType).alias("_r"),
                     *[F.lit(None).cast(r.schema[n].dataType).alias(n) for n in tie_names],
                     F.struct(*[F.col(c) for c in lcols]).alias("_l"))
    u = r.withColumn("_l", F.lit(None).cast(l_.schema["_l"].dataType)).unionByName(l_)
    # at equal time: right rows before left rows; among right rows the
    # preferred one last, so the running ``last`` lands on it
    prefer_last = [F.col(n).desc_nulls_last() for n in tie_names]
    frame = (Window.unboundedPreceding, Window.currentRow)
    up = Window.partitionBy(*pkeys).orderBy(
        F.col("_t").asc(), F.col("_kind").asc(), *prefer_last).rowsBetween(*frame)
    down = Window.partitionBy(*pkeys).orderBy(
        F.col("_t").desc(), F.col("_kind").asc(), *prefer_last).rowsBetween(*frame)
    u = (u.withColumn("_prev", F.last("_r", ignorenulls=True).over(up))
          .withColumn("_next", F.last("_r", ignorenulls=True).over(down))
          .where(F.col("_kind") == 1))
    out = u.select(*keys, F.col("_l.*"), "_prev", "_next")
    if window:
        t = F.col(left_t)
        ok_prev = F.col("_prev").isNotNull() & (t - F.col("_prev.t") <= window)
        ok_next = F.col("_next").isNotNull() & (F.col("_next.t") - t <= window)
        out = (out.withColumn("_prev", F.when(ok_prev, F.col("_prev")))
                  .withColumn("_next", F.when(ok_next, F.col("_next")))
                  .where(F.col("_prev").isNotNull() | F.col("_next").isNotNull()))
    return out


def pick_nearest(df: DataFrame, left_t: str) -> DataFrame:
    """Collapse ``_prev`` / ``_next`` into ``_m``: nearer wins, tie -> earlier."""
    t = F.col(left_t)
    dp = t - F.col("_prev.t")
    dn = F.col("_next.t") - t
    use_prev = F.col("_next").isNull() | (F.col("_prev").isNotNull() & (dp <= dn))
    return (df.withColumn("_m", F.when(use_prev, F.col("_prev")).otherwise(F.col("_next")))
              .drop("_prev", "_next"))
