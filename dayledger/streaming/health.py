"""Freshness and held-threshold alerts over tables of stamps and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.functions import scalars as S


def freshness(df: DataFrame, stamp: str, now: Column, limit_s: float = 300.0,
              source_newest: Column | None = None) -> DataFrame:
    """Seconds since the newest stamp, and whether that is beyond the limit.

    With ``source_newest`` the alert fires only when the source itself moved after the newest
    stamp, so that an idle source does not alert.
    """
    newest = df.agg(F.max(stamp).alias("newest"))
    age = S.micros_between(F.col("newest"), now) / F.lit(1e6)
    late = age > F.lit(limit_s)
    if source_newest is not None:
        late = late & (source_newest > F.col("newest"))
    return newest.select("newest", age.alias("age_s"), F.coalesce(late, F.lit(True)).alias("alert"))


def threshold_held(df: DataFrame, series: str, time: str, value: str, limit: float, hold: str,
                   no_data: str = "ok") -> DataFrame:
    """Spans during which a metric stayed above its limit for at least ``hold``.

    A span starts at the first breach after the last sample within the limit. A sample without
    value is good (``ok``) or a breach (``alert``).

    The last good sample is found in three bounded steps: over the days of a series, over the
    minutes of a day, over the instants of a minute. Samples of one instant count as one row, so a
    busy series, day or instant never reaches one task whole.
    """
    above = F.coalesce(F.col(value) > limit, F.lit(no_data == "alert"))
    instants = df.groupBy(F.col(series), F.col(time).alias("_t")).agg(
        F.max(F.when(~above, F.col(time))).alias("_good"), F.count_if(above).alias("_n"),
        F.max(F.when(above, F.col(value))).alias("_v"))
    instants = instants.withColumns({"_day": F.date_trunc("day", "_t"), "_minute": F.date_trunc("minute", "_t")})

    def earlier(keys: list[str], step: str) -> DataFrame:
        """Newest good sample of each step, and of all steps before it within ``keys``."""
        before = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        newest = instants.groupBy(*keys, step).agg(F.max("_good").alias("_m"))
        return newest.select(*keys, step, F.max("_m").over(before).alias(f"{step}_before"))

    inside = Window.partitionBy(series, "_day", "_minute").orderBy("_t")
    traced = instants.withColumn("_last", F.max("_good").over(inside)).where("_n > 0")
    traced = traced.join(earlier([series, "_day"], "_minute"), [series, "_day", "_minute"])
    traced = traced.join(earlier([series], "_day"), [series, "_day"])
    since = F.coalesce("_last", "_minute_before", "_day_before").alias("_since")
    spans = traced.groupBy(series, since).agg(
        F.min("_t").alias("started_at"), F.max("_t").alias("last_seen_at"),
        F.sum("_n").cast("bigint").alias("samples"), F.max("_v").alias("peak"))
    length = F.expr(f"INTERVAL {hold}")
    held = spans.where(F.col("last_seen_at") >= F.col("started_at") + length)
    return held.select(series, "started_at", (F.col("started_at") + length).alias("fires_at"), "last_seen_at",
                       "samples", "peak")
