"""Detection recall, arrival matching, delay and recovery figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.functions import scalars as S
from dayledger.operators.ranking import exact_quantiles
from dayledger.operators.reshape import stack


# -- recall ------------------------------------------------------------------------------------


def _pairs(injected: DataFrame, detected: DataFrame) -> DataFrame:
    """One row per (code, key) of either side, with what each side holds."""
    both = stack([
        injected.select("code", "key", F.lit(1).alias("_inj"), F.lit(0).alias("_det")),
        detected.select("code", "key", F.lit(0).alias("_inj"), F.lit(1).alias("_det"))])
    return both.groupBy("code", "key").agg(F.max("_inj").alias("inj"), F.max("_det").alias("det"))


def recall_by_code(injected: DataFrame, detected: DataFrame, total: str = "TOTAL") -> DataFrame:
    """Per injected code: injected, found, recall %, surplus detections; plus a total row.

    Both sides are sets of (code, key). An injected row without key counts as injected and is never found.
    """
    inj, det = F.col("inj"), F.col("det")
    per_code = _pairs(injected, detected).groupBy("code").agg(
        F.sum("inj").alias("injected"), F.sum(inj * det).alias("found"), F.sum((1 - inj) * det).alias("surplus"))
    per_code = per_code.where("injected > 0")
    out = per_code.rollup("code").agg(
        F.grouping("code").alias("_all"), *[F.sum(c).cast("bigint").alias(c) for c in ("injected", "found", "surplus")])
    # An empty journal gives no total row.
    out = out.where(F.col("injected").isNotNull())
    return out.select(
        F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col("code")).alias("code"),
        "injected", "found", S.percent(F.col("found"), F.col("injected")).alias("recall_pct"), "surplus")


def codes_never_injected(injected: DataFrame, detected: DataFrame) -> DataFrame:
    """Detections whose code the journal does not hold: completeness checks or false positives."""
    per_code = _pairs(injected, detected).groupBy("code").agg(
        F.sum("inj").alias("_i"), F.sum("det").cast("bigint").alias("detected"))
    return per_code.where("_i = 0").drop("_i")


def recall_with_cause(injected: DataFrame, detected: DataFrame, not_covered: Sequence[str]) -> DataFrame:
    """Per code: injected, found, caught under another reason, without key, recall, coverage.

    ``injected`` rows count one each (a key may be NULL or empty); they are reduced to counts per
    (code, key) first, so that the rows without key become one row per code before any join.
    """
    counted = injected.withColumn("key", F.nullif("key", F.lit(""))).groupBy("code", "key").agg(
        F.count(F.lit(1)).alias("n"))
    pairs = detected.where(F.col("key").isNotNull()).select("code", "key").distinct()
    keys = pairs.select("key").distinct().withColumn("_any", F.lit(True))
    j = counted.join(pairs.withColumn("_exact", F.lit(True)), ["code", "key"], "left").join(keys, "key", "left")
    no_key = F.col("key").isNull()
    found = F.coalesce("_exact", F.lit(False)) & ~no_key
    other = ~found & F.coalesce("_any", F.lit(False)) & ~no_key
    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("bigint")
    out = j.groupBy("code").agg(
        F.sum("n").cast("bigint").alias("injected"), total(found).alias("found"),
        total(other).alias("other_reason"), total(no_key).alias("without_key"))
    return out.withColumns({
        "recall_pct": S.percent(F.col("found"), F.col("injected")),
        "covered": ~F.col("code").isin(list(not_covered))})


def covered_recall(report: DataFrame) -> DataFrame:
    """Recall over the covered codes alone."""
    return report.where("covered").agg(
        F.sum("injected").cast("bigint").alias("injected"), F.sum("found").cast("bigint").alias("found"),
        S.percent(F.sum("found"), F.sum("injected")).alias("recall_pct"))


# -- delays ------------------------------------------------------------------------------------


def first_sample_at_or_above(wanted: DataFrame, samples: DataFrame, threshold: str, counter: str, time: str,
                             alias: str = "seen_at", width: int = 65536) -> DataFrame:
    """For each threshold, the time of the first sample whose counter reached it (NULL if none).

    Thresholds are unique BIGINTs. Samples shrink to one row per counter value, so a slice of
    ``width`` counter values has at most ``2 * width`` rows: the running minimum is taken inside
    slices, and the minimum of all higher slices is added in two more levels of the same width.
    """
    per_count = samples.groupBy(F.col(counter).cast("bigint").alias("_c")).agg(F.min(time).alias("_t"))
    slice_of = F.floor(F.col("_c") / width)
    points = per_count.withColumn("_wanted", F.lit(False)).unionByName(
        wanted.select(F.col(threshold).cast("bigint").alias("_c"), F.lit(None).cast(
            per_count.schema["_t"].dataType).alias("_t"), F.lit(True).alias("_wanted")))
    points = points.withColumn("_slice", slice_of)
    near = points.groupBy("_slice").agg(F.min("_t").alias("_m")).withColumn("_far", F.floor(F.col("_slice") / width))
    far = near.groupBy("_far").agg(F.min("_m").alias("_m"))
    beyond = Window.orderBy(F.col("_far").desc()).rowsBetween(Window.unboundedPreceding, -1)
    far = far.select("_far", F.min("_m").over(beyond).alias("_beyond"))
    later = Window.partitionBy("_far").orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = near.withColumn("_later", F.min("_m").over(later)).join(far, "_far").select(
        "_slice", F.least("_later", "_beyond").alias("_carry"))
    # Samples sort before the threshold of the same value: reaching it counts.
    inside = Window.partitionBy("_slice").orderBy(F.col("_c").desc(), "_wanted").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    timed = points.withColumn("_in", F.min("_t").over(inside)).where("_wanted")
    seen = timed.join(carry, "_slice").select(
        F.col("_c").alias("_key"), F.least("_in", "_carry").alias(alias))
    return wanted.join(seen, F.col(threshold).cast("bigint") == F.col("_key"), "left").drop("_key")


def kth_arrival(numbered: DataFrame, samples: DataFrame, start: int, created: str, counter: str, time: str) -> DataFrame:
    """Delay of the k-th arrival: first sample with counter >= start + k. Unseen arrivals go.

    ``numbered`` has ``k`` (see ``ranking.row_numbers``) and the creation time.
    """
    wanted = numbered.withColumn("_need", F.col("k") + F.lit(start))
    seen = first_sample_at_or_above(wanted, samples, "_need", counter, time).where(F.col("seen_at").isNotNull())
    return seen.drop("_need").withColumn("delay_us", S.micros_between(created, "seen_at"))


def latency_summary(df: DataFrame, delay_us: str, by: Sequence[str] = ()) -> DataFrame:
    """n, mean, median, p95 (linear interpolation), min and max, in seconds."""
    figures = exact_quantiles(df, by, delay_us, {"median_s": (0.5, "linear"), "p95_s": (0.95, "linear")})
    us = F.lit(1e6)
    return figures.select(
        *by, "n", (F.col("sum").cast("double") / F.col("n") / us).alias("mean_s"), (F.col("min") / us).alias("min_s"),
        (F.col("max") / us).alias("max_s"), (F.col("median_s") / us).alias("median_s"), (F.col("p95_s") / us).alias("p95_s"))


def throughput(events: Column, start: Column, end: Column) -> Column:
    """Events per second over a span, the span counted as one second at least."""
    return events / F.greatest(S.micros_between(start, end) / F.lit(1e6), F.lit(1.0))


def stage_delays(events: DataFrame, created: str, published_ms: str | Column = "published_ms") -> DataFrame:
    """(stage, delay_us) rows of the create events: commit, read, publish and the total.

    ``events`` is the decoded envelope with ``published_ms`` added.
    """
    publish = F.col(published_ms) if isinstance(published_ms, str) else published_ms
    made = S.iso_to_epoch_ms(f"after.{created}")
    spans = {
        "commit": F.col("source.ts_ms") - made, "read": F.col("ts_ms") - F.col("source.ts_ms"),
        "publish": publish - F.col("ts_ms"), "total": publish - made,
    }
    wide = events.where(F.col("op") == "c").select(
        *[F.round(ms * 1000.0).cast("bigint").alias(stage) for stage, ms in spans.items()])
    return wide.unpivot([], list(spans), "stage", "delay_us")


def stage_latency(delays: DataFrame) -> DataFrame:
    """Per stage: n, median, p95 (the element at floor(0.95 * (n - 1))) and max, in ms."""
    figures = exact_quantiles(delays, ["stage"], "delay_us", {"median_ms": (0.5, "linear"), "p95_ms": (0.95, "lower")})
    ms = F.lit(1000.0)
    return figures.select("stage", "n", (F.col("max") / ms).alias("max_ms"), (F.col("median_ms") / ms).alias("median_ms"),
                          (F.col("p95_ms") / ms).alias("p95_ms"))


def recovery_summary(probes: DataFrame, invoices: int | Column, services: int | Column, expected_events: int | Column,
                     relaunched_at: float, running_at: float) -> DataFrame:
    """Replay figures from probe rows (t_s, invoices, services, events_read).

    Low-water mark of the totals, time of equality with the source, end of replay (all events read
    and totals equal), recovery time and events per second.
    """
    equal = (F.col("invoices") == invoices) & (F.col("services") == services) & (F.col("t_s") >= running_at)
    done = equal & (F.col("events_read") >= expected_events)
    marks = probes.agg(
        F.min(F.when(equal, F.col("t_s"))).alias("equal_at_s"),
        F.min(F.when(done, F.col("t_s"))).alias("done_at_s"),
        F.min_by(F.when(done, F.col("events_read")), F.when(done, F.col("t_s"))).alias("events_read"))
    end = marks.select("done_at_s").scalar()
    low = probes.where(end.isNull() | (F.col("t_s") <= end)).agg(
        F.min(F.struct("invoices", "services")).alias("_low"))
    span = F.greatest(F.col("done_at_s") - running_at, F.lit(1.0))
    lowest = low.scalar()
    return marks.select(
        "equal_at_s", "done_at_s", (F.col("done_at_s") - relaunched_at).alias("recovery_s"), "events_read",
        (F.col("events_read") / span).alias("events_per_s"),
        lowest["invoices"].alias("lowest_invoices"),
        lowest["services"].alias("lowest_services"))
