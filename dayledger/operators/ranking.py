"""Top-n, numbering and exact order statistics without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_with_ties(df: DataFrame, measure: str, n: int, by: Sequence[str] = (), rank: str = "rang") -> DataFrame:
    """Rows with RANK <= n on ``measure`` descending, all ties included, overall or per group.

    Ranks are worked out on the n best distinct values, which every partition trims to n before
    any shuffle; the join back then lets a value shared by many rows through whole. No task sorts
    a group. ``df`` stands twice in one lazy plan, which shares its shuffles.
    """
    by = list(by)
    values = df.where(F.col(measure).isNotNull()).groupBy(*by, measure).agg(F.count(F.lit(1)).alias("_ties"))
    if by:
        best = Window.partitionBy(*by).orderBy(F.col(measure).desc())
        values = values.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= n).drop("_r")
        before = best.rowsBetween(Window.unboundedPreceding, -1)
    else:
        values = values.orderBy(F.col(measure).desc()).limit(n)
        before = Window.orderBy(F.col(measure).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.withColumn(rank, (F.coalesce(F.sum("_ties").over(before), F.lit(0)) + 1).cast("int"))
    ranked = ranked.where(F.col(rank) <= n).drop("_ties")
    return df.join(ranked, [*by, measure], "inner").select(*df.columns, rank)


def top_n_strict(df: DataFrame, measure: str, tiebreak: str | Sequence[str], n: int) -> DataFrame:
    """Exactly n rows, ties broken by code: each partition keeps n, one task merges those."""
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    return df.orderBy(F.col(measure).desc(), *[F.col(t).asc() for t in ties]).limit(n)


def newest(df: DataFrame, time: str, tiebreak: Sequence[str], n: int) -> DataFrame:
    """The n latest rows."""
    return df.orderBy(F.col(time).desc(), *[F.col(t).asc() for t in tiebreak]).limit(n)


def running_total(df: DataFrame, by: Sequence[str], slice_: Column, order: Sequence[str | Column], value: Column, alias: str) -> DataFrame:
    """Inclusive running sum of ``value`` per group in a total order, lazily and in parallel.

    ``slice_`` cuts the order into consecutive stretches (a day of a time, the upper digits of a number):
    it rises with the order's first column. A window runs inside each slice; what lies before comes from
    one sum per slice. A NULL slice comes first.
    """
    by = list(by)
    rows = df.withColumns({"_slice": slice_, "_value": value})
    sums = rows.groupBy(*by, "_slice").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy(F.col("_slice").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(b).alias(f"_b{i}") for i, b in enumerate(by)], F.col("_slice").alias("_s"),
                         F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    same = F.col("_slice").eqNullSafe(F.col("_s"))
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_b{i}"))
    inside = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(starts, same).select(*df.columns, (F.col("_start") + F.sum("_value").over(inside)).cast("bigint").alias(alias))


def row_numbers(df: DataFrame, by: Sequence[str], slice_: Column, order: Sequence[str | Column], alias: str = "k") -> DataFrame:
    """1-based position per group in a total order (see ``running_total``)."""
    return running_total(df, by, slice_, order, F.lit(1), alias)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, quantiles: dict[str, tuple[float, str]]) -> DataFrame:
    """Exact quantiles of a BIGINT column per group: {output: (q, method)}, with n, min, max and sum.

    The sum is a DECIMAL(38,0): that of a few million delays in microseconds is beyond a BIGINT, and so
    is what adds up on the way to it when negative values come first.

    ``linear`` interpolates between the two neighbours; ``lower`` takes the element at
    floor(q * (n - 1)). Rows shrink to counts per value first. The position of a value is then the
    sum of three running counts: over value >> 32 in the group, over value >> 16 in that, over the
    values in that. The last two see at most 65536 rows, so no task ever orders a whole group.
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("bigint").alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumns({"_far": F.shiftright("_v", 32), "_near": F.shiftright("_v", 16)})

    def running(keys: list[str], step: str):
        return Window.partitionBy(*(keys or [F.lit(0)])).orderBy(step).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)

    near = counts.groupBy(*by, "_far", "_near").agg(
        F.sum("_c").alias("_c"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.sum(F.col("_v").cast("decimal(19,0)") * F.col("_c")).alias("sum"))
    far = near.groupBy(*by, "_far").agg(
        F.sum("_c").alias("_c"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum("sum").alias("sum"))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    far = far.select(
        *by, "_far", (F.sum("_c").over(running(by, "_far")) - F.col("_c")).alias("_far_start"), F.sum("_c").over(group).alias("n"),
        F.min("min").over(group).alias("min"), F.max("max").over(group).alias("max"), F.sum("sum").over(group).alias("sum"))
    near_start = F.sum("_c").over(running([*by, "_far"], "_near")) - F.col("_c")
    near = near.select(*by, "_far", "_near", near_start.alias("_near_start")).join(far, [*by, "_far"])
    inside = F.sum("_c").over(running([*by, "_far", "_near"], "_v"))
    placed = counts.withColumn("_to", inside).join(near, [*by, "_far", "_near"])
    placed = placed.withColumn("_to", F.col("_to") + F.col("_far_start") + F.col("_near_start"))
    placed = placed.withColumn("_from", F.col("_to") - F.col("_c"))

    def holds(position):
        return (position >= F.col("_from")) & (position < F.col("_to"))

    figures = []
    needed = F.lit(False)
    for name, (q, method) in quantiles.items():
        at = F.lit(float(q)) * (F.col("n") - 1)
        lower, upper = F.floor(at), F.ceil(at) if method == "linear" else F.floor(at)
        up = (at - lower) if method == "linear" else F.lit(0.0)
        needed = needed | holds(lower) | holds(upper)
        share = F.when(holds(lower), 1 - up).otherwise(0.0) + F.when(holds(upper), up).otherwise(0.0)
        figures.append(F.sum(F.col("_v") * share).alias(name))
    return placed.where(needed).groupBy(*by).agg(*[F.max(s).alias(s) for s in ("n", "min", "max", "sum")], *figures)
