"""Periods, break-downs, totals and rates derived from the daily grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions import scalars as S


def additive(df: DataFrame, by: Sequence[str | Column], counts: Mapping[str, str] | None = None,
             amounts: Mapping[str, str] | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Re-sum additive measures of a daily table at any coarser grain: {output: input}."""
    aggs = [F.sum(c).cast("bigint").alias(out) for out, c in (counts or {}).items()]
    aggs += [S.sum_money(c).alias(out) for out, c in (amounts or {}).items()]
    return df.groupBy(*by).agg(*aggs, *extra)


def weekly(df: DataFrame, counts: Mapping[str, str], amounts: Mapping[str, str], by: Sequence[str] = (),
           extra: Sequence[Column] = ()) -> DataFrame:
    """Monday weeks from days."""
    return additive(df, [S.week_start("jour").alias("week"), *by], counts, amounts, extra)


def monthly_closed(df: DataFrame, as_of: str, counts: Mapping[str, str], amounts: Mapping[str, str],
                   by: Sequence[str] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """Months that ended before ``as_of``. The filter is on the raw day, so it prunes partitions."""
    closed = df.where(S.closed_months("jour", as_of))
    return additive(closed, [S.month_start("jour").alias("month"), *by], counts, amounts, extra)


def grand_totals(df: DataFrame, counts: Mapping[str, str], amounts: Mapping[str, str]) -> DataFrame:
    return additive(df, [], counts, amounts)


def coverage_rate(df: DataFrame, part: str, whole: str, alias: str, by: Sequence[str | Column] = ()) -> DataFrame:
    """100 * sum(part) / sum(whole), one decimal: ratio of sums, never a mean of ratios."""
    return df.groupBy(*by).agg(S.percent(F.sum(part), F.sum(whole)).alias(alias))


def response_rate(df: DataFrame, count: str, status: str = "status_code", by: Sequence[str] = (),
                  alias: str = "response_rate") -> DataFrame:
    """Answered share of requests in percent."""
    answered = F.sum(F.when(F.col(status) != S.UNANSWERED, F.col(count)).otherwise(0))
    return df.groupBy(*by).agg(S.percent(answered, F.sum(count)).alias(alias))


def distinct_over(df: DataFrame, column: str, alias: str, by: Sequence[str | Column] = (),
                  approximate: bool = False) -> DataFrame:
    """Exact distinct members at the grain asked for (never summed from days).

    Two combining aggregations instead of one set per group, so a group holding a large share of
    all rows is spread over (group, member).
    """
    if approximate:
        return df.groupBy(*by).agg(F.approx_count_distinct(column).alias(alias))
    grouping = [F.col(b) if isinstance(b, str) else b for b in by]
    keyed = df.select(*[g.alias(f"_g{i}") for i, g in enumerate(grouping)], F.col(column).alias("_v"))
    names = [f"_g{i}" for i in range(len(grouping))]
    once = keyed.where(F.col("_v").isNotNull()).groupBy(*names, "_v").agg(F.lit(1).alias("_one"))
    out = once.groupBy(*names).agg(F.count(F.lit(1)).alias(alias))
    labels = df.select(*grouping).columns if grouping else []
    for name, label in zip(names, labels):
        out = out.withColumnRenamed(name, label)
    return out


def headcount_by_period(dim: DataFrame, periods: DataFrame, alias: str, condition: Column | None = None) -> DataFrame:
    """A present-day head-count repeated on every period (it is not an activity of the period)."""
    total = dim.agg(F.count(F.lit(1) if condition is None else F.when(condition, 1)).alias(alias))
    return periods.select("*", total.scalar().alias(alias))


def suppress_small_groups(df: DataFrame, measure: str, k: int = 5) -> DataFrame:
    """Confidentiality threshold: groups counting fewer than k rows are not shown.

    Apply at the displayed grain; re-aggregating suppressed rows would under-count.
    """
    return df.where(F.col(measure) >= k)


def group_rate(df: DataFrame, by: Sequence[str], condition: Column, total: str, hits: str, rate: str) -> DataFrame:
    """Rows, rows meeting a condition, and their share in percent."""
    hit = F.count(F.when(condition, 1))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias(total), hit.alias(hits), S.percent(hit, F.count(F.lit(1))).alias(rate))


def group_mean(df: DataFrame, by: Sequence[str], value: str, total: str, sum_alias: str, mean: str) -> DataFrame:
    """Rows, summed value and value per row (two decimals)."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias(total), F.sum(value).cast("bigint").alias(sum_alias),
        S.ratio(F.sum(value), F.count(F.lit(1))).alias(mean))
