"""Daily-grain aggregates: every other period is derived from these."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import scalars as S


def count_and_sum(df: DataFrame, by: Sequence[str], count: str, amounts: Mapping[str, str] | None = None) -> DataFrame:
    """Rows and exact amount sums per group: {output: input amount column}."""
    sums = [S.sum_money(c).alias(out) for out, c in (amounts or {}).items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count), *sums)


def requests_day(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Requests per group with mean delay (answered ones only) and engaged amount."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_requests"),
        S.ratio(F.sum("delay_hours"), F.count("delay_hours")).cast("decimal(10,2)").alias("mean_delay_hours"),
        S.sum_money("amount").alias("engaged_amount"),
    )


def counts_by(df: DataFrame, by: Sequence[str], count: str, having: int | None = None) -> DataFrame:
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    return out if having is None else out.where(F.col(count) >= having)


def items_per_header(df: DataFrame, header: str, item: str, count: str, distinct: str) -> DataFrame:
    """Items and distinct item codes per header.

    Counting per (header, item) first keeps the distinct count skew-safe: both steps combine on
    the map side, and no set of codes is ever held in memory.
    """
    per_item = df.groupBy(header, item).agg(F.count(F.lit(1)).alias("_n"))
    return per_item.groupBy(header).agg(
        F.sum("_n").cast("bigint").alias(count), F.count(F.col(item)).alias(distinct))
