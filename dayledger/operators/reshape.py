"""Long form, matrices, cross-tabs, set operations and JSON to columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_form(df: DataFrame, by: str, indicators: Mapping[str, Column], name: str = "indicateur",
              value: str = "valeur", kind: str = "decimal(28,2)") -> DataFrame:
    """(by, indicator, value) rows: all indicators in one aggregation, then an unpivot.

    An indicator without any row on a day stays, with a NULL value.
    """
    wide = df.groupBy(by).agg(*[expr.cast(kind).alias(label) for label, expr in indicators.items()])
    return wide.unpivot([by], list(indicators), name, value)


def matrix(long: DataFrame, rows: str, column: str | Column, value: str, periods: Sequence[str], rest: str = "autres") -> DataFrame:
    """Indicator rows by period columns. The periods are given, so no extra job looks for them; values of
    any other period, or of none, go to the column ``rest``."""
    period = F.col(column) if isinstance(column, str) else column
    known = F.when(period.isin(list(periods)), period).otherwise(F.lit(rest))
    return long.withColumn("_p", known).groupBy(rows).pivot("_p", [*periods, rest]).agg(F.sum(value))


def cross_tab(df: DataFrame, row: str, column: str, measure: str | Column, values: Sequence[str],
              total: str = "total", rest: str = "autres") -> DataFrame:
    """Row x column table with a total column and a total row, in one pass over the data. What has none
    of the given ``values`` counts in the column ``rest``, so cells always add up to the total."""
    m = F.col(measure) if isinstance(measure, str) else measure
    zero = F.lit(0)
    cells = [F.coalesce(F.sum(F.when(F.col(column) == v, m)), zero).cast("bigint").alias(v) for v in values]
    other = F.coalesce(F.sum(F.when(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)), m)), zero).cast("bigint").alias(rest)
    out = df.rollup(row).agg(F.grouping(row).alias("_all"), *cells, other, F.sum(m).cast("bigint").alias(total))
    label = F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col(row).cast("string"))
    return out.select(label.alias(row), *values, rest, total)


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def board(figures: Sequence[tuple[str, DataFrame, str | None, str | Column]]) -> DataFrame:
    """Headline figures in long form: (indicateur, categorie, valeur), one row per figure and category.
    Each part is (indicator, aggregated rows, category column or none, value)."""
    return stack([
        rows.select(F.lit(name).alias("indicateur"), (F.col(by).cast("string") if by else F.lit(None).cast("string")).alias("categorie"),
                    (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)").alias("valeur"))
        for name, rows, by, value in figures])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def common_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def pairs_only_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference."""
    return left.subtract(right)


def json_columns(df: DataFrame, json: str, fields: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """JSON text to typed columns: {key: type}. A value that does not fit its type gives NULL.

    The generator makes the text parsed once per row, whatever the number of keys.
    """
    names = {k: f"_j{i}" for i, k in enumerate(fields)}
    parsed = df.select(*keep, F.inline(F.array(F.from_json(json, ", ".join(f"`{k}` string" for k in fields)))).alias(
        *names.values()))
    typed = [(F.col(names[k]) if t == "string" else F.col(names[k]).try_cast(t)).alias(k) for k, t in fields.items()]
    return parsed.select(*keep, *typed)
