"""Projection, defaulting and joins that feed the daily aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions import scalars as S


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename to analytic names: {new name: source column or expression}."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def coalesce_dims(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Unknown-member text for dimensions, zero for measures: {column: default}."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def dated(df: DataFrame, day: str = "jour") -> DataFrame:
    """Rows without an event day belong to no period; they are quarantined instead."""
    return df.where(F.col(day).isNotNull())


def join_lines(lines: DataFrame, headers: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Lines with their header, NULLs kept. Lines without header are dropped (inner join).

    No hint is given: the planner compares measured sizes, and adaptive execution splits the
    partition of a header that holds a large share of the lines.
    """
    return lines.join(headers, [on] if isinstance(on, str) else list(on), "inner")


def enrich_lines(lines: DataFrame, headers: DataFrame, on: str, day: Column | str,
                 dims: Mapping[str, str | Column], amounts: Mapping[str, str | Column],
                 carry: Mapping[str, str | Column] | None = None) -> DataFrame:
    """Dated lines with defaulted dimensions and exact amounts.

    Only the columns named are selected, so each scan reads those alone; the day filter sits on a
    header column and moves below the join.
    """
    day_col = F.col(day) if isinstance(day, str) else day
    joined = join_lines(lines, headers, on).where(day_col.isNotNull())
    out = [day_col.alias("jour")]
    out += [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in (carry or {}).items()]
    out += [S.or_unknown(c).alias(n) for n, c in dims.items()]
    out += [S.money_or_zero(c).alias(n) for n, c in amounts.items()]
    return joined.select(*out)


def sum_per_key(df: DataFrame, key: str, amount: str, alias: str) -> DataFrame:
    """One row per key before a join, so that the join carries one row instead of many."""
    return df.groupBy(key).agg(S.sum_money(S.money(amount)).alias(alias))


def left_status(requests: DataFrame, answers: DataFrame, amounts: DataFrame, key: str) -> DataFrame:
    """Requests with their answer and summed amount; no answer row means unanswered.

    Expects ``request_time`` on requests and ``status_code``, ``agent_code``, ``answer_time`` on
    answers (one row per key), ``amount`` on amounts (one row per key).
    """
    joined = requests.join(answers, key, "left").join(amounts, key, "left")
    return joined.where(F.col("request_time").isNotNull()).withColumns({
        "jour": F.col("request_time").cast("date"),
        "status_code": S.or_unknown("status_code", S.UNANSWERED),
        "delay_hours": S.hours_between("request_time", "answer_time"),
        "amount": S.money_or_zero("amount"),
    })


def left_dimension(facts: DataFrame, dim: DataFrame, on: str, labels: Mapping[str, str]) -> DataFrame:
    """Names looked up at read time; a missing member keeps the fact with a default label.

    Aggregate facts to the dimension key first: the join then carries one row per member.
    """
    joined = facts.join(dim, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in labels.items()})


def unmatched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of left without any match (NOT EXISTS)."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys), keys, "left_anti")


def count_with_match(df: DataFrame, other: DataFrame, on: str, by: Sequence[str], total: str,
                     matched: str) -> DataFrame:
    """Per group: rows, and rows whose key exists in ``other`` (a filtered count over EXISTS)."""
    flagged = df.join(other.select(on).distinct().withColumn("_hit", F.lit(True)), on, "left")
    return flagged.groupBy(*by).agg(F.count(F.lit(1)).alias(total), F.count("_hit").alias(matched))


def count_pairs(left: DataFrame, right: DataFrame, on: str, left_dim: str, right_dim: str, count: str) -> DataFrame:
    """Number of (left row, right row) pairs sharing a key, per pair of dimensions.

    Many-to-many without writing out the pairs: each side is counted per (key, dimension), and the
    counts are multiplied after the join.
    """
    a = left.groupBy(on, left_dim).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(on, right_dim).agg(F.count(F.lit(1)).alias("_b"))
    joined = a.join(b, on)
    return joined.groupBy(left_dim, right_dim).agg(F.sum(F.col("_a") * F.col("_b")).cast("bigint").alias(count))


def zero_filled(domain: DataFrame, parts: Mapping[str, DataFrame], on: str) -> DataFrame:
    """Every member of a domain with one count per part, zero where the part has none."""
    out = domain.select(on).distinct()
    for name, part in parts.items():
        out = out.join(part.select(on, F.col("n").alias(name)), on, "left")
    return out.select(on, *[F.coalesce(F.col(n), F.lit(0).cast("bigint")).alias(n) for n in parts])
