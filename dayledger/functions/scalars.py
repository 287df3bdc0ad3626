"""Column functions. Everything here is a built-in expression, so it stays in generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "(inconnu)"
UNKNOWN_FEMININE = "(inconnue)"
UNANSWERED = "sans_reponse"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- dates and times ---------------------------------------------------------------------------


def days_to_date(days: Column | str) -> Column:
    """DATE from a count of days since 1970-01-01; NULL stays NULL."""
    return F.date_from_unix_date(_col(days).cast("int"))


def iso_to_ts(text: Column | str) -> Column:
    """Millisecond timestamp from ISO-8601 text; zone suffix dropped, bad text gives NULL.

    The result is TIMESTAMP_NTZ: the wall clock as written (UTC in the change events), whatever
    the session zone is.
    """
    return F.substring(_col(text), 1, 23).try_cast("timestamp_ntz")


def iso_to_epoch_ms(text: Column | str) -> Column:
    """Epoch milliseconds of ISO-8601 text carrying a zone (``Z`` or an offset); bad text gives NULL."""
    return F.unix_micros(_col(text).try_cast("timestamp")) / F.lit(1000.0)


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Whole hours from start to end, truncated toward zero (-1.5 h gives -1)."""
    gap = _col(end) - _col(start)
    return F.extract(F.lit("DAY"), gap) * 24 + F.extract(F.lit("HOUR"), gap)


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Microseconds from start to end as BIGINT, independent of the session zone."""
    gap = _col(end) - _col(start)
    # SECOND of a day-time interval is DECIMAL(8,6), so the product is exact.
    seconds = (F.extract(F.lit("SECOND"), gap) * F.lit(1_000_000)).cast("bigint")
    minutes = (
        F.extract(F.lit("DAY"), gap).cast("bigint") * 1440
        + F.extract(F.lit("HOUR"), gap).cast("bigint") * 60
        + F.extract(F.lit("MINUTE"), gap).cast("bigint")
    )
    return minutes * 60_000_000 + seconds


def week_start(day: Column | str) -> Column:
    """Monday of the week, as DATE."""
    return F.trunc(_col(day), "week")


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "month")


def closed_months(day: Column | str, as_of: Column | str) -> Column:
    """True for days in months that ended before ``as_of``'s month began."""
    today = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return _col(day) < F.trunc(today, "month")


def today_only(day: Column | str, as_of: str) -> Column:
    return _col(day) == F.lit(as_of).cast("date")


def in_period(day: Column | str, first: str, last: str) -> Column:
    """Closed range on the raw day column, so that it prunes partitions and row groups."""
    return _col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))


# -- text --------------------------------------------------------------------------------------


def full_name(last: Column | str, first: Column | str) -> Column:
    """``last first``; NULL when either part is NULL."""
    return F.concat(_col(last), F.lit(" "), _col(first))


def business_key(*parts: Column | str) -> Column:
    """Slash-joined composite key; NULL when any part is NULL."""
    out: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            out.append(F.lit("/"))
        out.append(_col(part).cast("string"))
    return F.concat(*out)


def key_head(key: Column | str) -> Column:
    """First segment of a slash-joined key."""
    return F.split_part(_col(key), F.lit("/"), F.lit(1))


def raw_json(columns: Mapping[str, Column | str]) -> Column:
    """One JSON object of the given columns, with NULLs kept."""
    fields = [_col(c).alias(name) for name, c in columns.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def json_text(doc: Column | str, key: str) -> Column:
    return F.get_json_object(_col(doc), f"$.{key}")


# -- defaults and numbers ----------------------------------------------------------------------


def or_unknown(c: Column | str, default: str = UNKNOWN) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def money(c: Column | str, scale: int = 2) -> Column:
    """Exact amount: cast before summing, so that partial sums in any order agree."""
    return _col(c).cast(f"decimal(18,{scale})")


def money_or_zero(c: Column | str) -> Column:
    return F.coalesce(money(c), F.lit(0).cast("decimal(18,2)"))


def sum_money(c: Column | str) -> Column:
    return F.sum(_col(c)).cast("decimal(18,2)")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole on decimals, rounded half up; NULL when whole is zero."""
    num = part.cast("decimal(20,2)") * F.lit(100).cast("decimal(3,0)")
    share = num / F.nullif(whole.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    return F.round(share, digits).cast(f"decimal(18,{digits})")


def ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """num / den on decimals, rounded half up; NULL when den is zero."""
    zero = F.lit(0).cast("decimal(20,2)")
    quotient = num.cast("decimal(20,2)") / F.nullif(den.cast("decimal(20,2)"), zero)
    return F.round(quotient, digits).cast(f"decimal(18,{digits})")


def weighted_mean(mean: Column | str, weight: Column | str, digits: int = 2) -> Column:
    """Aggregate: mean of means weighted by row counts; rows without a mean weigh nothing."""
    m, w = _col(mean), _col(weight)
    top = F.sum((m * w.cast("decimal(18,0)")).cast("decimal(28,2)"))
    bottom = F.sum(F.when(m.isNotNull(), w).otherwise(F.lit(0)))
    den = F.nullif(bottom, F.lit(0).cast("bigint")).cast("decimal(20,0)")
    return F.round(top / den, digits).cast(f"decimal(18,{digits})")


def sum_where(value: Column | str, condition: Column) -> Column:
    """Conditional sum; NULL when no row of the group matches."""
    return F.sum(F.when(condition, _col(value)))


def flag_of_state(state: Column | str, up: str = "RUNNING") -> Column:
    """1 when the text state equals ``up``, else 0."""
    return F.when(_col(state) == up, F.lit(1)).otherwise(F.lit(0))


def member(c: Column | str, values: Sequence[str]) -> Column:
    return _col(c).isin(list(values))


def not_member(c: Column | str, values: Sequence[str]) -> Column:
    """Three-valued: NULL input gives NULL, so a filter on it does not flag the row."""
    return ~_col(c).isin(list(values))


def sha256(text: Column | str) -> Column:
    return F.sha2(_col(text), 256)


def pseudonym(c: Column | str, salt: str) -> Column:
    """Opaque identifier: salted SHA-256."""
    return F.sha2(F.concat(_col(c).cast("string"), F.lit(salt)), 256)
