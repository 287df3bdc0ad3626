import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from dayledger.functions import scalars as S


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_days_to_date(spark):
    r = one(spark, a=S.days_to_date(F.lit(20703)), b=S.days_to_date(F.lit(None)))
    assert r.a == dt.date(2026, 9, 7) and r.b is None


def test_iso_to_ts(spark):
    texts = ["2026-09-10T16:55:58.876543Z", "2026-09-10T16:55:58Z", "2026-09-10T16:55:58.8Z", "2026-09-10 16:55:58.87", "x"]
    got = [one(spark, a=S.iso_to_ts(F.lit(t))).a for t in texts]
    base = dt.datetime(2026, 9, 10, 16, 55, 58)
    assert got == [base.replace(microsecond=us) for us in (876000, 0, 800000, 870000)] + [None]


def test_iso_to_epoch_ms(spark):
    r = one(spark, a=S.iso_to_epoch_ms(F.lit("1970-01-01T00:00:01.250Z")), b=S.iso_to_epoch_ms(F.lit("1970-01-01T01:00:01.250+01:00")))
    assert r.a == r.b == 1250.0


def test_hours_truncate_toward_zero(spark):
    r = one(spark, a=S.hours_between(ts("2026-01-01 10:00:00"), ts("2026-01-01 08:30:00")),
            b=S.hours_between(ts("2026-01-01 00:00:00"), ts("2026-01-03 05:59:59")), c=S.hours_between(ts(None), ts("2026-01-03 05:59:59")))
    assert (r.a, r.b, r.c) == (-1, 53, None)


def test_micros_between(spark):
    r = one(spark, a=S.micros_between(ts("2026-01-01 10:00:00.000001"), ts("2026-01-02 10:00:00")),
            b=S.micros_between(ts("2026-01-02 10:00:00"), ts("2026-01-01 10:00:00.000001")))
    assert r.a == 86_400_000_000 - 1 and r.b == -r.a


def test_null_propagation_in_keys_and_names(spark):
    r = one(spark, a=S.full_name(F.lit("A"), F.lit(None)), b=S.business_key(F.lit("F1"), F.lit(2)), c=S.key_head(F.lit("F1/X")))
    assert (r.a, r.b, r.c) == (None, "F1/2", "F1")


def test_raw_json_keeps_nulls(spark):
    r = one(spark, a=S.raw_json({"x": F.lit(None).cast("string"), "y": F.lit(1.5)}))
    assert r.a == '{"x":null,"y":1.5}'


def test_periods(spark):
    r = one(spark, week=S.week_start(F.lit("2026-09-06").cast("date")), month=S.month_start(F.lit("2026-09-06").cast("date")),
            closed=S.closed_months(F.lit("2026-08-31").cast("date"), "2026-09-15"), open=S.closed_months(F.lit("2026-09-01").cast("date"), "2026-09-15"))
    assert (r.week, r.month, r.closed, r.open) == (dt.date(2026, 8, 31), dt.date(2026, 9, 1), True, False)


def test_rates_round_half_up_and_survive_zero(spark):
    r = one(spark, a=S.percent(F.lit(1), F.lit(16)), b=S.percent(F.lit(1), F.lit(0)), c=S.ratio(F.lit(1), F.lit(200)))
    assert (r.a, r.b, r.c) == (Decimal("6.3"), None, Decimal("0.01"))


def test_weighted_mean_ignores_rows_without_mean(spark):
    df = spark.createDataFrame([(Decimal("2.00"), 3), (None, 100), (Decimal("4.00"), 1)], "m decimal(10,2), n bigint")
    assert df.agg(S.weighted_mean("m", "n").alias("w")).first().w == Decimal("2.50")
    assert df.where("m is null").agg(S.weighted_mean("m", "n").alias("w")).first().w is None


def test_membership_is_three_valued(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "c string")
    assert [r.c for r in df.where(S.not_member("c", ["A"])).collect()] == ["Z"]


def test_state_flag(spark):
    df = spark.createDataFrame([("RUNNING",), ("FAILED",), (None,)], "s string")
    assert [r.f for r in df.select(S.flag_of_state("s").alias("f")).collect()] == [1, 0, 0]


def test_sum_where_is_null_without_match(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert df.agg(S.sum_where("v", F.col("k") == "b").alias("s")).first().s is None
