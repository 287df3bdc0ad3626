"""Independent recomputation compared row by row, counts, fingerprints, ghosts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.operators.reshape import stack


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per key: both sides, their difference and a verdict.

    Both sides are stacked and summed per key, which keeps NULL keys, needs one shuffle and
    combines on the map side. ``target_ahead`` is always an error; ``source_ahead`` may be lag.
    """
    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        cols = [F.col(m).cast("decimal(28,2)").alias(f"{mine}_{m}") for m in measures]
        empty = [F.lit(None).cast("decimal(28,2)").alias(f"{other}_{m}") for m in measures]
        return df.select(*keys, *cols, *empty, F.lit(mine).alias("_side"))

    both = stack([side(source, "source", "target"), side(target, "target", "source")])
    sums = [F.sum(f"{s}_{m}").alias(f"{s}_{m}") for m in measures for s in ("source", "target")]
    out = both.groupBy(*keys).agg(
        *sums, F.max(F.col("_side") == "source").alias("in_source"), F.max(F.col("_side") == "target").alias("in_target"))
    zero = F.lit(0).cast("decimal(28,2)")
    deltas = {f"delta_{m}": (F.coalesce(f"target_{m}", zero) - F.coalesce(f"source_{m}", zero)).cast("decimal(28,2)")
              for m in measures}
    out = out.withColumns(deltas)
    above = F.lit(False)
    below = ~F.col("in_target")
    for m in measures:
        above = above | (F.col(f"delta_{m}") > 0)
        below = below | (F.col(f"delta_{m}") < 0)
    above = above | ~F.col("in_source")
    return out.withColumn("verdict", F.when(above, "target_ahead").when(below, "source_ahead").otherwise("ok"))


def lag_or_error(first: DataFrame, second: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Two readings of the same comparison: a shrinking gap is lag, a target above its source is
    an error, a gap that stays is stuck."""
    gap = f"delta_{measure}"
    one = first.select(*keys, F.col(gap).alias("gap_first"))
    two = second.select(*keys, F.col(gap).alias("gap_second"), F.col("verdict").alias("_v"))
    joined = two.join(one, list(keys), "left")
    return joined.select(
        *keys, "gap_first", "gap_second",
        F.when(F.col("_v") == "target_ahead", "error")
        .when(F.col("gap_second") == 0, "ok")
        .when(F.abs("gap_second") < F.abs(F.coalesce("gap_first", "gap_second")), "lag")
        .otherwise("stuck").alias("reading"))


def compare_counts(reference: DataFrame, restored: DataFrame, tolerance_pct: float) -> DataFrame:
    """Two (table_name, rows) lists: OK within tolerance, ECART beyond, ABSENTE / MANQUANTE when
    one side lacks the table. A reference of zero allows only zero. The words are fixed output values."""
    a = reference.select("table_name", F.col("rows").alias("reference_rows"))
    b = restored.select("table_name", F.col("rows").alias("restored_rows"))
    j = a.join(b, "table_name", "full_outer")
    ref, got = F.col("reference_rows"), F.col("restored_rows")
    delta = (F.when(ref == 0, F.when(got == 0, 0.0).otherwise(100.0))
             .otherwise(F.abs(got - ref) * 100.0 / ref).cast("double"))
    delta = F.when(ref.isNull() | got.isNull(), F.lit(None).cast("double")).otherwise(delta)
    return j.withColumn("delta_pct", delta).withColumn(
        "verdict",
        F.when(ref.isNull(), "ABSENTE").when(got.isNull(), "MANQUANTE")
        .when(F.col("delta_pct") <= tolerance_pct, "OK").otherwise("ECART"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of a catalogue list."""
    return stack([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
                  for name, df in tables.items()])


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def duplicate_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(table_controlee, doublons): number of duplicated keys per table, zero expected."""
    return stack([
        duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("doublons"))
        .select(F.lit(name).alias("table_controlee"), "doublons")
        for name, (df, keys) in tables.items()])


def ordered_md5(df: DataFrame, text: str, order: Sequence[str | Column], n: int) -> DataFrame:
    """md5 of the comma-joined texts of the first ``n`` rows in order: the short fingerprint of a ranking.

    Each task keeps its n best, so no more than n rows ever meet; use ``fingerprint`` for whole sets.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    first = df.orderBy(*keys).limit(n).select(F.row_number().over(Window.orderBy(*keys)).alias("_pos"), F.col(text).alias("_text"))
    rows = F.sort_array(F.collect_list(F.struct("_pos", "_text")))
    return first.agg(F.count(F.lit(1)).alias("rows"),
                     F.md5(F.array_join(F.transform(rows, lambda r: r["_text"]), ",")).alias("fingerprint"))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(rows, fingerprint) of a set of any size, independent of order and partitioning.

    Each row gives an md5; both halves of it are summed exactly as integers, so every partition
    contributes one partial sum. Equal sets give equal sums; duplicates count.
    """
    digest = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]))
    halves = [F.sum(F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(38,0)")).cast("string") for at in (1, 17)]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("-", *halves).alias("fingerprint"))


def ghost_days(target: DataFrame, source: DataFrame, day: str = "jour") -> DataFrame:
    """Days present in the target and gone from the source."""
    return target.select(day).distinct().join(source.select(day).distinct(), day, "left_anti")
