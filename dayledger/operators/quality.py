"""Rule lists to quarantine rows, and checks on the quarantine itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions import scalars as S

QUARANTINE_COLUMNS = ("domaine", "motif_anomalie", "famille", "cle_metier", "donnee_brute")


@dataclass(frozen=True)
class Rule:
    """One anomaly: reason code, family, and the condition that flags a row.

    Conditions follow SQL three-valued logic: a condition that is NULL does not flag.
    """

    reason: str
    family: str
    condition: Column


def _label(rule: Rule) -> Column:
    return F.struct(F.lit(rule.reason).alias("reason"), F.lit(rule.family).alias("family"))


def first_match(rules: Sequence[Rule]) -> Column:
    """(reason, family) of the first rule that holds, in list order; NULL when none does."""
    ladder = F.when(rules[0].condition, _label(rules[0]))
    for rule in rules[1:]:
        ladder = ladder.when(rule.condition, _label(rule))
    return ladder


def all_matches(rules: Sequence[Rule]) -> Column:
    """Array of (reason, family) of every rule that holds."""
    return F.filter(F.array(*[F.when(r.condition, _label(r)) for r in rules]), lambda x: x.isNotNull())


def quarantine(df: DataFrame, domain: str, key: Column, rules: Sequence[Rule], raw: Mapping[str, str | Column],
               mode: str = "first", keep: Mapping[str, Column] | None = None) -> DataFrame:
    """Flagged rows as (domain, reason, family, key, raw row as JSON).

    ``first``: one reason per row, the first in priority order. ``all``: one row per reason.
    Reason, family and filter come from the one rule list; the scan needs no shuffle. ``keep`` puts
    typed columns beside the raw row, so that who needs these alone has no JSON written and parsed.
    """
    if mode == "first":
        flagged = df.withColumn("_hit", first_match(rules)).where(F.col("_hit").isNotNull())
    else:
        flagged = df.withColumn("_hit", F.explode(all_matches(rules)))
    return flagged.select(
        F.lit(domain).alias("domaine"), F.col("_hit.reason").alias("motif_anomalie"),
        F.col("_hit.family").alias("famille"), key.alias("cle_metier"), S.raw_json(raw).alias("donnee_brute"),
        *[c.alias(name) for name, c in (keep or {}).items()])


def family_of(reason: Column | str, families: Mapping[str, Sequence[str]], default: Column | str) -> Column:
    """Family of a reason code from {family: codes}; ``default`` where no family lists it."""
    c = F.col(reason) if isinstance(reason, str) else reason
    out = None
    for family, codes in families.items():
        hit = c.isin(list(codes))
        out = F.when(hit, F.lit(family)) if out is None else out.when(hit, F.lit(family))
    return out.otherwise(F.col(default) if isinstance(default, str) else default)


def without_raw_row(df: DataFrame) -> DataFrame:
    """Readable by everyone: the raw (nominative) row is left out."""
    return df.drop("donnee_brute")


def anomaly_counts(df: DataFrame, by: Sequence[str | Column], count: str = "nombre_lignes") -> DataFrame:
    """Quarantine counts by domain, reason, family, day or any mix; none for the total."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))


def volume_check(counts: DataFrame, source_rows: DataFrame, limit: float, count: str = "nombre_lignes") -> DataFrame:
    """Share of each source table that one rule flags; above ``limit`` the rule itself is suspect.

    ``source_rows`` is (domaine, source_rows). A rule flagging every row means a broken rule or a
    misspelt column.
    """
    share = F.col(count) / F.nullif(F.col("source_rows"), F.lit(0))
    return counts.join(source_rows, "domaine", "left").withColumns({
        "share": share.cast("double"), "suspect": F.coalesce(share > limit, F.lit(True))})


def require_plausible_volume(counts: DataFrame, source_rows: DataFrame, limit: float) -> None:
    bad = volume_check(counts, source_rows, limit).where("suspect").select("domaine", "motif_anomalie").collect()
    if bad:
        raise ValueError(f"rules flag an implausible share of their table: {[tuple(r) for r in bad]}")
