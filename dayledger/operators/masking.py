"""What each audience may read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import scalars as S
from dayledger.operators.rollup import suppress_small_groups


def audience_view(df: DataFrame, columns: Sequence[str], measure: str | None = None, k: int = 5) -> DataFrame:
    """Only the allowed columns; with ``measure``, small groups are suppressed too."""
    shown = df if measure is None else suppress_small_groups(df, measure, k)
    return shown.select(*columns)


def readable(name: str, audience: str, grants: Mapping[str, Sequence[str]]) -> bool:
    """Whether a table or view is granted to an audience."""
    return name in grants.get(audience, ())


def pseudonymous(df: DataFrame, person: str, columns: Sequence[str], salt: str | None = None) -> DataFrame:
    """Keep the opaque person id and the listed columns; with a salt, hash the id as well."""
    who = F.col(person) if salt is None else S.pseudonym(person, salt)
    return df.select(who.alias(person), *columns)
