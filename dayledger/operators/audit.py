"""Hash-chained archive manifest and daily audit slice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import scalars as S

GENESIS = "0" * 64


def hash_files(df: DataFrame) -> DataFrame:
    """(name, file_hash) from ``binaryFile`` rows."""
    return df.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("file_hash"))


def extend_chain(day: str, entries: DataFrame, tail: str = GENESIS) -> DataFrame:
    """Manifest lines for one day's archives, chained on from ``tail`` in the order of ``seq``.

    Every link needs the one before, so a chain is made by one task, reading the day's archive hashes
    (never the archived rows) once in order and keeping nothing but the last link.
    """
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = tail
        for batch in batches:
            previous, chain = [], []
            for file_hash, name in zip(batch["file_hash"], batch["name"]):
                previous.append(last)
                last = hashlib.sha256(f"{last}{file_hash}{name}".encode()).hexdigest()
                chain.append(last)
            yield batch.assign(previous=previous, chain=chain)

    ordered = entries.select(F.col("seq").cast("bigint"), "name", "file_hash").coalesce(1).sortWithinPartitions("seq")
    lines = ordered.mapInPandas(fold, "seq bigint, name string, file_hash string, previous string, chain string")
    return lines.select(F.lit(day).alias("day"), "*")


def verify_chain(manifest: DataFrame, actual: DataFrame, position: str, by: Sequence[str] = (),
                 genesis: str = GENESIS) -> DataFrame:
    """Per manifest line: missing, altered, broken before, invalid; ``ok`` when none holds.

    ``manifest`` has name, file_hash, previous, chain and a gap-free ``position`` (see
    ``ranking.row_numbers``) within ``by``; ``actual`` has name and actual_hash. The line before is
    found by an equality join on position, so that a long chain is checked in parallel.
    """
    keys = [*by, position]
    prior = manifest.select(*by, (F.col(position) + 1).alias(position), F.col("chain").alias("_prior"))
    lines = manifest.join(prior, keys, "left").join(actual, "name", "left")
    expected_prior = F.when(F.col(position) == 1, F.lit(genesis)).otherwise(F.col("_prior"))
    present = F.col("actual_hash").isNotNull()
    checked = lines.select(
        *keys, "name",
        (~present).alias("missing"),
        (present & (F.col("actual_hash") != F.col("file_hash"))).alias("altered"),
        (present & ~F.col("previous").eqNullSafe(expected_prior)).alias("broken"),
        (present & (S.sha256(F.concat("previous", "file_hash", "name")) != F.col("chain"))).alias("invalid"))
    return checked.withColumn("ok", ~(F.col("missing") | F.col("altered") | F.col("broken") | F.col("invalid")))


def chain_verdict(checked: DataFrame) -> DataFrame:
    """One row: entries, failures, conform."""
    bad = F.count(F.when(~F.col("ok"), 1))
    return checked.agg(F.count(F.lit(1)).alias("entries"), bad.alias("failures"), (bad == 0).alias("conform"))


def day_slice(log: DataFrame, users: DataFrame, day: str, time: str, user: str, name: str,
              anonymous: str = "anonyme") -> DataFrame:
    """One day of an event log with the user's name; unknown users become ``anonyme``.

    The half-open range is on the raw time column, so it reaches the scan.
    """
    start = F.lit(day).cast("timestamp_ntz")
    kept = log.where((F.col(time) >= start) & (F.col(time) < start + F.expr("INTERVAL 1 DAY")))
    named = kept.join(users.select(user, F.col(name).alias("_name")), user, "left")
    return named.withColumn("utilisateur", F.coalesce("_name", F.lit(anonymous))).drop("_name", user)
