"""Writers: partition overwrite, keyed messages, CSV, bucketed tables, JDBC upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.streaming import files


def stamped(df: DataFrame, column: str = "maj_le") -> DataFrame:
    """Add the update stamp."""
    return df.withColumn(column, F.current_timestamp())


def overwrite_days(df: DataFrame, path: str, day: str = "jour", period: tuple[str, str] | None = None,
                   keep_history: bool = False) -> None:
    """Write a daily table as day partitions. Writing the same again changes nothing.

    Without ``period`` the table is replaced: a day that has no rows any more goes. With ``period``
    (first and last day) only its days are written, and those it had but no longer produces go.
    ``keep_history`` replaces the days in ``df`` and leaves all others, for a source that was reset.
    Range partitioning on the whole row spreads a day that holds a large share of the rows.
    """
    if period:
        df = df.where(F.col(day).between(*period))
    rest = [c for c in df.columns if c != day]
    mode = "dynamic" if period or keep_history else "static"
    (df.repartitionByRange(day, *rest).write.mode("overwrite").option("partitionOverwriteMode", mode)
     .partitionBy(day).parquet(path))
    if period and not keep_history:
        produced = {f"{day}={r[0]}" for r in df.select(F.col(day).cast("string")).distinct().collect()}  # days of the period
        first, last = (f"{day}={d}" for d in period)
        for name in files.children(df.sparkSession, path):
            if first <= name <= last and name.startswith(f"{day}=") and name not in produced:
                files.remove(df.sparkSession, f"{path}/{name}")


def to_keyed_messages(df: DataFrame, keys: Sequence[str], deleted: str | None = None) -> DataFrame:
    """(key JSON, value JSON) rows for a compacted topic; a deleted row has a NULL value."""
    values = [c for c in df.columns if c != deleted]
    body = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    if deleted:
        body = F.when(F.col(deleted), F.lit(None).cast("string")).otherwise(body)
    return df.select(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key"), body.alias("value"))


def latest_messages(messages: DataFrame, order: str) -> DataFrame:
    """Compacted view of a keyed topic: last value per key, tombstoned keys gone."""
    last = messages.groupBy("key").agg(F.max_by("value", order).alias("value"))
    return last.where(F.col("value").isNotNull())


def write_csv(df: DataFrame, path: str) -> None:
    """Semicolon-separated files with a header."""
    df.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Table bucketed and sorted by ``key``: joins of two such tables need no shuffle."""
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table))


def upsert_statement(target: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """PostgreSQL upsert from a staging table, for writing a KPI table over JDBC."""
    rest = [c for c in columns if c not in set(keys)]
    action = "DO UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in rest) if rest else "DO NOTHING"
    names = ", ".join(columns)
    return (f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} "
            f"ON CONFLICT ({', '.join(keys)}) {action}")


def upsert_jdbc(df: DataFrame, url: str, target: str, keys: Sequence[str], properties: dict[str, str]) -> None:
    """Executors load a staging table in parallel; one statement then merges it, so a retried
    load never leaves the target half written."""
    staging = f"{target}_staging"
    df.write.jdbc(url, staging, mode="overwrite", properties={**properties, "truncate": "true"})
    jvm = df.sparkSession._jvm
    props = jvm.java.util.Properties()
    for key, value in properties.items():
        props.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        statement = connection.createStatement()
        statement.executeUpdate(upsert_statement(target, staging, keys, df.columns))
        statement.close()
    finally:
        connection.close()
