"""Batch run of the claims plan: every target table written from current source rows."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from dayledger.plans import claims
from dayledger.sources.sinks import overwrite_days, stamped


def write_all(src: claims.Sources, root: str, as_of: str | None = None, tables: Sequence[str] | None = None,
              parallel_jobs: int = 8, period: tuple[str, str] | None = None, keep_history: bool = False) -> None:
    """Fan out from one read: the current rows of every source are written once (``_sources``) and read from
    there, whatever they are planned on; the two joined row sets are computed once and feed all daily tables.

    Daily tables are day-partitioned. A full run replaces them; one with ``period`` replaces the days of
    the period; ``keep_history`` leaves days that the sources no longer have (see ``overwrite_days``).
    """
    def keep(name: str) -> None:
        src[name].write.mode("overwrite").parquet(f"{root}/_sources/{name}")

    with ThreadPoolExecutor(parallel_jobs) as pool:
        list(pool.map(keep, src))
    spark = next(iter(src.values())).sparkSession
    src = {n: spark.read.schema(df.schema).parquet(f"{root}/_sources/{n}") for n, df in src.items()}
    services = claims.enriched_services(src).persist(StorageLevel.MEMORY_AND_DISK)
    requests = claims.enriched_requests(src).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        plan = {**claims.kpi_tables(src, services, requests), **claims.dimension_tables(src)}
        plan["qualite_anomalies"] = claims.quarantine_table(src, as_of)

        def write(name: str) -> None:
            if name.startswith("kpi_"):
                overwrite_days(stamped(plan[name]), f"{root}/{name}", period=period, keep_history=keep_history)
            else:
                stamp = "detecte_le" if name == "qualite_anomalies" else "maj_le"
                stamped(plan[name], stamp).write.mode("overwrite").parquet(f"{root}/{name}")

        with ThreadPoolExecutor(parallel_jobs) as pool:
            list(pool.map(write, tables or plan))
    finally:
        services.unpersist()
        requests.unpersist()


def read_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The written tables by name, ready for ``read_model.views``."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in claims.TABLE_KEYS}
