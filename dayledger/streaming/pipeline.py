"""The continuous job: change events in, KPI, dimension, fact and quarantine tables out.

One streaming query reads all topics. Per micro-batch and per family of sources it looks up the
rows of the touched keys before and after the batch, and appends the difference of their
contributions. That gives exact retraction (updates, deletes, moves to another day), accepts any
lateness, and needs no operator state: everything lives in tables, and the checkpoint only holds
source positions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dayledger.operators.reshape import stack
from dayledger.plans import claims
from dayledger.sources import cdc
from dayledger.sources.sinks import overwrite_days
from dayledger.sources.specs import SPECS
from dayledger.streaming import files
from dayledger.streaming.tables import FAN, KeyedTable, SumTable, upsert_by_key

INVOICE_FAMILY = ("services", "invoices")
REQUEST_FAMILY = ("requests", "answers", "acts")
INVOICE_KEY, REQUEST_KEY = "FACTURE_NUMERO", "ENTENTE_PREALABLE_ID"

#: Marks of finished batches that stay beside the newest.
KEPT_MARKS = 8

_ORDER_TYPE = T.StructType([T.StructField("lsn", T.LongType()), T.StructField("offset", T.LongType())])


@dataclass
class _Part:
    """What one family of sources adds in a batch: writes, and (before, after) quarantine rows."""

    writes: list[Callable[[], None]]
    flagged: list[tuple[DataFrame, DataFrame]] = field(default_factory=list)


@dataclass
class Ledger:
    """All tables under one root folder."""

    spark: SparkSession
    root: str
    buckets: int = 16
    history: bool = True
    as_of: str | None = None
    merge: bool = True
    parallel_jobs: int = 8
    _cached: list[DataFrame] = field(default_factory=list)

    # -- tables --------------------------------------------------------------------------------

    def state(self, name: str) -> KeyedTable:
        """Current rows of one source."""
        spec = SPECS[name]
        schema = T.StructType([*spec.schema.fields, T.StructField(cdc.OP, T.StringType()),
                               T.StructField(cdc.ORDER, _ORDER_TYPE)])
        return KeyedTable(self.spark, f"{self.root}/state/{name}", schema, spec.keys, spec.keys[0], self.buckets)

    def source(self, name: str, before: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        return SPECS[name].with_derived(self.state(name).read(before, touched))

    def _sum_table(self, name: str, keys: tuple[str, ...], count: str, measures: dict[str, str]) -> SumTable:
        kinds = {"jour": T.DateType()}
        fields = [T.StructField(k, kinds.get(k, T.StringType())) for k in keys]
        fields.append(T.StructField(count, T.LongType()))
        fields += [T.StructField(m, T.LongType() if m in ("heures", "reponses") else T.DecimalType(18, 2)) for m in measures]
        fields.append(T.StructField("maj_le", T.TimestampType()))
        return SumTable(self.spark, f"{self.root}/kpi/{name}", T.StructType(fields), keys, count, tuple(measures))

    def sum_tables(self) -> dict[str, tuple[SumTable, dict[str, str]]]:
        """{table: (sum table, {measure: input column})}."""
        plan = {**claims.SERVICE_TABLES, **claims.INVOICE_TABLES, **claims.FACT_TABLES,
                "kpi_ententes_prealables_jour": (claims.REQUEST_KEYS, "nombre_ententes", {
                    "heures": "delai_heures", "reponses": "repondue", "montant_engage_cmu": "montant_engage_cmu"}),
                "kpi_ententes_prealables_agent_jour": (claims.AGENT_KEYS, "nombre_ententes", {})}
        return {n: (self._sum_table(n, k, c, m), m) for n, (k, c, m) in plan.items()}

    def quarantine(self) -> KeyedTable:
        schema = T.StructType.fromDDL(
            "domaine string, motif_anomalie string, famille string, cle_metier string, donnee_brute string, "
            "detecte_le timestamp, _op string, _order struct<lsn:bigint,offset:bigint>")
        return KeyedTable(self.spark, f"{self.root}/qualite_anomalies", schema, claims.TABLE_KEYS["qualite_anomalies"],
                          "cle_metier", self.buckets, ("detecte_le",))

    # -- reading -------------------------------------------------------------------------------

    def committed(self) -> int:
        """First batch number not finished yet: readers see the batches below it."""
        return max(files.numbered(self.spark, f"{self.root}/done", "batch"), default=-1) + 1

    def tables(self, before: int | None = None) -> dict[str, DataFrame]:
        """Every target table as of the last finished batch."""
        before = self.committed() if before is None else before
        return self._with_rest({n: t.read(before) for n, (t, _) in self.sum_tables().items()}, before)

    def _with_rest(self, out: dict[str, DataFrame], before: int) -> dict[str, DataFrame]:
        """The daily tables as readers see them, with catalogues, facts and the quarantine."""
        ep = out["kpi_ententes_prealables_jour"]
        out["kpi_ententes_prealables_jour"] = ep.select(
            *claims.REQUEST_KEYS, "nombre_ententes",
            claims.mean_delay(F.col("heures"), F.col("reponses")).alias("delai_moyen_heures"), "montant_engage_cmu", "maj_le")
        wanted = {src for src, _, _ in (*claims.DIMENSIONS.values(), *claims.FACTS.values())}
        sources = {name: self.source(name, before) for name in wanted}
        out.update(claims.dimension_tables(sources))
        out["qualite_anomalies"] = self.quarantine().read(before)
        return out

    # -- one micro-batch -----------------------------------------------------------------------

    def _hold(self, df: DataFrame) -> DataFrame:
        self._cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def _signed(self, build: Callable[[dict[str, DataFrame]], DataFrame], old: dict[str, DataFrame],
                new: dict[str, DataFrame]) -> DataFrame:
        return stack([build(old).withColumn("_sign", F.lit(-1)), build(new).withColumn("_sign", F.lit(1))])

    def _sum_writes(self, rows: DataFrame, names: Iterable[str], batch: int) -> list[Callable[[], None]]:
        tables = self.sum_tables()
        return [partial(table.append_signed, rows, inputs, batch) for table, inputs in (tables[n] for n in names)]

    def _quarantine_writes(self, pairs: list[tuple[DataFrame, DataFrame]], batch: int) -> list[Callable[[], None]]:
        """Upsert what the batch's rows are flagged for; in current mode, remove what no longer is."""
        if not pairs:
            return []
        keys = list(claims.TABLE_KEYS["qualite_anomalies"])
        found = self._hold(stack([new for _, new in pairs]))
        rows = found.withColumn("_deleted", F.lit(False))
        if not self.history:
            gone = stack([old for old, _ in pairs]).join(found.select(*keys), keys, "left_anti")
            rows = rows.unionByName(gone.withColumn("_deleted", F.lit(True)))
        rows = rows.withColumn("detecte_le", F.current_timestamp())
        return [partial(upsert_by_key, self.quarantine(), rows, batch)]

    def process(self, raw: DataFrame, batch: int) -> None:
        """Apply one batch of raw change events. Applying the same batch again changes nothing."""
        if batch < self.committed():
            return
        raw = self._hold(raw)
        try:
            seen = {r.topic for r in raw.select("topic").distinct().collect()}
            changes = {n: self._hold(self._changes(raw, n)) for n, s in SPECS.items() if s.table in seen}
            with ThreadPoolExecutor(self.parallel_jobs) as pool:
                def together(calls: Iterable[Callable]) -> list:
                    return list(pool.map(lambda call: call(), calls))

                together(partial(self.state(n).append, df, batch) for n, df in changes.items())
                parts = [p for p in together(partial(f, changes, batch) for f in self._families()) if p]
                # The quarantine write is the longest, so it starts first.
                writes = self._quarantine_writes([pair for part in parts for pair in part.flagged], batch)
                together(writes + [w for part in parts for w in part.writes])
            # Last: readers and a restarted job see the batch only once all of it is written.
            self.spark.range(1).write.mode("overwrite").parquet(f"{self.root}/done/batch={batch}")
            for name in files.children(self.spark, f"{self.root}/done"):  # the newest marks say it all
                if name.startswith("batch=") and int(name[6:]) < batch - KEPT_MARKS:
                    files.remove(self.spark, f"{self.root}/done/{name}")
            if self.merge:
                self._merge_due(batch)
        finally:
            while self._cached:
                self._cached.pop().unpersist()

    def _changes(self, raw: DataFrame, name: str) -> DataFrame:
        """Last change per key of one source within the batch."""
        spec = SPECS[name]
        events = cdc.parse_envelope(raw.where(F.col("topic") == spec.table), spec)
        return cdc.normalize_changelog(events, spec.keys, keep_deletes=True)

    def _before_after(self, changes: dict[str, DataFrame], family: Iterable[str], key: str,
                      batch: int) -> tuple[dict[str, DataFrame], dict[str, DataFrame]] | None:
        """Rows of the touched keys as they stood before this batch and as they stand after it."""
        parts = [changes[n].select(key) for n in family if n in changes]
        if not parts:
            return None
        touched = self._hold(stack(parts).distinct())
        old, new = ({n: self._hold(self.source(n, before, touched)) for n in family} for before in (batch, batch + 1))
        return old, new

    def _families(self) -> list[Callable[[dict[str, DataFrame], int], _Part | None]]:
        def simple(name: str, build: Callable[[DataFrame], DataFrame]) -> Callable:
            def run(changes: dict[str, DataFrame], batch: int) -> _Part | None:
                rows = self._before_after(changes, [name], SPECS[name].keys[0], batch)
                return rows and _Part([], [tuple(build(side[name]) for side in rows)])
            return run

        def counted(name: str, target: str, build: Callable[[dict], DataFrame]) -> Callable:
            def run(changes: dict[str, DataFrame], batch: int) -> _Part | None:
                rows = self._before_after(changes, [name], INVOICE_KEY, batch)
                return rows and _Part(self._sum_writes(self._signed(build, *rows), [target], batch))
            return run

        return [
            self._invoices, self._requests,
            counted("prescriptions", "kpi_prescriptions_medicament_jour", claims.prescription_rows),
            counted("pathologies", "kpi_pathologies_jour", claims.pathology_rows),
            simple("agents", claims.agent_quarantine),
            simple("persons", lambda df: claims.person_quarantine(df, self.as_of)),
        ]

    def _invoices(self, changes: dict[str, DataFrame], batch: int) -> _Part | None:
        rows = self._before_after(changes, INVOICE_FAMILY, INVOICE_KEY, batch)
        if rows is None:
            return None
        rules = (
            lambda s: claims.service_quarantine(claims.raw_services(s)),
            lambda s: claims.undated_invoices(s["invoices"]),
            lambda s: claims.invoice_quarantine(s["invoices"]),
        )
        builds = [(lambda: self._signed(claims.enriched_services, *rows)), (lambda: self._signed(claims.valid_invoices, *rows))]
        builds += [partial(rule, side) for rule in rules for side in rows]
        # Plans of many columns take the driver longer to state than a small batch takes to run.
        with ThreadPoolExecutor(self.parallel_jobs) as pool:
            services, invoices, *flagged = pool.map(lambda build: build(), builds)
        writes = self._sum_writes(self._hold(services), claims.SERVICE_TABLES, batch)
        writes += self._sum_writes(invoices, claims.INVOICE_TABLES, batch)
        return _Part(writes, list(zip(flagged[::2], flagged[1::2])))

    def _requests(self, changes: dict[str, DataFrame], batch: int) -> _Part | None:
        rows = self._before_after(changes, REQUEST_FAMILY, REQUEST_KEY, batch)
        if rows is None:
            return None
        asked = self._hold(self._signed(claims.enriched_requests, *rows).withColumn(
            "repondue", F.when(F.col("delai_heures").isNotNull(), 1).otherwise(0)))
        writes = self._sum_writes(asked, ["kpi_ententes_prealables_jour"], batch)
        writes += self._sum_writes(asked.where("agent_code is not null"), ["kpi_ententes_prealables_agent_jour"], batch)
        flagged = tuple(claims.request_quarantine(s["requests"], s["answers"], claims.request_amounts(s)) for s in rows)
        return _Part(writes, [flagged])

    def _all(self) -> list[KeyedTable | SumTable]:
        return [*(self.state(n) for n in SPECS), self.quarantine(), *(t for t, _ in self.sum_tables().values())]

    def compact(self, upto: int) -> None:
        """Every table as one run of the batches below ``upto``."""
        with ThreadPoolExecutor(self.parallel_jobs) as pool:
            list(pool.map(lambda t: t.compact(upto), self._all()))

    def _merge_due(self, batch: int) -> None:
        if (batch + 1) % FAN == 0:
            with ThreadPoolExecutor(self.parallel_jobs) as pool:
                list(pool.map(lambda t: t.merge_due(batch), self._all()))

    def vacuum(self) -> None:
        for table in self._all():
            table.vacuum()

    def first_batch(self, checkpoint: str) -> int:
        """Number of the first batch of a checkpoint.

        A new checkpoint numbers its batches from 0 again, so they continue after the finished ones
        (a full replay is then an ordinary series of batches that changes nothing). What an
        abandoned run left unfinished is dropped.
        """
        note = f"{self.root}/runs/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
        if files.has(self.spark, f"{checkpoint}/metadata") and files.has(self.spark, f"{note}/_SUCCESS"):
            return self.spark.read.parquet(note).first()["first"]
        first = self.committed()
        for table in self._all():
            table.discard_from(first)
        self.spark.range(1).select(F.lit(first).alias("first")).write.mode("overwrite").parquet(note)
        return first


def run_pipeline(raw: DataFrame, ledger: Ledger, checkpoint: str, name: str = "dayledger",
                 trigger: dict[str, object] | None = None) -> StreamingQuery:
    """Start the continuous job on a raw change stream (see ``cdc.read_kafka``, ``cdc.read_files``).

    The target folder is claimed for this checkpoint until the query ends: a second job is refused, a
    restart from the same checkpoint goes on. The checkpoint replaces a replay from the earliest offset.
    """
    def start() -> StreamingQuery:
        first = ledger.first_batch(checkpoint)
        captured = cdc.allow_tables(raw, [s.table for s in SPECS.values()])
        writer = captured.writeStream.foreachBatch(lambda df, batch: ledger.process(df, first + batch))
        writer = writer.option("checkpointLocation", checkpoint).queryName(name)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    return files.claimed(ledger.spark, ledger.root, f"checkpoint {checkpoint}", start)


def publish_days(ledger: Ledger, name: str, path: str, period: tuple[str, str] | None = None) -> None:
    """Copy a daily table, or the days of a period, to plain day partitions for readers outside Spark."""
    overwrite_days(ledger.tables()[name], path, period=period)
