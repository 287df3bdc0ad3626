"""Event-time windows; the same functions serve streams and batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dayledger.functions import scalars as S
from dayledger.operators.quality import Rule, first_match
from dayledger.sources import cdc
from dayledger.sources.sinks import to_keyed_messages
from dayledger.sources.specs import SERVICES_BY_STATUS
from dayledger.streaming.files import claimed
from dayledger.streaming.tables import KeyedTable, SumTable

WATERMARK = "30 seconds"
WEEK = "7 days"


def windowed(df: DataFrame, time: str, length: str, by: Sequence[str], sums: Mapping[str, str], count: str,
             start: str, watermark: str | None = None) -> DataFrame:
    """Tumbling windows with a count and sums per group.

    Rows without event time belong to no window and are left out. Windows are aligned to
    1970-01-01 (a Thursday for 7 days), unlike calendar weeks, which start on Monday.
    """
    timed = df.where(F.col(time).isNotNull())
    begin = F.col("_w.start")
    if watermark:
        # Watermarks need an instant: read the wall clock as UTC, and give the start back the same
        # way, so that the session zone plays no part.
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        timed = timed.withColumn(time, F.timestamp_micros(S.micros_between(epoch, time)))
        timed = timed.withWatermark(time, watermark)
        begin = epoch + F.make_dt_interval(secs=F.unix_seconds(begin).cast("decimal(18,6)"))
    grouped = timed.groupBy(F.window(time, length).alias("_w"), *by).agg(
        F.count(F.lit(1)).alias(count), *[F.sum(c).alias(out) for out, c in sums.items()])
    return grouped.select(begin.alias(start), *by, count, *sums)


def weekly_by_status(services: DataFrame, watermark: str | None = None) -> DataFrame:
    """Service lines per 7-day window and refund status."""
    summed = windowed(_weekly_rows(services), "event_time", WEEK, ["statut_remboursement"], {"montant_total": "montant"},
                      "nombre_prestations", "semaine_debut", watermark)
    return summed.withColumn("montant_total", F.col("montant_total").cast("double"))


def _weekly_rows(services: DataFrame) -> DataFrame:
    """Status and amount as the weekly sums take them. Decimal, so that no sum depends on its order."""
    return services.withColumns({
        "statut_remboursement": S.or_unknown("STATUT_REMBOURSEMENT", "inconnu"),
        "montant": F.coalesce(F.col("PRESTATION_MONTANT_DEPENSE").cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))})


def _reject_rules() -> list[Rule]:
    """Completeness rules on a service line."""
    amount = F.col("PRESTATION_MONTANT_DEPENSE")
    return [
        Rule("date_creation_manquante", "", F.col("DATE_CREATION").isNull()),
        Rule("montant_manquant", "", amount.isNull()),
        Rule("montant_negatif", "", amount < 0),
    ]


_REJECT_COLUMNS = {
    "facture_numero": "FACTURE_NUMERO", "prestation_code": "PRESTATION_CODE",
    "montant_depense": "PRESTATION_MONTANT_DEPENSE", "date_creation_brute": "DATE_CREATION"}
REJECT_KEYS = ["facture_numero", "prestation_code"]


def rejected_services(services: DataFrame) -> DataFrame:
    """Lines without creation date, without amount, or with a negative amount, with the reason."""
    flagged = services.withColumn("_hit", first_match(_reject_rules())).where(F.col("_hit").isNotNull())
    return flagged.select(*[F.col(c).alias(n) for n, c in _REJECT_COLUMNS.items()],
                          F.col("_hit.reason").alias("motif_rejet_qualite"))


WEEK_KEYS = ("semaine_debut", "statut_remboursement")


@dataclass(frozen=True)
class WeeklyLedger:
    """The tables behind the weekly job: current service lines, and signed sums per week and status.

    Every batch compares the lines of the touched invoices before and after it. A corrected line leaves
    its old window and enters the new one, a deleted line leaves, and an event delivered again, or older
    than what is known, changes nothing: neither a sum nor a reject that was repaired comes back.
    """

    spark: SparkSession
    root: str
    buckets: int = 16

    def lines(self) -> KeyedTable:
        spec = SERVICES_BY_STATUS
        order = T.StructType.fromDDL("lsn bigint, offset bigint")
        schema = T.StructType([*spec.schema.fields, T.StructField(cdc.OP, T.StringType()), T.StructField(cdc.ORDER, order)])
        return KeyedTable(self.spark, f"{self.root}/lines", schema, spec.keys, spec.keys[0], self.buckets)

    def sums(self) -> SumTable:
        schema = T.StructType.fromDDL("semaine_debut timestamp_ntz, statut_remboursement string, nombre_prestations bigint, "
                                      "montant_total decimal(18,2), maj_le timestamp")
        return SumTable(self.spark, f"{self.root}/weeks", schema, WEEK_KEYS, "nombre_prestations", ("montant_total",))

    def merge_due(self, batch: int) -> None:
        """Merges of both tables that follow from ``batch`` being finished."""
        self.lines().merge_due(batch)
        self.sums().merge_due(batch)

    def read(self, before: int | None = None) -> DataFrame:
        """Current sums per week and status."""
        return self.sums().read(before).drop("maj_le").withColumn("montant_total", F.col("montant_total").cast("double"))

    def process(self, raw: DataFrame, batch: int) -> tuple[DataFrame, DataFrame]:
        """Apply one batch; the messages (key, value) of both topics that follow from it. Applying a batch
        again writes and returns the same."""
        spec = SERVICES_BY_STATUS
        events = cdc.parse_envelope(raw, spec)
        changes = cdc.normalize_changelog(events, spec.keys, keep_deletes=True).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.lines().append(changes, batch)
            touched = changes.select(spec.keys[0]).distinct()
            old, new = (self.lines().read(upto, touched) for upto in (batch, batch + 1))
            signed = self._weeks(old, -1).unionByName(self._weeks(new, 1))
            self.sums().append_signed(signed, {"montant_total": "montant"}, batch)
        finally:
            changes.unpersist()
        moved = self.sums().delta(batch).select(*WEEK_KEYS)
        held = self.read(batch + 1).withColumn("_held", F.lit(True))
        weeks = moved.join(held, list(WEEK_KEYS), "left").withColumn("_gone", F.col("_held").isNull()).drop("_held")
        return to_keyed_messages(weeks, WEEK_KEYS, "_gone"), self._reject_messages(old, new)

    def _weeks(self, lines: DataFrame, sign: int) -> DataFrame:
        timed = _weekly_rows(SERVICES_BY_STATUS.with_derived(lines)).where(F.col("event_time").isNotNull())
        return timed.select(F.window("event_time", WEEK)["start"].alias("semaine_debut"), "statut_remboursement", "montant", F.lit(sign).alias("_sign"))

    def _reject_messages(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """A rejected line gives its message; one that was rejected and no longer is gives a tombstone."""
        was, now = rejected_services(old).distinct(), rejected_services(new)
        fresh = now.exceptAll(was).withColumn("_gone", F.lit(False))
        gone = was.join(now.select(*REJECT_KEYS), REJECT_KEYS, "left_anti").withColumn("_gone", F.lit(True))
        return to_keyed_messages(fresh.unionByName(gone), REJECT_KEYS, "_gone")


def window_messages(raw: DataFrame, watermark: str | None = WATERMARK) -> DataFrame:
    """Messages (key, value) of the weekly sums of an insert-only source, one per closed window.

    For a source with updates, deletes or repeats use ``run_weekly``."""
    services = SERVICES_BY_STATUS.with_derived(cdc.parse_envelope(raw, SERVICES_BY_STATUS))
    return to_keyed_messages(weekly_by_status(services, watermark), WEEK_KEYS)


def run_weekly(raw: DataFrame, checkpoint: str, windows: dict[str, str], rejects: dict[str, str],
               sink: str = "kafka", trigger: dict[str, object] | None = None) -> StreamingQuery:
    """The weekly job: one read of the source feeds both outputs. ``windows`` / ``rejects`` are the
    options of each sink. Its tables live beside the checkpoint, start anew with it and are claimed for one
    query at a time. A batch that is
    retried may send its messages again; they are upserts, so readers see the same."""
    ledger = WeeklyLedger(raw.sparkSession, f"{checkpoint}/tables")

    def apply(batch: DataFrame, number: int) -> None:
        for messages, options in zip(ledger.process(batch, number), (windows, rejects)):
            messages.write.format(sink).mode("append").options(**options).save()
        ledger.merge_due(number)

    writer = raw.writeStream.foreachBatch(apply).option("checkpointLocation", f"{checkpoint}/source")
    return claimed(raw.sparkSession, ledger.root, f"checkpoint {checkpoint}", lambda: writer.trigger(**(trigger or {"availableNow": True})).start())
