"""Native windows, late rows, rejects, and the alerts."""

import datetime as dt
import json

from pyspark.sql import functions as F

from dayledger.sources import cdc
from dayledger.sources.specs import SERVICES_BY_STATUS
from dayledger.streaming import health, window


def event(i, when, amount=10.0, status="paye"):
    row = {"FACTURE_NUMERO": f"F{i}", "PRESTATION_CODE": "A", "STATUT_REMBOURSEMENT": status, "MOTIF_REJET_CODE": None,
           "PRESTATION_MONTANT_DEPENSE": amount, "DATE_CREATION": when}
    return json.dumps({"before": None, "after": row, "op": "c", "ts_ms": 1, "source": {"ts_ms": 1, "lsn": i, "table": "TB_FACTURES_PRESTATIONS"}})


def put(root, name, *lines):
    folder = root / "in" / "topic=TB_FACTURES_PRESTATIONS"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def services(spark, root, stream):
    raw = cdc.read_files(spark, str(root / "in"), stream=stream)
    return SERVICES_BY_STATUS.with_derived(cdc.parse_envelope(raw, SERVICES_BY_STATUS))


def drain(spark, root, mode="append"):
    out = window.weekly_by_status(services(spark, root, True), window.WATERMARK)
    (out.writeStream.outputMode(mode).format("parquet").option("path", str(root / "out"))
     .option("checkpointLocation", str(root / "check")).trigger(availableNow=True).start().awaitTermination())


def test_weekly_window_closes_on_thursday_and_drops_late_rows(spark, tmp_path):
    put(tmp_path, "a.json", event(1, "2026-09-03T00:00:00.000Z"), event(2, "2026-09-09T23:59:59.999Z", None, None), event(3, None))
    drain(spark, tmp_path)
    put(tmp_path, "b.json", event(4, "2026-09-10T00:00:31.000Z"))
    drain(spark, tmp_path)
    put(tmp_path, "c.json", event(5, "2026-09-04T00:00:00.000Z"), event(6, "2026-09-11T00:00:00.000Z"))  # 5 is too late
    drain(spark, tmp_path)
    put(tmp_path, "d.json", event(7, "2026-09-20T00:00:00.000Z"))
    drain(spark, tmp_path)
    got = {(str(r.semaine_debut.date()), r.statut_remboursement, r.nombre_prestations, r.montant_total)
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("2026-09-03", "paye", 1, 10.0), ("2026-09-03", "inconnu", 1, 0.0), ("2026-09-10", "paye", 2, 20.0)}
    batch = window.weekly_by_status(services(spark, tmp_path, False))
    assert batch.where("semaine_debut = timestamp_ntz'2026-09-03' and statut_remboursement = 'paye'").first().nombre_prestations == 2


def test_continuous_aggregate_in_update_mode_accepts_any_lateness(spark, tmp_path):
    put(tmp_path, "a.json", event(1, "2026-09-03T00:00:00.000Z"))
    seen = {}
    def keep(df, batch):
        seen.update({r.jour: r.n for r in df.collect()})
    def drain_counts():
        counts = services(spark, tmp_path, True).groupBy(F.to_date("event_time").alias("jour")).agg(F.count(F.lit(1)).alias("n"))
        (counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start().awaitTermination())
    drain_counts()
    put(tmp_path, "b.json", event(2, "2026-10-03T00:00:00.000Z"), event(3, "2026-09-03T10:00:00.000Z"))
    drain_counts()
    assert seen == {dt.date(2026, 9, 3): 2, dt.date(2026, 10, 3): 1}


def test_rejects(spark, tmp_path):
    put(tmp_path, "a.json", event(1, None), event(2, "2026-09-03T00:00:00.000Z", None), event(3, "2026-09-03T00:00:00.000Z", -1.0),
        event(4, "2026-09-03T00:00:00.000Z", 0.0))
    got = {(r.facture_numero, r.motif_rejet_qualite) for r in window.rejected_services(services(spark, tmp_path, False)).collect()}
    assert got == {("F1", "date_creation_manquante"), ("F2", "montant_manquant"), ("F3", "montant_negatif")}


def test_freshness(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-09-01 10:00:00' AS maj_le")
    now = F.lit("2026-09-01 10:06:00").cast("timestamp_ntz")
    r = health.freshness(df, "maj_le", now).first()
    assert (r.age_s, r.alert) == (360.0, True)
    idle = F.lit("2026-09-01 09:59:00").cast("timestamp_ntz")
    assert health.freshness(df, "maj_le", now, source_newest=idle).first().alert is False
    assert health.freshness(df.where("false"), "maj_le", now).first().alert is True


def test_threshold_held(spark):
    t0 = dt.datetime(2026, 9, 1, 10, 58)
    values = [5, 20, 20, 20, 20, 20, 20, 5, 20, None, 20]
    df = spark.createDataFrame([("m", t0 + dt.timedelta(minutes=i), v) for i, v in enumerate(values)], "s string, t timestamp_ntz, v int")
    got = health.threshold_held(df, "s", "t", "v", 10, "5 MINUTES").collect()
    assert [(r.started_at, r.fires_at, r.samples) for r in got] == [(t0 + dt.timedelta(minutes=1), t0 + dt.timedelta(minutes=6), 6)]
    assert health.threshold_held(df, "s", "t", "v", 10, "2 MINUTES").count() == 1
    assert health.threshold_held(df, "s", "t", "v", 10, "2 MINUTES", no_data="alert").count() == 2


def change(i, before, after, lsn):
    def row(amount):
        return amount and json.loads(event(i, "2026-09-03T00:00:00.000Z", *amount))["after"]
    op = "d" if after is None else "u" if before else "c"
    return json.dumps({"before": row(before), "after": row(after), "op": op, "ts_ms": 1, "source": {"ts_ms": 1, "lsn": lsn}})


def weekly(spark, tmp_path, *batches):
    """Messages of both topics after the given batches of events: {key: last value}."""
    for n, lines in enumerate(batches):
        put(tmp_path, f"{n}.json", *lines)
        window.run_weekly(cdc.read_files(spark, str(tmp_path / "in")), str(tmp_path / "check"), {"path": str(tmp_path / "w" / f"n={n}")},
                          {"path": str(tmp_path / "r" / f"n={n}")}, sink="parquet").awaitTermination()
    out = []
    for topic, key in (("w", "statut_remboursement"), ("r", "facture_numero")):
        last: dict = {}
        for r in spark.read.parquet(str(tmp_path / topic)).orderBy("n").collect():
            last[json.loads(r.key)[key]] = r.value and json.loads(r.value)
        out.append(last)
    return out


def test_weekly_job_retracts(spark, tmp_path):
    """Create 10, update to 12, delete; another line delivered twice: only the second line counts."""
    weeks, _ = weekly(spark, tmp_path, [change(1, None, (10.0,), 1), change(2, None, (5.0,), 2)],
                      [change(1, (10.0,), (12.0,), 3), change(2, None, (5.0,), 2)], [change(1, (12.0,), None, 4)])
    (only,) = weeks.values()
    assert (only["nombre_prestations"], only["montant_total"]) == (1, 5.0)
    weeks, _ = weekly(spark, tmp_path, [], [], [], [change(2, (5.0,), None, 5)])
    assert list(weeks.values()) == [None]  # the emptied window is withdrawn


def test_weekly_job_moves_a_line_to_another_week(spark, tmp_path):
    first, later = event(1, "2026-09-03T00:00:00.000Z", 7.0), json.loads(event(1, "2026-09-20T00:00:00.000Z", 7.0))
    later |= {"op": "u", "source": {"ts_ms": 9, "lsn": 9}}
    for n, lines in enumerate(([first], [json.dumps(later)])):
        put(tmp_path, f"{n}.json", *lines)
        window.run_weekly(cdc.read_files(spark, str(tmp_path / "in")), str(tmp_path / "check"), {"path": str(tmp_path / "w" / f"n={n}")},
                          {"path": str(tmp_path / "r" / f"n={n}")}, sink="parquet").awaitTermination()
    got = {json.loads(r.key)["semaine_debut"][:10]: r.value is not None for r in spark.read.parquet(str(tmp_path / "w")).orderBy("n").collect()}
    assert sorted(got.items()) == [("2026-09-03", False), ("2026-09-17", True)]


def test_rejects_are_repaired_for_good(spark, tmp_path):
    _, rejects = weekly(
        spark, tmp_path, [event(1, "2026-09-03T00:00:00.000Z", -1.0), change(2, None, (-2.0,), 2), change(3, None, (-3.0,), 3)],
        [change(2, (-2.0,), (5.0,), 4), change(3, (-3.0,), None, 5), change(4, None, (1.0,), 6), change(4, (1.0,), (2.0,), 7)],
        [change(2, None, (-2.0,), 2), change(3, None, (-3.0,), 3)])  # old events, delivered again
    assert {k: v and v["motif_rejet_qualite"] for k, v in rejects.items()} == {"F1": "montant_negatif", "F2": None, "F3": None}
