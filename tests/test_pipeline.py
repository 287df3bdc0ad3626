"""The continuous job against the batch plan on the same events."""

import pytest

import events as ev
from dayledger.plans import batch, claims, read_model
from dayledger.sources import cdc
from dayledger.sources.specs import SPECS
from dayledger.streaming import files
from dayledger.streaming.pipeline import Ledger, run_pipeline

AS_OF = "2026-09-30"
DAILY = [n for n in claims.TABLE_KEYS if n.startswith("kpi_")]


def rows(df, drop=("maj_le", "detecte_le")):
    df = df.drop(*drop)
    names = sorted(df.columns)
    return sorted((tuple(str(r[c]) for c in names) for r in df.collect()))


def batch_tables(spark, path):
    raw = cdc.read_files(spark, path, stream=False)
    return claims.all_tables({n: cdc.current_state(raw, s) for n, s in SPECS.items()}, AS_OF)


def run(spark, ledger, src, checkpoint, **kw):
    query = run_pipeline(cdc.read_files(spark, src), ledger, checkpoint, **kw)
    query.awaitTermination()


def assert_same(spark, ledger, src, tables):
    expected = batch_tables(spark, src)
    got = ledger.tables()
    for name in tables:
        assert rows(got[name]) == rows(expected[name].select(*[c for c in got[name].columns if c in expected[name].columns])), name


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    """Two micro-batches with corrections and re-deliveries, compacted after the first."""
    root = str(tmp_path_factory.mktemp("ledger"))
    src, target, check = f"{root}/in", f"{root}/out", f"{root}/check"
    log = ev.Log()
    ev.first_batch(log)
    log.resend(0)
    log.resend(1)
    stale = list(log.lines[:30])
    ev.write(log.take(), src, "a")
    ledger = Ledger(spark, target, buckets=4, history=False, as_of=AS_OF)
    run(spark, ledger, src, check)
    ledger.compact(ledger.committed())
    first = rows(ledger.tables()["kpi_prestations_jour"])
    ev.second_batch(log)
    # Old events delivered again after their correction must not win.
    ev.write(log.take() + stale, src, "b")
    run(spark, ledger, src, check)
    return {"ledger": ledger, "src": src, "check": check, "first": first, "root": root}


def test_corrections_match_batch(spark, done):
    assert_same(spark, done["ledger"], done["src"], claims.TABLE_KEYS)
    days = {r["jour"].isoformat() for r in done["ledger"].tables()["kpi_factures_jour"].collect()}
    assert "2026-08-15" in days
    assert done["first"] != rows(done["ledger"].tables()["kpi_prestations_jour"])


def test_emptied_group_is_gone(done):
    # Every invoice of 2026-09-01 except F21 moved away; groups without rows must not stay at zero.
    left = done["ledger"].tables()["kpi_prestations_jour"].where("nombre_prestations <= 0").count()
    assert left == 0


def test_restart_without_new_data_changes_nothing(spark, done):
    before = done["ledger"].committed()
    run(spark, done["ledger"], done["src"], done["check"])
    assert before == done["ledger"].committed()


def test_full_replay_is_idempotent(spark, done):
    some = DAILY[:3]
    before = {n: rows(done["ledger"].tables()[n]) for n in some}
    run(spark, done["ledger"], done["src"], done["root"] + "/check2")
    assert before == {n: rows(done["ledger"].tables()[n]) for n in some}


def test_second_writer_is_refused(spark, tmp_path):
    """Defaults everywhere: another checkpoint is refused while a job runs, and let in when it has ended."""
    src, target = f"{tmp_path}/in", f"{tmp_path}/out"
    log = ev.Log()
    ev.invoice(log, "F1")
    ev.write(log.take(), src, "a")
    ledger = Ledger(spark, target, buckets=2)
    running = run_pipeline(cdc.read_files(spark, src), ledger, f"{tmp_path}/one")
    with pytest.raises(files.WriterBusy):
        run_pipeline(cdc.read_files(spark, src), ledger, f"{tmp_path}/two")
    running.awaitTermination()
    run(spark, ledger, src, f"{tmp_path}/one")
    run(spark, ledger, src, f"{tmp_path}/two")


def test_claim_is_of_one_checkpoint(spark, tmp_path):
    files.acquire(spark, str(tmp_path), "checkpoint a")
    files.acquire(spark, str(tmp_path), "checkpoint a")
    with pytest.raises(files.WriterBusy):
        files.acquire(spark, str(tmp_path), "checkpoint b")
    files.release(spark, str(tmp_path), "checkpoint b")
    assert files.has(spark, f"{tmp_path}/writer.lock")
    files.release(spark, str(tmp_path), "checkpoint a")
    files.acquire(spark, str(tmp_path), "checkpoint b")


def test_views_over_streaming_tables(spark, done):
    names = read_model.register(spark, done["ledger"].tables(), "2026-10-15")
    assert "v_top10_assures" in names
    top = spark.sql("SELECT * FROM v_top10_assures ORDER BY rang, personne_uuid").collect()
    assert top[0]["rang"] == 1
    figures = spark.sql("SELECT indicateur, sum(valeur) AS v FROM v_synthese WHERE indicateur LIKE '%prestations%' OR indicateur LIKE 'Prestations%' GROUP BY 1").collect()
    assert len(figures) == 2 and len({r["v"] for r in figures}) == 1  # the total, and the acts that add up to it
    for domain in read_model.DETAIL_FIELDS:
        n = spark.sql(f"SELECT count(*) AS n FROM qualite_anomalies WHERE domaine = '{domain}'").first()["n"]
        assert spark.table(f"v_anomalies_{domain}").count() == n
        assert spark.table(f"v_anomalies_{domain}").where("cle_metier IS NULL").count() == 0


def test_vacuum_keeps_results(spark, done):
    ledger = done["ledger"]
    some = ("kpi_prestations_jour", "kpi_ententes_prealables_jour", "qualite_anomalies", "dim_agents")
    before = {n: rows(ledger.tables()[n]) for n in some}
    ledger.compact(ledger.committed())
    ledger.vacuum()
    assert before == {n: rows(ledger.tables()[n]) for n in some}


def test_history_keeps_corrected_anomalies(spark, tmp_path):
    src, target = f"{tmp_path}/in", f"{tmp_path}/out"
    log = ev.Log()
    ev.invoice(log, "F1")
    ev.service(log, "F1", "XXX")
    ev.write(log.take(), src, "a")
    ledger = Ledger(spark, target, buckets=2)
    run(spark, ledger, src, f"{tmp_path}/check")
    first = ledger.tables()["qualite_anomalies"].collect()
    assert [r["motif_anomalie"] for r in first] == ["PRESTATION_ORPHELINE"]
    log.drop("services", FACTURE_NUMERO="F1", PRESTATION_CODE="XXX")
    ev.service(log, "F1", "CONS-GEN", PRESTATION_MONTANT_DEPENSE=-1.0)
    ev.write(log.take(), src, "b")
    run(spark, ledger, src, f"{tmp_path}/check")
    after = {r["motif_anomalie"]: r["detecte_le"] for r in ledger.tables()["qualite_anomalies"].collect()}
    assert set(after) == {"PRESTATION_ORPHELINE", "MONTANT_ABERRANT"}
    assert after["PRESTATION_ORPHELINE"] == first[0]["detecte_le"]


def test_retried_batch_is_applied_once(spark, tmp_path):
    log = ev.Log()
    ev.invoice(log, "F1")
    ev.service(log, "F1")
    ev.write(log.take(), f"{tmp_path}/in", "a")
    ledger = Ledger(spark, f"{tmp_path}/out", buckets=2)
    raw = cdc.read_files(spark, f"{tmp_path}/in", stream=False)
    ledger.process(raw, 0)
    files.remove(spark, f"{tmp_path}/out/done/batch=0")  # as if the job died before its last write
    ledger.process(raw, 0)
    assert [r["nombre_prestations"] for r in ledger.tables()["kpi_prestations_jour"].collect()] == [1]


def test_batch_run_matches_and_reruns(spark, done, tmp_path):
    raw = cdc.read_files(spark, done["src"], stream=False)
    src = {n: cdc.current_state(raw, s) for n, s in SPECS.items()}
    some = ["kpi_prestations_jour", "kpi_ententes_prealables_jour", "dim_agents", "qualite_anomalies"]
    for _ in range(2):
        batch.write_all(src, str(tmp_path), AS_OF, some)
    for name in some:
        got = spark.read.parquet(f"{tmp_path}/{name}")
        want = done["ledger"].tables()[name]
        assert rows(got.select(*want.columns)) == rows(want), name
