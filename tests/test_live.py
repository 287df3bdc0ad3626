"""The continuous job on the state store: same tables as the batch plan and as ``Ledger``."""

import pytest

import events as ev
from dayledger.plans import claims
from dayledger.sources import cdc
from dayledger.sources.specs import SPECS
from dayledger.streaming import files, live, tables
from dayledger.streaming.live import LiveLedger, run_live
from test_pipeline import AS_OF, assert_same, rows


def run(spark, ledger, src, checkpoint):
    run_live(cdc.read_files(spark, src), ledger, checkpoint).awaitTermination()


def test_corrections_deletes_and_replays(spark, tmp_path):
    """Everything, then corrections with old events delivered again, then the same files once more."""
    src, check = f"{tmp_path}/in", f"{tmp_path}/check"
    log = ev.Log()
    ev.first_batch(log)
    log.resend(0)
    stale = list(log.lines[:30])
    ev.write(log.take(), src, "a")
    ledger = LiveLedger(spark, f"{tmp_path}/out", buckets=2, history=False, as_of=AS_OF)
    run(spark, ledger, src, check)
    ev.second_batch(log)
    second = log.take()
    ev.write(second + stale, src, "b")
    run(spark, ledger, src, check)
    assert_same(spark, ledger, src, claims.TABLE_KEYS)
    before = {n: rows(ledger.tables()[n]) for n in ("kpi_prestations_jour", "qualite_anomalies")}
    ev.write(second, src, "c")
    run(spark, ledger, src, check)
    assert before == {n: rows(ledger.tables()[n]) for n in before}
    with pytest.raises(ValueError, match="another checkpoint"):
        run(spark, ledger, src, f"{tmp_path}/other")
    assert not files.has(spark, f"{tmp_path}/out/writer.lock")


def test_keys_read_back(spark):
    raw = spark.createDataFrame([
        ("TB_FACTURES_PRESTATIONS", '{"op":"c","after":{"FACTURE_NUMERO":"a:1","PRESTATION_CODE":"x"},"source":{"lsn":3}}', 5),
        ("TB_ENTENTES_PREALABLES", '{"op":"d","before":{"ENTENTE_PREALABLE_ID":7},"after":null,"source":{"ts_ms":9}}', None),
        ("TB_FACTURES_PRESTATIONS", '{"op":"c","after":{"FACTURE_NUMERO":"a"},"source":{}}', 1), ("TB_OTHER", '{"op":"c","after":{}}', 1),
        ("TB_FACTURES", None, 1)], "topic string, value string, offset long")
    got = sorted((r.family, r.key, r.source, r.pk, r.op, r.lsn, r.position) for r in live.images(raw).collect())
    assert got == [("invoice", "3:a:1", "services", "3:a:11:x", "c", 3, 5), ("request", "1:7", "requests", "1:7", "d", 9, -1)]
    assert live.key_of("3:a:11:x") == "3:a:1"


class Store(dict):
    """A map state in memory."""
    getValue, containsKey, updateValue = dict.get, dict.__contains__, dict.__setitem__

    def iterator(self):
        return iter(list(self.items()))


def step(store, family, *events):
    from pyspark.sql import Row
    operator = live.Changes()
    operator.rows = store
    rows = [Row(source=s, pk=p, image=i, op=o, lsn=n, position=0) for s, p, i, o, n in events]
    return [(r.source, r.pk, r.image, r.side, r.context) for r in operator.handleInputRows((family, "1:f"), iter(rows), None)]


def test_a_changed_line_brings_its_header_only():
    store = Store()
    step(store, "invoice", ("invoices", "1:f", "H", "c", 1), *[("services", f"1:f1:{k}", f"L{k}", "c", 2) for k in "abc"])
    got = step(store, "invoice", ("services", "1:f1:a", "L2", "u", 3))
    assert got == [("services", "1:f1:a", "La", -1, False), ("services", "1:f1:a", "L2", 1, False),
                   ("invoices", "1:f", "H", -1, True), ("invoices", "1:f", "H", 1, True)]
    got = step(store, "invoice", ("invoices", "1:f", "H2", "u", 4))
    assert len(got) == 2 + 2 * 3  # a changed header brings all lines on both sides


def test_old_equal_and_deleted_rows():
    store = Store()
    assert step(store, "agents", ("agents", "1:x", "A", "c", 5)) == [("agents", "1:x", "A", 1, False)]
    assert step(store, "agents", ("agents", "1:x", "B", "u", 4)) == []  # older
    assert step(store, "agents", ("agents", "1:x", "A", "u", 6)) == []  # nothing new
    assert step(store, "agents", ("agents", "1:x", "A", "d", 7)) == [("agents", "1:x", "A", -1, False), ("agents", "1:x", "A", 1, False)]
    assert step(store, "agents", ("agents", "1:x", "A", "c", 5)) == []  # the tombstone stays
    assert step(store, "agents", ("agents", "1:x", "C", "c", 8)) == [("agents", "1:x", "C", 1, False)]


def test_runs_are_merged_by_size(spark, tmp_path):
    """What merges rewrite follows the batches they cover, never the table; few runs remain for a read."""
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL("k string, v int, _op string, _order struct<lsn:bigint,offset:bigint>")
    table = tables.KeyedTable(spark, str(tmp_path / "t"), schema, ("k",), "k", 4)
    written = []

    def append(batch, n):
        df = spark.range(n).selectExpr(f"concat('{batch}-', id) k", "1 v", "'c' _op", f"named_struct('lsn', {batch}L, 'offset', 0L) _order")
        table.append(df, batch)
        held = set(table.finished())
        table.merge_due(batch)
        written.append(sum(b - a + 1 for a, b in set(table.finished()) - held))

    append(0, 20_000)
    for batch in range(1, 4 * tables.FAN):
        append(batch, 1)
    assert table.read().count() == 20_000 + 4 * tables.FAN - 1
    assert written[tables.FAN - 1::tables.FAN] == [tables.FAN] * 4 and sum(written) == 4 * tables.FAN  # batches rewritten, each once
    assert table.runs() == [(0, 7), (8, 15), (16, 23), (24, 31)] and len(table.finished()) <= 4 + tables.FAN
    assert [table._read([s], schema).count() for s in table.runs()] == [20_007, 8, 8, 8]  # later merges leave the large first run alone
    with pytest.raises(ValueError):
        table.compact(12)
    table.compact(4 * tables.FAN)
    table.vacuum()
    assert table.finished() == [(0, 31)] and table.read().count() == 20_000 + 4 * tables.FAN - 1


def test_lookups_open_touched_buckets_in_every_run(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL("k string, v int, _op string, _order struct<lsn:bigint,offset:bigint>")
    table = tables.KeyedTable(spark, str(tmp_path / "t"), schema, ("k",), "k", 16)
    for batch in (0, 1):
        table.append(spark.range(400).selectExpr("cast(id as string) k", f"{batch} v", "'c' _op", f"named_struct('lsn', {batch}L, 'offset', 0L) _order"), batch)
    touched = spark.createDataFrame([("7",)], "k string")
    found = table.versions(touched=touched)
    assert sorted(r.v for r in found.collect()) == [0, 1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters", 1)[1].split("]")[0]
    assert [r.v for r in table.read(touched=touched).collect()] == [1]
