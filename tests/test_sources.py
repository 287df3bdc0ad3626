"""Change events, checks on them, and the writers."""

import json

import pytest
from pyspark.sql import functions as F

import events as ev
from dayledger.sources import cdc, sinks
from dayledger.sources.specs import CAPTURED_TABLES, SPECS, UNREAD_TABLES, SourceSpec
from dayledger.streaming.tables import KeyedTable, SumTable, upsert_by_key
from pyspark.sql import types as T


def raw(spark, log, offset=0):
    rows = [(t, i + offset, v) for i, (t, v) in enumerate(log.take())]
    return spark.createDataFrame(rows, "topic string, offset bigint, value string").withColumn("timestamp", F.current_timestamp())


def test_capture_list():
    assert len(CAPTURED_TABLES) == len(set(CAPTURED_TABLES)) == 18
    assert {s.table for s in SPECS.values()} <= set(CAPTURED_TABLES) and len(UNREAD_TABLES) == 3
    for spec in SPECS.values():
        assert set(spec.keys) <= set(spec.columns)
        assert {src for _, src in spec.derived.values()} <= set(spec.columns)


def test_latest_image_wins_whatever_the_arrival(spark):
    log = ev.Log()
    ev.invoice(log, "F1", "2026-09-01")
    ev.invoice(log, "F1", "2026-09-02")
    ev.invoice(log, "F2")
    log.drop("invoices", FACTURE_NUMERO="F2")
    ev.invoice(log, "F3")
    log.resend(0)
    log.resend(2)
    log.lines.append(("TB_FACTURES", None))  # tombstone
    got = cdc.current_state(raw(spark, log), SPECS["invoices"]).collect()
    assert {(r.FACTURE_NUMERO, str(r.jour_soins)) for r in got} == {("F1", "2026-09-02"), ("F3", "2026-09-01")}


def test_snapshot_reads_and_recreated_key(spark):
    log = ev.Log()
    ev.invoice(log, "F1")
    log.drop("invoices", FACTURE_NUMERO="F1")
    ev.invoice(log, "F1", "2026-09-05")
    body = json.loads(log.lines[0][1])
    body.update(op="r", after={**body["after"], "FACTURE_NUMERO": "F9"})
    log.lines.append(("TB_FACTURES", json.dumps(body)))
    got = cdc.current_state(raw(spark, log), SPECS["invoices"]).collect()
    assert {(r.FACTURE_NUMERO, str(r.jour_soins)) for r in got} == {("F1", "2026-09-05"), ("F9", "2026-09-01")}


def test_missing_before_image(spark):
    log = ev.Log()
    ev.invoice(log, "F1")
    ev.invoice(log, "F1", "2026-09-02")
    good = raw(spark, log)
    assert cdc.updates_without_before(good, SPECS["invoices"]).count() == 0
    assert cdc.require_before_images(good, SPECS["invoices"]).count() == 2
    bad = good.withColumn("value", F.regexp_replace("value", r'"before": \{[^}]*\}', '"before": null'))
    assert cdc.updates_without_before(bad, SPECS["invoices"]).count() == 1
    with pytest.raises(Exception, match="before-image"):
        cdc.require_before_images(bad, SPECS["invoices"]).select("op").collect()


def test_misspelt_column_is_caught(spark):
    log = ev.Log()
    log.put("substances", DCI_CODE="D", DCI_DENOMINATION="x")
    events = raw(spark, log)
    cdc.schema_null_guard(cdc.current_state(events, SPECS["substances"]), SPECS["substances"])
    wrong = SourceSpec("substances", "TB_REF_DCI", "DCI_CODE string, DCI_DENOM string", ("DCI_CODE",))
    with pytest.raises(ValueError, match="DCI_DENOM"):
        cdc.schema_null_guard(cdc.current_state(events, wrong), wrong)


def test_allow_list_and_ghosts(spark):
    log = ev.Log()
    ev.invoice(log, "F1")
    log.put("substances", DCI_CODE="D", DCI_DENOMINATION="x")
    assert cdc.allow_tables(raw(spark, log), ["TB_FACTURES"]).count() == 1
    state = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [r.k for r in cdc.find_ghost_rows(state, state.where("k = 'a'"), ["k"]).collect()] == ["b"]


def test_keyed_messages_compact_to_current_rows(spark):
    rows = spark.createDataFrame([("a", 1, False, 1), ("b", 1, False, 2), ("a", 2, False, 3), ("b", None, True, 4)],
                                 "k string, v int, gone boolean, seq int")
    messages = sinks.to_keyed_messages(rows.select("k", "v", "gone"), ["k"], "gone")
    assert messages.where("value is null").count() == 1
    ordered = sinks.to_keyed_messages(rows, ["k"], "gone").withColumn("seq", F.get_json_object("value", "$.seq").cast("int"))
    ordered = ordered.withColumn("seq", F.coalesce("seq", F.lit(4)))
    assert {r.key for r in sinks.latest_messages(ordered, "seq").collect()} == {'{"k":"a"}'}


def test_overwrite_days(spark, tmp_path):
    path = str(tmp_path / "kpi")

    def table(*rows):
        return spark.createDataFrame(list(rows), "jour string, n int")

    def read():
        return {(str(r.jour), r.n) for r in spark.read.parquet(path).collect()}

    sinks.overwrite_days(table(("2026-01-01", 1), ("2026-01-02", 2), ("2026-01-03", 3)), path)
    for _ in range(2):  # the source was reset: other days stay
        sinks.overwrite_days(table(("2026-01-02", 5)), path, keep_history=True)
        assert read() == {("2026-01-01", 1), ("2026-01-02", 5), ("2026-01-03", 3)}
    for _ in range(2):  # the period is recomputed: its emptied day goes, days outside stay
        sinks.overwrite_days(table(("2026-01-01", 7), ("2026-01-03", 9)), path, period=("2026-01-02", "2026-01-03"))
        assert read() == {("2026-01-01", 1), ("2026-01-03", 9)}
    sinks.overwrite_days(table(("2026-01-01", 4)), path)  # a full run replaces the table
    assert read() == {("2026-01-01", 4)}


def test_csv(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([("F1", 1.5)], "facture string, delai_s double").coalesce(1), str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("part-*")).read_text()
    assert text == "facture;delai_s\nF1;1.5\n"


def test_bucketed_tables_join_without_shuffle(spark):
    sinks.write_bucketed(spark.range(100).select("id", F.lit(1).alias("a")), "lines_b", "id", 4)
    sinks.write_bucketed(spark.range(100).select("id", F.lit(2).alias("b")), "heads_b", "id", 4)
    joined = spark.table("lines_b").hint("merge").join(spark.table("heads_b"), "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_upsert_statement():
    assert sinks.upsert_statement("t", "s", ["k"], ["k", "v"]) == (
        "INSERT INTO t (k, v) SELECT k, v FROM s ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v")
    assert sinks.upsert_statement("t", "s", ["k"], ["k"]).endswith("DO NOTHING")


def test_keyed_table_upsert_replay_and_compaction(spark, tmp_path):
    order = "_order struct<lsn:bigint,offset:bigint>"
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(f"k string, v int, _op string, {order}"), ("k",), "k", 4)
    def rows():
        return {(r.k, r.v) for r in table.read().collect()}
    assert rows() == set()
    upsert_by_key(table, spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    for _ in range(2):
        upsert_by_key(table, spark.createDataFrame([("a", 2, False), ("b", 0, True), ("c", 3, False)], "k string, v int, _deleted boolean"), 1)
    assert rows() == {("a", 2), ("c", 3)}
    table.compact(2)
    upsert_by_key(table, spark.createDataFrame([("d", 4)], "k string, v int"), 2)
    assert rows() == {("a", 2), ("c", 3), ("d", 4)}
    assert {(r.k, r.v) for r in table.read(touched=spark.createDataFrame([("a",), ("b",)], "k string")).collect()} == {("a", 2)}
    assert {(r.k, r.v) for r in table.read(before=1).collect()} == {("a", 1), ("b", 1)}


def test_sum_table_drops_emptied_groups(spark, tmp_path):
    schema = T.StructType.fromDDL("jour date, n bigint, m decimal(18,2), maj_le timestamp")
    table = SumTable(spark, str(tmp_path / "s"), schema, ("jour",), "n", ("m",))
    def add(batch, *rows):
        df = spark.createDataFrame(list(rows), "jour string, x string, _sign int")
        df = df.select(F.to_date("jour").alias("jour"), F.col("x").cast("decimal(18,2)").alias("x"), "_sign")
        table.append_signed(df, {"m": "x"}, batch)
    def rows():
        return {(str(r.jour), r.n, str(r.m)) for r in table.read().collect()}
    add(0, ("2026-01-01", "10.10", 1), ("2026-01-01", "5.00", 1))
    add(1, ("2026-01-01", "10.10", -1), ("2026-01-02", "10.10", 1))
    assert rows() == {("2026-01-01", 1, "5.00"), ("2026-01-02", 1, "10.10")}
    table.compact(2)
    add(2, ("2026-01-01", "5.00", -1))
    assert rows() == {("2026-01-02", 1, "10.10")}
