import datetime as dt
import hashlib
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayledger.operators import audit, enrich, evaluate, masking, quality, ranking, reconcile, reshape, rollup
from dayledger.operators.quality import Rule
from dayledger.plans import read_model


def as_set(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_count_pairs_equals_joined_rows(spark):
    a = spark.createDataFrame([("i", "x"), ("i", "x"), ("i", "y"), ("j", "x")], "k string, s string")
    b = spark.createDataFrame([("i", "p"), ("i", "p"), ("i", "q"), ("z", "p")], "k string, c string")
    want = a.join(b, "k").groupBy("s", "c").agg(F.count(F.lit(1)).alias("n"))
    assert as_set(enrich.count_pairs(a, b, "k", "s", "c", "n"), "s", "c", "n") == as_set(want, "s", "c", "n")


# -- ranking -----------------------------------------------------------------------------------


def test_ties_at_the_limit_all_stay(spark):
    data = [(f"p{i}", 100 - i) for i in range(9)] + [(f"t{i}", 50) for i in range(10)] + [("low", 1), ("none", None)]
    df = spark.createDataFrame(data, "person string, n int")
    top = ranking.top_n_with_ties(df, "n", 10)
    assert top.count() == 19 and as_set(top.where("rang = 10"), "n") == {(50,)}


@pytest.mark.parametrize("seed", [1, 2])
def test_grouped_ties_match_rank(spark, seed):
    df = spark.range(2000).select((F.col("id") % 7).alias("g"), "id", F.floor(F.rand(seed) * 40).cast("int").alias("n"))
    df = df.withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("g")))  # one hot group
    df = spark.createDataFrame(df.collect(), df.schema)
    df.createOrReplaceTempView("tied")
    want = spark.sql("SELECT * FROM (SELECT *, rank() OVER (PARTITION BY g ORDER BY n DESC) AS rang FROM tied) WHERE rang <= 5")
    got = ranking.top_n_with_ties(df, "n", 5, by=["g"])
    assert as_set(got, "g", "id", "rang") == as_set(want, "g", "id", "rang")


def test_strict_top_breaks_ties_by_code(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "code string, n int")
    assert [r.code for r in ranking.top_n_strict(df, "n", "code", 2).collect()] == ["c", "a"]


def test_row_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("id"), F.lit("same").alias("hot"))
    got = ranking.row_numbers(df, [], F.shiftright("id", 6), ["hot", "id"])
    assert as_set(got, "id", "k") == {(i, i + 1) for i in range(1000)}
    grouped = ranking.row_numbers(df.withColumn("g", F.when(F.col("id") % 3 > 0, F.col("id") % 3)), ["g"], F.shiftright("id", 6), ["id"])
    assert as_set(grouped, "id", "k") == {(i, i // 3 + 1) for i in range(1000)}


def test_running_total(spark):
    df = spark.range(300).select("id", (F.col("id") % 7).alias("v"))
    got = ranking.running_total(df, [], F.shiftright("id", 4), ["id"], F.col("v"), "t")
    assert as_set(got, "id", "t") == {(i, sum(k % 7 for k in range(i + 1))) for i in range(300)}


@pytest.mark.parametrize("values", [[5], [1, 2], [-3, -3, 10, 2**40, 7], list(range(0, 3_000_000, 70_001)), [4] * 50 + [9]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v bigint")
    r = ranking.exact_quantiles(df, ["g"], "v", {"med": (0.5, "linear"), "p95": (0.95, "linear"), "low": (0.95, "lower")}).first()
    assert r.med == pytest.approx(np.quantile(values, 0.5))
    assert r.p95 == pytest.approx(np.quantile(values, 0.95))
    assert r.low == np.quantile(values, 0.95, method="lower")
    assert (r.n, r["min"], r["max"], r["sum"]) == (len(values), min(values), max(values), sum(values))


@pytest.mark.parametrize("values", [[-6 * 10**18, -5 * 10**18, 6 * 10**18, 7 * 10**18], [3 * 10**18] * 5])
def test_sums_of_delays_beyond_bigint(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v bigint")
    assert ranking.exact_quantiles(df, ["g"], "v", {"med": (0.5, "linear")}).first()["sum"] == sum(values)
    r = evaluate.latency_summary(df, "v", ["g"]).first()
    assert (r.n, r.mean_s) == (len(values), pytest.approx(sum(values) / len(values) / 1e6))


# -- roll-ups ----------------------------------------------------------------------------------


def test_suppression_threshold(spark):
    df = spark.createDataFrame([("four", 4), ("five", 5)], "g string, n int")
    assert as_set(rollup.suppress_small_groups(df, "n"), "g") == {("five",)}


def test_distinct_is_recomputed_not_summed(spark):
    df = spark.createDataFrame([("2026-01-01", "p"), ("2026-01-02", "p"), ("2026-01-02", "q"), ("2026-02-01", None)], "jour string, person string")
    df = df.withColumn("jour", F.to_date("jour"))
    got = rollup.distinct_over(df, "person", "n", [F.trunc("jour", "month").alias("month")])
    assert as_set(got, "n") == {(2,)}
    assert rollup.distinct_over(df, "person", "n").first().n == 2
    assert rollup.distinct_over(df, "person", "n", approximate=True).first().n == 2


def test_long_form_keeps_empty_indicator(spark):
    df = spark.createDataFrame([(1, "A", 2), (2, "B", 3)], "jour int, k string, n int")
    got = reshape.long_form(df, "jour", {"a": F.sum(F.when(F.col("k") == "A", F.col("n"))), "all": F.sum("n")})
    assert as_set(got, "jour", "indicateur", "valeur") == {
        (1, "a", Decimal("2.00")), (1, "all", Decimal("2.00")), (2, "a", None), (2, "all", Decimal("3.00"))}


def test_cross_tab_totals(spark):
    df = spark.createDataFrame([("x", "A", 1), ("x", "B", 2), ("y", "A", 4)], "r string, c string, n int")
    got = as_set(reshape.cross_tab(df, "r", "c", "n", ["A", "B"]), "r", "A", "B", "total")
    assert got == {("x", 1, 2, 3), ("y", 4, 0, 4), ("total", 5, 2, 7)}


# -- quality -----------------------------------------------------------------------------------


def test_first_rule_wins_and_all_mode_keeps_both(spark):
    df = spark.createDataFrame([("a", -5.0, 9), ("b", 1.0, 9), ("c", 1.0, 0), ("d", None, None)], "k string, v double, q int")
    rules = [Rule("NEG", "F1", F.col("v") < 0), Rule("BIG", "F2", F.col("q") > 5)]
    first = quality.quarantine(df, "d", F.col("k"), rules, {"v": "v"})
    assert as_set(first, "cle_metier", "motif_anomalie") == {("a", "NEG"), ("b", "BIG")}
    both = quality.quarantine(df, "d", F.col("k"), rules, {"v": "v"}, mode="all")
    assert as_set(both, "cle_metier", "motif_anomalie") == {("a", "NEG"), ("a", "BIG"), ("b", "BIG")}


def test_volume_guard(spark):
    counts = spark.createDataFrame([("d", "r1", 100), ("d", "r2", 1), ("ghost", "r3", 1)], "domaine string, motif_anomalie string, nombre_lignes bigint")
    source = spark.createDataFrame([("d", 100)], "domaine string, source_rows bigint")
    bad = quality.volume_check(counts, source, 0.5).where("suspect")
    assert as_set(bad, "motif_anomalie") == {("r1",), ("r3",)}
    with pytest.raises(ValueError):
        quality.require_plausible_volume(counts, source, 0.5)


def test_audiences(spark):
    assert not set(read_model.PUBLIC) & set(read_model.NOMINATIVE)
    assert masking.readable("v_top10_medicaments", "public", read_model.GRANTS)
    assert not masking.readable("fait_pathologies", "public", read_model.GRANTS)
    df = spark.createDataFrame([("c", "secret", 4), ("d", "secret", 6)], "c string, s string, n int")
    shown = masking.audience_view(df, ["c", "n"], "n")
    assert shown.columns == ["c", "n"] and as_set(shown, "c") == {("d",)}


# -- reconciliation ----------------------------------------------------------------------------


def test_reconcile_verdicts(spark):
    s = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, n int")
    t = spark.createDataFrame([("a", 1), ("b", 1), ("x", 1), (None, 5)], "k string, n int")
    got = as_set(reconcile.reconcile(s, t, ["k"], ["n"]), "k", "verdict")
    assert got == {("a", "ok"), ("b", "source_ahead"), ("c", "source_ahead"), ("x", "target_ahead"), (None, "target_ahead")}


def test_lag_shrinks_error_stays(spark):
    s = spark.createDataFrame([("lag", 10), ("stuck", 10), ("err", 10), ("ok", 10)], "k string, n int")
    def target(*values):
        return spark.createDataFrame(list(zip(("lag", "stuck", "err", "ok"), values)), "k string, n int")
    one = reconcile.reconcile(s, target(5, 5, 12, 9), ["k"], ["n"])
    two = reconcile.reconcile(s, target(9, 5, 11, 10), ["k"], ["n"])
    assert as_set(reconcile.lag_or_error(one, two, ["k"], "n"), "k", "reading") == {
        ("lag", "lag"), ("stuck", "stuck"), ("err", "error"), ("ok", "ok")}


def test_compare_counts(spark):
    a = spark.createDataFrame([("t1", 1000), ("t2", 1000), ("t3", 0), ("t4", 0), ("gone", 5)], "table_name string, rows bigint")
    b = spark.createDataFrame([("t1", 1004), ("t2", 1006), ("t3", 0), ("t4", 1), ("new", 5)], "table_name string, rows bigint")
    assert as_set(reconcile.compare_counts(a, b, 0.5), "table_name", "verdict") == {
        ("t1", "OK"), ("t2", "ECART"), ("t3", "OK"), ("t4", "ECART"), ("gone", "MANQUANTE"), ("new", "ABSENTE")}


def test_fingerprints(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int")
    text = F.concat("k", F.lit(":"), F.col("n").cast("string"))
    got = reconcile.ordered_md5(df.withColumn("t", text), "t", ["k"], 10).first()
    assert (got.rows, got.fingerprint) == (2, hashlib.md5(b"a:1,b:2").hexdigest())
    best = reconcile.ordered_md5(df.withColumn("t", text), "t", [F.desc("n")], 1).first()
    assert (best.rows, best.fingerprint) == (1, hashlib.md5(b"b:2").hexdigest())
    again = reconcile.fingerprint(df.orderBy("k"), ["k", "n"]).first()
    assert again == reconcile.fingerprint(df.repartition(3), ["k", "n"]).first()
    assert again != reconcile.fingerprint(df.withColumn("n", F.col("n") + 1), ["k", "n"]).first()


# -- audit -------------------------------------------------------------------------------------


def chain(spark, n=5):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    entries = spark.createDataFrame([(i, f"f{i}", sha(f"body{i}")) for i in range(n)], "seq bigint, name string, file_hash string")
    lines = audit.extend_chain("2026-09-01", entries).orderBy("seq").collect()
    prev = audit.GENESIS
    for r in lines:
        assert r.previous == prev and r.chain == sha(prev + r.file_hash + r.name)
        prev = r.chain
    return [r.asDict() for r in lines]


def verify(spark, lines, hashes=None):
    rows = [(i + 1, r["name"], r["file_hash"], r["previous"], r["chain"]) for i, r in enumerate(lines)]
    manifest = spark.createDataFrame(rows, "pos bigint, name string, file_hash string, previous string, chain string")
    actual = spark.createDataFrame(list((hashes or {r["name"]: r["file_hash"] for r in lines}).items()), "name string, actual_hash string")
    checked = audit.verify_chain(manifest, actual, "pos")
    return {r["name"]: [c for c in ("missing", "altered", "broken", "invalid") if r[c]] for r in checked.collect()}, audit.chain_verdict(checked).first()


def test_chain_intact_and_every_fault(spark):
    lines = chain(spark)
    faults, verdict = verify(spark, lines)
    assert not any(faults.values()) and verdict.conform and verdict.entries == 5
    assert verify(spark, lines[:2] + lines[3:])[0]["f3"] == ["broken"]
    swapped = [lines[0], lines[2], lines[1], lines[3], lines[4]]
    assert all("broken" in verify(spark, swapped)[0][n] for n in ("f1", "f2", "f3"))
    hashes = {r["name"]: r["file_hash"] for r in lines}
    assert verify(spark, lines, {**hashes, "f2": "0"})[0]["f2"] == ["altered"]
    del hashes["f1"]
    faults, verdict = verify(spark, lines, hashes)
    assert faults["f1"] == ["missing"] and not verdict.conform
    edited = [dict(r) for r in lines]
    edited[4]["chain"] = "0" * 64
    assert verify(spark, edited)[0]["f4"] == ["invalid"]


def test_hash_files(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"abc")
    got = audit.hash_files(spark.read.format("binaryFile").load(str(tmp_path)))
    assert as_set(got, "name", "file_hash") == {("a.log", hashlib.sha256(b"abc").hexdigest())}


# -- evaluation --------------------------------------------------------------------------------


def test_recall(spark):
    inj = spark.createDataFrame([("A", "1"), ("A", "2"), ("A", "2"), ("B", "3")], "code string, key string")
    det = spark.createDataFrame([("A", "1"), ("A", "9"), ("A", "9"), ("C", "4")], "code string, key string")
    assert as_set(evaluate.recall_by_code(inj, det), "code", "injected", "found", "surplus") == {
        ("A", 2, 1, 1), ("B", 1, 0, 0), ("TOTAL", 3, 1, 1)}
    assert as_set(evaluate.codes_never_injected(inj, det), "code", "detected") == {("C", 1)}


def test_recall_with_cause(spark):
    inj = spark.createDataFrame([("A", "1"), ("A", "2"), ("A", ""), ("A", None), ("D", "5")], "code string, key string")
    det = spark.createDataFrame([("A", "1"), ("B", "2"), ("B", "")], "code string, key string")
    report = evaluate.recall_with_cause(inj, det, ["D"])
    assert as_set(report, "code", "injected", "found", "other_reason", "without_key", "covered") == {
        ("A", 4, 1, 1, 2, True), ("D", 1, 0, 0, 0, False)}
    total = evaluate.covered_recall(report).first()
    assert (total.injected, total.found, total.recall_pct) == (4, 1, Decimal("25.0"))


def test_first_sample_matches_scan(spark):
    t0 = dt.datetime(2026, 1, 1)
    samples = [(t0 + dt.timedelta(seconds=i), c) for i, c in enumerate([100, 101, 101, 140, 139, 90_000, 200_000])]
    arrivals = [(k, t0) for k in (1, 2, 30, 40, 80_000, 99_900, 99_901)]
    got = evaluate.kth_arrival(spark.createDataFrame(arrivals, "k bigint, created timestamp_ntz"),
                               spark.createDataFrame(samples, "ts timestamp_ntz, c bigint"), 100, "created", "c", "ts")
    # By hand: 101 is first read at 1 s, 130 and 140 at 3 s, 90,000 at 5 s, all higher counts at 6 s.
    seconds = {1: 1, 2: 3, 30: 3, 40: 3, 80_000: 5, 99_900: 6}
    assert {r.k: (r.seen_at - t0).total_seconds() for r in got.collect() if r.k <= 99_900} == seconds


def test_recovery_summary(spark):
    probes = spark.createDataFrame(
        [(10.0, 5, 9, 0), (20.0, 4, 9, 10), (30.0, 8, 8, 50), (40.0, 8, 8, 100), (50.0, 1, 1, 100)],
        "t_s double, invoices bigint, services bigint, events_read bigint")
    r = evaluate.recovery_summary(probes, 8, 8, 100, relaunched_at=5.0, running_at=15.0).first()
    assert (r.equal_at_s, r.done_at_s, r.recovery_s, r.events_read, r.events_per_s) == (30.0, 40.0, 35.0, 100, 4.0)
    assert (r.lowest_invoices, r.lowest_services) == (4, 9)
