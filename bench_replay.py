"""Replay throughput of the continuous job: change events of all orders and lines, one micro-batch.

Events are derived from the tables at $BENCH_SF_DIR and written once to a new temporary folder; the
timed part reads, decodes, applies and writes them to the target tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from dayledger.session import local_session  # noqa: E402
from dayledger.sources import cdc  # noqa: E402
from dayledger.sources.tables import table  # noqa: E402
from dayledger.streaming.pipeline import Ledger, run_pipeline  # noqa: E402


def envelopes(df, name, image):
    position = F.monotonically_increasing_id()
    source = F.struct(F.lit(1).cast("bigint").alias("ts_ms"), position.alias("lsn"), F.lit(name).alias("table"))
    body = F.struct(F.struct(*[c.alias(n) for n, c in image.items()]).alias("after"), F.lit("c").alias("op"),
                    F.lit(1).cast("bigint").alias("ts_ms"), source.alias("source"))
    return df.repartition(8).select(F.to_json(body).alias("value"), F.lit(name).alias("topic"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "replay")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    text = lambda c: F.col(c).cast("string")
    invoices = envelopes(table(spark, sf_dir, "orders"), "TB_FACTURES", {
        "FACTURE_NUMERO": text("o_orderkey"), "TYPE_FACTURE_CODE": F.col("o_orderstatus"),
        "REGIME_CODE": F.col("o_orderpriority"), "CENTRE_SANTE_CODE": (F.col("o_custkey") % 100).cast("string"),
        "CENTRE_SANTE_TYPE_CODE": F.lit("CHU"), "CENTRE_SANTE_TYPE_LIBELLE": F.lit("Hopital"), "PERSONNE_UUID": text("o_custkey"),
        "FACTURE_DATE_SOINS": F.unix_date(F.col("o_orderdate").cast("date")),
        "DATE_CREATION": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")})
    services = envelopes(table(spark, sf_dir, "lineitem"), "TB_FACTURES_PRESTATIONS", {
        "FACTURE_NUMERO": text("l_orderkey"), "PRESTATION_CODE": text("l_linenumber"), "PROFESSIONNEL_SANTE_CODE": text("l_partkey"),
        "PRESTATION_MONTANT_DEPENSE": F.col("l_extendedprice"), "PRESTATION_MONTANT_RQ": F.col("l_extendedprice"),
        "PRESTATION_MONTANT_ASSURE": F.lit(0.0), "PRESTATION_QUANTITE_PRESCRITE": F.col("l_quantity"),
        "PRESTATION_QUANTITE_SERVIE": F.col("l_quantity"), "PRESTATION_TAUX_REMBOURSEMENT": F.lit(70.0)})
    invoices.unionByName(services).write.partitionBy("topic").text(f"{root}/in")
    events = spark.read.text(f"{root}/in").count()
    ledger = Ledger(spark, f"{root}/out")
    started = time.perf_counter()
    run_pipeline(cdc.read_files(spark, f"{root}/in"), ledger, f"{root}/check").awaitTermination()
    seconds = time.perf_counter() - started
    counted = ledger.tables()["kpi_prestations_jour"].agg(F.sum("nombre_prestations")).first()[0]
    print(json.dumps({"metric": "replay_throughput", "value": round(events / seconds, 1), "unit": "events/s", "events": events,
                      "seconds": round(seconds, 2), "services": counted, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
