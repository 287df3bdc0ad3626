"""The star-schema tables in their analytic roles.

orders = invoices (and prior-authorisation requests), lineitem = service lines, supplier = centre,
part = act or medicine, customer = insured person, nation = locality; the line numbered 1 of an
order stands for the answer to its request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import scalars as S
from dayledger.operators import daily, enrich
from dayledger.sources.tables import table

AS_OF = "2001-07-15"


Period = tuple[str | None, str | None]


def orders(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    """Orders, cut to whole days on the stored column so that the range reaches the scan."""
    df = table(spark, d, "orders")
    first, last = period or (None, None)
    if first:
        df = df.where(F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
    if last:
        df = df.where(F.col("o_orderdate") < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz"))
    return df


def invoices(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return enrich.project(orders(spark, d, period), {
        "invoice": "o_orderkey", "person": F.col("o_custkey").cast("string"), "care_day": F.col("o_orderdate").cast("date"),
        "invoice_type": "o_orderstatus", "scheme": "o_orderpriority"})


def lines(spark: SparkSession, d: str) -> DataFrame:
    price, share = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(4,2)")
    return enrich.project(table(spark, d, "lineitem"), {
        "invoice": "l_orderkey", "act": "l_returnflag", "centre_type": "l_linestatus",
        "centre": F.col("l_suppkey").cast("string"), "practitioner": F.col("l_partkey").cast("string"),
        "billed": price, "insurer_paid": price * (F.lit(1).cast("decimal(4,2)") - share),
        "patient_paid": price * share})


def enriched(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    names = ("act", "invoice_type", "scheme", "centre_type", "centre", "practitioner", "person")
    amounts = ("billed", "insurer_paid", "patient_paid")
    return enrich.enrich_lines(lines(spark, d), invoices(spark, d, period), "invoice", "care_day",
                               {n: n for n in names}, {a: a for a in amounts})


def service_units(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    """Service lines as a daily table of one line each: roll-ups that keep no day group these at their
    own grain at once, with one shuffle."""
    return enriched(spark, d, period).withColumn("n_services", F.lit(1))


SERVICE_KEYS = ["jour", "act", "invoice_type", "scheme", "centre_type"]


def services_day(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return daily.count_and_sum(enriched(spark, d, period), SERVICE_KEYS, "n_services", {
        "billed": "billed", "insurer_paid": "insurer_paid", "patient_paid": "patient_paid"})


def centre_day(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return daily.count_and_sum(enriched(spark, d, period), ["jour", "centre"], "n_services", {"billed": "billed"})


def practitioner_day(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return daily.count_and_sum(enriched(spark, d, period), ["jour", "practitioner"], "n_services", {"billed": "billed"})


def person_day(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return daily.count_and_sum(enriched(spark, d, period), ["jour", "person", "centre"], "n_services", {"billed": "billed"})


def invoice_units(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    dated = enrich.dated(invoices(spark, d, period).withColumnRenamed("care_day", "jour"))
    return enrich.coalesce_dims(dated, {"invoice_type": S.UNKNOWN, "scheme": S.UNKNOWN}).withColumn("n_invoices", F.lit(1))


def invoices_day(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return daily.count_and_sum(invoice_units(spark, d, period).drop("n_invoices"), ["jour", "invoice_type", "scheme"], "n_invoices")


def requests(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return enrich.project(orders(spark, d, period), {
        "request": "o_orderkey", "request_type": "o_orderpriority", "request_time": "o_orderdate"})


def answers(spark: SparkSession, d: str) -> DataFrame:
    """Last answer per request wins; every tenth centre answers without an agent."""
    first = table(spark, d, "lineitem").where("l_linenumber = 1")
    last = first.groupBy(F.col("l_orderkey").alias("request")).agg(
        F.max(F.struct("l_shipdate", "l_returnflag", "l_suppkey")).alias("m"))
    return last.select(
        "request", F.col("m.l_returnflag").alias("status_code"),
        (F.col("m.l_shipdate") + F.expr("INTERVAL 90 MINUTE")).alias("answer_time"),
        F.when(F.col("m.l_suppkey") % 10 != 0, (F.col("m.l_suppkey") % 20).cast("string")).alias("agent_code"))


def amounts(spark: SparkSession, d: str) -> DataFrame:
    acts = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "request")
    return enrich.sum_per_key(acts, "request", "l_extendedprice", "amount")


def requests_enriched(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return enrich.left_status(requests(spark, d, period), answers(spark, d), amounts(spark, d), "request")


def request_units(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return requests_enriched(spark, d, period).withColumns({"n_requests": F.lit(1), "engaged_amount": F.col("amount")})


def requests_day(spark: SparkSession, d: str, period: Period | None = None) -> DataFrame:
    return daily.requests_day(requests_enriched(spark, d, period), ["jour", "status_code", "request_type"])


def agent_day(spark: SparkSession, d: str) -> DataFrame:
    answered = requests_enriched(spark, d).where(F.col("agent_code").isNotNull())
    return daily.count_and_sum(answered, ["jour", "agent_code", "status_code"], "n_requests")


def medicine_units(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("jour"),
                                              F.col("l_partkey").alias("medicine"), F.lit(1).alias("n_prescriptions"))


def medicine_day(spark: SparkSession, d: str) -> DataFrame:
    return daily.count_and_sum(medicine_units(spark, d).drop("n_prescriptions"), ["jour", "medicine"], "n_prescriptions")


def pathology_day(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("ts").cast("date").alias("jour"),
                                            F.col("event_type").alias("pathology"))
    return daily.count_and_sum(rows, ["jour", "pathology"], "n_pathologies")


def pathologies(spark: SparkSession, d: str) -> DataFrame:
    """Line-level second fact of an invoice: (invoice, pathology)."""
    return table(spark, d, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("invoice"), F.col("l_suppkey").alias("pathology"))


def clinical_detail(spark: SparkSession, d: str) -> DataFrame:
    """One row per request with its status and the clinical counts of its invoice."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("request"), F.col("l_partkey").alias("item"))
    per_items = daily.items_per_header(items, "request", "item", "n_items", "n_distinct_items")
    per_path = daily.counts_by(pathologies(spark, d), ["invoice"], "n_pathologies").withColumnRenamed("invoice", "request")
    joined = (requests(spark, d).join(answers(spark, d), "request", "left")
              .join(per_items, "request", "left").join(per_path, "request", "left"))
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "request", S.or_unknown("request_type").alias("request_type"),
        S.or_unknown("status_code", S.UNANSWERED).alias("status_code"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_items", "n_distinct_items", "n_pathologies")])
