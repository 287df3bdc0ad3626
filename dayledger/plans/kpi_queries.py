"""Registered queries: daily aggregates, roll-ups, rankings, rates and clinical views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import scalars as S
from dayledger.operators import daily, enrich, masking, ranking, reshape, rollup
from dayledger.plans import star
from dayledger.plans.registry import (ANSWERS, DETAIL, ENRICHED, REQUESTS, REQUESTS_DAY, cents, half_up, query,
                                      with_)
from dayledger.sources.tables import table

AS_OF = star.AS_OF

# -- daily grain -------------------------------------------------------------------------------


@query(with_(ENRICHED) + """
SELECT jour, act, invoice_type, scheme, centre_type, count(*) AS n_services,
       CAST(sum(billed) AS DECIMAL(18,2)) AS billed, CAST(sum(insurer_paid) AS DECIMAL(18,2)) AS insurer_paid,
       CAST(sum(patient_paid) AS DECIMAL(18,2)) AS patient_paid
FROM enr GROUP BY ALL""")
def kpi_services_day(spark: SparkSession, d: str) -> DataFrame:
    return star.services_day(spark, d)


@query(with_(ENRICHED) + "SELECT jour, centre, count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed "
       "FROM enr GROUP BY ALL")
def kpi_services_centre_day(spark: SparkSession, d: str) -> DataFrame:
    return star.centre_day(spark, d)


@query(with_(ENRICHED) + "SELECT jour, practitioner, count(*) AS n_services, "
       "CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr GROUP BY ALL")
def kpi_services_practitioner_day(spark: SparkSession, d: str) -> DataFrame:
    return star.practitioner_day(spark, d)


@query(with_(ENRICHED) + "SELECT jour, person, centre, count(*) AS n_services, "
       "CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr GROUP BY ALL")
def kpi_services_person_day(spark: SparkSession, d: str) -> DataFrame:
    return star.person_day(spark, d)


@query("SELECT CAST(o_orderdate AS DATE) AS jour, o_orderstatus AS invoice_type, o_orderpriority AS scheme, "
       "count(*) AS n_invoices FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL")
def kpi_invoices_day(spark: SparkSession, d: str) -> DataFrame:
    return star.invoices_day(spark, d)


@query(with_(REQUESTS_DAY) + "SELECT jour, status_code, request_type, n_requests, "
       "CAST(mean_delay_hours AS DECIMAL(10,2)) AS mean_delay_hours, engaged_amount FROM rday")
def kpi_ep_day(spark: SparkSession, d: str) -> DataFrame:
    return star.requests_day(spark, d)


@query(with_(REQUESTS) + "SELECT jour, agent_code, status_code, count(*) AS n_requests FROM req "
       "WHERE agent_code IS NOT NULL GROUP BY ALL")
def kpi_ep_agent_day(spark: SparkSession, d: str) -> DataFrame:
    return star.agent_day(spark, d)


@query("SELECT l_orderkey AS request, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount "
       "FROM lineitem GROUP BY 1")
def amount_per_request(spark: SparkSession, d: str) -> DataFrame:
    return star.amounts(spark, d)


@query("SELECT CAST(l_shipdate AS DATE) AS jour, l_partkey AS medicine, count(*) AS n_prescriptions "
       "FROM lineitem GROUP BY ALL")
def kpi_prescriptions_medicine_day(spark: SparkSession, d: str) -> DataFrame:
    return star.medicine_day(spark, d)


@query("SELECT CAST(ts AS DATE) AS jour, event_type AS pathology, count(*) AS n_pathologies FROM events GROUP BY ALL")
def kpi_pathologies_day(spark: SparkSession, d: str) -> DataFrame:
    return star.pathology_day(spark, d)


# -- periods and totals ------------------------------------------------------------------------

_SERVICE_SUMS = ({"n_services": "n_services"}, {"billed": "billed"})


@query(with_(ENRICHED) + "SELECT jour, count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed "
       "FROM enr GROUP BY 1")
def services_by_day(spark: SparkSession, d: str) -> DataFrame:
    return rollup.additive(star.service_units(spark, d), ["jour"], *_SERVICE_SUMS)


@query(with_(ENRICHED) + f"""
SELECT CAST(date_trunc('week', jour) AS DATE) AS week, count(*) AS n_services,
       CAST(sum(billed) AS DECIMAL(18,2)) AS billed,
       {half_up('100 * ' + cents('sum(insurer_paid)'), cents('sum(billed)'), 1)} AS coverage_pct
FROM enr GROUP BY 1""")
def services_by_week(spark: SparkSession, d: str) -> DataFrame:
    rate = S.percent(F.sum("insurer_paid"), F.sum("billed")).alias("coverage_pct")
    return rollup.weekly(star.service_units(spark, d), *_SERVICE_SUMS, extra=[rate])


@query(with_(ENRICHED) + f"""
SELECT CAST(date_trunc('month', jour) AS DATE) AS month, count(*) AS n_services,
       CAST(sum(billed) AS DECIMAL(18,2)) AS billed
FROM enr WHERE jour < date_trunc('month', DATE '{AS_OF}') GROUP BY 1""")
def services_by_month_closed(spark: SparkSession, d: str) -> DataFrame:
    return rollup.monthly_closed(star.service_units(spark, d, (None, AS_OF)), AS_OF, *_SERVICE_SUMS)


@query(with_(ENRICHED) + "SELECT act, count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr "
       "WHERE jour BETWEEN DATE '1998-01-01' AND DATE '1998-03-31' GROUP BY 1")
def services_period(spark: SparkSession, d: str) -> DataFrame:
    period = star.service_units(spark, d, ("1998-01-01", "1998-03-31"))
    return rollup.additive(period, ["act"], *_SERVICE_SUMS)


@query("SELECT o_orderstatus AS invoice_type, count(*) AS n_invoices FROM orders "
       f"WHERE CAST(o_orderdate AS DATE) = DATE '{AS_OF}' GROUP BY 1")
def invoices_today(spark: SparkSession, d: str) -> DataFrame:
    today = star.invoice_units(spark, d, (AS_OF, AS_OF)).where(S.today_only("jour", AS_OF))
    return rollup.additive(today, ["invoice_type"], {"n_invoices": "n_invoices"})


@query("SELECT CAST(o_orderdate AS DATE) AS jour, count(*) AS n_invoices FROM orders GROUP BY 1")
def invoices_by_day(spark: SparkSession, d: str) -> DataFrame:
    return rollup.additive(star.invoice_units(spark, d), ["jour"], {"n_invoices": "n_invoices"})


@query(with_(ENRICHED) + "SELECT count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed, "
       "CAST(sum(insurer_paid) AS DECIMAL(18,2)) AS insurer_paid, CAST(sum(patient_paid) AS DECIMAL(18,2)) AS patient_paid FROM enr")
def totals(spark: SparkSession, d: str) -> DataFrame:
    return rollup.grand_totals(star.service_units(spark, d), {"n_services": "n_services"}, {
        "billed": "billed", "insurer_paid": "insurer_paid", "patient_paid": "patient_paid"})


@query(with_(ENRICHED) + f"SELECT {half_up('100 * ' + cents('sum(insurer_paid)'), cents('sum(billed)'), 1)} AS coverage_pct FROM enr")
def coverage_rate(spark: SparkSession, d: str) -> DataFrame:
    return rollup.coverage_rate(star.service_units(spark, d), "insurer_paid", "billed", "coverage_pct")


@query(with_(ENRICHED) + f"SELECT {half_up(cents('sum(billed)'), '100 * count(*)', 2)} AS mean_amount FROM enr")
def mean_amount(spark: SparkSession, d: str) -> DataFrame:
    return star.service_units(spark, d).agg(S.ratio(F.sum("billed"), F.sum("n_services")).alias("mean_amount"))


@query(with_(ENRICHED) + "SELECT act, invoice_type, scheme, count(*) AS n_services, "
       "CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr GROUP BY ALL")
def breakdown_by_act_type_scheme(spark: SparkSession, d: str) -> DataFrame:
    return rollup.additive(star.service_units(spark, d), ["act", "invoice_type", "scheme"], *_SERVICE_SUMS)


def _breakdown(dim: str) -> None:
    sql = with_(ENRICHED) + (f"SELECT {dim}, count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed "
                             "FROM enr GROUP BY 1")

    @query(sql, name=f"breakdown_by_{dim}")
    def run(spark: SparkSession, d: str) -> DataFrame:
        return rollup.additive(star.service_units(spark, d), [dim], *_SERVICE_SUMS)


for _dim in ("act", "invoice_type", "scheme", "centre_type"):
    _breakdown(_dim)


@query("""SELECT p.p_type, count(*) AS n_services, CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS billed
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1""")
def breakdown_by_part_type(spark: SparkSession, d: str) -> DataFrame:
    """Lines shrink to one row per part before they meet the catalogue."""
    per_part = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("n_services"), S.sum_money(S.money("l_extendedprice")).alias("billed"))
    named = per_part.join(table(spark, d, "part").select("p_partkey", "p_type"), "p_partkey")
    return rollup.additive(named, ["p_type"], *_SERVICE_SUMS)


# -- prior-authorisation requests --------------------------------------------------------------


@query(with_(REQUESTS) + "SELECT " + half_up("100 * count(*) FILTER (WHERE status_code <> 'sans_reponse')", "count(*)", 1)
       + " AS response_rate FROM req")
def response_rate(spark: SparkSession, d: str) -> DataFrame:
    return rollup.response_rate(star.request_units(spark, d), "n_requests")


@query(with_(REQUESTS_DAY) + "SELECT " + half_up(
    cents("sum(mean_delay_hours * n_requests)"),
    "100 * sum(CASE WHEN mean_delay_hours IS NOT NULL THEN n_requests ELSE 0 END)", 2) + " AS mean_delay_hours FROM rday")
def weighted_delay(spark: SparkSession, d: str) -> DataFrame:
    return star.requests_day(spark, d).agg(S.weighted_mean("mean_delay_hours", "n_requests").alias("mean_delay_hours"))


@query(with_(REQUESTS_DAY) + f"""SELECT CAST(date_trunc('month', jour) AS DATE) AS month, status_code,
  CAST(sum(n_requests) AS BIGINT) AS n_requests, CAST(sum(engaged_amount) AS DECIMAL(18,2)) AS engaged_amount, """ + half_up(
    cents("sum(COALESCE(mean_delay_hours, 0) * n_requests)"),
    "100 * sum(CASE WHEN mean_delay_hours IS NOT NULL THEN n_requests ELSE 0 END)", 2)
    + f" AS mean_delay_hours FROM rday WHERE jour < date_trunc('month', DATE '{AS_OF}') GROUP BY ALL")
def ep_month_closed(spark: SparkSession, d: str) -> DataFrame:
    mean = S.weighted_mean("mean_delay_hours", "n_requests").alias("mean_delay_hours")
    return rollup.monthly_closed(star.requests_day(spark, d, (None, AS_OF)), AS_OF, {"n_requests": "n_requests"},
                                 {"engaged_amount": "engaged_amount"}, ["status_code"], [mean])


def _requests_by(dim: str) -> None:
    @query(with_(REQUESTS) + f"SELECT {dim}, count(*) AS n_requests, CAST(sum(amount) AS DECIMAL(18,2)) AS engaged_amount "
           "FROM req GROUP BY 1", name=f"requests_by_{dim}")
    def run(spark: SparkSession, d: str) -> DataFrame:
        return rollup.additive(star.request_units(spark, d), [dim], {"n_requests": "n_requests"},
                               {"engaged_amount": "engaged_amount"})


for _dim in ("status_code", "request_type"):
    _requests_by(_dim)


@query(with_(REQUESTS) + "SELECT jour, CAST(sum(CASE WHEN status_code IN ('A', 'N') THEN amount END) AS DECIMAL(18,2)) "
       "AS engaged_amount FROM req GROUP BY 1")
def engaged_on_granted(spark: SparkSession, d: str) -> DataFrame:
    """Engaged amount on granted requests per day; NULL on a day without any."""
    granted = S.sum_where("engaged_amount", S.member("status_code", ["A", "N"])).cast("decimal(18,2)")
    return star.request_units(spark, d).groupBy("jour").agg(granted.alias("engaged_amount"))


@query(with_(ANSWERS) + "SELECT o_orderkey AS request FROM orders WHERE NOT EXISTS "
       "(SELECT 1 FROM ans WHERE ans.request = o_orderkey)")
def unanswered_anti(spark: SparkSession, d: str) -> DataFrame:
    return enrich.unmatched(star.requests(spark, d).select("request"), star.answers(spark, d), "request")


@query(with_(ANSWERS) + """SELECT o.o_orderpriority AS request_type, COALESCE(a.status_code, 'sans_reponse') AS status_code,
  count(*) AS n_requests, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM lineitem l
    WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')) AS n_with_pathology
  FROM orders o LEFT JOIN ans a ON a.request = o.o_orderkey GROUP BY ALL""")
def answered_semi_count(spark: SparkSession, d: str) -> DataFrame:
    asked = star.requests(spark, d).join(star.answers(spark, d), "request", "left").select(
        F.col("request").alias("invoice"), "request_type", S.or_unknown("status_code", S.UNANSWERED).alias("status_code"))
    return enrich.count_with_match(asked, star.pathologies(spark, d), "invoice", ["request_type", "status_code"],
                                   "n_requests", "n_with_pathology")


@query(with_(DETAIL) + "SELECT status_code, CAST(sum(n_items) AS BIGINT) AS n_items, "
       "CAST(sum(n_pathologies) AS BIGINT) AS n_pathologies FROM det GROUP BY 1")
def status_zero_filled(spark: SparkSession, d: str) -> DataFrame:
    asked = star.requests(spark, d).join(star.answers(spark, d), "request", "left").select(
        F.col("request").alias("invoice"), S.or_unknown("status_code", S.UNANSWERED).alias("status_code"))
    def per_status(facts: DataFrame) -> DataFrame:
        per_invoice = daily.counts_by(facts, ["invoice"], "c")
        return asked.join(per_invoice, "invoice").groupBy("status_code").agg(F.sum("c").cast("bigint").alias("n"))
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("invoice"))
    return enrich.zero_filled(asked, {"n_items": per_status(items),
                                      "n_pathologies": per_status(star.pathologies(spark, d))}, "status_code")


# -- distinct counts and head-counts -----------------------------------------------------------


@query(with_(ENRICHED) + "SELECT CAST(date_trunc('month', jour) AS DATE) AS month, count(DISTINCT person) AS n_persons "
       "FROM enr GROUP BY 1")
def distinct_persons_by_month(spark: SparkSession, d: str) -> DataFrame:
    return rollup.distinct_over(star.enriched(spark, d), "person", "n_persons", [S.month_start("jour").alias("month")])


@query(with_(ENRICHED) + "SELECT CAST(date_trunc('month', jour) AS DATE) AS month, count(DISTINCT centre) AS n_centres "
       "FROM enr GROUP BY 1")
def distinct_centres_by_month(spark: SparkSession, d: str) -> DataFrame:
    return rollup.distinct_over(star.enriched(spark, d), "centre", "n_centres", [S.month_start("jour").alias("month")])


@query(with_(REQUESTS) + "SELECT count(DISTINCT agent_code) AS n_agents, count(*) AS n_requests FROM req "
       "WHERE agent_code IS NOT NULL")
def active_agents(spark: SparkSession, d: str) -> DataFrame:
    per_agent = rollup.additive(star.agent_day(spark, d), ["agent_code"], {"n": "n_requests"})
    return per_agent.agg(F.count("agent_code").alias("n_agents"), F.sum("n").cast("bigint").alias("n_requests"))


@query("""SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
  (SELECT count(*) FROM supplier) AS n_network, (SELECT count(*) FROM supplier WHERE s_acctbal > 0) AS n_in_credit FROM orders""")
def headcount_by_month(spark: SparkSession, d: str) -> DataFrame:
    months = star.invoices(spark, d).select(S.month_start("care_day").alias("month")).distinct()
    centres = table(spark, d, "supplier")
    out = rollup.headcount_by_period(centres, months, "n_network")
    return rollup.headcount_by_period(centres, out, "n_in_credit", F.col("s_acctbal") > 0)


# -- rankings ----------------------------------------------------------------------------------

_PERSON = ENRICHED + """, tot AS (SELECT person, count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed
  FROM enr GROUP BY 1)"""
_PERSON_CENTRE = ENRICHED + """, tot AS (SELECT centre, person, count(*) AS n_services,
  CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr GROUP BY ALL)"""


@query(with_(_PERSON) + "SELECT person, n_services, billed, CAST(rank() OVER (ORDER BY n_services DESC) AS INTEGER) AS rang "
       "FROM tot QUALIFY rang <= 10")
def top_persons(spark: SparkSession, d: str) -> DataFrame:
    totals_ = rollup.additive(star.service_units(spark, d), ["person"], *_SERVICE_SUMS)
    return ranking.top_n_with_ties(totals_, "n_services", 10)


@query(with_(_PERSON_CENTRE) + "SELECT centre, person, n_services, billed, "
       "CAST(rank() OVER (PARTITION BY centre ORDER BY n_services DESC) AS INTEGER) AS rang FROM tot QUALIFY rang <= 10")
def top_persons_by_centre(spark: SparkSession, d: str) -> DataFrame:
    totals_ = rollup.additive(star.service_units(spark, d), ["centre", "person"], *_SERVICE_SUMS)
    return ranking.top_n_with_ties(totals_, "n_services", 10, by=["centre"])


@query(with_(ENRICHED, """tot AS (SELECT person, count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed
  FROM enr WHERE jour BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY 1)""") +
       "SELECT person, n_services, billed, CAST(rank() OVER (ORDER BY n_services DESC) AS INTEGER) AS rang FROM tot QUALIFY rang <= 10")
def top_persons_period(spark: SparkSession, d: str) -> DataFrame:
    period = star.service_units(spark, d, ("1998-01-01", "1998-12-31"))
    return ranking.top_n_with_ties(rollup.additive(period, ["person"], *_SERVICE_SUMS), "n_services", 10)


@query("""SELECT l.l_partkey AS medicine, COALESCE(p.p_name, '(inconnu)') AS medicine_name, count(*) AS n_prescriptions
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2 HAVING count(*) >= 5
ORDER BY n_prescriptions DESC, medicine LIMIT 10""")
def top_parts_masked(spark: SparkSession, d: str) -> DataFrame:
    per_code = rollup.additive(star.medicine_units(spark, d), ["medicine"], {"n_prescriptions": "n_prescriptions"})
    best = ranking.top_n_strict(rollup.suppress_small_groups(per_code, "n_prescriptions"), "n_prescriptions", "medicine", 10)
    names = table(spark, d, "part").select(F.col("p_partkey").alias("medicine"), F.col("p_name").alias("medicine_name"))
    named = enrich.left_dimension(best, names, "medicine", {"medicine_name": S.UNKNOWN})
    return named.select("medicine", "medicine_name", "n_prescriptions").orderBy(F.desc("n_prescriptions"), "medicine")


@query("""SELECT s.s_nationkey AS nation, COALESCE(n.n_name, '(inconnue)') AS nation_name, count(*) AS n_services
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY 1, 2 HAVING count(*) >= 5 ORDER BY n_services DESC, nation LIMIT 10""")
def top_nations_masked(spark: SparkSession, d: str) -> DataFrame:
    per_centre = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("n_services"))
    located = per_centre.join(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
    per_nation = rollup.additive(located, [F.col("s_nationkey").alias("nation")], {"n_services": "n_services"})
    best = ranking.top_n_strict(rollup.suppress_small_groups(per_nation, "n_services"), "n_services", "nation", 10)
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("nation_name"))
    named = enrich.left_dimension(best, names, "nation", {"nation_name": S.UNKNOWN_FEMININE})
    return named.select("nation", "nation_name", "n_services").orderBy(F.desc("n_services"), "nation")


@query(with_(ENRICHED) + "SELECT centre, count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr "
       "GROUP BY 1 ORDER BY billed DESC, centre LIMIT 10")
def top_centres_by_amount(spark: SparkSession, d: str) -> DataFrame:
    per_centre = rollup.additive(star.service_units(spark, d), ["centre"], *_SERVICE_SUMS)
    return ranking.top_n_strict(per_centre, "billed", "centre", 10)


@query(with_(ENRICHED) + "SELECT practitioner, count(*) AS n_services, CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr "
       "GROUP BY 1 ORDER BY billed DESC, practitioner LIMIT 10")
def top_practitioners_by_amount(spark: SparkSession, d: str) -> DataFrame:
    per_one = rollup.additive(star.service_units(spark, d), ["practitioner"], *_SERVICE_SUMS)
    return ranking.top_n_strict(per_one, "billed", "practitioner", 10)


@query(with_(ENRICHED) + """SELECT e.centre, s.s_name AS centre_name, count(*) AS n_services,
  CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr e LEFT JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = e.centre
  GROUP BY ALL""")
def centre_totals_named(spark: SparkSession, d: str) -> DataFrame:
    per_centre = rollup.additive(star.service_units(spark, d), ["centre"], *_SERVICE_SUMS)
    names = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("centre"),
                                               F.col("s_name").alias("centre_name"))
    return per_centre.join(names, "centre", "left")


@query(with_(ENRICHED) + """SELECT e.practitioner, p.p_brand || ' ' || p.p_name AS full_name, count(*) AS n_services,
  CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr e LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = e.practitioner
  GROUP BY ALL""")
def practitioner_totals_named(spark: SparkSession, d: str) -> DataFrame:
    per_one = rollup.additive(star.service_units(spark, d), ["practitioner"], *_SERVICE_SUMS)
    names = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("practitioner"),
                                           S.full_name("p_brand", "p_name").alias("full_name"))
    return per_one.join(names, "practitioner", "left")


@query("SELECT s.s_suppkey AS centre, s.s_name AS centre_name, n.n_name AS locality, r.r_name AS region FROM supplier s "
       "LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey")
def centre_geo(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
            .join(table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey", "left")
            .join(table(spark, d, "region"), "r_regionkey", "left")
            .select(F.col("s_suppkey").alias("centre"), F.col("s_name").alias("centre_name"),
                    F.col("n_name").alias("locality"), F.col("r_name").alias("region")))


@query(with_(ENRICHED) + """SELECT e.centre, s.s_name AS centre_name, n.n_name AS locality, count(*) AS n_services,
  CAST(sum(billed) AS DECIMAL(18,2)) AS billed FROM enr e JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = e.centre
  JOIN nation n ON n.n_nationkey = s.s_nationkey WHERE n.n_regionkey IS NOT NULL AND s.s_acctbal > 0 GROUP BY ALL""")
def geo_totals(spark: SparkSession, d: str) -> DataFrame:
    """Centre totals, located centres only."""
    located = (table(spark, d, "supplier").where("s_acctbal > 0").withColumnRenamed("s_nationkey", "n_nationkey")
               .join(table(spark, d, "nation").where("n_regionkey is not null"), "n_nationkey")
               .select(F.col("s_suppkey").cast("string").alias("centre"), F.col("s_name").alias("centre_name"),
                       F.col("n_name").alias("locality")))
    per_centre = rollup.additive(star.service_units(spark, d), ["centre"], *_SERVICE_SUMS)
    return located.join(per_centre, "centre").select("centre", "centre_name", "locality", "n_services", "billed")


@query(with_(REQUESTS) + """SELECT jour, agent_code, s.s_name || ' ' || n.n_name AS full_name, status_code,
  count(*) AS n_requests FROM req JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = agent_code
  JOIN nation n ON n.n_nationkey = s.s_nationkey WHERE n.n_regionkey IN (0, 2) GROUP BY ALL""")
def agent_activity(spark: SparkSession, d: str) -> DataFrame:
    """Requests per adviser with the full name, restricted to one type of agent."""
    agents = (table(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
              .join(table(spark, d, "nation"), "n_nationkey").where(F.col("n_regionkey").isin(0, 2))
              .select(F.col("s_suppkey").cast("string").alias("agent_code"), S.full_name("s_name", "n_name").alias("full_name")))
    return star.agent_day(spark, d).join(agents, "agent_code").select(
        "jour", "agent_code", "full_name", "status_code", "n_requests")


# -- clinical views ----------------------------------------------------------------------------


@query("""SELECT CAST(l_shipdate AS DATE) AS jour, count(*) AS n_prescriptions, count(DISTINCT l_partkey) AS n_medicines
FROM lineitem GROUP BY 1 HAVING count(*) >= 5""")
def prescriptions_by_day_masked(spark: SparkSession, d: str) -> DataFrame:
    # One row per (day, medicine) already: distinct medicines of a day are its rows.
    per_day = star.medicine_day(spark, d).groupBy("jour").agg(
        F.sum("n_prescriptions").cast("bigint").alias("n_prescriptions"), F.count("medicine").alias("n_medicines"))
    return rollup.suppress_small_groups(per_day, "n_prescriptions")


@query(with_(DETAIL) + "SELECT * FROM det")
def ep_clinical_detail(spark: SparkSession, d: str) -> DataFrame:
    return star.clinical_detail(spark, d)


@query(with_(DETAIL) + "SELECT request_type, status_code, count(*) AS n_requests, count(*) FILTER (WHERE n_items > 2) AS n_with_items, "
       + half_up("100 * count(*) FILTER (WHERE n_items > 2)", "count(*)", 1)
       + " AS rate_with_items FROM det GROUP BY ALL HAVING count(*) >= 5")
def ep_with_items_masked(spark: SparkSession, d: str) -> DataFrame:
    out = rollup.group_rate(star.clinical_detail(spark, d), ["request_type", "status_code"], F.col("n_items") > 2,
                            "n_requests", "n_with_items", "rate_with_items")
    return rollup.suppress_small_groups(out, "n_requests")


@query(with_(DETAIL) + "SELECT request_type, status_code, count(*) AS n_requests, CAST(sum(n_items) AS BIGINT) AS n_items, "
       + half_up("sum(n_items)", "count(*)", 2) + " AS items_per_request FROM det GROUP BY ALL HAVING count(*) >= 5")
def ep_items_mean(spark: SparkSession, d: str) -> DataFrame:
    out = rollup.group_mean(star.clinical_detail(spark, d), ["request_type", "status_code"], "n_items",
                            "n_requests", "n_items", "items_per_request")
    return rollup.suppress_small_groups(out, "n_requests")


@query(with_(DETAIL) + "SELECT status_code, " + half_up("100 * count(*) FILTER (WHERE n_items > 2)", "count(*)", 1)
       + " AS rate_with_items, " + half_up("sum(n_items)", "count(*)", 2) + " AS items_per_request FROM det GROUP BY 1")
def ep_weighted_rate(spark: SparkSession, d: str) -> DataFrame:
    """Rates over groups of groups: sums first, one division at the end."""
    per_group = star.clinical_detail(spark, d).groupBy("request_type", "status_code").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_items") > 2).alias("hits"), F.sum("n_items").alias("items"))
    return per_group.groupBy("status_code").agg(
        S.percent(F.sum("hits"), F.sum("n")).alias("rate_with_items"),
        S.ratio(F.sum("items"), F.sum("n")).alias("items_per_request"))


_BY_PATHOLOGY = DETAIL + """, bp AS (SELECT det.status_code, l.l_suppkey AS pathology, COALESCE(s.s_name, '(inconnue)') AS pathology_name,
  count(*) AS n_pathologies FROM det JOIN lineitem l ON l.l_orderkey = det.request AND l.l_returnflag = 'R'
  LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey GROUP BY ALL HAVING count(*) >= 5)"""


@query(with_(_BY_PATHOLOGY) + "SELECT * FROM bp")
def ep_by_pathology_masked(spark: SparkSession, d: str) -> DataFrame:
    """Requests expanded by the pathologies of their invoice (many to many)."""
    status = star.requests(spark, d).join(star.answers(spark, d), "request", "left").select(
        F.col("request").alias("invoice"), S.or_unknown("status_code", S.UNANSWERED).alias("status_code"))
    counted = enrich.count_pairs(status, star.pathologies(spark, d), "invoice", "status_code", "pathology", "n_pathologies")
    counted = rollup.suppress_small_groups(counted, "n_pathologies")
    names = table(spark, d, "supplier").select(F.col("s_suppkey").alias("pathology"), F.col("s_name").alias("pathology_name"))
    return enrich.left_dimension(counted, names, "pathology", {"pathology_name": S.UNKNOWN_FEMININE}).select(
        "status_code", "pathology", "pathology_name", "n_pathologies")


_STATUSES = ["A", "N", "R", S.UNANSWERED]


@query(with_(_BY_PATHOLOGY) + "SELECT COALESCE(pathology_name, 'total') AS pathology_name, "
       + ", ".join(f"CAST(sum(CASE WHEN status_code = '{s}' THEN n_pathologies ELSE 0 END) AS BIGINT) AS \"{s}\"" for s in _STATUSES)
       + f", CAST(sum(CASE WHEN status_code NOT IN {tuple(_STATUSES)} THEN n_pathologies ELSE 0 END) AS BIGINT) AS autres"
       + ", CAST(sum(n_pathologies) AS BIGINT) AS total FROM bp GROUP BY ROLLUP(pathology_name)")
def cross_tab(spark: SparkSession, d: str) -> DataFrame:
    return reshape.cross_tab(ep_by_pathology_masked(spark, d), "pathology_name", "status_code", "n_pathologies", _STATUSES)


# -- report grid -------------------------------------------------------------------------------

_REPORT = ENRICHED + """, rep AS (
  SELECT jour, 'returned' AS indicateur, CAST(sum(CASE WHEN act = 'R' THEN 1 END) AS DECIMAL(28,2)) AS valeur FROM enr GROUP BY 1
  UNION ALL SELECT jour, 'type F', CAST(sum(CASE WHEN invoice_type = 'F' THEN 1 END) AS DECIMAL(28,2)) FROM enr GROUP BY 1
  UNION ALL SELECT jour, 'urgent', CAST(sum(CASE WHEN scheme = '1-URGENT' THEN 1 END) AS DECIMAL(28,2)) FROM enr GROUP BY 1
  UNION ALL SELECT jour, 'amount', CAST(sum(billed) AS DECIMAL(28,2)) FROM enr GROUP BY 1)"""


@query(with_(_REPORT) + "SELECT * FROM rep")
def report_long(spark: SparkSession, d: str) -> DataFrame:
    return reshape.long_form(star.service_units(spark, d), "jour", {
        "returned": S.sum_where("n_services", F.col("act") == "R"),
        "type F": S.sum_where("n_services", F.col("invoice_type") == "F"),
        "urgent": S.sum_where("n_services", F.col("scheme") == "1-URGENT"),
        "amount": F.sum("billed")})


_YEARS = [str(y) for y in range(1995, 2002)]


@query(with_(_REPORT) + "SELECT indicateur, "
       + ", ".join(f"CAST(sum(CASE WHEN year(jour) = {y} THEN valeur END) AS DECIMAL(38,2)) AS \"{y}\"" for y in _YEARS)
       + f", CAST(sum(CASE WHEN year(jour) NOT BETWEEN {_YEARS[0]} AND {_YEARS[-1]} THEN valeur END) AS DECIMAL(38,2)) AS autres"
       + " FROM rep GROUP BY 1")
def report_matrix(spark: SparkSession, d: str) -> DataFrame:
    return reshape.matrix(report_long(spark, d), "indicateur", F.year("jour").cast("string"), "valeur", _YEARS)


_GRANTED = "sum(CASE WHEN status_code IN ('A', 'N') THEN amount END)"


@query(with_(ENRICHED, REQUESTS) + f"""
SELECT (SELECT count(*) FROM enr) AS n_services, (SELECT count(*) FROM orders) AS n_invoices,
       (SELECT CAST(sum(billed) AS DECIMAL(18,2)) FROM enr) AS billed, (SELECT count(*) FROM req) AS n_requests,
       (SELECT {half_up("100 * count(*) FILTER (WHERE status_code <> 'sans_reponse')", "count(*)", 1)} FROM req) AS response_rate,
       (SELECT CAST({_GRANTED} AS DECIMAL(18,2)) FROM req) AS engaged_amount""")
def summary_board(spark: SparkSession, d: str) -> DataFrame:
    """Headline figures, one row: each part is one aggregated row, read as a scalar."""
    services = totals(spark, d)
    visits = rollup.grand_totals(star.invoice_units(spark, d), {"n": "n_invoices"}, {})
    asked = star.request_units(spark, d).agg(
        F.sum("n_requests").cast("bigint").alias("n"),
        S.percent(F.sum(F.when(F.col("status_code") != S.UNANSWERED, F.col("n_requests")).otherwise(0)),
                  F.sum("n_requests")).alias("rate"),
        S.sum_where("engaged_amount", S.member("status_code", ["A", "N"])).cast("decimal(18,2)").alias("engaged"))
    figures = asked.select(F.struct("n", "rate", "engaged")).scalar()
    return services.select(
        "n_services", visits.scalar().alias("n_invoices"), "billed", figures["n"].alias("n_requests"),
        figures["rate"].alias("response_rate"), figures["engaged"].alias("engaged_amount"))


@query(with_(ENRICHED, REQUESTS) + f"""
SELECT indicateur, categorie, CAST(valeur AS DECIMAL(18,2)) AS valeur FROM (
  SELECT 'services' AS indicateur, CAST(NULL AS VARCHAR) AS categorie, count(*) AS valeur FROM enr
  UNION ALL SELECT 'invoices', NULL, count(*) FROM orders
  UNION ALL SELECT 'billed', NULL, sum(billed) FROM enr
  UNION ALL SELECT 'requests', NULL, count(*) FROM req
  UNION ALL SELECT 'response rate', NULL, {half_up("100 * count(*) FILTER (WHERE status_code <> 'sans_reponse')", "count(*)", 1)} FROM req
  UNION ALL SELECT 'engaged amount', NULL, {_GRANTED} FROM req
  UNION ALL SELECT 'services by act', act, count(*) FROM enr GROUP BY act
  UNION ALL SELECT 'requests by status', status_code, count(*) FROM req GROUP BY status_code
  UNION ALL SELECT 'insurer paid by invoice type', invoice_type, sum(insurer_paid) FROM enr GROUP BY invoice_type
  UNION ALL SELECT 'requests by closed month', CAST(CAST(date_trunc('month', jour) AS DATE) AS VARCHAR), count(*) FROM req
    WHERE jour < date_trunc('month', DATE '{AS_OF}') GROUP BY 2)""")
def summary_ten(spark: SparkSession, d: str) -> DataFrame:
    """The ten headline indicators in one place."""
    services, asked = star.service_units(spark, d), star.request_units(spark, d)
    by_status = rollup.additive(asked, ["status_code"], {"n": "n_requests"})
    months = rollup.monthly_closed(asked, AS_OF, {"n": "n_requests"}, {})
    one = summary_board(spark, d)
    return reshape.board([
        ("services", one, None, "n_services"), ("invoices", one, None, "n_invoices"), ("billed", one, None, "billed"),
        ("requests", one, None, "n_requests"), ("response rate", one, None, "response_rate"), ("engaged amount", one, None, "engaged_amount"),
        ("services by act", rollup.additive(services, ["act"], {"n": "n_services"}), "act", "n"),
        ("requests by status", by_status, "status_code", "n"),
        ("insurer paid by invoice type", rollup.additive(services, ["invoice_type"], {}, {"paid": "insurer_paid"}), "invoice_type", "paid"),
        ("requests by closed month", months, "month", "n")])


# -- audience ----------------------------------------------------------------------------------


@query(with_(ENRICHED) + "SELECT centre, count(DISTINCT person) AS n_persons FROM enr GROUP BY 1 HAVING count(DISTINCT person) >= 5")
def public_view(spark: SparkSession, d: str) -> DataFrame:
    """Allowed columns only, at the displayed grain, small groups suppressed."""
    per_centre = rollup.distinct_over(star.enriched(spark, d), "person", "n_persons", ["centre"])
    return masking.audience_view(per_centre, ["centre", "n_persons"], "n_persons")


@query("SELECT sha256(CAST(c_custkey AS VARCHAR) || 'pepper') AS c_custkey, c_nationkey, c_mktsegment FROM customer")
def pseudonymous_view(spark: SparkSession, d: str) -> DataFrame:
    return masking.pseudonymous(table(spark, d, "customer"), "c_custkey", ["c_nationkey", "c_mktsegment"], "pepper")
