"""Registered queries: quarantine, recall, change capture, checks, delays, audit and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import scalars as S
from dayledger.operators import audit, evaluate, quality, ranking, reconcile, reshape, rollup
from dayledger.plans import claims, read_model, star
from dayledger.plans.registry import ANSWERS, ENRICHED, ORACLES, QUERIES, half_up, query, with_
from dayledger.sources import cdc, sinks
from dayledger.sources.specs import SPECS, SourceSpec
from dayledger.sources.tables import TABLES, table
from dayledger.streaming import health, window

# -- quarantine --------------------------------------------------------------------------------


def _service_rows(spark: SparkSession, d: str) -> DataFrame:
    """Lines and orders in the shape of the claims sources; the rules then run as they stand."""
    services = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("FACTURE_NUMERO"), F.col("l_returnflag").alias("PRESTATION_CODE"),
        F.col("l_partkey").cast("string").alias("PROFESSIONNEL_SANTE_CODE"),
        F.when(F.col("l_quantity") != 50, F.col("l_extendedprice")).alias("PRESTATION_MONTANT_DEPENSE"),
        (F.col("l_extendedprice").cast("decimal(18,2)") - F.col("l_tax").cast("decimal(4,2)") * 20).cast("double").alias("PRESTATION_MONTANT_RQ"),
        F.lit(None).cast("double").alias("PRESTATION_MONTANT_ASSURE"),
        (F.col("l_linenumber") * 8.0).alias("PRESTATION_QUANTITE_PRESCRITE"),
        (F.col("l_quantity") - 1).alias("PRESTATION_QUANTITE_SERVIE"),
        (F.col("l_discount").cast("decimal(4,2)") * 1050).cast("double").alias("PRESTATION_TAUX_REMBOURSEMENT"))
    invoices = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("FACTURE_NUMERO"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date")).alias("jour_soins"),
        F.col("o_orderstatus").alias("TYPE_FACTURE_CODE"), F.col("o_orderpriority").alias("REGIME_CODE"),
        F.lit(None).cast("string").alias("CENTRE_SANTE_CODE"), F.col("o_custkey").cast("string").alias("PERSONNE_UUID"))
    return claims.raw_services({"services": services, "invoices": invoices})


def _service_quarantine(spark: SparkSession, d: str, mode: str = "first", day: str | None = None) -> DataFrame:
    return claims.service_quarantine(_service_rows(spark, d), claims.service_rules(90_000, ["A", "N"]), mode, day)


_SERVICE_ROWS = """src AS (
  SELECT CASE WHEN o.o_orderpriority <> '5-LOW' THEN CAST(o.o_orderdate AS DATE) END AS jour,
         CAST(l.l_orderkey AS VARCHAR) AS facture_numero, l.l_returnflag AS prestation_code,
         CAST(l.l_partkey AS VARCHAR) AS professionnel_sante_code,
         CASE WHEN l.l_quantity <> 50 THEN l.l_extendedprice END AS montant_depense,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) - CAST(l.l_tax AS DECIMAL(4,2)) * 20 AS DOUBLE) AS montant_rq, CAST(NULL AS DOUBLE) AS montant_assure,
         l.l_linenumber * CAST(8 AS DOUBLE) AS quantite_prescrite, l.l_quantity - 1 AS quantite_servie,
         CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 1050 AS DOUBLE) AS taux_remboursement, o.o_orderstatus AS type_facture_code,
         o.o_orderpriority AS regime_code, CAST(NULL AS VARCHAR) AS centre_sante_code, CAST(o.o_custkey AS VARCHAR) AS personne_uuid
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""
_SERVICE_RULES = (
    ("date_soins_manquante", "DATES", "jour IS NULL"),
    ("montant_depense_manquant", "MONTANTS", "montant_depense IS NULL"),
    ("MONTANT_ABERRANT", "MONTANTS", "montant_depense < 0 OR montant_depense > 90000"),
    ("QUANTITE_NULLE", "QUANTITES", "quantite_servie = 0 AND quantite_prescrite > 0"),
    ("QUANTITE_EXCESSIVE", "QUANTITES", "quantite_servie > quantite_prescrite"),
    ("MONTANT_HORS_BAREME", "MONTANTS", "taux_remboursement < 0 OR taux_remboursement > 100"),
    ("REPARTITION_FAUSSEE", "MONTANTS", "abs(COALESCE(montant_rq, 0) + COALESCE(montant_assure, 0) - montant_depense) > 1"),
    ("PRESTATION_ORPHELINE", "REFERENTIEL", "prestation_code NOT IN ('A', 'N')"),
)


def _case(rules: tuple[tuple[str, str, str], ...], which: int) -> str:
    return "CASE " + " ".join(f"WHEN {r[2]} THEN '{r[which]}'" for r in rules) + " END"


_SERVICE_Q = _SERVICE_ROWS + f""", q AS (SELECT *, {_case(_SERVICE_RULES, 0)} AS motif_anomalie,
  {_case(_SERVICE_RULES, 1)} AS famille, facture_numero || '/' || prestation_code AS cle_metier FROM src)"""

_LINE_COLUMNS = ["famille", "motif_anomalie", "cle_metier"]
_MONEY = ("montant_depense", "montant_rq", "quantite_servie", "taux_remboursement")


@query(with_(_SERVICE_Q) + "SELECT 'prestation' AS domaine, motif_anomalie, famille, cle_metier FROM q "
       "WHERE motif_anomalie IS NOT NULL")
def quarantine_services(spark: SparkSession, d: str) -> DataFrame:
    return quality.without_raw_row(_service_quarantine(spark, d))


@query(with_(_SERVICE_Q) + "SELECT famille, motif_anomalie, cle_metier, facture_numero, prestation_code, "
       "professionnel_sante_code, centre_sante_code, jour AS jour_soins, "
       + ", ".join(f"CAST({c} AS DECIMAL(18,2)) AS {c}" for c in ("montant_depense", "montant_rq", "montant_assure", "quantite_prescrite", "quantite_servie", "taux_remboursement"))
       + ", type_facture_code, regime_code, personne_uuid FROM q WHERE motif_anomalie IS NOT NULL")
def quarantine_detail(spark: SparkSession, d: str) -> DataFrame:
    """Raw JSON rows back to typed columns."""
    return read_model.anomaly_detail({"qualite_anomalies": _service_quarantine(spark, d)}, "prestation")


@query(with_(_SERVICE_ROWS) + " UNION ALL ".join(
    f"SELECT 'prestation' AS domaine, '{r}' AS motif_anomalie, '{f}' AS famille, facture_numero || '/' || prestation_code "
    f"AS cle_metier FROM src WHERE {c}" for r, f, c in _SERVICE_RULES))
def quarantine_all_reasons(spark: SparkSession, d: str) -> DataFrame:
    return quality.without_raw_row(_service_quarantine(spark, d, "all"))


_INVOICE_ROWS = """inv AS (
  SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS jour_soins, l.made, o.o_orderpriority AS kind
  FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS made FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey)"""
_INVOICE_RULES = (
    ("DATE_ANTIDATEE", "DATES", "jour_soins < CAST(made AS DATE) - INTERVAL 60 DAY"),
    ("DATE_SOINS_FUTURE", "DATES", "jour_soins > CAST(made AS DATE)"),
    ("TYPE_CENTRE_INCONNU", "REFERENTIEL", "kind NOT IN ('1-URGENT', '2-HIGH')"),
)


def _invoice_quarantine(spark: SparkSession, d: str, day: str | None = None) -> DataFrame:
    """Creation date = first shipment of the order, taken before the join."""
    made = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("date_creation_facture"))
    rows = table(spark, d, "orders").join(made, "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("FACTURE_NUMERO"), F.col("o_orderdate").cast("date").alias("jour_soins"),
        "date_creation_facture", F.col("o_orderpriority").alias("CENTRE_SANTE_TYPE_CODE"),
        F.lit(None).cast("string").alias("CENTRE_SANTE_CODE"))
    return claims.invoice_quarantine(rows, claims.invoice_rules(["1-URGENT", "2-HIGH"]), day=day)


@query(with_(_INVOICE_ROWS) + f"""SELECT 'facture' AS domaine, {_case(_INVOICE_RULES, 0)} AS motif_anomalie,
  {_case(_INVOICE_RULES, 1)} AS famille, CAST(o_orderkey AS VARCHAR) AS cle_metier,
  '{{"facture_numero":"' || o_orderkey || '","centre_sante_code":null,"centre_sante_type_code":"' || kind || '","jour_soins":"'
  || jour_soins || '","date_creation_facture":"' || strftime(made, '%Y-%m-%d %H:%M:%S.%g') || '"}}' AS donnee_brute
  FROM inv WHERE jour_soins IS NOT NULL AND made IS NOT NULL AND {_case(_INVOICE_RULES, 0)} IS NOT NULL""")
def quarantine_invoices(spark: SparkSession, d: str) -> DataFrame:
    return _invoice_quarantine(spark, d)


_PERSON_ROWS = """per AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 40 = 0 THEN '' WHEN c_custkey % 41 = 0 THEN c_name || '?'
           WHEN c_custkey % 43 = 0 THEN '{{7*7}}' WHEN c_custkey % 47 = 0 THEN 'Ã' || c_name ELSE c_name END AS nom,
         CASE WHEN c_acctbal < 0 THEN '384' ELSE '394' END || substring(c_name, 10, CASE WHEN c_nationkey = 3 THEN 8 ELSE 9 END) || '1' AS secu,
         DATE '1895-01-01' + CAST(c_custkey % 43000 AS INTEGER) * 30 AS birth FROM customer)"""


@query(with_(_PERSON_ROWS) + """SELECT 'assure' AS domaine, cle_metier, m[1] AS motif_anomalie, m[2] AS famille FROM (
  SELECT id AS cle_metier, CASE WHEN nom = '' THEN ['CHAMP_OBLIGATOIRE_VIDE', 'IDENTITE']
    WHEN nom LIKE '%?%' OR nom LIKE '%Ã%' OR nom LIKE '%Â%' THEN ['ENCODAGE_CASSE', 'FORMAT']
    WHEN nom IN ('{{7*7}}') THEN ['TENTATIVE_INJECTION', 'FORMAT']
    WHEN length(secu) <> 13 OR secu NOT LIKE '394%' THEN ['NUMERO_SECU_INVALIDE', 'IDENTITE']
    WHEN birth > DATE '2001-07-15' OR birth < DATE '2001-07-15' - INTERVAL 100 YEAR THEN ['DATE_NAISSANCE_ABERRANTE', 'IDENTITE']
  END AS m FROM per) WHERE m IS NOT NULL""")
def quarantine_persons(spark: SparkSession, d: str) -> DataFrame:
    return quality.without_raw_row(_person_quarantine(spark, d))


def _person_quarantine(spark: SparkSession, d: str, day: str | None = None) -> DataFrame:
    key = F.col("c_custkey")
    name = (F.when(key % 40 == 0, "").when(key % 41 == 0, F.concat("c_name", F.lit("?"))).when(key % 43 == 0, "{{7*7}}")
            .when(key % 47 == 0, F.concat(F.lit("Ã"), "c_name")).otherwise(F.col("c_name")))
    digits = F.substring("c_name", F.lit(10), F.when(F.col("c_nationkey") == 3, 8).otherwise(9))
    rows = table(spark, d, "customer").select(
        key.cast("string").alias("PERSONNE_UUID"), F.lit(None).cast("string").alias("ASSURE_NUMERO_IDENTIFIANT"),
        F.concat(F.when(F.col("c_acctbal") < 0, "384").otherwise("394"), digits, F.lit("1")).alias("NUMERO_SECU"),
        name.alias("ASSURE_NOM"), F.lit(None).cast("string").alias("ASSURE_PRENOMS"),
        F.date_add(F.lit("1895-01-01").cast("date"), (key % 43000).cast("int") * 30).alias("date_naissance"))
    return claims.person_quarantine(rows, star.AS_OF, day=day)


@query("""SELECT 'agent' AS domaine, 'EMAIL_INVALIDE' AS motif_anomalie, 'FORMAT' AS famille,
  CAST(s_suppkey AS VARCHAR) AS cle_metier, '{"agent_code":"' || s_suppkey || '","agent_nom":"' || s_name ||
  '","agent_prenoms":null,"agent_email":"' || m || '","agent_type_code":"accueil"}' AS donnee_brute
  FROM (SELECT *, s_name || CASE WHEN s_acctbal < 3000 THEN '.ci' ELSE '@x.ci' END AS m FROM supplier) WHERE m NOT LIKE '%@%.%'""")
def quarantine_agents(spark: SparkSession, d: str) -> DataFrame:
    return _agent_quarantine(spark, d)


def _agent_quarantine(spark: SparkSession, d: str, day: str | None = None) -> DataFrame:
    rows = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("AGENT_CODE"), F.col("s_name").alias("AGENT_NOM"),
        F.lit(None).cast("string").alias("AGENT_PRENOMS"), F.lit("accueil").alias("AGENT_TYPE_CODE"),
        F.concat("s_name", F.when(F.col("s_acctbal") < 3000, ".ci").otherwise("@x.ci")).alias("AGENT_EMAIL"))
    return claims.agent_quarantine(rows, day)


@query("""SELECT 'entente_prealable' AS domaine, CASE WHEN o_orderstatus = 'P' THEN 'type_demande_manquant' ELSE 'montant_engage_negatif' END AS motif_anomalie,
  CASE WHEN o_orderstatus = 'P' THEN 'FORMAT' ELSE 'MONTANTS' END AS famille, CAST(o_orderkey AS VARCHAR) AS cle_metier
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)) - 50000) AS amount FROM lineitem GROUP BY 1) m
    ON m.l_orderkey = o_orderkey WHERE o_orderstatus = 'P' OR m.amount < 0""")
def quarantine_requests(spark: SparkSession, d: str) -> DataFrame:
    return quality.without_raw_row(_request_quarantine(spark, d))


def _request_quarantine(spark: SparkSession, d: str, day: str | None = None) -> DataFrame:
    key = "ENTENTE_PREALABLE_ID"
    asked = table(spark, d, "orders").select(
        F.col("o_orderkey").alias(key), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("TYPE_DEMANDE_CODE"),
        F.col("o_orderdate").cast("string").alias("ENTENTE_PREALABLE_DATE_DEBUT"))
    answered = star.answers(spark, d).select(F.col("request").alias(key), F.col("status_code").alias("STATUT_CODE"),
                                             F.col("agent_code").alias("AGENT_CODE"))
    acts = table(spark, d, "lineitem").select(F.col("l_orderkey").alias(key),
                                              (S.money("l_extendedprice") - 50000).alias("ACTE_MEDICAL_MONTANT_CMU"))
    return claims.request_quarantine(asked, answered, claims.request_amounts({"acts": acts}), day=day)


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS facture_numero, l_returnflag AS prestation_code,
  CASE WHEN l_tax > 0 THEN l_extendedprice - 20000 END AS montant_depense,
  CASE WHEN l_linenumber = 7 THEN 'date_creation_manquante' WHEN NOT (l_tax > 0) THEN 'montant_manquant' ELSE 'montant_negatif' END AS motif_rejet_qualite,
  CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date_creation_brute
  FROM lineitem WHERE l_linenumber = 7 OR NOT (l_tax > 0) OR l_extendedprice - 20000 < 0""")
def rejected_services(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("FACTURE_NUMERO"), F.col("l_returnflag").alias("PRESTATION_CODE"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice") - 20000).alias("PRESTATION_MONTANT_DEPENSE"),
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate").cast("date").cast("string")).alias("DATE_CREATION"))
    return window.rejected_services(rows)


_DOMAIN_QUERIES = ("quarantine_services", "quarantine_invoices", "quarantine_persons", "quarantine_agents", "quarantine_requests")
_ALL_DOMAINS = "allq AS (" + " UNION ALL ".join(
    f"SELECT domaine, motif_anomalie, famille, cle_metier FROM ({ORACLES[q]}) {q}" for q in _DOMAIN_QUERIES) + ")"


def _all_domains(spark: SparkSession, d: str) -> DataFrame:
    """Quarantine rows of all five domains, without the raw row."""
    return reshape.stack([QUERIES[q](spark, d).select("domaine", "motif_anomalie", "famille", "cle_metier") for q in _DOMAIN_QUERIES])


@query(with_(_ALL_DOMAINS) + "SELECT domaine, famille, motif_anomalie, count(*) AS nombre_lignes FROM allq GROUP BY ALL")
def quarantine_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.anomaly_counts(_all_domains(spark, d), ["domaine", "famille", "motif_anomalie"])


@query(with_(_SERVICE_Q) + "SELECT jour, famille, motif_anomalie, count(*) AS nombre_lignes FROM q WHERE motif_anomalie IS NOT NULL GROUP BY ALL")
def quarantine_counts_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Counts per day of care, read back from the raw row."""
    rows = _service_quarantine(spark, d).withColumn("jour", S.json_text("donnee_brute", "jour_soins").cast("date"))
    return quality.anomaly_counts(rows, ["jour", "famille", "motif_anomalie"])


def _declared_invoices(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the declared invoice source brings them: a day number, an ISO time, and what the
    declaration derives from both."""
    return SPECS["invoices"].with_derived(table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("FACTURE_NUMERO"), F.col("o_orderstatus").alias("TYPE_FACTURE_CODE"),
        F.col("o_orderpriority").alias("REGIME_CODE"), F.lit(None).cast("string").alias("CENTRE_SANTE_CODE"),
        F.lit(None).cast("string").alias("CENTRE_SANTE_TYPE_CODE"), F.lit(None).cast("string").alias("CENTRE_SANTE_TYPE_LIBELLE"),
        F.col("o_custkey").cast("string").alias("PERSONNE_UUID"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.datediff("o_orderdate", F.lit("1970-01-01").cast("date"))).alias("FACTURE_DATE_SOINS"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("DATE_CREATION")))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS facture_numero, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS jour_soins, "
       "o_orderdate AS date_creation_facture FROM orders")
def declared_invoices(spark: SparkSession, d: str) -> DataFrame:
    """Day numbers and ISO times to dates and timestamps, by declaration."""
    return _declared_invoices(spark, d).select(F.col("FACTURE_NUMERO").alias("facture_numero"), "jour_soins", "date_creation_facture")


@query("""SELECT 'facture' AS domaine, 'date_soins_manquante' AS motif_anomalie, 'DATES' AS famille, CAST(o_orderkey AS VARCHAR) AS cle_metier,
  '{"facture_numero":"' || o_orderkey || '","type_facture_code":"' || o_orderstatus || '","regime_code":"' || o_orderpriority ||
  '","centre_sante_code":null,"centre_sante_type_libelle":null,"personne_uuid":"' || o_custkey || '","facture_date_soins_brute":null}' AS donnee_brute
  FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderdate IS NULL""")
def quarantine_undated_invoices(spark: SparkSession, d: str) -> DataFrame:
    """Invoices without a day of care, raw row included."""
    return claims.undated_invoices(_declared_invoices(spark, d))

# -- all five domains with their raw rows ----------------------------------------------------------

# Every flagged row with the columns of its raw row, one relation per domain.
_FLAGGED_INVOICES = f"""inv_q AS (
  SELECT {_case(_INVOICE_RULES, 1)} AS famille, {_case(_INVOICE_RULES, 0)} AS motif_anomalie, CAST(o_orderkey AS VARCHAR) AS cle_metier,
    NULL::VARCHAR AS type_facture_code, NULL::VARCHAR AS regime_code, kind AS centre_sante_type_code, jour_soins,
    CAST(strftime(made, '%Y-%m-%d %H:%M:%S.%g') AS TIMESTAMP) AS date_creation_facture, NULL::VARCHAR AS personne_uuid
  FROM inv WHERE jour_soins IS NOT NULL AND made IS NOT NULL AND {_case(_INVOICE_RULES, 0)} IS NOT NULL
  UNION ALL SELECT 'DATES', 'date_soins_manquante', CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority, NULL, NULL, NULL, CAST(o_custkey AS VARCHAR)
  FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderdate IS NULL)"""
_FLAGGED_PERSONS = """per_q AS (
  SELECT m[2] AS famille, m[1] AS motif_anomalie, id AS cle_metier, nom, secu, birth FROM (
    SELECT *, CASE WHEN nom = '' THEN ['CHAMP_OBLIGATOIRE_VIDE', 'IDENTITE']
      WHEN nom LIKE '%?%' OR nom LIKE '%Ã%' OR nom LIKE '%Â%' THEN ['ENCODAGE_CASSE', 'FORMAT']
      WHEN nom IN ('{{7*7}}') THEN ['TENTATIVE_INJECTION', 'FORMAT']
      WHEN length(secu) <> 13 OR secu NOT LIKE '394%' THEN ['NUMERO_SECU_INVALIDE', 'IDENTITE']
      WHEN birth > DATE '2001-07-15' OR birth < DATE '2001-07-15' - INTERVAL 100 YEAR THEN ['DATE_NAISSANCE_ABERRANTE', 'IDENTITE']
    END AS m FROM per) WHERE m IS NOT NULL)"""
_FLAGGED_AGENTS = """age_q AS (
  SELECT 'FORMAT' AS famille, 'EMAIL_INVALIDE' AS motif_anomalie, CAST(s_suppkey AS VARCHAR) AS cle_metier, s_name, m
  FROM (SELECT *, s_name || CASE WHEN s_acctbal < 3000 THEN '.ci' ELSE '@x.ci' END AS m FROM supplier) WHERE m NOT LIKE '%@%.%')"""
_FLAGGED_REQUESTS = ANSWERS + """, req_q AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'FORMAT' ELSE 'MONTANTS' END AS famille,
    CASE WHEN o_orderstatus = 'P' THEN 'type_demande_manquant' ELSE 'montant_engage_negatif' END AS motif_anomalie,
    CAST(o_orderkey AS VARCHAR) AS cle_metier, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS kind, o_orderdate AS asked,
    a.status_code, a.agent_code, CAST(m.amount AS DECIMAL(18,2)) AS amount
  FROM orders LEFT JOIN ans a ON a.request = o_orderkey
  LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)) - 50000) AS amount FROM lineitem GROUP BY 1) m ON m.l_orderkey = o_orderkey
  WHERE o_orderstatus = 'P' OR m.amount < 0)"""


def _all_raw(spark: SparkSession, d: str, day: str | None = None) -> DataFrame:
    """The quarantine table: flagged rows of all domains, raw rows included."""
    return reshape.stack([_service_quarantine(spark, d, day=day), _invoice_quarantine(spark, d, day), claims.undated_invoices(_declared_invoices(spark, d), day),
                          _person_quarantine(spark, d, day), _agent_quarantine(spark, d, day), _request_quarantine(spark, d, day)])


@query(with_(_PERSON_ROWS, _FLAGGED_PERSONS) + """SELECT 'assure' AS domaine, motif_anomalie, famille, cle_metier,
  '{"personne_uuid":"' || cle_metier || '","assure_numero_identifiant":null,"numero_secu":"' || secu || '","assure_nom":"' || nom ||
  '","assure_prenoms":null,"assure_date_naissance":"' || birth || '"}' AS donnee_brute FROM per_q""")
def quarantine_persons_raw(spark: SparkSession, d: str) -> DataFrame:
    """Flagged persons as they came."""
    return _person_quarantine(spark, d)


@query(with_(_FLAGGED_REQUESTS) + """SELECT 'entente_prealable' AS domaine, motif_anomalie, famille, cle_metier,
  '{"entente_prealable_id":"' || cle_metier || '","type_demande_code":' || COALESCE('"' || kind || '"', 'null') || ',"date_debut":"' || asked ||
  '","statut_code":' || COALESCE('"' || status_code || '"', 'null') || ',"agent_code":' || COALESCE('"' || agent_code || '"', 'null') ||
  ',"montant_engage_cmu":' || COALESCE(CAST(amount AS VARCHAR), 'null') || '}' AS donnee_brute FROM req_q""")
def quarantine_requests_raw(spark: SparkSession, d: str) -> DataFrame:
    """Flagged requests as they came, with their answer and amount."""
    return _request_quarantine(spark, d)


@query(with_(_INVOICE_ROWS, _FLAGGED_INVOICES) + """SELECT famille, motif_anomalie, cle_metier, cle_metier AS facture_numero, type_facture_code, regime_code,
  NULL::VARCHAR AS centre_sante_code, centre_sante_type_code, NULL::VARCHAR AS centre_sante_type_libelle, jour_soins, date_creation_facture,
  NULL::VARCHAR AS facture_date_soins_brute, personne_uuid FROM inv_q""")
def quarantine_detail_invoices(spark: SparkSession, d: str) -> DataFrame:
    return read_model.anomaly_detail({"qualite_anomalies": _all_raw(spark, d)}, "facture")


@query(with_(_PERSON_ROWS, _FLAGGED_PERSONS) + """SELECT famille, motif_anomalie, cle_metier, cle_metier AS personne_uuid,
  NULL::VARCHAR AS assure_numero_identifiant, secu AS numero_secu, nom AS assure_nom, NULL::VARCHAR AS assure_prenoms, birth AS assure_date_naissance FROM per_q""")
def quarantine_detail_persons(spark: SparkSession, d: str) -> DataFrame:
    return read_model.anomaly_detail({"qualite_anomalies": _all_raw(spark, d)}, "assure")


@query(with_(_FLAGGED_AGENTS) + """SELECT famille, motif_anomalie, cle_metier, cle_metier AS agent_code, s_name AS agent_nom, NULL::VARCHAR AS agent_prenoms,
  m AS agent_email, 'accueil' AS agent_type_code FROM age_q""")
def quarantine_detail_agents(spark: SparkSession, d: str) -> DataFrame:
    return read_model.anomaly_detail({"qualite_anomalies": _all_raw(spark, d)}, "agent")


@query(with_(_FLAGGED_REQUESTS) + """SELECT famille, motif_anomalie, cle_metier, cle_metier AS entente_prealable_id, kind AS type_demande_code,
  asked AS date_debut, status_code AS statut_code, agent_code, amount AS montant_engage_cmu FROM req_q""")
def quarantine_detail_requests(spark: SparkSession, d: str) -> DataFrame:
    return read_model.anomaly_detail({"qualite_anomalies": _all_raw(spark, d)}, "entente_prealable")


_DATED_DOMAINS = with_(_SERVICE_Q, _INVOICE_ROWS, _FLAGGED_INVOICES, _PERSON_ROWS, _FLAGGED_PERSONS, _FLAGGED_AGENTS, _FLAGGED_REQUESTS, """dated AS (
  SELECT 'prestation' AS domaine, famille, motif_anomalie, cle_metier, jour FROM q WHERE motif_anomalie IS NOT NULL
  UNION ALL SELECT 'facture', famille, motif_anomalie, cle_metier, jour_soins FROM inv_q
  UNION ALL SELECT 'assure', famille, motif_anomalie, cle_metier, NULL FROM per_q
  UNION ALL SELECT 'agent', famille, motif_anomalie, cle_metier, NULL FROM age_q
  UNION ALL SELECT 'entente_prealable', famille, motif_anomalie, cle_metier, CAST(asked AS DATE) FROM req_q)""")


def _dated_domains(spark: SparkSession, d: str) -> DataFrame:
    """The quarantine with the day of each row, as its raw row has it: care, else request; none for persons and agents.
    The day is kept beside the raw row, as taking it out of the JSON has every line written and parsed twice."""
    return _all_raw(spark, d, "jour")


@query(_DATED_DOMAINS + "SELECT domaine, jour, famille, motif_anomalie, count(*) AS nombre_lignes FROM dated GROUP BY ALL")
def quarantine_board_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the quality board per domain, day, family and reason."""
    return quality.anomaly_counts(_dated_domains(spark, d), ["domaine", "jour", "famille", "motif_anomalie"])


@query(_DATED_DOMAINS + "SELECT jour, domaine, famille, motif_anomalie, cle_metier FROM dated WHERE jour IS NOT NULL "
       "ORDER BY jour DESC, domaine, cle_metier, motif_anomalie LIMIT 200")
def quarantine_board_newest(spark: SparkSession, d: str) -> DataFrame:
    """The board's 200 newest rows of all domains."""
    rows = _dated_domains(spark, d).where(F.col("jour").isNotNull()).select("jour", "domaine", "famille", "motif_anomalie", "cle_metier")
    return ranking.newest(rows, "jour", ["domaine", "cle_metier", "motif_anomalie"], 200)


@query(with_(_SERVICE_Q) + "SELECT motif_anomalie, cle_metier FROM q WHERE famille IN ('QUANTITES', 'REFERENTIEL')")
def quarantine_filtered(spark: SparkSession, d: str) -> DataFrame:
    rows = _service_quarantine(spark, d)
    return rows.where(S.member("famille", ["QUANTITES", "REFERENTIEL"])).select("motif_anomalie", "cle_metier")


@query(with_(_INVOICE_ROWS) + f"""SELECT DISTINCT made AS detecte_le, motif_anomalie, cle_metier FROM (
  SELECT made, {_case(_INVOICE_RULES, 0)} AS motif_anomalie, CAST(o_orderkey AS VARCHAR) AS cle_metier FROM inv WHERE made IS NOT NULL)
  WHERE motif_anomalie IS NOT NULL ORDER BY detecte_le DESC, cle_metier LIMIT 200""")
def quarantine_newest(spark: SparkSession, d: str) -> DataFrame:
    """The 200 newest rows; the creation date stands for the detection stamp."""
    rows = _invoice_quarantine(spark, d)
    stamp = S.json_text("donnee_brute", "date_creation_facture").cast("timestamp_ntz").alias("detecte_le")
    return ranking.newest(rows.select(stamp, "motif_anomalie", "cle_metier"), "detecte_le", ["cle_metier"], 200)


_DOMAIN_ROWS = {"prestation": "lineitem", "facture": "orders", "assure": "customer", "agent": "supplier", "entente_prealable": "orders"}


@query(with_(_ALL_DOMAINS) + "SELECT domaine, motif_anomalie, n AS nombre_lignes, r AS source_rows, n / CAST(r AS DOUBLE) AS share, n / CAST(r AS DOUBLE) > 0.15 AS suspect "
       "FROM (SELECT domaine, motif_anomalie, count(*) AS n FROM allq GROUP BY ALL) JOIN ("
       + " UNION ALL ".join(f"SELECT '{k}' AS domaine, count(*) AS r FROM {t}" for k, t in _DOMAIN_ROWS.items()) + ") USING (domaine)")
def quarantine_volume(spark: SparkSession, d: str) -> DataFrame:
    counts = quality.anomaly_counts(_all_domains(spark, d), ["domaine", "motif_anomalie"])
    source = reconcile.row_counts({k: table(spark, d, t) for k, t in _DOMAIN_ROWS.items()}).select(
        F.col("table_name").alias("domaine"), F.col("rows").alias("source_rows"))
    return quality.volume_check(counts, source, 0.15)


@query(with_(_ALL_DOMAINS) + "SELECT DISTINCT motif_anomalie, famille FROM allq")
def quarantine_family_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Family looked up from the reason alone, for the reasons of all domains."""
    reasons = reshape.distinct_values(_all_domains(spark, d), "motif_anomalie")
    return reasons.withColumn("famille", quality.family_of("motif_anomalie", claims.FAMILIES, F.lit("INDETERMINEE")))


# -- recall: journal = labels, detections = rules on documents ---------------------------------------


def _injected(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select(
        F.when(F.col("toxic") == 1, "TOXIC").when(F.col("quality") == 0, "LOW").otherwise("FINE").alias("code"),
        F.when(F.col("doc_id") % 9 != 0, F.col("doc_id").cast("string")).alias("key"))


def _detected(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.when(F.col("n_chars") < 400, "LOW").when(F.col("source") == "web", "FINE").otherwise("OTHER").alias("code"),
        S.key_head(F.concat(F.col("doc_id").cast("string"), F.lit("/"), "lang")).alias("key"))


_RECALL = """inj AS (SELECT CASE WHEN toxic = 1 THEN 'TOXIC' WHEN quality = 0 THEN 'LOW' ELSE 'FINE' END AS code,
    CASE WHEN doc_id % 9 <> 0 THEN CAST(doc_id AS VARCHAR) END AS key FROM labels),
  det AS (SELECT CASE WHEN n_chars < 400 THEN 'LOW' WHEN source = 'web' THEN 'FINE' ELSE 'OTHER' END AS code, CAST(doc_id AS VARCHAR) AS key FROM documents)"""


@query(with_(_RECALL, """i AS (SELECT DISTINCT code, key FROM inj), f AS (
  SELECT i.code, count(*) AS injected, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM det WHERE det.code = i.code AND det.key = i.key)) AS found,
    (SELECT count(*) FROM (SELECT DISTINCT code, key FROM det) x WHERE x.code = i.code
       AND NOT EXISTS (SELECT 1 FROM i j WHERE j.code = x.code AND j.key = x.key)) AS surplus FROM i GROUP BY i.code)""")
       + "SELECT COALESCE(code, 'TOTAL') AS code, CAST(sum(injected) AS BIGINT) AS injected, CAST(sum(found) AS BIGINT) AS found, "
       "CAST(sum(surplus) AS BIGINT) AS surplus, " + half_up("100 * sum(found)", "sum(injected)", 1) + " AS recall_pct FROM f GROUP BY ROLLUP(code)")
def recall_by_code(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.recall_by_code(_injected(spark, d), _detected(spark, d))


@query(with_(_RECALL) + "SELECT code, count(DISTINCT key) AS detected FROM det WHERE code NOT IN (SELECT code FROM inj) GROUP BY 1")
def recall_never_injected(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.codes_never_injected(_injected(spark, d), _detected(spark, d))


_CAUSE = _RECALL + """, c AS (SELECT code, count(*) AS injected,
  count(*) FILTER (WHERE key IS NOT NULL AND EXISTS (SELECT 1 FROM det WHERE det.code = inj.code AND det.key = inj.key)) AS found,
  count(*) FILTER (WHERE key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM det WHERE det.code = inj.code AND det.key = inj.key)
                   AND EXISTS (SELECT 1 FROM det WHERE det.key = inj.key)) AS other_reason,
  count(*) FILTER (WHERE key IS NULL) AS without_key FROM inj GROUP BY 1)"""


@query(with_(_CAUSE) + "SELECT *, " + half_up("100 * found", "injected", 1) + " AS recall_pct, code NOT IN ('TOXIC') AS covered FROM c")
def recall_with_cause(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.recall_with_cause(_injected(spark, d), _detected(spark, d), ["TOXIC"])


@query(with_(_CAUSE) + "SELECT CAST(sum(injected) AS BIGINT) AS injected, CAST(sum(found) AS BIGINT) AS found, "
       + half_up("100 * sum(found)", "sum(injected)", 1) + " AS recall_pct FROM c WHERE code <> 'TOXIC'")
def recall_covered(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.covered_recall(evaluate.recall_with_cause(_injected(spark, d), _detected(spark, d), ["TOXIC"]))


@query(with_(_RECALL) + "SELECT code, key FROM inj INTERSECT SELECT code, key FROM det")
def recall_common_pairs(spark: SparkSession, d: str) -> DataFrame:
    return reshape.common_pairs(_injected(spark, d), _detected(spark, d))


@query(with_(_RECALL) + "SELECT code, key FROM det EXCEPT SELECT code, key FROM inj")
def recall_only_detected(spark: SparkSession, d: str) -> DataFrame:
    return reshape.pairs_only_left(_detected(spark, d), _injected(spark, d))


# -- change capture over the event table ---------------------------------------------------------

USER_SPEC = SourceSpec("users", "users", "user_id bigint, event_type string, value double, at string, spare string", ("user_id",))


def _envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Change events of a table of users: one event per row, position = event id, errors delete."""
    image = F.struct("user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"))
    nothing = F.lit(None).cast("struct<user_id:bigint,event_type:string,value:double,at:string>")
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    made = F.round(S.iso_to_epoch_ms(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))).cast("bigint")
    body = F.struct(
        F.when(op == "c", nothing).otherwise(image).alias("before"), F.when(op == "d", nothing).otherwise(image).alias("after"),
        op.alias("op"), (made + 40 + F.col("event_id") % 7).alias("ts_ms"),
        F.struct((made + F.col("event_id") % 30).alias("ts_ms"), F.col("event_id").alias("lsn"), F.lit("users").alias("table")).alias("source"))
    return table(spark, d, "events").select(
        F.lit("users").alias("topic"), F.col("event_id").alias("offset"),
        F.timestamp_millis(made + 100 + F.col("event_id") % 50).alias("timestamp"), F.to_json(body).alias("value"))


_LAST_EVENT = """SELECT user_id, event_type, value, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at, CAST(NULL AS VARCHAR) AS spare
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'"""


@query(_LAST_EVENT)
def cdc_current_state(spark: SparkSession, d: str) -> DataFrame:
    return cdc.current_state(_envelopes(spark, d), USER_SPEC)


@query(_LAST_EVENT)
def cdc_redelivered(spark: SparkSession, d: str) -> DataFrame:
    """Every event twice, the second time at a later offset: the state is the same."""
    once = _envelopes(spark, d)
    return cdc.current_state(once.unionByName(once.withColumn("offset", F.col("offset") + 1_000_000_000)), USER_SPEC)


@query("SELECT CASE WHEN event_type = 'error' THEN 'd' WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS op, count(*) AS n FROM events "
       "WHERE event_type IN ('click', 'signup') GROUP BY 1")
def cdc_allow_list(spark: SparkSession, d: str) -> DataFrame:
    """One topic per event type, restricted to the captured ones."""
    topics = _envelopes(spark, d).withColumn("topic", F.coalesce(S.json_text("value", "after.event_type"), F.lit("error")))
    kept = cdc.decode(cdc.allow_tables(topics, ["click", "signup"]), USER_SPEC)
    return kept.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id AS lsn, 'u' AS op FROM events WHERE event_type = 'view'")
def cdc_missing_before(spark: SparkSession, d: str) -> DataFrame:
    """Updates whose before-image was cut off."""
    cut = F.when(F.col("value").contains('"event_type":"view"'), F.regexp_replace("value", r'^\{"before":\{[^}]*\},', "{")).otherwise(F.col("value"))
    return cdc.updates_without_before(_envelopes(spark, d).withColumn("value", cut), USER_SPEC).select("source.lsn", "op")


@query("""SELECT c AS column_name, (SELECT count(*) FROM events) AS rows, CASE c WHEN 'spare' THEN 0 ELSE (SELECT count(*) FROM events) END AS non_null,
  c = 'spare' AS suspect FROM (VALUES ('event_type'), ('value'), ('at'), ('spare')) v(c)""")
def cdc_null_columns(spark: SparkSession, d: str) -> DataFrame:
    events = cdc.parse_envelope(_envelopes(spark, d), USER_SPEC)
    return cdc.null_column_report(events, ["event_type", "value", "at", "spare"])


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem "
       "JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' AND l_returnflag <> 'A'")
def cdc_ghost_rows(spark: SparkSession, d: str) -> DataFrame:
    """Line keys that a fresh snapshot no longer has: their order left it, or the line did."""
    state = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    kept = table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    snapshot = table(spark, d, "lineitem").where("l_returnflag <> 'A'").join(kept, "l_orderkey", "left_semi")
    return cdc.find_ghost_rows(state, snapshot, ["l_orderkey", "l_linenumber"])


@query("""SELECT '{"user_id":' || user_id || '}' AS key, CASE WHEN event_type <> 'error' THEN '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' END AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def keyed_messages(spark: SparkSession, d: str) -> DataFrame:
    """Upsert messages with a tombstone for each removed key."""
    events = cdc.parse_envelope(_envelopes(spark, d), USER_SPEC)
    last = cdc.normalize_changelog(events, ["user_id"], keep_deletes=True)
    rows = last.select("user_id", "event_type", (F.col("_op") == "d").alias("gone"))
    return sinks.to_keyed_messages(rows, ["user_id"], "gone")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT 'orders' AS table_controlee, count(*) AS doublons FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'lineitem', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def duplicate_report(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.duplicate_report({"orders": (table(spark, d, "orders"), ["o_orderkey"]),
                                       "lineitem": (table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])})


# -- event-time windows --------------------------------------------------------------------------


@query("""SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS semaine_debut, event_type AS statut_remboursement,
  count(*) AS nombre_prestations, CAST(sum(CAST(COALESCE(value, 0) AS DECIMAL(18,2))) AS DOUBLE) AS montant_total FROM events WHERE ts IS NOT NULL GROUP BY ALL""")
def weekly_window_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(
        F.col("ts").alias("event_time"), F.col("event_type").alias("STATUT_REMBOURSEMENT"),
        F.col("value").alias("PRESTATION_MONTANT_DEPENSE"))
    return window.weekly_by_status(rows)


@query(f"""SELECT time_bucket(INTERVAL 7 DAY, CAST("at" AS TIMESTAMP), TIMESTAMP '1970-01-01') AS semaine_debut, event_type AS statut_remboursement,
  count(*) AS nombre_prestations, CAST(sum(CAST(COALESCE(value, 0) AS DECIMAL(18,2))) AS DOUBLE) AS montant_total FROM ({_LAST_EVENT}) GROUP BY ALL""")
def weekly_window_changes(spark: SparkSession, d: str) -> DataFrame:
    """Weekly sums over change events with updates, deletes and every event delivered twice."""
    once = _envelopes(spark, d)
    twice = once.unionByName(once.withColumn("offset", F.col("offset") + 1_000_000_000))
    spec = SourceSpec("users", "users", USER_SPEC.ddl, USER_SPEC.keys, {"event_time": ("iso", "at")})
    rows = cdc.current_state(twice, spec).select(
        "event_time", F.col("event_type").alias("STATUT_REMBOURSEMENT"), F.col("value").alias("PRESTATION_MONTANT_DEPENSE"))
    return window.weekly_by_status(rows)


# -- delays --------------------------------------------------------------------------------------


def _ship_delays(spark: SparkSession, d: str) -> DataFrame:
    """First shipment after each order, in microseconds, per priority."""
    joined = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_linenumber").join(
        table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority"), "o_orderkey")
    return joined.select("o_orderpriority", (S.micros_between("o_orderdate", "l_shipdate") + F.col("l_linenumber") * 1_234_567).alias("delay_us"))


@query("""SELECT o_orderpriority, count(*) AS n, avg(x) / 1e6 AS mean_s, min(x) / 1e6 AS min_s, max(x) / 1e6 AS max_s,
  quantile_cont(CAST(x AS DOUBLE), 0.5) / 1e6 AS median_s, quantile_cont(CAST(x AS DOUBLE), 0.95) / 1e6 AS p95_s
  FROM (SELECT o_orderpriority, epoch_us(l_shipdate) - epoch_us(o_orderdate) + l_linenumber * 1234567 AS x FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  GROUP BY 1""")
def latency_summary(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.latency_summary(_ship_delays(spark, d), "delay_us", ["o_orderpriority"])


@query("""WITH s AS (SELECT event_id, epoch_us(ts) AS c, CAST(round(epoch_us(ts) / 1000.0) AS BIGINT) AS m FROM events WHERE event_type = 'signup'),
  v AS (SELECT unnest([{'stage': 'commit', 'x': (m + event_id % 30) * 1000 - c}, {'stage': 'read', 'x': (40 + event_id % 7 - event_id % 30) * 1000},
    {'stage': 'publish', 'x': (60 + event_id % 50 - event_id % 7) * 1000}, {'stage': 'total', 'x': (m + 100 + event_id % 50) * 1000 - c}]) AS r FROM s)
  SELECT r.stage AS stage, count(*) AS n, max(r.x) / 1000.0 AS max_ms, quantile_cont(CAST(r.x AS DOUBLE), 0.5) / 1000 AS median_ms,
    list_sort(list(r.x))[CAST(floor(0.95 * (count(*) - 1)) AS BIGINT) + 1] / 1000.0 AS p95_ms FROM v GROUP BY 1""")
def stage_latency(spark: SparkSession, d: str) -> DataFrame:
    events = cdc.decode(_envelopes(spark, d), USER_SPEC)
    return evaluate.stage_latency(evaluate.stage_delays(events, "at", F.unix_millis("timestamp")))


@query("""WITH a AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS k FROM events WHERE event_type = 'signup'),
  s AS (SELECT ts + INTERVAL 1 SECOND * (30 + event_id % 977) AS seen, sum(CAST(event_type = 'signup' AS INT)) OVER (ORDER BY ts, event_id) + 100 AS c FROM events)
  SELECT a.event_id, a.ts, a.k, min(s.seen) AS seen_at, epoch_us(min(s.seen)) - epoch_us(a.ts) AS delay_us
  FROM a JOIN (SELECT c, min(seen) AS seen FROM s GROUP BY 1) s ON s.c >= a.k + 100 GROUP BY a.event_id, a.ts, a.k""")
def kth_arrival(spark: SparkSession, d: str) -> DataFrame:
    """Arrivals = signups; samples = the running counter, read after every event, each time with another
    delay, so that a later sample can be the first to show a count."""
    events = table(spark, d, "events").select("event_id", "ts", "event_type")
    day, order = F.col("ts").cast("date"), ["ts", "event_id"]
    arrivals = ranking.row_numbers(events.where("event_type = 'signup'").select("event_id", "ts"), [], day, order)
    counted = ranking.running_total(events, [], day, order, S.flag_of_state("event_type", "signup"), "n")
    seen = F.col("ts") + F.make_dt_interval(secs=(30 + F.col("event_id") % 977).cast("decimal(18,6)"))
    samples = counted.select(seen.alias("at"), (F.col("n") + 100).alias("counter"))
    return evaluate.kth_arrival(arrivals, samples, 100, "ts", "counter", "at")


@query("""WITH p AS (SELECT CAST(epoch_us(max(ts)) - epoch_us(TIMESTAMP '2024-01-01') AS DOUBLE) / 1e6 AS t_s, max(event_id) + 1 AS n
    FROM events GROUP BY event_id // 100), g AS (SELECT max(n) AS total FROM p),
  m AS (SELECT min(CASE WHEN least(n, total - 150) = total - 150 AND t_s >= 3600 THEN t_s END) AS equal_at_s,
               min(CASE WHEN least(n, total - 150) = total - 150 AND t_s >= 3600 AND n >= total THEN t_s END) AS done_at_s, max(total) AS total FROM p, g)
  SELECT equal_at_s, done_at_s, done_at_s - 1800 AS recovery_s, total AS events_read, total / greatest(done_at_s - 3600, 1.0) AS events_per_s,
    (SELECT min(least(n, total - 150)) FROM p) AS lowest_invoices, (SELECT min(n // 2) FROM p) AS lowest_services FROM m""")
def recovery_summary(spark: SparkSession, d: str) -> DataFrame:
    """Probes every 100 events of a replay; totals reach the source's figure before the replay ends."""
    events = table(spark, d, "events")
    total = events.agg((F.max("event_id") + 1).alias("n")).scalar()
    target = total - 150
    half = F.floor(target / 2).cast("bigint")
    span = S.micros_between(F.lit("2024-01-01").cast("timestamp_ntz"), F.max("ts")) / F.lit(1e6)
    probes = events.groupBy(F.expr("event_id DIV 100")).agg(
        span.alias("t_s"), (F.max("event_id") + 1).alias("events_read"))
    probes = probes.select("t_s", "events_read", F.least("events_read", target).alias("invoices"),
                           F.when(F.col("events_read") >= target, half).otherwise(F.expr("events_read DIV 2")).alias("services"))
    return evaluate.recovery_summary(probes, target, half, total, 1800.0, 3600.0)


# -- reconciliation --------------------------------------------------------------------------------


@query(with_(ENRICHED) + """SELECT jour, CAST(s.n AS DECIMAL(28,2)) AS source_n_services, CAST(t.n AS DECIMAL(28,2)) AS target_n_services,
    CAST(s.b AS DECIMAL(28,2)) AS source_billed, CAST(t.b AS DECIMAL(28,2)) AS target_billed, s.n IS NOT NULL AS in_source, t.n IS NOT NULL AS in_target,
    CAST(COALESCE(t.n, 0) - COALESCE(s.n, 0) AS DECIMAL(28,2)) AS delta_n_services, CAST(COALESCE(t.b, 0) - COALESCE(s.b, 0) AS DECIMAL(28,2)) AS delta_billed,
    CASE WHEN s.n IS NULL OR t.n > s.n OR t.b > s.b THEN 'target_ahead' WHEN t.n IS NULL OR t.n < s.n OR t.b < s.b THEN 'source_ahead' ELSE 'ok' END AS verdict
  FROM (SELECT jour, count(*) AS n, sum(billed) AS b FROM enr GROUP BY 1) s
  FULL JOIN (SELECT jour, count(*) AS n, sum(billed) AS b FROM enr WHERE invoice_type <> 'P' OR scheme <> '5-LOW' GROUP BY 1) t USING (jour)""")
def reconcile_days(spark: SparkSession, d: str) -> DataFrame:
    """Source recomputed from raw rows against a daily table that misses some invoices."""
    source = star.enriched(spark, d).groupBy("jour").agg(F.count(F.lit(1)).alias("n_services"), F.sum("billed").alias("billed"))
    stale = star.service_units(spark, d).where("not (invoice_type = 'P' and scheme = '5-LOW')")
    target = rollup.additive(stale, ["jour"], {"n_services": "n_services"}, {"billed": "billed"})
    return reconcile.reconcile(source, target, ["jour"], ["n_services", "billed"])


@query("""WITH s AS (SELECT CAST(o_orderdate AS DATE) AS jour, count(*) AS n, count(*) FILTER (WHERE o_orderstatus <> 'P') AS one,
    count(*) FILTER (WHERE o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT') AS two FROM orders GROUP BY 1)
  SELECT jour, CASE WHEN one > 0 THEN CAST(one - n AS DECIMAL(28,2)) ELSE CAST(-n AS DECIMAL(28,2)) END AS gap_first, CAST(two - n AS DECIMAL(28,2)) AS gap_second,
    CASE WHEN two - n = 0 THEN 'ok' WHEN n - two < n - one THEN 'lag' ELSE 'stuck' END AS reading FROM s""")
def reconcile_lag(spark: SparkSession, d: str) -> DataFrame:
    """Two readings: the second has caught up on some days."""
    orders = table(spark, d, "orders").withColumn("jour", F.col("o_orderdate").cast("date"))
    def per_day(df: DataFrame) -> DataFrame:
        return df.groupBy("jour").agg(F.count(F.lit(1)).alias("n"))
    first = reconcile.reconcile(per_day(orders), per_day(orders.where("o_orderstatus <> 'P'")), ["jour"], ["n"])
    caught_up = orders.where("o_orderstatus <> 'P' or o_orderpriority = '1-URGENT'")
    second = reconcile.reconcile(per_day(orders), per_day(caught_up), ["jour"], ["n"])
    return reconcile.lag_or_error(first, second, ["jour"], "n")




@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES))
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.row_counts({t: table(spark, d, t) for t in TABLES})


@query("""SELECT event_type AS table_name, a AS reference_rows, b AS restored_rows, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN abs(b - a) * 100.0 / a END AS delta_pct,
  CASE WHEN a IS NULL THEN 'ABSENTE' WHEN b IS NULL THEN 'MANQUANTE' WHEN abs(b - a) * 100.0 / a <= 5 THEN 'OK' ELSE 'ECART' END AS verdict FROM (
  SELECT event_type, NULLIF(count(*) FILTER (WHERE event_type <> 'view'), 0) AS a, NULLIF(count(*) FILTER (WHERE event_type <> 'error' AND value > 2), 0) AS b FROM events GROUP BY 1)""")
def count_compare(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    def counts(df: DataFrame) -> DataFrame:
        return df.groupBy(F.col("event_type").alias("table_name")).agg(F.count(F.lit(1)).alias("rows"))
    return reconcile.compare_counts(counts(events.where("event_type <> 'view'")),
                                    counts(events.where("event_type <> 'error' and value > 2")), 5.0)


@query(with_(ENRICHED) + """, tot AS (SELECT person, count(*) AS n_services FROM enr GROUP BY 1),
  top AS (SELECT *, rank() OVER (ORDER BY n_services DESC) AS rang FROM tot QUALIFY rang <= 10)
  SELECT count(*) AS rows, sum(CAST('0x' || substring(md5(person || chr(31) || n_services), 1, 16) AS HUGEINT)) || '-' ||
  sum(CAST('0x' || substring(md5(person || chr(31) || n_services), 17, 16) AS HUGEINT)) AS fingerprint FROM top""")
def fingerprint_top(spark: SparkSession, d: str) -> DataFrame:
    totals = rollup.additive(star.service_units(spark, d), ["person"], {"n_services": "n_services"})
    return reconcile.fingerprint(ranking.top_n_with_ties(totals, "n_services", 10), ["person", "n_services"])


@query(with_(ENRICHED) + """, p AS (SELECT person AS code, count(*) AS n FROM enr GROUP BY 1), c AS (SELECT centre AS code, count(*) AS n FROM enr GROUP BY 1),
  r AS (SELECT 'persons' AS ranking, * FROM (SELECT * FROM p ORDER BY n DESC, code LIMIT 10) UNION ALL SELECT 'centres', * FROM (SELECT * FROM c ORDER BY n DESC, code LIMIT 10))
  SELECT ranking, count(*) AS rows, md5(string_agg(code || ':' || n, ',' ORDER BY n DESC, code)) AS fingerprint FROM r GROUP BY 1""")
def ranking_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Ordered md5 of two rankings of ten, as a short proof of their content and order."""
    rows = star.service_units(spark, d)
    def of(name: str, code: str) -> DataFrame:
        totals = rollup.additive(rows, [F.col(code).alias("code")], {"n": "n_services"})
        labelled = totals.withColumn("label", F.concat_ws(":", "code", F.col("n").cast("string")))
        return reconcile.ordered_md5(labelled, "label", [F.desc("n"), "code"], 10).select(F.lit(name).alias("ranking"), "rows", "fingerprint")
    return of("persons", "person").unionByName(of("centres", "centre"))


@query("SELECT DISTINCT CAST(l_shipdate AS DATE) AS jour FROM lineitem WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL)")
def ghost_days(spark: SparkSession, d: str) -> DataFrame:
    target = table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("jour"))
    source = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("jour")).where("jour is not null")
    return reconcile.ghost_days(target, source)


# -- audit -----------------------------------------------------------------------------------------

_MANIFEST = """m AS (SELECT CAST(o_orderkey AS VARCHAR) AS name, o_custkey AS archive, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos,
    sha256(o_orderkey || '/' || o_orderstatus) AS file_hash, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
    WHEN o_orderpriority = '2-HIGH' THEN sha256('changed') ELSE sha256(o_orderkey || '/' || o_orderstatus) END AS actual_hash FROM orders),
  p AS (SELECT *, CASE WHEN pos % 3 = 1 THEN repeat('0', 64) ELSE sha256('link' || archive || '/' || (pos - 1)) END AS previous FROM m),
  c AS (SELECT *, CASE WHEN pos % 5 = 0 THEN sha256(previous || file_hash || name) ELSE sha256('link' || archive || '/' || pos) END AS chain FROM p),
  v AS (SELECT archive, pos, name, actual_hash IS NULL AS missing, COALESCE(actual_hash <> file_hash, false) AS altered,
    actual_hash IS NOT NULL AND previous IS DISTINCT FROM (CASE WHEN pos = 1 THEN repeat('0', 64) ELSE lag(chain) OVER (PARTITION BY archive ORDER BY pos) END) AS broken,
    actual_hash IS NOT NULL AND sha256(previous || file_hash || name) <> chain AS invalid FROM c)"""


@query(with_(_MANIFEST) + "SELECT *, NOT (missing OR altered OR broken OR invalid) AS ok FROM v")
def chain_verify(spark: SparkSession, d: str) -> DataFrame:
    """A manifest of one archive per customer with every kind of fault in it."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    numbered = ranking.row_numbers(orders, ["o_custkey"], F.shiftright("o_orderkey", 16), ["o_orderkey"], "pos")
    text = F.concat(F.col("o_orderkey").cast("string"), F.lit("/"), "o_orderstatus")
    rows = numbered.select(
        F.col("o_orderkey").cast("string").alias("name"), F.col("o_custkey").alias("archive"),
        "pos", S.sha256(text).alias("file_hash"), "o_orderstatus", "o_orderpriority")
    def link(position):
        return S.sha256(F.concat(F.lit("link"), F.col("archive").cast("string"), F.lit("/"), position.cast("string")))
    pos = F.col("pos")
    rows = rows.withColumn("previous", F.when(pos % 3 == 1, audit.GENESIS).otherwise(link(pos - 1)))
    rows = rows.withColumn("chain", F.when(pos % 5 == 0, S.sha256(F.concat("previous", "file_hash", "name"))).otherwise(link(pos)))
    kept = rows.where("not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')")
    actual = kept.select("name", F.when(F.col("o_orderpriority") == "2-HIGH", S.sha256(F.lit("changed"))).otherwise(F.col("file_hash")).alias("actual_hash"))
    manifest = rows.select("archive", "pos", "name", "file_hash", "previous", "chain")
    return audit.verify_chain(manifest, actual, "pos", by=["archive"])


@query(with_(_MANIFEST) + "SELECT count(*) AS entries, count(*) FILTER (WHERE missing OR altered OR broken OR invalid) AS failures, "
       "count(*) FILTER (WHERE missing OR altered OR broken OR invalid) = 0 AS conform FROM v")
def chain_verdict(spark: SparkSession, d: str) -> DataFrame:
    return audit.chain_verdict(chain_verify(spark, d))


@query("""SELECT event_id, ts, event_type, COALESCE(c_name, 'anonyme') AS utilisateur FROM events LEFT JOIN customer ON c_custkey = user_id AND c_acctbal > 1000
  WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'""")
def audit_day_slice(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    users = table(spark, d, "customer").where("c_acctbal > 1000").select(F.col("c_custkey").alias("user_id"), "c_name")
    return audit.day_slice(log, users, "2024-01-10", "ts", "user_id", "c_name")


# -- alerts ----------------------------------------------------------------------------------------


@query("SELECT max(ts) AS newest, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 1e6 AS age_s, "
       "(epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 1e6 > 300 AS alert FROM events")
def freshness(spark: SparkSession, d: str) -> DataFrame:
    return health.freshness(table(spark, d, "events"), "ts", F.lit("2024-02-01").cast("timestamp_ntz"))


@query("""WITH m AS (SELECT event_type, ts, value, COALESCE(value > 3, false) AS above, max(CASE WHEN NOT COALESCE(value > 3, false) THEN ts END)
    OVER (PARTITION BY event_type ORDER BY ts) AS since FROM events)
  SELECT event_type, min(ts) AS started_at, min(ts) + INTERVAL 30 MINUTE AS fires_at, max(ts) AS last_seen_at, count(*) AS samples, max(value) AS peak
  FROM m WHERE above GROUP BY event_type, since HAVING max(ts) >= min(ts) + INTERVAL 30 MINUTE""")
def threshold_held(spark: SparkSession, d: str) -> DataFrame:
    return health.threshold_held(table(spark, d, "events"), "event_type", "ts", "value", 3.0, "30 MINUTES")


@query("SELECT event_type, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS up FROM events GROUP BY 1")
def state_flags(spark: SparkSession, d: str) -> DataFrame:
    flagged = table(spark, d, "events").select("event_type", S.flag_of_state("event_type", "signup").alias("f"))
    return flagged.groupBy("event_type").agg(F.sum("f").alias("up"))
