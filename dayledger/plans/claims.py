"""The health-claims plan: current source rows to KPI, dimension, fact and quarantine tables.

Sources are DataFrames of current rows keyed as in ``dayledger.sources.specs.SPECS``. Nothing here
runs a job: every function returns a plan, used unchanged by batch runs and by micro-batches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions import scalars as S
from dayledger.operators import daily, enrich
from dayledger.operators.quality import Rule, quarantine
from dayledger.operators.reshape import stack

Sources = Mapping[str, DataFrame]

# Codes in use at the source.
VALID_ACTS = (
    "BIO-CRE", "BIO-CRP", "BIO-GEU", "BIO-GLY", "BIO-GRO", "BIO-HBA", "BIO-HBS", "BIO-LIP", "BIO-NFS", "BIO-SEL",
    "BIO-TRA", "BIO-URE", "BIO-URI", "CONS-GEN", "CONS-SPE", "DENT-CAR", "DENT-DET", "DENT-EXT", "HOS-CHI", "HOS-MAT",
    "HOS-MED", "HOS-PED", "HOS-REA", "IMG-ECH", "IMG-IRM", "IMG-MAM", "IMG-RAD", "IMG-SCA", "SOI-PAN", "URG-ACC",
)
VALID_CENTRE_TYPES = (
    "AUT", "CAT", "CHR", "CHU", "CLN", "CMS", "CS", "CSR", "CSU", "DISP", "FSU", "HG", "HOP", "INST", "MAT", "MIL",
    "PMI", "SSSU",
)
INJECTION_PAYLOADS = (
    "'; DROP TABLE TB_FACTURES; --", "' OR '1'='1", "<script>alert(1)</script>", "../../../etc/passwd",
    "${jndi:ldap://x}", "{{7*7}}",
)
SECU_LENGTH, SECU_PREFIX = 13, "394"
MAX_AMOUNT = 500_000
BACKDATED_DAYS = 60
MAX_AGE_YEARS = 100

# Family of each reason. The birth-date reason follows the live rules (IDENTITE).
FAMILIES = {
    "MONTANTS": ("MONTANT_ABERRANT", "MONTANT_HORS_BAREME", "REPARTITION_FAUSSEE", "montant_depense_manquant",
                 "montant_engage_negatif"),
    "DATES": ("DATE_ANTIDATEE", "DATE_SOINS_FUTURE", "DATE_HORS_DROITS", "date_soins_manquante"),
    "IDENTITE": ("NUMERO_SECU_INVALIDE", "CHAMP_OBLIGATOIRE_VIDE", "DATE_NAISSANCE_ABERRANTE", "DOUBLON_EXACT",
                 "DOUBLON_APPROCHANT"),
    "QUANTITES": ("QUANTITE_NULLE", "QUANTITE_EXCESSIVE"),
    "FORMAT": ("EMAIL_INVALIDE", "ENCODAGE_CASSE", "TENTATIVE_INJECTION", "type_demande_manquant"),
    "REFERENTIEL": ("PRESTATION_ORPHELINE", "TYPE_CENTRE_INCONNU"),
}
# Catalogue codes that no row-by-row rule covers.
NOT_COVERED = ("DOUBLON_EXACT", "DOUBLON_APPROCHANT", "DATE_HORS_DROITS", "FORMAT_DATE_INCOHERENT")


# -- lines and requests, cleaned for the KPIs ------------------------------------------------------


def enriched_services(src: Sources) -> DataFrame:
    """Service lines with their invoice: dated, unknown members named, missing amounts zero."""
    dims = {
        "type_facture_code": "TYPE_FACTURE_CODE", "regime_code": "REGIME_CODE",
        "centre_sante_type_libelle": "CENTRE_SANTE_TYPE_LIBELLE", "centre_sante_code": "CENTRE_SANTE_CODE",
        "professionnel_sante_code": "PROFESSIONNEL_SANTE_CODE", "personne_uuid": "PERSONNE_UUID",
    }
    amounts = {
        "montant_depense": "PRESTATION_MONTANT_DEPENSE", "montant_rq": "PRESTATION_MONTANT_RQ",
        "montant_assure": "PRESTATION_MONTANT_ASSURE",
    }
    return enrich.enrich_lines(src["services"], src["invoices"], "FACTURE_NUMERO", "jour_soins", dims, amounts,
                               {"prestation_code": "PRESTATION_CODE"})


def valid_invoices(src: Sources) -> DataFrame:
    """Visits, from invoices alone: no join is needed to count them."""
    dated = enrich.dated(src["invoices"], "jour_soins")
    return dated.select(
        F.col("jour_soins").alias("jour"), S.or_unknown("TYPE_FACTURE_CODE").alias("type_facture_code"),
        S.or_unknown("REGIME_CODE").alias("regime_code"),
        S.or_unknown("CENTRE_SANTE_TYPE_LIBELLE").alias("centre_sante_type_libelle"))


def request_amounts(src: Sources) -> DataFrame:
    return enrich.sum_per_key(src["acts"], "ENTENTE_PREALABLE_ID", "ACTE_MEDICAL_MONTANT_CMU", "amount")


def enriched_requests(src: Sources) -> DataFrame:
    asked = src["requests"].select("ENTENTE_PREALABLE_ID", "TYPE_DEMANDE_CODE", F.col("event_time").alias("request_time"))
    answered = src["answers"].select(
        "ENTENTE_PREALABLE_ID", F.col("STATUT_CODE").alias("status_code"), F.col("AGENT_CODE").alias("agent_code"),
        F.col("event_time").alias("answer_time"))
    joined = enrich.left_status(asked, answered, request_amounts(src), "ENTENTE_PREALABLE_ID")
    return joined.select(
        "jour", F.col("status_code").alias("statut_code"), S.or_unknown("TYPE_DEMANDE_CODE").alias("type_demande_code"),
        "agent_code", F.col("delay_hours").alias("delai_heures"), F.col("amount").alias("montant_engage_cmu"))


# -- daily tables ----------------------------------------------------------------------------------

# Grain, row count and summed amounts of the additive tables: {table: (keys, count, {output: input})}.
SERVICE_TABLES: dict[str, tuple[tuple[str, ...], str, dict[str, str]]] = {
    "kpi_prestations_jour": (
        ("jour", "prestation_code", "type_facture_code", "regime_code", "centre_sante_type_libelle"),
        "nombre_prestations",
        {"montant_depense": "montant_depense", "montant_pris_en_charge": "montant_rq",
         "montant_reste_a_charge": "montant_assure"}),
    "kpi_prestations_centre_jour": (
        ("jour", "centre_sante_code"), "nombre_prestations", {"montant_depense": "montant_depense"}),
    "kpi_prestations_praticien_jour": (
        ("jour", "professionnel_sante_code"), "nombre_prestations", {"montant_depense": "montant_depense"}),
    "kpi_prestations_assure_jour": (
        ("jour", "personne_uuid", "centre_sante_code"), "nombre_prestations", {"montant_depense": "montant_depense"}),
}
INVOICE_TABLES = {
    "kpi_factures_jour": (("jour", "type_facture_code", "regime_code", "centre_sante_type_libelle"), "nombre_factures", {}),
}
REQUEST_KEYS = ("jour", "statut_code", "type_demande_code")
AGENT_KEYS = ("jour", "agent_code", "statut_code")
FACT_TABLES = {
    "kpi_prescriptions_medicament_jour": (("jour", "medicament_code"), "nombre_prescriptions", {}),
    "kpi_pathologies_jour": (("jour", "pathologie_code"), "nombre_pathologies", {}),
}


def prescription_rows(src: Sources) -> DataFrame:
    return src["prescriptions"].select(F.col("jour_prescription").alias("jour"),
                                       F.col("PRESCRIPTION_CODE").alias("medicament_code"))


def pathology_rows(src: Sources) -> DataFrame:
    return src["pathologies"].select(F.col("jour_pathologie").alias("jour"),
                                     F.col("PATHOLOGIE_CODE").alias("pathologie_code"))


def mean_delay(hours: Column, answered: Column) -> Column:
    return S.ratio(hours, answered).cast("decimal(10,2)")


def kpi_tables(src: Sources, services: DataFrame | None = None, requests: DataFrame | None = None) -> dict[str, DataFrame]:
    """The nine daily tables. Pass persisted ``services`` / ``requests`` when several are written."""
    services = enriched_services(src) if services is None else services
    requests = enriched_requests(src) if requests is None else requests
    out: dict[str, DataFrame] = {}
    for base, tables in ((services, SERVICE_TABLES), (valid_invoices(src), INVOICE_TABLES)):
        for name, (keys, count, amounts) in tables.items():
            out[name] = daily.count_and_sum(base, keys, count, amounts)
    out["kpi_ententes_prealables_jour"] = requests.groupBy(*REQUEST_KEYS).agg(
        F.count(F.lit(1)).alias("nombre_ententes"),
        mean_delay(F.sum("delai_heures"), F.count("delai_heures")).alias("delai_moyen_heures"),
        S.sum_money("montant_engage_cmu").alias("montant_engage_cmu"))
    out["kpi_ententes_prealables_agent_jour"] = daily.count_and_sum(
        requests.where(F.col("agent_code").isNotNull()), AGENT_KEYS, "nombre_ententes")
    for base, (name, (keys, count, amounts)) in zip((prescription_rows(src), pathology_rows(src)), FACT_TABLES.items()):
        out[name] = daily.count_and_sum(base, keys, count, amounts)
    return out


# -- dimensions and line-level facts -----------------------------------------------------------------

# {table: (source, {column: source column}, key columns)}
DIMENSIONS: dict[str, tuple[str, dict[str, str], tuple[str, ...]]] = {
    "dim_centres_sante": ("centres", {
        "centre_sante_code": "CENTRE_SANTE_CODE", "centre_sante_denomination": "CENTRE_SANTE_DENOMINATION",
        "collectivite_code": "COLLECTIVITE_CODE",
        "type_etablissement_sanitaire_code": "TYPE_ETABLISSEMENT_SANITAIRE_CODE"}, ("centre_sante_code",)),
    "dim_professionnels_sante": ("practitioners", {
        "professionnel_sante_code": "PROFESSIONNEL_SANTE_CODE", "nom": "NOM", "prenoms": "PRENOMS",
        "type_code": "TYPE_CODE", "statut": "STATUT"}, ("professionnel_sante_code",)),
    "dim_collectivites": ("localities", {
        "collectivite_code": "COLLECTIVITE_CODE", "collectivite_denomination": "COLLECTIVITE_DENOMINATION",
        "collectivite_latitude": "COLLECTIVITE_LATITUDE", "collectivite_longitude": "COLLECTIVITE_LONGITUDE"},
        ("collectivite_code",)),
    "dim_agents": ("agents", {
        "agent_code": "AGENT_CODE", "agent_nom": "AGENT_NOM", "agent_prenoms": "AGENT_PRENOMS",
        "agent_type_code": "AGENT_TYPE_CODE"}, ("agent_code",)),
    "dim_medicaments": ("medicines", {
        "medicament_code": "MEDICAMENT_CODE", "medicament_denomination": "MEDICAMENT_DENOMINATION",
        "dci_code": "DCI_CODE"}, ("medicament_code",)),
    "dim_dci": ("substances", {"dci_code": "DCI_CODE", "dci_denomination": "DCI_DENOMINATION"}, ("dci_code",)),
    "dim_pathologies": ("pathology_names", {
        "pathologie_code": "PATHOLOGIE_CODE", "pathologie_denomination": "PATHOLOGIE_DENOMINATION"},
        ("pathologie_code",)),
}
FACTS: dict[str, tuple[str, dict[str, str], tuple[str, ...]]] = {
    "fait_prescriptions": ("prescriptions", {
        "facture_numero": "FACTURE_NUMERO", "prescription_code": "PRESCRIPTION_CODE", "date_debut": "jour_prescription"},
        ("facture_numero", "prescription_code", "date_debut")),
    "fait_pathologies": ("pathologies", {
        "facture_numero": "FACTURE_NUMERO", "pathologie_code": "PATHOLOGIE_CODE", "date_debut": "jour_pathologie"},
        ("facture_numero", "pathologie_code", "date_debut")),
    "fait_entente_facture": ("requests", {
        "entente_prealable_id": "ENTENTE_PREALABLE_ID", "facture_numero": "FACTURE_NUMERO",
        "type_demande_code": "TYPE_DEMANDE_CODE", "date_debut": "event_time"}, ("entente_prealable_id",)),
    "fait_entente_statut": ("answers", {
        "entente_prealable_id": "ENTENTE_PREALABLE_ID", "statut_code": "STATUT_CODE"}, ("entente_prealable_id",)),
}


def current_dimension(src: Sources, name: str) -> DataFrame:
    """One catalogue or fact table: current rows, renamed columns, no person identifier."""
    source, columns, _ = {**DIMENSIONS, **FACTS}[name]
    out = enrich.project(src[source], columns)
    if name == "dim_collectivites":
        for c in ("collectivite_latitude", "collectivite_longitude"):
            out = out.withColumn(c, F.col(c).cast("decimal(9,6)"))
    if name == "fait_entente_facture":
        out = out.withColumn("date_debut", F.col("date_debut").cast("date"))
    return out


def dimension_tables(src: Sources) -> dict[str, DataFrame]:
    return {name: current_dimension(src, name) for name in (*DIMENSIONS, *FACTS)}


# -- quarantine ------------------------------------------------------------------------------------


def _day(name: str | None, value: Column | None = None) -> dict[str, Column]:
    """The day of a quarantine row beside its raw row, if asked for by name; NULL in a domain without days."""
    return {} if name is None else {name: F.lit(None).cast("date") if value is None else value}


def raw_services(src: Sources) -> DataFrame:
    """Service lines with their invoice, before any default: a NULL is what the rules look for."""
    joined = enrich.join_lines(src["services"], src["invoices"], "FACTURE_NUMERO")
    return enrich.project(joined, {
        "jour": "jour_soins", "facture_numero": "FACTURE_NUMERO", "prestation_code": "PRESTATION_CODE",
        "professionnel_sante_code": "PROFESSIONNEL_SANTE_CODE", "montant_depense": "PRESTATION_MONTANT_DEPENSE",
        "montant_rq": "PRESTATION_MONTANT_RQ", "montant_assure": "PRESTATION_MONTANT_ASSURE",
        "quantite_prescrite": "PRESTATION_QUANTITE_PRESCRITE", "quantite_servie": "PRESTATION_QUANTITE_SERVIE",
        "taux_remboursement": "PRESTATION_TAUX_REMBOURSEMENT", "type_facture_code": "TYPE_FACTURE_CODE",
        "regime_code": "REGIME_CODE", "centre_sante_code": "CENTRE_SANTE_CODE", "personne_uuid": "PERSONNE_UUID"})


def service_rules(max_amount: float = MAX_AMOUNT, acts: Sequence[str] = VALID_ACTS, tolerance: float = 1) -> list[Rule]:
    billed, served, prescribed = F.col("montant_depense"), F.col("quantite_servie"), F.col("quantite_prescrite")
    split = F.coalesce("montant_rq", F.lit(0.0)) + F.coalesce("montant_assure", F.lit(0.0))
    return [
        Rule("date_soins_manquante", "DATES", F.col("jour").isNull()),
        Rule("montant_depense_manquant", "MONTANTS", billed.isNull()),
        Rule("MONTANT_ABERRANT", "MONTANTS", ~billed.between(0, max_amount)),
        Rule("QUANTITE_NULLE", "QUANTITES", (served == 0) & (prescribed > 0)),
        Rule("QUANTITE_EXCESSIVE", "QUANTITES", served > prescribed),
        Rule("MONTANT_HORS_BAREME", "MONTANTS", ~F.col("taux_remboursement").between(0, 100)),
        Rule("REPARTITION_FAUSSEE", "MONTANTS", F.abs(split - billed) > tolerance),
        Rule("PRESTATION_ORPHELINE", "REFERENTIEL", S.not_member("prestation_code", acts)),
    ]


def service_quarantine(rows: DataFrame, rules: Sequence[Rule] | None = None, mode: str = "first", day: str | None = None) -> DataFrame:
    raw = {c: c for c in rows.columns if c != "jour"}
    raw["jour_soins"] = F.col("jour").cast("string")
    return quarantine(rows, "prestation", S.business_key("facture_numero", "prestation_code"),
                      rules or service_rules(), raw, mode, _day(day, F.col("jour")))


def undated_invoices(invoices: DataFrame, day: str | None = None) -> DataFrame:
    raw = {
        "facture_numero": "FACTURE_NUMERO", "type_facture_code": "TYPE_FACTURE_CODE", "regime_code": "REGIME_CODE",
        "centre_sante_code": "CENTRE_SANTE_CODE", "centre_sante_type_libelle": "CENTRE_SANTE_TYPE_LIBELLE",
        "personne_uuid": "PERSONNE_UUID", "facture_date_soins_brute": F.col("FACTURE_DATE_SOINS").cast("string")}
    rules = [Rule("date_soins_manquante", "DATES", F.col("jour_soins").isNull())]
    return quarantine(invoices, "facture", F.col("FACTURE_NUMERO"), rules, raw, keep=_day(day))


def invoice_rules(centre_types: Sequence[str] = VALID_CENTRE_TYPES, backdated: int = BACKDATED_DAYS) -> list[Rule]:
    """Care date against creation date, never against today: a replay gives the same rows."""
    care, made = F.col("jour_soins"), F.col("date_creation_facture").cast("date")
    return [
        Rule("DATE_ANTIDATEE", "DATES", care < F.date_sub(made, backdated)),
        Rule("DATE_SOINS_FUTURE", "DATES", care > made),
        Rule("TYPE_CENTRE_INCONNU", "REFERENTIEL", S.not_member("CENTRE_SANTE_TYPE_CODE", centre_types)),
    ]


def invoice_quarantine(invoices: DataFrame, rules: Sequence[Rule] | None = None, mode: str = "first", day: str | None = None) -> DataFrame:
    raw = {
        "facture_numero": "FACTURE_NUMERO", "centre_sante_code": "CENTRE_SANTE_CODE",
        "centre_sante_type_code": "CENTRE_SANTE_TYPE_CODE", "jour_soins": F.col("jour_soins").cast("string"),
        "date_creation_facture": F.date_format("date_creation_facture", "yyyy-MM-dd HH:mm:ss.SSS")}
    dated = invoices.where(F.col("jour_soins").isNotNull() & F.col("date_creation_facture").isNotNull())
    return quarantine(dated, "facture", F.col("FACTURE_NUMERO"), rules or invoice_rules(), raw, mode, _day(day, F.col("jour_soins")))


def agent_quarantine(agents: DataFrame, day: str | None = None) -> DataFrame:
    raw = {
        "agent_code": "AGENT_CODE", "agent_nom": "AGENT_NOM", "agent_prenoms": "AGENT_PRENOMS",
        "agent_email": "AGENT_EMAIL", "agent_type_code": "AGENT_TYPE_CODE"}
    rules = [Rule("EMAIL_INVALIDE", "FORMAT", ~F.col("AGENT_EMAIL").like("%@%.%"))]
    return quarantine(agents, "agent", F.col("AGENT_CODE"), rules, raw, keep=_day(day))


def request_quarantine(requests: DataFrame, answers: DataFrame, amounts: DataFrame, mode: str = "first", day: str | None = None) -> DataFrame:
    """``amounts`` is one row per request (see ``request_amounts``)."""
    key = "ENTENTE_PREALABLE_ID"
    rows = (requests.join(answers.select(key, "STATUT_CODE", "AGENT_CODE"), key, "left")
            .join(amounts, key, "left"))
    raw = {
        "entente_prealable_id": F.col(key).cast("string"), "type_demande_code": "TYPE_DEMANDE_CODE",
        "date_debut": "ENTENTE_PREALABLE_DATE_DEBUT", "statut_code": "STATUT_CODE", "agent_code": "AGENT_CODE",
        "montant_engage_cmu": "amount"}
    rules = [
        Rule("type_demande_manquant", "FORMAT", F.col("TYPE_DEMANDE_CODE").isNull()),
        Rule("montant_engage_negatif", "MONTANTS", F.col("amount") < 0),
    ]
    asked = F.substring("ENTENTE_PREALABLE_DATE_DEBUT", 1, 10).cast("date")
    return quarantine(rows, "entente_prealable", F.col(key).cast("string"), rules, raw, mode, _day(day, asked))


def person_rules(as_of: str | None = None) -> list[Rule]:
    """``as_of`` is the day ages are judged on (today if not given); a fixed day does not drift."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    name, secu, birth = F.col("ASSURE_NOM"), F.col("NUMERO_SECU"), F.col("date_naissance")
    broken = name.contains("?") | name.contains("Ã") | name.contains("Â")
    return [
        Rule("CHAMP_OBLIGATOIRE_VIDE", "IDENTITE", name == ""),
        Rule("ENCODAGE_CASSE", "FORMAT", broken),
        Rule("TENTATIVE_INJECTION", "FORMAT", S.member("ASSURE_NOM", INJECTION_PAYLOADS)),
        Rule("NUMERO_SECU_INVALIDE", "IDENTITE",
             (F.char_length(secu) != SECU_LENGTH) | ~secu.startswith(SECU_PREFIX)),
        Rule("DATE_NAISSANCE_ABERRANTE", "IDENTITE",
             (birth > today) | (birth < F.add_months(today, -12 * MAX_AGE_YEARS))),
    ]


def person_quarantine(persons: DataFrame, as_of: str | None = None, mode: str = "first", day: str | None = None) -> DataFrame:
    raw = {
        "personne_uuid": "PERSONNE_UUID", "assure_numero_identifiant": "ASSURE_NUMERO_IDENTIFIANT",
        "numero_secu": "NUMERO_SECU", "assure_nom": "ASSURE_NOM", "assure_prenoms": "ASSURE_PRENOMS",
        "assure_date_naissance": F.col("date_naissance").cast("string")}
    return quarantine(persons, "assure", F.col("PERSONNE_UUID"), person_rules(as_of), raw, mode, _day(day))


def quarantine_table(src: Sources, as_of: str | None = None, mode: str = "first") -> DataFrame:
    """All domains, one row per flagged row and reason."""
    return stack([
        service_quarantine(raw_services(src), mode=mode),
        undated_invoices(src["invoices"]),
        invoice_quarantine(src["invoices"], mode=mode),
        agent_quarantine(src["agents"]),
        request_quarantine(src["requests"], src["answers"], request_amounts(src), mode),
        person_quarantine(src["persons"], as_of, mode),
    ])


def all_tables(src: Sources, as_of: str | None = None) -> dict[str, DataFrame]:
    """Every target table of the plan."""
    return {**kpi_tables(src), **dimension_tables(src), "qualite_anomalies": quarantine_table(src, as_of)}


TABLE_KEYS: dict[str, tuple[str, ...]] = {
    **{n: k for n, (k, _, _) in {**SERVICE_TABLES, **INVOICE_TABLES, **FACT_TABLES}.items()},
    "kpi_ententes_prealables_jour": REQUEST_KEYS,
    "kpi_ententes_prealables_agent_jour": AGENT_KEYS,
    **{n: k for n, (_, _, k) in {**DIMENSIONS, **FACTS}.items()},
    "qualite_anomalies": ("domaine", "cle_metier", "motif_anomalie"),
}
