"""Read-time views over the daily, dimension, fact and quarantine tables.

``views`` takes a mapping of table name to DataFrame (freshly planned, read from files, or read
from the streaming tables) and returns the derived views by name; ``register`` makes all of them
temp views, so that they can be queried with SQL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import scalars as S
from dayledger.operators import daily, enrich, quality, ranking, reshape, rollup

Tables = Mapping[str, DataFrame]

# JSON keys and types of the raw row, per quarantine domain.
DETAIL_FIELDS: dict[str, dict[str, str]] = {
    "prestation": {
        "facture_numero": "string", "prestation_code": "string", "professionnel_sante_code": "string",
        "centre_sante_code": "string", "jour_soins": "date", "montant_depense": "decimal(18,2)",
        "montant_rq": "decimal(18,2)", "montant_assure": "decimal(18,2)", "quantite_prescrite": "decimal(18,2)",
        "quantite_servie": "decimal(18,2)", "taux_remboursement": "decimal(18,2)", "type_facture_code": "string",
        "regime_code": "string", "personne_uuid": "string"},
    "facture": {
        "facture_numero": "string", "type_facture_code": "string", "regime_code": "string",
        "centre_sante_code": "string", "centre_sante_type_code": "string", "centre_sante_type_libelle": "string",
        "jour_soins": "date", "date_creation_facture": "timestamp_ntz", "facture_date_soins_brute": "string",
        "personne_uuid": "string"},
    "agent": {
        "agent_code": "string", "agent_nom": "string", "agent_prenoms": "string", "agent_email": "string",
        "agent_type_code": "string"},
    "assure": {
        "personne_uuid": "string", "assure_numero_identifiant": "string", "numero_secu": "string",
        "assure_nom": "string", "assure_prenoms": "string", "assure_date_naissance": "date"},
    "entente_prealable": {
        "entente_prealable_id": "string", "type_demande_code": "string", "date_debut": "timestamp",
        "statut_code": "string", "agent_code": "string", "montant_engage_cmu": "decimal(18,2)"},
}

# Report lines and the codes each counts.
CONSULTATION_ACTS = ("CONS-GEN", "CONS-SPE")
REPORT_TYPES = {
    "Nombre de prescriptions (Pharmacie)": "PHA", "Nombre d'examen de labo-imagerie": "BIO",
    "Nombre de soins dentaires": "DEN", "Nombre d'hospitalisation": "HOS",
}

# Which tables and views each audience may read. Masked views are public; line-level facts, the
# unmasked clinical detail and the raw quarantine are for data governance alone.
PUBLIC = (
    "kpi_prestations_jour", "kpi_prestations_centre_jour", "kpi_prestations_praticien_jour", "kpi_factures_jour",
    "kpi_prestations_assure_jour", "kpi_ententes_prealables_jour", "kpi_ententes_prealables_agent_jour",
    "dim_centres_sante", "dim_professionnels_sante", "dim_collectivites", "dim_agents", "dim_medicaments", "dim_dci",
    "dim_pathologies", "v_top10_assures", "v_top10_assures_par_centre", "v_kpi_ententes_prealables_mois",
    "v_kpi_ep_agent_medecin_conseil", "v_centres_sante_geo", "v_professionnels_sante", "v_kpi_prescriptions_jour",
    "v_top10_medicaments", "v_top10_pathologies", "v_kpi_ep_prescriptions", "v_kpi_ep_medicaments",
    "v_kpi_ep_pathologies", "v_qualite_anomalies", "v_rapport_actes", "v_synthese", "v_top_centres_sante_nomme",
    "v_top_praticiens_nomme", "v_centres_sante_carte",
)
NOMINATIVE = (
    "qualite_anomalies", "kpi_prescriptions_medicament_jour", "kpi_pathologies_jour", "fait_prescriptions",
    "fait_pathologies", "fait_entente_facture", "fait_entente_statut", "v_ep_clinique_detail",
    "v_anomalies_prestation", "v_anomalies_facture", "v_anomalies_agent", "v_anomalies_assure",
    "v_anomalies_entente_prealable",
)
GRANTS = {"public": PUBLIC, "nominative": NOMINATIVE}
MASKED = ("v_kpi_prescriptions_jour", "v_top10_medicaments", "v_top10_pathologies", "v_kpi_ep_prescriptions",
          "v_kpi_ep_medicaments", "v_kpi_ep_pathologies")


def centres_geo(t: Tables) -> DataFrame:
    return t["dim_centres_sante"].join(t["dim_collectivites"], "collectivite_code", "left").select(
        "centre_sante_code", "centre_sante_denomination", "type_etablissement_sanitaire_code",
        "collectivite_denomination", "collectivite_latitude", "collectivite_longitude")


def practitioners(t: Tables) -> DataFrame:
    return t["dim_professionnels_sante"].select(
        "professionnel_sante_code", "nom", "prenoms", S.full_name("nom", "prenoms").alias("nom_complet"), "type_code",
        "statut")


def clinical_detail(t: Tables) -> DataFrame:
    """One row per request with the clinical counts of its invoice; both facts shrink before the join."""
    presc = daily.items_per_header(t["fait_prescriptions"], "facture_numero", "prescription_code",
                                   "nombre_prescriptions", "nombre_medicaments_distincts")
    patho = daily.counts_by(t["fait_pathologies"], ["facture_numero"], "nombre_pathologies")
    joined = (t["fait_entente_facture"].join(t["fait_entente_statut"], "entente_prealable_id", "left")
              .join(presc, "facture_numero", "left").join(patho, "facture_numero", "left"))
    zero = F.lit(0).cast("bigint")
    counts = ("nombre_prescriptions", "nombre_medicaments_distincts", "nombre_pathologies")
    return joined.select(
        "entente_prealable_id", "facture_numero", S.or_unknown("type_demande_code").alias("type_demande_code"),
        S.or_unknown("statut_code", S.UNANSWERED).alias("statut_code"), *[F.coalesce(c, zero).alias(c) for c in counts])


def anomaly_detail(t: Tables, domain: str) -> DataFrame:
    rows = t["qualite_anomalies"].where(F.col("domaine") == domain)
    keep = [c for c in ("famille", "motif_anomalie", "cle_metier", "detecte_le") if c in rows.columns]
    return reshape.json_columns(rows, "donnee_brute", DETAIL_FIELDS[domain], keep)


def report_acts(t: Tables) -> DataFrame:
    n = "nombre_prestations"
    lines = {"Nombre de consultations": S.sum_where(n, S.member("prestation_code", CONSULTATION_ACTS))}
    lines |= {label: S.sum_where(n, F.col("type_facture_code") == code) for label, code in REPORT_TYPES.items()}
    lines["Montants"] = F.sum("montant_depense")
    return reshape.long_form(t["kpi_prestations_jour"], "jour", lines)


def months_closed(t: Tables, as_of: str | None) -> DataFrame:
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    closed = t["kpi_ententes_prealables_jour"].where(S.closed_months("jour", day))
    return rollup.additive(
        closed, [S.month_start("jour").alias("mois"), "statut_code"], {"nombre_ententes": "nombre_ententes"},
        {"montant_engage_cmu": "montant_engage_cmu"},
        [S.weighted_mean("delai_moyen_heures", "nombre_ententes").alias("delai_moyen_heures")])


def summary(t: Tables, as_of: str | None) -> DataFrame:
    """The ten headline indicators: six figures, three break-downs and the closed months."""
    services, asked = t["kpi_prestations_jour"], t["kpi_ententes_prealables_jour"]
    answered = F.when(F.col("statut_code") != S.UNANSWERED, F.col("nombre_ententes")).otherwise(0)
    figures = services.agg(F.sum("nombre_prestations").alias("n"), F.sum("montant_depense").alias("depense"))
    requests = asked.agg(F.sum("nombre_ententes").alias("n"), S.percent(F.sum(answered), F.sum("nombre_ententes")).alias("taux"),
                         F.sum("montant_engage_cmu").alias("engage"))
    months = months_closed(t, as_of).groupBy("mois").agg(F.sum("nombre_ententes").alias("n"))
    return reshape.board([
        ("Nombre de prestations", figures, None, "n"),
        ("Nombre de factures", t["kpi_factures_jour"].agg(F.sum("nombre_factures").alias("n")), None, "n"),
        ("Montant total facture", figures, None, "depense"), ("Nombre d'ententes prealables", requests, None, "n"),
        ("Taux de reponse", requests, None, "taux"), ("Montant engage", requests, None, "engage"),
        ("Prestations par acte", services.groupBy("prestation_code").agg(F.sum("nombre_prestations").alias("n")), "prestation_code", "n"),
        ("Ententes par statut", asked.groupBy("statut_code").agg(F.sum("nombre_ententes").alias("n")), "statut_code", "n"),
        ("Montant pris en charge par type de facture",
         services.groupBy("type_facture_code").agg(F.sum("montant_pris_en_charge").alias("m")), "type_facture_code", "m"),
        ("Ententes par mois clos", months, "mois", "n")])


def _top_masked(daily_table: DataFrame, code: str, count: str, dim: DataFrame, name: str, default: str) -> DataFrame:
    per_code = rollup.suppress_small_groups(rollup.additive(daily_table, [code], {count: count}), count)
    best = ranking.top_n_strict(per_code, count, code, 10)
    named = enrich.left_dimension(best, dim.select(code, name), code, {name: default})
    return named.select(code, name, count).orderBy(F.desc(count), code)


def _named(daily_table: DataFrame, key: str, names: DataFrame) -> DataFrame:
    return daily_table.join(names, key, "left")


def views(t: Tables, as_of: str | None = None) -> dict[str, DataFrame]:
    sums = ({"nombre_prestations": "nombre_prestations"}, {"montant_depense": "montant_depense"})
    persons = t["kpi_prestations_assure_jour"]
    detail = clinical_detail(t)
    by_type_status = ["type_demande_code", "statut_code"]
    geo = centres_geo(t)
    located = geo.where("collectivite_latitude is not null and collectivite_longitude is not null")
    per_centre = rollup.additive(t["kpi_prestations_centre_jour"], ["centre_sante_code"], *sums)
    per_day = t["kpi_prescriptions_medicament_jour"].groupBy("jour").agg(
        F.sum("nombre_prescriptions").cast("bigint").alias("nombre_prescriptions"),
        F.count("medicament_code").alias("medicaments_distincts"))
    pathologies = rollup.suppress_small_groups(enrich.count_pairs(
        detail, t["fait_pathologies"], "facture_numero", "statut_code", "pathologie_code", "nombre_pathologies"),
        "nombre_pathologies")
    out = {
        "v_top10_assures": ranking.top_n_with_ties(
            rollup.additive(persons, ["personne_uuid"], *sums), "nombre_prestations", 10),
        "v_top10_assures_par_centre": ranking.top_n_with_ties(
            rollup.additive(persons, ["centre_sante_code", "personne_uuid"], *sums), "nombre_prestations", 10,
            by=["centre_sante_code"]),
        "v_kpi_ententes_prealables_mois": months_closed(t, as_of),
        "v_centres_sante_geo": geo,
        "v_professionnels_sante": practitioners(t),
        "v_kpi_ep_agent_medecin_conseil": t["kpi_ententes_prealables_agent_jour"].join(
            t["dim_agents"].where("agent_type_code = 'medecin_conseil'").select(
                "agent_code", S.full_name("agent_nom", "agent_prenoms").alias("agent_nom_complet")), "agent_code"
        ).select("jour", "agent_code", "agent_nom_complet", "statut_code", "nombre_ententes"),
        "v_ep_clinique_detail": detail,
        "v_kpi_prescriptions_jour": rollup.suppress_small_groups(per_day, "nombre_prescriptions"),
        "v_top10_medicaments": _top_masked(
            t["kpi_prescriptions_medicament_jour"], "medicament_code", "nombre_prescriptions", t["dim_medicaments"],
            "medicament_denomination", S.UNKNOWN),
        "v_top10_pathologies": _top_masked(
            t["kpi_pathologies_jour"], "pathologie_code", "nombre_pathologies", t["dim_pathologies"],
            "pathologie_denomination", S.UNKNOWN_FEMININE),
        "v_kpi_ep_prescriptions": rollup.suppress_small_groups(rollup.group_rate(
            detail, by_type_status, F.col("nombre_prescriptions") > 0, "nombre_ententes", "ententes_avec_prescription",
            "taux_avec_prescription"), "nombre_ententes"),
        "v_kpi_ep_medicaments": rollup.suppress_small_groups(rollup.group_mean(
            detail, by_type_status, "nombre_prescriptions", "nombre_ententes", "nombre_medicaments_prescrits",
            "medicaments_par_entente"), "nombre_ententes"),
        "v_kpi_ep_pathologies": enrich.left_dimension(
            pathologies, t["dim_pathologies"], "pathologie_code", {"pathologie_denomination": S.UNKNOWN_FEMININE}
        ).select("statut_code", "pathologie_code", "pathologie_denomination", "nombre_pathologies"),
        "v_qualite_anomalies": quality.without_raw_row(t["qualite_anomalies"]),
        "v_rapport_actes": report_acts(t),
        "v_synthese": summary(t, as_of),
        "v_top_centres_sante_nomme": _named(
            t["kpi_prestations_centre_jour"], "centre_sante_code",
            t["dim_centres_sante"].select("centre_sante_code", "centre_sante_denomination")),
        "v_top_praticiens_nomme": _named(
            t["kpi_prestations_praticien_jour"], "professionnel_sante_code",
            practitioners(t).select("professionnel_sante_code", "nom_complet")),
        "v_centres_sante_carte": located.join(per_centre, "centre_sante_code").select(
            "centre_sante_code", "centre_sante_denomination", "collectivite_denomination", "collectivite_latitude",
            "collectivite_longitude", "nombre_prestations", "montant_depense"),
    }
    for domain in DETAIL_FIELDS:
        out[f"v_anomalies_{domain}"] = anomaly_detail(t, domain)
    return out


def register(spark: SparkSession, t: Tables, as_of: str | None = None, audience: str | None = None) -> list[str]:
    """Temp views for every table and view, or for those one audience may read."""
    everything = {**t, **views(t, as_of)}
    names = [n for n in everything if audience is None or n in GRANTS[audience]]
    for name in names:
        everything[name].createOrReplaceTempView(name)
    return names
