"""Boundary rows of every rule, and the claims plan on small sources."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import events as ev
from dayledger.plans import claims, read_model
from dayledger.sources.specs import SPECS

AS_OF = "2026-09-30"


def source(spark, name, rows):
    spec = SPECS[name]
    data = [tuple(r.get(c) for c in spec.columns) for r in rows]
    return spec.with_derived(spark.createDataFrame(data, spec.schema))


def reasons(df):
    return {r["cle_metier"]: r["motif_anomalie"] for r in df.collect()}


LINE = {
    "PRESTATION_CODE": "CONS-GEN", "PRESTATION_MONTANT_DEPENSE": 10000.0, "PRESTATION_MONTANT_RQ": 7000.0,
    "PRESTATION_MONTANT_ASSURE": 3000.0, "PRESTATION_QUANTITE_PRESCRITE": 1.0, "PRESTATION_QUANTITE_SERVIE": 1.0,
    "PRESTATION_TAUX_REMBOURSEMENT": 70.0,
}


def amount(v):
    return {"PRESTATION_MONTANT_DEPENSE": v, "PRESTATION_MONTANT_RQ": v, "PRESTATION_MONTANT_ASSURE": None}


def quantity(prescribed, served):
    return {"PRESTATION_QUANTITE_PRESCRITE": prescribed, "PRESTATION_QUANTITE_SERVIE": served}


CASES = {
    "fine": ({}, None), "no_amount": (amount(None), "montant_depense_manquant"), "minus": (amount(-1.0), "MONTANT_ABERRANT"),
    "zero": (amount(0.0), None), "max": (amount(500000.0), None), "over": (amount(500000.01), "MONTANT_ABERRANT"),
    "q00": (quantity(0.0, 0.0), None), "q10": (quantity(1.0, 0.0), "QUANTITE_NULLE"), "qn0": (quantity(None, 0.0), None),
    "q12": (quantity(1.0, 2.0), "QUANTITE_EXCESSIVE"), "qn2": (quantity(None, 2.0), None),
    "rate_low": ({"PRESTATION_TAUX_REMBOURSEMENT": -0.01}, "MONTANT_HORS_BAREME"),
    "rate_0": ({"PRESTATION_TAUX_REMBOURSEMENT": 0.0}, None), "rate_100": ({"PRESTATION_TAUX_REMBOURSEMENT": 100.0}, None),
    "rate_high": ({"PRESTATION_TAUX_REMBOURSEMENT": 100.01}, "MONTANT_HORS_BAREME"),
    "rate_null": ({"PRESTATION_TAUX_REMBOURSEMENT": None}, None),
    "split_1": ({"PRESTATION_MONTANT_RQ": 7001.0}, None), "split_2": ({"PRESTATION_MONTANT_RQ": 7001.01}, "REPARTITION_FAUSSEE"),
    "act": ({"PRESTATION_CODE": "XXX"}, "PRESTATION_ORPHELINE"),
    "two": ({**amount(-1.0), "PRESTATION_CODE": "XXX"}, "MONTANT_ABERRANT"),
}


def test_service_rules(spark):
    lines = [{**LINE, "FACTURE_NUMERO": k, **change} for k, (change, _) in CASES.items()]
    heads = [{"FACTURE_NUMERO": k, "FACTURE_DATE_SOINS": 20000} for k in CASES] + [{"FACTURE_NUMERO": "undated"}]
    lines.append({**LINE, "FACTURE_NUMERO": "undated"})
    src = {"services": source(spark, "services", lines), "invoices": source(spark, "invoices", heads)}
    found = claims.service_quarantine(claims.raw_services(src))
    got = {k.split("/")[0]: v for k, v in reasons(found).items()}
    assert got == {**{k: v for k, (_, v) in CASES.items() if v}, "undated": "date_soins_manquante"}
    raw = json.loads(found.where("cle_metier = 'no_amount/CONS-GEN'").first()["donnee_brute"])
    assert raw["montant_depense"] is None and raw["jour_soins"] == "2024-10-04"
    detail = read_model.anomaly_detail({"qualite_anomalies": found}, "prestation")
    assert detail.where("facture_numero = 'over'").first()["montant_depense"] == Decimal("500000.01")


def test_invoice_rules(spark):
    made = "2026-09-10T12:00:00.000000Z"
    def head(number, care, **kw):
        return {"FACTURE_NUMERO": number, "FACTURE_DATE_SOINS": care and ev.day(care), "DATE_CREATION": made, "CENTRE_SANTE_TYPE_CODE": "CHU", **kw}
    rows = [head("d60", "2026-07-12"), head("d61", "2026-07-11"), head("same", "2026-09-10"), head("next", "2026-09-11"),
            head("type", "2026-09-10", CENTRE_SANTE_TYPE_CODE="?"), head("null", "2026-09-10", CENTRE_SANTE_TYPE_CODE=None),
            head("undated", None), head("unmade", "2026-09-11", DATE_CREATION=None)]
    invoices = source(spark, "invoices", rows)
    assert reasons(claims.invoice_quarantine(invoices)) == {
        "d61": "DATE_ANTIDATEE", "next": "DATE_SOINS_FUTURE", "type": "TYPE_CENTRE_INCONNU"}
    assert reasons(claims.undated_invoices(invoices)) == {"undated": "date_soins_manquante"}


def test_agent_rule(spark):
    rows = [{"AGENT_CODE": m, "AGENT_EMAIL": m} for m in ("a@b", "a.b@c", "a@b.c")]
    assert set(reasons(claims.agent_quarantine(source(spark, "agents", rows)))) == {"a@b", "a.b@c"}


def test_person_rules(spark):
    good = "3940000000001"
    born = {"in": "1980-01-01", "today": AS_OF, "tomorrow": "2026-10-01", "hundred": "1926-09-30", "older": "1926-09-29"}
    rows = {
        "ok": ("Ok", good, "in"), "empty": ("", good, "in"), "mark": ("a?", good, "in"), "moji": ("JosÃ©", good, "in"),
        "id12": ("Ok", good[:12], "in"), "id14": ("Ok", good + "0", "in"), "id384": ("Ok", "384" + good[3:], "in"),
        **{b: ("Ok", good, b) for b in ("today", "tomorrow", "hundred", "older")}, "two": ("", "1", "in"),
        **{f"inj{i}": (p, good, "in") for i, p in enumerate(claims.INJECTION_PAYLOADS)}}
    persons = source(spark, "persons", [
        {"PERSONNE_UUID": k, "ASSURE_NOM": n, "NUMERO_SECU": s, "ASSURE_DATE_NAISSANCE": ev.day(born[b])} for k, (n, s, b) in rows.items()])
    assert reasons(claims.person_quarantine(persons, AS_OF)) == {
        "empty": "CHAMP_OBLIGATOIRE_VIDE", "mark": "ENCODAGE_CASSE", "moji": "ENCODAGE_CASSE", "two": "CHAMP_OBLIGATOIRE_VIDE",
        **{k: "NUMERO_SECU_INVALIDE" for k in ("id12", "id14", "id384")},
        **{k: "DATE_NAISSANCE_ABERRANTE" for k in ("tomorrow", "older")},
        **{f"inj{i}": "TENTATIVE_INJECTION" for i in range(6)}}


def test_every_reason_has_its_family(spark):
    from dayledger.operators.quality import family_of
    rules = claims.service_rules() + claims.invoice_rules() + claims.person_rules(AS_OF)
    df = spark.createDataFrame([(r.reason, r.family) for r in rules], "motif string, family string")
    assert df.where(family_of("motif", claims.FAMILIES, F.lit("?")) != F.col("family")).count() == 0


@pytest.fixture(scope="module")
def requests(spark):
    asked = [{"ENTENTE_PREALABLE_ID": i, "TYPE_DEMANDE_CODE": None if i == 4 else "HOSP", "FACTURE_NUMERO": f"F{i}",
              "ENTENTE_PREALABLE_DATE_DEBUT": None if i == 6 else "2026-09-01T10:00:00.000000Z"} for i in range(1, 7)]
    answered = [
        {"ENTENTE_PREALABLE_ID": 1, "STATUT_CODE": "acceptee", "STATUT_DATE_DEBUT": "2026-09-01T12:59:59.000Z", "AGENT_CODE": "A1"},
        {"ENTENTE_PREALABLE_ID": 2, "STATUT_CODE": "acceptee", "STATUT_DATE_DEBUT": "2026-09-01T08:30:00.000Z", "AGENT_CODE": None}]
    acts = [{"ENTENTE_PREALABLE_ID": 1, "ACTE_MEDICAL_CODE": c, "ACTE_MEDICAL_MONTANT_CMU": 10.25} for c in "XY"]
    acts.append({"ENTENTE_PREALABLE_ID": 5, "ACTE_MEDICAL_CODE": "X", "ACTE_MEDICAL_MONTANT_CMU": -1.0})
    return {"requests": source(spark, "requests", asked), "answers": source(spark, "answers", answered), "acts": source(spark, "acts", acts)}


def test_requests_day(requests):
    rows = {(r.statut_code, r.type_demande_code): r for r in _ep(requests)["kpi_ententes_prealables_jour"].collect()}
    got = rows["acceptee", "HOSP"]
    # Delays 2 h and -1 h (truncated toward zero).
    assert (got.nombre_ententes, got.delai_moyen_heures, got.montant_engage_cmu) == (2, Decimal("0.50"), Decimal("20.50"))
    waiting = rows["sans_reponse", "HOSP"]
    assert (waiting.nombre_ententes, waiting.delai_moyen_heures, waiting.montant_engage_cmu) == (2, None, Decimal("-1.00"))
    assert rows["sans_reponse", "(inconnu)"].nombre_ententes == 1
    agents = _ep(requests)["kpi_ententes_prealables_agent_jour"].collect()
    assert [(r.agent_code, r.nombre_ententes) for r in agents] == [("A1", 1)]


def _ep(src):
    asked = claims.enriched_requests(src)
    empty = {n: None for n in ()}
    spark = asked.sparkSession
    full = {**{n: spark.createDataFrame([], s.schema).transform(s.with_derived) for n, s in SPECS.items()}, **src, **empty}
    return claims.kpi_tables(full, requests=asked)


def test_request_rules(requests):
    found = claims.request_quarantine(requests["requests"], requests["answers"], claims.request_amounts(requests))
    assert reasons(found) == {"4": "type_demande_manquant", "5": "montant_engage_negatif"}


def test_unknown_members_and_missing_amounts(spark):
    heads = [{"FACTURE_NUMERO": "F1", "FACTURE_DATE_SOINS": 20000}, {"FACTURE_NUMERO": "F2"}]
    lines = [{"FACTURE_NUMERO": "F1", "PRESTATION_CODE": "A", "PRESTATION_MONTANT_DEPENSE": 0.1},
             {"FACTURE_NUMERO": "F1", "PRESTATION_CODE": "B"}, {"FACTURE_NUMERO": "F2", "PRESTATION_CODE": "A"},
             {"FACTURE_NUMERO": "lost", "PRESTATION_CODE": "A"}]
    rows = claims.enriched_services({"services": source(spark, "services", lines), "invoices": source(spark, "invoices", heads)}).collect()
    assert {(r.prestation_code, r.regime_code, r.personne_uuid, r.montant_depense, r.jour) for r in rows} == {
        ("A", "(inconnu)", "(inconnu)", Decimal("0.10"), dt.date(2024, 10, 4)),
        ("B", "(inconnu)", "(inconnu)", Decimal("0.00"), dt.date(2024, 10, 4))}


def test_clinical_views_on_controlled_data(spark):
    """Three of each: 9 requests of which 6 with a prescription (66.7 %), one suppressed group."""
    ids = range(1, 10)
    t = {
        "fait_entente_facture": spark.createDataFrame(
            [(i, f"F{i}", "HOSP", dt.date(2026, 9, 1)) for i in ids] + [(i, f"F{i}", "AUTRE", dt.date(2026, 9, 1)) for i in range(20, 24)],
            "entente_prealable_id int, facture_numero string, type_demande_code string, date_debut date"),
        "fait_entente_statut": spark.createDataFrame([(i, "acceptee") for i in ids], "entente_prealable_id int, statut_code string"),
        "fait_prescriptions": spark.createDataFrame(
            [(f"F{i}", f"M{j}", dt.date(2026, 9, 1)) for i in range(1, 7) for j in range(1 + i % 2)],
            "facture_numero string, prescription_code string, date_debut date"),
        "fait_pathologies": spark.createDataFrame(
            [(f"F{i}", "P1", dt.date(2026, 9, d)) for i in range(1, 4) for d in (1, 2, 3)] + [(f"F{i}", "P2", dt.date(2026, 9, 1)) for i in ids if i < 5],
            "facture_numero string, pathologie_code string, date_debut date"),
        "dim_pathologies": spark.createDataFrame([("P1", "Palu")], "pathologie_code string, pathologie_denomination string"),
    }
    empties = {
        "kpi_prestations_jour": "jour date, prestation_code string, type_facture_code string, regime_code string, centre_sante_type_libelle string, nombre_prestations bigint, montant_depense decimal(18,2), montant_pris_en_charge decimal(18,2)",
        "kpi_factures_jour": "jour date, type_facture_code string, regime_code string, centre_sante_type_libelle string, nombre_factures bigint",
        "kpi_prestations_centre_jour": "jour date, centre_sante_code string, nombre_prestations bigint, montant_depense decimal(18,2)",
        "kpi_prestations_praticien_jour": "jour date, professionnel_sante_code string, nombre_prestations bigint, montant_depense decimal(18,2)",
        "kpi_prestations_assure_jour": "jour date, personne_uuid string, centre_sante_code string, nombre_prestations bigint, montant_depense decimal(18,2)",
        "kpi_ententes_prealables_jour": "jour date, statut_code string, type_demande_code string, nombre_ententes bigint, delai_moyen_heures decimal(10,2), montant_engage_cmu decimal(18,2)",
        "kpi_ententes_prealables_agent_jour": "jour date, agent_code string, statut_code string, nombre_ententes bigint",
        "kpi_prescriptions_medicament_jour": "jour date, medicament_code string, nombre_prescriptions bigint",
        "kpi_pathologies_jour": "jour date, pathologie_code string, nombre_pathologies bigint",
        "dim_centres_sante": "centre_sante_code string, centre_sante_denomination string, collectivite_code string, type_etablissement_sanitaire_code string",
        "dim_professionnels_sante": "professionnel_sante_code string, nom string, prenoms string, type_code string, statut string",
        "dim_collectivites": "collectivite_code string, collectivite_denomination string, collectivite_latitude decimal(9,6), collectivite_longitude decimal(9,6)",
        "dim_agents": "agent_code string, agent_nom string, agent_prenoms string, agent_type_code string",
        "dim_medicaments": "medicament_code string, medicament_denomination string, dci_code string",
        "qualite_anomalies": "domaine string, motif_anomalie string, famille string, cle_metier string, donnee_brute string",
    }
    t.update({n: spark.createDataFrame([], s) for n, s in empties.items()})
    v = read_model.views(t, AS_OF)
    got = [(r.type_demande_code, r.nombre_ententes, r.ententes_avec_prescription, r.taux_avec_prescription) for r in v["v_kpi_ep_prescriptions"].collect()]
    assert got == [("HOSP", 9, 6, Decimal("66.7"))]
    assert [r.nombre_medicaments_prescrits for r in v["v_kpi_ep_medicaments"].collect()] == [9]
    assert {(r.pathologie_denomination, r.nombre_pathologies) for r in v["v_kpi_ep_pathologies"].collect()} == {("Palu", 9)}
    assert set(read_model.MASKED) < set(v)
