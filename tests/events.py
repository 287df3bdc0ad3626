"""Hand-made change events in the shape of the captured tables."""

from __future__ import annotations

import json
import os

from dayledger.sources.specs import SPECS


class Log:
    """Collects envelopes with rising positions, keeping the current rows to fill before-images."""

    def __init__(self) -> None:
        self.lsn = 0
        self.rows: dict[tuple, dict] = {}
        self.lines: list[tuple[str, str]] = []

    def _emit(self, name: str, op: str, before, after) -> None:
        self.lsn += 1
        body = {"before": before, "after": after, "op": op, "ts_ms": 1_700_000_000_000 + self.lsn,
                "source": {"ts_ms": 1_700_000_000_000 + self.lsn, "lsn": self.lsn, "table": SPECS[name].table}}
        self.lines.append((SPECS[name].table, json.dumps(body, ensure_ascii=False)))

    def _key(self, name: str, row: dict) -> tuple:
        return (name, *(row[k] for k in SPECS[name].keys))

    def put(self, name: str, **row) -> None:
        full = {c: row.get(c) for c in SPECS[name].columns}
        key = self._key(name, full)
        before = self.rows.get(key)
        self.rows[key] = full
        self._emit(name, "c" if before is None else "u", before, full)

    def drop(self, name: str, **key) -> None:
        before = self.rows.pop(self._key(name, key))
        self._emit(name, "d", before, None)

    def resend(self, index: int) -> None:
        self.lines.append(self.lines[index])

    def take(self) -> list[tuple[str, str]]:
        lines, self.lines = self.lines, []
        return lines


def write(lines: list[tuple[str, str]], root: str, label: str) -> None:
    """JSON-lines files under root/topic=<table>/."""
    by_topic: dict[str, list[str]] = {}
    for topic, line in lines:
        by_topic.setdefault(topic, []).append(line)
    for topic, body in by_topic.items():
        os.makedirs(f"{root}/topic={topic}", exist_ok=True)
        with open(f"{root}/topic={topic}/{label}.json", "w", encoding="utf-8") as f:
            f.write("\n".join(body) + "\n")


def day(text: str) -> int:
    import datetime as dt
    return (dt.date.fromisoformat(text) - dt.date(1970, 1, 1)).days


def invoice(log: Log, number: str, care: str | None = "2026-09-01", **kw) -> None:
    log.put("invoices", **{
        "FACTURE_NUMERO": number, "TYPE_FACTURE_CODE": "AMB", "REGIME_CODE": "RGB", "CENTRE_SANTE_CODE": "C1",
        "CENTRE_SANTE_TYPE_CODE": "CHU", "CENTRE_SANTE_TYPE_LIBELLE": "Hopital", "PERSONNE_UUID": "p1",
        "FACTURE_DATE_SOINS": None if care is None else day(care), "DATE_CREATION": "2026-09-02T10:00:00.123456Z", **kw})


def service(log: Log, number: str, code: str = "CONS-GEN", **kw) -> None:
    log.put("services", **{
        "FACTURE_NUMERO": number, "PRESTATION_CODE": code, "PROFESSIONNEL_SANTE_CODE": "D1",
        "PRESTATION_MONTANT_DEPENSE": 10000.0, "PRESTATION_MONTANT_RQ": 7000.0, "PRESTATION_MONTANT_ASSURE": 3000.0,
        "PRESTATION_QUANTITE_PRESCRITE": 1.0, "PRESTATION_QUANTITE_SERVIE": 1.0, "PRESTATION_TAUX_REMBOURSEMENT": 70.0, **kw})


def request(log: Log, ident: int, begin: str = "2026-09-01T08:00:00.000000Z", **kw) -> None:
    log.put("requests", **{"ENTENTE_PREALABLE_ID": ident, "FACTURE_NUMERO": f"F{ident}", "TYPE_DEMANDE_CODE": "HOSP",
                           "ENTENTE_PREALABLE_DATE_DEBUT": begin, **kw})


def answer(log: Log, ident: int, at: str = "2026-09-01T11:30:00.000000Z", **kw) -> None:
    log.put("answers", **{"ENTENTE_PREALABLE_ID": ident, "STATUT_CODE": "acceptee", "STATUT_DATE_DEBUT": at,
                          "AGENT_CODE": "A1", **kw})


def first_batch(log: Log) -> None:
    """A bit of everything, edge rows included."""
    for i in range(1, 9):
        invoice(log, f"F{i}", f"2026-09-0{1 + i % 3}", PERSONNE_UUID=f"p{i % 4}", CENTRE_SANTE_CODE=f"C{i % 2}")
        service(log, f"F{i}")
        service(log, f"F{i}", "BIO-NFS", PRESTATION_MONTANT_DEPENSE=2000.5, PRESTATION_MONTANT_RQ=1000.5,
                PRESTATION_MONTANT_ASSURE=1000.0)
    invoice(log, "F20", None)
    service(log, "F20")
    service(log, "F1", "SOI-PAN", PRESTATION_MONTANT_DEPENSE=None)
    service(log, "F2", "XXX")
    invoice(log, "F21", "2026-09-01", TYPE_FACTURE_CODE=None, REGIME_CODE=None, PERSONNE_UUID=None, CENTRE_SANTE_TYPE_CODE=None)
    service(log, "F21", "URG-ACC", PRESTATION_QUANTITE_SERVIE=0.0)
    for i in range(1, 7):
        request(log, i, TYPE_DEMANDE_CODE=None if i == 6 else "HOSP")
        if i < 5:
            answer(log, i, STATUT_CODE="refusee" if i == 4 else "acceptee", AGENT_CODE=None if i == 3 else "A1")
        log.put("acts", ENTENTE_PREALABLE_ID=i, ACTE_MEDICAL_CODE="X", ACTE_MEDICAL_MONTANT_CMU=-5.0 if i == 5 else 100.25 * i)
        log.put("prescriptions", FACTURE_NUMERO=f"F{i}", PRESCRIPTION_CODE="M1", DATE_DEBUT=day("2026-09-01"))
        log.put("prescriptions", FACTURE_NUMERO=f"F{i}", PRESCRIPTION_CODE=f"M{i}x", DATE_DEBUT=day("2026-09-02"))
        log.put("pathologies", FACTURE_NUMERO=f"F{i}", PATHOLOGIE_CODE="P1", PATHOLOGIE_DATE_DEBUT=day("2026-09-01"))
    for i in range(2):
        log.put("centres", CENTRE_SANTE_CODE=f"C{i}", COLLECTIVITE_CODE="L1" if i else None,
                TYPE_ETABLISSEMENT_SANITAIRE_CODE="CHU", CENTRE_SANTE_DENOMINATION=f"Centre {i}")
    log.put("localities", COLLECTIVITE_CODE="L1", COLLECTIVITE_DENOMINATION="Ville", COLLECTIVITE_LATITUDE=5.35, COLLECTIVITE_LONGITUDE=-4.0)
    log.put("practitioners", PROFESSIONNEL_SANTE_CODE="D1", NOM="Nom", PRENOMS="Pre", TYPE_CODE="G", STATUT="actif")
    log.put("agents", AGENT_CODE="A1", AGENT_NOM="Ann", AGENT_PRENOMS="Lee", AGENT_EMAIL="ann@x.ci", AGENT_TYPE_CODE="medecin_conseil")
    log.put("agents", AGENT_CODE="A2", AGENT_NOM="Bob", AGENT_PRENOMS="Kay", AGENT_EMAIL="bob@x", AGENT_TYPE_CODE="accueil")
    log.put("persons", PERSONNE_UUID="p1", ASSURE_NUMERO_IDENTIFIANT="1", NUMERO_SECU="3940000000001", ASSURE_NOM="",
            ASSURE_PRENOMS="A", ASSURE_DATE_NAISSANCE=day("1980-01-01"))
    log.put("persons", PERSONNE_UUID="p2", ASSURE_NUMERO_IDENTIFIANT="2", NUMERO_SECU="3940000000002", ASSURE_NOM="Ok",
            ASSURE_PRENOMS="B", ASSURE_DATE_NAISSANCE=day("1980-01-01"))
    log.put("medicines", MEDICAMENT_CODE="M1", MEDICAMENT_DENOMINATION="Med", DCI_CODE="D1")
    log.put("substances", DCI_CODE="D1", DCI_DENOMINATION="Sub")
    log.put("pathology_names", PATHOLOGIE_CODE="P1", PATHOLOGIE_DENOMINATION="Patho")


def second_batch(log: Log) -> None:
    """Corrections: a moved day, an emptied day, a deleted line, a repaired row, a late answer."""
    invoice(log, "F1", "2026-08-15", PERSONNE_UUID="p1", CENTRE_SANTE_CODE="C1")
    log.drop("services", FACTURE_NUMERO="F2", PRESTATION_CODE="BIO-NFS")
    service(log, "F2", "XXX", PRESTATION_MONTANT_DEPENSE=12000.0, PRESTATION_MONTANT_RQ=12000.0, PRESTATION_MONTANT_ASSURE=0.0)
    service(log, "F1", "SOI-PAN")
    for i in (3, 6):
        invoice(log, f"F{i}", "2026-09-02", PERSONNE_UUID=f"p{i % 4}", CENTRE_SANTE_CODE=f"C{i % 2}")
    invoice(log, "F20", "2026-09-03")
    answer(log, 5, "2026-09-01T06:30:00.000000Z")
    answer(log, 1, "2026-09-02T06:30:00.000000Z", STATUT_CODE="refusee")
    log.put("acts", ENTENTE_PREALABLE_ID=5, ACTE_MEDICAL_CODE="X", ACTE_MEDICAL_MONTANT_CMU=50.0)
    log.drop("prescriptions", FACTURE_NUMERO="F2", PRESCRIPTION_CODE="M2x", DATE_DEBUT=day("2026-09-02"))
    log.put("agents", AGENT_CODE="A2", AGENT_NOM="Bob", AGENT_PRENOMS="Kay", AGENT_EMAIL="bob@x.ci", AGENT_TYPE_CODE="accueil")
    log.drop("centres", CENTRE_SANTE_CODE="C0")
    log.put("persons", PERSONNE_UUID="p2", ASSURE_NUMERO_IDENTIFIANT="2", NUMERO_SECU="384", ASSURE_NOM="Ok",
            ASSURE_PRENOMS="B", ASSURE_DATE_NAISSANCE=day("1980-01-01"))
