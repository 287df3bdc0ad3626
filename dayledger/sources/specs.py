"""Declared schemas of the captured source tables.

Fixed values: table and column names, keys and types below are the wire format of the change
events and must match it exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from dayledger.functions import scalars as S


@dataclass(frozen=True)
class SourceSpec:
    """One captured table: wire schema, key columns and columns computed after decoding."""

    name: str
    table: str
    ddl: str
    keys: tuple[str, ...]
    derived: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def with_derived(self, df: DataFrame) -> DataFrame:
        kinds = {"epoch_day": S.days_to_date, "iso": S.iso_to_ts}
        cols: dict[str, Column] = {out: kinds[kind](src) for out, (kind, src) in self.derived.items()}
        return df.withColumns(cols) if cols else df


SPECS: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        SourceSpec(
            "services", "TB_FACTURES_PRESTATIONS",
            "FACTURE_NUMERO string, PRESTATION_CODE string, PROFESSIONNEL_SANTE_CODE string, "
            "PRESTATION_MONTANT_DEPENSE double, PRESTATION_MONTANT_RQ double, PRESTATION_MONTANT_ASSURE double, "
            "PRESTATION_QUANTITE_PRESCRITE double, PRESTATION_QUANTITE_SERVIE double, "
            "PRESTATION_TAUX_REMBOURSEMENT double",
            ("FACTURE_NUMERO", "PRESTATION_CODE"),
        ),
        SourceSpec(
            "invoices", "TB_FACTURES",
            "FACTURE_NUMERO string, TYPE_FACTURE_CODE string, REGIME_CODE string, CENTRE_SANTE_CODE string, "
            "CENTRE_SANTE_TYPE_CODE string, CENTRE_SANTE_TYPE_LIBELLE string, PERSONNE_UUID string, "
            "FACTURE_DATE_SOINS int, DATE_CREATION string",
            ("FACTURE_NUMERO",),
            {"jour_soins": ("epoch_day", "FACTURE_DATE_SOINS"), "date_creation_facture": ("iso", "DATE_CREATION")},
        ),
        SourceSpec(
            "requests", "TB_ENTENTES_PREALABLES",
            "ENTENTE_PREALABLE_ID int, FACTURE_NUMERO string, TYPE_DEMANDE_CODE string, "
            "ENTENTE_PREALABLE_DATE_DEBUT string",
            ("ENTENTE_PREALABLE_ID",),
            {"event_time": ("iso", "ENTENTE_PREALABLE_DATE_DEBUT")},
        ),
        SourceSpec(
            "answers", "TB_ENTENTES_PREALABLES_STATUTS",
            "ENTENTE_PREALABLE_ID int, STATUT_CODE string, STATUT_DATE_DEBUT string, AGENT_CODE string",
            ("ENTENTE_PREALABLE_ID",),
            {"event_time": ("iso", "STATUT_DATE_DEBUT")},
        ),
        SourceSpec(
            "acts", "TB_ENTENTES_PREALABLES_ACTES_MEDICAUX",
            "ENTENTE_PREALABLE_ID int, ACTE_MEDICAL_CODE string, ACTE_MEDICAL_MONTANT_CMU double",
            ("ENTENTE_PREALABLE_ID", "ACTE_MEDICAL_CODE"),
        ),
        SourceSpec(
            "centres", "TB_REF_CENTRES_SANTE",
            "CENTRE_SANTE_CODE string, COLLECTIVITE_CODE string, TYPE_ETABLISSEMENT_SANITAIRE_CODE string, "
            "CENTRE_SANTE_DENOMINATION string",
            ("CENTRE_SANTE_CODE",),
        ),
        SourceSpec(
            "practitioners", "TB_REF_PROFESSIONNELS_SANTE",
            "PROFESSIONNEL_SANTE_CODE string, NOM string, PRENOMS string, TYPE_CODE string, STATUT string",
            ("PROFESSIONNEL_SANTE_CODE",),
        ),
        SourceSpec(
            "localities", "TB_REF_COLLECTIVITES",
            "COLLECTIVITE_CODE string, COLLECTIVITE_DENOMINATION string, COLLECTIVITE_LATITUDE double, "
            "COLLECTIVITE_LONGITUDE double",
            ("COLLECTIVITE_CODE",),
        ),
        SourceSpec(
            "agents", "TB_REF_AGENTS",
            "AGENT_CODE string, AGENT_NOM string, AGENT_PRENOMS string, AGENT_EMAIL string, AGENT_TYPE_CODE string",
            ("AGENT_CODE",),
        ),
        SourceSpec(
            "persons", "TB_REF_ASSURES",
            "PERSONNE_UUID string, ASSURE_NUMERO_IDENTIFIANT string, NUMERO_SECU string, ASSURE_NOM string, "
            "ASSURE_PRENOMS string, ASSURE_DATE_NAISSANCE int",
            ("PERSONNE_UUID",),
            {"date_naissance": ("epoch_day", "ASSURE_DATE_NAISSANCE")},
        ),
        SourceSpec(
            "prescriptions", "TB_FACTURES_PRESCRIPTIONS",
            "FACTURE_NUMERO string, PRESCRIPTION_CODE string, DATE_DEBUT int",
            ("FACTURE_NUMERO", "PRESCRIPTION_CODE", "DATE_DEBUT"),
            {"jour_prescription": ("epoch_day", "DATE_DEBUT")},
        ),
        SourceSpec(
            "pathologies", "TB_FACTURES_PATHOLOGIES",
            "FACTURE_NUMERO string, PATHOLOGIE_CODE string, PATHOLOGIE_DATE_DEBUT int",
            ("FACTURE_NUMERO", "PATHOLOGIE_CODE", "PATHOLOGIE_DATE_DEBUT"),
            {"jour_pathologie": ("epoch_day", "PATHOLOGIE_DATE_DEBUT")},
        ),
        SourceSpec(
            "medicines", "TB_REF_MEDICAMENTS",
            "MEDICAMENT_CODE string, MEDICAMENT_DENOMINATION string, DCI_CODE string",
            ("MEDICAMENT_CODE",),
        ),
        SourceSpec(
            "substances", "TB_REF_DCI", "DCI_CODE string, DCI_DENOMINATION string", ("DCI_CODE",),
        ),
        SourceSpec(
            "pathology_names", "TB_REF_PATHOLOGIES",
            "PATHOLOGIE_CODE string, PATHOLOGIE_DENOMINATION string",
            ("PATHOLOGIE_CODE",),
        ),
    )
}

# First-prototype view of the service lines: same topic, other columns, read with a watermark.
SERVICES_BY_STATUS = SourceSpec(
    "services_by_status", "TB_FACTURES_PRESTATIONS",
    "FACTURE_NUMERO string, PRESTATION_CODE string, STATUT_REMBOURSEMENT string, MOTIF_REJET_CODE string, "
    "PRESTATION_MONTANT_DEPENSE double, DATE_CREATION string",
    ("FACTURE_NUMERO", "PRESTATION_CODE"),
    {"event_time": ("iso", "DATE_CREATION")},
)

# Captured but read by no KPI: only their names matter for the allow-list.
UNREAD_TABLES = ("TB_FACTURES_REJETS", "TB_FACTURES_STATUTS", "TB_ENTENTES_PREALABLES_PRESTATIONS")

CAPTURED_TABLES = tuple(s.table for s in SPECS.values()) + UNREAD_TABLES
