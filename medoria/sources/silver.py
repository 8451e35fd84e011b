"""The silver tables the star schema is built from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Role of a table in the builders, and its name in the silver zone.
SILVER_TABLES = {
    "consultations": "consultation_consultation",
    "diagnostic": "consultation_diagnostic",
    "patient": "consultation_patient",
    "deces": "deces_deces",
    "activite_professionel": "etablissement_sante_activite_professionnel_sante",
    "etablissement_sante": "etablissement_sante_etablissement_sante",
    "professionnel_sante": "etablissement_sante_professionnel_sante",
    "hospitalisation": "hospitalisation_hospitalisation",
    "region": "localisation_regions",
    "communes": "localisation_communes",
    "satisfaction_esatis": "satisfaction_esatis48h_2020",
    "satisfaction_esatisca": "satisfaction_esatisca_2020",
}

# The columns the builders use; other columns are ignored.
SILVER_COLUMNS = {
    "consultations": ("id_prof_sante", "id_patient", "date", "code_diag", "motif"),
    "diagnostic": ("code_diag", "diagnostic"),
    "patient": ("id_patient", "sexe", "date_naissance"),
    "deces": ("date_deces", "code_commune"),
    "activite_professionel": ("id_prof_sante", "id_etablissement"),
    "etablissement_sante": ("id_etablissement", "raison_sociale", "code_commune", "finess"),
    "professionnel_sante": ("id_prof_sante", "nom", "prenom", "civilite", "profession", "specialite"),
    "hospitalisation": ("id_patient", "id_etablissement", "code_diag", "date", "duree"),
    "region": ("code_region", "region", "iso"),
    "communes": ("code_commune", "code_region"),
    "satisfaction_esatis": (
        "finess", "score_all_rea_ajust", "nb_rep_score_all_rea_ajust", "taux_reco_brut",
    ),
    "satisfaction_esatisca": (
        "finess", "score_all_ajust", "nb_rep_score_all_ajust", "taux_reco_brut",
    ),
}


# Columns that are numbers, days or scores; all others are codes or words, and stay text.
_MEASURES = frozenset(
    "id_patient date date_naissance date_deces duree score_all_rea_ajust nb_rep_score_all_rea_ajust"
    " score_all_ajust nb_rep_score_all_ajust taux_reco_brut".split()
)
TEXT_COLUMNS = {
    SILVER_TABLES[role]: tuple(c for c in columns if c not in _MEASURES) for role, columns in SILVER_COLUMNS.items()
}


class MissingTables(LookupError):
    """Required silver tables, or columns of them, that are not there."""


def check_silver(tables: Mapping[str, DataFrame], required: Iterable[str] = SILVER_TABLES) -> None:
    """Raise one error that names everything missing."""
    missing = []
    for name in required:
        if name not in tables:
            missing.append(name)
        else:
            absent = set(SILVER_COLUMNS[name]) - set(tables[name].columns)
            missing += [f"{name}.{column}" for column in sorted(absent)]
    if missing:
        raise MissingTables("missing from silver: " + ", ".join(missing))


def load_silver(
    spark: SparkSession, root: str, required: Iterable[str] = SILVER_TABLES
) -> dict[str, DataFrame]:
    """All silver tables that can be read; an error if a required one cannot."""
    tables = {}
    for name, folder in SILVER_TABLES.items():
        try:
            tables[name] = spark.read.parquet(f"{root.rstrip('/')}/{folder}")
        except AnalysisException:
            continue
    check_silver(tables, required)
    return tables
