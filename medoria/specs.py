"""The star schema: what each gold table holds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructType

_TYPES = {
    "bigint": LongType(),
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "string": StringType(),
}


@dataclass(frozen=True)
class TableSpec:
    """A gold table.

    ``declared_by`` partitions the table when it is created empty;
    ``adaptive_by`` is the column it is partitioned by when written, if its
    size calls for that. ``key`` is unique and not NULL. Files are sorted by
    ``sort_by``, so that a period skips the row groups outside of it.
    """

    name: str
    schema: StructType
    declared_by: tuple[str, ...] = ()
    adaptive_by: str | None = None
    key: str | None = None
    sort_by: str | None = None


def _table(name: str, columns: str, **more) -> TableSpec:
    schema = StructType()
    for column in columns.split(", "):
        column_name, type_name = column.split()
        schema.add(column_name, _TYPES[type_name])
    return TableSpec(name, schema, **more)


# Tables, columns and partition columns of the star. Generated
# keys and patient ids are 64 bits wide, scores double.
STAR = {
    spec.name: spec
    for spec in (
        _table(
            "dim_lieu",
            "lieu_id bigint, commune string, region string, iso string",
            declared_by=("region",),
            adaptive_by="region",
            key="lieu_id",
        ),
        _table(
            "dim_patient",
            "patient_id bigint, age int, sexe string, annee_naissance int, date_naissance date",
            declared_by=("annee_naissance",),
            adaptive_by="annee_naissance",
            key="patient_id",
        ),
        _table(
            "dim_date",
            "date_id int, date_complete date, annee int, mois int, jour int, trimestre int, semestre int",
            declared_by=("annee",),
            adaptive_by="annee",
            key="date_id",
        ),
        _table(
            "dim_etablissement",
            "etablissement_id string, raison_sociale string, commune string, region string, finess string",
            declared_by=("region",),
            adaptive_by="region",
            key="etablissement_id",
        ),
        _table(
            "dim_diagnostic",
            "diagnostic_id string, libelle_diagnostic string, categorie_diagnostic string",
            declared_by=("categorie_diagnostic",),
            key="diagnostic_id",
        ),
        _table(
            "dim_indicateur",
            "indicateur_id int, libelle_indicateur string",
            declared_by=("libelle_indicateur",),
            key="indicateur_id",
        ),
        _table(
            "dim_professionel",
            "professionnel_id string, nom string, prenom string, civilite string, profession string, "
            "specialite string",
            declared_by=("profession", "specialite"),
            key="professionnel_id",
        ),
        _table(
            "fait_deces",
            "id_mort bigint, fk_date_deces int, fk_lieu_deces bigint, nb_deces int, annee int",
            declared_by=("annee",),
            adaptive_by="annee",
            key="id_mort",
            sort_by="fk_date_deces",
        ),
        _table(
            "fait_hospitalisation",
            "fk_patient bigint, fk_etablissement string, fk_diagnostic string, fk_date_entree int, "
            "duree_sejour_jours int, nb_hospitalisations int, annee int",
            declared_by=("annee",),
            adaptive_by="annee",
            sort_by="fk_date_entree",
        ),
        _table(
            "fait_satisfaction",
            "fk_etablissement string, fk_indicateur int, fk_date_mesure int, score_ajuste double, "
            "nombre_reponses int, taux_participation double",
            declared_by=("fk_indicateur",),
        ),
        _table(
            "fait_consultations",
            "fk_patient bigint, fk_professionnel string, fk_date_consultation int, fk_diagnostic string, "
            "fk_etablissement string, nb_consultations int, annee int",
            declared_by=("annee",),
            adaptive_by="annee",
            sort_by="fk_date_consultation",
        ),
    )
}


class SchemaMismatch(ValueError):
    """A built table lacks columns of its contract or has others."""


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of the contract, in its order and of its types."""
    expected, found = set(spec.schema.names), set(df.columns)
    if expected != found:
        raise SchemaMismatch(
            f"{spec.name}: missing {sorted(expected - found)}, unexpected {sorted(found - expected)}"
        )
    return df.select(*[F.col(field.name).cast(field.dataType) for field in spec.schema])
