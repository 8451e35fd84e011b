"""The seven dimensions. ``t`` maps silver roles to DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medoria.functions import age_at, calendar, date_key
from medoria.operators import dense_number, keep_one, lookup
from medoria.specs import STAR, conform

Tables = Mapping[str, DataFrame]

# The two satisfaction surveys.
INDICATORS = {1: "esatis48h", 2: "esatisca"}


def year_key(year: int) -> int:
    """Key of the date member that stands for a whole year."""
    return year * 10000


def _regions(t: Tables) -> DataFrame:
    code = F.col("code_region").cast("string").alias("code_region")
    return keep_one(t["region"].select(code, "region", "iso"), "code_region")


def _communes(t: Tables) -> DataFrame:
    codes = [F.col(c).cast("string").alias(c) for c in ("code_commune", "code_region")]
    return keep_one(t["communes"].select(*codes), "code_commune")


def dim_lieu(t: Tables) -> DataFrame:
    """Communes with their region; the key follows the order of the commune codes."""
    places = lookup(_communes(t), _regions(t), "code_region", spread_by="code_commune").select(
        F.col("code_commune").alias("commune"), "region", "iso"
    )
    return conform(dense_number(places, ["commune"], "lieu_id"), STAR["dim_lieu"])


def dim_patient(t: Tables, as_of: dt.date) -> DataFrame:
    """One row per patient, with the age on ``as_of`` and the year of birth."""
    patients = keep_one(
        t["patient"].select(
            F.col("id_patient").try_cast("bigint").alias("patient_id"),
            "sexe",
            F.col("date_naissance").try_cast("date").alias("date_naissance"),
        ),
        "patient_id",
    )
    born = F.col("date_naissance")
    return conform(
        patients.withColumns({"age": age_at(born, as_of), "annee_naissance": F.year(born)}),
        STAR["dim_patient"],
    )


def dim_date(t: Tables, years: Iterable[int] = (2020,)) -> DataFrame:
    """Every day that occurs in a source, and one member per year in ``years``."""
    sources = (
        ("hospitalisation", "date"),
        ("consultations", "date"),
        ("deces", "date_deces"),
        ("patient", "date_naissance"),
    )
    days = None
    for table, column in sources:
        one = t[table].select(F.col(column).try_cast("date").alias("date_complete"))
        days = one if days is None else days.union(one)
    day = F.col("date_complete")
    days = (
        days.where(day.isNotNull())
        .distinct()
        .withColumns({"date_id": date_key(day), **calendar(day)})
    )
    for year in years:
        member = days.sparkSession.range(1).select(
            F.lit(year_key(year)).alias("date_id"), F.lit(year).alias("annee")
        )
        days = days.unionByName(member, allowMissingColumns=True)
    return conform(days, STAR["dim_date"])


def dim_etablissement(t: Tables) -> DataFrame:
    """One row per establishment, placed in its region through its commune."""
    establishments = keep_one(
        t["etablissement_sante"].select(
            F.col("id_etablissement").cast("string").alias("etablissement_id"),
            "raison_sociale",
            F.col("code_commune").cast("string").alias("commune"),
            "finess",
        ),
        "etablissement_id",
    )
    regions = _regions(t).select("code_region", "region")
    placed = lookup(_communes(t), regions, "code_region", spread_by="code_commune").select(
        F.col("code_commune").alias("commune"), "region"
    )
    return conform(
        lookup(establishments, placed, "commune", spread_by="etablissement_id"),
        STAR["dim_etablissement"],
    )


def _labels(t: Tables) -> DataFrame:
    return (
        t["diagnostic"]
        .groupBy(F.col("code_diag").cast("string").alias("diagnostic_id"))
        .agg(F.min("diagnostic").alias("libelle_diagnostic"))
    )


def dim_diagnostic(t: Tables) -> DataFrame:
    """One row per code used in a consultation or a stay.

    The category is the most frequent reason given with the code, the smallest
    one on a tie. Reasons are counted per code before the codes are grouped.
    """
    code = F.col("code_diag").cast("string").alias("diagnostic_id")
    reasons = (
        t["consultations"]
        .groupBy(code, F.col("motif").alias("categorie_diagnostic"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stays = t["hospitalisation"].select(code).distinct()
    ranked = F.when(
        F.col("categorie_diagnostic").isNotNull(), F.struct(-F.col("n"), "categorie_diagnostic")
    )
    codes = (
        reasons.unionByName(stays, allowMissingColumns=True)
        .where("diagnostic_id is not null")
        .groupBy("diagnostic_id")
        .agg(F.min(ranked)["categorie_diagnostic"].alias("categorie_diagnostic"))
    )
    return conform(lookup(codes, _labels(t), "diagnostic_id", spread_by="diagnostic_id"), STAR["dim_diagnostic"])


def bridge_diagnostic_motif(t: Tables) -> DataFrame:
    """Every distinct (code, label, reason) of the consultations: several rows per code."""
    pairs = (
        t["consultations"]
        .select(
            F.col("code_diag").cast("string").alias("diagnostic_id"),
            F.col("motif").alias("categorie_diagnostic"),
        )
        .distinct()
    )
    labels = (
        t["diagnostic"]
        .select(
            F.col("code_diag").cast("string").alias("diagnostic_id"),
            F.col("diagnostic").alias("libelle_diagnostic"),
        )
        .distinct()
    )
    return lookup(pairs, labels, "diagnostic_id", spread_by="categorie_diagnostic").select(
        "diagnostic_id", "libelle_diagnostic", "categorie_diagnostic"
    )


def dim_indicateur(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(INDICATORS.items()), STAR["dim_indicateur"].schema)


def dim_professionel(t: Tables) -> DataFrame:
    """One row per professional."""
    people = t["professionnel_sante"].select(
        F.col("id_prof_sante").cast("string").alias("professionnel_id"),
        "nom",
        "prenom",
        "civilite",
        "profession",
        "specialite",
    )
    return conform(keep_one(people, "professionnel_id"), STAR["dim_professionel"])
