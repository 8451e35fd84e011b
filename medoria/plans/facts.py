"""The four facts. ``t`` maps silver roles to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medoria.functions import date_key, to_number
from medoria.operators import dense_number, lookup
from medoria.plans.dimensions import Tables, year_key
from medoria.specs import STAR, conform


def fait_deces(t: Tables, dim_lieu: DataFrame) -> DataFrame:
    """One row per death; an unknown commune has no place key.

    Deaths carry no id of their own. They are numbered by day and commune;
    deaths equal in both differ in nothing else, so the rows are determined.
    """
    deaths = t["deces"].select(
        F.col("date_deces").try_cast("date").alias("jour"),
        F.col("code_commune").cast("string").alias("commune"),
    )
    numbered = dense_number(deaths, ["jour", "commune"], "id_mort", ties=True)
    places = dim_lieu.select("commune", F.col("lieu_id").alias("fk_lieu_deces"))
    day = F.col("jour")
    return conform(
        lookup(numbered, places, "commune", spread_by="id_mort").select(
            "id_mort",
            date_key(day).alias("fk_date_deces"),
            "fk_lieu_deces",
            F.lit(1).alias("nb_deces"),
            F.year(day).alias("annee"),
        ),
        STAR["fait_deces"],
    )


def fait_hospitalisation(t: Tables) -> DataFrame:
    """One row per stay: a projection of the source, no shuffle."""
    day = F.col("date").try_cast("date")
    return conform(
        t["hospitalisation"].select(
            F.col("id_patient").try_cast("bigint").alias("fk_patient"),
            F.col("id_etablissement").alias("fk_etablissement"),
            F.col("code_diag").alias("fk_diagnostic"),
            date_key(day).alias("fk_date_entree"),
            F.col("duree").try_cast("int").alias("duree_sejour_jours"),
            F.lit(1).alias("nb_hospitalisations"),
            F.year(day).alias("annee"),
        ),
        STAR["fait_hospitalisation"],
    )


def fait_satisfaction(t: Tables, dim_etablissement: DataFrame, year: int = 2020) -> DataFrame:
    """One row per survey line of both surveys, dated by the year they cover.

    Lines refer to establishments by ``finess``; where several share one, the
    smallest id is meant, so no line is repeated. ``taux_participation`` holds
    the recommendation rate ``taux_reco_brut``.
    """

    def survey(table: str, indicator: int, score: str, answers: str) -> DataFrame:
        return t[table].select(
            F.col("finess").cast("string").alias("finess"),
            F.lit(indicator).alias("fk_indicateur"),
            to_number(F.col(score)).alias("score_ajuste"),
            to_number(F.col(answers)).try_cast("int").alias("nombre_reponses"),
            to_number(F.col("taux_reco_brut")).alias("taux_participation"),
        )

    lines = survey(
        "satisfaction_esatis", 1, "score_all_rea_ajust", "nb_rep_score_all_rea_ajust"
    ).unionByName(survey("satisfaction_esatisca", 2, "score_all_ajust", "nb_rep_score_all_ajust"))
    owners = dim_etablissement.groupBy("finess").agg(
        F.min("etablissement_id").alias("fk_etablissement")
    )
    return conform(
        lookup(lines, owners, "finess")
        .drop("finess")
        .withColumn("fk_date_mesure", F.lit(year_key(year))),
        STAR["fait_satisfaction"],
    )


def _consultations(t: Tables) -> DataFrame:
    return t["consultations"].withColumn("id_prof_sante", F.col("id_prof_sante").cast("string"))


def _activities(t: Tables) -> DataFrame:
    return t["activite_professionel"].select(
        F.col("id_prof_sante").cast("string").alias("id_prof_sante"),
        F.col("id_etablissement").cast("string").alias("fk_etablissement"),
    )


def _consultation_rows(joined: DataFrame) -> DataFrame:
    day = F.col("date").try_cast("date")
    return conform(
        joined.select(
            F.col("id_patient").try_cast("bigint").alias("fk_patient"),
            F.col("id_prof_sante").alias("fk_professionnel"),
            date_key(day).alias("fk_date_consultation"),
            F.col("code_diag").alias("fk_diagnostic"),
            "fk_etablissement",
            F.lit(1).alias("nb_consultations"),
            F.year(day).alias("annee"),
        ),
        STAR["fait_consultations"],
    )


def fait_consultations(t: Tables) -> DataFrame:
    """One row per consultation, at the professional's first establishment."""
    main = _activities(t).groupBy("id_prof_sante").agg(F.min("fk_etablissement").alias("fk_etablissement"))
    return _consultation_rows(lookup(_consultations(t), main, "id_prof_sante"))


def bridge_consultation_etablissement(t: Tables) -> DataFrame:
    """A consultation once per establishment its professional works at.

    Repeats consultations: counts over it are per establishment, not in total.
    """
    return _consultation_rows(lookup(_consultations(t), _activities(t), "id_prof_sante"))
