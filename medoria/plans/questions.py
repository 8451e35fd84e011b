"""The business questions over the star."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medoria.functions import in_period
from medoria.plans.dimensions import year_key

RATE_DIGITS = 6


def rate(part: Column, whole: Column) -> Column:
    """Ratio as a rounded double; NULL over nothing."""
    quotient = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
    return F.round(quotient, RATE_DIGITS)


def _in_period(fact: DataFrame, key: str, start: dt.date, end: dt.date) -> DataFrame:
    return fact.where(in_period(F.col(key), F.col("annee"), start, end))


def consultation_rate(
    fact: DataFrame,
    by: str,
    start: dt.date,
    end: dt.date,
    only: Sequence | None = None,
) -> DataFrame:
    """Consultations of ``[start, end)`` per value of ``by``.

    ``n``; ``part``, the share of all consultations of the period; and
    ``par_patient``, consultations per distinct patient. Rows are counted per
    (value, patient) first, so a value with many rows is counted by many tasks.
    ``only`` keeps some values; shares still refer to the whole period.
    """
    visits = _in_period(fact, "fk_date_consultation", start, end)
    per_patient = visits.groupBy(by, "fk_patient").agg(F.sum("nb_consultations").alias("n"))
    groups = per_patient.groupBy(by).agg(
        F.sum("n").alias("n"), F.count("fk_patient").alias("patients")
    )
    total = groups.agg(F.sum("n")).scalar()
    rates = groups.select(
        by,
        "n",
        rate(F.col("n"), total).alias("part"),
        rate(F.col("n"), F.col("patients")).alias("par_patient"),
    )
    return rates if only is None else rates.where(F.col(by).isin(*only))


def consultation_rate_by_professional(
    fact: DataFrame, dim_professionel: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """``consultation_rate`` per professional with profession and speciality."""
    rates = consultation_rate(fact, "fk_professionnel", start, end)
    people = dim_professionel.select(
        F.col("professionnel_id").alias("fk_professionnel"), "profession", "specialite"
    )
    return rates.join(people, "fk_professionnel", "left")  # one row per key on both sides


def hospitalisation_rate(
    fact: DataFrame, dim_patient: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """One row: patients with a stay in the period, their share of all patients, stays."""
    stays = _in_period(fact, "fk_date_entree", start, end)
    per_patient = stays.groupBy("fk_patient").agg(F.sum("nb_hospitalisations").alias("n"))
    population = dim_patient.agg(F.count(F.lit(1))).scalar()
    return per_patient.agg(
        F.count("fk_patient").alias("patients"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"),
    ).select("patients", rate(F.col("patients"), population).alias("taux"), "n")


def hospitalisation_by(
    fact: DataFrame, by: str, start: dt.date, end: dt.date
) -> DataFrame:
    """Stays of the period per value of ``by``: number, share, days."""
    groups = (
        _in_period(fact, "fk_date_entree", start, end)
        .groupBy(by)
        .agg(
            F.sum("nb_hospitalisations").alias("n"),
            F.sum("duree_sejour_jours").alias("jours"),
        )
    )
    # the total asks for the same sums, days included, so that both read one exchange
    total = groups.agg(F.struct(F.sum("n").alias("n"), F.sum("jours").alias("jours"))).scalar()["n"]
    return groups.select(by, "n", rate(F.col("n"), total).alias("part"), "jours")


def stays_per_patient(fact: DataFrame) -> DataFrame:
    """One row per patient and year with a stay: what is kept in buckets of the patient.

    A patient of very many stays, or the stays of unknown patients, are a row a year.
    """
    return fact.groupBy("fk_patient", "annee").agg(
        F.sum("nb_hospitalisations").alias("nb_hospitalisations"),
        F.sum("duree_sejour_jours").alias("duree_sejour_jours"),
    )


def hospitalisation_by_patient(
    fact: DataFrame, dim_patient: DataFrame, by: Sequence[str] = ("sexe", "age")
) -> DataFrame:
    """Share of patients with a stay, per cell of ``by`` and per each column of it alone.

    ``niveau`` names the columns a row is grouped by. Cells without a stay
    have rate 0. Patients are reduced to one row on both sides before the
    join, and the single columns are summed from the cells.
    """
    by = list(by)
    stayed = fact.select(F.col("fk_patient").alias("patient_id")).distinct()
    flagged = dim_patient.select("patient_id", *by).join(
        stayed.withColumn("stayed", F.lit(1)), "patient_id", "left"
    )
    cells = flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("patients"), F.count("stayed").alias("hospitalises")
    )
    levels = [by] + ([[column] for column in by] if len(by) > 1 else [])
    used = F.concat_ws("_", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in by])
    grouped = cells.groupingSets([[F.col(c) for c in level] for level in levels], *by).agg(
        used.alias("niveau"),
        F.sum("patients").alias("patients"),
        F.sum("hospitalises").alias("hospitalises"),
    )
    return grouped.withColumn("taux", rate(F.col("hospitalises"), F.col("patients")))


def deaths_by_region(fact: DataFrame, dim_lieu: DataFrame, year: int) -> DataFrame:
    """Deaths of a year per region; those in an unknown commune under NULL.

    Deaths are summed per place before the join: what is joined is at most
    one row per commune.
    """
    per_place = (
        fact.where(F.col("annee") == year)
        .groupBy(F.col("fk_lieu_deces").alias("lieu_id"))
        .agg(F.sum("nb_deces").alias("n"))
    )
    return (
        per_place.join(dim_lieu.select("lieu_id", "region"), "lieu_id", "left")
        .groupBy("region")
        .agg(F.sum("n").alias("nb_deces"))
    )


def satisfaction_by_region(fact: DataFrame, dim_etablissement: DataFrame, year: int) -> DataFrame:
    """Satisfaction of a year per region.

    ``score_pondere`` weights scores by the answers behind them, over lines
    that have both; ``score_moyen`` is the plain mean. Sums are taken per
    establishment before the join and added up per region.
    """
    both = F.col("score_ajuste").isNotNull() & F.col("nombre_reponses").isNotNull()
    weighted = F.col("score_ajuste") * F.col("nombre_reponses")
    per_owner = (
        fact.where(F.col("fk_date_mesure") == year_key(year))
        .groupBy(F.col("fk_etablissement").alias("etablissement_id"))
        .agg(
            F.sum(F.when(both, weighted)).alias("weighted"),
            F.sum(F.when(both, F.col("nombre_reponses"))).alias("weight"),
            F.sum("score_ajuste").alias("scores"),
            F.count("score_ajuste").alias("n_scores"),
            F.sum("nombre_reponses").alias("reponses"),
        )
    )
    return (
        per_owner.join(dim_etablissement.select("etablissement_id", "region"), "etablissement_id", "left")
        .groupBy("region")
        .agg(
            rate(F.sum("weighted"), F.sum("weight")).alias("score_pondere"),
            rate(F.sum("scores"), F.sum("n_scores")).alias("score_moyen"),
            F.sum("reponses").alias("reponses"),
        )
    )


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Any statement over the registered star."""
    return spark.sql(sql)
