"""Sets of patients per key and month, kept so that periods are counted without the fact.

Distinct patients of a period can't be added up from the counts of its months, but
sets can be united. Patients get dense numbers, and the sets are cut into buckets of
32,768 numbers. A bucket of few patients is a list of their places, of more a bitmap of
4,096 bytes; both are exact. Whole months are answered from these sets. The days of a
month that a period cuts are answered from a table with one row per key, day and patient.

A key with most of the rows is as many sets as there are buckets, and a row of either table holds
at most one bucket, so no group grows with the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medoria.functions import to_date_key
from medoria.operators import dense_number, lookup
from medoria.plans.questions import rate
from medoria.work import materialise, scratch

FEW = 1024  # places of 4 bytes that take as much as a bitmap


@dataclass(frozen=True)
class PatientSets:
    """``days``: (by…, mois, jour, bucket, place, n); ``months``: (by…, mois, bucket, n, bits, places).

    ``n`` adds up the measure. Rows of an unknown patient have no bucket: they count in ``n`` alone.
    """

    by: tuple[str, ...]
    days: DataFrame
    months: DataFrame


def patient_numbers(fact: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(fk_patient, numero): patients numbered 1, 2, 3…

    Numbers that are ``known`` stay and new patients follow them, so that sets
    made before remain right when months are added.
    """
    patients = fact.select("fk_patient").where("fk_patient is not null").distinct()
    if known is None:
        return dense_number(patients, ["fk_patient"], "numero")
    new = dense_number(patients.join(known, "fk_patient", "left_anti"), ["fk_patient"], "numero")
    last = known.agg(F.coalesce(F.max("numero"), F.lit(0))).scalar()
    return known.select("fk_patient", "numero").unionByName(
        new.select("fk_patient", (F.col("numero") + last).alias("numero"))
    )


def _month(key: Column) -> Column:
    return F.floor(key / 100).cast("int")


def write_patient_sets(
    fact: DataFrame, numbers: DataFrame, by: Sequence[str], key: str, measure: str, root: str
) -> PatientSets:
    """Build the sets of a fact below ``root``, a place not used yet; rows without a date are in no period."""
    by, spark = list(by), fact.sparkSession
    per_day = (
        fact.where(F.col(key).isNotNull())
        .groupBy(*by, F.col(key).alias("jour"), "fk_patient")
        .agg(F.sum(measure).alias("n"))
    )
    number = F.col("numero")
    days = lookup(per_day, numbers, "fk_patient").select(
        *by,
        "jour",
        F.bitmap_bucket_number(number).alias("bucket"),
        F.bitmap_bit_position(number).cast("int").alias("place"),
        "n",
        _month(F.col("jour")).alias("mois"),
    )
    days.hint("rebalance", "mois").sortWithinPartitions("mois", "jour").write.partitionBy("mois").parquet(f"{root}/days")
    days = spark.read.schema(days.schema).parquet(f"{root}/days")
    # a group here is one bucket of one month: at most 31 rows for each of its places
    grouped = days.repartition(*by, "mois", "bucket").groupBy(*by, "mois", "bucket", "place").agg(F.sum("n").alias("n"))
    keys = [*by, "mois", "bucket"]
    lists = grouped.groupBy(*keys).agg(F.sum("n").alias("n"), F.collect_list("place").alias("places"))
    with scratch(spark):
        lists = materialise(lists, "lists")
        # an aggregate holds a whole bitmap per group, so only the sets that become one go through it
        few = F.size("places") <= FEW
        many = lists.where(~few).select(*keys, "n", F.explode("places").alias("place")).groupBy(*keys, "n")
        months = many.agg(F.bitmap_construct_agg("place").alias("bits")).unionByName(
            lists.where(few), allowMissingColumns=True
        )
        months.sortWithinPartitions("mois").write.parquet(f"{root}/months")
    return read_patient_sets(spark, by, root)


def read_patient_sets(spark: SparkSession, by: Sequence[str], root: str) -> PatientSets:
    """The sets that lie below ``root``."""
    months = spark.read.parquet(f"{root}/months")
    # days without rows have no file to tell their columns
    own = StructType.fromDDL("jour int, place int").fields
    schema = StructType([*(months.schema[c] for c in (*by, "mois", "bucket", "n")), *own])
    return PatientSets(tuple(by), spark.read.schema(schema).parquet(f"{root}/days"), months)


def united_by(sets: PatientSets, names: DataFrame, key: str, to: str) -> PatientSets:
    """The sets per ``to`` instead of ``key``; ``names`` has both, one row per ``key``.

    Sets of the finer key are only named anew; they unite when a period is counted.
    """
    kept = [c for c in sets.by if c != key]
    names = names.select(key, to)
    return PatientSets(
        (*kept, to), lookup(sets.days, names, key).drop(key), lookup(sets.months, names, key).drop(key)
    )


def _next_month(day: dt.date) -> dt.date:
    return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)


def count_patients(sets: PatientSets, start: dt.date, end: dt.date) -> DataFrame:
    """``n`` and distinct ``patients`` of ``[start, end)`` per key, one row in all if the sets have none."""
    by = list(sets.by)
    first = start if start.day == 1 else _next_month(start)
    last = max(first, end.replace(day=1))
    day = F.col("jour")
    whole = sets.months.where(
        (F.col("mois") >= first.year * 100 + first.month) & (F.col("mois") < last.year * 100 + last.month)
    )
    cut = sets.days.where(
        (F.col("mois") >= start.year * 100 + start.month)
        & (F.col("mois") <= end.year * 100 + end.month)
        & (day >= to_date_key(start))
        & (day < to_date_key(end))
        & ((day < to_date_key(first)) | (day >= to_date_key(last)))
    )
    lists = whole.where("bucket is not null and places is not null").select(
        *by, "bucket", F.explode("places").alias("place")
    )
    places = lists.unionByName(cut.where("bucket is not null").select(*by, "bucket", "place")).distinct()
    # places become a bitmap where there is one to unite them with; elsewhere they are counted as they are
    keys = [*by, "bucket"]
    many = whole.where("bits is not null").groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    places = places.join(many.select(*[F.col(c).alias(f"_{c}") for c in keys]), same, "left")
    beside = F.col("_bucket").isNotNull()
    bits = places.where(beside).groupBy(*keys).agg(F.bitmap_construct_agg("place").alias("bits"))
    united = bits.unionByName(many).groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))
    zero = F.lit(0).cast("bigint")
    parts = (
        whole.select(*by, "n", zero.alias("patients"))
        .unionByName(cut.select(*by, "n", zero.alias("patients")))
        .unionByName(united.select(*by, zero.alias("n"), F.bitmap_count("bits").alias("patients")))
        .unionByName(places.where(~beside).select(*by, zero.alias("n"), F.lit(1).cast("bigint").alias("patients")))
    )
    total = [F.coalesce(F.sum(c), zero).alias(c) for c in ("n", "patients")]
    return parts.groupBy(*by).agg(*total)


def visit_rate(sets: PatientSets, start: dt.date, end: dt.date) -> DataFrame:
    """Rows, ``part`` and ``par_patient`` of ``consultation_rate``, from sets."""
    groups = count_patients(sets, start, end)
    total = groups.agg(F.sum("n")).scalar()
    return groups.select(
        *sets.by,
        "n",
        rate(F.col("n"), total).alias("part"),
        rate(F.col("n"), F.col("patients")).alias("par_patient"),
    )


def stay_rate(sets: PatientSets, dim_patient: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The row of ``hospitalisation_rate``, from sets by nothing."""
    population = dim_patient.agg(F.count(F.lit(1))).scalar()
    return count_patients(sets, start, end).select("patients", rate(F.col("patients"), population).alias("taux"), "n")
