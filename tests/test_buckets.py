"""Tables in buckets of a key: joined where they lie."""

from __future__ import annotations

import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from medoria.plans.questions import hospitalisation_by_patient, stays_per_patient
from medoria.sinks import ensure_database, register_bucketed, write_bucketed

DATABASE = "kept_in_buckets"


@pytest.fixture(scope="module")
def fact(spark):
    # a third of the stays are one patient's, a third nobody's; some patients are unknown
    patient = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 500 + 40)
    return spark.range(6000).select(
        patient.cast("bigint").alias("fk_patient"),
        (2019 + F.col("id") % 4).cast("int").alias("annee"),
        F.lit(1).alias("nb_hospitalisations"),
        F.when(F.col("id") % 5 > 0, F.lit(2)).alias("duree_sejour_jours"),
    )


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(400).select(
        F.col("id").alias("patient_id"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("s"), (F.col("id") % 2).cast("string"))).alias("sexe"),
        (F.col("id") % 50).cast("int").alias("age"),
    )


@pytest.fixture(scope="module")
def kept(spark, fact, people, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("it's here"))
    ensure_database(spark, DATABASE)
    stays = write_bucketed(stays_per_patient(fact), DATABASE, "stays", f"{root}/stays", "fk_patient", 6)
    return root, stays, write_bucketed(people, DATABASE, "people", f"{root}/people", "patient_id", 6)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


def _shuffled_by_patient(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning\((?:patient_id|fk_patient)", plan))


def test_same_rows(fact, people, kept):
    assert _sorted(hospitalisation_by_patient(*kept[1:])) == _sorted(hospitalisation_by_patient(fact, people))


def test_nothing_is_shuffled_under_the_join(fact, people, kept, no_broadcast):
    assert _shuffled_by_patient(hospitalisation_by_patient(fact, people)) > 0
    question = hospitalisation_by_patient(*kept[1:])
    assert "SortMergeJoin" in question._jdf.queryExecution().executedPlan().toString()
    assert _shuffled_by_patient(question) == 0


def test_a_patient_is_a_row_a_year(fact, kept):
    stays = kept[1]
    assert stays.where("fk_patient = 7").count() == 4 and stays.where("fk_patient is null").count() == 4
    sums = [F.sum(c) for c in ("nb_hospitalisations", "duree_sejour_jours")]
    assert stays.agg(*sums).collect() == fact.agg(*sums).collect()


def test_registered_from_files(spark, fact, people, kept, no_broadcast):
    root, stays, there = kept
    named = register_bucketed(spark, DATABASE, "stays_again", f"{root}/stays", stays.schema, "fk_patient", 6)
    assert _shuffled_by_patient(hospitalisation_by_patient(named, there)) == 0
    assert _sorted(named) == _sorted(stays_per_patient(fact))


def test_taken_names_raise(spark, people, kept, tmp_path):
    with pytest.raises(AnalysisException):
        write_bucketed(people, DATABASE, "people", f"{tmp_path}/new", "patient_id", 6)
    assert kept[2].count() == 400


def test_empty(spark, people, fact, kept, tmp_path):
    none = write_bucketed(
        stays_per_patient(fact.limit(0)), DATABASE, "no_stays", f"{tmp_path}/none", "fk_patient", 6
    )
    assert hospitalisation_by_patient(none, kept[2]).agg(F.sum("hospitalises")).collect() == [(0,)]
