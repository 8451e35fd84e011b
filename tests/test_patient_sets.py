"""Sets of patients: any period as from the fact, at the borders of months too."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from medoria.plans import patient_sets
from medoria.plans.patient_sets import count_patients, patient_numbers, read_patient_sets, united_by, write_patient_sets
from medoria.plans.questions import consultation_rate

D = dt.date
SCHEMA = "fk_patient bigint, k string, fk_date_consultation int, nb_consultations int, annee int"
PERIODS = [
    (D(2019, 1, 1), D(2020, 1, 1)),
    (D(2019, 1, 1), D(2019, 1, 31)),
    (D(2019, 1, 31), D(2019, 2, 1)),
    (D(2018, 12, 31), D(2019, 2, 1)),
    (D(2019, 1, 10), D(2019, 1, 20)),
    (D(2018, 12, 15), D(2019, 3, 15)),
    (D(2019, 2, 1), D(2019, 2, 1)),
    (D(2019, 11, 30), D(2020, 1, 2)),
    (D(2030, 1, 1), D(2031, 1, 1)),
]


def _rows():
    r = random.Random(5)
    rows = []
    for _ in range(3000):
        day = D(2018, 11, 1) + dt.timedelta(r.randrange(460))
        # one key has a third of the rows, patients and keys may be unknown, rows are repeated
        key = r.choice(["hot", "hot", "a", "b", None, "c"])
        patient = r.choice([None, r.randrange(40), r.randrange(100_000), -7])
        rows.append((patient, key, day.year * 10000 + day.month * 100 + day.day, 1, day.year))
    edges = [(1, "edge", d, 1, d // 10000) for d in (20181231, 20190101, 20190131, 20190201, 20190228, 20191231, 20200101)]
    return [*rows, *rows[:200], *edges, (5, "undated", None, 1, None)]


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="module")
def roots(spark, fact, tmp_path_factory):
    """The sets as lists, and as bitmaps alone."""
    made = []
    for few in (patient_sets.FEW, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(patient_sets, "FEW", few)
            made.append(f"{tmp_path_factory.mktemp('sets')}/here")
            write_patient_sets(fact, patient_numbers(fact), ["k"], "fk_date_consultation", "nb_consultations", made[-1])
    return made


def _counted(rows, start, end):
    lower, upper = (d.year * 10000 + d.month * 100 + d.day for d in (start, end))
    found: dict = {}
    for patient, key, day, n, _ in rows:
        if day is not None and lower <= day < upper:
            total, people = found.setdefault(key, [0, set()])
            found[key][0] = total + n
            people.add(patient)
    return {key: (n, len(people - {None})) for key, (n, people) in found.items()}


@pytest.mark.parametrize("period", PERIODS, ids=str)
def test_periods(spark, roots, period):
    for root in roots:
        counted = count_patients(read_patient_sets(spark, ["k"], root), *period).collect()
        assert {r["k"]: (r["n"], r["patients"]) for r in counted} == _counted(_rows(), *period)
        assert len(counted) == len({r["k"] for r in counted})


def test_rates_equal_those_of_the_fact(spark, fact, roots):
    sets = read_patient_sets(spark, ["k"], roots[0])
    for period in PERIODS[:4]:
        mine = patient_sets.visit_rate(sets, *period)
        assert sorted(mine.collect(), key=str) == sorted(consultation_rate(fact, "k", *period).collect(), key=str)


def test_both_forms(spark, roots):
    lists, bitmaps = (read_patient_sets(spark, ["k"], root).months.where("bucket is not null") for root in roots)
    assert lists.where("bits is not null or size(places) > 1024").isEmpty()
    assert bitmaps.where("places is not null").isEmpty() and bitmaps.count() == lists.count()


def test_more_than_one_bucket_and_dense_sets(spark, tmp_path):
    fact = spark.range(70_000).select(
        F.col("id").alias("fk_patient"),
        F.lit(20190100 + 1).alias("fk_date_consultation"),
        F.lit(1).alias("nb_consultations"),
        F.lit(2019).alias("annee"),
    )
    fact = fact.unionByName(fact.withColumn("fk_date_consultation", F.lit(20190215)))
    sets = write_patient_sets(
        fact, patient_numbers(fact), [], "fk_date_consultation", "nb_consultations", f"{tmp_path}/sets"
    )
    assert sets.months.where("bits is not null").count() == 6
    assert count_patients(sets, D(2019, 1, 1), D(2019, 2, 20)).collect() == [(140_000, 70_000)]
    assert count_patients(sets, D(2020, 1, 1), D(2021, 1, 1)).collect() == [(0, 0)]


def test_numbers_stay_when_patients_are_added(fact):
    early = patient_numbers(fact.where("annee < 2019"))
    before = {r["fk_patient"]: r["numero"] for r in early.collect()}
    after = {r["fk_patient"]: r["numero"] for r in patient_numbers(fact, early).collect()}
    assert before.items() <= after.items()
    assert sorted(after.values()) == list(range(1, len(after) + 1))
    assert set(after) == {r[0] for r in _rows()} - {None}


def test_united(spark, roots):
    sets = read_patient_sets(spark, ["k"], roots[0])
    names = spark.createDataFrame([("hot", "x"), ("a", "x"), ("b", "y"), ("unused", "z")], "k string, kind string")
    kinds = {"hot": "x", "a": "x", "b": "y"}
    rows = [(p, kinds.get(k), day, n, y) for p, k, day, n, y in _rows()]
    for period in PERIODS:
        counted = count_patients(united_by(sets, names, "k", "kind"), *period).collect()
        assert {r["kind"]: (r["n"], r["patients"]) for r in counted} == _counted(rows, *period)


def test_empty(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    root = f"{tmp_path}/sets"
    write_patient_sets(empty, patient_numbers(empty), ["k"], "fk_date_consultation", "nb_consultations", root)
    assert count_patients(read_patient_sets(spark, ["k"], root), D(2019, 1, 1), D(2019, 3, 4)).isEmpty()


def test_bitmaps_are_made_for_many_patients_alone(spark, fact, tmp_path, monkeypatch):
    """An aggregate of bitmaps holds 4,096 bytes per group: sets of few patients never enter one."""
    refused = lambda place: F.max(F.raise_error(F.concat(F.lit("a bitmap for "), place.cast("string")))).cast("binary")
    monkeypatch.setattr(patient_sets.F, "bitmap_construct_agg", lambda place: refused(F.col(place)))
    sets = write_patient_sets(
        fact, patient_numbers(fact), ["k"], "fk_date_consultation", "nb_consultations", f"{tmp_path}/sets"
    )
    for period in PERIODS:
        counted = count_patients(sets, *period).collect()
        assert {r["k"]: (r["n"], r["patients"]) for r in counted} == _counted(_rows(), *period)


def test_lists_beside_bitmaps(spark, fact, tmp_path, monkeypatch):
    monkeypatch.setattr(patient_sets, "FEW", 20)
    sets = write_patient_sets(
        fact, patient_numbers(fact), ["k"], "fk_date_consultation", "nb_consultations", f"{tmp_path}/sets"
    )
    assert 0 < sets.months.where("bits is not null").count() < sets.months.count()
    for period in PERIODS:
        counted = count_patients(sets, *period).collect()
        assert {r["k"]: (r["n"], r["patients"]) for r in counted} == _counted(_rows(), *period)
