from __future__ import annotations

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medoria.functions import (
    age_at,
    calendar,
    clean_name,
    date_key,
    in_period,
    output_files,
    size_mb,
    table_name_of,
    to_date_key,
    to_number,
)
from medoria.functions.sizing import output_files_for


def values(spark, rows, kind, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [row["y"] for row in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_date_key(spark):
    days = [dt.date(2020, 1, 9), dt.date(1999, 12, 31), None]
    assert values(spark, days, "date", date_key) == [20200109, 19991231, None]
    assert to_date_key(days[0]) == 20200109


def test_calendar_of_half_years_and_null(spark):
    days = [dt.date(2020, 6, 30), dt.date(2020, 7, 1), None]
    semesters = values(spark, days, "date", lambda c: calendar(c)["semestre"])
    quarters = values(spark, days, "date", lambda c: calendar(c)["trimestre"])
    assert semesters == [1, 2, None]
    assert quarters == [2, 3, None]


def test_age_counts_completed_years(spark):
    as_of = dt.date(2021, 3, 1)
    born = [
        dt.date(2000, 2, 29),
        dt.date(2000, 3, 1),
        dt.date(2000, 3, 2),
        dt.date(2021, 3, 1),
        None,
    ]
    assert values(spark, born, "date", lambda c: age_at(c, as_of)) == [21, 21, 20, 0, None]


def test_in_period_is_half_open(spark):
    start, end = dt.date(2019, 12, 31), dt.date(2020, 1, 2)
    rows = [(20191230, 2019), (20191231, 2019), (20200101, 2020), (20200102, 2020)]
    df = spark.createDataFrame(rows, "k int, y int")
    kept = df.where(in_period(F.col("k"), F.col("y"), start, end)).orderBy("k").collect()
    assert [row["k"] for row in kept] == [20191231, 20200101]


@pytest.mark.parametrize(
    ("raw", "name"),
    [
        ("Satisfaction_ESATIS48h_2020", "satisfaction_esatis48h_2020"),
        ("2020", "unknown_table"),
        ("2020 décès.v1", "d_c_s_v1"),
        ("__a--b", "a_b"),
        ("", "unknown_table"),
        (None, "unknown_table"),
        ("a_", "a"),
        ("9lives_", "lives"),
    ],
)
def test_clean_name(spark, raw, name):
    assert values(spark, [raw], "string", clean_name) == [name]


def by_the_rules(raw: str) -> str:
    """The naming rules one after the other."""
    name = raw.lower()
    name = re.sub("[ .-]", "_", name)
    name = "".join(c if c.isascii() and (c.isalnum() or c == "_") else "_" for c in name)
    while name and not name[0].isalpha():
        name = name[1:]
    while "__" in name:
        name = name.replace("__", "_")
    return name.strip("_") or "unknown_table"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ09_-. é/É\n\t")), min_size=50, max_size=50))
def test_clean_name_follows_the_rules(spark, raws):
    assert values(spark, raws, "string", clean_name) == [by_the_rules(raw) for raw in raws]


def test_table_name_of_path(spark):
    paths = ["Consultation/Patient.csv", "a/b.c/d.v1.csv", "x.csv", "no_extension"]
    assert values(spark, paths, "string", table_name_of) == [
        "consultation_patient",
        "a_b_c_d_v1",
        "x",
        "no_extension",
    ]


def test_to_number(spark):
    raws = ["72,5", "72.5", " 3 ", "", "abc", None, "-0,25"]
    assert values(spark, raws, "string", to_number) == [72.5, 72.5, 3.0, None, None, None, -0.25]


def test_size_mb_rounds_half_to_even(spark):
    megabyte = 1024 * 1024
    lengths = [0, megabyte // 8, megabyte * 3 // 8, megabyte, 123_456_789, None]
    expected = [round(n / megabyte, 2) if n is not None else 0.0 for n in lengths]
    assert values(spark, lengths, "bigint", size_mb) == expected


def test_output_files(spark):
    rows = [0, 1, 100_000, 100_001, 1_000_000, 1_000_001, None, -1]
    files = [None, 1, 1, 4, 4, 8, None, None]
    assert values(spark, rows, "bigint", output_files) == files
    assert [output_files_for(n) for n in rows if n is not None] == [
        f for n, f in zip(rows, files) if n is not None
    ]
