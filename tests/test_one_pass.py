"""CSV is converted in one pass where the beginnings tell the types, with the rows and types of inference; fingerprints sum numbers."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameReader

from medoria.plans.silver import convert_source
from medoria.sinks.checks import _row_hashes, fingerprint
from medoria.sources import csv_files, raw

HEADER = "n;w;d;x;code"
ROW = "1;abc;2020-02-01;0.5;012"


def put(folder, *files):
    source = folder / "f.csv"
    source.mkdir()
    for k, rows in enumerate(files):
        (source / f"part-{k}.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    return str(source)


def converted(spark, source, target):
    outcome = convert_source(spark, source, target, "f")
    table = spark.read.parquet(target).drop("conversion_timestamp")
    rows = table.selectExpr(*[f"string({c}) as {c}" for c in table.columns]).collect()  # some days are beyond Python's
    return outcome, table.schema, sorted(map(str, rows))


def test_files_that_begin_as_they_go_on_are_read_once(spark, tmp_path, monkeypatch):
    source, csv = put(tmp_path, [ROW] * 5, [ROW, "7;;;;", "-8;x;2021-12-31;1;1"]), DataFrameReader.csv

    def no_inference(self, path, **options):
        assert not options.get("inferSchema"), "the files are read to infer types"
        return csv(self, path, **options)

    monkeypatch.setattr(DataFrameReader, "csv", no_inference)
    outcome, schema, rows = converted(spark, source, f"{tmp_path}/out")
    assert (outcome.status, outcome.n_rows, outcome.n_cols, outcome.error) == ("OK", 8, 8, None)
    assert [f.dataType.simpleString() for f in schema[:5]] == ["int", "string", "date", "double", "int"]
    assert len(rows) == 8


@pytest.mark.parametrize(
    "later",
    [
        ["3000000000;abc;2020-02-01;1;5"],  # a wider number
        ["99999999999999999999;abc;2020-02-01;99999999999999999999;5"],  # beyond 64 bits
        ["1.5;abc;2020-02-01;NaN;5"],
        ["one;abc;2020-02-01;1,5;5"],
        ["1;12;2020-02-01;1d;5"],
        ["1;abc;2020-02-30;0.5;5"],  # no such day
        ["1;abc;2020-02;0.5;5"],  # a cast takes it
        ["1;abc;2020-2-1;0.5;5"],
        ["1;abc;2020;0.5;5"],
        ["1;abc;2020-02-01 10:00:00;0.5;5"],
        ["1;abc;2020-02-01T10:00:00;0.5;5"],
        ["1;abc;+12020-02-01;0.5;5"],
        ['"1";"a;b";"2020-02-01"; 0.5 ;5'],
        ["1;abc; 2020-02-03 ;0.5;"],
        ['1;abc;" 2020-02-03";0.5;5'],
        ["1;abc;2020-02-01"],  # too few cells
        ["1;abc;2020-02-01;0.5;5;6"],
        ["true;true;true;true;true"],
        [";;;;"],
    ],
)
def test_what_comes_later_has_the_types_of_inference(spark, tmp_path, monkeypatch, later):
    source = put(tmp_path, [ROW] * 20 + later + [ROW], later + [ROW])
    monkeypatch.setattr(csv_files, "HEAD_BYTES", 120)  # none of what comes later in the first file
    monkeypatch.setattr(csv_files, "GUESSED_FROM", 1)
    begun = csv_files.read_csv_as_begun(spark, source)
    assert begun is None or begun.columns[:-1] == HEADER.split(";")
    found = converted(spark, source, f"{tmp_path}/out")
    monkeypatch.setattr(raw, "read_csv_as_begun", lambda *_: None)
    assert found == converted(spark, source, f"{tmp_path}/inferred")


@pytest.mark.parametrize(
    ("cells", "kind"),
    [
        ({"1", "-7", "", "007"}, "int"),
        ({"1", "3000000000"}, "bigint"),
        ({"1", "0.5"}, "double"),
        ({"2020-02-29", ""}, "date"),
        ({"1", "2020-02-29", "Brand#1"}, "string"),
        ({"2020-02-30"}, None),
        ({"2020-02-29", "1"}, None),
        ({"2020-02-29 10:00:00"}, None),
        ({"99999999999999999999"}, None),
        ({"true"}, None),
        ({"NaN"}, None),
        ({"1,5"}, None),
        ({""}, None),
    ],
)
def test_only_sure_types_are_guessed(cells, kind):
    found = csv_files._guessed_type(cells)
    assert (found and found.simpleString()) == kind


def test_a_fingerprint_is_the_exact_sum_of_numbers(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, id * 7) as x", "string(id % 5) as y")
    hashes = [tuple(r) for r in df.select(*_row_hashes(df.columns).values()).collect()]
    found = fingerprint(df).first()
    assert (found["n_rows"], int(found["h1"]), int(found["h2"])) == (1000, *map(sum, zip(*hashes)))
    plan = fingerprint(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast" not in plan  # the rows are not summed as decimals
