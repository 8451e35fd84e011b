from __future__ import annotations

import datetime as dt
import json
import os
import random
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from medoria.plans.silver import convert_folder, convert_source, preview, with_lineage
from medoria.sinks import as_report, failed, summary, write_silver
from medoria.sinks.report import Outcome
from medoria.sources import UnsupportedFormat, discover, read_csv, read_json, read_raw, sniff_separator
from medoria.sources.json_files import array_records, layout
from medoria.sources.jdbc import jdbc_options
from medoria.sources.silver import SILVER_COLUMNS, SILVER_TABLES, MissingTables, check_silver, load_silver


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def content(df):
    return df.columns, sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(
    ("lines", "separator"),
    [
        (["a;b", "1;2"], ";"),
        (["a,b", "1,2"], ","),
        (["a;b", "1,2"], ","),
        (["a;b"], ";"),
        ([], ","),
        (["a,b", "�;"], ";"),
    ],
)
def test_sniff_separator(lines, separator):
    assert sniff_separator(lines) == separator


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('id;nom\n1;"a ""q"""\n', (["id", "nom"], [(1, 'a "q"')])),
        ("id,nom\n1,x\n", (["id", "nom"], [(1, "x")])),
        ("id,nom\r\n1,x\r\n", (["id", "nom"], [(1, "x")])),
        # as many of both: the comma is tried first and splits
        ("a,b\n1;1,2\n", (["a", "b"], [("1;1", 2)])),
        # as many of both: the comma leaves one column, the semicolon two
        ('a;b\n"x,y,z";1\n', (["a", "b"], [("x,y,z", 1)])),
        # the comma is inside the quotes of the only header cell
        ('"a,b";c\n1;2\n', (["a,b", "c"], [(1, 2)])),
        ('"a,b"\n1\n', (["a,b"], [(1,)])),
        ("id;nom\n 1 ;  x \n", (["id", "nom"], [(1, "x")])),
        ("d;t\n2020-02-01;2020-02-01 10:00:00\n", (["d", "t"], [(dt.date(2020, 2, 1), dt.datetime(2020, 2, 1, 10))])),
        # one column either way
        ("id\n1\n2\n", (["id"], [(1,), (2,)])),
    ],
)
def test_read_csv(spark, tmp_path, text, expected):
    path = put(tmp_path, "f.csv", text)
    assert content(read_csv(spark, path)) == expected


def test_read_csv_with_known_schema(spark, tmp_path):
    path = put(tmp_path, "f.csv", "id;code\n1;01001\n")
    schema = StructType([StructField("id", LongType()), StructField("code", StringType())])
    table = read_csv(spark, path, schema)
    assert table.schema == schema
    assert content(table)[1] == [(1, "01001")]


def test_without_inference_every_column_is_text(spark, tmp_path, monkeypatch):
    path = put(tmp_path, "f.csv", "id;nom\n 1 ; x \n")
    csv = DataFrameReader.csv

    def no_inference(self, path, **options):
        if options.get("inferSchema"):
            raise PySparkException("types cannot be inferred")
        return csv(self, path, **options)

    monkeypatch.setattr(DataFrameReader, "csv", no_inference)
    assert content(read_csv(spark, path)) == (["id", "nom"], [("1", "x")])


def test_bytes_that_are_not_utf8_mean_semicolon(spark, tmp_path):
    path = put(tmp_path, "f.csv", "a;décès\n1;2\n", "latin-1")
    assert len(read_csv(spark, path).columns) == 2


def test_json_keeps_nested_values(spark, tmp_path):
    data = [{"id": 1, "place": {"code": "2A"}, "tags": ["x", "y"]}, {"id": 2, "place": None, "tags": []}]
    path = put(tmp_path, "f.json", json.dumps(data, indent=2))
    table = read_raw(spark, path, "json")
    assert dict(table.dtypes) == {"id": "bigint", "place": "struct<code:string>", "tags": "array<string>"}
    assert table.where("id = 1").first()["place"]["code"] == "2A"
    assert table.count() == 2


@pytest.mark.parametrize(
    "text",
    [
        '{"id": 1}\n{"id": 2}\n{"id": 3}\n',
        '[{"id": 1}, {"id": 2},\n {"id": 3}]',
        '[\n{"id": 1},\n{"id": 2},\n{"id": 3}\n]\n',
    ],
)
def test_json_is_read_whole_in_any_layout(spark, tmp_path, text):
    path = put(tmp_path, "f.json", text)
    assert content(read_raw(spark, path, "json")) == (["id"], [(1,), (2,), (3,)])


def test_one_json_object(spark, tmp_path):
    path = put(tmp_path, "f.json", '{"id": 1,\n "x": "{}"}')
    assert content(read_raw(spark, path, "json")) == (["id", "x"], [(1, "{}")])


def test_unknown_format(spark):
    with pytest.raises(UnsupportedFormat):
        read_raw(spark, "/nowhere", "xlsx")


def test_discover_names_and_sizes(spark, tmp_path):
    texts = {
        "Consultation/Patient.csv": "a;b\n",
        "x y/Z.csv": "a\n",
        "x-y/z.csv": "a;b;c\n",
        "top.csv": "a,b\n1,2\n",
        "2020.csv": "a\n",
        "other.txt": "a\n",
        "deep/er/one.csv": "a\n",
        "big.csv/part-0.csv": "a\n1\n",
        "big.csv/part-1.csv": "a\n2\n",
    }
    for name, text in texts.items():
        put(tmp_path, name, text)
    found = {row["table_name"]: row for row in discover(spark, f"{tmp_path}/", "csv", "out/").collect()}
    assert set(found) == {
        "consultation_patient",
        "x_y_z",
        "x_y_z_1",
        "top",
        "unknown_table",
        "deep_er_one",
        "big",
    }
    assert found["x_y_z"]["source_path"].endswith("x y/Z.csv")  # a space sorts before a dash
    assert found["x_y_z_1"]["target_path"] == "out/x_y_z_1"
    assert (found["big"]["n_files"], found["big"]["length"]) == (2, 8)
    assert found["top"]["length"] == os.path.getsize(tmp_path / "top.csv")
    assert found["top"]["file_size_mb"] == 0.0


@pytest.mark.parametrize("spelling", ["file://{}", "file:{}", "{}/", "{}"])
def test_discover_any_spelling_of_the_root(spark, tmp_path, spelling):
    put(tmp_path, "raw/raw/x.csv", "a\n")
    root = f"{tmp_path}/raw"
    (found,) = discover(spark, spelling.format(root), "csv", "out").collect()
    assert found["table_name"] == "raw_x"
    assert found["source_path"].endswith(f"{root}/raw/x.csv")


def test_discover_nothing(spark, tmp_path):
    assert discover(spark, str(tmp_path), "csv", "out").count() == 0


def test_given_files_have_their_true_size(spark, sf_dir):
    found = discover(spark, sf_dir, "parquet", "out").collect()
    assert {row["table_name"]: row["length"] for row in found} == {
        name.removesuffix(".parquet"): os.path.getsize(f"{sf_dir}/{name}") for name in os.listdir(sf_dir)
    }


def test_lineage(spark):
    row = with_lineage(spark.range(1), "x").first()
    assert (row["id"], row["table_name"]) == (0, "x")
    assert isinstance(row["conversion_timestamp"], dt.datetime)


def parquet_files(path):
    return [name for name in os.listdir(path) if name.endswith(".parquet")]


@pytest.mark.parametrize(("rows", "files"), [(1, 1), (100_000, 1), (100_001, 4), (1_000_001, 8)])
def test_output_files_follow_the_rule(spark, tmp_path, rows, files):
    path = f"{tmp_path}/out"
    assert write_silver(spark.range(rows), path, output_files=True) == rows
    assert len(parquet_files(path)) == files
    assert all(".snappy." in name for name in parquet_files(path))


def test_tables_keep_their_splits(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert write_silver(spark.range(0, 1000, 1, 6), path) == 1000
    assert len(parquet_files(path)) == 6


def test_nothing_is_written_for_no_rows(spark, tmp_path):
    assert write_silver(spark.range(0), f"{tmp_path}/a") == 0
    assert write_silver(spark.range(0), f"{tmp_path}/b", output_files=True) == 0
    assert not os.listdir(tmp_path)


def test_convert_source_outcomes(spark, tmp_path):
    good = put(tmp_path, "good.csv", "a;b\n1;2\n")
    empty = put(tmp_path, "empty.csv", "a;b\n")
    out = f"{tmp_path}/out"
    assert convert_source(spark, good, out, "good") == Outcome("good", "OK", 1, 5)
    assert convert_source(spark, empty, out, "empty").status == "EMPTY"
    assert convert_source(spark, f"{tmp_path}/absent.csv", out, "absent").status == "FAILED"
    unknown = convert_source(spark, good, out, "good", "xlsx")
    assert unknown.status == "FAILED" and "xlsx" in unknown.error


def test_convert_folder_isolates_a_broken_source(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in/one.parquet")
    spark.range(7).write.parquet(f"{tmp_path}/in/two.parquet")
    put(tmp_path, "in/broken.parquet", "not parquet")
    outcomes = convert_folder(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet")
    assert {o.table_name: (o.status, o.n_rows) for o in outcomes} == {
        "broken": ("FAILED", None),
        "one": ("OK", 5),
        "two": ("OK", 7),
    }
    assert failed(outcomes)
    report = as_report(spark, outcomes)
    assert tuple(summary(report).first()) == (3, 2, 0, 1, 66.7)
    assert preview(spark, f"{tmp_path}/out/two").count() == 3
    assert spark.read.parquet(f"{tmp_path}/out/two").columns[-3:] == [
        "conversion_timestamp",
        "source_file",
        "table_name",
    ]


def test_empty_tables_are_no_failure(spark):
    outcomes = [Outcome("a", "OK", 1, 1), Outcome("b", "EMPTY", 0, 1)]
    assert not failed(outcomes)
    assert tuple(summary(as_report(spark, outcomes)).first()) == (2, 1, 1, 0, 50.0)


def test_load_silver_names_all_missing(spark, tmp_path):
    with pytest.raises(MissingTables, match="communes") as error:
        load_silver(spark, str(tmp_path))
    assert all(name in str(error.value) for name in SILVER_TABLES)
    assert load_silver(spark, str(tmp_path), required=()) == {}


def test_check_silver_names_missing_columns(spark):
    tables = {"region": spark.range(1).withColumnRenamed("id", "code_region")}
    with pytest.raises(MissingTables, match="region.iso, region.region"):
        check_silver(tables, ["region"])
    assert set(SILVER_COLUMNS) == set(SILVER_TABLES)


def test_jdbc_scan_is_split():
    options = jdbc_options("jdbc:x", "t", "id", 0, 100, 4, {"user": "u"})
    assert options == {
        "user": "u",
        "url": "jdbc:x",
        "dbtable": "t",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id", 0, 100, 0)


def test_hidden_names_are_reported(spark, tmp_path):
    for name in ("a.csv", "_b.csv", "deep/er/.c.csv", "_dir/d.csv", "big.csv/part-0.csv", "big.csv/_SUCCESS", "_e.csv/part-0.csv"):
        put(tmp_path / "raw", name, "x;y\n1;2\n")
    outcomes = convert_folder(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    assert {o.table_name for o in outcomes if o.status == "OK"} == {"a", "big"}
    hidden = sorted(o.table_name.rpartition("/raw/")[2] for o in outcomes if o.status == "FAILED")
    assert hidden == ["_b.csv", "_dir/d.csv", "_e.csv", "deep/er/.c.csv"]


def test_a_root_named_like_a_part_of_its_path(spark, tmp_path, monkeypatch):
    put(tmp_path / "draw/raw", "visits/a.csv", "x\n1\n")
    assert [r["table_name"] for r in discover(spark, f"{tmp_path}/draw/raw", "csv", "o").collect()] == ["visits_a"]


def test_each_file_has_its_separator(spark, tmp_path):
    put(tmp_path, "f.csv/a.csv", "id;nom\n1;x,y\n")
    put(tmp_path, "f.csv/b.csv", "id,nom\n2,x;y\n3,\n")
    found = read_csv(spark, f"{tmp_path}/f.csv")
    assert content(found) == (["id", "nom"], [(1, "x,y"), (2, "x;y"), (3, None)])


def test_codes_stay_text(spark, tmp_path):
    path = put(tmp_path, "f.csv", "code_commune;n\n01001;1\n75056;02\n")
    assert content(read_csv(spark, path, text_columns=["code_commune"]))[1] == [("01001", 1), ("75056", 2)]


@pytest.mark.parametrize(
    "files, rows",
    [
        ({"a": '{"a":1}\n\n{"a":2}\n{"a":3}\n'}, [1, 2, 3]),
        ({"a": '[{"a":1},\n{"a":2}]', "b": '{"a":3}\n{"a":4}\n\n{"a":5}'}, [1, 2, 3, 4, 5]),
        ({"a": '{\n"a": 1\n}'}, [1]),
        ({"a": '{"a":1}'}, [1]),
        ({"a": '[{"a":1}, {"a":2}]'}, [1, 2]),
    ],
)
def test_json_of_any_layout(spark, tmp_path, files, rows):
    for name, text in files.items():
        put(tmp_path, f"f.json/{name}.json", text)
    assert sorted(r["a"] for r in read_raw(spark, f"{tmp_path}/f.json", "json").collect()) == rows


def test_records_that_do_not_parse_are_counted(spark, tmp_path):
    path = put(tmp_path, "f.json", '{"a":1}\n{"a":2}\n{"a":\n')
    outcome = convert_source(spark, path, f"{tmp_path}/out", "f", "json")
    assert outcome.status == "OK" and "do not parse" in outcome.error


def test_columns_go_by_their_names(spark, tmp_path):
    put(tmp_path, "f.csv/a.csv", "id,name\n1,x\n2,y,z\n")
    put(tmp_path, "f.csv/b.csv", "name;id;more\nw;3;1.5\nv;4\n")
    put(tmp_path, "f.csv/c.csv", "ID,name\n5,007\n")
    put(tmp_path, "f.csv/empty.csv", "")
    source = f"{tmp_path}/f.csv"
    found = read_csv(spark, source, text_columns=["name"])
    rows = sorted(tuple(r) for r in found.select("id", "name", "more").collect())
    assert rows == [(1, "x", None), (2, "y", None), (3, "w", 1.5), (4, "v", None), (5, "007", None)]
    out = f"{tmp_path}/out"
    outcome = convert_source(spark, source, out, "f")
    assert (outcome.status, outcome.n_rows, outcome.n_cols) == ("OK", 5, 7) and outcome.error.startswith("2 records")
    broken = spark.read.parquet(out).where("_corrupt_record is not null")
    assert sorted(r["_corrupt_record"] for r in broken.collect()) == ["2,y,z", "v;4"]


def test_types_that_differ_between_files(spark, tmp_path):
    put(tmp_path, "f.csv/a.csv", "a,b,c\n1,1,1\n")
    put(tmp_path, "f.csv/b.csv", "b,a,c\n2.5,3000000000,x\n")
    found = read_csv(spark, f"{tmp_path}/f.csv")
    assert dict(found.dtypes) == {"a": "bigint", "b": "double", "c": "string"}
    assert sorted(map(tuple, found.collect())) == [(1, 1.0, "1"), (3000000000, 2.5, "x")]


def test_a_known_schema_goes_by_names_too(spark, tmp_path):
    put(tmp_path, "f.csv/a.csv", "code;id\n01;1\n")
    put(tmp_path, "f.csv/b.csv", "id;other\n2;z\n")
    schema = StructType([StructField("id", LongType()), StructField("code", StringType()), StructField("none", StringType())])
    found = read_csv(spark, f"{tmp_path}/f.csv", schema)
    assert found.schema.names == ["id", "code", "none"]
    assert sorted(tuple(r) for r in found.collect()) == [(1, "01", None), (2, None, None)]


def test_values_a_schema_does_not_hold_are_kept(spark, tmp_path):
    path = put(tmp_path, "f.csv", "id;code\n1;x\nabc;y\n")
    schema = StructType([StructField("id", LongType()), StructField("code", StringType())])
    found = read_csv(spark, path, schema, keep_corrupt=True)
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "x", None), (None, "y", "abc;y")]


def test_files_are_told_apart_by_their_first_bytes(spark, tmp_path, monkeypatch):
    from medoria.sources import csv_files

    read = []
    head = csv_files.head
    monkeypatch.setattr(csv_files, "head", lambda s, f, n: read.append(head(s, f, n)) or read[-1])
    put(tmp_path, "f.csv/a [1]{2}.csv", "id;t\n1;" + "é" * 100_000 + "\n")
    put(tmp_path, "f.csv/b.csv", "t,id\n" + "x,2\n" * 50_000)
    found = read_csv(spark, f"{tmp_path}/f.csv")
    assert found.count() == 50_001
    assert [len(x) for x in read] == [csv_files.HEAD_BYTES] * 2


def test_what_replaces_nothing_leaves_what_is_there(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert write_silver(spark.range(3), path) == 3
    assert write_silver(spark.range(0), path) == 0
    assert spark.read.parquet(path).count() == 3


def test_rows_are_counted_as_they_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", None)
    monkeypatch.setattr(type(spark.range(1)), "count", None)
    path = put(tmp_path, "f.csv", "a;b\n1;2\n3;4\n")
    assert convert_source(spark, path, f"{tmp_path}/out", "f") == Outcome("f", "OK", 2, 5)


@pytest.mark.parametrize("split", ["300", "100000"])
def test_arrays_are_cut_into_records(spark, tmp_path, split):
    draw = random.Random(7)

    def text():
        return "".join(draw.choice('{}[]",\\\n:é a') for _ in range(draw.randint(0, 30)))

    rows = [{"id": k, "s": text(), "o": {"p": text(), "l": [text(), "}" * draw.randint(0, 2)]}} for k in range(120)]
    put(tmp_path, "f.json/a.json", json.dumps(rows[:50], ensure_ascii=False))
    put(tmp_path, "f.json/b.json", json.dumps(rows[50:100], indent=2))
    put(tmp_path, "f.json/c.json", "[\n" + ",\n".join(map(json.dumps, rows[100:])) + "\n]\n")
    put(tmp_path, "f.json/d.json", "[]")
    put(tmp_path, "f.json/e.json", "[ {} , {\"id\": -1}]")
    put(tmp_path, "f.json/f.json", '{"id": -2}\n{"id": -3}\n')
    source = f"{tmp_path}/f.json"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = read_json(spark, source, array_bytes=0)
        files = [f"{source}/{n}.json" for n in "abcde"]
        expected = spark.read.json(files, multiLine=True).unionByName(spark.createDataFrame([(-2,), (-3,)], "id long"), allowMissingColumns=True)
        assert sorted(map(str, found.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
        by_file = found.groupBy(F.regexp_extract("_source_file", "([a-z])[.]json$", 1).alias("f")).count()
        assert {r["f"]: r["count"] for r in by_file.collect()} == {"a": 50, "b": 50, "c": 20, "e": 2, "f": 2}
        if split == "300":
            assert array_records(spark, files).where("file like '%/b.json'").count() == 50
            pieces = spark.read.option("lineSep", "}").text(files[1])
            assert pieces.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    "start, kind",
    [
        ('{"a":1}\n{"a":', "lines"),
        ('\n\n{"a":1}\n', "lines"),
        ('[{"a":1},', "array"),
        ('{\n"a": 1,\n"b": 2\n', "whole"),
        ('{"a":\n{"a":1}\n{"a":2}\n', None),
        ("", "lines"),
    ],
)
def test_json_layout_from_the_first_bytes(start, kind):
    assert layout(start.encode(), whole=False) == kind


def test_json_layout_from_all_lines(spark, tmp_path):
    """The first record is broken and the first bytes hold too little to tell."""
    put(tmp_path, "f.json/a.json", '{"a":\n' + '{"a":1}\n' * 20_000)
    put(tmp_path, "f.json/b.json", '{\n"a": 7\n}')
    found = read_json(spark, f"{tmp_path}/f.json")
    rows = found.collect()
    assert sum(r["_corrupt_record"] is not None for r in rows) == 1 and sum(r["a"] is not None for r in rows) == 20_001


def test_a_second_run_converts_what_changed(spark, tmp_path, monkeypatch):
    from medoria.plans import silver

    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for name in "abc":
        put(tmp_path, f"in/{name}.csv", "x;y\n1;2\n")
    put(tmp_path, "in/empty.csv", "x;y\n")
    put(tmp_path, "in/bad.csv/part.csv", "x;y\n1;2\n")
    converted = []
    convert = silver.convert_source
    monkeypatch.setattr(silver, "convert_source", lambda *a, **k: converted.append(a[3]) or convert(*a, **k))

    def run(**settings):
        converted.clear()
        outcomes = silver.convert_folder(spark, source, out, changed_only=True, **settings)
        return sorted(converted), {o.table_name: (o.status, o.n_rows) for o in outcomes}

    every = ["a", "b", "bad", "c", "empty"]
    expected = {"a": ("OK", 1), "b": ("OK", 1), "c": ("OK", 1), "bad": ("OK", 1), "empty": ("EMPTY", 0)}
    assert run() == (every, expected)
    assert run() == ([], expected)
    put(tmp_path, "in/b.csv", "x;y\n1;2\n3;4\n")
    put(tmp_path, "in/bad.csv/other.csv", "x;y\n5;6\n")
    expected |= {"b": ("OK", 2), "bad": ("OK", 2)}
    assert run() == (["b", "bad"], expected)
    # another way of converting, and files that are gone
    assert run(output_files=True) == (every, expected)
    shutil.rmtree(f"{out}/c")
    assert run(output_files=True) == (["c"], expected)
    # a failure is tried again
    monkeypatch.setattr(silver, "read_raw", lambda *a, **k: (_ for _ in ()).throw(UnsupportedFormat("no")))
    put(tmp_path, "in/a.csv", "x;y\n1;2\n7;8\n9;9\n")
    assert run(output_files=True)[0] == ["a"]
    assert run(output_files=True)[0] == ["a"]


def test_a_stamp_tells_states_apart(spark, tmp_path):
    from medoria.files import stamp

    path = put(tmp_path, "f/a.csv", "x")
    before = stamp(spark, path)
    assert before == stamp(spark, str(tmp_path / "f")) and before[0][:2] == ("a.csv", 1)
    put(tmp_path, "f/a.csv", "xy")
    assert stamp(spark, path) != before


def test_pieces_of_arrays_stay_where_they_are(spark, tmp_path, capsys):
    """The sums of the splits go to the pieces, not the pieces to them; records are kept compressed."""
    rows = [{"n": k, "text": f'}}{{"[{k}'} for k in range(300)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "b.json").write_text(json.dumps(rows))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        array_records(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")]).explain()
        found = read_json(spark, str(tmp_path), array_bytes=0)
        files = found.inputFiles()
        assert sorted((r["n"], r["text"]) for r in found.collect()) == sorted((r["n"], r["text"]) for r in rows * 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in capsys.readouterr().out
    assert files and all(f.endswith(".gz") for f in files)
