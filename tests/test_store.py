from __future__ import annotations

import datetime as dt
import os
import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from medoria.__main__ import main
from medoria.config import Settings
from medoria.files import nested
from medoria.plans import questions
from medoria.plans.pipeline import STEPS, build_gold, build_star, create_star, register_star, run_pipeline
from medoria.sinks import (
    create_if_absent,
    databases,
    differences,
    ensure_database,
    fingerprint,
    generations,
    location_of,
    read_table,
    register_all,
    relocate,
    replace_table,
    same_rows,
    tables_in,
    verify_tables,
)
from medoria.sinks import checks
from medoria.sources import MissingTables
from medoria.specs import STAR
from medoria.work import work_path, work_root
from tests.test_star import AS_OF, ROWS, rows


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name)
    yield name
    spark.sql(f"drop database {name} cascade")


@pytest.fixture
def stays(spark):
    """Enough rows for the table to be partitioned."""
    return spark.range(12_000).selectExpr(
        "id as fk_patient",
        "'e1' as fk_etablissement",
        "'A' as fk_diagnostic",
        "cast(20190101 as int) as fk_date_entree",
        "cast(id % 9 as int) as duree_sejour_jours",
        "1 as nb_hospitalisations",
        "case when id % 3 = 0 then null else cast(2015 + id % 5 as int) end as annee",
    )


def silver_frames(spark):
    return {name: spark.createDataFrame(data, schema) for name, (schema, data) in ROWS.items()}


def settings(tmp_path, database, **more):
    return Settings(str(tmp_path / "raw"), str(tmp_path / "lake"), database=database, as_of=AS_OF, **more)


def test_create_if_absent(spark, database, tmp_path):
    spec = STAR["fait_consultations"]
    assert create_if_absent(spark, database, spec, str(tmp_path))
    assert not create_if_absent(spark, database, spec, str(tmp_path))
    table = spark.table(f"{database}.fait_consultations")
    assert table.count() == 0
    assert set(table.dtypes) == {(f.name, f.dataType.simpleString()) for f in spec.schema}
    partitions = [c.name for c in spark.catalog.listColumns(f"{database}.fait_consultations") if c.isPartition]
    assert partitions == ["annee"]


def test_create_keeps_files_that_are_there(spark, database, tmp_path, stays):
    spec = STAR["fait_hospitalisation"]
    stays.write.partitionBy("annee").parquet(f"{tmp_path}/{spec.name}")
    assert create_if_absent(spark, database, spec, str(tmp_path))
    assert spark.table(f"{database}.{spec.name}").count() == 12_000


def test_replace_partitions_large_tables(spark, database, tmp_path, stays):
    spec = STAR["fait_hospitalisation"]
    table = replace_table(stays, database, spec, str(tmp_path))
    assert same_rows(table, stays)
    location = location_of(spark, database, spec.name).removeprefix("file:")
    folders = {name for name in os.listdir(location) if "=" in name}
    assert len(folders) == 6 and "annee=__HIVE_DEFAULT_PARTITION__" in folders


def test_files_are_sorted_for_periods(spark, database, tmp_path, stays):
    spec = STAR["fait_hospitalisation"]
    days = stays.withColumn("fk_date_entree", F.expr("cast(20190100 + fk_patient % 28 as int)"))
    replace_table(days.repartition(4), database, spec, str(tmp_path))
    location = location_of(spark, database, spec.name).removeprefix("file:")
    files = list(Path(location).rglob("*.parquet"))
    assert files
    for file in files:
        keys = pq.read_table(file, columns=[spec.sort_by], partitioning=None)[spec.sort_by].to_pylist()
        assert keys == sorted(keys)


def test_replace_leaves_small_tables_in_one_piece(spark, database, tmp_path, stays):
    spec = STAR["fait_hospitalisation"]
    replace_table(stays.limit(100), database, spec, str(tmp_path))
    location = location_of(spark, database, spec.name).removeprefix("file:")
    assert not [name for name in os.listdir(location) if "=" in name]


@pytest.mark.parametrize("n", [100, 12_000])
def test_replace_a_table_with_itself(spark, database, tmp_path, stays, n):
    spec = STAR["fait_hospitalisation"]
    table = replace_table(stays.limit(n), database, spec, str(tmp_path))
    again = replace_table(table.where("fk_patient % 2 = 0"), database, spec, str(tmp_path))
    assert again.count() == n // 2
    assert spark.table(f"{database}.{spec.name}").count() == n // 2
    assert table.count() == n


def test_replace_across_layouts(spark, database, tmp_path, stays):
    spec = STAR["fait_hospitalisation"]
    for n in (100, 12_000, 50):
        assert replace_table(stays.limit(n), database, spec, str(tmp_path)).count() == n


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    assert same_rows(df, df.repartition(3))
    assert not same_rows(df, df.distinct())
    assert not same_rows(df, spark.createDataFrame([(1, "a"), (2, None), (2, "")], "x int, y string"))
    assert not same_rows(df, spark.createDataFrame([(1, "a"), (2, None), (3, None)], "x int, y string"))
    assert fingerprint(df.limit(0)).first()["n_rows"] == 0


def test_gaps_move_the_fingerprint(spark):
    left = spark.createDataFrame([(None, "a")], "x string, y string")
    right = spark.createDataFrame([("a", None)], "x string, y string")
    assert fingerprint(left).first() != fingerprint(right).first()


def test_differences_name_the_places(spark):
    left = spark.createDataFrame(
        [(1, "a", 2019), (2, None, 2019), (3, "c", 2020), (3, "c", 2020), (4, "d", None)], "k int, y string, annee int"
    )
    place = F.col("k") % 3
    assert differences(left, left.select("y", "annee", "k").repartition(3), ["annee"], place).count() == 0
    assert differences(left, left).count() == 0 and differences(left.limit(0), left.limit(0), ["annee"]).count() == 0

    def found(right, *parts):
        return sorted(map(tuple, differences(left, right, parts, place).collect()), key=str)

    gap = left.withColumn("y", F.when(F.col("k") != 2, F.col("y")).otherwise(""))
    assert found(gap, "annee") == [("bucket", 2019, 2, 1, 1), ("partition", 2019, None, 2, 2), ("table", None, None, 5, 5)]
    assert found(gap) == [("bucket", 2, 1, 1), ("table", None, 5, 5)]
    once = left.distinct()
    assert found(once, "annee") == [("bucket", 2020, 0, 2, 1), ("partition", 2020, None, 2, 1), ("table", None, None, 5, 4)]
    # the missing partition value is a partition of its own; a moved row shows on both sides
    moved = left.withColumn("annee", F.coalesce("annee", F.lit(2021)))
    assert found(moved, "annee") == [
        ("bucket", 2021, 1, 0, 1), ("bucket", None, 1, 1, 0), ("partition", 2021, None, 0, 1),
        ("partition", None, None, 1, 0), ("table", None, None, 5, 5),
    ]
    # a changed row lies in two buckets if these are made of whole rows
    levels = [r["level"] for r in differences(left, gap, buckets=1 << 20).collect()]
    assert sorted(levels) == ["bucket", "bucket", "table"]
    with pytest.raises(ValueError):
        differences(left, left.drop("y"))


def damaged(target, partition):
    """One file of a partition without its first row."""
    (path, *_) = sorted(Path(target).glob(f"{partition}/*.parquet"))
    file = pq.ParquetFile(path).read()
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    pq.write_table(file.slice(1), path)


@pytest.mark.parametrize("partition_by", [[], ["annee"]])
def test_a_damaged_copy_is_reported_by_its_places(spark, database, tmp_path, stays, partition_by, monkeypatch):
    spec = STAR["fait_hospitalisation"]
    replace_table(stays, database, spec, f"{tmp_path}/a")
    before = location_of(spark, database, spec.name)
    read = checks._copy_at

    def damage_and_read(target, source, table_format):
        damaged(target, "annee=2016" if partition_by else ".")
        return read(target, source, table_format)

    monkeypatch.setattr(checks, "_copy_at", damage_and_read)
    outcome = relocate(spark, database, spec.name, f"{tmp_path}/b", partition_by)
    assert (outcome.status, outcome.n_rows) == ("FAILED", 11_999)
    assert location_of(spark, database, spec.name) == before
    places = outcome.error.partition("fait_hospitalisation: ")[2]
    assert places.startswith("annee=2016 (1600 rows, 1599 in the copy)" if partition_by else "bucket=") and ";" not in places


def files_below(folder):
    return sorted(str(p) for p in Path(folder).rglob("*.parquet"))


@pytest.mark.parametrize("partition_by", [[], ["annee"]])
def test_relocate(spark, database, tmp_path, stays, partition_by):
    spec = STAR["fait_hospitalisation"]
    replace_table(stays, database, spec, f"{tmp_path}/a")
    target = f"{tmp_path}/b"
    outcome = relocate(spark, database, spec.name, target, partition_by)
    assert (outcome.status, outcome.n_rows) == ("OK", 12_000)
    assert "/b/generation-" in location_of(spark, database, spec.name)
    assert same_rows(spark.table(f"{database}.{spec.name}").select(*stays.columns), stays)
    for same in (target, f"{target}/", f"file:{target}", f"file://{target}"):
        assert relocate(spark, database, spec.name, same).status == "FAILED"


@pytest.mark.parametrize("place", ["", "/{name}", "/{name}/..", "/{name}/{generation}", "/{name}/{generation}/deeper"])
def test_a_table_is_not_moved_into_or_around_itself(spark, database, tmp_path, stays, place):
    spec = STAR["fait_hospitalisation"]
    replace_table(stays, database, spec, f"{tmp_path}/gold")
    location, before = location_of(spark, database, spec.name), files_below(tmp_path)
    target = f"{tmp_path}/gold" + place.format(name=spec.name, generation=location.rpartition("/")[2])
    outcome = relocate(spark, database, spec.name, target, ["annee"])
    assert outcome.status == "FAILED" and "around" in outcome.error
    assert files_below(tmp_path) == before and location_of(spark, database, spec.name) == location
    assert spark.table(f"{database}.{spec.name}").count() == 12_000


def test_spellings_of_one_place(spark):
    assert nested(spark, "s3a://lake/gold/x", "s3://lake/gold") and nested(spark, "s3n://lake/a/", "s3a://lake/a")
    assert not nested(spark, "s3a://lake/gold", "s3a://lake/golden") and nested(spark, "file:///a/b", "/a/c/../b/d")


def test_a_broken_move_is_reported(spark, database, tmp_path):
    assert relocate(spark, database, "fait_deces", f"{tmp_path}/b").status == "FAILED"


def test_an_empty_table_is_not_moved(spark, database, tmp_path):
    spec = STAR["dim_indicateur"]
    create_if_absent(spark, database, spec, str(tmp_path / "a"))
    assert relocate(spark, database, spec.name, f"{tmp_path}/b").status == "EMPTY"
    assert "/a/dim_indicateur/generation-" in location_of(spark, database, spec.name)


def test_register_all(spark, database, tmp_path, stays):
    stays.write.partitionBy("annee").parquet(f"{tmp_path}/stays")
    stays.limit(0).write.parquet(f"{tmp_path}/none")
    (tmp_path / "hollow").mkdir()
    stays.write.parquet(f"{tmp_path}/mixed")
    stays.write.mode("append").partitionBy("annee").parquet(f"{tmp_path}/mixed")
    locations = {
        "fait_hospitalisation": f"{tmp_path}/stays",
        "dim_lieu": f"{tmp_path}/absent",
        "dim_date": f"{tmp_path}/hollow",
        "dim_patient": f"{tmp_path}/none",
        "fait_deces": f"{tmp_path}/mixed",
    }
    outcomes = {o.table_name: o.status for o in register_all(spark, database, locations)}
    assert outcomes == {
        "fait_hospitalisation": "OK",
        "dim_lieu": "FAILED",
        "dim_date": "FAILED",
        "dim_patient": "EMPTY",
        "fait_deces": "FAILED",
    }
    found = {row["tableName"] for row in tables_in(spark, database).collect()}
    assert found == {"fait_hospitalisation", "dim_patient"}
    assert database in [row[0] for row in databases(spark).collect()]
    sql = f"select sum(nb_hospitalisations) n from {database}.fait_hospitalisation where annee = 2016"
    expected = stays.where("annee = 2016").count()
    assert questions.query(spark, sql).first()["n"] == expected


def test_the_newest_complete_generation_counts(spark, database, tmp_path, stays):
    spec, root = STAR["fait_hospitalisation"], f"{tmp_path}/gold"
    for n in (10, 12_000, 30, 40):
        replace_table(stays.limit(n), database, spec, root, keep=2)
    folder = f"{root}/{spec.name}"
    assert len(generations(spark, folder)) == 2
    assert read_table(spark, spec, root).count() == 40
    # a write that broke off is passed over
    os.remove(f"{generations(spark, folder)[-1]}/_SUCCESS")
    assert read_table(spark, spec, root).count() == 30
    with pytest.raises(FileNotFoundError):
        read_table(spark, STAR["fait_deces"], root)


def test_the_star_is_found_again_by_its_files(spark, database, tmp_path):
    cfg = settings(tmp_path, database)
    build_gold(spark, silver_frames(spark), cfg)
    before = rows(verify_tables(spark, database, STAR))
    for name in STAR:
        spark.sql(f"drop table {database}.{name}")
    outcomes = register_star(spark, cfg)
    assert {o.status for o in outcomes} == {"OK"}
    assert rows(verify_tables(spark, database, STAR)) == before
    assert {o.status for o in register_star(spark, cfg)} == {"OK"}  # once more changes nothing


def test_a_broken_table_does_not_stop_the_others(spark, database, tmp_path):
    t = silver_frames(spark)
    t["region"] = t["region"].withColumn("region", F.raise_error(F.lit("broken on purpose")).cast("string"))
    gold, outcomes = build_star(spark, t, settings(tmp_path, database))
    status = {o.table_name: o.status for o in outcomes}
    assert len(status) == len(STAR) and status["fait_consultations"] == "OK"
    broken = {name for name, s in status.items() if s == "FAILED"}
    assert broken == {"dim_lieu", "dim_etablissement", "fait_deces", "fait_satisfaction"}
    errors = {o.table_name: o.error for o in outcomes}
    assert "broken on purpose" in errors["dim_lieu"] and "dim_lieu failed" in errors["fait_deces"]


def test_verify_tables(spark, database, tmp_path):
    for name in ("dim_indicateur", "dim_lieu"):
        create_if_absent(spark, database, STAR[name], str(tmp_path))
    spark.sql(f"insert into {database}.dim_indicateur values (1, 'x')")
    full = verify_tables(spark, database, ["dim_indicateur", "dim_lieu", "dim_date"])
    found = full.drop("error")
    assert rows(found) == sorted(
        [("dim_indicateur", "OK", 1, 2), ("dim_lieu", "EMPTY", 0, 4), ("dim_date", "FAILED", None, None)],
        key=repr,
    )
    assert "dim_date" in full.where("status = 'FAILED'").first()["error"]


def test_build_gold_twice_gives_the_same(spark, database, tmp_path):
    cfg = settings(tmp_path, database)
    t = silver_frames(spark)
    create_star(spark, cfg)
    first = build_gold(spark, t, cfg)
    second = build_gold(spark, {name: df.repartition(3) for name, df in t.items()}, cfg)
    assert set(first) == set(STAR)
    for name in STAR:
        assert first[name].exceptAll(second[name]).isEmpty()
        assert second[name].exceptAll(first[name]).isEmpty()


def test_build_gold_stops_early(spark, database, tmp_path):
    t = silver_frames(spark)
    del t["communes"], t["deces"]
    with pytest.raises(MissingTables, match="deces, communes"):
        build_gold(spark, t, settings(tmp_path, database))


def write_raw(spark, folder, skip=()):
    from medoria.sources.silver import SILVER_TABLES

    for number, (role, df) in enumerate(silver_frames(spark).items()):
        if role in skip:
            continue
        path = f"{folder}/{SILVER_TABLES[role].replace('_', '/', 1)}.csv"
        df.coalesce(1).write.option("header", True).option("sep", ";,"[number % 2]).csv(path)


def test_questions_read_only_the_period(spark, database, tmp_path, capsys):
    visits = spark.range(12_000).selectExpr(
        "id as fk_patient",
        "'p' as fk_professionnel",
        "cast(20150101 + 10000 * (id % 5) as int) as fk_date_consultation",
        "'A' as fk_diagnostic",
        "'e' as fk_etablissement",
        "1 as nb_consultations",
        "cast(2015 + id % 5 as int) as annee",
    )
    fact = replace_table(visits, database, STAR["fait_consultations"], str(tmp_path))
    rates = questions.consultation_rate(
        fact, "fk_diagnostic", dt.date(2016, 1, 1), dt.date(2017, 6, 1)
    )
    assert rates.first()["n"] == 4800
    rates.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(annee" in plan
    assert "GreaterThanOrEqual(fk_date_consultation,20160101)" in plan
    read = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "fk_professionnel" not in read and "fk_etablissement" not in read


def test_pipeline_from_raw_files(spark, database, tmp_path):
    cfg = settings(tmp_path, database, relocate_to=str(tmp_path / "moved"))
    write_raw(spark, cfg.source_root)
    report = run_pipeline(spark, cfg)
    assert {outcome.status for _, outcome in report} == {"OK"}
    assert [step for step in dict.fromkeys(step for step, _ in report)] == list(STEPS)
    counts = {outcome.table_name: outcome.n_rows for step, outcome in report if step == "verify"}
    assert counts["fait_consultations"] == 7 and counts["dim_lieu"] == 4 and counts["fait_deces"] == 6
    deaths = questions.deaths_by_region(
        spark.table(f"{database}.fait_deces"), spark.table(f"{database}.dim_lieu"), 2019
    )
    assert rows(deaths) == sorted([("Ain", 2), ("Corse", 1), (None, 1)], key=repr)
    assert "/moved/" in location_of(spark, database, "fait_deces")


def test_pipeline_ends_at_a_failed_step(spark, database, tmp_path):
    cfg = settings(tmp_path, database, file_format="parquet")
    spark.range(3).write.parquet(f"{cfg.source_root}/good.parquet")
    (tmp_path / "raw" / "bad.parquet").write_text("x")
    report = run_pipeline(spark, cfg)
    assert [(step, o.table_name, o.status) for step, o in report] == [
        ("convert", "bad", "FAILED"),
        ("convert", "good", "OK"),
    ]


def test_command_line(spark, database, tmp_path, monkeypatch, capsys):
    # work tables of their own, so that discarding them leaves those of other tests
    monkeypatch.setattr("medoria.work._own_folder", lambda spark: f"{tmp_path}/work")
    write_raw(spark, tmp_path / "raw")
    arguments = ["--source", f"{tmp_path}/raw", "--output", f"{tmp_path}/lake", "--database", database]
    assert main([*arguments, "--as-of", "2021-03-01", "--steps", "convert", "declare", "build"]) == 0
    assert spark.table(f"{database}.fait_consultations").count() == 7
    assert not os.path.exists(f"{tmp_path}/work")
    assert "fait_consultations" in capsys.readouterr().out
    assert main([*arguments, "--format", "json", "--steps", "verify"]) == 0
    assert main(["--source", f"{tmp_path}/raw", "--output", "x", "--database", "absent", "--steps", "verify"]) == 1


def test_missing_silver_tables_stop_the_run(spark, database, tmp_path):
    cfg = settings(tmp_path, database)
    write_raw(spark, cfg.source_root, skip=("communes",))
    step, outcome = run_pipeline(spark, cfg)[-1]
    assert (step, outcome.status) == ("build", "FAILED") and "communes" in outcome.error


def test_settings(monkeypatch):
    monkeypatch.setenv("SOURCE_FOLDER", "/in")
    monkeypatch.setenv("TARGET_BUCKET", "lake")
    cfg = Settings.from_env()
    assert (cfg.source_root, cfg.output_root, cfg.file_format) == ("/in", "s3a://lake", "csv")
    assert Settings.from_env(output_root="/out/").gold_root == "/out/gold"
    monkeypatch.delenv("SOURCE_FOLDER")
    with pytest.raises(ValueError):
        Settings.from_env()


def test_only_a_local_session_may_go_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr("medoria.work.FOLDER_SETTING", "spark.checkpoint.absent")
    root = work_root(spark)
    assert os.path.isdir(root) and work_root(spark) == root

    class Context:
        master = "spark://head:7077"

    class OnCluster:
        conf, sparkContext = spark.conf, Context()

    with pytest.raises(ValueError, match="spark.checkpoint.absent"):
        work_root(OnCluster())


def test_work_paths_are_in_the_shared_folder(spark):
    root = work_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x").startswith(root)
    assert work_path(spark, "x") != work_path(spark, "x")
