"""Registered queries: each runs an operator or a question over whole given tables."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from medoria.config import Settings
from medoria.files import stamp
from medoria.functions import age_at, clean_name, date_key, output_files, size_mb, table_name_of
from medoria.operators import dense_number, partition_advice, unique_names
from medoria.parallel import together
from medoria.plans import dimensions, facts, patient_sets, questions
from medoria.plans.pipeline import build_gold, create_star, register_star, run_pipeline
from medoria.plans.silver import convert_folder, convert_source, preview
from medoria.sinks import (
    as_report,
    differences,
    ensure_database,
    failed,
    newest,
    read_table,
    register_all,
    relocate,
    replace_table,
    summary,
    tables_in,
    verify_tables,
    write_bucketed,
)
from medoria.sinks.catalog import databases
from medoria.sources import SILVER_TABLES, discover, load_silver, read_json
from medoria.specs import STAR
from medoria.work import materialise, scratch, work_path
from workload.bindings import AS_OF, BINDINGS, CUT_END, CUT_START, END, START, TABLES, YEAR, silver, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

PLACES = ("etablissement_sante", "communes", "region")
ETABLISSEMENTS = ("1", "2", "3")
BUCKETS = 16
SURVEYS = ("satisfaction_esatis", "satisfaction_esatisca")


def register(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def _settings(spark: SparkSession, source_root: str = "-", file_format: str = "csv") -> Settings:
    """A database and folder of its own for each run."""
    return Settings(
        source_root=source_root,
        output_root=work_path(spark, "lake"),
        file_format=file_format,
        database=f"star_{uuid.uuid4().hex[:12]}",
        as_of=AS_OF,
        survey_year=YEAR,
    )


def _written(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The roles as a lake has them: those that come of a join are written once, so what reads them does not join again."""
    return {role: materialise(df, role) if " join " in BINDINGS[role] else df for role, df in t.items()}


# Dimensions


@register
def dim_lieu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_lieu(silver(spark, sf_dir, "communes", "region"))


@register
def dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_patient(silver(spark, sf_dir, "patient"), AS_OF)


@register
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, "hospitalisation", "consultations", "deces", "patient")
    return dimensions.dim_date(t, [YEAR])


@register
def dim_etablissement(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, *PLACES)
    return dimensions.dim_etablissement(t)


@register
def dim_diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, "consultations", "hospitalisation", "diagnostic")
    return dimensions.dim_diagnostic(t)


@register
def bridge_diagnostic_motif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.bridge_diagnostic_motif(silver(spark, sf_dir, "consultations", "diagnostic"))


@register
def dim_professionel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_professionel(silver(spark, sf_dir, "professionnel_sante"))


@register
def dim_indicateur(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicators with the number of survey lines that carry each."""
    lines = fait_satisfaction(spark, sf_dir).groupBy(F.col("fk_indicateur").alias("indicateur_id"))
    return dimensions.dim_indicateur(spark).join(
        lines.agg(F.count(F.lit(1)).alias("nb_mesures")), "indicateur_id", "left"
    )


# Facts


@register
def fait_deces(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, "deces", "communes", "region")
    return facts.fait_deces(t, dimensions.dim_lieu(t))


@register
def fait_hospitalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fait_hospitalisation(silver(spark, sf_dir, "hospitalisation"))


def _stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stays for a writer that reads them more than once."""
    return facts.fait_hospitalisation(_written(spark, silver(spark, sf_dir, "hospitalisation")))


@register
def fait_satisfaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, *SURVEYS, *PLACES)
    return facts.fait_satisfaction(t, dimensions.dim_etablissement(t), YEAR)


@register
def fait_consultations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fait_consultations(silver(spark, sf_dir, "consultations", "activite_professionel"))


@register
def bridge_consultation_etablissement(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, "consultations", "activite_professionel")
    return facts.bridge_consultation_etablissement(t)


# Business questions, over facts and dimensions as they are stored


# by application, folder and table: the root of the stored table, and what the given tables were then
_GOLD: dict[tuple[str, str, str], tuple[str, tuple]] = {}


def _stored(spark: SparkSession, sf_dir: str, **build: Callable[[], DataFrame]) -> list[DataFrame]:
    """Gold tables as a user of the star reads them, in the order given.

    A session builds and stores each once per state of the given tables; questions then share it.
    """
    state = tuple(stamp(spark, f"{sf_dir}/{name}.parquet") for name in TABLES)

    def find(one: tuple[str, Callable[[], DataFrame]]) -> DataFrame:
        spec = STAR[one[0]]
        key = (spark.sparkContext.applicationId, sf_dir, spec.name)
        root, then = _GOLD.get(key, ("", ()))
        if then != state or newest(spark, f"{root}/{spec.name}") is None:
            cfg = _settings(spark)
            ensure_database(spark, cfg.database, cfg.database_root)
            with scratch(spark):
                replace_table(one[1](), cfg.database, spec, cfg.gold_root)
            root = cfg.gold_root
            _GOLD[key] = (root, state)
        return read_table(spark, spec, root)

    return together(find, build.items())


def store_gold(spark: SparkSession, sf_dir: str) -> None:
    """Build and store whatever the questions read, so that a question alone can be timed."""
    t = silver(spark, sf_dir)
    (places, establishments) = _stored(
        spark,
        sf_dir,
        dim_lieu=lambda: dimensions.dim_lieu(t),
        dim_etablissement=lambda: dimensions.dim_etablissement(t),
    )
    _stored(
        spark,
        sf_dir,
        fait_deces=lambda: facts.fait_deces(t, places),
        fait_satisfaction=lambda: facts.fait_satisfaction(t, establishments, YEAR),
        fait_consultations=lambda: facts.fait_consultations(t),
        fait_hospitalisation=lambda: _stays(spark, sf_dir),
        dim_patient=lambda: dimensions.dim_patient(t, AS_OF),
        dim_professionel=lambda: dimensions.dim_professionel(t),
    )


@register
def consult_by_etablissement(spark: SparkSession, sf_dir: str) -> DataFrame:
    (fact,) = _stored(spark, sf_dir, fait_consultations=lambda: fait_consultations(spark, sf_dir))
    return questions.consultation_rate(fact, "fk_etablissement", START, END)


@register
def consult_one_etablissement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some establishments alone; their shares still refer to all."""
    (fact,) = _stored(spark, sf_dir, fait_consultations=lambda: fait_consultations(spark, sf_dir))
    return questions.consultation_rate(fact, "fk_etablissement", START, END, only=ETABLISSEMENTS)


@register
def consult_by_diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    (fact,) = _stored(spark, sf_dir, fait_consultations=lambda: fait_consultations(spark, sf_dir))
    return questions.consultation_rate(fact, "fk_diagnostic", START, END)


@register
def hosp_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, "patient")
    stays, people = _stored(
        spark,
        sf_dir,
        fait_hospitalisation=lambda: _stays(spark, sf_dir),
        dim_patient=lambda: dimensions.dim_patient(t, AS_OF),
    )
    return questions.hospitalisation_rate(stays, people, START, END)


@register
def hosp_by_diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    (stays,) = _stored(spark, sf_dir, fait_hospitalisation=lambda: _stays(spark, sf_dir))
    return questions.hospitalisation_by(stays, "fk_diagnostic", START, END)


@register
def hosp_by_sexe_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, "patient")
    stays, people = _stored(
        spark,
        sf_dir,
        fait_hospitalisation=lambda: _stays(spark, sf_dir),
        dim_patient=lambda: dimensions.dim_patient(t, AS_OF),
    )
    return questions.hospitalisation_by_patient(stays, people, ["sexe", "age"])


def _visit_sets(spark: SparkSession, sf_dir: str, by: str) -> patient_sets.PatientSets:
    """The sets of the stored visits; patients of later years are numbered after those of earlier ones."""
    (fact,) = _stored(spark, sf_dir, fait_consultations=lambda: fait_consultations(spark, sf_dir))
    early = patient_sets.patient_numbers(fact.where(F.col("annee") < CUT_START.year))
    numbers = patient_sets.patient_numbers(fact, early)
    return patient_sets.write_patient_sets(
        fact, numbers, [by], "fk_date_consultation", "nb_consultations", work_path(spark, "sets")
    )


@register
def sets_by_etablissement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A period that begins and ends inside months, from sets of patients."""
    return patient_sets.visit_rate(_visit_sets(spark, sf_dir, "fk_etablissement"), CUT_START, CUT_END)


@register
def sets_by_profession(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets kept per professional, united per profession."""
    people = dimensions.dim_professionel(silver(spark, sf_dir, "professionnel_sante"))
    names = people.select(F.col("professionnel_id").alias("fk_professionnel"), "profession")
    sets = _visit_sets(spark, sf_dir, "fk_professionnel")
    return patient_sets.visit_rate(
        patient_sets.united_by(sets, names, "fk_professionnel", "profession"), CUT_START, CUT_END
    )


@register
def sets_hosp_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients with a stay in a period, from the sets of its months."""
    t = silver(spark, sf_dir, "patient")
    stays, people = _stored(
        spark,
        sf_dir,
        fait_hospitalisation=lambda: _stays(spark, sf_dir),
        dim_patient=lambda: dimensions.dim_patient(t, AS_OF),
    )
    numbers = patient_sets.patient_numbers(stays)
    sets = patient_sets.write_patient_sets(
        stays, numbers, [], "fk_date_entree", "nb_hospitalisations", work_path(spark, "sets")
    )
    return patient_sets.stay_rate(sets, people, CUT_START, CUT_END)


@register
def hosp_by_patient_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays and patients in buckets of the patient: neither is shuffled to be joined."""
    t = silver(spark, sf_dir, "patient")
    stays, people = _stored(
        spark,
        sf_dir,
        fait_hospitalisation=lambda: _stays(spark, sf_dir),
        dim_patient=lambda: dimensions.dim_patient(t, AS_OF),
    )
    cfg = _settings(spark)
    ensure_database(spark, cfg.database, cfg.database_root)

    def kept(name: str, rows: DataFrame, key: str) -> DataFrame:
        return write_bucketed(rows, cfg.database, name, f"{cfg.gold_root}/{name}", key, BUCKETS)

    return questions.hospitalisation_by_patient(
        kept("stays", questions.stays_per_patient(stays), "fk_patient"), kept("people", people, "patient_id")
    )


@register
def consult_by_professionnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, "consultations", "activite_professionel", "professionnel_sante")
    visits, people = _stored(
        spark,
        sf_dir,
        fait_consultations=lambda: facts.fait_consultations(t),
        dim_professionel=lambda: dimensions.dim_professionel(t),
    )
    return questions.consultation_rate_by_professional(visits, people, START, END)


@register
def deces_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, "deces", "communes", "region")
    (places,) = _stored(spark, sf_dir, dim_lieu=lambda: dimensions.dim_lieu(t))
    (deaths,) = _stored(spark, sf_dir, fait_deces=lambda: facts.fait_deces(t, places))
    return questions.deaths_by_region(deaths, places, YEAR)


@register
def satisfaction_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir, *SURVEYS, *PLACES)
    (places,) = _stored(spark, sf_dir, dim_etablissement=lambda: dimensions.dim_etablissement(t))
    (lines,) = _stored(spark, sf_dir, fait_satisfaction=lambda: facts.fait_satisfaction(t, places, YEAR))
    return questions.satisfaction_by_region(lines, places, YEAR)


# Column functions and keys


@register
def date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", date_key(F.col("l_shipdate")).alias("date_id"))


@register
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_name", "p_partkey")
    return dense_number(parts, ["p_name", "p_partkey"], "part_id")


@register
def ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = silver(spark, sf_dir, "patient")["patient"]
    return people.select("id_patient", age_at(F.col("date_naissance"), AS_OF).alias("age"))


@register
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents")
    return texts.select("doc_id", clean_name(F.col("text")).alias("name"))


@register
def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web addresses as paths: folders and file stem become a table name."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", table_name_of(F.col("url")).alias("name"))


@register
def dedup_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", clean_name(F.col("p_name")).alias("base"))
    return unique_names(parts, "base", ["p_partkey"], "name").select("p_partkey", "name")


@register
def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents")
    return texts.select("doc_id", size_mb(F.octet_length("text")).alias("size_mb"))


@register
def output_files_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output files each given table would get in silver."""
    counts = [
        table(spark, sf_dir, name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("n_files", output_files(F.col("n_rows")))


@register
def output_files_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule over numbers on both sides of each bound: a hundred rows per byte of text."""
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length("text").cast("bigint") * 100).alias("n"))
    return rows.select("doc_id", output_files(F.col("n")).alias("n_files"))


@register
def partition_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which gold tables are large enough to be partitioned by their column."""
    t = silver(spark, sf_dir)
    built = {
        "dim_patient": dimensions.dim_patient(t, AS_OF),
        "dim_date": dimensions.dim_date(t, [YEAR]),
        "dim_etablissement": dimensions.dim_etablissement(t),
        "fait_hospitalisation": facts.fait_hospitalisation(t),
        "fait_consultations": facts.fait_consultations(t),
    }
    rows = [
        partition_advice(df, STAR[name].adaptive_by).withColumn("table_name", F.lit(name))
        for name, df in built.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# Raw files to silver


def _export_csv(df: DataFrame, folder: str, name: str, sep: str) -> str:
    path = f"{folder}/{name}.csv"
    # the writer's own way to format days takes a quarter of the time of the export
    df = df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType == DateType()})
    df.write.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return path


def _converted(
    spark: SparkSession, source: str, name: str, file_format: str, like: DataFrame | None = None
) -> DataFrame:
    """The silver table of a source without the time of conversion and its path.

    Integers are inferred as narrow as the values allow; with ``like`` they
    get the width they have there.
    """
    target = work_path(spark, f"silver-{name}")
    outcome = convert_source(spark, source, target, name, file_format)
    if outcome.status != "OK":
        raise RuntimeError(outcome.error or outcome.status)
    rows = spark.read.parquet(target).drop("conversion_timestamp", "source_file")
    if like is None:
        return rows
    return rows.select(*[F.col(c).cast(kind) for c, kind in like.dtypes], "table_name")


@register
def silver_csv_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    source = _export_csv(customers, work_path(spark, "raw"), "customer", ";")
    return _converted(spark, source, "customer", "csv", like=customers)


@register
def silver_csv_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    source = _export_csv(orders, work_path(spark, "raw"), "orders", ",")
    return _converted(spark, source, "orders", "csv", like=orders)


@register
def silver_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of day survive the way through CSV."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    source = _export_csv(events, work_path(spark, "raw"), "events", ",")
    found = _converted(spark, source, "events", "csv")
    return found.select(
        F.col("event_id").cast("bigint"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "table_name"
    )


@register
def silver_csv_one_column_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many commas inside the values as semicolons between them: the first guess is wrong."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(",", "p_name", "p_brand", "p_type").alias("p_label")
    )
    source = _export_csv(parts, work_path(spark, "raw"), "part", ";")
    return _converted(spark, source, "part", "csv", like=parts)


@register
def silver_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pretty-printed JSON arrays with nested values, at most ten thousand rows per file."""
    source = f"{work_path(spark, 'raw')}/customer.json"
    customers = dense_number(table(spark, sf_dir, "customer"), ["c_custkey"], "_number")
    rows = customers.select(
        F.floor((F.col("_number") - 1) / 10_000).alias("chunk"),
        F.struct(
            "c_custkey",
            "c_name",
            F.struct("c_nationkey", "c_mktsegment").alias("place"),
            F.array("c_acctbal").alias("amounts"),
        ).alias("row"),
    )
    arrays = rows.groupBy("chunk").agg(
        F.to_json(F.collect_list("row"), {"pretty": "true"}).alias("value")
    )
    arrays.write.partitionBy("chunk").text(source)
    return _converted(spark, source, "customer", "json").select(
        "c_custkey",
        "c_name",
        F.col("place.c_nationkey").cast("int").alias("nation"),
        F.col("place.c_mktsegment").alias("segment"),
        F.col("amounts")[0].alias("amount"),
        "table_name",
    )


@register
def silver_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _converted(spark, f"{sf_dir}/lineitem.parquet", "lineitem", "parquet")
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@register
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document ids as files by language and source, under folder names that collide once cleaned."""
    ids = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("value"),
        F.concat("lang", F.when(F.col("doc_id") % 2 == 0, " ").otherwise("-"), "source", F.lit(".csv")).alias("t"),
    )
    root = f"{work_path(spark, 'draw')}/raw"
    ids.repartition("t").write.partitionBy("t").csv(root)
    return discover(spark, root, "csv", "silver").drop("source_path")


@register
def silver_json_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder with files of an object per line, blank lines among them, and files of pretty arrays."""
    source = f"{work_path(spark, 'raw')}/customer.json"
    customers = table(spark, sf_dir, "customer")
    row = F.struct("c_custkey", "c_name")
    lines = customers.where("c_custkey % 2 = 0").select(
        F.concat(F.when(F.col("c_custkey") % 3 == 0, "\n").otherwise(""), F.to_json(row)).alias("value")
    )
    lines.write.text(f"{source}/lines")
    numbered = dense_number(customers.where("c_custkey % 2 = 1"), ["c_custkey"], "_number")
    arrays = numbered.groupBy(F.floor((F.col("_number") - 1) / 10_000).alias("chunk")).agg(
        F.to_json(F.collect_list(row), {"pretty": "true"}).alias("value")
    )
    arrays.write.partitionBy("chunk").text(f"{source}/arrays")
    return _converted(spark, source, "customer", "json")


@register
def silver_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder whose files have their columns in other orders, one too few and one too many, and other separators."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    third = F.pmod("o_orderkey", F.lit(3))
    source = f"{work_path(spark, 'raw')}/orders.csv"
    parts = [
        (["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"], ","),
        (["o_totalprice", "o_orderkey", "o_custkey"], ";"),
        (["o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey", "o_totalprice"], ","),
    ]
    for k, (columns, separator) in enumerate(parts):
        _export_csv(orders.where(third == k).select(columns), source, f"part{k}", separator)
    found = _converted(spark, source, "orders", "csv")
    like = [f for f in orders.dtypes if f[0] in found.columns]
    return found.select(*[F.col(c).cast(kind) for c, kind in like], "table_name")


@register
def silver_csv_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a cell too many or too few: what they hold is kept, their text and number are reported."""
    source = f"{work_path(spark, 'raw')}/supplier.csv"
    cells = [F.col(c).cast("string") for c in ("s_suppkey", "s_name", "s_nationkey")]
    more = F.when(F.col("s_suppkey") % 7 == 0, F.concat_ws(",", *cells, F.lit("more")))
    less = more.when(F.col("s_suppkey") % 7 == 1, F.concat_ws(",", *cells[:2]))
    line = less.otherwise(F.concat_ws(",", *cells))
    # every file begins with a header
    suppliers = table(spark, sf_dir, "supplier").select(line.alias("s_suppkey,s_name,s_nationkey"))
    suppliers.write.option("header", True).option("quote", "").option("sep", "\t").csv(source)
    target = work_path(spark, "silver-supplier")
    outcome = convert_source(spark, source, target, "supplier", "csv")
    if outcome.status != "OK":
        raise RuntimeError(outcome.error or outcome.status)
    reported = F.regexp_extract(F.lit(outcome.error or ""), "^([0-9]+) records", 1).cast("bigint")
    return spark.read.parquet(target).select(
        F.col("s_suppkey").cast("bigint").alias("s_suppkey"),
        "s_name",
        F.col("s_nationkey").cast("int").alias("s_nationkey"),
        F.col("_corrupt_record").alias("broken"),
        reported.alias("n_broken"),
    )


@register
def silver_text_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types cannot be inferred by a pattern that Spark refuses: every column is text."""
    events = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    source = _export_csv(events, work_path(spark, "raw"), "events", ";")
    target = work_path(spark, "silver-events")
    outcome = convert_source(spark, source, target, "events", "csv", options={"timestampFormat": "yyyy-MM-dd'T"})
    if outcome.status != "OK":
        raise RuntimeError(outcome.error or outcome.status)
    return spark.read.parquet(target).select("event_id", "ts", "table_name")


@register
def silver_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays cut into their elements by many tasks; texts hold braces, quotes and line ends."""
    source = f"{work_path(spark, 'raw')}/documents.json"
    docs = table(spark, sf_dir, "documents")
    files = max(1, -(-docs.count() // 500))
    text = F.concat(F.lit('{"[\n\\'), F.coalesce("text", F.lit("")), F.lit('\\"}],'))
    row = F.struct("doc_id", F.struct(text.alias("text"), F.array("lang").alias("langs")).alias("body"))
    # every second file is pretty, the others are one line
    arrays = docs.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(files)).alias("chunk")).agg(F.collect_list(row).alias("rows"))
    pretty = F.when(F.col("chunk") % 2 == 0, F.to_json("rows", {"pretty": "true"})).otherwise(F.to_json("rows"))
    arrays.select("chunk", pretty.alias("value")).write.partitionBy("chunk").text(source)
    found = read_json(spark, source, array_bytes=0)
    return found.select("doc_id", F.md5(F.col("body.text").cast("binary")).alias("text_md5"), F.col("body.langs")[0].alias("lang"))


@register
def silver_source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file each row came from, of a folder with a file per nation."""
    source = f"{work_path(spark, 'raw')}/customer.csv"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("nation"))
    customers.repartition("nation").write.option("header", True).partitionBy("nation").csv(source)
    target = work_path(spark, "silver-customer")
    outcome = convert_source(spark, source, target, "customer", "csv")
    if outcome.status != "OK":
        raise RuntimeError(outcome.error or outcome.status)
    nation = F.regexp_extract("source_file", "nation=([0-9]+)/[^/]+[.]csv$", 1).cast("int")
    return preview(spark, target, outcome.n_rows).select(F.col("c_custkey").cast("bigint"), nation.alias("nation"))


@register
def silver_text_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are known to be codes stay text; no value is looked at for its type."""
    raw = table(spark, sf_dir, "supplier").select(
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("code_commune"),
        F.col("s_nationkey").alias("code_region"),
    )
    name = SILVER_TABLES["communes"]
    return _converted(spark, _export_csv(raw, work_path(spark, "raw"), name, ";"), name, "csv")


@register
def unknown_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A format no reader knows fails for its table, whatever the others do; rows are those of the table."""
    outcomes = []
    for name in ("region", "nation"):
        source = f"{sf_dir}/{name}.parquet"
        for file_format in ("parquet", "xlsx"):
            target = work_path(spark, f"silver-{name}")
            outcomes.append(convert_source(spark, source, target, f"{name}_{file_format}", file_format))
    return as_report(spark, outcomes).select("table_name", "status", "n_rows")


@register
def leading_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths per place from raw files in which only one table's codes hold letters."""
    code = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    codes = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("2A"), code)).otherwise(code)
    t = silver(spark, sf_dir, "region")
    raw = {
        "communes": table(spark, sf_dir, "customer").select(
            codes.alias("code_commune"), F.col("c_nationkey").alias("code_region")
        ),
        "deces": table(spark, sf_dir, "events").select(
            F.col("ts").cast("date").alias("date_deces"),
            F.lpad((F.col("user_id") * 11).cast("string"), 8, "0").alias("code_commune"),
        ),
        "region": t["region"],
    }
    folder = _raw_folder(spark, {SILVER_TABLES[role].replace("_", "/", 1): df for role, df in raw.items()})
    target = work_path(spark, "silver")
    outcomes = convert_folder(spark, folder, target)
    if failed(outcomes):
        raise RuntimeError(str(outcomes))
    found = load_silver(spark, target, raw)
    places = dimensions.dim_lieu(found)
    deaths = facts.fait_deces(found, places).groupBy("fk_lieu_deces").agg(F.sum("nb_deces").alias("n"))
    known = places.select(F.col("lieu_id").alias("fk_lieu_deces"), "commune")
    return deaths.join(known, "fk_lieu_deces", "left").select("commune", "n")


def _raw_folder(spark: SparkSession, tables: dict[str, DataFrame]) -> str:
    """Each table as CSV; ``a/b`` puts it into a folder. Separators alternate."""
    folder = work_path(spark, "raw")
    separators = itertools.cycle(";,")
    together(
        lambda one: _export_csv(one[1], folder, one[0], one[2]),
        [(name, df, next(separators)) for name, df in tables.items()],
    )
    return folder


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("region", "nation", "customer", "supplier", "part", "lineitem")
    folder = _raw_folder(spark, {name: table(spark, sf_dir, name) for name in names})
    return as_report(spark, convert_folder(spark, folder, work_path(spark, "silver")))


@register
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@register
def second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run over a folder in which one source of four has got further files."""
    names = ("region", "nation", "customer", "supplier")
    folder = _raw_folder(spark, {name: table(spark, sf_dir, name) for name in names})
    target = work_path(spark, "silver")
    made = F.max("conversion_timestamp").alias("at")

    def times() -> DataFrame:
        one = [spark.read.parquet(f"{target}/{name}").agg(F.lit(name).alias("table_name"), made) for name in names]
        return spark.createDataFrame(reduce(DataFrame.unionByName, one).collect(), "table_name string, at timestamp")

    first = convert_folder(spark, folder, target, changed_only=True)
    before = times()
    table(spark, sf_dir, "nation").write.mode("append").option("header", True).option("sep", ",").csv(f"{folder}/nation.csv")
    second = convert_folder(spark, folder, target, changed_only=True)
    if failed(first) or failed(second):
        raise RuntimeError(str(first + second))
    again = before.join(times().withColumnRenamed("at", "now"), "table_name")
    report = as_report(spark, second).select("table_name", "status", "n_rows")
    return report.join(again.select("table_name", (F.col("now") > F.col("at")).alias("converted_again")), "table_name")


@register
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six good sources, one without rows and one whose name Spark hides."""
    names = ("region", "nation", "customer", "supplier", "part", "lineitem")
    tables = {name: table(spark, sf_dir, name) for name in names}
    tables |= {"nobody": tables["customer"].where("false"), "_hidden": tables["region"]}
    folder = _raw_folder(spark, tables)
    return summary(as_report(spark, convert_folder(spark, folder, work_path(spark, "silver"))))


# The star in the catalog


@register
def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consultations put into the declared, partitioned table; declaring it again changes nothing."""
    cfg = _settings(spark)
    create_star(spark, cfg)
    name = f"{cfg.database}.fait_consultations"
    rows = fait_consultations(spark, sf_dir)
    rows.select(*spark.table(name).columns).write.insertInto(name)
    if any(create_star(spark, cfg).values()):
        raise RuntimeError("an existing table was created again")
    return spark.table(name)


@register
def replace_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table overwritten with what it holds itself, partitioned if its size calls for it."""
    cfg = _settings(spark)
    ensure_database(spark, cfg.database, cfg.database_root)
    spec = STAR["fait_hospitalisation"]
    with scratch(spark):
        stays = replace_table(_stays(spark, sf_dir), cfg.database, spec, cfg.gold_root)
    return replace_table(stays, cfg.database, spec, cfg.gold_root)


@register
def table_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gold tables built, written and registered, then counted."""
    cfg = _settings(spark)
    with scratch(spark):
        build_gold(spark, _written(spark, silver(spark, sf_dir)), cfg)
    return verify_tables(spark, cfg.database, STAR)


@register
def star_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A star built in one database and entered into another from its files alone."""
    cfg = _settings(spark)
    with scratch(spark):
        build_gold(spark, _written(spark, silver(spark, sf_dir)), cfg)
    again = replace(cfg, database=f"{cfg.database}_again")
    outcomes = register_star(spark, again)
    names = [row["tableName"] for row in tables_in(spark, again.database).collect()]  # one row per table
    if failed(outcomes) or sorted(names) != sorted(STAR):
        raise RuntimeError(str(outcomes))
    counted = verify_tables(spark, again.database, STAR)
    # and read by path, without any database
    rows = [
        read_table(spark, spec, cfg.gold_root).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("by_path"))
        for name, spec in STAR.items()
    ]
    return counted.drop("error").join(reduce(DataFrame.unionByName, rows), "table_name")


@register
def databases_and_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two databases as the catalog lists them, with the tables of each and their rows."""
    cfg = _settings(spark)
    t = silver(spark, sf_dir, "communes", "region", "patient")
    kept = {"dim_lieu": dimensions.dim_lieu(t), "dim_patient": dimensions.dim_patient(t, AS_OF)}
    for name, df in kept.items():
        database = f"{cfg.database}_{name}"
        ensure_database(spark, database, f"{cfg.output_root}/{database}.db")
        df.write.parquet(f"{cfg.gold_root}/{name}")
        outcomes = register_all(spark, database, {name: f"{cfg.gold_root}/{name}"})
        if failed(outcomes):
            raise RuntimeError(str(outcomes))
    names = [row["namespace"] for row in databases(spark).where(F.startswith("namespace", F.lit(cfg.database))).collect()]
    found = [
        spark.table(f"{database}.{row['tableName']}").agg(
            F.lit(database.removeprefix(f"{cfg.database}_")).alias("place"),
            F.lit(row["tableName"]).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for database in names
        for row in tables_in(spark, database).collect()
    ]
    return reduce(DataFrame.unionByName, found)


@register
def register_and_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths per region and quarter in SQL over tables registered from their files."""
    cfg = _settings(spark)
    t = silver(spark, sf_dir)
    places = dimensions.dim_lieu(t)
    built = {
        "dim_lieu": places,
        "dim_date": dimensions.dim_date(t, [YEAR]),
        "fait_deces": facts.fait_deces(t, places),
    }
    for name, df in built.items():
        df.write.parquet(f"{cfg.gold_root}/{name}")
    database = cfg.database
    ensure_database(spark, database, cfg.database_root)
    outcomes = register_all(spark, database, {name: f"{cfg.gold_root}/{name}" for name in built})
    if failed(outcomes):
        raise RuntimeError(str(outcomes))
    return questions.query(
        spark,
        f"""
        select l.region, d.trimestre, sum(f.nb_deces) as nb_deces, count(distinct f.fk_lieu_deces) as lieux
        from {database}.fait_deces f
        left join {database}.dim_lieu l on f.fk_lieu_deces = l.lieu_id
        left join {database}.dim_date d on f.fk_date_deces = d.date_id
        group by l.region, d.trimestre
        """,
    )


@register
def relocate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consultations read from the place their table was moved to."""
    cfg = _settings(spark)
    ensure_database(spark, cfg.database, cfg.database_root)
    spec = STAR["fait_consultations"]
    replace_table(fait_consultations(spark, sf_dir), cfg.database, spec, cfg.gold_root)
    outcome = relocate(
        spark, cfg.database, spec.name, work_path(spark, "moved"), partition_by=["annee"]
    )
    if outcome.status != "OK":
        raise RuntimeError(outcome.error or outcome.status)
    return spark.table(f"{cfg.database}.{spec.name}")


@register
def copy_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a partitioned copy of the orders, with some changed, lost and doubled, differs from them."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("annee")
    )
    place = F.pmod("o_orderkey", F.lit(100))
    price = F.when((F.col("annee") == 1996) & (place == 7), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = orders.withColumn("o_totalprice", price).where((F.col("annee") != 1995) | (place != 11))
    copy = kept.unionByName(kept.where((F.col("annee") == 1998) & (place == 30)))
    target = work_path(spark, "copy")
    copy.write.partitionBy("annee").parquet(target)
    return differences(orders, spark.read.schema(orders.schema).parquet(target), ["annee"], place)


@register
def star_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files of all twelve sources to a registered star, moved and counted."""
    t = silver(spark, sf_dir)
    folders = {SILVER_TABLES[role].replace("_", "/", 1): t[role] for role in SILVER_TABLES}
    cfg = replace(
        _settings(spark, source_root=_raw_folder(spark, folders)), relocate_to=work_path(spark, "moved")
    )
    report = run_pipeline(spark, cfg)
    broken = [outcome for _, outcome in report if outcome.status != "OK"]
    if broken:
        raise RuntimeError(str(broken))
    return verify_tables(spark, cfg.database, STAR)
