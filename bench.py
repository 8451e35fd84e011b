"""Time the registered queries: one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8)
choose the data and the cores, ``BENCH_WORK_DIR`` the folder of work tables, arguments the queries. Results go to Spark's
no-op sink, so what is timed is the query and not a transfer to Python. Each
query first runs once untimed on the smallest tables (sf0.001 beside the
chosen folder), which loads classes and compiles the generated code. The gold tables that
questions read are stored first, timed as ``store_gold``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from medoria.session import session
from medoria.work import discard_work
from workload.queries import REGISTERED, store_gold

WORK_DIR = os.environ.get("BENCH_WORK_DIR", "/tmp/medoria-bench")
HEADLINE = [
    "dim_lieu",
    "dim_patient",
    "dim_date",
    "dim_etablissement",
    "dim_diagnostic",
    "dim_professionel",
    "fait_deces",
    "fait_hospitalisation",
    "fait_satisfaction",
    "fait_consultations",
    "consult_by_etablissement",
    "consult_by_diagnostic",
    "consult_by_professionnel",
    "hosp_global",
    "hosp_by_diagnostic",
    "hosp_by_sexe_age",
    "deces_by_region",
    "satisfaction_by_region",
    "clean_names",
    "dedup_names",
    "surrogate_key",
    "silver_csv_semicolon",
    "silver_csv_comma",
    "silver_json",
    "silver_parquet",
    "replace_twice",
    "relocate_table",
    "register_and_sql",
    "table_verify",
    "star_pipeline",
]

# these read stored tables; storing them is timed apart
QUESTIONS = {name for name in HEADLINE if name.startswith(("consult_by", "hosp_")) or name.endswith("_by_region")}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": WORK_DIR,
            "spark.sql.warehouse.dir": f"{WORK_DIR}/warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm_up = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    names = sys.argv[1:] or HEADLINE

    def run(name: str, folder: str) -> None:
        REGISTERED[name](spark, folder).write.format("noop").mode("overwrite").save()

    if os.path.isdir(warm_up):
        for name in names:
            run(name, warm_up)

    seconds = {}
    if QUESTIONS & set(names):
        begin = time.perf_counter()
        store_gold(spark, sf_dir)
        seconds["store_gold"] = round(time.perf_counter() - begin, 3)
    for name in names:
        begin = time.perf_counter()
        run(name, sf_dir)
        seconds[name] = round(time.perf_counter() - begin, 3)
    discard_work(spark)
    print(
        json.dumps(
            {
                "metric": "wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
