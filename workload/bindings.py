"""The given tables in the roles of the silver tables.

Each statement runs unchanged in Spark SQL and in DuckDB, so the same text
feeds the queries and, as common table expressions, their SQL counterparts.
Ratios between tables hold at every scale factor: about a tenth of the
professionals, communes and ``finess`` referred to do not exist.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Periods that cover part of the dates in the given tables.
START, END = dt.date(1997, 1, 1), dt.date(1999, 1, 1)
CUT_START, CUT_END = dt.date(1996, 11, 20), dt.date(1998, 2, 15)
AS_OF = dt.date(2000, 1, 1)
YEAR = 2024

BINDINGS = {
    # a place per customer; its region is that of the customer's nation
    "communes": """
        select c_name as code_commune, n_regionkey as code_region
        from customer join nation on c_nationkey = n_nationkey""",
    "region": """
        select r_regionkey as code_region, r_name as region, upper(substr(r_name, 1, 2)) as iso
        from region""",
    "patient": """
        select c_custkey as id_patient, c_mktsegment as sexe,
               date '1940-01-01' + cast(c_custkey * 37 % 20000 as int) as date_naissance
        from customer""",
    "etablissement_sante": """
        select s_suppkey as id_etablissement, s_name as raison_sociale, s_name as finess,
               concat('Customer#', lpad(cast(s_suppkey * 16 as string), 9, '0')) as code_commune
        from supplier""",
    "professionnel_sante": """
        select s_suppkey as id_prof_sante, s_name as nom,
               concat('P', cast(s_suppkey % 7 as string)) as prenom,
               case when s_suppkey % 2 = 0 then 'M' else 'MME' end as civilite,
               concat('profession ', cast(s_suppkey % 5 as string)) as profession,
               concat('specialite ', cast(s_nationkey as string)) as specialite
        from supplier""",
    # none, one or two establishments per professional
    "activite_professionel": """
        select s_suppkey as id_prof_sante, s_suppkey as id_etablissement
        from supplier where s_acctbal >= 0
        union all
        select s_suppkey as id_prof_sante, s_suppkey + 7 as id_etablissement
        from supplier where s_acctbal >= 5000""",
    "consultations": """
        select cast(floor(o_orderkey / 140.0) as bigint) as id_prof_sante, o_custkey as id_patient,
               concat('Brand#', cast(o_orderkey % 30 as string)) as code_diag,
               o_orderpriority as motif, cast(o_orderdate as date) as date
        from orders""",
    "diagnostic": """
        select distinct p_brand as code_diag, concat('Libelle ', p_brand) as diagnostic from part""",
    "hospitalisation": """
        select o_custkey as id_patient, l_suppkey as id_etablissement, p_brand as code_diag,
               cast(l_shipdate as date) as date, cast(l_quantity as int) as duree
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "deces": """
        select concat('Customer#', lpad(cast(user_id * 11 as string), 9, '0')) as code_commune,
               cast(ts as date) as date_deces
        from events where event_type = 'error'""",
    # scores with a decimal comma in one survey, as numbers in the other
    "satisfaction_esatis": """
        select concat('Supplier#', lpad(cast(cast(floor(user_id * 3 / 4.0) as bigint) as string), 9, '0')) as finess,
               replace(cast(value as string), '.', ',') as score_all_rea_ajust,
               event_id % 200 as nb_rep_score_all_rea_ajust, value / 100 as taux_reco_brut
        from events where event_type = 'view'""",
    "satisfaction_esatisca": """
        select concat('Supplier#', lpad(cast(cast(floor(user_id * 3 / 4.0) as bigint) as string), 9, '0')) as finess,
               value as score_all_ajust,
               event_id % 200 as nb_rep_score_all_ajust, value / 100 as taux_reco_brut
        from events where event_type = 'click'""",
}
_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def silver(spark: SparkSession, sf_dir: str, *roles: str) -> dict[str, DataFrame]:
    """The given tables under the roles the builders know; all roles if none is named."""
    statements = {role: BINDINGS[role] for role in roles or BINDINGS}
    source = re.compile(r"\b(from|join) (\w+)")
    used = {name for statement in statements.values() for _, name in source.findall(statement)}
    tables = {name: table(spark, sf_dir, name) for name in used}
    return {
        role: spark.sql(
            source.sub(r"\1 {\2}", statement),
            **{name: tables[name] for _, name in source.findall(statement)},
        )
        for role, statement in statements.items()
    }
