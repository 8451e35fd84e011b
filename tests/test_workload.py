"""Registered queries compute what they are made of once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from workload import queries


@pytest.mark.parametrize("name", ["table_verify", "hosp_by_sexe_age"])
def test_stays_are_joined_once(spark, sf_dir, monkeypatch, name):
    """A pass for the layout, one for the rows and those of the dimensions read the joined stays, none joins them again."""
    passed = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        passed.add(1)
        return True

    given = queries.silver

    def silver(*args):
        t = given(*args)
        if "hospitalisation" in t:
            t["hospitalisation"] = t["hospitalisation"].where(counted.asNondeterministic()("id_patient"))
        return t

    monkeypatch.setattr(queries, "silver", silver)
    monkeypatch.setattr(queries, "_GOLD", {})
    queries.REGISTERED[name](spark, sf_dir).collect()
    assert passed.value == queries.table(spark, sf_dir, "lineitem").count()
