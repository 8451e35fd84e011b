"""Sessions with the few settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "medoria", master: str | None = None, hive: bool = False, **conf: str) -> SparkSession:
    """Adaptive execution and UTC; everything else is left to the cluster.

    With ``hive`` the catalog is that of the metastore the cluster is set up with.
    """
    builder = SparkSession.builder.appName(app)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # also where the split costs a shuffle that a later step could have shared
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
