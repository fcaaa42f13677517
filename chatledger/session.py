"""Spark session helpers.

Library code never creates its own session; callers pass one in.  These helpers are
for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "chatledger") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CHATLEDGER_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``chatledger`` importable by Python workers on every executor (once per context).

    Functions that run Python on executors (applyInPandas, mapInPandas) are pickled by
    reference to this package, so executors need it: the package is zipped and added with
    ``SparkContext.addPyFile``, which distributes it and puts it on the workers' path.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="chatledger-pkg-"), "chatledger.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
