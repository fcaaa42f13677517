"""Remote/local file manifests: reconciliation counts and a sorted sample of missing names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_diff(remote: DataFrame, local: DataFrame, name: str = "name") -> DataFrame:
    """Distinct remote and local names, missing = remote - local, extra = local - remote."""
    r = remote.select(F.col(name).alias("name")).distinct()
    lo = local.select(F.col(name).alias("name")).distinct()
    missing = r.join(lo, "name", "left_anti")
    extra = lo.join(r, "name", "left_anti")
    counts = [
        r.agg(F.count(F.lit(1)).alias("n")).withColumn("measure", F.lit("remote")),
        lo.agg(F.count(F.lit(1)).alias("n")).withColumn("measure", F.lit("local")),
        missing.agg(F.count(F.lit(1)).alias("n")).withColumn("measure", F.lit("missing")),
        extra.agg(F.count(F.lit(1)).alias("n")).withColumn("measure", F.lit("extra")),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.select("measure", "n")


def missing_sample(remote: DataFrame, local: DataFrame, n: int = 10, name: str = "name") -> DataFrame:
    """The first ``n`` missing names in sorted order (a top-n, not a full sort)."""
    r = remote.select(F.col(name).alias("name")).distinct()
    lo = local.select(F.col(name).alias("name")).distinct()
    return r.join(lo, "name", "left_anti").orderBy("name").limit(n)
