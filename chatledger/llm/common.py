"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Make the package importable by the Python workers."""
    ship_package(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Where none is set, a scratch folder does for a local master; a cluster
    needs one that all its machines share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _SCRATCH.setdefault(spark.sparkContext.applicationId, None) or tempfile.mkdtemp(prefix="chatledger-ckpt-")
        _SCRATCH[spark.sparkContext.applicationId] = root
    return root.rstrip("/")


_SCRATCH: dict[str, str | None] = {}


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a Parquet table in the shared folder; lost executors only cost a reread.

    The tables of an application lie in one folder of its own, which is removed when its Python process ends.
    """
    spark = df.sparkSession
    top = f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}"
    if top not in _MADE:
        _MADE.add(top)
        atexit.register(_remove, spark, top)
    path = f"{top}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_MADE: set[str] = set()


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # else it was stopped before: the folder is the cluster's to clean
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """A new schema: ``schema`` and the fields of ``ddl`` after it."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def least_row(df: DataFrame, keys: list[str], text_col: str, name: str) -> DataFrame:
    """``keys`` and one row of each group as a struct ``name``: that of the smallest hash of the columns beside the text."""
    rest = [f.name for f in df.schema if f.name not in {*keys, text_col} and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = F.xxhash64(*(F.col(f"`{c}`") for c in rest)) if rest else F.lit(0)
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in keys))
    return df.groupBy(*keys).agg(F.min_by(whole, order).alias(name))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, min_rows: int = 0) -> Iterator[pa.Table]:
    """Tables of whole groups from a partition sorted by ``key``.

    Several groups come in one table, so that callers work on many small groups at once; a group
    is held back until its last row has been seen.  At least ``min_rows`` rows a table, but for the last.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < min_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
            held, rows = [batch.slice(cut)], batch.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys, and the length of the array."""
    n = len(sorted_keys)
    return np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [n])) if n else np.zeros(1, np.int64)


def blocks_of(count: Column, size: int) -> Column:
    """Blocks of about ``size`` rows that a group of ``count`` rows is dealt into."""
    return F.greatest(F.lit(1), F.ceil(count / F.lit(size))).cast("int")
