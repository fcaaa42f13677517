"""Tables that are written together, a version at a time, and read as far as they are committed.

A version's rows of each table go to ``<root>/<table>/version=<n>``; then one file ``<root>/_commits/<n>`` makes all of
them visible at once.  A write that fails leaves folders that no reader looks at and that the next try
overwrites; a version that is committed is not written again, so a replayed batch changes nothing.

``read_table`` reads through Spark.  The data source ``versioned_table`` (``read_anew``) lists the committed versions
in its tasks, so the static side of a streaming join sees in each batch what earlier ones wrote; a DataFrame
of files would keep the listing it was made with.  Within a micro-batch it reads the versions before that
batch's number only, so a batch that is replayed after its commit reads what it read at first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from chatledger.session import ship_package

COMMITS = "_commits"
SLOTS = 8


def _hadoop(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def committed(spark: SparkSession, root: str) -> list[int]:
    """Versions committed, in order."""
    path, fs = _hadoop(spark, f"{root}/{COMMITS}")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit())


def _commit(spark: SparkSession, root: str, version: int) -> None:
    done, fs = _hadoop(spark, f"{root}/{COMMITS}/{version:020d}")
    made, _ = _hadoop(spark, f"{root}/{COMMITS}/.{version:020d}.tmp")
    fs.create(made, True).close()
    if not fs.rename(made, done) and not fs.exists(done):
        raise OSError(f"version {version} of {root} was not committed")


def write_version(root: str, version: int, tables: dict[str, DataFrame]) -> bool:
    """Write all tables of a version, or none.  False if it was there before."""
    spark = next(iter(tables.values())).sparkSession
    if version in committed(spark, root):
        return False
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/version={version}")
    _commit(spark, root, version)
    return True


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType | str) -> DataFrame:
    """The committed rows of a table, with ``version``."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*fields, T.StructField("version", T.LongType())])
    paths = [f"{root}/{name}/version={v}" for v in committed(spark, root)]
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{root}/{name}").parquet(*paths)


@dataclass
class _Slot(InputPartition):
    number: int


class _Reader(DataSourceReader):
    """A fixed number of slots share the files; Spark keeps the slots of a plan, so files are listed in the tasks."""

    def __init__(self, root: str, name: str, schema: T.StructType, slots: int) -> None:
        self.root, self.name, self.fields, self.slots = root, name, schema, slots

    def partitions(self) -> list[_Slot]:
        return [_Slot(i) for i in range(self.slots)]

    def files(self, fs: pafs.FileSystem, root: str) -> list[str]:
        task = TaskContext.get()
        batch = task.getLocalProperty("streaming.sql.batchId") if task else None
        names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(f"{root}/{COMMITS}", allow_not_found=True))]
        seen = {int(n) for n in names if n.isdigit() and (batch is None or int(n) < int(batch))}
        found = fs.get_file_info(pafs.FileSelector(f"{root}/{self.name}", allow_not_found=True, recursive=True))
        parts = [f.path for f in found if f.path.endswith(".parquet") and f.size]
        return sorted(p for p in parts if int(p.rsplit("version=", 1)[1].split("/")[0]) in seen)

    def read(self, partition: _Slot) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(self.root)
        kinds = to_arrow_schema(self.fields)
        for path in self.files(fs, root)[partition.number :: self.slots]:
            with fs.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(columns=kinds.names):
                    yield pa.RecordBatch.from_arrays([batch.column(n).cast(t) for n, t in zip(kinds.names, kinds.types, strict=True)], kinds.names)


class VersionedTable(DataSource):
    """Options ``root`` (a URI that pyarrow opens: file, hdfs, s3, gs), ``table`` and ``slots`` (tasks)."""

    @classmethod
    def name(cls) -> str:
        return "versioned_table"

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(self.options["root"], self.options["table"], schema, int(self.options["slots"]))


def read_anew(spark: SparkSession, root: str, name: str, schema: T.StructType | str, slots: int = SLOTS) -> DataFrame:
    """The committed rows of a table as of each time that a plan with this DataFrame is run."""
    ship_package(spark)
    spark.dataSource.register(VersionedTable)
    uri = root if "://" in root else f"file://{root}"
    return spark.read.format("versioned_table").schema(schema).option("root", uri).option("table", name).option("slots", slots).load()
