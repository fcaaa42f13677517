"""Chat export scan (S1 file selection, S2 12-column CSV).

One CSV per conversation, no header.  Quoted text may hold newlines, so whether a newline ends a record
depends on all quotes before it.  Files of at most one input split are read by the multi-line CSV reader,
many to a task.  Larger files are read as lines in splits of any size (``read_split_csvs``):

1. Each line with quotes is a function from "begins inside quotes or not" to "ends inside quotes or not".
   A scan composes a split's functions, one row a split.
2. A running composition over a file's splits tells which of them begin inside quotes.  Only these go
   to the tasks, by their path and offset: fewer entries than the scan has splits, which the driver plans
   one by one anyway.
3. A second scan cuts each split into records from its first line on.  A record that ends in a later split is
   put together from its parts, a few rows a split.  Records are then parsed by the CSV parser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger import schemas as S
from chatledger.functions import text as X
from chatledger.session import ship_package

CSV_GLOB = "*.[cC][sS][vV]"
_CORRUPT = "_corrupt"


def is_chat_file(name: Column, size: Column) -> Column:
    """S1: '.csv' suffix in any case, not the business-account notice file, not empty."""
    return F.lower(name).endswith(".csv") & ~name.contains(S.EXCLUDED_CHAT_FILE) & (size > 0)


def field_count(raw_line: Column) -> Column:
    """Fields of a raw CSV record: commas outside quoted sections, plus one."""
    unquoted = F.regexp_replace(raw_line, r'"([^"]|"")*"', "")
    return F.size(F.split(unquoted, ","))


def _selected(df: DataFrame, *extra: Column) -> DataFrame:
    """Rows of a file scan that are of chat files, with name, path and size of their file."""
    df = df.select(
        "*",
        F.monotonically_increasing_id().alias("file_row"),
        F.col("_metadata.file_name").alias("_fname"),
        F.col("_metadata.file_path").alias("_fpath"),
        F.col("_metadata.file_size").alias("_fsize"),
        *extra,
    )
    return df.filter(is_chat_file(X.decoded_file_name(F.col("_fname")), F.col("_fsize")))


def _chat_rows(parsed: DataFrame) -> DataFrame:
    """Parsed records without the over-long ones."""
    # Spark refuses scans whose required columns are only the corrupt-record column, so the
    # width rule also names ``chat_id`` (the extra disjunct is never true).
    width_ok = F.col(_CORRUPT).isNull() | (field_count(F.col(_CORRUPT)) <= len(S.RAW_CHAT_COLUMNS))
    return parsed.filter(width_ok | (F.length("chat_id") < 0)).select(
        *S.RAW_CHAT_COLUMNS,
        X.decoded_file_name(F.col("_fname")).alias("filename"),
        X.decoded_file_name(F.col("_fpath")).alias("file_path"),
        "file_row",
    )


def _scan(spark: SparkSession, recursive: bool):
    return spark.read.option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", str(recursive).lower())


_SCHEMA = T.StructType(list(S.RAW_CHAT_SCHEMA.fields) + [T.StructField(_CORRUPT, T.StringType())])
_OPTIONS = {"header": "false", "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "encoding": "UTF-8"}


def read_whole_csvs(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Rows of every selected file, each file read by one task; its bytes are ``_fsize``."""
    df = _scan(spark, recursive).schema(_SCHEMA).options(**_OPTIONS).option("multiLine", "true").csv(folder)
    return _selected(df)


def ends_inside_quotes(line: str, inside: bool) -> bool:
    """Whether a line that begins inside quotes, or not, ends inside quotes.

    The pieces between quotes are walked with four states: at a field's start (0), within an unquoted field,
    where quotes are text (1), within quotes (2), right after a quote within quotes (3).
    """
    state = 2 if inside else 0
    pieces = line.split('"')
    for piece in pieces[:-1]:
        if state == 2:
            state = 3
        elif piece[-1:] == "," or (not piece and state != 1):
            state = 2
        else:
            state = 1
    return state == 2


def _before(df: DataFrame, out: str, in_: str, part: list[str], order: str, names: tuple[str, str]) -> DataFrame:
    """The composition of the functions of all rows before, by its values at outside (0) and inside (1).

    A function is constant, the identity or a swap: what counts is the last constant and the swaps after it.
    """
    upto = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    constant = F.when(F.col(out) == F.col(in_), F.col(out))
    df = df.withColumn("_swaps", F.sum(F.when(F.col(out) > F.col(in_), 1).otherwise(0)).over(upto))
    last = F.last(constant, ignorenulls=True).over(prior)
    then = F.last(F.when(constant.isNotNull(), F.col("_swaps")), ignorenulls=True).over(prior)
    since = F.coalesce(F.last("_swaps").over(prior), F.lit(0)) - F.coalesce(then, F.lit(0))
    values = {n: ((F.coalesce(last, F.lit(start)) + since) % 2).cast("int") for n, start in zip(names, (0, 1), strict=True)}
    return df.withColumns(values).drop("_swaps")


_KEY = ["_file", "_block"]  # of a split: a hash of the file's path, and the offset
_SPLIT = "_file bigint, _block bigint, _out int, _in int, _cr boolean"
_RECORD = "_fpath string, file_row bigint, _record string, _part int"
_WHOLE, _BEGINS, _ENDS, _MIDDLE = range(4)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The slices of a batch by split."""
    file, block = (batch.column(c).to_numpy() for c in _KEY)
    cuts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(file)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if lo < hi:
            yield (int(file[lo]), int(block[lo])), batch.slice(lo, hi - lo)


def _split_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: its function on "inside quotes", and whether its first line ends in CR."""
    held, done = None, []
    for batch in batches:
        for key, run in _runs(batch):
            if held is None or key != (held[0], held[1]):
                held = [*key, 0, 1, run.column("_cr")[0].as_py()]
                done.append(held)
            for line in run.column("_quoted").drop_null().to_pylist():
                out = int(ends_inside_quotes(line, bool(held[2])))
                held[3] = out if held[2] == held[3] else int(ends_inside_quotes(line, bool(held[3])))
                held[2] = out
    if done:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], [*_KEY, "_out", "_in", "_cr"])


class _Cutter:
    """Cuts the lines of one split after another into records and parts of records."""

    def __init__(self, paths: dict[int, str], inside: set[tuple[int, int]], crlf: set[int]) -> None:
        self.paths, self.inside_at, self.crlf_of, self.key = paths, inside, crlf, None
        self.parts: list[tuple] = []

    def begin(self, key: tuple[int, int]) -> None:
        self.end()
        self.key, self.path, self.row = key, self.paths[key[0]], key[1]
        self.inside, self.crlf = key in self.inside_at, key[0] in self.crlf_of
        self.held, self.at, self.open = [], self.row, self.inside  # ``open``: the lines held began in an earlier split

    def end(self) -> None:
        if self.key is not None and self.inside:
            self.parts.append((self.path, self.at, "\n".join(self.held), _MIDDLE if self.open else _BEGINS))

    def cut(self, key: tuple[int, int], run: pa.RecordBatch) -> pa.RecordBatch:
        """The run's lines that are whole records; other records go to ``parts``."""
        if key != self.key:
            self.begin(key)
        lines = run.column("value")
        if self.crlf:
            lines = pc.replace_substring_regex(lines, "\r$", "")
        n = len(lines)
        alone = np.zeros(n, bool)
        last = 0
        for i in [*np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist(), n]:
            if self.inside:
                self.held += lines.slice(last, i - last).to_pylist()
            else:
                alone[last:i] = True
            last = i + 1
            if i == n:
                break
            line = lines[i].as_py()
            after = ends_inside_quotes(line, self.inside)
            if self.inside:
                self.held.append(line)
                if not after:
                    self.parts.append((self.path, self.at, "\n".join(self.held), _ENDS if self.open else _WHOLE))
                    self.held, self.open = [], False
            elif after:
                self.held, self.at = [line], self.row + i
            else:
                alone[i] = True
            self.inside = after
        rows = pa.array(self.row + np.arange(n))
        self.row += n
        whole = pa.RecordBatch.from_arrays([pa.repeat(self.path, n), rows, lines, pa.repeat(pa.scalar(_WHOLE, pa.int32()), n)], ["_fpath", "file_row", "_record", "_part"])
        return whole if alone.all() else whole.filter(pa.array(alone))


def read_split_csvs(spark: SparkSession, folder: str, recursive: bool = False, larger_than: int = 0) -> DataFrame:
    """The same rows as ``read_whole_csvs``, from files of over ``larger_than`` bytes read in input splits.

    Runs a job while it is built.  ``file_row`` is the byte offset of a record's split plus its line's number
    there: it rises within a file.  A file whose first line ends in CRLF has CRLF line ends; a lone CR is text.  A
    quote never closed makes the rest of its file one record, as in any reader.  Text after a closing
    quote, which no CSV writer makes, ends its field at the next comma.
    """
    listed = _selected(_scan(spark, recursive).format("binaryFile").load(folder)).filter(F.col("_fsize") > larger_than)
    paths = [r["_fpath"] for r in listed.select("_fpath").collect()]
    if not paths:
        return spark.createDataFrame([], T.StructType([*_SCHEMA, *T.StructType.fromDDL("_fname string, _fpath string, file_row bigint")]))
    ship_package(spark)
    path = F.col("_metadata.file_path")
    df = _scan(spark, recursive).option("lineSep", "\n").text(folder).filter(path.isin(paths))
    key = [F.xxhash64(path).alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    quoted = F.when(F.contains("value", F.lit('"')), F.col("value")).alias("_quoted")
    splits = df.select(*key, quoted, F.col("value").endswith("\r").alias("_cr")).mapInArrow(_split_functions, _SPLIT)
    splits = _before(splits, "_out", "_in", ["_file"], "_block", ("_start", "_unused"))
    end = F.when(F.col("_start") == 0, F.col("_out")).otherwise(F.col("_in")).alias("_end")
    crlf = ((F.col("_block") == 0) & F.col("_cr")).alias("_crlf")
    told = splits.select(*_KEY, "_start", end, crlf).filter("_start = 1 or _end = 1 or _crlf").collect()
    inside, ends = {(r["_file"], r["_block"]) for r in told if r["_start"]}, {r["_file"] for r in told if r["_crlf"]}
    borders = {(r["_file"], r["_block"]) for r in told if r["_start"] or r["_end"]}
    names = {r["_file"]: r["p"] for r in spark.createDataFrame([(x,) for x in paths], "p string").select("p", F.xxhash64("p").alias("_file")).collect()}
    if len(names) < len(paths):
        raise ValueError("two paths of one hash; read their folders apart")

    def cut(only: set[tuple[int, int]] | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cutter = _Cutter(names, inside, ends)
            fields = ["_fpath", "file_row", "_record", "_part"]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32()]

            def parts() -> Iterator[pa.RecordBatch]:
                made = [p for p in cutter.parts if (p[3] == _WHOLE) == (only is None)]
                cutter.parts = []
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], fields)

            for batch in batches:
                for split, lines in _runs(batch):
                    if only is None or split in only:
                        whole = cutter.cut(split, lines)
                        if only is None:
                            yield whole
                yield from parts()
            cutter.end()
            yield from parts()

        return df.select(*key, "value").mapInArrow(run, _RECORD)

    # Lines are read anew, not kept: once for whole records, once for those over the borders of splits.
    found = cut(None)
    so_far = Window.partitionBy("_fpath").orderBy("file_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = cut(borders).withColumn("_first", F.last(F.when(F.col("_part") == _BEGINS, F.col("file_row")), ignorenulls=True).over(so_far))
    joined = parts.groupBy("_fpath", "_first").agg(F.sort_array(F.collect_list(F.struct("file_row", "_record"))).alias("_parts"))
    joined = joined.select("_fpath", F.col("_first").alias("file_row"), F.array_join("_parts._record", "\n").alias("_record"))
    records = found.select("_fpath", "file_row", "_record")
    records = records.unionByName(joined) if borders else records
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _SCHEMA)
    # A BOM may be left on the first line; blank records are none.
    record = F.when(F.col("file_row") == 0, F.regexp_replace("_record", "^\uFEFF", "")).otherwise(F.col("_record"))
    parsed = records.withColumn("_record", record).filter(F.col("_record") != "").withColumn("_row", F.from_csv("_record", fields, _OPTIONS))
    return parsed.select("_row.*", F.element_at(F.split("_fpath", "/"), -1).alias("_fname"), "_fpath", "file_row")


def read_chat_csvs(spark: SparkSession, folder: str, recursive: bool = False, whole_bytes: int | None = None) -> DataFrame:
    """Rows of every selected chat file with ``filename``, ``file_path`` and ``file_row``.

    Over-long rows are dropped (the original reader warns and skips them); short rows are kept with NULLs.
    File names are percent-decoded without turning '+' into a space.  Files of over ``whole_bytes`` (default: an
    input split, ``spark.sql.files.maxPartitionBytes``) are read in splits; the rows are the same.
    """
    if whole_bytes is None:
        whole_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    small = read_whole_csvs(spark, folder, recursive).filter(F.col("_fsize") <= whole_bytes).drop("_fsize")
    return _chat_rows(small.unionByName(read_split_csvs(spark, folder, recursive, whole_bytes)))
