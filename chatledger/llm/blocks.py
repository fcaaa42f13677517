"""Pairs within a group without pairs of rows: a large group is dealt into blocks, and each pair of blocks is one cell.

A row of a group of one block gets one cell; a row of a group of ``k`` blocks gets ``k`` cells, so no
task holds more than two blocks of a group and every pair of rows meets in exactly one cell, but for
pairs within one block, which meet in the cell of that block with itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import blocks_of, materialize


def into_cells(rows: DataFrame, key: str, row_id: str, size: int) -> DataFrame:
    """``rows`` of groups of at least two, with ``cell`` (hash of key and pair of blocks) and ``side``:
    0 and 1 are rows of the cell's two blocks, 2 rows of a cell of one block."""
    # Written: Spark splits a hot key's partition only between plain exchanges.
    counts = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    dealt = rows.join(counts, key).withColumn("_k", blocks_of(F.col("_n"), size)).withColumn("_b", F.pmod(F.xxhash64(F.lit("block"), row_id), F.col("_k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_o")
    side = F.when(F.col("_o") == F.col("_b"), 2).when(F.col("_b") < F.col("_o"), 0).otherwise(1).cast("int")
    cell = F.xxhash64(key, F.least("_b", "_o"), F.greatest("_b", "_o"))
    return dealt.select(*rows.columns, "_b", other).select(*rows.columns, cell.alias("cell"), side.alias("side"))
