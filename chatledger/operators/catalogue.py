"""F19 at catalogue size: names written with typing errors, found through an index of deletions.

Two texts within ``edits`` edits have a common text that both reach by at most ``edits`` deletions, and so have their
first ``head`` characters.  Every catalogue name is indexed under the hash of each such text, every mention asks with its
own, and the edit distance decides about the pairs that meet.  Nothing is missed; names that meet nothing cost no comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD = 16
EDITS = 2


def deletions(text: Column, edits: int = EDITS, head: int = HEAD) -> Column:
    """Hashes of all texts that at most ``edits`` deletions from the first ``head`` characters give."""

    def one_less(t: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(t))
        cut = F.transform(places, lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))
        return F.when(F.length(t) > 0, cut).otherwise(F.array().cast("array<string>"))

    level = F.array(F.substring(text, 1, head))
    every = level
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, one_less)))
        every = F.concat(every, level)
    return F.array_distinct(F.transform(every, lambda t: F.xxhash64(t)))


def close_names(mentions: DataFrame, catalogue: DataFrame, edits: int = EDITS, head: int = HEAD) -> DataFrame:
    """``mention``, ``name``, ``edits`` of all pairs of a text of ``mentions`` (column ``mention``) and one of ``catalogue``
    (``name``) within ``edits`` edits.  Equal texts are one; NULL meets nothing; the empty text is a text."""
    texts = lambda df, c: df.select(c).where(F.col(c).isNotNull()).distinct()
    asked, known = texts(mentions, "mention"), texts(catalogue, "name")
    asked = asked.select("mention", F.explode(deletions(F.col("mention"), edits, head)).alias("key"))
    known = known.select("name", F.explode(deletions(F.col("name"), edits, head)).alias("key"))
    pairs = asked.join(known, "key").where(F.abs(F.length("mention") - F.length("name")) <= edits)
    pairs = pairs.select("mention", "name", F.levenshtein("mention", "name", edits).alias("edits"))
    return pairs.where(F.col("edits") >= 0).distinct()


def match_names(mentions: DataFrame, catalogue: DataFrame, edits: int = EDITS, head: int = HEAD) -> DataFrame:
    """``mentions`` with ``name`` and ``edits``: the catalogue's nearest name (ties: the first by text), NULLs if none is near."""
    near = close_names(mentions, catalogue, edits, head).groupBy("mention").agg(F.min(F.struct("edits", "name")).alias("_best"))
    best = near.select("mention", F.col("_best.name").alias("name"), F.col("_best.edits").alias("edits"))
    return mentions.join(best, "mention", "left")
