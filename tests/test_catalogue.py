import random

import pytest
from chatledger.operators import catalogue as C
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def typo(rng, s, n):
    for _ in range(n):
        i = rng.randrange(len(s) + 1)
        c = rng.choice("abcdeé ")
        s = rng.choice([s[:i] + c + s[i:], s[:i] + s[i + 1 :], s[:i] + c + s[i + 1 :]])
    return s


def all_pairs(mentions, names, edits):
    j = mentions.select("mention").distinct().crossJoin(names.select("name").distinct())
    return {tuple(r) for r in j.select("mention", "name", F.levenshtein("mention", "name").alias("e")).where(F.col("e") <= edits).collect()}


@pytest.mark.parametrize("edits,head", [(1, 4), (2, 4), (2, 16), (3, 6)])
def test_no_pair_is_missed(spark, edits, head):
    rng = random.Random(edits * 100 + head)
    names = ["".join(rng.choice("abcdeé ") for _ in range(rng.randrange(0, 24))) for _ in range(300)]
    names += ["arepa de " + n[:6] for n in names]  # a beginning that many share
    said = [typo(rng, rng.choice(names), rng.randrange(5)) for _ in range(200)] + ["", "a"]
    m = spark.createDataFrame([(x,) for x in said + said[:9] + [None]], "mention string")
    n = spark.createDataFrame([(x,) for x in names + names[:9] + [None]], "name string")
    got = C.close_names(m, n, edits, head).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == all_pairs(m, n, edits)
    assert got


def test_the_nearest_name_wins_and_no_mention_is_lost(spark):
    n = spark.createDataFrame([("waffle",), ("wafer",), ("muffin",), ("muffins",)], "name string")
    m = spark.createDataFrame([(1, "wafle"), (2, "wafle"), (3, "muffin"), (4, "mufffins"), (5, "arepa"), (6, None)], "id int, mention string")
    got = {r.id: (r.name, r.edits) for r in C.match_names(m, n).collect()}
    assert got == {1: ("waffle", 1), 2: ("waffle", 1), 3: ("muffin", 0), 4: ("muffins", 1), 5: (None, None), 6: (None, None)}
    assert C.match_names(m, n.limit(0)).count() == 6 and C.match_names(m.limit(0), n).count() == 0


def _reach(s, k):
    out = level = {s}
    for _ in range(k):
        level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t))}
        out = out | level
    return out


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, old[j + 1] + 1, old[j] + (x != y)))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("ab", max_size=9), st.text("ab", max_size=9), st.integers(0, 2), st.integers(1, 6))
def test_heads_of_near_texts_have_a_common_deletion(a, b, k, head):
    if _edits(a, b) <= k:
        assert _reach(a[:head], k) & _reach(b[:head], k)
