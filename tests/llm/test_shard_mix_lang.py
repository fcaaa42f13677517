import re
import zlib
from collections import Counter, defaultdict

import pytest
from chatledger.llm import histogram_shard, langid, mixing
from chatledger.llm.common import table
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm.conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check_shards(rows, shards=16):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, largest = sum(sizes.values()), max(r.size for r in rows)
    for s in range(shards):
        assert abs(sizes[s] - total / shards) <= 2 * largest + 0.002 * total / shards


def test_shards_of_documents(spark):
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    rows = histogram_shard.assign_shards(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    check_shards(rows)


def test_a_hot_text_is_cut(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same " * 40)).otherwise(F.concat(F.lit("t "), F.col("id").cast("string"), F.repeat(F.lit(" w"), 80))).alias("text"))
    check_shards(histogram_shard.assign_shards(docs).collect())
    equal = spark.range(1600).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("one").alias("text"))
    check_shards(histogram_shard.assign_shards(equal).collect())


def test_shards_of_odd_rows(odd_docs, no_docs, clashing):
    rows = histogram_shard.assign_shards(clashing).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)} == {(1, 0)}
    assert histogram_shard.assign_shards(no_docs).count() == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    histogram_shard.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("__shard").count() == docs.count() and back.select("__shard").distinct().count() == 16


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s] + 1e-9}
        if not over:
            for s in open_:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check_mix(docs, rows, near=0.05):
    size = Counter()
    for d in docs:
        size[d.source] += len(WORD.findall(d.text or ""))
    want = plain_targets(size)
    source = defaultdict(list)
    for d in docs:
        source[d.doc_id].append(d.source)
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        s = next(x for x in source[r.doc_id] if size[x] == r.source_size and want[x] == pytest.approx(r.target))
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= near * t + 70, (s, taken[s], t)


def test_mix_of_documents(spark):
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    rows = mixing.mix(docs).collect()
    check_mix(docs.collect(), rows, 0.01)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_permutation_is_one(spark):
    for n in (1, 2, 97, 1000):
        got = [r.p for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3)).alias("p")).collect()]
        assert sorted(got) == list(range(n))
    assert got != sorted(got)


def test_counts_of_shards_are_drawn(spark):
    targets = spark.createDataFrame([(0, 6000, 0), (1, 3000, 6000), (2, 1000, 9000)], "s int, n bigint, first bigint")
    rows = mixing.draw(targets, 10_000, 20).collect()
    per = Counter()
    for r in rows:
        per[r.s] += r["count"]
    assert per == {0: 6000, 1: 3000, 2: 1000}
    first = [r["count"] for r in rows if r.s == 0 and r.shard < 19]
    assert min(first) < 300 < max(first) and all(240 < c < 360 for c in first)


def test_mix_of_odd_rows(odd_docs, no_docs, clashing):
    rows = mixing.mix(clashing).collect()
    assert len(rows) == odd_docs.count()
    check_mix(odd_docs.collect(), rows)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    out = mixing.mixed_documents(clashing)
    assert out.columns == clashing.columns
    per = Counter()
    for r in out.collect():
        per[r.source] += len(WORD.findall(r.text))
    want = Counter()
    for d, r in zip(sorted(odd_docs.collect(), key=str), sorted(rows, key=str)):
        pass
    for r in rows:
        want[r.target] += r.taken
    assert sorted(v for v in per.values() if v) == sorted(v for v in want.values() if v)


def test_rows_of_one_id_and_text_keep_their_source(spark):
    rows = [(1, words(9, 1), "A", 1), (1, words(9, 1), "B", 2), (1, words(9, 1), "B", 3), (2, words(30, 2), "A", 4), (3, words(12, 3), None, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, note int")
    want = Counter()
    source_of = {}
    for r in mixing.mix(docs, block=4).collect():
        source_of[round(r.target, 6)] = r.source_size
        want[r.source_size] += r.taken
    size_of = {"A": 39, "B": 18, None: 12}
    seen = []
    for part in (docs, docs.orderBy(F.desc("note")).repartition(5)):
        out = sorted(mixing.mixed_documents(part, block=4).collect(), key=str)
        per = Counter()
        for r in out:
            per[size_of[r.source]] += len(WORD.findall(r.text))
        assert {k: v for k, v in per.items() if v} == {k: v for k, v in want.items() if v}
        seen.append(out)
    assert seen[0] == seen[1]


def test_mixed_documents_hold_the_words_taken(spark):
    docs = table(spark, SF_SMALL, "documents")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = Counter()
    for r in mixing.mixed_documents(docs).collect():
        assert r.n_chars == len(r.text)
        own = WORD.findall(r.text)
        held[r.doc_id] += len(own)
        it = iter(WORD.findall(texts[r.doc_id]))
        assert all(w in it for w in own)  # in order
        if len(own) == len(WORD.findall(texts[r.doc_id])):
            assert r.text == texts[r.doc_id]
    assert {i: t for i, t in taken.items() if t} == dict(held)


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.identify_language(docs.drop("source")).select("doc_id", langid.held_out(F.col("doc_id")).alias("out"), "lang_pred", "rejected", "score").collect()
    out = [r for r in rows if r.out]
    assert {r.doc_id for r in out} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.99 * len(out)
    assert sum(r.rejected for r in rows) <= 0.005 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_unlearnt_scripts_noise_and_ties_are_rejected(spark):
    import random

    rng = random.Random(3)
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents").select("doc_id", "text", "lang")
    russian = "вот как мы жили в старом доме у реки где всегда было тихо и светло зимой летом".split()
    japanese = "今日は天気がとても良いので公園へ散歩に行きました友達と本を読みます"
    texts = {
        "unlearnt": [" ".join(rng.choices(russian, k=n)) for n in (5, 60, 600)] + ["".join(rng.choices(japanese, k=n)) for n in (20, 300, 5000)],
        "noise": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz" + " " * (i % 2 * 5), k=n)) for n in (30, 400, 3000, 50_000) for i in range(100)],
        "ties": ["a", "xq", "OK?"],
    }
    rows = spark.createDataFrame([(i, t, kind) for i, (kind, t) in enumerate((k, t) for k, ts in texts.items() for t in ts)], "doc_id bigint, text string, kind string")
    learnt = langid.learn(docs)
    found = defaultdict(list)
    for r in langid.classify(rows, learnt).collect():
        found[r.kind].append(r.rejected)
    assert all(found["unlearnt"]) and all(found["ties"])
    assert sum(found["noise"]) >= 0.97 * len(found["noise"])
    # A tie of equal priors, and one language against none.
    same = langid.Language(b"one dictionary for both", 5)
    assert [r.rejected for r in langid.classify(rows, {"a": same, "b": same}).collect()] == [True] * rows.count()
    only = langid.classify(rows.unionByName(docs.where("length(text) > 1000 and lang = 'en'").limit(20).select("doc_id", "text", F.lit("en").alias("kind"))), {"en": learnt["en"]}).collect()
    assert not any(r.rejected for r in only if r.kind == "en")
    assert all(r.rejected for r in only if r.kind == "unlearnt" and len(r.text) < 1000)
    # Short texts go by their words.
    short = spark.createDataFrame([(2, "Von.", "de")], docs.schema)
    assert {(r.lang, r.lang_pred, r.rejected) for r in langid.classify(short, learnt).collect()} == {("de", "de", False)}
    # Long texts of a learnt language stay.
    long = docs.where("lang = 'fr'").agg(F.repeat(F.concat_ws(" ", F.collect_list("text")), 2).alias("text"))
    assert [(r.lang_pred, r.rejected) for r in langid.classify(long, learnt).collect()] == [("fr", False)]


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert langid.learn(docs) == langid.learn(other)


def test_letters_are_unicode_letters(spark):
    rows = [(1, "½ ²"), (2, "①② Ⅳ"), (3, "12_3 ٣"), (4, "é"), (5, "the ½")]
    learnt = {"en": langid.Language(b"the and of to in that", 5)}
    found = {r.doc_id: (r.lang_pred, r.rejected) for r in langid.classify(spark.createDataFrame(rows, "doc_id bigint, text string"), learnt).collect()}
    assert [found[i] for i in (1, 2, 3)] == [("und", True)] * 3
    assert found[4][0] == found[5][0] == "en"
    odd = spark.createDataFrame([(i, "½ ²", "zz") for i in range(8)], "doc_id bigint, text string, lang string")
    assert langid.learn(odd) == {}


def test_a_shared_opening_does_not_fill_the_dictionary(spark):
    opening = "licence text in another tongue " * 100
    rows = [(i, opening + words(600, i), "xx") for i in range(60)]
    learnt = langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))["xx"].dictionary.decode(errors="ignore")
    assert len(learnt) > 50_000 and learnt.count("tongue") < 0.5 * 60 * 66


def test_sizes_scores_and_rejections_against_plain(spark):
    """Each text compressed by itself, costs and posterior by their definition."""
    import math

    import regex
    import zstandard

    docs = table(spark, SF_SMALL, "documents")
    learnt = langid.learn(docs)
    total = sum(x.rows for x in learnt.values())
    names = sorted(learnt, key=lambda n: (-learnt[n].rows, n))
    vocabulary = [set(regex.findall(r"\p{L}+", learnt[n].dictionary.decode(errors="ignore"))) for n in names]
    held = []
    for r in langid.classify(docs, learnt).collect():
        if not r.text or not regex.search(r"\p{L}", r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        data = r.text.lower().encode()
        sizes = []
        for n in names:
            d = zstandard.ZstdCompressionDict(learnt[n].dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes.append(len(zstandard.ZstdCompressor(level=7, dict_data=d, write_content_size=False, write_dict_id=False).compress(data)))
        bare = len(zstandard.ZstdCompressor(level=7, write_content_size=False).compress(data))
        cost = [8 * s - math.log2(learnt[n].rows / total) for s, n in zip(sizes, names, strict=True)]
        post = [1 / sum(2.0 ** min(max(-1000.0, c - d), 1000.0) for d in cost) for c in cost]
        best, rejected = min(range(len(names)), key=lambda i: (cost[i], i)), None
        if min(sorted(sizes)[1], bare) - min(sizes) < max(2, 0.03 * math.sqrt(len(data))):
            found = regex.findall(r"\p{L}+", r.text.lower())
            cover = [sum(len(w) for w in found if w in v) for v in vocabulary]
            clear = sorted(cover)[-1] - sorted(cover)[-2] >= 0.5 * sum(map(len, found))
            best, rejected = (cover.index(max(cover)), False) if clear else (best, True)
        rejected = post[best] < 0.5 if rejected is None else rejected
        assert (r.lang_pred, r.rejected) == (names[best], rejected)
        assert r.score == pytest.approx(post[best], abs=1e-9)
        held.append(r.rejected)
    assert len(held) > 150


def test_language_of_odd_rows(odd_docs, no_docs, clashing):
    rows = langid.identify_language(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3, 9)} == {("und", 0.0)}
    assert {r.lang_pred for r in langid.identify_language(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify_language(no_docs).count() == 0
    assert langid.identify_language(clashing).count() == len(rows)
    assert words(3, 1) == words(3, 1)
