"""The corpus pipeline against a plain version of its five stages on a fixture, and stage by stage."""

import re
from collections import Counter

import corpus_pipeline
import pytest
import regex
from chatledger.llm import langid, pii, unigram
from chatledger.llm.common import table
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm.test_simhash import components, plain_fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    """Given documents, with rejected, repeated, near and masked rows, and rows of one id, among them."""
    docs = table(spark, SF_SMALL, "documents")
    base = [tuple(r) for r in docs.where("length(text) < 6000").orderBy("doc_id").limit(90).collect()]
    long = [r for r in base if len(WORD.findall(r[1] or "")) > 150]
    rows = list(base)
    rows += [(9000 + i, t, None, "a", len(t)) for i, t in enumerate(["", "12345 !!! 678", "½ ²", "Это предложение написано по-русски и больше нигде.", "日本語の文章です。"])]
    rows += [(9100, None, "en", None, None)]
    rows += [(9200 + i, r[1], r[2], "copy", r[4]) for i, r in enumerate(long[:5])]  # exact copies
    rows += [(9300 + i, r[1] + " indeed", r[2], "near", len(r[1]) + 7) for i, r in enumerate(long[5:9])]
    rows += [(-5, long[9][1] + " Write to ana@example.org or call +57 300 123 4567 from 10.1.2.3.", long[9][2], "pii", None)]
    rows += [(long[10][0], long[10][1], long[10][2], "other", long[10][4])] * 2  # repeated id and text, another source
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{path}/documents.parquet")
    return str(path)


def with_letters(rows):
    return [r for r in rows if r["text"] and regex.search(r"\p{L}", r["text"])]


def plain_one_of_each(rows):
    prints = {t: plain_fingerprint(t) for t in {r["text"] for r in rows}}
    values = sorted(set(prints.values()))
    pairs = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 4]
    root = components(pairs, values)
    least = {}
    for r in rows:
        key = root[prints[r["text"]]]
        least[key] = min(least.get(key, r["doc_id"]), r["doc_id"])
    return sorted(least.values())


def test_run_against_plain_stages(spark, fixture_dir):
    docs = table(spark, fixture_dir, "documents")
    rows = docs.collect()
    # 1: language
    kept = corpus_pipeline.identify_language(spark, docs, fixture_dir)
    assert kept.columns == docs.columns
    one = kept.collect()
    found = {r["doc_id"]: r for r in langid.classify(docs, langid.learn(docs)).collect()}
    assert Counter(r["doc_id"] for r in one) == Counter(r["doc_id"] for r in rows if not found[r["doc_id"]]["rejected"])
    ids = {r["doc_id"] for r in one}
    assert not ids & {9000, 9001, 9002, 9003, 9004, 9100}
    plain = with_letters(rows)
    assert ids <= {r["doc_id"] for r in plain} and len(ids) >= 0.97 * len({r["doc_id"] for r in plain if r["doc_id"] not in (9003, 9004)})
    # 2: near duplicates
    two = corpus_pipeline.drop_near_duplicates(spark, kept, fixture_dir)
    assert two.columns == docs.columns
    stay = two.collect()
    assert sorted(r["doc_id"] for r in stay) == plain_one_of_each(one)
    assert not {r["doc_id"] for r in stay} & set(range(9200, 9205))
    # 3: personal data
    three = corpus_pipeline.mask_personal_data(spark, two, fixture_dir).collect()
    by_id = {r["doc_id"]: r for r in three}
    for r in stay:
        want, end = "", 0
        for kind, start, stop, _ in sorted(pii.find_spans(r["text"]), key=lambda x: (x[1], -x[2])):
            if start >= end:
                want += r["text"][end:start] + f"[{kind.upper()}]"
            end = max(end, stop)
        assert by_id[r["doc_id"]]["text"] == want + r["text"][end:]
    assert "Write to [EMAIL] or call [PHONE] from [IP]." in by_id[-5]["text"]
    # 4 and 5: the mix, and its tokens
    out = corpus_pipeline.run(spark, fixture_dir).collect()
    model = unigram.load()
    size = Counter()
    for r in three:
        size[r["source"]] += len(WORD.findall(r["text"]))
    taken, seen = Counter(), Counter()
    for r in out:
        assert r["round_trip"] and r["n_tokens"] == len(r["tokens"])
        own, whole = WORD.findall(model.decode(r["tokens"])), WORD.findall(by_id[r["doc_id"]]["text"])
        it = iter(whole)
        assert all(w in it for w in own)  # its words, in order
        assert r["source"] == by_id[r["doc_id"]]["source"]
        taken[r["source"]] += len(own)
        seen[r["doc_id"]] += len(own)
    for s, want in plain_targets(size).items():
        assert abs(taken[s] - want) <= 64 + 1, (s, taken[s], want)
    assert all(seen[i] <= 2 * len(WORD.findall(by_id[i]["text"])) for i in seen)
    again = corpus_pipeline.run(spark, fixture_dir).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def plain_targets(size):
    """Weights 5, 2, 1 by source, null last; 150 % of all words; none above twice its size, the excess reshared."""
    names = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(size.values()), set(names), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * size[s] <= per * weight[s]}
        if not full:
            return target | {s: per * weight[s] for s in open_}
        for s in full:
            target[s] = 2 * size[s]
            left -= target[s]
        open_ -= full
    return target


def test_empty_documents(spark, fixture_dir, tmp_path):
    table(spark, fixture_dir, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_extra_columns_and_clashing_names(spark, fixture_dir):
    docs = table(spark, fixture_dir, "documents").limit(40).withColumns({n: F.lit("clash") for n in ("id", "h", "s", "row", "times", "tokens", "fp", "k")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, fixture_dir).columns == docs.columns
