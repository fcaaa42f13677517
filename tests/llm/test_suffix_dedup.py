import collections
import hashlib
import random

import numpy as np
import pytest
from chatledger.llm import suffix_dedup as sd
from chatledger.llm.queries import QUERIES


def brute(texts, length):
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for i in range(len(t)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    base = "".join(rng.choice("abé") for _ in range(120))
    out = []
    for _ in range(n):
        t = "".join(rng.choice("ab") for _ in range(rng.randint(0, 30)))
        a = rng.randint(0, 100)
        t += base[a : a + rng.randint(0, 60)] + rng.choice(["", "x", "yy"])
        out.append(t)
    return [*out, None, "", "a" * 300, out[3], out[3], base * 3]


@pytest.mark.parametrize(("length", "gram", "max_group"), [(20, 5, 1024), (20, 20, 3), (12, 4, 2), (8, 1, 1024)])
def test_rows_equal_brute_force(spark, length, gram, max_group):
    texts = corpus(length)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:5] for r in sd.remove_repeats(docs, length=length, gram=gram, max_group=max_group).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    want = brute([(t or "").encode() for t in texts], length)
    assert got == dict(enumerate(want))


def test_hash_collisions_do_not_matter(monkeypatch):
    # All hashes equal: neighbours are verified on bytes and groups sorted by them.
    monkeypatch.setattr(sd._Contexts, "same", lambda self, a, b, size, way: np.ones(len(a), bool))
    contexts = [b"xxabcdeyy", b"zzabcdeyy", b"zzabcdfyy", b"qqabcdeyz"]
    member, first, last = sd.repeated_distances(contexts, np.full(4, 4), np.array([0, 4]), 6, 3)
    found = {(m, d) for m, a, b in zip(member.tolist(), first.tolist(), last.tolist()) for d in range(a, b + 1)}
    want = set()
    for d in range(4):
        windows = [c[4 - d : 10 - d] for c in contexts]
        want |= {(i, d) for i, w in enumerate(windows) if len(w) == 6 and windows.count(w) > 1}
    assert found == want


def test_odd_rows(odd_docs, no_docs, clashing):
    rows = sd.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_bytes, r.n_removed))
    assert by[1] == {(0, 0)} and by[7] == {(200_000, 200_000)}
    assert sd.remove_repeats(no_docs).count() == 0
    assert sd.remove_repeats(clashing).count() == odd_docs.count()


def test_planted_passages_go_from_400_bytes_on(spark, tmp_path):
    # Passages of over 50 words in two documents each: n_removed tells which are cut, n_bytes is the size as given.
    rng = random.Random(400)
    prose = lambda n: " ".join("".join(rng.choice("abcdeilmnorstué") for _ in range(rng.randint(3, 6))) for _ in range(n))
    texts, want = [], []
    for size in [399, 400] * 6 + [401, 700]:
        raw = prose(200).encode()[:size]
        passage = raw.decode(errors="ignore")
        passage += "z" * (size - len(passage.encode()))
        assert len(passage.encode()) == size and len(passage.split()) > 50
        for a, b in ("<>", "[]"):  # other bytes beside it, so nothing longer repeats
            texts.append(prose(rng.randint(0, 300)) + a + passage + b + prose(rng.randint(0, 300)))
            want.append(size if size >= 400 else 0)
    for _ in range(20):  # clean ones
        texts.append(prose(rng.randint(51, 600)))
        want.append(0)
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:5] for r in QUERIES["op2_suffix_dedup"](spark, str(tmp_path)).collect()}
    raws = [t.encode() for t in texts]
    assert {k: v[:2] for k, v in got.items()} == {k: (len(t), n) for k, (t, n) in enumerate(zip(raws, want, strict=True))}
    assert got == dict(enumerate(brute(raws, sd.LENGTH)))
