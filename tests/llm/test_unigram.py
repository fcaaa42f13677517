import functools
import math
import struct

import pytest
from chatledger.llm import unigram

from tests.llm.conftest import words


@pytest.fixture(scope="module")
def model():
    return unigram.load()


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def message(field, data):
    return varint(field << 3 | 2) + varint(len(data)) + data


def small(pieces, kind=1, prefix=1, squeeze=0):
    out = b"".join(message(1, message(1, p.encode()) + varint(2 << 3 | 5) + struct.pack("<f", s) + varint(3 << 3) + varint(t)) for p, s, t in pieces)
    return unigram.Model(out + message(2, varint(3 << 3) + varint(kind)) + message(3, message(1, b"identity") + varint(3 << 3) + varint(prefix) + varint(4 << 3) + varint(squeeze)))


def best_score(model, text):
    own = {p: s for p, s, t in zip(model.pieces, model.scores, model.types) if t == unigram.NORMAL}
    long = max(map(len, own))
    best = [0.0] + [-math.inf] * len(text)
    for e in range(1, len(text) + 1):
        for s in range(max(0, e - long), e):
            piece = text[s:e]
            if piece in own or e - s == 1:
                best[e] = max(best[e], best[s] + own.get(piece, model.unk_score))
    return best[-1]


def score(model, ids):
    total, raw = 0.0, b""
    for i in ids:
        if model.types[i] == unigram.BYTE:
            raw += bytes([int(model.pieces[i][3:5], 16)])
            continue
        total += model.unk_score * len(raw.decode()) + model.scores[i]
        raw = b""
    return total + model.unk_score * len(raw.decode())


TEXTS = ["a", " a", "  b  c ", "\n\n x\ny", "日本語テスト", "naïve 😀😀 café", "a\tb\r\n", "x" * 300, "▁x", " ", "\n", "a\n\n", "a \n b", words(300, 9), "&&& $$$ %%%\x00\x0b"]


@pytest.mark.parametrize("text", TEXTS)
def test_best_path_and_round_trip(model, text):
    ids = model.encode([text])[0]
    assert model.decode(ids) == text.replace("▁", " ")
    assert score(model, ids) == pytest.approx(best_score(model, model.normalised(text)), abs=1e-6)


def test_many_texts_at_once_equal_one_by_one(model):
    fresh = unigram.load()
    assert model.encode(TEXTS + TEXTS) == [fresh.encode([t])[0] for t in TEXTS + TEXTS]


def test_double_array_holds_exactly_its_keys():
    keys = [bytes([a, b, c])[: 1 + (a + b + c) % 3] for a in range(0, 250, 17) for b in (0, 1, 254) for c in (0, 7, 255)]
    keys = sorted(set(keys))
    trie = unigram.DoubleArray(keys, list(range(len(keys))))
    import numpy as np

    def find(key):
        node = np.array([0])
        for c in key:
            node = trie.step(node, np.array([c]))
            if node[0] < 0:
                return -1
        return int(trie.value[node[0]])

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert find(b"\xfe\xfe") == -1 and find(b"zz") == -1


def test_own_scores_unknowns_and_flags():
    m = small([("<unk>", 0, 2), ("▁", -1, 1), ("ab", -1.5, 1), ("a", -1, 1), ("b", -1, 1), ("▁ab", -4, 1)], prefix=1, squeeze=1)
    assert m.encode(["  ab   ab "])[0] == [1, 2, 1, 2]
    assert m.encode(["z"])[0] == [1, 0]
    crossing = small([("<unk>", 0, 2), ("a▁b", -0.1, 1), ("a", -1, 1), ("b", -1, 1), ("▁", -1, 1)], prefix=0)
    assert crossing.encode(["a b"])[0] == [1]


def test_documents(spark, model, odd_docs, no_docs, clashing):
    out = unigram.encode_documents(odd_docs, model)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(r.round_trip for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert unigram.encode_documents(no_docs, model).count() == 0
    assert unigram.encode_documents(clashing, model).count() == len(rows)
    texts = {(r.doc_id, r.n_chars): r.text or "" for r in odd_docs.collect()}
    for r in unigram.decode_documents(out, model).collect():
        assert r.text == texts[r.doc_id, r.n_chars]
