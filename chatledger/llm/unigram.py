"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The model file is read here (its pieces, scores and flags); texts are encoded by the best sum of log
scores, characters that no piece covers fall back to their bytes, and spaces are the marker U+2581.
A unigram model's scores are used as they are.  A BPE model carries merge ranks, not log scores: its
pieces get scores by Zipf's law over those ranks, ``-log(rank + 2.7)``.

No piece crosses a point where the marker follows another character, and no piece holds a line
feed, so a text falls into chunks at these points; each is solved on its own and frequent chunks are
remembered.  Many chunks are solved at once: all start places walk the trie together, then the best
path is found for all chunks place by place.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import prepare, with_fields

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
REMEMBERED = 200_000  # chunks remembered by a worker
BATCH_BYTES = 1 << 18  # bytes of chunks solved at once
UNK_PENALTY = 10.0

# Piece types and field numbers of the model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes):
    """(field, value) of a protocol buffer message: ints, bytes, or floats for 32-bit fields."""
    i = 0

    def varint(i):
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value, i

    while i < len(data):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = data[i : i + n], i + n
        elif kind == 5:
            value, i = struct.unpack("<f", data[i : i + 4])[0], i + 4
        elif kind == 1:
            value, i = data[i : i + 8], i + 8
        else:
            raise ValueError("not a model file")
        yield tag >> 3, value


class DoubleArray:
    """A trie of byte strings: node ``s`` goes by byte ``c`` to ``t = base[s] + c + 1`` if ``check[t] == s``."""

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys, values = [keys[i] for i in order], [values[i] for i in order]
        size = 1 << 16
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        used = bytearray(size)
        used[0] = 1
        start: dict[int, int] = {}
        todo = [(0, 0, len(keys), 0)]
        while todo:
            node, lo, hi, depth = todo.pop()
            if lo < hi and len(keys[lo]) == depth:
                value[node] = values[lo]
                lo += 1
            if lo == hi:
                continue
            children, k = [], lo
            while k < hi:
                c, first = keys[k][depth], k
                while k < hi and keys[k][depth] == c:
                    k += 1
                children.append((c, first, k))
            # The search goes on from where nodes with as many children last found room.
            head, many = children[0][0], min(len(children), 8)
            t = start.get(many, 1)
            while True:
                t = used.find(0, t)
                if t < 0 or t + 1024 > len(used):
                    t = len(used) if t < 0 else t
                    self._grow(base, check, value, used)
                b = t - head - 1
                if b >= 0 and not any(used[b + c + 1] for c, _, _ in children):
                    break
                t += 1
            start[many] = t if many > 1 else t + 1
            base[node] = b
            for c, first, last in children:
                t = b + c + 1
                used[t], check[t] = 1, node
                todo.append((t, first, last, depth + 1))
        n = len(used)
        while n > 1 and not used[n - 1]:
            n -= 1
        n += 512  # any step from any node stays inside
        self._grow(base, check, value, used, n - len(used)) if n > len(used) else None
        self.base, self.check, self.value = (np.array(x[:n], np.int32) for x in (base, check, value))

    @staticmethod
    def _grow(base, check, value, used, by: int | None = None) -> None:
        by = by or len(used)
        base.extend([0] * by)
        check.extend([-1] * by)
        value.extend([-1] * by)
        used.extend(bytes(by))

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes reached, -1 where there is none."""
        t = self.base[node] + byte + 1
        t = np.minimum(t, len(self.check) - 1)
        return np.where((self.check[t] == node) & (t > 0), t, -1)


class Model:
    """A model file, read once on the driver and sent to the tasks (its size is the vocabulary's)."""

    def __init__(self, data: bytes) -> None:
        pieces, kind, flags = [], UNIGRAM, {"prefix": True, "squeeze": True}
        for f, v in _fields(data):
            if f == 1:
                p = dict(_fields(v))
                pieces.append((p[1].decode(), p.get(2, 0.0), p.get(3, NORMAL)))
            elif f == 2:
                kind = dict(_fields(v)).get(3, UNIGRAM)
            elif f == 3:
                spec = dict(_fields(v))
                if spec.get(2):
                    raise ValueError("models with a normalisation table are not supported")
                flags = {"prefix": bool(spec.get(3, 1)), "squeeze": bool(spec.get(4, 1))}
        if kind not in (UNIGRAM, BPE):
            raise ValueError("neither a unigram nor a BPE model")
        self.dummy_prefix, self.squeeze = flags["prefix"], flags["squeeze"]
        self.pieces = [p for p, _, _ in pieces]
        self.types = [t for _, _, t in pieces]
        own = [i for i, t in enumerate(self.types) if t in (NORMAL, USER_DEFINED)]
        if kind == BPE:
            rank = {i: k for k, i in enumerate(sorted(own, key=lambda i: (-pieces[i][1], i)))}
            scores = {i: -math.log(rank[i] + 2.7) for i in own}
        else:
            scores = {i: pieces[i][1] for i in own}
        self.scores = np.full(len(pieces) + 1, -np.inf)
        self.scores[list(scores)] = list(scores.values())
        lowest, highest = (min(scores.values()), max(scores.values())) if scores else (0.0, 0.0)
        for i in own:
            if self.types[i] == USER_DEFINED:
                self.scores[i] = len(self.pieces[i]) * highest - 0.1
        self.unk = next((i for i, t in enumerate(self.types) if t == UNKNOWN), 0)
        self.unk_score = lowest - UNK_PENALTY
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, t in enumerate(self.types) if t == BYTE}
        self.trie = DoubleArray([self.pieces[i].encode() for i in own], own)
        crossing = [p for i, p in enumerate(self.pieces) if i in scores and (MARKER in p.lstrip(MARKER) or "\n" in p)]
        # A piece that crosses a chunk's edge would make chunks depend on each other.
        self.chunk = re.compile(r".+" if crossing else rf"\n|{MARKER}+[^{MARKER}\n]*|[^{MARKER}\n]+", re.S)
        self.plain = not crossing and self.dummy_prefix and not self.squeeze
        self.surface = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else p.replace(MARKER, " ").encode() for p, t in zip(self.pieces, self.types, strict=True)]
        self.known: dict[str, tuple[int, ...]] = {}  # by key, see split()
        self.older: dict[str, tuple[int, ...]] = {}

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", MARKER)
        return MARKER + text if text and self.dummy_prefix else text

    def split(self, text: str) -> list[str]:
        """Keys of the text's chunks: a chunk after a marker is what follows it, a line feed is itself,
        and any other chunk comes after two line feeds."""
        if self.plain and text and text[0] != " " and "  " not in text and MARKER not in text:
            return text.replace("\n", " \n \n\n").split(" ")
        found = self.chunk.findall(self.normalised(text))
        return [c if c == "\n" else c[1:] if c[0] == MARKER and "\n" not in c else "\n\n" + c for c in found]

    @staticmethod
    def chunk_of(key: str) -> str:
        return key if key == "\n" else key[2:] if key.startswith("\n\n") else MARKER + key

    def solve(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """Best pieces of each chunk."""
        raw = [c.encode() for c in chunks]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"\xff".join(raw) + b"\xff", np.uint8).astype(np.int32)  # 0xFF is in no UTF-8 text
        begin = np.cumsum(size + 1) - size - 1
        chunk = np.repeat(np.arange(len(raw)), size + 1)
        start = np.flatnonzero((data & 0xC0 != 0x80) & (data != 0xFF))
        # All matches of pieces, from all starts at once.
        at, node, k = start, np.zeros(len(start), np.int32), 0
        edges: list[tuple[np.ndarray, ...]] = []
        width = np.where(data[start] < 0x80, 1, np.where(data[start] < 0xE0, 2, np.where(data[start] < 0xF0, 3, 4)))
        covered = np.zeros(len(data), bool)
        wide = np.zeros(len(data), np.int64)
        wide[start] = width
        while len(at):
            node = self.trie.step(node, data[at + k])
            live = node >= 0
            at, node, k = at[live], node[live], k + 1
            piece = self.trie.value[node]
            hit = piece >= 0
            edges.append((at[hit], at[hit] + k, piece[hit]))
            covered[at[hit][wide[at[hit]] == k]] = True
        bare = start[~covered[start]]
        edges.append((bare, bare + wide[bare], np.full(len(bare), -1)))
        a, b, piece = (np.concatenate(x) for x in zip(*edges, strict=True))
        score = np.where(piece >= 0, self.scores[piece], self.unk_score)
        # Ends in step, chunk by chunk; of equal paths the one whose last piece starts first.
        own = chunk[a]
        local = b - begin[own]
        order = np.lexsort((piece < 0, a, own, local))
        a, b, piece, score, local = a[order], b[order], piece[order], score[order], local[order]
        best = np.full(len(data) + 1, -np.inf)
        best[begin] = 0.0
        back = np.zeros(len(data) + 1, np.int64)
        bounds = np.concatenate(([0], np.flatnonzero(local[1:] != local[:-1]) + 1, [len(local)])) if len(local) else [0]
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            total = best[a[s:e]] + score[s:e]
            end = b[s:e]
            seg = np.concatenate(([0], np.flatnonzero(end[1:] != end[:-1]) + 1))
            top = np.maximum.reduceat(total, seg)
            best[end[seg]] = top
            first = np.flatnonzero(total == np.repeat(top, np.diff(np.append(seg, e - s))))[::-1]
            back[end[first]] = s + first
        # Back from all ends together.
        live, cur = np.flatnonzero(size), begin + size
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while live.size:
            edge = back[cur[live]]
            steps.append((live, piece[edge], a[edge]))
            cur[live] = a[edge]
            live = live[cur[live] > begin[live]]
        if not steps:
            return [()] * len(chunks)
        who, ids, places = (np.concatenate([s[i] for s in steps]) for i in range(3))
        order = np.lexsort((places, who))
        who, ids, places = who[order], ids[order].tolist(), places[order].tolist()
        edge = np.searchsorted(who, np.arange(len(raw) + 1)).tolist()
        out = []
        for i in range(len(raw)):
            found = ids[edge[i] : edge[i + 1]]
            if -1 in found:
                found = [x for p, place in zip(found, places[edge[i] : edge[i + 1]], strict=True) for x in ([p] if p >= 0 else self._fallback(data[place : place + wide[place]].tolist()))]
            out.append(tuple(found))
        return out

    def _fallback(self, raw: list[int]) -> list[int]:
        return [self.bytes[c] for c in raw] if self.bytes else [self.unk]

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.split(t) for t in texts]
        known, older = self.known, self.older
        missing = set().union(*split).difference(known)
        for c in missing.intersection(older):
            known[c] = older[c]
        new = sorted(missing.difference(older), key=len)
        # Chunks of like length are solved together.
        size = np.fromiter(map(len, new), np.int64, len(new))
        total = np.cumsum(4 * size + 16)
        at = 0
        while at < len(new):
            fits = int(np.searchsorted(total, (total[at - 1] if at else 0) + BATCH_BYTES, "right"))
            end = max(at + 1, min(fits, int(np.searchsorted(size, 2 * size[at] + 16, "right"))))
            known.update(zip(new[at:end], self.solve([self.chunk_of(c) for c in new[at:end]]), strict=True))
            at = end
        out = [list(chain.from_iterable(map(known.__getitem__, chunks))) for chunks in split]
        for c in new[int(np.searchsorted(size, 64)) :]:  # unlikely to come again
            del known[c]
        if len(known) > REMEMBERED:  # chunks of the last two generations stay
            self.older, self.known = known, {}
        return out

    def decode(self, ids: list[int]) -> str:
        """The text: markers are spaces, bytes are put together, and the prefix goes."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        if self.dummy_prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def load(path: str = MODEL) -> Model:
    with open(path, "rb") as f:
        return Model(f.read())


def encode_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``tokens`` (ids), ``n_tokens``, ``n_byte_tokens``, ``tokens_sha256``
    (of the ids as 32-bit little-endian numbers) and ``round_trip``: whether decoding gives the text again.

    Null and empty texts have no tokens and come back as the empty text.  A text that holds the marker
    itself comes back with spaces there, so its ``round_trip`` is false.
    """
    prepare(docs.sparkSession)
    new = {"tokens": "array<int>", "n_tokens": "bigint", "n_byte_tokens": "bigint", "tokens_sha256": "string", "round_trip": "boolean"}
    docs = docs.drop(*[c for c in new if c != text_col])
    at = docs.columns.index(text_col)
    fallback = frozenset(model.bytes.values())

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                texts = [t or "" for t in part.column(at).to_pylist()]
                tokens = model.encode(texts)
                flat = [np.array(t, "<i4") for t in tokens]
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
                expected = [t if not model.squeeze else re.sub(" +", " ", t).strip(" ") for t in texts]
                rest = [i for i in range(part.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in rest),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), pa.int32())),
                        pa.array([len(t) for t in tokens], pa.int64()),
                        pa.array([int(np.count_nonzero(np.isin(t, list(fallback)))) if model.bytes else 0 for t in flat], pa.int64()),
                        pa.array([hashlib.sha256(t.tobytes()).hexdigest() for t in flat], pa.string()),
                        pa.array([model.decode(t) == e for t, e in zip(tokens, expected, strict=True)], pa.bool_()),
                    ],
                    names=[*(part.schema.names[i] for i in rest), *new],
                )

    return docs.mapInArrow(run, with_fields(docs.drop(text_col).schema, ", ".join(f"{n} {k}" for n, k in new.items())))


def decode_documents(encoded: DataFrame, model: Model, tokens_col: str = "tokens", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its tokens; null tokens give null."""
    prepare(encoded.sparkSession)

    @F.pandas_udf("string")
    def decode(ids):
        return ids.map(lambda x: None if x is None else model.decode(list(x)))

    return encoded.withColumn(text_col, decode(tokens_col))
