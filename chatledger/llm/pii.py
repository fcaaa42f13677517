"""PII: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Kinds ``email ip card phone`` follow fixed patterns: leftmost, non-overlapping per kind, and a match
that fails its check is dropped without a retry.  These spans are always reported.  The method adds
spans of two further kinds: ``iban`` (mod-97) and ``phone_local``, a telephone number without a
``+`` whose score reaches the threshold only beside a context word.  An ``iban`` pattern that takes in
the next word is cut to its country's length, or group by group where the country is not listed, and a
candidate without a valid cut does not hide one that starts inside it.

Whole texts are searched.  Null or empty texts give no spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from chatledger.llm.common import prepare

KINDS = ("email", "ip", "card", "phone", "iban", "phone_local")
BASE_KINDS = KINDS[:4]
CONTEXT_CHARS = 40
THRESHOLD = 0.6

# Score of a confirmed pattern before its context, and the words that raise it.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "phone_local": 0.4}
CONTEXT_BONUS = 0.3
CONTEXT_MALUS = 0.3
CONTEXT = {
    "email": r"e-?mail|mail|correo|courriel|contact",
    "ip": r"ip|address|host|server|login|adresse|servidor",
    "card": r"card|visa|mastercard|credit|kredit|carte|tarjeta|pay",
    "phone": r"phone|tel|call|mobile|fax|whatsapp|telefon|téléphone|teléfono|llam\w+",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "phone_local": r"phone|tel|call|mobile|fax|whatsapp|telefon|téléphone|teléfono|llam\w+",
}
AGAINST = re.compile(r"(?<!\w)(?:version|isbn|order|invoice|serial|commit|bestell\w+|factura|facture)(?!\w)", re.I)
_CONTEXT = {k: re.compile(rf"(?<!\w)(?:{v})(?!\w)", re.I) for k, v in CONTEXT.items()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Every match of ip, card, phone and phone_local lies inside one such zone.
_ZONE = re.compile(r"[+0-9][-+0-9 .()]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")

# Characters of an IBAN by country, from the public registry.
_IBAN_LENGTHS = {
    c: int(n)
    for n, codes in (
        x.split(":")
        for x in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,CR,HR,LI,LV "
            "22:BG,BH,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST "
            "26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
        ).split()
    )
    for c in codes.split(",")
}

SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
SPAN_DDL = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    pos = 0
    while m := _IBAN.search(text, pos):
        start, s = m.start(), m.group()
        # Ends of the words of the match: where the pattern may also stop.
        ends = [k for k in range(15, len(s) + 1) if k == len(s) or s[k] == " "]
        length = _IBAN_LENGTHS.get(s[:2])
        cuts = [k for k in ends if k - s[:k].count(" ") == length] + [len(s)] if length else ends[::-1]
        end = next((k for k in cuts if mod97(s[:k])), None)
        if end:
            yield start, start + end
        pos = start + (end or 1)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # A match holds one @ after its local part, so each @ has one leftmost candidate.
    pos = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            pos = m.end()
        at = text.find("@", max(at + 1, pos))


def _numbers(text: str) -> Iterator[tuple[str, int, int]]:
    for zone in _ZONE.finditer(text):
        a, b = zone.span()
        if b - a < 7:
            continue
        s = zone.group()
        for m in _IP.finditer(s):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                yield "ip", a + m.start(), a + m.end()
        for m in _CARD.finditer(s):
            if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                yield "card", a + m.start(), a + m.end()
        if "+" in s:
            for m in _PHONE.finditer(s):
                if 9 <= len(_digits(m.group())) <= 15:
                    yield "phone", a + m.start(), a + m.end()
        for m in _LOCAL_PHONE.finditer(s):
            if 9 <= len(_digits(m.group())) <= 11:
                yield "phone_local", a + m.start(), a + m.end()


def score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    value = BASE_SCORE[kind] + CONTEXT_BONUS * bool(_CONTEXT[kind].search(near)) - CONTEXT_MALUS * bool(AGAINST.search(near))
    return round(min(1.0, max(0.0, value)), 3)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by kind as listed, then start."""
    if not text:
        return []
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    found += _numbers(text)
    found += [("iban", a, b) for a, b in _ibans(text)]
    base = [(a, b) for kind, a, b in found if kind in BASE_KINDS]
    out = []
    for kind, a, b in found:
        s = score(text, kind, a, b)
        if kind in BASE_KINDS or kind == "iban" or s >= THRESHOLD and not any(x < b and a < y for x, y in base):
            out.append((kind, a, b, s))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def joined(spans: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans)


def masked(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each personal span replaced by its kind in brackets; overlapping spans go as one."""
    out, pos = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= pos:
            out += [text[pos:a], f"[{kind.upper()}]"]
        pos = max(pos, b)
    return "".join(out) + text[pos:]


def detect_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, counts of the base kinds, ``base_sha256``, ``spans`` and ``spans_list``.

    Null or empty text: no spans.  Repeated rows: one result row each.  Null id: kept.  No shuffle.
    """
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                all_spans = [find_spans(t.as_py()) for t in part.column(1)]
                base = [[s for s in spans if s[0] in BASE_KINDS] for spans in all_spans]
                counts = [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in BASE_KINDS]
                sha = pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base], pa.string())
                rows = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans] for spans in all_spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *counts, sha, pa.array([joined(s) for s in all_spans], pa.string()), pa.array(rows, pa.list_(SPAN_TYPE))],
                    names=["id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "spans_list"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, spans_list {SPAN_DDL}"
    return docs.select(id_col, text_col).mapInArrow(run, ddl).withColumnRenamed("id", id_col)


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal spans replaced by ``[KIND]`` and the length kept in step.

    Null text stays null; a row without spans is unchanged; other columns pass through untouched.
    """
    prepare(docs.sparkSession)
    names = docs.columns
    at_text = names.index(text_col)
    at_len = names.index(length_col) if length_col in names else None

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(at_text).to_pylist()
                spans = [find_spans(t) for t in texts]
                columns = list(part.columns)
                columns[at_text] = pa.array([masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)], part.schema.field(at_text).type)
                if at_len is not None:
                    was = columns[at_len].to_pylist()
                    now = [len(t) if s else n for t, s, n in zip(columns[at_text].to_pylist(), spans, was, strict=True)]
                    columns[at_len] = pa.array(now, part.schema.field(at_len).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
