import hashlib
import re

import pytest

from chatledger.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile("[^0-9]")


def plain(text):
    """The contract's patterns as they stand."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = DIGITS.sub("", m.group())
        total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1]))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.sub("", m.group())) <= 15]
    return out


TEXTS = [
    "", "a@b.c", "a@b", "x.y+z@host-1.example.com, q@w.e", "a@@b.c", "a@b.c@d.e", "a@b.com_c@d.org", "@@@", "a@b.c.", "1.2.3.4", "1.2.3.4.5.6.7.8",
    "256.1.1.1 10.0.0.255", "0000001.002.3.4", "1..2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4111  1111 1111 1111",
    "+1 (555) 010-9999", "+1+1 555 0109999", "+123456789", "+12345678", "++123456789)", "+1 234 567 890 123 456 789", "٤111111111111111", "1.2.3.4 4111111111111111 +4915112345678",
    "9" * 3000, "1." * 500, "+1" * 200, "é@b.c日本 a@ü.de", "a" * 5000 + "@b.co",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_are_the_patterns(text):
    found = [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]
    assert found == plain(text)


def test_random_texts_agree_with_the_patterns():
    import random

    rng = random.Random(7)
    for _ in range(4000):
        text = "".join(rng.choice("0123456789 .-+()@ab,\n") for _ in range(rng.randint(1, 60)))
        assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == plain(text), text


def test_context_and_checksums():
    kinds = lambda t: [s[0] for s in pii.find_spans(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 ok") == ["iban"]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00 ok") == []
    assert kinds("please call 555 123 4567 today") == ["phone_local"]
    assert kinds("there were 555 123 4567 of them") == []
    near, far = pii.find_spans("server 10.1.2.3")[0], pii.find_spans("version 10.1.2.3")[0]
    assert near[3] > far[3]


@pytest.mark.parametrize(
    "text, want",
    [
        ("ES91 2100 0418 4502 0005 1332 EUR", ["ES91 2100 0418 4502 0005 1332"]),
        ("BE68 5390 0754 7034 BIC KREDBEBB", ["BE68 5390 0754 7034"]),
        ("AT61 1904 3002 3457 3201 BKAUATWW", ["AT61 1904 3002 3457 3201"]),
        ("PL61 1090 1014 0000 0712 1981 2874 1000 PLN", ["PL61 1090 1014 0000 0712 1981 2874"]),
        ("DE89 3704 0044 0532 0130 00 2024", ["DE89 3704 0044 0532 0130 00"]),
        ("DE89370400440532013000 EUR", ["DE89370400440532013000"]),
        ("AB12 3456 7890 ES91 2100 0418 4502 0005 1332", ["ES91 2100 0418 4502 0005 1332"]),
        ("BE68 5390 0754 7034 ES91 2100 0418 4502 0005 1332", ["BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332"]),
        ("ES92 2100 0418 4502 0005 1332 EUR", []),
    ],
)
def test_iban_before_another_word(text, want):
    assert [text[a:b] for k, a, b, _ in pii.find_spans(text) if k == "iban"] == want
    assert all(w not in pii.masked(text, pii.find_spans(text)) for w in want)


def test_masking():
    text = "mail a@b.co, pay 4111 1111 1111 1111."
    assert pii.masked(text, pii.find_spans(text)) == "mail [EMAIL], pay [CARD]."


def test_query_columns_and_odd_rows(odd_docs, no_docs, clashing):
    rows = pii.detect_pii(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.base_sha256 for r in rows if r.doc_id in (1, 2)} == {hashlib.sha256(b"").hexdigest()}
    assert pii.detect_pii(no_docs).count() == 0
    assert pii.mask_pii(clashing).columns == clashing.columns
    assert {r.doc_id: r.text for r in pii.mask_pii(odd_docs).collect()}[1] is None


def test_masked_rows_keep_their_length_in_step(spark):
    docs = spark.createDataFrame([(1, "to a@b.co", 9), (2, "clean", 5)], "doc_id bigint, text string, n_chars bigint")
    assert [tuple(r) for r in pii.mask_pii(docs).orderBy("doc_id").collect()] == [(1, "to [EMAIL]", 10), (2, "clean", 5)]
