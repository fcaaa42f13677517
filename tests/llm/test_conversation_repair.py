import hashlib
import itertools
import random
import re
import zlib

import pytest
from chatledger.llm import conversation_repair as C
from chatledger.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")
FILLED = re.compile(r"[^\x20\x09-\x0D]")


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        filled = FILLED.findall(text)
        out.append("blank" if not filled else "duplicate" if (role, text) in seen else "truncated" if filled[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_edits(rows):
    """(cost, initials) by a table of whole strings: for each state after each row the least of all ways."""
    next_of = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, "")}

    def inserts(best):
        for _ in range(4):
            for s, (c, x) in list(best.items()):
                t = next_of[s]
                best[t] = min(best.get(t, (10**9, "")), (c + 2, x + "I"))
        return best

    for (role, _), fault in zip(rows, plain_faults(rows), strict=True):
        after = {}

        def put(state, way, after=after):
            after[state] = min(after.get(state, way), way)

        extra = fault == "truncated"
        for s, (c, x) in inserts(best).items():
            put(s, (c + 3, x + "D"))
            if fault in ("blank", "duplicate"):
                continue
            put(next_of[s], (c + 2 + extra, x + "R"))
            if role[:1] == "s" and s == 0:
                put(1, (c + extra, x + "K"))
            if role[:1] == "ua"[next_of[s] - 2]:
                put(next_of[s], (c + extra, x + "K"))
        best = after
    best = inserts(best)
    return min(best[s] for s in (0, 3) if s in best)


def every_edit(rows):
    """(cost, initials) by trying all edits of a few rows, with up to two inserts in each place."""
    faults, found = plain_faults(rows), []
    for letters in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * g + x for g, x in itertools.zip_longest(gaps, letters, fillvalue=""))
            cost = sum(C.COST[x] for x in audit) + sum(f == "truncated" and x != "D" for f, x in zip(faults, letters, strict=True))
            if any(f in ("blank", "duplicate") and x != "D" for f, x in zip(faults, letters, strict=True)):
                continue
            ways, at = [""], 0
            for x in audit:
                if x != "I":
                    role = rows[at][0][:1] or "?"
                    at += 1
                    ways = [w + role for w in ways] if x == "K" else [w + r for w in ways for r in "ua"] if x == "R" else ways
                else:
                    ways = [w + r for w in ways for r in "ua"]
            if any(SHAPE.fullmatch(w) for w in ways):
                found.append((cost, audit))
    return min(found)


def repaired(rows, audit):
    out, at, state = [], 0, ""
    for x in audit:
        if x == "I":
            out.append(("assistant" if state == "u" else "user", ""))
        else:
            role, text = rows[at]
            at += 1
            if x == "D":
                continue
            out.append((role if x == "K" else "assistant" if state == "u" else "user", text))
        state = out[-1][0][:1]
    return "\n".join(f"{r}:{t}" for r, t in out)


def plain(table):
    """The contract's row of each conversation."""
    groups = {}
    for conv, turn, role, text in table:
        held = groups.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        rows, turns = [r[1:] for r in held], {r[0] for r in held} - {None}
        faults = plain_faults(rows)
        cost, audit = plain_edits(rows)
        illegal = sum((a[0][:1], b[0][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in itertools.pairwise(rows))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(repaired(rows, audit).encode()).hexdigest())
    return out


def search(rows):
    letters = []
    tree = C.Survivors(0, letters.append)
    for (role, _), fault in zip(rows, plain_faults(rows), strict=True):
        tree.step(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
    tree.finish()
    return "".join(letters)


def some_rows(rng, n):
    roles = rng.choice([["user", "assistant"], ["user", "assistant", "system", "tool"], ["tool", ""], ["system", "user"]])
    return [(rng.choice(roles), rng.choice(["", " ", f"t{i}.", f"t{i}", "same.", "same"])) for i in range(n)]


def test_search_tries_all():
    rng = random.Random(5)
    for _ in range(60):
        rows = some_rows(rng, rng.randint(0, 4))
        assert every_edit(rows) == plain_edits(rows)
        assert search(rows) == plain_edits(rows)[1]


def test_search_of_longer_conversations():
    rng = random.Random(6)
    for _ in range(1500):
        rows = some_rows(rng, rng.randint(0, 40))
        assert search(rows) == plain_edits(rows)[1], rows


def test_memory_holds_what_is_not_settled():
    emitted = []
    tree = C.Survivors(0, emitted.append)
    for i in range(5000):
        tree.step("ua"[i % 2], i % 7 == 3, i % 5 == 0)
        assert i + 1 - sum(x != "I" for x in emitted) <= 20
    tree = C.Survivors(0, emitted.append)
    for _ in range(1000):
        tree.step("u", True, False)
        assert len(tree.best) <= 4 and tree.root.up is None


def test_segments_chain():
    rng = random.Random(7)
    for _ in range(400):
        rows = some_rows(rng, rng.randint(1, 30))
        faults = plain_faults(rows)
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randint(0, 5))))
        parts = [slice(a, b) for a, b in itertools.pairwise([0, *cuts, len(rows)])]

        def events(part, rows=rows, faults=faults):
            for i in range(part.start, part.stop):
                if faults[i] == "duplicate":
                    yield {"kind": 1, "ord": i}
                yield {"kind": 0, "ord": i, "role": rows[i][0], "text": rows[i][1]}

        ports = C.chain([C.summarise(events(p)) for p in parts])
        letters = []
        for part, (entry, leave, before) in zip(parts, ports, strict=True):
            assert before == (rows[part.start - 1][0][:1] if part.start else None)
            tree = C.Survivors(entry, letters.append)
            for i in range(part.start, part.stop):
                tree.step(rows[i][0][:1], faults[i] in ("blank", "duplicate"), faults[i] == "truncated")
            tree.finish(leave)
        assert "".join(letters) == plain_edits(rows)[1], (rows, cuts)


def as_dict(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


def run(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    return as_dict(queries.op11_conversation_repair(spark, str(tmp_path)))


def odd_rows():
    rng = random.Random(8)
    rows = []
    for conv in [*range(60), None]:
        for i, (role, text) in enumerate(some_rows(rng, rng.randint(1, 25))):
            turn = rng.choice([i, i, i, i // 2, None])
            rows.append((conv, turn, rng.choice([role, role, role, None]), rng.choice([text, text, "é😀!", "x" * 50_000, None, "  spaced .\t"])))
    return rows + rows[:40] + [(1000, 1, "user", "Only one"), (-7, None, None, None)]


def test_query_against_plain(spark, tmp_path):
    rows = odd_rows()
    assert run(spark, spark.createDataFrame(rows, SCHEMA), tmp_path) == plain(rows)


def test_whole_table(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(queries.op11_conversation_repair(spark, "/root/testdata/sf0.01")) == plain(rows)


@pytest.mark.parametrize("bits", [2, 4])
def test_conversation_over_many_segments(spark, bits):
    rng = random.Random(9)
    rows = [(1, i, r, t) for i, (r, t) in enumerate(some_rows(rng, 400))] + [(2, i, r, t) for i, (r, t) in enumerate(some_rows(rng, 90))] + [(None, i, r, t) for i, (r, t) in enumerate(some_rows(rng, 50))]
    damaged = C.damage(spark.createDataFrame(rows, SCHEMA))
    found = {r["conv"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in C.digest(C.repair(damaged, segment_bits=bits)).collect()}
    assert found == plain(rows)


def test_empty_and_clashing(spark, tmp_path):
    from pyspark.sql import functions as F

    assert run(spark, spark.createDataFrame([], SCHEMA), tmp_path) == {}
    rows = [(3, 1, "user", "Hello."), (3, 2, "assistant", "Yes."), (3, 3, "user", "Well")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("clash") for n in "conv seg ord k kind order edit fault entry exit h1 h2 c".split()})
    found = C.repair(df).orderBy("ord", "k").collect()
    assert [(r["edit"], r["role"], r["text"]) for r in found][:2] == [("K", "user", "Hello."), ("K", "assistant", "Yes.")]
    assert [r["edit"] for r in found[2:]] == ["D"] and found[2]["fault"] == "truncated"
