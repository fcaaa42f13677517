"""Incremental ingest stream (T1) and sessionization properties against brute force."""

import random
import shutil
from datetime import datetime, timedelta

import os
import time

from pyspark.sql import functions as F

from chatledger.operators import messages as M
from chatledger.streaming import ingest
from tests.test_chat_csv import row, write


def brute_force(rows):
    """Straight sequential definition: sort per conversation, 0-based index, break on >24 h."""
    out = {}
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    for conv, rs in by_conv.items():
        rs.sort(key=lambda r: (r[1], r[2]))
        n, prev = 1, None
        for i, r in enumerate(rs):
            if prev is not None and (r[1] - prev) > timedelta(hours=24):
                n += 1
            out[r[2]] = (i, f"{conv}__s{n}")
            prev = r[1]
    return out


def test_sessionize_matches_brute_force(spark):
    rnd = random.Random(7)
    rows, fr = [], 0
    for conv in ["a", "b", "hot"]:
        t = datetime(2024, 1, 1)
        for _ in range(400 if conv == "hot" else 60):
            t += rnd.choice([timedelta(seconds=0), timedelta(minutes=5), timedelta(hours=23, minutes=59), timedelta(hours=24),
                             timedelta(hours=24, seconds=1), timedelta(days=3)])
            rows.append((conv, t, fr))
            fr += 1
    rnd.shuffle(rows)
    expect = brute_force(rows)
    for parts, width in ((1, M.BUCKET_US), (7, M.BUCKET_US), (3, M.DAY_US), (5, 60_000_000)):
        df = spark.createDataFrame(rows, "conversation_id string, sent_at timestamp_ntz, file_row long").repartition(parts)
        got = {r.file_row: (r.message_index, r.session_id) for r in M.sessionize(df, width).collect()}
        assert got == expect


def some_messages(rnd, conversations=("a", "b", "hot", "late")):
    rows = []
    for conv in conversations:
        t = datetime(2024, 1, 1)
        for _ in range(150 if conv == "hot" else 40):
            t += rnd.choice([timedelta(seconds=0), timedelta(minutes=5), timedelta(minutes=50), timedelta(hours=24), timedelta(hours=24, seconds=1), timedelta(days=3)])
            rows.append((conv, t, len(rows)))
    return rows


def test_continued_sessions_equal_the_whole_recomputation(spark):
    """Batches in any order, late messages among them: the carried state numbers every message as one pass over all does."""
    schema = "conversation_id string, sent_at timestamp_ntz, file_row long"
    for seed in (1, 2):
        rnd = random.Random(seed)
        rows = some_messages(rnd)
        order = rows[:]
        rnd.shuffle(order)
        cuts = [0, 3, 40, 41, 150, len(order)]
        state = spark.createDataFrame([], M.bucket_summary(spark.createDataFrame([], schema)).schema)
        state, held = M.number_buckets(state), {}
        for lo, hi in zip(cuts, cuts[1:]):
            batch = order[lo:hi]
            changed = M.continue_buckets(state, M.bucket_summary(spark.createDataFrame(batch, schema))).collect()
            # rows before a conversation's first new message are not touched
            first = {}
            for conv, t, _ in batch:
                first[conv] = min(first.get(conv, t), t)
            hour = lambda t: int((t - datetime(1970, 1, 1)).total_seconds() // 3600)
            assert all(r["_bucket"] >= hour(first[r["conversation_id"]]) for r in changed)
            held |= {(r["conversation_id"], r["_bucket"]): r for r in changed}
            state = spark.createDataFrame(list(held.values()), state.schema)
        got = M.place_messages(spark.createDataFrame(rows, schema), state)
        assert {r.file_row: (r.message_index, r.session_id) for r in got.collect()} == brute_force(rows)
        whole = M.sessionize(spark.createDataFrame(rows, schema))
        assert sorted(got.select(*whole.columns).collect()) == sorted(whole.collect())


def test_stream_of_shuffled_batches(spark, tmp_path):
    """The stream's sessions equal those of one pass over its ledger, and a batch reads none of the messages before it."""
    raw = tmp_path / "raw"
    raw.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    rnd = random.Random(3)
    rows = some_messages(rnd, ("Ana", "Bob"))
    rnd.shuffle(rows)
    for i, part in enumerate((rows[:20], rows[20:23], rows[23:60], rows[60:])):
        if i == 3:  # what earlier batches wrote is not read: their messages may be away
            os.rename(f"{out}/messages", f"{out}/away")
        for conv in ("Ana", "Bob"):
            lines = [row(chat=conv, sent=f"{t:%Y-%m-%d %H:%M:%S}", text=f"m{n}") for c, t, n in part if c == conv]
            if lines:
                write(raw, conv + ".csv" * (i + 1), lines)  # names of one conversation
        ingest.start(spark, str(raw), out, ckpt).awaitTermination(120)
    batches = spark.read.parquet(f"{out}/hours").groupBy("conversation_id").agg(F.countDistinct("batch").alias("n")).collect()
    assert len(batches) == 2 and min(r["n"] for r in batches) > 2
    for bucket in os.listdir(f"{out}/away"):
        if bucket.startswith("bucket="):
            for b in os.listdir(f"{out}/away/{bucket}"):
                shutil.copytree(f"{out}/away/{bucket}/{b}", f"{out}/messages/{bucket}/{b}", dirs_exist_ok=True)
    ledger = spark.read.parquet(f"{out}/messages").drop("bucket", "batch")
    whole = M.sessionize(ledger)
    got = ingest.read_sessions(spark, out).select(*whole.columns)
    assert got.count() == len(rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_incremental_ingest(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    write(raw, "WhatsApp - Ana.csv", [row(sent="2024-01-01 10:00:00", text="a1"), row(sent="2024-01-03 10:00:00", text="a2")])
    write(raw, "notas.txt", [row(text="ignored")])
    q = ingest.start(spark, str(raw), out, ckpt)
    q.awaitTermination(120)
    s1 = ingest.read_sessions(spark, out).filter(F.col("conversation_id") == "WhatsApp - Ana")
    assert sorted(r.session_id for r in s1.collect()) == ["WhatsApp - Ana__s1", "WhatsApp - Ana__s2"]
    # a new file, however old its date; an already-read name is never read again
    write(raw, "WhatsApp - Bob.csv", [row(chat="WhatsApp - Bob", contact="", sent="2024-02-01 10:00:00", text="b1")])
    then = time.time() - 400 * 86400
    os.utime(raw / "WhatsApp - Bob.csv", (then, then))
    write(raw, "WhatsApp - Cleo.csv", [])
    q = ingest.start(spark, str(raw), out, ckpt)
    q.awaitTermination(120)
    sess = ingest.read_sessions(spark, out)
    # the second batch wrote the conversation that it touched, and no other
    assert {r.conversation_id for r in spark.read.parquet(f"{out}/hours").where("batch = 1").collect()} == {"WhatsApp - Bob"}
    assert {r.conversation_id for r in sess.collect()} == {"WhatsApp - Ana", "WhatsApp - Bob"}
    assert sess.count() == 3
    msgs = spark.read.parquet(f"{out}/messages")
    assert msgs.count() == 3


def test_ingest_drops_overlong_rows(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    write(raw, "WhatsApp - Cy.csv", [row(sent="2024-01-01 10:00:00", text="ok"), row(sent="2024-01-01 11:00:00", text="largo") + ",x"])
    ingest.start(spark, str(raw), out, ckpt).awaitTermination(120)
    assert [r.text for r in spark.read.parquet(f"{out}/messages").collect()] == ["ok"]
