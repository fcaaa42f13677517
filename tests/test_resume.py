import collections
import json
import os
import time
import uuid

import pytest
from chatledger.operators import extract as EX
from chatledger.sources import sinks


def transcripts(spark, n, parts=8):
    rows = [(f"s{i}", f"c{i}", None, f"text {i}") for i in range(n)]
    return spark.createDataFrame(rows, "session_id string, conversation_id string, client_id string, transcript string").repartition(parts)


def test_one_cap_for_the_whole_job(spark, tmp_path):
    here, most = tmp_path / "now", tmp_path / "most"
    here.mkdir(), most.mkdir()

    def extractor(text):
        mine = here / uuid.uuid4().hex
        mine.touch()
        time.sleep(0.05)
        (most / f"{len(os.listdir(here))}").touch()
        mine.unlink()
        return json.dumps({"t": text})

    got = EX.run_extractor_resumable(transcripts(spark, 40), extractor, str(tmp_path / "ledger"), in_flight=3).collect()
    assert {r.session_id: json.loads(r.response)["t"] for r in got} == {f"s{i}": f"text {i}" for i in range(40)}
    assert 2 <= max(int(n) for n in os.listdir(most)) <= 3


def test_a_killed_run_goes_on_where_it_stopped(spark, tmp_path):
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()

    def extractor(text, deadly):
        if deadly and len(os.listdir(calls)) == 7:
            os._exit(1)  # the worker is gone in the middle of a call
        (calls / f"{text.replace(' ', '_')}.{uuid.uuid4().hex}").touch()
        return json.dumps({"t": text})

    df = transcripts(spark, 20)
    with pytest.raises(Exception):
        EX.run_extractor_resumable(df, lambda t: extractor(t, True), ledger, in_flight=1)
    assert EX.read_ledger(spark, ledger).count() == 7
    got = EX.run_extractor_resumable(df, lambda t: extractor(t, False), ledger, in_flight=4).collect()
    assert len(got) == 20 and all(r.error is None and r.response for r in got)
    assert set(collections.Counter(n.split(".")[0] for n in os.listdir(calls)).values()) == {1}
    assert len(os.listdir(calls)) == 20
    # a third run, with more sessions of which some are equal: only the new text is sent
    more = df.unionByName(df.limit(5)).unionByName(spark.createDataFrame([("n1", "c", None, "new"), ("n2", "c", None, "new")], df.schema))
    assert EX.run_extractor_resumable(more, lambda t: extractor(t, False), ledger).count() == 27
    assert len(os.listdir(calls)) == 21


def test_failures_are_rows_and_are_tried_again(spark, tmp_path):
    ledger = str(tmp_path / "ledger")

    def fails(text):
        if text == "text 3":
            raise ValueError("refused")
        return "{}"

    df = transcripts(spark, 5)
    got = {r.session_id: r for r in EX.run_extractor_resumable(df, fails, ledger).collect()}
    assert got["s3"].response is None and got["s3"].error == "refused" and got["s1"].response == "{}"
    got = {r.session_id: r for r in EX.run_faq_extractor_resumable(df, fails, ledger).collect()}
    assert json.loads(got["s3"].response) == {"faqs": [], "venta": None, "cliente": None, "error": "refused"}
    got = EX.run_extractor_resumable(df, lambda t: "{}", ledger).collect()
    assert len(got) == 5 and all(r.response == "{}" and r.error is None for r in got)
    none = df.limit(0)
    assert EX.run_extractor_resumable(none, fails, ledger).count() == 0


def test_counts_of_the_rows_written(spark, tmp_path):
    a = spark.range(7)
    counts = sinks.export_tables({"a": a, "empty": a.limit(0), "none": a.where("id < 0")}, str(tmp_path / "out"))
    assert counts == {"a": 7, "empty": 0, "none": 0}
    assert spark.read.json(str(tmp_path / "out" / "a")).count() == 7
