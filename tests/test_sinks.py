"""Writers K1-K3, K6 round trips: Parquet/CSV messages, session JSON lines, flat sales CSV."""

import csv
import glob
import json

from chatledger import schemas as S
from chatledger.operators import messages as M
from chatledger.operators import sessions as SS
from chatledger.sources import jsonl, sinks
from chatledger.sources.chat_csv import read_chat_csvs
from tests.test_chat_csv import make_fixture


def _msgs(spark, tmp_path):
    return M.normalise(read_chat_csvs(spark, make_fixture(tmp_path)), "yyyy-MM-dd HH:mm:ss")


def test_messages_parquet_and_csv(spark, tmp_path):
    msgs = _msgs(spark, tmp_path)
    n = msgs.count()
    sinks.write_messages(msgs, str(tmp_path / "m.parquet"))
    assert spark.read.parquet(str(tmp_path / "m.parquet")).count() == n
    sinks.write_messages(msgs.select("conversation_id", "text"), str(tmp_path / "m.csv"), fmt="csv")
    rows = []
    for f in glob.glob(str(tmp_path / "m.csv" / "*.csv")):
        with open(f, newline="", encoding="utf-8") as fh:
            rows += list(csv.DictReader(fh))
    assert len(rows) == n
    assert "hola\nbuenas" in {r["text"] for r in rows}  # newline survives quoting


def test_sessions_jsonl_roundtrip(spark, tmp_path):
    rec = SS.session_records(_msgs(spark, tmp_path))
    path = str(tmp_path / "conversaciones")
    sinks.write_sessions(rec, path)
    lines = [json.loads(x) for f in glob.glob(path + "/*.json") for x in open(f, encoding="utf-8")]
    assert len(lines) == rec.count()
    assert all(set(r) == {"conversation_id", "session_id", "client_id", "messages"} for r in lines)
    back = jsonl.read_sessions(spark, path, 2).collect()
    assert len(back) == 2 and back[0].session_id <= back[1].session_id
    assert jsonl.read_sessions(spark, path, 0).count() == rec.count()  # 0 means no limit
    assert back[0].messages[0].timestamp is not None


def test_sales_csv_nulls_empty(spark, tmp_path):
    cols = sinks.SALES_COLUMNS
    df = spark.createDataFrame([tuple(["x"] + [None] * (len(cols) - 1))], ", ".join(f"{c} string" for c in cols))
    sinks.write_sales_csv(df, str(tmp_path / "ventas"))
    files = [open(f, encoding="utf-8").read().splitlines() for f in glob.glob(str(tmp_path / "ventas" / "*.csv"))]
    data = [lines for lines in files if len(lines) > 1]
    assert len(data) == 1
    header, line = data[0][:2]
    assert header.split(",") == cols
    assert line == "x" + "," * (len(cols) - 1)


def test_json_tables_roundtrip(spark, tmp_path):
    p = spark.createDataFrame([("p1", "Muffin", None, None)], S.PRODUCTS_SCHEMA)
    sinks.write_json(p, str(tmp_path / "products"))
    lines = [json.loads(x) for f in glob.glob(str(tmp_path / "products" / "*.json")) for x in open(f, encoding="utf-8") if x.strip()]
    assert len(lines) == 1
    assert lines[0]["variant"] is None and "variant" in lines[0]
