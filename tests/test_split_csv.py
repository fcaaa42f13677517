"""Chat CSVs read in splits: the same rows as each file read by one task."""

import random

import pytest
from chatledger.sources import chat_csv as C

FIELDS = ["", "a", "hola", '"q"', '"a ""b"" c"', '"x,y"', '"l1\nl2"', '"\n"', '"a\n\nb"', '""', '5" pipe', ' "sp"', "é😀", "  ", '"\n,""\n"', '"a""\n""b"', 'x"y"z', '"long ' + "w " * 60 + '\nmore"']


def plain_files(rng, count):
    for i in range(count):
        rows = []
        for _ in range(rng.randint(1, 40)):
            n = rng.choice([12, 12, 12, 12, 3, 14, 1])
            pool = FIELDS[:10] if rng.random() < 0.7 else FIELDS
            rows.append(",".join(rng.choice(pool) for _ in range(n)))
            if rng.random() < 0.1:
                rows.append("")
        end = rng.choice(["\n", "\n", "\r\n"])
        text = end.join(rows) + (end if rng.random() < 0.7 else "")
        yield f"chat {i}.csv", (("﻿" if rng.random() < 0.4 else "") + text).encode()


def rows_of(df):
    found = {}
    for r in df.orderBy("filename", "file_row").collect():
        found.setdefault(r["filename"], []).append(tuple(r[c] for c in C.S.RAW_CHAT_COLUMNS))
    return found


@pytest.fixture
def split_bytes(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in keys}

    def set_(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], str(n))

    yield set_
    for k, v in old.items():
        spark.conf.set(k, v)


def test_same_rows_for_every_split_size(spark, tmp_path, split_bytes):
    folder = tmp_path / "chats"
    folder.mkdir()
    for name, data in plain_files(random.Random(11), 16):
        (folder / name).write_bytes(data)
    whole = rows_of(C._chat_rows(C.read_whole_csvs(spark, str(folder))))
    assert sum(map(len, whole.values())) > 150
    for size in (64, 300, 10**6):
        split_bytes(size)
        split = rows_of(C._chat_rows(C.read_split_csvs(spark, str(folder))))
        assert split.keys() == whole.keys(), size
        for name, rows in whole.items():
            assert split[name] == rows, (size, name)


def test_small_and_large_files_together(spark, tmp_path, split_bytes):
    folder = tmp_path / "chats"
    folder.mkdir()
    for name, data in plain_files(random.Random(12), 12):
        (folder / name).write_bytes(data)
    (folder / "vacío.csv").write_bytes(b"")
    (folder / "WhatsApp Business.csv").write_bytes(b"a,b\n" * 100)
    whole = rows_of(C._chat_rows(C.read_whole_csvs(spark, str(folder))))
    split_bytes(300)
    assert rows_of(C.read_chat_csvs(spark, str(folder))) == whole
    assert rows_of(C.read_chat_csvs(spark, str(folder), whole_bytes=0)) == whole


def test_a_long_quoted_text_over_many_splits(spark, tmp_path, split_bytes):
    folder = tmp_path / "chats"
    folder.mkdir()
    text = "\n".join(f'línea {i} ""x"", y' for i in range(400))
    plain = "\n".join(f"c,{i}" + "," * 10 for i in range(300))
    (folder / "a.csv").write_text(f'{plain}\nchat,1,,,,,,,"{text}",,,\n{plain}\n', encoding="utf-8")
    split_bytes(128)
    df = C.read_split_csvs(spark, str(folder))
    assert _tasks(df) > 40
    rows = rows_of(C._chat_rows(df))["a.csv"]
    assert len(rows) == 601 and rows[300][8] == text.replace('""', '"')
    assert [r[1] for r in rows[301:]] == [str(i) for i in range(300)]


def _tasks(df):
    return df.sparkSession.read.text(df.inputFiles()).rdd.getNumPartitions()


def test_line_function_walks_quotes():
    cases = [("a,b", 0, 1), ('"a', 1, 0), ('a"b', 0, 0), ('x,"', 1, 0), ('""', 0, 1), ('"""', 1, 0), ('a","b', 1, 1), ('"a"b,"c', 1, 1), ('","', 0, 1), ("", 0, 1), ('"', 1, 0), (',"","', 1, 0)]
    for line, out, in_ in cases:
        assert (C.ends_inside_quotes(line, False), C.ends_inside_quotes(line, True)) == (out, in_), line
