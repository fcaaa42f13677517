import json
import time

import pytest
from chatledger.operators import bot as B
from chatledger.sources import versioned as V
from chatledger.streaming import dialogue as D
from chatledger.streaming import dialogue_state as DS

from tests.test_dialogue import sale_updates


def write(path, updates):
    path.write_text("\n".join(json.dumps(u) for u in updates))


def rows(df):
    return sorted(map(tuple, df.select(*B.OUTPUT_SCHEMA.names).collect()), key=str)


def test_typed_state_gives_the_replay_over_restarts_and_can_be_read(spark, tmp_path):
    base, out, ckpt = tmp_path / "updates", str(tmp_path / "out"), str(tmp_path / "ckpt")
    base.mkdir()
    a, b = sale_updates(0, 1, "3001112233", "Ana"), sale_updates(100, 2, "3009998877", "Luz")
    again = sale_updates(200, 1, "3001112244", "Eva")
    parts = [a[:5] + b[:2], a[4:6] + b[2:], a[6:] + again[:6], again[6:]]  # one update delivered twice
    for n, part in enumerate(parts):
        write(base / f"{n}.json", part)
        D.start(spark, str(base), out, ckpt, typed_state=True).awaitTermination(120)
        if n == 0:
            held = {r.chat_id: r for r in DS.open_dialogues(spark, ckpt).collect()}
            assert held[1].state == "seleccionando_cantidad" or held[1].state == "seleccionando_productos"
            assert held[1].telefono == "3001112233" and held[1].nombre == "Ana" and held[1].last_update_id == a[4]["update_id"]
            assert held[2].state == "esperando_nombre"
        if n == 1:
            assert [tuple(r) for r in DS.open_carts(spark, ckpt).collect()] == [(1, 0, "Waffle", "Yuca y Queso", 2)]
            assert [r.chat_id for r in DS.open_dialogues(spark, ckpt).collect()] == [1]
    assert DS.open_carts(spark, ckpt).count() == 0 and DS.open_dialogues(spark, ckpt).count() == 0
    every = [json.dumps(u) for u in a + b + again]
    upd = spark.read.schema(D.UPDATE_FILE_SCHEMA).json(spark.sparkContext.parallelize(every))
    want = rows(B.replay(B.prepare_updates(upd, None, None)))
    got = [r for r in rows(V.read_table(spark, out, "replies", B.OUTPUT_SCHEMA)) if r[3] != "duplicate"]
    assert got == want
    assert spark.read.parquet(f"{out}/orders").count() == 3


def test_a_dialogue_left_open_expires(spark, tmp_path):
    base, out, ckpt = tmp_path / "updates", str(tmp_path / "out"), str(tmp_path / "ckpt")
    base.mkdir()
    sale = sale_updates(0, 1, "3001112233", "Ana")

    def wait_for(chat, reply):
        end = time.time() + 60
        while time.time() < end:
            found = {(r.chat_id, r.reply): r for r in V.read_table(spark, out, "replies", B.OUTPUT_SCHEMA).collect()}
            if (chat, reply) in found:
                return found
            time.sleep(1)
        raise AssertionError(f"no {reply}")

    query = D.start(spark, str(base), out, ckpt, available_now=False, typed_state=True, idle_seconds=2)
    try:
        write(base / "a.json", sale[:5] + sale_updates(500, 2, "3005556677", "Leo"))
        replies = wait_for(1, "expired")
        assert replies[1, "expired"].state == "idle" and replies[1, "expired"].update_id == sale[4]["update_id"]
        assert (2, "expired") not in replies and (2, "sale_saved") in replies
        # what comes later finds no dialogue: nothing is sold
        write(base / "b.json", sale[5:])
        late = wait_for(1, "sale_rejected")
        assert (1, "sale_saved") not in late
    finally:
        query.stop()
    assert DS.open_carts(spark, ckpt).count() == 0


def test_timers_need_typed_state(spark, tmp_path):
    with pytest.raises(ValueError, match="typed_state"):
        D.start(spark, str(tmp_path), str(tmp_path / "o"), str(tmp_path / "c"), idle_seconds=1)
    with pytest.raises(ValueError, match="available_now"):
        D.start(spark, str(tmp_path), str(tmp_path / "o"), str(tmp_path / "c"), typed_state=True, idle_seconds=1)
