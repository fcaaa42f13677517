"""Chat CSV scan and normalisation on literal fixture files (FIXTURES.md section 1)."""

import codecs

from pyspark.sql import functions as F

from chatledger.operators import messages as M
from chatledger.operators import sessions as SS
from chatledger.sources.chat_csv import read_chat_csvs


def row(chat="WhatsApp - Ana", sent="2024-01-01 10:00:00", direction="Entrante", contact="+57 300 123 4567", text="hola", media=""):
    def q(v):
        if v is None:
            return ""
        v = str(v)
        if any(c in v for c in ',"\n'):
            return '"' + v.replace('"', '""') + '"'
        return v

    vals = [chat, sent, "", direction, "", contact, "", "", text, "", media, ""]
    return ",".join(q(v) for v in vals)


def write(folder, name, lines, bom=False, raw=None):
    p = folder / name
    data = raw if raw is not None else "\n".join(lines) + "\n"
    with open(p, "wb") as f:
        if bom:
            f.write(codecs.BOM_UTF8)
        f.write(data.encode("utf-8"))
    return p


def make_fixture(tmp_path):
    d = tmp_path / "raw_chats"
    d.mkdir()
    write(
        d,
        "WhatsApp - Ana.csv",
        [
            row(sent="2024-01-01 10:00:00", text="  hola\nbuenas  "),
            row(sent="2024-01-01 10:00:00", direction="Saliente", text='dice "hola", y más'),
            row(sent="not a date", text="sin fecha"),
            row(sent="2024-01-01 11:00:00", direction="Notificación", text="aviso"),
            row(sent="2024-01-01 12:00:00", direction="", text="sin dirección"),
            row(sent="2024-01-02 12:00:00", text="exactamente 24 h"),
            row(sent="2024-01-03 12:00:01", text="24 h y 1 s"),
            row(sent="2024-01-03 13:00:00", text="   "),
            "WhatsApp - Ana,2024-01-03 14:00:00,,Entrante,,x,,,corta",
            row(sent="2024-01-03 15:00:00", text="larga") + ",extra",
        ],
        bom=True,
    )
    lines = [row(chat="WhatsApp - Bob", contact="", sent=f"2024-02-{d:02d} 09:00:00", text=f"s{d}") for d in range(1, 23, 2)]
    write(d, "WhatsApp - Bob +57.csv", lines)
    write(d, "Árbol 100%.CSV", [row(chat="x", contact="3001234", text="siete dígitos")])
    write(d, "vacío.csv", [], raw="")
    write(d, "WhatsApp Business.csv", [row(text="excluido")])
    write(d, "notas.txt", [row(text="no csv")])
    return str(d)


def test_scan_selection_and_widths(spark, tmp_path):
    df = read_chat_csvs(spark, make_fixture(tmp_path))
    names = {r.filename for r in df.select("filename").distinct().collect()}
    assert names == {"WhatsApp - Ana.csv", "WhatsApp - Bob +57.csv", "Árbol 100%.CSV"}
    ana = df.filter(F.col("filename") == "WhatsApp - Ana.csv").orderBy("file_row").collect()
    # the over-long row is dropped, the short row kept with NULL padding
    assert len(ana) == 9
    assert ana[0].chat_id == "WhatsApp - Ana"  # BOM stripped
    assert ana[0].text == "  hola\nbuenas  "
    assert ana[1].text == 'dice "hola", y más'
    short = [r for r in ana if r.text == "corta"][0]
    assert short.media_type is None


def test_normalise(spark, tmp_path):
    raw = read_chat_csvs(spark, make_fixture(tmp_path))
    msgs = M.normalise(raw, "yyyy-MM-dd HH:mm:ss")
    ana = msgs.filter(F.col("filename") == "WhatsApp - Ana.csv").orderBy("message_index").collect()
    texts = [r.text for r in ana]
    # bad date and the notice are dropped; NULL direction kept; equal timestamps keep file order
    assert texts[:3] == ["hola\nbuenas", 'dice "hola", y más', "sin dirección"]
    assert ana[2].role is None and ana[2].direction is None
    assert [r.message_index for r in ana] == list(range(len(ana)))
    sess = {r.text: r.session_id for r in ana}
    assert sess["hola\nbuenas"] == "WhatsApp - Ana__s1"
    assert sess["exactamente 24 h"] == "WhatsApp - Ana__s1"  # exactly 24 h does not break
    assert sess["24 h y 1 s"] == "WhatsApp - Ana__s2"
    assert ana[0].client_id == "+573001234567"
    bob = msgs.filter(F.col("conversation_id") == "WhatsApp - Bob +57").collect()
    assert {r.client_id for r in bob} == {"WhatsApp - Bob"}  # empty contact -> chat id, few digits
    assert len({r.session_id for r in bob}) == 11
    arbol = msgs.filter(F.col("filename") == "Árbol 100%.CSV").collect()
    assert arbol[0].conversation_id == "Árbol 100%.CSV"  # only a literal '.csv' is removed
    assert arbol[0].client_id == "3001234"  # 7 digits: unchanged


def test_session_records_order(spark, tmp_path):
    raw = read_chat_csvs(spark, make_fixture(tmp_path))
    msgs = M.normalise(raw, "yyyy-MM-dd HH:mm:ss")
    rec = SS.first_n(SS.session_records(msgs), 0).filter(F.col("conversation_id") == "WhatsApp - Bob +57").collect()
    # string order: __s10 and __s11 sort before __s2
    assert [r.session_id.split("__")[1] for r in rec][:4] == ["s1", "s10", "s11", "s2"]
    ana = SS.session_records(msgs).filter(F.col("session_id") == "WhatsApp - Ana__s1").collect()[0]
    assert [m.content for m in ana.messages] == ["hola\nbuenas", 'dice "hola", y más', "exactamente 24 h"]
    assert ana.messages[0].timestamp == "2024-01-01T10:00:00"
