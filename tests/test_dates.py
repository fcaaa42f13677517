"""Dates in chat text: expressions with the dates a reader expects, written by hand."""

from datetime import date, datetime

from pyspark.sql import functions as F

from chatledger.functions import text as X
from chatledger.functions.dates import mentioned_date

WED = datetime(2024, 3, 13, 18, 30)  # a Wednesday
CASES = [
    (WED, "Lo necesito para hoy", date(2024, 3, 13)),
    (WED, "HOY mismo, por favor", date(2024, 3, 13)),
    (WED, "¿Me lo envías mañana?", date(2024, 3, 14)),
    (WED, "Mañana en la mañana", date(2024, 3, 14)),
    (WED, "mañana por la mañana", date(2024, 3, 14)),
    (WED, "Te encargo 3 paquetes para mañana", date(2024, 3, 14)),
    (WED, "pasado mañana a las 3", date(2024, 3, 15)),
    (WED, "Puede ser pasado mañana o el sábado", date(2024, 3, 15)),
    (WED, "Mejor en la mañana", None),
    (WED, "por la mañana no estoy", None),
    (WED, "por la mañana no, el viernes sí", date(2024, 3, 15)),
    (WED, "Para el lunes necesito 4 cajas", date(2024, 3, 18)),
    (WED, "el martes paso", date(2024, 3, 19)),
    (WED, "el miércoles", date(2024, 3, 20)),
    (WED, "El MIERCOLES", date(2024, 3, 20)),
    (WED, "este jueves", date(2024, 3, 14)),
    (WED, "Apúntame 3 paquetes para el viernes", date(2024, 3, 15)),
    (WED, "el sábado temprano", date(2024, 3, 16)),
    (WED, "este domingo", date(2024, 3, 17)),
    (WED, "el próximo lunes", date(2024, 3, 18)),
    (WED, "próximo jueves", date(2024, 3, 14)),
    (WED, "De lunes a sábado, todo el día", None),
    (WED, "abrimos lunes y martes", None),
    (WED, "los domingos no", None),
    (WED, "el 15 de marzo", date(2024, 3, 15)),
    (WED, "el 13 de marzo", date(2024, 3, 13)),
    (WED, "el 12 de marzo", date(2025, 3, 12)),
    (WED, "1 de enero", date(2025, 1, 1)),
    (WED, "para el 31 de diciembre", date(2024, 12, 31)),
    (WED, "5 de Abril", date(2024, 4, 5)),
    (WED, "20 de mayo o 21 de mayo", date(2024, 5, 20)),
    (WED, "3 de junio", date(2024, 6, 3)),
    (WED, "4 de julio", date(2024, 7, 4)),
    (WED, "7 de agosto", date(2024, 8, 7)),
    (WED, "9 de septiembre", date(2024, 9, 9)),
    (WED, "9 de setiembre", date(2024, 9, 9)),
    (WED, "12 de octubre", date(2024, 10, 12)),
    (WED, "2 de noviembre", date(2024, 11, 2)),
    (WED, "14 de febrero", date(2025, 2, 14)),
    (WED, "29 de febrero", None),
    (WED, "30 de febrero", None),
    (WED, "31 de abril", None),
    (WED, "0 de mayo", None),
    (WED, "15 de marzo de 2026", date(2026, 3, 15)),
    (WED, "15 de marzo del 2023", date(2023, 3, 15)),
    (WED, "29 de febrero de 2024", date(2024, 2, 29)),
    (WED, "29 de febrero de 2023", None),
    (WED, "el 20/03", date(2024, 3, 20)),
    (WED, "el 1/2", date(2025, 2, 1)),
    (WED, "1/2 caja", None),
    (WED, "el 31/12", date(2024, 12, 31)),
    (WED, "el 15/13", None),
    (WED, "15/03/2024", date(2024, 3, 15)),
    (WED, "5-4-2024", date(2024, 4, 5)),
    (WED, "el 05/11/2025 sin falta", date(2025, 11, 5)),
    (WED, "32/01/2025", None),
    (WED, "Son 2 de muffins", None),
    (WED, "Quiero 10 de arepas para el 8 de mayo", date(2024, 5, 8)),
    (WED, "Hola, buenas tardes", None),
    (WED, "", None),
    (WED, None, None),
    (WED, "hoyos", None),
    (WED, "martes 13", None),
    (WED, "total $45.000", None),
    (datetime(2024, 3, 17, 0, 0), "el domingo", date(2024, 3, 24)),  # a Sunday
    (datetime(2024, 3, 17, 0, 0), "el lunes", date(2024, 3, 18)),
    (datetime(2024, 3, 18, 23, 59), "el lunes", date(2024, 3, 25)),  # a Monday
    (datetime(2024, 3, 18, 23, 59), "el domingo", date(2024, 3, 24)),
    (datetime(2024, 12, 31, 12, 0), "mañana", date(2025, 1, 1)),
    (datetime(2024, 12, 30, 12, 0), "pasado mañana", date(2025, 1, 1)),
    (datetime(2023, 2, 28, 12, 0), "mañana", date(2023, 3, 1)),
    (datetime(2024, 2, 28, 12, 0), "mañana", date(2024, 2, 29)),
    (datetime(2023, 6, 1, 0, 0), "29 de febrero", date(2024, 2, 29)),
    (datetime(2024, 12, 31, 1, 0), "el 1 de enero", date(2025, 1, 1)),
    (datetime(2024, 12, 28, 1, 0), "el viernes", date(2025, 1, 3)),  # a Saturday
    (None, "mañana", None),
]


def test_expressions(spark):
    df = spark.createDataFrame([(i, t, s) for i, (t, s, _) in enumerate(CASES)], "i int, sent_at timestamp_ntz, text string")
    got = {r.i: r.d for r in df.select("i", mentioned_date(X.fold("text"), F.col("sent_at")).alias("d")).collect()}
    wrong = [(s, want, got[i]) for i, (_, s, want) in enumerate(CASES) if got[i] != want]
    assert not wrong


def test_extraction_gives_date_and_unit(spark):
    import json

    from chatledger.operators import extract as EX
    from tests.test_extract import msgs_frame

    rows = [  # from Monday 1 January 2024 on
        ("a", 0, "user", "Buenas, necesito 2 cajas de muffins y 3 paquetes de arepas y un brownie"),
        ("a", 1, "assistant", "Listo, ¿para el viernes?"),
        ("a", 2, "user", "Mejor mañana"),
        ("b", 0, "user", "Quiero 2 muffins"),
        ("c", 0, "user", "Quiero 2 cajas de muffins, mi barrio es Belén"),
        ("c", 1, "user", "Perdón, cancela el pedido"),
    ]
    out = {r.conversation_id: r for r in EX.extract_orders(msgs_frame(spark, rows)).collect()}
    order = json.loads(out["a"].response)["order"]
    assert order["order_date"] == "2024-01-05" and out["a"].order_date == date(2024, 1, 5)
    assert [(p["quantity_units"], p["unit"]) for p in order["products"]] == [(2, "caja"), (3, "paquete"), (None, None)]
    assert json.loads(out["b"].response)["order"]["order_date"] is None
    # a cancelled order still meets the conditions of an order
    assert out["c"].has_order and out["c"].order_type == "cancelled"
