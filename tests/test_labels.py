"""Labels of the rule extractor on lines written and labelled by hand, apart from the vocabulary."""

from chatledger.functions import rules as RU
from pyspark.sql import functions as F

CATEGORIES = [
    ("¿Tienen envío a Envigado?", "envio"),
    ("¿Cuánto se demora el domicilio?", "envio"),
    ("¿Hacen envíos los domingos?", "envio"),
    ("¿A qué barrios llegan?", "envio"),
    ("¿Me lo pueden entregar en la oficina?", "envio"),
    ("¿El domicilio tiene costo?", "envio"),
    ("¿Qué valor tiene la caja de arepas?", "precios"),
    ("¿Cuánto cuestan los brownies?", "precios"),
    ("¿En cuánto está el paquete de waffles?", "precios"),
    ("¿Me regalas los precios por favor?", "precios"),
    ("¿Cuál es el precio de los muffins?", "precios"),
    ("¿Qué costo tienen las arepas?", "precios"),
    ("¿Son aptos para diabéticos?", "diabeticos"),
    ("¿Los muffins llevan azúcar?", "diabeticos"),
    ("Mi mamá es diabética, ¿los puede comer?", "diabeticos"),
    ("¿Con qué los endulzan?", "diabeticos"),
    ("¿Hasta qué hora atienden?", "horarios"),
    ("¿Abren los festivos?", "horarios"),
    ("¿Cuál es el horario de atención?", "horarios"),
    ("¿Atienden los sábados?", "horarios"),
    ("¿Dónde están ubicados?", "ubicacion"),
    ("¿Dónde queda la tienda?", "ubicacion"),
    ("¿Cuál es la dirección del local?", "ubicacion"),
    ("¿Tienen punto físico?", "ubicacion"),
    ("¿Qué sabores manejan?", "productos"),
    ("¿Qué productos tienen?", "productos"),
    ("¿Me envías el catálogo?", "productos"),
    ("¿Tienen arepas sin queso?", "productos"),
    ("¿Los waffles vienen congelados?", "productos"),
    ("¿Cómo hago un pedido?", "proceso_compra"),
    ("¿Puedo pagar con tarjeta?", "proceso_compra"),
    ("¿A qué cuenta hago la transferencia?", "proceso_compra"),
    ("¿Cómo es el proceso para comprar?", "proceso_compra"),
    ("¿Reciben Nequi?", "proceso_compra"),
    ("¿Quiénes son ustedes?", "info_general"),
    ("¿Qué venden?", "info_general"),
    ("¿Tienen redes sociales?", "info_general"),
    ("¿Me das más información?", "info_general"),
    ("¿Cómo amaneciste?", "otro"),
    ("¿Sí?", "otro"),
    ("¿Lo recuerdas?", "otro"),
]
NAMES = [
    ("Hola, soy Marta", "Marta"),
    ("Soy Juan Pérez", "Juan Pérez"),
    ("Buenas tardes, habla Lucía", "Lucía"),
    ("Me llamo Íngrid Muñoz", "Íngrid Muñoz"),
    ("Mi nombre es Carlos", "Carlos"),
    ("mi nombre es Ana María Restrepo, mucho gusto", "Ana María Restrepo"),
    ("El pedido va a nombre de Óscar", "Óscar"),
    ("Te habla Camila", "Camila"),
    ("Le escribe Andrés Gil", "Andrés Gil"),
    ("soy diabética", None),
    ("Soy de Medellín", None),
    ("me llamo así", None),
    ("Marta está bien", None),
    ("Hablamos mañana Pedro", None),
    ("", None),
]
# Which of the conditions of an order each line shows.
SIGNALS = [
    ("Quiero pedir dos cajas", {"intent"}),
    ("Quiero 3 arepas", {"intent", "product_qty"}),
    ("Me gustaría encargar unos waffles", {"intent"}),
    ("Apúntame 2 muffins", {"intent", "product_qty"}),
    ("Mándame 4 paquetes de arepas", {"intent", "product_qty"}),
    ("Déjame el pedido para mañana", {"intent"}),
    ("5 brownies por favor", {"product_qty"}),
    ("2 cajas de waffles", {"product_qty"}),
    ("Vivo en la carrera 43 con calle 10", {"delivery"}),
    ("Edificio Mirador, apto 502", {"delivery"}),
    ("Lo dejan en la portería", {"delivery"}),
    ("Barrio Laureles", {"delivery"}),
    ("Te acabo de hacer la transferencia", {"payment"}),
    ("Pago en efectivo", {"payment"}),
    ("Adjunto el comprobante", {"payment"}),
    ("Ya consigné", {"payment"}),
    ("¿A qué hora llega el pedido?", {"followup"}),
    ("No me ha llegado", {"followup"}),
    ("¿El pedido ya va en camino?", {"followup"}),
    ("Todo llegó bien, gracias", {"followup"}),
    ("Cancela mi pedido", {"cancel"}),
    ("Mejor ya no lo necesito", {"cancel"}),
    ("¿Qué productos manejan?", {"info"}),
    ("Pásame los precios", {"info"}),
    ("Muéstrame el catálogo", {"info"}),
    ("Hola, buenas tardes", set()),
    ("Muchas gracias", set()),
    ("Ok", set()),
    ("Feliz día", set()),
    ("Quiero agradecerles", set()),
]
FLAGS = ["intent", "product_qty", "delivery", "payment", "followup", "cancel", "info"]


def labelled(spark, pairs, label):
    rows = [(i, text) for i, (text, _) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, text string").select("i", label.alias("l"))
    return {pairs[r.i][0]: r.l for r in df.collect()}


def test_categories(spark):
    got = labelled(spark, CATEGORIES, RU.faq_category(RU.folded("text")))
    assert {t: (got[t], want) for t, want in CATEGORIES if got[t] != want} == {}


def test_names(spark):
    from chatledger.functions import text as X

    got = labelled(spark, NAMES, X.blank_to_null(F.regexp_extract("text", RU.NAME_INTRO, 1)))
    assert {t: (got[t], want) for t, want in NAMES if got[t] != want} == {}


def test_signals(spark):
    flags = F.filter(F.array(*[F.when(RU.signal(n, RU.folded("text")), F.lit(n)) for n in FLAGS]), lambda x: x.isNotNull())
    got = labelled(spark, SIGNALS, flags)
    assert {t: (set(got[t]), want) for t, want in SIGNALS if set(got[t]) != want} == {}
