"""Native rule vocabulary for the default extractor.

The original pipeline asks a hosted language model to label each session.  The default
extractor here is a documented approximation: regular expressions over accent-folded,
lower-cased message text, combined per session.  It is not claimed equal to a model.
Patterns use only constructs with the same meaning in Java and RE2 regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatledger import schemas as S
from chatledger.functions import text as X

# Per-message signals (folded text).
SIGNALS = {
    "intent": r"(quiero|me gustaria) (hacer|pedir|comprar|encargar|reservar|[0-9])|quisiera|(manda|deja|apunta|pon|envia|aparta|confirma|separa)me ([0-9]|el pedido)|te encargo|me quedo con|dejalo asi|me das [0-9]|apuntame",
    "product_qty": r"[0-9]+ (de )?(cajas?|paquetes?|unidades?|mufins?|muffins?|arepas?|arepitas?|brownies?|wafles?|waffles?)|(^|[^a-z])un (bronwie|brownie|muffin|waffle|arepa)",
    "delivery": r"barrio|carrera|calle |apto|edificio|torre|porteria|conjunto|estacion del metro",
    "payment": r"pagar|pago |transferencia|transferi|nequi|daviplata|bancolombia|efectivo|comprobante|consigne|consignar|consignacion",
    "followup": r"llega el pedido|domiciliario|en camino|llego bien|no me ha llegado",
    "cancel": r"cancela|ya no lo necesito",
    "info": r"que productos|la carta|precios|catalogo",
    "question": r"[?¿]",
}

# Leftmost vocabulary hit -> canonical value.  A named method wins over a generic transfer,
# which is used only when no method is named in the session.
PAYMENT_TERMS = [
    ("nequi", "Nequi"),
    ("daviplata", "Daviplata"),
    ("bancolombia", "Bancolombia"),
    ("tarjeta", "tarjeta"),
    ("efectivo", "efectivo"),
]
GENERIC_TRANSFER = (r"transferencia|transferi", "transferencia")
CITY_TERMS = [
    ("medellin", "Medellín"),
    ("bogota", "Bogotá"),
    ("envigado", "Envigado"),
    ("itagui", "Itagüí"),
    ("sabaneta", "Sabaneta"),
]
AMOUNT = r"\$ ?([0-9][0-9.]*)"
# An introduction and up to three capitalised words.
NAME_INTRO = r"(?:[Ss]oy|[Hh]abla|[Ee]scribe|[Mm]e llamo|[Mm]i nombre es|[Aa] nombre de) ([A-ZÁÉÍÓÚÑ][a-záéíóúñ]+(?: [A-ZÁÉÍÓÚÑ][a-záéíóúñ]+){0,2})"
PHONE_LIKE = r"^\+?[0-9]{7,}$"

# FAQ category by keywords of the folded question; first rule that matches wins.
FAQ_CATEGORY_RULES = [
    ("diabeticos", r"diabetic|azucar|endulz"),
    ("envio", r"envio|domicilio|llega|entreg"),
    ("precios", r"cuanto|precio|vale|valor|cuesta|costo"),
    ("horarios", r"(^|[^a-z])horas?([^a-z]|$)|abren|cierran|horario|atiend|atencion"),
    ("ubicacion", r"donde estan|donde queda|ubicad|direccion|punto fisico"),
    ("productos", r"productos|sabores|carta|catalogo"),
    ("proceso_compra", r"pedido|pagar|comprar|transferencia|consign|nequi|daviplata|tarjeta"),
    ("info_general", r"quien(es)? son|informacion|que venden|redes"),
    ("productos", r"arepa|muf+in|brownie|bronwie|waf+le"),
]

# Product mention: optional quantity (and box/pack) before a product alias.
PRODUCT_MENTION = r"([0-9]+ ((cajas?|paquetes?) )?(de )?)?(mufins?|muffins?|mufi|arepitas?|arepas?|bronwies?|brownies?|browni|wafles?|waffles?)"
ALIAS_PREFIX = [("muf", "Muffin"), ("are", "Arepa"), ("bro", "Brownie"), ("waf", "Waffle")]
VARIANT_MAX_EDITS = 2
VARIANT_MIN_WORD = 5


def folded(c) -> Column:
    return X.fold(c)


def signal(name: str, folded_text: Column) -> Column:
    return folded_text.rlike(SIGNALS[name])


def term(terms: list[tuple[str, str]], folded_text: Column) -> Column:
    """Canonical value of the leftmost vocabulary hit, NULL if none."""
    hit = F.regexp_extract(folded_text, "(" + "|".join(t for t, _ in terms) + ")", 1)
    out = F.lit(None).cast("string")
    for t, canon in reversed(terms):
        out = F.when(hit == t, F.lit(canon)).otherwise(out)
    return out


def faq_category(folded_question: Column) -> Column:
    out = F.lit(S.FAQ_DEFAULT_CATEGORY)
    for cat, pat in reversed(FAQ_CATEGORY_RULES):
        out = F.when(folded_question.rlike(pat), F.lit(cat)).otherwise(out)
    return out


def alias_name(alias: Column) -> Column:
    out = F.lit(None).cast("string")
    for prefix, name in reversed(ALIAS_PREFIX):
        out = F.when(alias.startswith(prefix), F.lit(name)).otherwise(out)
    return out


def catalogue_variants() -> Column:
    """Constant array of (name, folded variant, canonical variant) in catalogue order."""
    rows = [(n, v) for n, v in S.CATALOGUE if v is not None]
    return F.array(
        *[
            F.struct(F.lit(n).alias("name"), folded(F.lit(v)).alias("vfold"), F.lit(v).alias("variant"))
            for n, v in rows
        ]
    )


def resolve_variant(name: Column, folded_text: Column) -> Column:
    """First catalogue variant of ``name`` written in the text, exactly or (one-word
    variants) within two edits of a word of the text."""
    words = F.split(folded_text, "[^a-z]+")

    def hit(v):
        exact = folded_text.contains(v["vfold"])
        near = (~v["vfold"].contains(" ")) & F.exists(
            words, lambda w: (F.length(w) >= VARIANT_MIN_WORD) & (F.levenshtein(w, v["vfold"]) <= VARIANT_MAX_EDITS)
        )
        return (v["name"] == name) & (exact | near)

    return F.try_element_at(F.filter(catalogue_variants(), hit), F.lit(1))["variant"]
