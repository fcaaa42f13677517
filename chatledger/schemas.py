"""Schemas and fixed values.

Everything under a "FIXED VALUES" comment must equal what the original pipeline uses for
results to agree; it is stated here once, in natural order, and referenced elsewhere.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: chat CSV layout (12 fields, no header)
# ---------------------------------------------------------------------------
RAW_CHAT_COLUMNS = [
    "chat_id",
    "sent_at",
    "read_at",
    "direction",
    "col4",
    "contact",
    "status",
    "col8",
    "text",
    "media_filename",
    "media_type",
    "media_metadata",
]

# FIXED VALUES: direction labels, roles, session rule
DIRECTION_INCOMING = "Entrante"
DIRECTION_OUTGOING = "Saliente"
DIRECTION_NOTICE = "Notificación"
ROLE_USER = "user"
ROLE_ASSISTANT = "assistant"
SESSION_GAP_HOURS = 24
SESSION_SEPARATOR = "__s"
EXCLUDED_CHAT_FILE = "WhatsApp Business.csv"
CLIENT_ID_MIN_DIGITS = 8

# FIXED VALUES: transcript labels
TRANSCRIPT_USER_LABEL = "Cliente"
TRANSCRIPT_BUSINESS_LABEL = "Negocio"
TRANSCRIPT_ORDERS_HEADER = ("CONVERSATION_ID: ", "CLIENT_ID: ")
TRANSCRIPT_FAQ_HEADER = "Cliente ID: "

# FIXED VALUES: order types exported to the mart, FAQ categories, sale states
ORDER_TYPES = ["quotation", "confirmed", "delivery_followup", "cancelled", "unclear"]
EXPORTED_ORDER_TYPES = ["confirmed", "delivery_followup"]
FAQ_CATEGORIES = [
    "info_general",
    "ubicacion",
    "envio",
    "precios",
    "productos",
    "proceso_compra",
    "diabeticos",
    "horarios",
    "otro",
]
FAQ_DEFAULT_CATEGORY = "otro"
SALE_STATES = ["confirmada", "probable"]
ORDER_STATUSES = ["pending", "confirmed", "delivery_followup", "delivered", "cancelled"]

# FIXED VALUES: bot product catalogue (name, variant) in menu order
CATALOGUE = [
    ("Arepa", "Maíz Multigranos"),
    ("Arepa", "Maíz Queso y Semillas"),
    ("Arepa", "Yuca y Queso"),
    ("Arepa", "Maduro y Queso"),
    ("Brownie", None),
    ("Muffin", "Chocolate"),
    ("Muffin", "Banano"),
    ("Muffin", "Zanahoria"),
    ("Waffle", "Yuca y Queso"),
    ("Waffle", "Plátano y Queso"),
]
CATALOGUE_NAMES = ["Muffin", "Arepa", "Brownie", "Waffle"]

# FIXED VALUES: product-name aliases from the extraction instructions (alias -> name)
PRODUCT_ALIASES = {
    "Muffin": ["Muffin", "Muffins", "Mufin", "Mufi", "Mufins", "Mufinss"],
    "Arepa": ["Arepa", "Arepas", "Arepita", "Arepitas"],
    "Brownie": ["Brownie", "Brownies", "Browni", "Bronwie"],
    "Waffle": ["Waffle", "Waffles", "Wafle", "Wafles"],
}

# FIXED VALUES: bot dialogue
BOT_QUANTITIES = list(range(1, 11))
BOT_ITEM_UNIT = "caja"
BOT_SOURCE_PREFIX = "telegram_"
BOT_MIN_PHONE_DIGITS = 7
BOT_MIN_NAME_LENGTH = 2
DIALOGUE_STATES = [
    "idle",
    "esperando_telefono",
    "esperando_nombre",
    "seleccionando_productos",
    "seleccionando_cantidad",
    "esperando_total",
    "confirmacion",
]

# FIXED VALUES: webhook source ranges (CIDR)
TRUSTED_IP_RANGES = ["149.154.160.0/20", "91.108.4.0/22"]

# FIXED VALUES: column width limits of the mart DDL
MART_STRING_LIMITS = {
    "clients": {"phone": 20, "name": 255, "source_client_id": 255},
    "orders": {"city": 100, "payment_method": 50, "status": 50, "source_session_id": 255},
    "products": {"name": 100, "variant": 100},
    "order_items": {"product_name": 255, "variant": 255, "unit": 50},
}

# ---------------------------------------------------------------------------
# Struct types
# ---------------------------------------------------------------------------
RAW_CHAT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_CHAT_COLUMNS])

MESSAGE_STRUCT = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

SESSION_SCHEMA = T.StructType(
    [
        T.StructField("conversation_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("messages", T.ArrayType(MESSAGE_STRUCT)),
    ]
)

CLIENTS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("source_client_id", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("city", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("total", T.DecimalType(12, 2)),
        T.StructField("status", T.StringType()),
        T.StructField("source_session_id", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

ORDER_ITEMS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit", T.StringType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

MART_SCHEMAS = {
    "clients": CLIENTS_SCHEMA,
    "orders": ORDERS_SCHEMA,
    "products": PRODUCTS_SCHEMA,
    "order_items": ORDER_ITEMS_SCHEMA,
}

UPDATE_SCHEMA = T.StructType(
    [
        T.StructField("update_id", T.LongType()),
        T.StructField(
            "message",
            T.StructType(
                [
                    T.StructField("message_id", T.LongType()),
                    T.StructField("chat", T.StructType([T.StructField("id", T.LongType())])),
                    T.StructField("from", T.StructType([T.StructField("first_name", T.StringType())])),
                    T.StructField("text", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "callback_query",
            T.StructType(
                [
                    T.StructField("id", T.StringType()),
                    T.StructField("data", T.StringType()),
                    T.StructField(
                        "message",
                        T.StructType(
                            [
                                T.StructField("message_id", T.LongType()),
                                T.StructField("chat", T.StructType([T.StructField("id", T.LongType())])),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)
