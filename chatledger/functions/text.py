"""Column -> Column helpers.  All are built-in Spark expressions (whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatledger import schemas as S

_WS_EDGES = r"(?U)^\s+|\s+$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace including newlines."""
    return F.regexp_replace(col_(c), _WS_EDGES, "")


def blank_to_null(c) -> Column:
    """``x or None`` for strings: NULL and '' become NULL."""
    c = col_(c)
    return F.when(c != "", c)


def digits_only(c) -> Column:
    return F.regexp_replace(col_(c), r"[^\p{Nd}]", "")


def client_id(contact, chat_id) -> Column:
    """Stable client key: stripped contact, else stripped chat id; phone-like values
    (>= 8 digits) keep an optional leading '+' and their digits only."""
    ct = strip(F.coalesce(col_(contact), F.lit("")))
    ch = strip(F.coalesce(col_(chat_id), F.lit("")))
    base = F.when(ct != "", ct).otherwise(ch)
    digits = digits_only(base)
    plus = F.when(base.startswith("+"), F.lit("+")).otherwise(F.lit(""))
    return F.when(F.length(digits) >= S.CLIENT_ID_MIN_DIGITS, F.concat(plus, digits)).otherwise(base)


def conversation_id(file_name) -> Column:
    """File name with every literal '.csv' removed (case-sensitive)."""
    return F.replace(col_(file_name), F.lit(".csv"), F.lit(""))


def decoded_file_name(path_col) -> Column:
    """Decode a percent-encoded file name without turning a literal '+' into a space."""
    return F.url_decode(F.replace(col_(path_col), F.lit("+"), F.lit("%2B")))


def role(direction) -> Column:
    d = col_(direction)
    return (
        F.when(d == S.DIRECTION_INCOMING, F.lit(S.ROLE_USER))
        .when(d == S.DIRECTION_OUTGOING, F.lit(S.ROLE_ASSISTANT))
        .otherwise(F.lit(None).cast("string"))
    )


def epoch_micros(ts_ntz) -> Column:
    """Microseconds since 1970-01-01 for a TIMESTAMP_NTZ, independent of the session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {_sql(ts_ntz)})")


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def iso_timestamp(ts_ntz) -> Column:
    """Python ``datetime.isoformat()``: microseconds printed only when non-zero."""
    c = col_(ts_ntz)
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(base, F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")))
    )


def parse_timestamp_ntz(text, fmt: str) -> Column:
    """Parse text to TIMESTAMP_NTZ with an explicit pattern; unparsable -> NULL (zone independent)."""
    t = col_(text)
    ok = F.try_to_timestamp(t, F.lit(fmt)).isNotNull()
    return F.when(ok, F.to_timestamp_ntz(t, F.lit(fmt)))


def parse_date_lenient(text) -> Column:
    """``strptime('%Y-%m-%d')``: accepts unpadded month/day; anything else -> NULL."""
    t = col_(text)
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "yyyy-M-d"))


def parse_iso_timestamp(text) -> Column:
    """``datetime.fromisoformat``-style parse of 'YYYY-MM-DD[ T]HH:MM[:SS[.ffffff]]' or a date."""
    t = F.regexp_replace(col_(text), "T", " ")
    return F.coalesce(
        parse_timestamp_ntz(t, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        parse_timestamp_ntz(t, "yyyy-MM-dd HH:mm:ss"),
        parse_timestamp_ntz(t, "yyyy-MM-dd HH:mm"),
        parse_timestamp_ntz(t, "yyyy-MM-dd"),
    )


def money_text_to_number(text) -> Column:
    """Export money rule for text: drop '$', drop '.', ',' -> '.', strip, to number; bad -> NULL."""
    t = F.replace(F.replace(col_(text), F.lit("$"), F.lit("")), F.lit("."), F.lit(""))
    t = strip(F.replace(t, F.lit(","), F.lit(".")))
    # Java also reads '45d', 'NaN' and 'Infinity' as numbers.
    return F.when(t.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"), t.try_cast("double"))


def bot_money(text) -> Column:
    """Bot total: drop '$', '.', ',' and spaces; positive integer else NULL."""
    t = F.regexp_replace(col_(text), r"[$., ]", "")
    v = F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("bigint"))
    return F.when(v > 0, v)


def bot_phone(text) -> Column:
    """Bot phone: digits only; fewer than 7 digits -> NULL."""
    d = digits_only(text)
    return F.when(F.length(d) >= S.BOT_MIN_PHONE_DIGITS, d)


def uuid_from(key) -> Column:
    """UUID-shaped, content-derived id: md5 of the key laid out 8-4-4-4-12."""
    h = F.md5(col_(key))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )


def product_display_name(name, variant) -> Column:
    return F.concat_ws(" ", col_(name), blank_to_null(variant))


def product_button_id(name, variant) -> Column:
    v = F.coalesce(blank_to_null(variant), F.lit(""))
    return F.concat(F.lower(col_(name)), F.lit("_"), F.replace(F.lower(v), F.lit(" "), F.lit("_")))


def short_code(order_id) -> Column:
    """Short code of an order in its confirmation: the first 8 characters of its id."""
    return F.substring(col_(order_id), 1, 8)


def thousands(n) -> Column:
    """Python ``f'{n:,}'`` for integers."""
    return F.format_number(col_(n).cast("bigint"), 0)


def fold(c) -> Column:
    """Lower case and strip Spanish accents (for vocabulary matching)."""
    return F.translate(F.lower(col_(c)), "áéíóúüñ", "aeiouun")
