"""Dates named in chat text, resolved against the time of their message.

A small grammar over folded text; of a text's expressions the leftmost counts:

- "hoy", "mañana", "pasado mañana" (not "la mañana", the time of day)
- "el", "este" or "próximo" and a weekday: the next such day after the message's
- a day and month by name or as "el d/m": the next such day from the message's on
- with a year, "15 de marzo de 2025" or "15/3/2025": that day

A day that the calendar does not have gives no date.  Patterns use only constructs with the same meaning in
Java and RE2 regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ["lunes", "martes", "miercoles", "jueves", "viernes", "sabado", "domingo"]
MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
TIME_OF_DAY = r"\bla manana\b"
_MONTH = "|".join([*MONTHS, "setiembre"])
EXPRESSION = (
    r"\bpasado manana\b|\bmanana\b|\bhoy\b"
    r"|\b[0-9]{1,2} de (?:" + _MONTH + r")\b(?: del? [0-9]{4}\b)?"
    r"|\b[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{4}\b|\bel [0-9]{1,2}/[0-9]{1,2}(?:/[0-9]{4})?\b"
    r"|\b(?:el|este|proximo) (?:" + "|".join(WEEKDAYS) + r")\b"
)


def _place(name: Column, names: list[str]) -> Column:
    """1-based place of a name in a list, NULL if it is not there."""
    out = F.lit(None).cast("int")
    for i, n in enumerate(names, 1):
        out = F.when(name == n, i).otherwise(out)
    return out


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year, month, day), F.lit("yyyy-MM-dd")).cast("date")


def mentioned_date(folded: Column, sent_at: Column) -> Column:
    """The date that a message's folded text names, or NULL."""
    base = sent_at.cast("date")
    hit = F.regexp_extract(F.regexp_replace(folded, TIME_OF_DAY, " "), f"({EXPRESSION})", 1)
    weekday = _place(F.regexp_extract(hit, "([a-z]+)$", 1), WEEKDAYS)
    # weekday() counts from Monday, 0
    ahead = F.pmod(weekday - 1 - F.weekday(base) + 6, F.lit(7)) + 1

    number = lambda pattern: F.regexp_extract(hit, pattern, 1).try_cast("int")
    month_name = F.regexp_replace(F.regexp_extract(hit, " de ([a-z]+)", 1), "^setiembre$", "septiembre")
    month = F.coalesce(_place(month_name, MONTHS), number("[0-9]+[/-]([0-9]+)"))
    day, year = number("^(?:el )?([0-9]+)"), number("([0-9]{4})$")
    this, following = _day(F.year(base), month, day), _day(F.year(base) + 1, month, day)
    # 29 February is looked for in this year and the next one only
    coming = F.when(this >= base, this).otherwise(following)
    return (
        F.when(hit == "hoy", base)
        .when(hit == "manana", F.date_add(base, 1))
        .when(hit == "pasado manana", F.date_add(base, 2))
        .when(weekday.isNotNull(), F.date_add(base, ahead))
        .when(year.isNotNull(), _day(year, month, day))
        .when(month.isNotNull(), coming)
    )
