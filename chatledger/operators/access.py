"""Authorised-update split over a webhook request log (allow-list, source ranges, secret)."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatledger import schemas as S
from chatledger.functions import text as X


def ipv4_to_long(ip: Column) -> Column:
    """Dotted IPv4 text -> integer; anything malformed -> NULL."""
    ok = ip.rlike(r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$")
    parts = F.split(ip, r"\.")
    val = F.lit(0).cast("bigint")
    for i in range(4):
        val = val * 256 + parts.getItem(i).cast("bigint")
    return F.when(ok, val)


def _ranges(cidrs: list[str]) -> list[tuple[int, int]]:
    out = []
    for c in cidrs:
        n = ipaddress.ip_network(c)
        out.append((int(n.network_address), int(n.broadcast_address)))
    return out


def in_ranges(ip_long: Column, cidrs: list[str] = S.TRUSTED_IP_RANGES) -> Column:
    """Range test against a fixed, tiny list of CIDR blocks: inlined as comparisons
    (no join, no broadcast needed)."""
    cond = F.lit(False)
    for lo, hi in _ranges(cidrs):
        cond = cond | ip_long.between(lo, hi)
    return F.coalesce(cond, F.lit(False))


def client_ip(forwarded: Column, real_ip: Column, peer: Column) -> Column:
    """First X-Forwarded-For hop, else X-Real-IP, else the peer address, else 0.0.0.0."""
    first_hop = X.strip(F.split(forwarded, ",").getItem(0))

    def given(c: Column) -> Column:
        return F.when(c.isNotNull() & (c != ""), c)

    return F.coalesce(F.when(given(forwarded).isNotNull(), first_hop), given(real_ip), given(peer), F.lit("0.0.0.0"))


def authorise(
    requests: DataFrame,
    allowed_chats: DataFrame | None,
    secret: str = "",
    chat_col: str = "chat_id",
) -> DataFrame:
    """Adds ``client_ip``, ``ip_ok``, ``token_ok``, ``user_allowed`` and ``authorised``.

    A blank configured secret accepts any token; when a secret is configured the IP test
    is skipped.  An empty (or absent) allow-list admits every chat.
    """
    ip = client_ip(F.col("x_forwarded_for"), F.col("x_real_ip"), F.col("peer_ip"))
    df = requests.withColumn("client_ip", ip).withColumn("ip_ok", in_ranges(ipv4_to_long(F.col("client_ip"))))
    token_ok = F.lit(True) if secret == "" else F.coalesce(F.col("secret_token") == F.lit(secret), F.lit(False))
    df = df.withColumn("token_ok", token_ok)
    if allowed_chats is None:
        df = df.withColumn("user_allowed", F.lit(True))
    else:
        allow = allowed_chats.select(F.col(chat_col).alias("_allowed")).distinct()
        # Whether the list is empty is part of the query, not a job while it is built.
        everybody = allowed_chats.select(F.count(F.lit(1)) == 0).scalar()
        df = df.join(allow, df[chat_col] == allow["_allowed"], "left").withColumn(
            "user_allowed", F.col("_allowed").isNotNull() | everybody
        ).drop("_allowed")
    skip_ip = secret != ""
    accepted = F.col("token_ok") & (F.lit(True) if skip_ip else F.col("ip_ok"))
    return df.withColumn("authorised", accepted & F.col("user_allowed"))
