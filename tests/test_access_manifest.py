"""Request gating (range edges, malformed addresses, allow-list, secret) and manifests."""

from chatledger.operators import access as AC
from chatledger.operators import manifest as MF

SCHEMA = "chat_id long, peer_ip string, x_forwarded_for string, x_real_ip string, secret_token string"


def test_ranges_and_header_precedence(spark):
    rows = [
        (1, "149.154.160.0", None, None, "t"),  # first of /20
        (1, "149.154.175.255", None, None, "t"),  # last of /20
        (1, "149.154.176.0", None, None, "t"),  # one beyond
        (1, "91.108.4.0", None, None, "t"),
        (1, "91.108.7.255", None, None, "t"),
        (1, "91.108.8.0", None, None, "t"),
        (1, "10.0.0.1", " 91.108.5.5 , 1.2.3.4", None, "t"),  # first forwarded hop wins
        (1, "10.0.0.1", None, "149.154.161.1", "t"),  # then X-Real-IP
        (1, "10.0.0.1", None, "999.1.1.1", "t"),  # malformed -> false
        (1, None, None, None, "t"),  # nothing -> 0.0.0.0
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = [(r.client_ip, r.ip_ok) for r in AC.authorise(df, None, "").collect()]
    assert [ok for _, ok in out] == [True, True, False, True, True, False, True, True, False, False]
    assert out[6][0] == "91.108.5.5" and out[9][0] == "0.0.0.0"


def test_allow_list_and_secret(spark):
    df = spark.createDataFrame([(1, "8.8.8.8", None, None, "s"), (2, "8.8.8.8", None, None, "x")], SCHEMA)
    empty = spark.createDataFrame([], "chat_id long")
    allow = spark.createDataFrame([(1,)], "chat_id long")
    # blank secret: IP test applies (8.8.8.8 is outside) -> nothing authorised
    assert [r.authorised for r in AC.authorise(df, empty, "").orderBy("chat_id").collect()] == [False, False]
    # secret configured: IP test skipped, token must match; allow-list admits chat 1 only
    res = AC.authorise(df, allow, "s").orderBy("chat_id").collect()
    assert [(r.token_ok, r.user_allowed, r.authorised) for r in res] == [(True, True, True), (False, False, False)]
    # empty allow-list admits everyone
    assert all(r.user_allowed for r in AC.authorise(df, empty, "s").collect())


def test_manifest(spark):
    remote = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "name string")
    local = spark.createDataFrame([("b",), ("d",)], "name string")
    diff = {r.measure: r.n for r in MF.manifest_diff(remote, local).collect()}
    assert diff == {"remote": 3, "local": 2, "missing": 2, "extra": 1}
    assert [r.name for r in MF.missing_sample(remote, local, 1).collect()] == ["a"]
