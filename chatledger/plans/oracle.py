"""Reference SQL (DuckDB dialect) for every registered query that SQL can express.

Each statement restates, independently of the Spark code, both the input mapping of
``plans/adapters.py`` and the operator's semantics in the most direct SQL form (for
example plain whole-conversation windows where the Spark plan uses day buckets).
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


def iso(ts: str) -> str:
    """Python isoformat() of a TIMESTAMP expression."""
    return (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({ts}) % 1000000 <> 0 "
        f"THEN '.' || lpad(CAST(microsecond({ts}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END)"
    )


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def lst(values) -> str:
    def q(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"

    return "[" + ", ".join(q(v) for v in values) + "]"


from chatledger.plans.adapters import BUSINESS_PHRASES, CLIENT_PHRASES  # noqa: E402

# ---------------------------------------------------------------------------
# V_msg and stage 1
# ---------------------------------------------------------------------------
RAW = f"""
raw AS (
  SELECT event_id AS file_row,
         'WhatsApp - u' || user_id AS chat_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS sent_at,
         CASE WHEN event_type IN ('view', 'purchase') THEN 'Entrante'
              WHEN event_type = 'click' THEN 'Saliente'
              WHEN event_type = 'error' THEN 'Notificación' END AS direction,
         CASE user_id % 4 WHEN 0 THEN '+57 300 ' || lpad(CAST(user_id AS VARCHAR), 7, '0')
                          WHEN 1 THEN ''
                          WHEN 2 THEN 'Cliente ' || user_id
                          ELSE ' 300-' || lpad(CAST(user_id AS VARCHAR), 5, '0') || ' ' END AS contact,
         CASE WHEN event_id % 11 = 0 THEN ''
              WHEN event_id % 13 = 0 THEN NULL
              WHEN event_type = 'click' THEN ' ' || {lst(BUSINESS_PHRASES)}[(event_id * 7 + user_id) % {len(BUSINESS_PHRASES)} + 1] || chr(10)
              ELSE ' ' || {lst(CLIENT_PHRASES)}[(event_id * 7 + user_id) % {len(CLIENT_PHRASES)} + 1] || chr(10) END AS text_raw,
         CASE WHEN value > 300 THEN '  ' WHEN value > 30 THEN 'image' END AS media_type,
         'WhatsApp - u' || user_id || '.csv' AS filename,
         'raw_chats/WhatsApp - u' || user_id || '.csv' AS file_path
  FROM events
)"""

CLEAN = f"""
clean AS (
  SELECT file_row, chat_id, sent_at, direction, contact, filename, file_path,
         {strip("coalesce(text_raw, '')")} AS text,
         {strip("coalesce(media_type, '')")} <> '' AS is_media
  FROM raw
  WHERE sent_at IS NOT NULL AND direction IS DISTINCT FROM 'Notificación'
)"""


def client_id_sql(contact: str, chat: str) -> str:
    base = (
        f"(CASE WHEN {strip(f'coalesce({contact}, {chr(39)}{chr(39)})')} <> '' "
        f"THEN {strip(f'coalesce({contact}, {chr(39)}{chr(39)})')} "
        f"ELSE {strip(f'coalesce({chat}, {chr(39)}{chr(39)})')} END)"
    )
    digits = f"regexp_replace({base}, '[^0-9]', '', 'g')"
    return (
        f"(CASE WHEN length({digits}) >= 8 THEN "
        f"(CASE WHEN starts_with({base}, '+') THEN '+' ELSE '' END) || {digits} ELSE {base} END)"
    )


IDS = f"""
ids AS (
  SELECT *, replace(filename, '.csv', '') AS conversation_id,
         {client_id_sql('contact', 'chat_id')} AS client_id,
         CASE direction WHEN 'Entrante' THEN 'user' WHEN 'Saliente' THEN 'assistant' END AS role
  FROM clean
)"""

SEQ = """
seq AS (
  SELECT *,
         row_number() OVER w - 1 AS message_index,
         epoch_us(sent_at) - lag(epoch_us(sent_at)) OVER w AS gap_us
  FROM ids
  WINDOW w AS (PARTITION BY conversation_id ORDER BY sent_at, file_row)
),
msgs AS (
  SELECT *,
         coalesce(gap_us, 0) / 1e6 / 3600.0 AS gap_hours,
         conversation_id || '__s' || CAST(1 + sum(CASE WHEN gap_us > 86400000000 THEN 1 ELSE 0 END)
             OVER (PARTITION BY conversation_id ORDER BY sent_at, file_row ROWS UNBOUNDED PRECEDING) AS VARCHAR) AS session_id
  FROM seq
),
ex AS (
  SELECT * FROM msgs WHERE role IN ('user', 'assistant') AND length(text) > 0
)"""

MSGS = f"WITH {RAW},{CLEAN},{IDS},{SEQ}"

sql(
    "messages_clean",
    f"WITH {RAW},{CLEAN} SELECT file_row, chat_id, {iso('sent_at')} AS sent_at, direction, text, is_media FROM clean",
)
sql("message_ids_roles", f"WITH {RAW},{CLEAN},{IDS} SELECT file_row, conversation_id, client_id, role FROM ids")
sql(
    "client_id_normalise",
    f"WITH {RAW} SELECT DISTINCT chat_id, contact, {client_id_sql('contact', 'chat_id')} AS client_id FROM raw",
)
sql("message_index", f"{MSGS} SELECT file_row, conversation_id, message_index FROM msgs")
sql("message_gaps", f"{MSGS} SELECT file_row, gap_hours FROM msgs")
sql("message_sessions", f"{MSGS} SELECT file_row, conversation_id, message_index, session_id FROM msgs")
sql(
    "normalise_summary",
    f"""{MSGS} SELECT count(DISTINCT file_path) AS files, count(*) AS messages,
        count(DISTINCT conversation_id) AS conversations, count(DISTINCT session_id) AS sessions FROM msgs""",
)
sql(
    "session_records",
    f"""{MSGS} SELECT conversation_id, session_id,
        arg_min(client_id, (sent_at, message_index)) AS client_id,
        count(*) AS n_messages,
        {iso('min(sent_at)')} AS first_timestamp,
        {iso('max(sent_at)')} AS last_timestamp,
        arg_max(role, (sent_at, message_index)) AS last_role
      FROM ex GROUP BY conversation_id, session_id""",
)
sql(
    "session_last_date",
    f"{MSGS} SELECT session_id, strftime(max(sent_at), '%Y-%m-%d') AS last_date FROM ex GROUP BY session_id",
)
sql(
    "client_first_contact",
    f"""{MSGS}, s AS (
          SELECT conversation_id, session_id, arg_min(client_id, (sent_at, message_index)) AS client_id,
                 min(sent_at) AS first_at
          FROM ex GROUP BY conversation_id, session_id)
        SELECT client_id, {iso('arg_min(first_at, (conversation_id, session_id))')} AS first_contact
        FROM s GROUP BY client_id""",
)
sql(
    "transcript_orders",
    f"""{MSGS} SELECT session_id,
        'CONVERSATION_ID: ' || conversation_id || chr(10) || 'CLIENT_ID: ' || arg_min(client_id, (sent_at, message_index))
        || chr(10) || string_agg('[' || {iso('sent_at')} || '] ' || CASE WHEN role = 'user' THEN 'Cliente' ELSE 'Negocio' END
                                 || ': ' || text, chr(10) ORDER BY sent_at, message_index) AS transcript
      FROM ex GROUP BY conversation_id, session_id""",
)
sql(
    "transcript_faq",
    f"""{MSGS} SELECT session_id,
        'Cliente ID: ' || arg_min(client_id, (sent_at, message_index))
        || chr(10) || string_agg(CASE WHEN role = 'user' THEN 'Cliente' ELSE 'Negocio' END
                                 || ': ' || text, chr(10) ORDER BY sent_at, message_index) AS transcript
      FROM ex GROUP BY conversation_id, session_id""",
)
sql(
    "sessions_first_n",
    f"""{MSGS} SELECT conversation_id, session_id, arg_min(client_id, (sent_at, message_index)) AS client_id,
        count(*) AS n_messages
      FROM ex GROUP BY conversation_id, session_id ORDER BY conversation_id, session_id LIMIT 5""",
)


# ---------------------------------------------------------------------------
# Mart tables and reports
# ---------------------------------------------------------------------------
def uuid(key: str) -> str:
    h = f"md5({key})"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' "
        f"|| substr({h}, 17, 4) || '-' || substr({h}, 21, 12))"
    )


def src_id(k: str) -> str:
    return f"(CASE WHEN {k} % 2 = 0 THEN '+57300' || lpad(CAST({k} AS VARCHAR), 7, '0') ELSE 'WhatsApp - Cliente ' || {k} END)"


def _catalogue():
    from chatledger import schemas as S

    return [n for n, _ in S.CATALOGUE], [v for _, v in S.CATALOGUE]


_NAMES, _VARIANTS = _catalogue()
CITIES_SQL = lst(["Medellín", "Bogotá", "Envigado", "Itagüí"])
PAYMENTS_SQL = lst(["Nequi", "Daviplata", "efectivo", "transferencia"])
RUN_TS_SQL = "TIMESTAMP '2025-01-01 00:00:00'"


def cat_name(pk: str) -> str:
    return f"(CASE WHEN {pk} % 97 = 0 THEN '' ELSE {lst(_NAMES)}[{pk} % {len(_NAMES)} + 1] END)"


def cat_variant(pk: str) -> str:
    return f"({lst(_VARIANTS)}[{pk} % {len(_VARIANTS)} + 1])"


def order_id(ok: str) -> str:
    return uuid(f"'order:o' || {ok}")


ORDER_CK = "(CASE WHEN o_custkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END)"

MART = f"""
mc AS (
  SELECT {uuid(f"'client:' || {src_id('c_custkey')}")} AS id,
         CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE '+57300' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS phone,
         c_name AS name, {src_id('c_custkey')} AS source_client_id,
         TIMESTAMP '2023-01-01 00:00:00' + to_minutes(CAST(c_custkey % 1000 AS BIGINT)) AS created_at,
         TIMESTAMP '2023-01-01 00:00:00' + to_minutes(CAST(c_custkey % 1000 AS BIGINT)) AS updated_at
  FROM customer
),
mo AS (
  SELECT {order_id('o_orderkey')} AS id,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE {uuid(f"'client:' || {src_id(ORDER_CK)}")} END AS client_id,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {CITIES_SQL}[o_custkey % 4 + 1] END AS city,
         'Calle ' || (o_custkey % 100) || ' # ' || (o_orderkey % 50) AS address,
         {PAYMENTS_SQL}[o_orderkey % 4 + 1] AS payment_method,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS total,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending' ELSE 'confirmed' END AS status,
         'o' || o_orderkey AS source_session_id,
         o_orderdate AS created_at, o_orderdate AS updated_at
  FROM orders
),
mi_all AS (
  SELECT {uuid("'item:o:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey")} AS id,
         {order_id('l_orderkey')} AS order_id,
         CAST(NULL AS VARCHAR) AS product_id,
         {cat_name('l_partkey')} AS product_name, {cat_variant('l_partkey')} AS variant,
         CAST(l_quantity AS INTEGER) AS quantity, 'caja' AS unit,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price, l_shipdate AS created_at
  FROM lineitem
),
mp AS (
  SELECT {uuid("'product:' || name || ':' || coalesce(variant, '')")} AS id, name, variant, {RUN_TS_SQL} AS created_at
  FROM (SELECT DISTINCT product_name AS name, variant FROM mi_all WHERE coalesce(product_name, '') <> '')
),
mi AS (
  SELECT i.id, i.order_id, p.pid AS product_id, i.product_name, i.variant, i.quantity, i.unit, i.unit_price, i.created_at
  FROM mi_all i LEFT JOIN (SELECT name, variant, min(id) AS pid FROM mp GROUP BY name, variant) p
    ON i.product_name = p.name AND i.variant IS NOT DISTINCT FROM p.variant
  WHERE coalesce(i.product_name, '') <> ''
)"""

W = f"WITH {MART}"


def d(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


sql(
    "client_summary",
    f"""{W} SELECT c.id, c.name, c.phone, count(o.id) AS total_orders,
        CAST(coalesce(sum(o.total), 0) AS DOUBLE) AS total_spent, {d('max(o.order_date)')} AS last_order_date
      FROM mc c LEFT JOIN mo o ON c.id = o.client_id GROUP BY c.id, c.name, c.phone""",
)
sql(
    "orders_with_client",
    f"""{W} SELECT o.id AS order_id, {d('o.order_date')} AS order_date, o.city, o.address, o.payment_method,
        CAST(o.total AS DOUBLE) AS total, o.status, c.name AS client_name, c.phone AS client_phone
      FROM mo o LEFT JOIN mc c ON o.client_id = c.id""",
)
sql(
    "sales_by_month",
    f"""{W} SELECT {d("date_trunc('month', order_date)")} AS month, count(*) AS total_orders,
        CAST(coalesce(sum(total), 0) AS DOUBLE) AS total_revenue
      FROM mo WHERE order_date IS NOT NULL GROUP BY date_trunc('month', order_date) ORDER BY month DESC""",
)
sql(
    "top_products",
    f"""{W} SELECT product_name, variant, sum(quantity) AS total_quantity, count(DISTINCT order_id) AS order_count
      FROM mi_all WHERE product_name IS NOT NULL AND product_name <> '' GROUP BY product_name, variant
      ORDER BY total_quantity DESC""",
)
sql(
    "mart_counts",
    f"""{W} SELECT 'clients' AS table_name, count(*) AS rows FROM mc
      UNION ALL SELECT 'orders', count(*) FROM mo
      UNION ALL SELECT 'products', count(*) FROM mp
      UNION ALL SELECT 'order_items', count(*) FROM mi""",
)
sql("total_sales", f"{W} SELECT CAST(coalesce(sum(total), 0) AS DOUBLE) AS total_sales FROM mo WHERE total IS NOT NULL")
sql(
    "best_product",
    f"""{W} SELECT product_name, sum(quantity) AS total_qty FROM mi_all WHERE product_name <> ''
      GROUP BY product_name ORDER BY total_qty DESC NULLS FIRST, product_name LIMIT 1""",
)
sql(
    "daily_summary",
    f"""{W} SELECT {d('order_date')} AS order_date, count(*) AS orders, CAST(coalesce(sum(total), 0) AS DOUBLE) AS revenue
      FROM mo WHERE order_date IS NOT NULL GROUP BY order_date""",
)
sql(
    "recent_clients",
    f"""{W} SELECT id, name, phone, {iso('created_at')} AS created_at FROM mc
      ORDER BY created_at DESC NULLS LAST, id LIMIT 10""",
)
sql(
    "client_month",
    f"""{W} SELECT client_id, strftime(order_date, '%Y-%m') AS month, count(*) AS orders,
        CAST(coalesce(sum(total), 0) AS DOUBLE) AS total
      FROM mo WHERE client_id IS NOT NULL AND order_date IS NOT NULL GROUP BY client_id, strftime(order_date, '%Y-%m')""",
)
sql(
    "mark_delivered",
    f"""{W}, latest AS (
          SELECT client_id, arg_max(id, (coalesce(order_date, DATE '0001-01-01'), created_at, id)) AS oid
          FROM mo WHERE client_id IS NOT NULL AND status IN ('pending', 'confirmed') GROUP BY client_id)
        SELECT o.id, o.client_id, CASE WHEN l.oid IS NOT NULL THEN 'delivered' ELSE o.status END AS status,
               {iso(f"CASE WHEN l.oid IS NOT NULL THEN {RUN_TS_SQL} ELSE o.updated_at END")} AS updated_at
        FROM mo o LEFT JOIN latest l ON o.id = l.oid""",
)
sql(
    "items_valid",
    f"{W} SELECT id, order_id, product_name, variant, quantity FROM mi_all WHERE coalesce(product_name, '') <> ''",
)
sql("item_product_id", f"{W} SELECT id, product_name, variant, product_id FROM mi")
sql(
    "client_by_phone",
    f"""{W}, one AS (
          SELECT regexp_replace(phone, '[^0-9]', '', 'g') AS k, arg_min(id, (created_at, id)) AS id,
                 arg_min(name, (created_at, id)) AS name
          FROM mc WHERE phone IS NOT NULL GROUP BY 1),
        lk AS (SELECT '57 300 ' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone_input FROM customer)
        SELECT lk.phone_input, one.id AS client_id, one.name AS client_name, one.id IS NOT NULL AS found
        FROM lk LEFT JOIN one ON regexp_replace(lk.phone_input, '[^0-9]', '', 'g') = one.k""",
)

BATCH_CLIENTS = f"""
bc AS (
  SELECT {uuid("'client:' || src")} AS id,
         CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE '+57301' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS phone,
         upper(c_name) AS name, src AS source_client_id, CAST(NULL AS TIMESTAMP) AS created_at
  FROM (SELECT *, CASE WHEN c_custkey % 5 = 0 THEN 'nuevo-' || {src_id('c_custkey')} ELSE {src_id('c_custkey')} END AS src
        FROM customer WHERE c_custkey % 3 = 0)
)"""
sql(
    "upsert_clients",
    f"""{W}, {BATCH_CLIENTS}
      SELECT coalesce(s.id, t.id) AS id,
        CASE WHEN s.id IS NOT NULL AND t.id IS NOT NULL THEN coalesce(s.phone, t.phone) WHEN s.id IS NOT NULL THEN s.phone ELSE t.phone END AS phone,
        CASE WHEN s.id IS NOT NULL AND t.id IS NOT NULL THEN coalesce(s.name, t.name) WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
        CASE WHEN s.id IS NOT NULL THEN s.source_client_id ELSE t.source_client_id END AS source_client_id,
        {iso("CASE WHEN t.id IS NOT NULL THEN t.created_at ELSE s.created_at END")} AS created_at,
        {iso(f"CASE WHEN s.id IS NOT NULL THEN {RUN_TS_SQL} ELSE t.updated_at END")} AS updated_at
      FROM mc t FULL OUTER JOIN bc s ON t.id = s.id""",
)
BATCH_ORDERS = f"""
bo AS (
  SELECT {uuid("'order:' || bsess")} AS id, {uuid(f"'client:' || {src_id(ORDER_CK)}")} AS client_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(NULL AS VARCHAR) AS city,
         'Calle ' || (o_custkey % 100) || ' # ' || (o_orderkey % 50) AS address,
         {PAYMENTS_SQL}[o_orderkey % 4 + 1] AS payment_method, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
         CASE WHEN o_orderkey % 8 = 0 THEN 'cancelled' ELSE 'pending' END AS status,
         bsess AS source_session_id, CAST(NULL AS TIMESTAMP) AS created_at
  FROM (SELECT *, 'o' || o_orderkey || CASE WHEN o_orderkey % 40 = 0 THEN '-b' ELSE '' END AS bsess
        FROM orders WHERE o_orderkey % 4 = 0)
)"""


def _pick_s(c: str) -> str:
    return f"CASE WHEN s.id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"


sql(
    "upsert_orders",
    f"""{W}, {BATCH_ORDERS}
      SELECT coalesce(s.id, t.id) AS id, {_pick_s('client_id')},
        {d("CASE WHEN s.id IS NOT NULL THEN s.order_date ELSE t.order_date END")} AS order_date,
        {_pick_s('city')}, {_pick_s('address')}, {_pick_s('payment_method')},
        CAST(CASE WHEN s.id IS NOT NULL THEN s.total ELSE t.total END AS DOUBLE) AS total,
        {_pick_s('status')}, {_pick_s('source_session_id')},
        {iso("CASE WHEN t.id IS NOT NULL THEN t.created_at ELSE s.created_at END")} AS created_at,
        {iso(f"CASE WHEN s.id IS NOT NULL THEN {RUN_TS_SQL} ELSE t.updated_at END")} AS updated_at
      FROM mo t FULL OUTER JOIN bo s ON t.id = s.id""",
)
sql(
    "upsert_products",
    f"""{W}, bp AS (SELECT id, name, upper(variant) AS variant FROM mp WHERE name = 'Muffin')
      SELECT coalesce(s.id, t.id) AS id, {_pick_s('name')}, {_pick_s('variant')},
        {iso(f"CASE WHEN t.id IS NOT NULL THEN t.created_at ELSE {RUN_TS_SQL} END")} AS created_at
      FROM mp t FULL OUTER JOIN bp s ON t.id = s.id""",
)
BATCH_ITEMS = f"""
bi AS (
  SELECT * FROM (
    SELECT {uuid("CASE WHEN l_orderkey % 5 = 0 THEN 'item:new:o' ELSE 'item:o' END || ':' || l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey")} AS id,
           {order_id('l_orderkey')} AS order_id,
           {cat_name('l_partkey')} AS product_name, {cat_variant('l_partkey')} AS variant,
           coalesce(CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END, 1) AS quantity,
           'paquete' AS unit, CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price
    FROM lineitem WHERE l_linenumber = 1)
  WHERE coalesce(product_name, '') <> ''
)"""
sql(
    "upsert_items",
    f"""{W}, {BATCH_ITEMS}
      SELECT coalesce(s.id, t.id) AS id, {_pick_s('order_id')},
        CASE WHEN t.id IS NOT NULL THEN t.product_id ELSE NULL END AS product_id,
        {_pick_s('product_name')}, {_pick_s('variant')}, {_pick_s('quantity')}, {_pick_s('unit')},
        CAST(CASE WHEN s.id IS NOT NULL THEN s.unit_price ELSE t.unit_price END AS DOUBLE) AS unit_price,
        {iso(f"CASE WHEN t.id IS NOT NULL THEN t.created_at ELSE {RUN_TS_SQL} END")} AS created_at
      FROM mi t FULL OUTER JOIN bi s ON t.id = s.id""",
)
sql(
    "catalog_match",
    """WITH cut AS (SELECT p_partkey, substr(p_name, 1, p_partkey % length(p_name)) || substr(p_name, 2 + p_partkey % length(p_name)) AS s FROM part),
      m AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'otro ' ELSE '' END
              || CASE WHEN p_partkey % 3 = 0 THEN left(s, length(s) - 1) || 'x' ELSE s END AS mention FROM cut),
      near AS (SELECT mention, name, levenshtein(mention, name) AS e
               FROM (SELECT DISTINCT mention FROM m), (SELECT DISTINCT p_name AS name FROM part)),
      best AS (SELECT mention, name, e FROM near WHERE e <= 2 QUALIFY row_number() OVER (PARTITION BY mention ORDER BY e, name) = 1)
      SELECT m.p_partkey, m.mention, best.name, CAST(best.e AS BIGINT) AS edits FROM m LEFT JOIN best ON m.mention = best.mention""",
)
# The views over the tables as a load leaves them: nothing of changes or stored sums here.
ORDERS_AFTER = f"""{W}, {BATCH_ORDERS},
oa AS (SELECT {_pick_s('client_id')}, {_pick_s('order_date')}, {_pick_s('total')}, coalesce(s.id, t.id) AS id
       FROM mo t FULL OUTER JOIN bo s ON t.id = s.id)"""
sql(
    "maintained_client_summary",
    f"""{ORDERS_AFTER} SELECT c.id, c.name, c.phone, count(o.id) AS total_orders,
        CAST(coalesce(sum(o.total), 0) AS DOUBLE) AS total_spent, {d('max(o.order_date)')} AS last_order_date
      FROM mc c LEFT JOIN oa o ON c.id = o.client_id GROUP BY c.id, c.name, c.phone""",
)
sql(
    "maintained_sales_by_month",
    f"""{ORDERS_AFTER} SELECT {d("date_trunc('month', order_date)")} AS month, count(*) AS total_orders,
        CAST(coalesce(sum(total), 0) AS DOUBLE) AS total_revenue
      FROM oa WHERE order_date IS NOT NULL GROUP BY date_trunc('month', order_date)""",
)
sql(
    "maintained_top_products",
    f"""{W}, {BATCH_ITEMS},
      ia AS (SELECT {_pick_s('product_name')}, {_pick_s('variant')}, {_pick_s('quantity')}, {_pick_s('order_id')}
             FROM mi t FULL OUTER JOIN bi s ON t.id = s.id)
      SELECT product_name, variant, sum(quantity) AS total_quantity, count(DISTINCT order_id) AS order_count
      FROM ia GROUP BY product_name, variant""",
)
sql(
    "delete_propagation",
    f"""{W},
      dc AS (SELECT DISTINCT {uuid(f"'client:' || {src_id('c_custkey')}")} AS id FROM customer WHERE c_custkey % 50 = 1),
      dor AS (SELECT DISTINCT {order_id('o_orderkey')} AS id FROM orders WHERE o_orderkey % 50 = 2),
      dp AS (SELECT DISTINCT id FROM mp WHERE variant = 'Banano'),
      o2 AS (SELECT CASE WHEN client_id IN (SELECT id FROM dc) THEN NULL ELSE client_id END AS client_id
             FROM mo WHERE id NOT IN (SELECT id FROM dor)),
      i2 AS (SELECT CASE WHEN product_id IN (SELECT id FROM dp) THEN NULL ELSE product_id END AS product_id
             FROM mi WHERE order_id NOT IN (SELECT id FROM dor))
      SELECT 'clients' AS table_name, count(*) AS remaining, CAST(0 AS BIGINT) AS nulled FROM mc WHERE id NOT IN (SELECT id FROM dc)
      UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE client_id IS NULL) FROM o2
      UNION ALL SELECT 'products', count(*), 0 FROM mp WHERE id NOT IN (SELECT id FROM dp)
      UNION ALL SELECT 'order_items', count(*), count(*) FILTER (WHERE product_id IS NULL) FROM i2""",
)


def _quality_sql() -> str:
    from chatledger import schemas as S

    lim = S.MART_STRING_LIMITS
    parts = []

    def rules(table, src, checks):
        for k, cond in checks.items():
            parts.append(f"SELECT '{table}.{k}' AS rule, count(*) FILTER (WHERE {cond}) AS violations FROM {src}")

    statuses = ", ".join(f"'{s}'" for s in S.ORDER_STATUSES)
    rules("clients", "mc", {"source_client_id_null": "source_client_id IS NULL", "id_null": "id IS NULL"}
          | {f"{c}_too_long": f"length({c}) > {n}" for c, n in lim["clients"].items()})
    rules("orders", "mo", {"id_null": "id IS NULL", "status_domain": f"status NOT IN ({statuses})"}
          | {f"{c}_too_long": f"length({c}) > {n}" for c, n in lim["orders"].items()}
          | {"total_out_of_range": "abs(total) >= 10000000000"})
    rules("products", "mp", {"name_null": "name IS NULL"} | {f"{c}_too_long": f"length({c}) > {n}" for c, n in lim["products"].items()})
    rules("order_items", "mi_q", {"product_name_null": "product_name IS NULL"}
          | {f"{c}_too_long": f"length({c}) > {n}" for c, n in lim["order_items"].items()})

    def dup(src, keys, rule):
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        parts.append(
            f"SELECT '{rule}', count(*) FROM (SELECT {', '.join(keys)} FROM {src} WHERE {nn} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
        )

    dup("mc", ["id"], "clients.id_duplicate")
    dup("mc", ["source_client_id"], "clients.source_client_id_duplicate")
    dup("mo", ["id"], "orders.id_duplicate")
    dup("mp", ["id"], "products.id_duplicate")
    dup("mp", ["name", "variant"], "products.name_variant_duplicate")
    dup("mi_q", ["id"], "order_items.id_duplicate")

    def orphan(child, fk, parent, rule):
        parts.append(
            f"SELECT '{rule}', count(*) FROM {child} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT id FROM {parent} WHERE id IS NOT NULL)"
        )

    orphan("mo", "client_id", "mc", "orders.client_id_orphan")
    orphan("mi_q", "order_id", "mo", "order_items.order_id_orphan")
    orphan("mi_q", "product_id", "mp", "order_items.product_id_orphan")
    mi_q = """mi_q AS (
      SELECT i.*, p.pid AS product_id FROM (SELECT * EXCLUDE (product_id) FROM mi_all) i
      LEFT JOIN (SELECT name, variant, min(id) AS pid FROM mp GROUP BY name, variant) p
        ON i.product_name = p.name AND i.variant IS NOT DISTINCT FROM p.variant)"""
    return f"{W}, {mi_q} SELECT rule, CAST(violations AS BIGINT) AS violations FROM (" + " UNION ALL ".join(parts) + ")"


sql("quality_report", _quality_sql())


# ---------------------------------------------------------------------------
# Extractor results (V_res) restated relationally: no JSON on this side
# ---------------------------------------------------------------------------
def _num_text(x: str) -> str:
    """Text of a JSON number as the VARIANT reader prints it (whole numbers without '.0')."""
    return f"(CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END)"


RES = f"""
res0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus, o_totalprice AS tot, o_orderdate AS d,
         'WhatsApp - u' || (o_orderkey // 64) || '__s' || (o_orderkey % 64) AS session_id,
         'WhatsApp - u' || (o_orderkey // 64) AS conversation_id,
         {src_id('o_custkey')} AS client_id,
         o_orderkey % 89 = 0 AS rate_limited,
         o_orderkey % 101 = 50 AS malformed
  FROM orders
),
res AS (
  SELECT *,
    NOT rate_limited AND NOT malformed AS ok,
    NOT rate_limited AND NOT malformed AND k % 37 <> 0 AS has_order_obj,
    CASE WHEN rate_limited OR malformed OR k % 37 = 0 THEN NULL
         WHEN k % 29 = 0 THEN 'cancelled' WHEN o_orderstatus = 'F' THEN 'confirmed'
         WHEN o_orderstatus = 'P' THEN 'delivery_followup' ELSE 'quotation' END AS order_type,
    CASE WHEN k % 3 = 0 THEN NULL
         WHEN k % 3 = 1 AND k % 5 = 0 THEN strftime(d, '%Y-%-m-%-d')
         WHEN k % 3 = 1 AND k % 7 = 0 THEN strftime(d, '%d/%m/%Y')
         WHEN k % 3 = 2 AND k % 11 = 0 THEN ''
         ELSE strftime(d, '%Y-%m-%d') END AS order_date_text,
    CASE WHEN k % 7 = 0 THEN '' ELSE {CITIES_SQL}[c % 4 + 1] END AS city,
    'Calle ' || (c % 100) || ' # ' || (k % 50) AS address,
    {PAYMENTS_SQL}[k % 4 + 1] AS payment_method,
    CASE WHEN k % 2 = 0 THEN {_num_text('tot')}
         WHEN k % 10 = 1 THEN '$' || replace(format('{{:,}}', CAST(floor(tot) AS BIGINT)), ',', '.')
         WHEN k % 10 = 3 THEN replace(format('{{:,}}', CAST(floor(tot) AS BIGINT)), ',', '.') || ',50'
         WHEN k % 10 = 5 THEN 'consultar'
         WHEN k % 10 = 7 THEN NULL
         ELSE CAST(CAST(floor(tot) AS BIGINT) AS VARCHAR) END AS approx_total_text,
    CASE WHEN k % 2 = 0 THEN tot
         WHEN k % 10 IN (1, 9) THEN floor(tot)
         WHEN k % 10 = 3 THEN floor(tot) + 0.5
         ELSE NULL END AS total_num,
    CASE WHEN c % 23 = 0 THEN NULL WHEN c % 4 = 0 THEN '+57300' || lpad(CAST(c AS VARCHAR), 7, '0')
         WHEN c % 4 = 1 THEN '300' || lpad(CAST(c AS VARCHAR), 7, '0') END AS customer_phone,
    CASE WHEN c % 23 = 0 THEN NULL WHEN c % 5 = 0 THEN '' ELSE 'Cliente ' || c END AS customer_name,
    k % 43 <> 0 AND k % 47 <> 0 AS products_listed
  FROM res0
),
exp AS (SELECT * FROM res WHERE has_order_obj AND order_type IN ('confirmed', 'delivery_followup')),
lastd AS (SELECT session_id, strftime(max(sent_at), '%Y-%m-%d') AS last_date FROM ex GROUP BY session_id),
dated AS (
  SELECT e.*,
    CASE WHEN coalesce(e.order_date_text, '') <> '' THEN e.order_date_text ELSE l.last_date END AS order_date,
    CASE WHEN coalesce(e.order_date_text, '') <> '' THEN 'llm' WHEN l.last_date IS NOT NULL THEN 'last_message' ELSE 'none' END AS order_date_source
  FROM exp e LEFT JOIN lastd l ON e.session_id = l.session_id
),
plines AS (
  SELECT l_orderkey AS k,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos,
    {cat_name('l_partkey')} AS name, {cat_variant('l_partkey')} AS variant, l_linenumber AS ln,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qtxt,
    CASE WHEN l_linenumber = 3 THEN '' ELSE 'caja' END AS unit, l_extendedprice AS price
  FROM lineitem
),
items AS (
  SELECT e.session_id, p.* FROM exp e JOIN plines p ON e.k = p.k WHERE e.products_listed
),
labels AS (
  SELECT session_id, string_agg(concat_ws(' ', name,
            CASE WHEN coalesce(variant, '') <> '' THEN '(' || variant || ')' END,
            CASE WHEN ln = 4 OR ln = 6 THEN NULL WHEN ln = 7 THEN 'xdos' ELSE 'x' || qtxt END,
            CASE WHEN unit <> '' THEN unit END), '; ' ORDER BY pos) AS products
  FROM items GROUP BY session_id
),
firstc AS (
  SELECT client_id, arg_min(first_at, (conversation_id, session_id)) AS first_at FROM (
    SELECT conversation_id, session_id, arg_min(client_id, (sent_at, message_index)) AS client_id, min(sent_at) AS first_at
    FROM ex GROUP BY conversation_id, session_id) GROUP BY client_id
),
cl AS (
  SELECT client_id AS src, arg_min(customer_phone, session_id) AS cp, arg_min(customer_name, session_id) AS cn
  FROM exp GROUP BY client_id
),
cl2 AS (
  SELECT src, CASE WHEN starts_with(coalesce(cp, ''), '+') THEN cp WHEN starts_with(src, '+') THEN src END AS phone, cn FROM cl
),
clients_t AS (
  SELECT {uuid("'client:' || src")} AS id, phone,
    nullif(CASE WHEN coalesce(cn, '') = '' AND phone IS NULL AND NOT starts_with(src, '+')
                THEN {strip("replace(src, 'WhatsApp - ', '')")} ELSE cn END, '') AS name,
    src AS source_client_id,
    coalesce({iso('f.first_at')}, '2025-01-01T00:00:00') AS created_at
  FROM cl2 LEFT JOIN firstc f ON cl2.src = f.client_id
)"""

R3 = f"{MSGS}, {RES}"

sql(
    "extract_parse",
    f"""{R3} SELECT session_id,
        CASE WHEN rate_limited THEN 'Max retries exceeded (rate limit)' WHEN malformed THEN 'invalid JSON response' END AS error,
        ok AS parsed, order_type FROM res""",
)
sql("extract_status", f"{R3} SELECT count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE NOT ok) AS errors FROM res")
sql("orders_confirmed", f"{R3} SELECT session_id, order_type FROM exp")
sql("order_date_fallback", f"{R3} SELECT session_id, order_date, order_date_source FROM dated")
sql("date_source_counts", f"{R3} SELECT order_date_source, count(*) AS orders FROM dated GROUP BY order_date_source")
sql(
    "money_parse_export",
    f"""{R3} SELECT session_id, CASE WHEN has_order_obj THEN approx_total_text END AS approx_total_text,
        CASE WHEN has_order_obj THEN total_num END AS total FROM res""",
)
sql(
    "product_label",
    f"{R3} SELECT e.session_id, coalesce(l.products, '') AS products FROM exp e LEFT JOIN labels l ON e.session_id = l.session_id",
)
sql(
    "sales_flat",
    f"""{R3} SELECT d.conversation_id, d.session_id, d.client_id, d.customer_phone, d.customer_name, d.order_type,
        d.order_date, d.order_date_source, d.city, d.address, d.payment_method, d.approx_total_text AS approx_total,
        coalesce(l.products, '') AS products
      FROM dated d LEFT JOIN labels l ON d.session_id = l.session_id""",
)
sql(
    "orders_table",
    f"""{R3} SELECT {uuid("'order:' || session_id")} AS id, {uuid("'client:' || client_id")} AS client_id,
        nullif(order_date, '') AS order_date, nullif(city, '') AS city, nullif(address, '') AS address,
        nullif(payment_method, '') AS payment_method, total_num AS total, order_type AS status,
        session_id AS source_session_id, '2025-01-01T00:00:00' AS created_at
      FROM dated""",
)
sql(
    "items_table",
    f"""{R3} SELECT {uuid("'item:' || session_id || ':' || pos")} AS id, {uuid("'order:' || session_id")} AS order_id,
        name AS product_name, nullif(variant, '') AS variant,
        CAST(CASE WHEN ln IN (4, 6) THEN 1 WHEN ln = 7 THEN NULL ELSE CAST(qtxt AS BIGINT) END AS BIGINT) AS quantity,
        nullif(unit, '') AS unit, price AS unit_price
      FROM items""",
)
sql("clients_table", f"{R3} SELECT id, phone, name, source_client_id, created_at FROM clients_t")
sql(
    "order_date_parse",
    f"""{R3} SELECT {uuid("'order:' || session_id")} AS id, nullif(order_date, '') AS order_date_text,
        strftime(CASE WHEN regexp_full_match(order_date, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_strptime(order_date, '%Y-%m-%d') END, '%Y-%m-%d') AS order_date
      FROM dated""",
)
sql(
    "created_at_parse",
    f"""{R3} SELECT source_client_id, {iso("CAST(created_at AS TIMESTAMP)")} AS created_at FROM clients_t""",
)


# ---------------------------------------------------------------------------
# Rule extractor
# ---------------------------------------------------------------------------
def _rules_sql() -> dict[str, str]:
    from chatledger import schemas as S
    from chatledger.functions import rules as RU

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def term(terms, f):
        hit = f"regexp_extract({f}, {q('(' + '|'.join(t for t, _ in terms) + ')')}, 1)"
        return "CASE " + " ".join(f"WHEN {hit} = {q(t)} THEN {q(c)}" for t, c in terms) + " END"

    sig = ",\n".join(f"regexp_matches(_f, {q(p)}) AS {n}" for n, p in RU.SIGNALS.items())
    amt = "replace(replace(replace(_amount, '$', ''), '.', ''), ',', '.')"
    money = f"TRY_CAST({strip(amt)} AS DOUBLE)"
    catvar = "[" + ", ".join(
        f"{{'name': {q(n)}, 'vfold': {q(v.lower().translate(str.maketrans('áéíóúüñ', 'aeiouun')))}, 'variant': {q(v)}}}"
        for n, v in S.CATALOGUE if v is not None
    ) + "]"
    alias = "regexp_extract(mention, '([a-z]+)$', 1)"
    name = "CASE " + " ".join(f"WHEN starts_with({alias}, {q(p)}) THEN {q(n)}" for p, n in RU.ALIAS_PREFIX) + " END"
    cat = "CASE " + " ".join(f"WHEN regexp_matches(_f, {q(p)}) THEN {q(c)}" for c, p in RU.FAQ_CATEGORY_RULES) + " ELSE 'otro' END"
    feats = f"""
feats0 AS (SELECT *, translate(lower(text), 'áéíóúüñ', 'aeiouun') AS _f FROM ex),
feats AS (
  SELECT *, {sig},
    {term(RU.PAYMENT_TERMS, '_f')} AS payment_term,
    regexp_matches(_f, {q(RU.GENERIC_TRANSFER[0])}) AS generic_transfer,
    {term(RU.CITY_TERMS, '_f')} AS city_term,
    CASE WHEN contains(_f, 'total') THEN nullif(regexp_extract(text, {q(RU.AMOUNT)}, 1), '') END AS amount_text,
    nullif(regexp_extract(text, {q(RU.NAME_INTRO)}, 1), '') AS intro_name
  FROM feats0
),
days AS (
  SELECT session_id, message_index, CAST(sent_at AS DATE) AS base,
    regexp_extract(regexp_replace(_f, '\\bla manana\\b', ' ', 'g'),
      '\\bpasado manana\\b|\\bmanana\\b|\\bhoy\\b|\\b[0-9]{{1,2}} de (?:enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|setiembre|octubre|noviembre|diciembre)\\b(?: del? [0-9]{{4}}\\b)?|\\b[0-9]{{1,2}}[/-][0-9]{{1,2}}[/-][0-9]{{4}}\\b|\\bel [0-9]{{1,2}}/[0-9]{{1,2}}(?:/[0-9]{{4}})?\\b|\\b(?:el|este|proximo) (?:lunes|martes|miercoles|jueves|viernes|sabado|domingo)\\b') AS hit
  FROM feats
),
days1 AS (
  SELECT *, list_position(['lunes', 'martes', 'miercoles', 'jueves', 'viernes', 'sabado', 'domingo'], regexp_extract(hit, '[a-z]+$')) AS wd,
    TRY_CAST(regexp_extract(hit, '^(?:el )?([0-9]+)', 1) AS INTEGER) AS dd,
    coalesce(list_position(['enero', 'febrero', 'marzo', 'abril', 'mayo', 'junio', 'julio', 'agosto', 'septiembre', 'octubre', 'noviembre', 'diciembre'],
      replace(regexp_extract(hit, ' de ([a-z]+)', 1), 'setiembre', 'septiembre')), TRY_CAST(regexp_extract(hit, '[0-9]+[/-]([0-9]+)', 1) AS INTEGER)) AS mm,
    TRY_CAST(regexp_extract(hit, '[0-9]{{4}}$') AS INTEGER) AS yy
  FROM days WHERE hit <> ''
),
days2 AS (
  SELECT *, TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', year(base), mm, dd) AS DATE) AS this,
    TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', year(base) + 1, mm, dd) AS DATE) AS following
  FROM days1
),
named AS (
  SELECT session_id, arg_min(d, message_index) AS order_date FROM (
    SELECT session_id, message_index, CASE WHEN hit = 'hoy' THEN base WHEN hit = 'manana' THEN base + 1 WHEN hit = 'pasado manana' THEN base + 2
      WHEN wd > 0 THEN base + CAST(1 + (wd - 1 - (isodow(base) - 1) + 6) % 7 AS INTEGER)
      WHEN yy IS NOT NULL THEN TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', yy, mm, dd) AS DATE)
      WHEN mm > 0 THEN CASE WHEN this >= base THEN this ELSE following END END AS d FROM days2) WHERE d IS NOT NULL GROUP BY session_id
),
facts0 AS (
  SELECT conversation_id, session_id, arg_min(client_id, message_index) AS client_id,
    bool_or(intent) AS intent, bool_or(product_qty) AS product_qty, bool_or(delivery) AS delivery,
    bool_or(payment) AS payment, bool_or(followup) AS followup, bool_or(cancel) AS cancel, bool_or(info) AS info,
    coalesce(arg_min(payment_term, message_index),
             CASE WHEN bool_or(generic_transfer) THEN {q(RU.GENERIC_TRANSFER[1])} END) AS payment_method,
    arg_min(city_term, message_index) AS city,
    arg_min(CASE WHEN delivery THEN text END, message_index) AS address,
    arg_min(amount_text, message_index) AS _amount,
    arg_min(CASE WHEN role = 'user' THEN intro_name END, message_index) AS customer_name
  FROM feats GROUP BY conversation_id, session_id
),
facts AS (
  SELECT *,
    CASE WHEN cancel THEN 'cancelled' WHEN followup THEN 'delivery_followup'
         WHEN intent OR product_qty OR delivery OR payment THEN 'confirmed'
         WHEN info THEN 'quotation' ELSE 'unclear' END AS order_type,
    CASE WHEN NOT cancel AND (intent OR product_qty OR delivery OR payment OR followup) THEN
         CASE WHEN followup OR (delivery AND payment) THEN 'confirmada' ELSE 'probable' END END AS sale_state,
    {money} AS approx_total,
    CASE WHEN regexp_matches(client_id, {q(RU.PHONE_LIKE)}) THEN client_id END AS customer_phone
  FROM facts0
),
pm0 AS (SELECT conversation_id, session_id, message_index, string_split_regex(_f, {q(RU.PRODUCT_MENTION)}) AS parts, regexp_extract_all(_f, {q(RU.PRODUCT_MENTION)}, 0) AS l FROM feats),
pm1 AS (SELECT conversation_id, session_id, message_index, parts[gs + 1] AS _f, mention, gs - 1 AS pos
  FROM (SELECT *, unnest(l) AS mention, generate_subscripts(l, 1) AS gs FROM pm0)),
pm2 AS (SELECT *, {name} AS name FROM pm1),
pm AS (
  SELECT conversation_id, session_id, message_index, pos, mention, name,
    list_filter({catvar}, lambda v: v.name = pm2.name AND (contains(pm2._f, v.vfold) OR (NOT contains(v.vfold, ' ')
      AND len(list_filter(string_split_regex(pm2._f, '[^a-z]+'), lambda w: length(w) >= {RU.VARIANT_MIN_WORD} AND levenshtein(w, v.vfold) <= {RU.VARIANT_MAX_EDITS})) > 0)))[1].variant AS variant,
    TRY_CAST(nullif(regexp_extract(mention, '^([0-9]+)', 1), '') AS BIGINT) AS quantity
  FROM pm2
),
nx AS (
  SELECT *, lead(session_id) OVER w AS next_session_id, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM feats WINDOW w AS (PARTITION BY conversation_id ORDER BY sent_at, message_index)
),
pairs AS (
  SELECT session_id, message_index AS pos, text AS pregunta, next_text AS respuesta, {cat} AS categoria
  FROM nx WHERE role = 'user' AND question AND next_role = 'assistant' AND next_session_id = session_id
),
prodn AS (
  SELECT session_id, count(*) AS n_products,
    string_agg(concat_ws(' ', name, nullif(variant, '')), '; ' ORDER BY message_index, pos) AS productos
  FROM pm GROUP BY session_id
),
faqn AS (SELECT session_id, count(*) AS n_faqs FROM pairs GROUP BY session_id)"""
    W4 = f"{MSGS}, {feats}"
    out = {}
    out["order_signals"] = f"""{W4} SELECT session_id, intent, product_qty, delivery, payment, followup, cancel, info,
        (intent OR product_qty OR delivery OR payment OR followup) AS has_order, order_type FROM facts"""
    out["mention_extract"] = f"{W4} SELECT f.session_id, payment_method, city, address, approx_total, strftime(n.order_date, '%Y-%m-%d') AS order_date FROM facts f LEFT JOIN named n ON f.session_id = n.session_id"
    out["customer_mention"] = f"{W4} SELECT session_id, customer_phone, customer_name FROM facts"
    out["sale_state"] = f"{W4} SELECT session_id, sale_state AS estado FROM facts"
    out["catalog_canonical"] = f"{W4} SELECT session_id, message_index, pos, mention, name, variant, quantity, nullif(regexp_extract(mention, '^[0-9]+ (caja|paquete)', 1), '') AS unit FROM pm"
    out["faq_pairs"] = f"{W4} SELECT session_id, pos, pregunta, respuesta, categoria FROM pairs"
    out["extract_orders_rules"] = f"""{W4} SELECT f.session_id, (f.intent OR f.product_qty OR f.delivery OR f.payment OR f.followup) AS has_order,
        f.order_type, n.order_date, f.city, f.address, f.payment_method, f.approx_total, f.customer_phone, f.customer_name,
        CAST(coalesce(p.n_products, 0) AS INTEGER) AS n_products
      FROM facts f LEFT JOIN prodn p ON f.session_id = p.session_id LEFT JOIN named n ON f.session_id = n.session_id"""
    out["extract_faq_rules"] = f"""{W4} SELECT f.session_id, coalesce(q.n_faqs, 0) AS n_faqs,
        f.sale_state AS venta_estado, CASE WHEN f.sale_state IS NOT NULL THEN f.approx_total END AS venta_total,
        CASE WHEN f.sale_state IS NOT NULL THEN coalesce(p.n_products, 0) END AS venta_n_productos,
        CASE WHEN f.customer_name IS NOT NULL OR f.city IS NOT NULL THEN f.customer_name END AS cliente_nombre,
        CASE WHEN f.customer_name IS NOT NULL OR f.city IS NOT NULL THEN f.city END AS cliente_ciudad
      FROM facts f LEFT JOIN faqn q ON f.session_id = q.session_id LEFT JOIN prodn p ON f.session_id = p.session_id"""
    out["faq_frequency"] = f"""{W4} SELECT arg_min(pregunta, (session_id, pos)) AS pregunta, arg_min(respuesta, (session_id, pos)) AS respuesta,
        arg_min(categoria, (session_id, pos)) AS categoria, count(*) AS frecuencia
      FROM pairs WHERE lower({strip('pregunta')}) <> '' GROUP BY lower({strip('pregunta')})"""
    out["sales_detected"] = f"""{W4} SELECT f.session_id, f.client_id, f.address AS direccion, f.approx_total AS total,
        f.payment_method AS metodo_pago, f.sale_state AS estado, coalesce(p.productos, '') AS productos
      FROM facts f LEFT JOIN prodn p ON f.session_id = p.session_id WHERE f.sale_state IS NOT NULL"""
    out["client_notes"] = f"""{W4} SELECT customer_name AS nombre, CAST(NULL AS VARCHAR) AS telefono, city AS ciudad,
        CAST(NULL AS VARCHAR) AS notas, client_id FROM facts WHERE customer_name IS NOT NULL OR city IS NOT NULL"""
    return out


for _k, _v in _rules_sql().items():
    sql(_k, _v)


# ---------------------------------------------------------------------------
# File selection, manifests, request gating, bot parsers and texts
# ---------------------------------------------------------------------------
LISTING = """
listing AS (
  SELECT CASE doc_id % 5 WHEN 0 THEN 'WhatsApp - d' || doc_id || '.csv'
                         WHEN 1 THEN 'WhatsApp - d' || doc_id || '.CSV'
                         WHEN 2 THEN 'WhatsApp - d' || doc_id || '.txt'
                         WHEN 3 THEN 'd' || doc_id || ' WhatsApp Business.csv'
                         ELSE 'chat d' || doc_id || '.csv' END AS file_name,
         CASE WHEN doc_id % 13 = 0 THEN 0 ELSE n_chars END AS file_size
  FROM documents
)"""
sql(
    "chat_file_filter",
    f"""WITH {LISTING} SELECT file_name, file_size,
        (lower(file_name) LIKE '%.csv' AND NOT contains(file_name, 'WhatsApp Business.csv') AND file_size > 0) AS selected
      FROM listing""",
)
MANIFEST = """
remote AS (SELECT DISTINCT 'chat_' || CASE WHEN doc_id % 11 = 0 THEN doc_id - 1 ELSE doc_id END || '.csv' AS name FROM documents),
localn AS (SELECT DISTINCT name FROM (
    SELECT 'chat_' || doc_id || '.csv' AS name FROM documents WHERE doc_id % 3 <> 0
    UNION ALL SELECT 'viejo_' || doc_id || '.csv' FROM documents WHERE doc_id % 7 = 0))"""
sql(
    "manifest_diff",
    f"""WITH {MANIFEST}
      SELECT 'remote' AS measure, count(*) AS n FROM remote
      UNION ALL SELECT 'local', count(*) FROM localn
      UNION ALL SELECT 'missing', count(*) FROM remote WHERE name NOT IN (SELECT name FROM localn)
      UNION ALL SELECT 'extra', count(*) FROM localn WHERE name NOT IN (SELECT name FROM remote)""",
)
sql(
    "manifest_missing_sample",
    f"WITH {MANIFEST} SELECT name FROM remote WHERE name NOT IN (SELECT name FROM localn) ORDER BY name LIMIT 10",
)


def _auth_sql() -> str:
    import ipaddress

    from chatledger import schemas as S

    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    pat = f"^{octet}(\\.{octet}){{3}}$"
    ranges = " OR ".join(
        f"ip_long BETWEEN {int(n.network_address)} AND {int(n.broadcast_address)}"
        for n in (ipaddress.ip_network(c) for c in S.TRUSTED_IP_RANGES)
    )
    return f"""WITH req AS (
        SELECT event_id, user_id AS chat_id,
          '149.154.' || (160 + user_id % 20) || '.' || (event_id % 256) AS peer_ip,
          CASE WHEN event_id % 3 = 0 THEN ' 91.108.' || (4 + event_id % 6) || '.' || (user_id % 256) || ', 10.0.0.1' END AS xff,
          CASE WHEN event_id % 3 = 1 THEN CASE WHEN event_id % 7 = 0 THEN 'not-an-ip' ELSE '149.154.17' || (event_id % 10) || '.9' END END AS xri
        FROM events),
      ip AS (
        SELECT *, CASE WHEN coalesce(xff, '') <> '' THEN {strip("split_part(xff, ',', 1)")}
                       WHEN coalesce(xri, '') <> '' THEN xri
                       WHEN coalesce(peer_ip, '') <> '' THEN peer_ip ELSE '0.0.0.0' END AS client_ip
        FROM req),
      ipl AS (
        SELECT *, CASE WHEN regexp_matches(client_ip, '{pat}') THEN
            CAST(split_part(client_ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(client_ip, '.', 2) AS BIGINT) * 65536
            + CAST(split_part(client_ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(client_ip, '.', 4) AS BIGINT) END AS ip_long
        FROM ip),
      fl AS (
        SELECT event_id, client_ip, coalesce({ranges}, false) AS ip_ok, true AS token_ok,
               chat_id IN (SELECT DISTINCT user_id FROM events WHERE user_id % 10 <> 9) AS user_allowed
        FROM ipl)
      SELECT event_id, client_ip, ip_ok, token_ok, user_allowed, token_ok AND ip_ok AND user_allowed AS authorised FROM fl"""


sql("authorised_updates", _auth_sql())

BOT_TEXTS = """
bt AS (
  SELECT o_orderkey,
    CASE o_orderkey % 6 WHEN 0 THEN '$' || replace(format('{:,}', CAST(floor(o_totalprice) AS BIGINT)), ',', '.')
                        WHEN 1 THEN format('{:,}', CAST(floor(o_totalprice) AS BIGINT))
                        WHEN 2 THEN ' ' || CAST(floor(o_totalprice) AS BIGINT) || ' '
                        WHEN 3 THEN 'abc' WHEN 4 THEN '-5' ELSE '0' END AS total_text,
    CASE WHEN o_orderkey % 9 = 0 THEN '12 34' ELSE '+57 (300) ' || lpad(CAST(o_orderkey % 10000000 AS VARCHAR), 7, '0') END AS phone_text
  FROM orders
)"""
sql(
    "money_parse_bot",
    f"""WITH {BOT_TEXTS}, m AS (SELECT *, regexp_replace(total_text, '[$., ]', '', 'g') AS t FROM bt)
      SELECT o_orderkey, total_text,
        CASE WHEN regexp_matches(t, '^[+-]?[0-9]+$') AND TRY_CAST(t AS BIGINT) > 0 THEN TRY_CAST(t AS BIGINT) END AS total
      FROM m""",
)
sql(
    "phone_parse_bot",
    f"""WITH {BOT_TEXTS}, p AS (SELECT *, regexp_replace(phone_text, '[^0-9]', '', 'g') AS d FROM bt)
      SELECT o_orderkey, phone_text, CASE WHEN length(d) >= 7 THEN d END AS phone FROM p""",
)
sql(
    "product_button_id",
    f"""{W} SELECT name, variant, concat_ws(' ', name, nullif(variant, '')) AS display_name,
        lower(name) || '_' || replace(lower(coalesce(nullif(variant, ''), '')), ' ', '_') AS button_id FROM mp""",
)
sql(
    "sale_summary_text",
    f"""{W}, lines AS (
          SELECT order_id, string_agg('  • ' || quantity || 'x ' || concat_ws(' ', product_name, nullif(variant, '')), chr(10) ORDER BY id, quantity) AS body
          FROM mi_all WHERE coalesce(product_name, '') <> '' GROUP BY order_id)
        SELECT o.id AS order_id,
          '📦 <b>Confirmar venta:</b>' || chr(10) || chr(10) || '👤 <b>Cliente:</b> ' || coalesce(c.name, 'None')
          || CASE WHEN o.client_id IS NULL THEN ' (nuevo)' ELSE '' END
          || chr(10) || '📱 <b>Tel:</b> ' || coalesce(c.phone, 'None') || chr(10) || chr(10)
          || CASE WHEN l.body IS NOT NULL THEN '🛒 <b>Productos:</b>' || chr(10) || l.body ELSE '🛒 <b>Carrito vacío</b>' END
          || chr(10) || chr(10) || '💰 <b>Total:</b> $' || coalesce(format('{{:,}}', CAST(trunc(o.total) AS BIGINT)), 'None') || ' COP' AS summary
        FROM mo o LEFT JOIN mc c ON o.client_id = c.id LEFT JOIN lines l ON o.id = l.order_id""",
)
sql("order_short_code", f"{W} SELECT id, left(id, 8) AS short_code FROM mo")


# ---------------------------------------------------------------------------
# Sale dialogue: one update of every chat per step of the recursion
# ---------------------------------------------------------------------------
def _dialogue_sql() -> dict[str, str]:
    from chatledger import schemas as S

    buttons = lst([f"prod_{n.lower()}_{(v or '').lower().replace(' ', '_')}" for n, v in S.CATALOGUE])
    names, variants = lst(_NAMES), lst(_VARIANTS)
    qty = lst([f"cant_{n}" for n in range(1, 11)])
    line = "STRUCT(name VARCHAR, variant VARCHAR, cantidad BIGINT)"
    sale = f"STRUCT(telefono VARCHAR, nombre VARCHAR, client_id VARCHAR, es_nuevo BOOLEAN, productos {line}[], total BIGINT)"
    bare = "replace(replace(replace(replace(text, '$', ''), '.', ''), ',', ''), ' ', '')"
    dialogue = f"""WITH RECURSIVE {MART},
      ev AS (SELECT event_id AS e, user_id AS u, event_type AS t, value AS v, ts FROM events),
      script AS (SELECT *, unnest(range(8)) AS i FROM ev WHERE t = 'purchase' AND e % 3 <> 0),
      raw AS (
        SELECT e * 8 AS update_id, u AS chat_id, ts,
          CASE WHEN t = 'signup' AND v < 8 THEN '/venta' WHEN t = 'signup' THEN '+57 300 ' || lpad(CAST(u AS VARCHAR), 7, '0')
               WHEN t = 'view' AND v < 3 THEN '123' WHEN t = 'view' AND v > 250 THEN 'A' WHEN t = 'view' THEN 'Cliente ' || u
               WHEN t = 'error' AND v < 60 AND e % 7 = 0 THEN 'abc' WHEN t = 'error' AND v < 60 THEN '$66.000' END AS text,
          CASE WHEN t = 'purchase' AND e % 4 = 0 THEN 'prod_finalizar' WHEN t = 'purchase' AND e % 17 = 0 THEN 'prod_desconocido'
               WHEN t = 'purchase' THEN {buttons}[e % {len(_NAMES)} + 1]
               WHEN t = 'click' AND e % 13 = 0 THEN 'cant_cancelar' WHEN t = 'click' THEN 'cant_' || (1 + e % 10)
               WHEN t = 'error' AND v >= 60 AND e % 5 = 0 THEN 'confirm_no' WHEN t = 'error' AND v >= 60 THEN 'confirm_si' END AS data
        FROM ev WHERE NOT (t = 'purchase' AND e % 3 <> 0)
        UNION ALL
        SELECT e * 8 + i, u, ts,
          CASE i WHEN 0 THEN '/venta'
            WHEN 1 THEN CASE WHEN e % 37 = 0 THEN '12' ELSE '+57 300 ' || lpad(CAST(CASE WHEN e % 5 = 0 THEN u + 5000000 ELSE u END AS VARCHAR), 7, '0') END
            WHEN 2 THEN CASE WHEN e % 31 = 0 THEN 'A' ELSE 'Cliente ' || e END
            WHEN 6 THEN CASE WHEN e % 23 = 0 THEN 'abc' WHEN e % 29 = 0 THEN '99999999999' ELSE '$' || (20 + e % 900) || '.000' END END,
          CASE i WHEN 3 THEN {buttons}[e % {len(_NAMES)} + 1]
            WHEN 4 THEN CASE WHEN e % 19 = 0 THEN 'cant_3000000000' ELSE 'cant_' || (1 + e % 10) END
            WHEN 5 THEN 'prod_finalizar' WHEN 7 THEN CASE WHEN e % 11 = 0 THEN 'confirm_no' ELSE 'confirm_si' END END
        FROM script),
      one AS (
        SELECT regexp_replace(phone, '[^0-9]', '', 'g') AS k, arg_min({{'id': id, 'name': name}}, (created_at, id)) AS c
        FROM mc WHERE phone IS NOT NULL GROUP BY 1),
      upd AS MATERIALIZED (
        SELECT r.update_id, r.chat_id, r.ts, r.data, coalesce(r.text, '') AS text, regexp_replace(coalesce(r.text, ''), '[^0-9]', '', 'g') AS digits,
          CASE WHEN r.data IS NOT NULL THEN 'callback' WHEN r.text IS NOT NULL THEN 'message' END AS kind,
          r.chat_id % 10 <> 9 AS allowed, one.c.id AS found_id, one.c.name AS found_name,
          row_number() OVER (PARTITION BY r.chat_id ORDER BY r.update_id) AS rn
        FROM raw r LEFT JOIN one ON regexp_replace(r.text, '[^0-9]', '', 'g') = one.k),
      d AS (
        SELECT DISTINCT chat_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS update_id, 'idle' AS st, CAST(NULL AS VARCHAR) AS tel,
          CAST(NULL AS VARCHAR) AS nombre, CAST(NULL AS VARCHAR) AS client_id, false AS es_nuevo, CAST([] AS {line}[]) AS cart,
          CAST(NULL AS VARCHAR) AS picked, CAST(NULL AS BIGINT) AS total, CAST(NULL AS VARCHAR) AS reply, CAST(NULL AS {sale}) AS sale
        FROM upd
        UNION ALL
        SELECT chat_id, rn, update_id,
          CASE WHEN reply = 'ask_phone' THEN 'esperando_telefono' WHEN fresh THEN 'idle'
            WHEN reply IN ('client_found', 'ask_products', 'added') OR (reply = 'error' AND known_qty) THEN 'seleccionando_productos'
            WHEN reply = 'new_client' THEN 'esperando_nombre' WHEN reply = 'summary' THEN 'confirmacion'
            WHEN reply = 'ask_total' THEN 'esperando_total' WHEN reply = 'ask_quantity' THEN 'seleccionando_cantidad' ELSE st END,
          CASE WHEN fresh THEN NULL WHEN reply IN ('client_found', 'new_client') THEN digits ELSE tel END,
          CASE WHEN fresh THEN NULL WHEN reply = 'client_found' THEN found_name WHEN reply = 'ask_products' AND kind = 'message' THEN text ELSE nombre END,
          CASE WHEN fresh THEN NULL WHEN reply = 'client_found' THEN found_id ELSE client_id END,
          CASE WHEN fresh OR reply = 'client_found' THEN false WHEN reply = 'new_client' THEN true ELSE es_nuevo END,
          CASE WHEN fresh THEN CAST([] AS {line}[])
            WHEN reply = 'added' THEN list_append(cart, CAST(row({names}[list_position({buttons}, picked)], {variants}[list_position({buttons}, picked)], CAST(substr(data, 6) AS BIGINT)) AS {line})) ELSE cart END,
          CASE WHEN fresh OR reply = 'added' OR (reply = 'ask_products' AND kind = 'callback') THEN NULL WHEN reply = 'ask_quantity' THEN data ELSE picked END,
          CASE WHEN fresh THEN NULL WHEN reply = 'summary' THEN typed ELSE total END,
          reply,
          CASE WHEN reply = 'sale_saved' THEN CAST(row(tel, nombre, client_id, es_nuevo, cart, total) AS {sale}) END
        FROM (
          SELECT *, reply IN ('ask_phone', 'welcome', 'cancelled', 'sale_saved', 'sale_rejected', 'sale_cancelled') AS fresh
          FROM (
            SELECT *,
              CASE
                WHEN kind = 'callback' AND NOT allowed THEN 'unauthorised'
                WHEN kind = 'callback' AND data = 'prod_finalizar' THEN CASE WHEN len(cart) = 0 THEN 'cart_empty' ELSE 'ask_total' END
                WHEN kind = 'callback' AND starts_with(data, 'prod_') THEN CASE WHEN list_contains({buttons}, data) THEN 'ask_quantity' ELSE 'ignored' END
                WHEN kind = 'callback' AND data = 'cant_cancelar' THEN 'ask_products'
                WHEN kind = 'callback' AND starts_with(data, 'cant_') THEN CASE WHEN known_qty AND picked IS NOT NULL THEN 'added' ELSE 'error' END
                WHEN kind = 'callback' AND data = 'confirm_si' THEN CASE WHEN st = 'confirmacion' THEN 'sale_saved' ELSE 'sale_rejected' END
                WHEN kind = 'callback' AND starts_with(data, 'confirm_') THEN 'sale_cancelled'
                WHEN kind = 'callback' THEN 'ack'
                WHEN kind IS NULL OR text = '' THEN 'ignored'
                WHEN NOT allowed THEN 'unauthorised'
                WHEN text = '/start' THEN 'welcome' WHEN text = '/cancelar' THEN 'cancelled' WHEN text = '/venta' THEN 'ask_phone'
                WHEN text = '/id' THEN 'your_id' WHEN text IN ('/ayuda', '/help') THEN 'help'
                WHEN st = 'esperando_telefono' THEN CASE WHEN length(digits) < 7 THEN 'bad_phone' WHEN found_id IS NOT NULL THEN 'client_found' ELSE 'new_client' END
                WHEN st = 'esperando_nombre' THEN CASE WHEN length(text) < 2 THEN 'short_name' ELSE 'ask_products' END
                WHEN st = 'esperando_total' THEN CASE WHEN typed > 0 THEN 'summary' ELSE 'bad_total' END
                ELSE 'hint' END AS reply
            FROM (
              SELECT d.chat_id, u.rn, u.update_id, d.st, d.tel, d.nombre, d.client_id, d.es_nuevo, d.cart, d.picked, d.total,
                u.kind, u.text, u.data, u.digits, u.allowed, u.found_id, u.found_name,
                coalesce(list_contains({qty}, u.data), false) AS known_qty,
                CASE WHEN regexp_full_match({bare}, '[+-]?[0-9]+') THEN TRY_CAST({bare} AS BIGINT) END AS typed
              FROM d JOIN upd u ON u.chat_id = d.chat_id AND u.rn = d.rn + 1) j) r) f),
      sales AS (
        SELECT d.chat_id, d.update_id, upd.ts, d.sale.telefono AS telefono, d.sale.nombre AS nombre, d.sale.client_id AS client_id,
          d.sale.es_nuevo AS es_nuevo, d.sale.productos AS productos, d.sale.total AS total
        FROM d JOIN upd ON d.update_id = upd.update_id WHERE d.sale IS NOT NULL),
      rows_ AS (
        SELECT *, {uuid("'bot-order:' || chat_id || ':' || update_id")} AS order_id,
          CASE WHEN es_nuevo THEN {uuid("'client:telegram_' || telefono")} ELSE client_id END AS client
        FROM sales WHERE total < 10000000000)"""
    return {
        "dialogue_replies": f"{dialogue} SELECT reply, st AS state, count(*) AS n FROM d WHERE rn > 0 GROUP BY reply, st",
        "dialogue_sales": f"{dialogue} SELECT chat_id, update_id, telefono, nombre, client_id, es_nuevo, CAST(len(productos) AS BIGINT) AS lines, total FROM sales",
        "bot_orders": f"""{dialogue} SELECT order_id AS id, client AS client_id, strftime(ts, '%Y-%m-%d') AS order_date, CAST(total AS DOUBLE) AS total,
            'pending' AS status, CAST(NULL AS VARCHAR) AS source_session_id FROM rows_""",
        "bot_items": f"""{dialogue} SELECT {uuid("'bot-item:' || chat_id || ':' || update_id || ':' || (n - 1)")} AS id, order_id,
            (SELECT min(mp.id) FROM mp WHERE mp.name = l.name AND mp.variant IS NOT DISTINCT FROM l.variant) AS product_id,
            l.name AS product_name, l.variant AS variant, l.cantidad AS quantity, 'caja' AS unit
          FROM (SELECT *, unnest(productos) AS l, unnest(range(1, len(productos) + 1)) AS n FROM rows_)""",
        "bot_clients": f"""{dialogue} SELECT client AS id, r.phone AS phone, r.name AS name, r.source_client_id AS source_client_id
          FROM (SELECT client, arg_max({{'phone': telefono, 'name': nombre, 'source_client_id': 'telegram_' || telefono}}, (update_id, chat_id)) AS r
                FROM rows_ WHERE es_nuevo GROUP BY client)""",
        "bot_sale_rejects": f"{dialogue} SELECT chat_id, update_id, telefono, total FROM sales WHERE total >= 10000000000",
    }


for _k, _v in _dialogue_sql().items():
    sql(_k, _v)
