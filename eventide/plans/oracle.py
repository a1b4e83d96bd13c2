"""DuckDB SQL equivalents of the registered queries: plain window-function
forms over the same tables (no chunking, no Spark).  Decimal literals are
written as DOUBLE so thresholds compare exactly as in the operators."""

ORACLE: dict[str, str] = {}

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

ORACLE["spend_threshold"] = """
WITH r AS (
  SELECT o_custkey AS customer_id, CAST(o_orderkey AS VARCHAR) AS crossing_order_id,
         o_orderdate, o_orderkey,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(27, 10))) OVER w AS DOUBLE) AS s, ROW_NUMBER() OVER w AS n
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT customer_id, ROUND(s, 2) AS total_spend, crossing_order_id,
       CAST(n AS INTEGER) AS order_count
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
                                   ORDER BY o_orderdate, o_orderkey) AS first_hit
      FROM r WHERE s >= 500000)
WHERE first_hit = 1
"""

def _alerts(threshold: float, listed: str) -> str:
    """Rules over f; ``listed``: five earlier amounts are there."""
    return f"""g AS (
  SELECT *,
    COALESCE(lt IS NOT NULL AND t - lt < 3600000 AND n > 10, false) AS r1,
    COALESCE(lc IS NOT NULL AND lc IS DISTINCT FROM country AND lt IS NOT NULL
             AND t - lt < 7200000, false) AS r2,
    COALESCE(n > 0 AND amount > tot / n * 5.0::DOUBLE, false) AS r3,
    COALESCE(mc > 5, false) AS r4,
    COALESCE({listed} AND sm >= 4, false) AS r5
  FROM f),
h AS (
  SELECT *,
    0.0::DOUBLE + (CASE WHEN r1 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END)
                + (CASE WHEN r2 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END)
                + (CASE WHEN r3 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END)
                + (CASE WHEN r4 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END)
                + (CASE WHEN r5 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END) AS riskScore,
    concat_ws(',', CASE WHEN r1 THEN 'HIGH_VELOCITY' END, CASE WHEN r2 THEN 'GEO_IMPOSSIBLE' END,
              CASE WHEN r3 THEN 'AMOUNT_ANOMALY' END, CASE WHEN r4 THEN 'MERCHANT_FREQUENCY' END,
              CASE WHEN r5 THEN 'SMALL_TXN_PATTERN' END) AS reason
  FROM g)
SELECT userId, 'HIGH_RISK' AS alertType, riskScore, reason,
       CAST(n + 1 AS INTEGER) AS transactionCount, event_id
FROM h WHERE riskScore >= {threshold}::DOUBLE
"""


def _anomaly_sql(threshold: float, ttl_ms: int | None = None) -> str:
    expired = f"t - pt > {ttl_ms}" if ttl_ms else "false"
    return f"""
WITH e AS (
  SELECT user_id AS userId, value AS amount, CAST({_K} % 20 AS VARCHAR) AS country,
         event_type AS merchant, (epoch_us(ts) // 1000) AS t, event_id
  FROM events),
p AS (SELECT *, LAG(t) OVER (PARTITION BY userId ORDER BY t, event_id) AS pt FROM e),
x AS (SELECT *, SUM(CASE WHEN {expired} THEN 1 ELSE 0 END)
             OVER (PARTITION BY userId ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS ep FROM p),
f AS (
  SELECT *, LAG(t) OVER w AS lt, LAG(country) OVER w AS lc, ROW_NUMBER() OVER w - 1 AS n,
         CAST(SUM(CAST(amount AS DECIMAL(27, 10))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS tot,
         COUNT(*) FILTER (WHERE amount < 10.0::DOUBLE)
           OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS sm,
         ROW_NUMBER() OVER (PARTITION BY userId, ep, merchant ORDER BY t, event_id) - 1 AS mc
  FROM x WINDOW w AS (PARTITION BY userId, ep ORDER BY t, event_id)),
{_alerts(threshold, "n >= 5")}"""


ORACLE["anomaly_alerts"] = _anomaly_sql(0.7)
ORACLE["anomaly_alerts_ttl"] = _anomaly_sql(0.5, 43_200_000)

_H = 3_600_000
ORACLE["anomaly_alerts_clocks"] = f"""
WITH e AS (
  SELECT user_id AS userId, value AS amount, CAST({_K} % 20 AS VARCHAR) AS country,
         event_type AS merchant, (epoch_us(ts) // 1000) AS t, event_id
  FROM events),
p AS (SELECT *, LAG(t) OVER w AS pt, LAG(t, 5) OVER w AS t5, LAG(t) OVER m AS mt,
             COUNT(*) FILTER (WHERE amount < 10.0::DOUBLE)
               OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS sm
      FROM e WINDOW w AS (PARTITION BY userId ORDER BY t, event_id),
                    m AS (PARTITION BY userId, merchant ORDER BY t, event_id)),
x AS (SELECT *, SUM(CASE WHEN t - pt > {12 * _H} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY userId ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS ep,
             SUM(CASE WHEN t - mt > {36 * _H} THEN 1 ELSE 0 END)
               OVER (PARTITION BY userId, merchant ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS mep
      FROM p),
f AS (
  SELECT *, LAG(t) OVER w AS lt, LAG(country) OVER w AS lc, ROW_NUMBER() OVER w - 1 AS n,
         CAST(SUM(CAST(amount AS DECIMAL(27, 10))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS tot,
         ROW_NUMBER() OVER (PARTITION BY userId, merchant, mep ORDER BY t, event_id) - 1 AS mc
  FROM x WINDOW w AS (PARTITION BY userId, ep ORDER BY t, event_id)),
{_alerts(0.4, f"t - t5 <= {48 * _H}")}"""

ORACLE["dynamic_pricing"] = f"""
WITH RECURSIVE e AS (
  SELECT CAST(user_id AS VARCHAR) AS sku, (epoch_us(ts) // 1000) AS t, event_id AS seq,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS side,
         {_K} AS k, value AS cp
  FROM events),
x AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sku ORDER BY t, side, seq) AS rn FROM e),
st AS (
  SELECT sku, 0::BIGINT AS rn, NULL::BIGINT AS seq, NULL::BIGINT AS t, NULL::DOUBLE AS price,
         0 AS inv, NULL::DOUBLE AS comp, 0 AS dem, NULL::DOUBLE AS np, NULL::DOUBLE AS op,
         NULL::VARCHAR AS reason
  FROM (SELECT DISTINCT sku FROM e)
  UNION ALL
  SELECT sku, rn, seq, t, CASE WHEN emit THEN new ELSE price END, inv, comp,
         CASE WHEN hd THEN 0 ELSE dem END,
         CASE WHEN emit THEN new END, CASE WHEN emit THEN price END,
         CASE WHEN emit THEN CASE WHEN low OR hd OR cm THEN
           concat_ws(',', CASE WHEN low THEN 'LOW_INVENTORY' END,
                     CASE WHEN hd THEN 'HIGH_DEMAND' END,
                     CASE WHEN cm THEN 'COMPETITOR_MATCH' END) ELSE 'BASELINE' END END
  FROM (
   SELECT *, COALESCE(abs(new - price) > price * 0.02::DOUBLE, false) AS emit FROM (
    SELECT *, CASE WHEN cm THEN comp * 0.98::DOUBLE ELSE n2 END AS new FROM (
     SELECT *, COALESCE(price IS NOT NULL AND comp IS NOT NULL
                        AND abs(n2 - comp) > comp * 0.05::DOUBLE, false) AS cm FROM (
      SELECT *, CASE WHEN hd THEN price * 1.08::DOUBLE ELSE n1 END AS n2 FROM (
       SELECT *, COALESCE(dem > 3 AND n1 < price * 1.1::DOUBLE, false) AS hd FROM (
        SELECT *, CASE WHEN low THEN price * 1.15::DOUBLE ELSE price END AS n1 FROM (
         SELECT *, COALESCE(inv < 10 AND price < price * 1.2::DOUBLE, false) AS low FROM (
          SELECT s.sku, x.rn, x.seq, x.t,
                 CASE WHEN x.side = 0 THEN COALESCE(s.price, 10.0::DOUBLE + x.k)
                      ELSE s.price END AS price,
                 CASE WHEN x.side = 0 THEN x.k % 50 + 1 ELSE s.inv END AS inv,
                 CASE WHEN x.side = 1 THEN x.cp ELSE s.comp END AS comp,
                 s.dem + CASE WHEN x.side = 0 THEN 1 ELSE 0 END AS dem
          FROM st s JOIN x ON x.sku = s.sku AND x.rn = s.rn + 1) a) b) c) d) f) g) h))
SELECT sku, ROUND(np, 4) AS newPrice, ROUND(op, 4) AS oldPrice, reason, t AS timestamp, seq
FROM st WHERE np IS NOT NULL
"""


def _sessions_sql(close: bool) -> str:
    extra = " OR t - pt > 43200000" if close else ""
    return f"""
WITH e AS (SELECT user_id, event_type AS et, (epoch_us(ts) // 1000) AS t, event_id FROM events),
a AS (SELECT *, LAG(t) OVER w AS pt, LAG(et) OVER w AS pe, LEAD(t) OVER w AS nt
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
b AS (SELECT *, SUM(CASE WHEN pt IS NULL OR pe = 'purchase'{extra} THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS sid
      FROM a),
c AS (SELECT *, ROW_NUMBER() OVER s AS cnt, FIRST_VALUE(t) OVER s AS st,
             FIRST_VALUE(et) OVER s AS fe
      FROM b WINDOW s AS (PARTITION BY user_id, sid ORDER BY t, event_id))
SELECT user_id, CASE WHEN et = 'purchase' THEN 'COMPLETED' ELSE 'TIMEOUT' END AS status,
       CASE WHEN et = 'purchase' THEN t - st ELSE t + 43200000 - st END AS sessionDuration,
       CAST(cnt AS INTEGER) AS eventCount, fe AS firstEventType, et AS lastEventType
FROM c WHERE et = 'purchase' OR nt IS NULL OR nt - t > 43200000
"""


ORACLE["sessions_continue"] = _sessions_sql(False)
ORACLE["sessions_close"] = _sessions_sql(True)

ORACLE["session_summary"] = """
WITH a AS (SELECT user_id, ts, value, event_type, event_id,
                  LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pts
           FROM events),
b AS (SELECT *, SUM(CASE WHEN pts IS NULL OR ts >= pts + INTERVAL 12 HOUR THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
      FROM a)
SELECT user_id AS userId, MIN(ts) AS sessionStart, MAX(ts) + INTERVAL 12 HOUR AS sessionEnd,
       CAST(COUNT(*) AS INTEGER) AS eventCount, ROUND(SUM(value), 2) AS totalValue,
       array_to_string(list_sort(list_distinct(list(event_type))), ',') AS eventTypes
FROM b GROUP BY user_id, sid
"""

ORACLE["session_event_pages"] = """
WITH a AS (SELECT user_id, ts, value, event_type, event_id,
                  LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pts
           FROM events),
b AS (SELECT *, SUM(CASE WHEN pts IS NULL OR ts >= pts + INTERVAL 12 HOUR THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
      FROM a),
c AS (SELECT *, (ROW_NUMBER() OVER w - 1) // 4 + 1 AS page, MIN(ts) OVER s AS sessionStart,
             MAX(ts) OVER s + INTERVAL 12 HOUR AS sessionEnd, COUNT(*) OVER s AS n,
             SUM(CAST(value AS DECIMAL(27, 10))) OVER s AS total
      FROM b WINDOW w AS (PARTITION BY user_id, sid ORDER BY ts, event_id), s AS (PARTITION BY user_id, sid))
SELECT user_id AS userId, sessionStart, sessionEnd, CAST(n AS INTEGER) AS eventCount,
       ROUND(CAST(total AS DOUBLE), 2) AS totalValue, page,
       string_agg(event_type, ',' ORDER BY ts, event_id) AS eventTypes
FROM c GROUP BY user_id, sid, sessionStart, sessionEnd, n, total, page
"""

ORACLE["first_match_join"] = f"""
WITH u AS (
  SELECT user_id AS customerId, (epoch_us(ts) // 1000) AS t, 0 AS side, event_id AS seq,
         CAST(event_id AS VARCHAR) AS orderId, value AS totalAmount,
         NULL::VARCHAR AS name, NULL::VARCHAR AS email, NULL::VARCHAR AS tier
  FROM events WHERE event_type IN ('purchase', 'click', 'view')
  UNION ALL
  SELECT e.user_id, (epoch_us(e.ts) // 1000), 1, e.event_id, NULL, NULL,
         CASE WHEN {_K} % 7 = 0 THEN NULL ELSE c.c_name END,
         lower(replace(c.c_name, '#', '')) || '@example.com', c.c_mktsegment
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
  WHERE e.event_type NOT IN ('purchase', 'click', 'view')),
r AS (
  SELECT *,
    LAST_VALUE(CASE WHEN side = 0 THEN struct_pack(orderId := orderId,
                                                   totalAmount := totalAmount) END
               IGNORE NULLS) OVER w AS lo,
    LAST_VALUE(CASE WHEN side = 1 THEN struct_pack(name := name, email := email,
                                                   tier := tier) END
               IGNORE NULLS) OVER w AS lc,
    FIRST_VALUE(side) OVER w AS fs
  FROM u WINDOW w AS (PARTITION BY customerId ORDER BY t, side, seq
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customerId ORDER BY t, side, seq) AS first_hit
  FROM r WHERE (side = 0 AND lc.name IS NOT NULL) OR (side = 1 AND lo.orderId IS NOT NULL))
SELECT lo.orderId AS orderId, customerId, lo.totalAmount AS totalAmount,
       lc.name AS customerName, lc.email AS customerEmail, lc.tier AS customerTier,
       CASE WHEN fs = 0 THEN 'ORDER' ELSE 'CUSTOMER' END AS firstArrival, t AS joinTimestamp
FROM c WHERE first_hit = 1
"""

def _audit_sql(expired: str = "false") -> str:
    return f"""
WITH c AS (
  SELECT CASE user_id % 6 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP'
                          WHEN 3 THEN 'JPY' WHEN 4 THEN 'CHF' ELSE 'UNK' END AS currency,
         CASE event_type WHEN 'signup' THEN '+I' WHEN 'click' THEN '+U' WHEN 'view' THEN '+U'
                         WHEN 'error' THEN '-U' WHEN 'purchase' THEN '-D' END AS op,
         CAST(value AS DECIMAL(10, 4)) AS rate, ts AS update_time, (epoch_us(ts) // 1000) AS t, event_id
  FROM events),
p AS (SELECT *, LAG(t) OVER (PARTITION BY currency ORDER BY t, event_id) AS pt
      FROM c WHERE op IN ('+I', '+U', '-D')),
d AS (
  SELECT *, CASE WHEN {expired} THEN NULL ELSE LAG(CASE WHEN op <> '-D' THEN rate END)
              OVER (PARTITION BY currency ORDER BY t, event_id) END AS prev
  FROM p)
SELECT currency,
       CASE op WHEN '+I' THEN 'INSERT' WHEN '+U' THEN 'UPDATE' ELSE 'DELETE' END AS change_type,
       CASE WHEN op = '+I' THEN NULL ELSE prev END AS old_rate,
       CASE WHEN op = '-D' THEN NULL ELSE rate END AS new_rate,
       update_time AS change_time
FROM d
"""


ORACLE["changelog_audit"] = _audit_sql()
ORACLE["changelog_audit_ttl"] = _audit_sql("t - pt > 60000")

ORACLE["latest_by_key"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
"""

_OCOLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
          "o_orderpriority"]
ORACLE["latest_changelog"] = f"""
WITH a AS (
  SELECT *, MAX(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx
  FROM orders),
k AS (SELECT * EXCLUDE (mx) FROM a WHERE mx IS NULL OR o_orderdate >= mx),
l AS (
  SELECT *, ROW_NUMBER() OVER w AS rn,
         {", ".join(f"LAG({c}) OVER w AS p_{c}" for c in _OCOLS)}
  FROM k WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT '+I' AS op, 0 AS change_seq, {", ".join(_OCOLS)} FROM l WHERE rn = 1
UNION ALL
SELECT '-U', 0, {", ".join(f"p_{c}" for c in _OCOLS)} FROM l WHERE rn > 1
UNION ALL
SELECT '+U', 1, {", ".join(_OCOLS)} FROM l WHERE rn > 1
"""

ORACLE["changelog_audit_versioned"] = """
WITH a AS (
  SELECT *, MAX(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx
  FROM orders),
k AS (SELECT * EXCLUDE (mx) FROM a WHERE mx IS NULL OR o_orderdate >= mx),
l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn,
             LAG(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev
      FROM k)
SELECT o_custkey AS currency,
       CASE WHEN rn = 1 THEN 'INSERT' ELSE 'UPDATE' END AS change_type,
       CAST(CASE WHEN rn = 1 THEN NULL ELSE prev END AS DECIMAL(10, 4)) AS old_rate,
       CAST(o_totalprice AS DECIMAL(10, 4)) AS new_rate, o_orderdate AS change_time
FROM l
"""

# Materialising the latest-row changelog gives the latest row per key again.
ORACLE["changelog_materialized"] = ORACLE["latest_by_key"]

ORACLE["changelog_scd2"] = f"""
WITH a AS (
  SELECT *, MAX(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx
  FROM orders),
k AS (SELECT * EXCLUDE (mx) FROM a WHERE mx IS NULL OR o_orderdate >= mx)
SELECT {", ".join(_OCOLS)}, o_orderdate AS valid_from,
       LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to
FROM k
"""

def _quality_sql(amount_ok: str) -> str:
    return f"""
WITH q AS (
  SELECT e.event_id, CAST(e.user_id AS VARCHAR) AS userId,
         CASE WHEN {_K} % 17 = 0 THEN NULL WHEN {_K} % 19 = 0 THEN -e.value
              ELSE e.value * 30 END AS amount,
         CASE WHEN {_K} % 23 = 0 THEN NULL ELSE substr(n.n_name, 1, 1 + {_K} % 4) END AS country,
         CASE WHEN {_K} % 11 = 0 THEN NULL WHEN {_K} % 13 = 0 THEN ' ' || chr(9) || ' '
              ELSE e.event_type END AS merchant
  FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25),
c AS (
  SELECT *,
    COALESCE({amount_ok}, false) AS ok_a,
    COALESCE(userId IS NOT NULL AND length(userId) >= 3, false) AS ok_u,
    COALESCE(country IS NOT NULL AND length(country) BETWEEN 2 AND 3, false) AS ok_c,
    COALESCE(merchant IS NOT NULL AND regexp_matches(merchant, '[^\\x00-\\x20]'), false) AS ok_m
  FROM q)
SELECT event_id, userId, amount, country, merchant,
  0.0::DOUBLE + (CASE WHEN ok_a THEN 20.0::DOUBLE ELSE 0.0::DOUBLE END)
              + (CASE WHEN ok_u THEN 30.0::DOUBLE ELSE 0.0::DOUBLE END)
              + (CASE WHEN ok_c THEN 25.0::DOUBLE ELSE 0.0::DOUBLE END)
              + (CASE WHEN ok_m THEN 25.0::DOUBLE ELSE 0.0::DOUBLE END) AS quality_score,
  concat_ws(',', CASE WHEN NOT ok_a THEN 'INVALID_AMOUNT' END,
            CASE WHEN NOT ok_u THEN 'INVALID_USERID' END,
            CASE WHEN NOT ok_c THEN 'INVALID_COUNTRY' END,
            CASE WHEN NOT ok_m THEN 'INVALID_MERCHANT' END) AS quality_issues,
  (CASE WHEN ok_a THEN 20 ELSE 0 END + CASE WHEN ok_u THEN 30 ELSE 0 END
   + CASE WHEN ok_c THEN 25 ELSE 0 END + CASE WHEN ok_m THEN 25 ELSE 0 END) >= 80 AS is_valid
FROM c
"""


ORACLE["quality_score"] = _quality_sql("amount >= 0.0::DOUBLE AND amount <= 10000.0::DOUBLE")
ORACLE["quality_score_readme"] = _quality_sql("amount > 0.0::DOUBLE AND amount < 1000000.0::DOUBLE")


def _fmt(col: str) -> str:
    v = f"CAST({col} AS VARCHAR)"
    return (f"'{col}=' || CASE WHEN {col} IS NULL THEN 'null' WHEN length({v}) > 50 "
            f"THEN substr({v}, 1, 47) || '...' ELSE {v} END")


def _iso(col: str) -> str:
    frac = f"(microsecond({col}) % 1000000)"
    return (f"strftime({col}, '%Y-%m-%dT%H:%M') || "
            f"CASE WHEN second({col}) = 0 AND {frac} = 0 THEN '' "
            f"ELSE ':' || lpad(CAST(second({col}) AS VARCHAR), 2, '0') END || "
            f"CASE WHEN {frac} = 0 THEN '' WHEN {frac} % 1000 = 0 "
            f"THEN '.' || lpad(CAST({frac} // 1000 AS VARCHAR), 3, '0') "
            f"ELSE '.' || lpad(CAST({frac} AS VARCHAR), 6, '0') END")


def _info(col: str, name: str) -> str:
    return f"'{col}:' || CASE WHEN {col} IS NULL THEN 'NULL' ELSE '{name}' END"


def _sig(col: str) -> str:
    return f"'{col}:' || CASE WHEN {col} IS NULL THEN 'NULL' ELSE 'SET' END"


def _formatter_sql(src: str, key: str, order: str, cols: list[tuple[str, str, str]],
                   schema_info: str | None = None, alive: tuple | None = None) -> str:
    """cols: (name, runtime type name, text expression or ''); alive: count
    and window over the columns of ``src``, for patterns that expire"""
    def part(c, expr):
        if not expr:
            return _fmt(c)
        return (f"'{c}=' || CASE WHEN {c} IS NULL THEN 'null' WHEN length({expr}) > 50 "
                f"THEN substr({expr}, 1, 47) || '...' ELSE {expr} END")
    keyp = " || ', ' || ".join(part(c, x) for c, _, x in cols if c == key)
    rest = " || ', ' || ".join(part(c, x) for c, _, x in cols if c != key)
    info = f"'{schema_info}'" if schema_info else " || ', ' || ".join(_info(c, t) for c, t, _ in cols)
    sig = " || '|' || ".join(_sig(c) for c, _, _ in cols)
    if alive:
        return f"""
WITH s AS ({src})
SELECT {key}, '[' || {keyp} || '] => {{' || {rest} || '}}' AS formatted_row, {info} AS schema_info,
       CAST({alive[0]} AS BIGINT) AS distinct_patterns
FROM s WINDOW w AS {alive[1]}
"""
    return f"""
WITH s AS ({src}),
f AS (
  SELECT {key}, {order} AS ord, '[' || {keyp} || '] => {{' || {rest} || '}}' AS formatted_row,
         {info} AS schema_info, {sig} AS sig
  FROM s),
g AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key}, sig ORDER BY ord) AS srn FROM f)
SELECT {key}, formatted_row, schema_info,
       CAST(SUM(CASE WHEN srn = 1 THEN 1 ELSE 0 END)
            OVER (PARTITION BY {key} ORDER BY ord ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS distinct_patterns
FROM g
"""


ORACLE["row_formatter_nation"] = _formatter_sql(
    "SELECT * FROM nation", "n_regionkey", "n_nationkey",
    [("n_nationkey", "Integer", ""), ("n_name", "String", ""), ("n_regionkey", "Integer", "")])

_EVENTS_NULLED = f"""SELECT event_id, CASE WHEN {_K} % 13 = 0 THEN NULL ELSE user_id END AS user_id,
               event_type, CASE WHEN {_K} % 9 = 0 THEN NULL ELSE value END AS value,
               CASE WHEN {_K} % 5 = 0 THEN NULL ELSE ts END AS ts FROM events"""
_EVENTS_TEXT = [("event_id", "Long", ""), ("user_id", "Long", ""), ("event_type", "String", ""),
     ("value", "Double", ""), ("ts", "LocalDateTime", _iso("ts"))]
ORACLE["row_formatter_events"] = _formatter_sql(_EVENTS_NULLED, "event_type", "event_id", _EVENTS_TEXT)
ORACLE["row_formatter_sql_types"] = _formatter_sql(
    _EVENTS_NULLED, "event_type", "event_id", _EVENTS_TEXT,
    "event_id:BIGINT, user_id:BIGINT, event_type:STRING, value:DOUBLE, ts:TIMESTAMP(6)")

# the patterns of a key: which of user_id and value are null; each is alive
# while its last use lies at most the TTL back
_alive = " + ".join(
    f"CASE WHEN ts_ms - max(CASE WHEN p = {p} THEN ts_ms END) OVER w <= 6 * 3600000 THEN 1 ELSE 0 END" for p in range(4))
ORACLE["row_formatter_ttl"] = _formatter_sql(
    f"""SELECT *, CASE WHEN user_id IS NULL THEN 1 ELSE 0 END + CASE WHEN value IS NULL THEN 2 ELSE 0 END AS p,
               epoch_ms(ts) AS ts_ms
        FROM (SELECT event_id, CASE WHEN {_K} % 13 = 0 THEN NULL ELSE user_id END AS user_id, event_type,
                     CASE WHEN {_K} % 9 = 0 THEN NULL ELSE value END AS value, ts FROM events)""",
    "event_type", "event_id", [("event_id", "Long", ""), ("user_id", "Long", ""), ("event_type", "String", ""),
                               ("value", "Double", ""), ("ts", "LocalDateTime", _iso("ts"))],
    alive=(_alive, "(PARTITION BY event_type ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING)"))

_NESTED = f"""SELECT event_id, event_type,
    CASE WHEN {_K} % 7 = 0 THEN NULL ELSE '+I[' || CAST(user_id AS VARCHAR) || ', '
      || COALESCE(CASE WHEN {_K} % 9 <> 0 THEN CAST(value AS VARCHAR) END, 'null')
      || ', ' || {_iso("ts")} || ']' END AS detail,
    CASE WHEN {_K} % 11 = 0 THEN '[]' ELSE '[' || CAST({_K} AS VARCHAR) || ', null, '
      || CAST(user_id AS VARCHAR) || ']' END AS numbers,
    '{{' || 'k=[+I[' || CAST({_K} AS VARCHAR) || ']], u=[+I[' || CAST(user_id AS VARCHAR) || '], null]' || '}}' AS lookup
    FROM events"""
ORACLE["row_formatter_nested"] = _formatter_sql(
    _NESTED, "event_type", "event_id",
    [("event_id", "Long", ""), ("event_type", "String", ""), ("detail", "Row", ""), ("numbers", "Long[]", ""),
     ("lookup", "HashMap", "")])

ORACLE["cdc_transactions"] = """
WITH items AS (
  SELECT l_orderkey AS txn, l_linenumber + 1 AS total_order, (epoch_us(l_shipdate) // 1000) AS ts_ms,
         l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         l_extendedprice AS unit_price
  FROM lineitem),
agg AS (
  SELECT txn, COUNT(*) AS n,
         string_agg(CAST(product_id AS VARCHAR) || ':' || CAST(quantity AS VARCHAR) || ':'
                    || CAST(CAST(round(unit_price * 100) AS BIGINT) AS VARCHAR), ';'
                    ORDER BY total_order, ts_ms, product_id, quantity, unit_price) AS items_text
  FROM items GROUP BY txn)
SELECT CAST(o.o_orderkey AS VARCHAR) AS transaction_id, o.o_orderkey AS order_id,
       o.o_custkey AS customer_id, o.o_orderstatus AS status, o.o_totalprice AS total_amount,
       CAST(COALESCE(a.n, 0) AS INTEGER) AS n_items, COALESCE(a.items_text, '') AS items_text
FROM orders o LEFT JOIN agg a ON a.txn = o.o_orderkey
WHERE 1 + COALESCE(a.n, 0) = 1 + COALESCE(a.n, 0) + CASE WHEN o.o_orderkey % 10 = 0 THEN 1 ELSE 0 END
"""

ORACLE["cdc_changelog"] = f"""
WITH e AS (
  SELECT *, {_K} AS k,
         upper(CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'click' THEN 'MODIFY'
                               WHEN 'purchase' THEN 'REMOVE' ELSE event_type END) AS name
  FROM events),
j AS (
  SELECT *, 'user#' || CAST(user_id AS VARCHAR) AS pk,
    '{{"k":"' || CAST(k AS VARCHAR) || '","note":"'
      || COALESCE(CASE WHEN k % 4 = 0 THEN replace('say "hi"', '"', '\\"') END, 'null')
      || '","type":"' || event_type || '","value":"' || CAST(value AS VARCHAR) || '"}}' AS new_j,
    '{{"k":"' || CAST(k - 1 AS VARCHAR) || '"}}' AS old_j
  FROM e)
SELECT '+I' AS op, 0 AS change_seq, pk, 'profile' AS sk, new_j AS attributes_json,
       CAST(event_id AS VARCHAR) AS sequence_number, (epoch_us(ts) // 1000) AS event_time
FROM j WHERE name = 'INSERT'
UNION ALL
SELECT '-U', 0, pk, 'profile', old_j, CAST(event_id AS VARCHAR), (epoch_us(ts) // 1000)
FROM j WHERE name = 'MODIFY'
UNION ALL
SELECT '+U', 1, pk, 'profile', new_j, CAST(event_id AS VARCHAR), (epoch_us(ts) // 1000)
FROM j WHERE name = 'MODIFY'
UNION ALL
SELECT '-D', 0, pk, 'profile', CASE WHEN k % 3 <> 0 THEN old_j ELSE '{{}}' END,
       CAST(event_id AS VARCHAR), (epoch_us(ts) // 1000)
FROM j WHERE name = 'REMOVE'
"""

ORACLE["cdc_changelog_upsert"] = f"""
WITH e AS (SELECT *, {_K} AS k, CAST(event_id AS VARCHAR) AS sequence_number,
                  'user#' || CAST(user_id AS VARCHAR) AS pk FROM events),
j AS (SELECT *,
        '{{"k":"' || CAST(k AS VARCHAR) || '","note":'
          || CASE WHEN k % 4 = 0 THEN '"say \\"hi\\""' ELSE 'null' END
          || ',"type":"' || event_type || '","value":"' || CAST(value AS VARCHAR) || '"}}' AS new_j,
        '{{"k":"' || CAST(k - 1 AS VARCHAR) || '"}}' AS old_j FROM e)
SELECT CASE event_type WHEN 'signup' THEN '+I' WHEN 'click' THEN '+U' ELSE '-D' END AS op,
       CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS change_seq, pk, 'profile' AS sk,
       CASE WHEN event_type <> 'purchase' THEN new_j WHEN k % 3 <> 0 THEN old_j ELSE '{{}}' END
         AS attributes_json,
       sequence_number, date_trunc('milliseconds', ts) AS event_time
FROM j WHERE event_type IN ('signup', 'click', 'purchase')
"""

ORACLE["cdc_transactions_rows"] = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS transaction_id, o.o_orderkey AS order_id,
       o.o_custkey AS customer_id, o.o_orderstatus AS status, o.o_totalprice AS total_amount,
       l.l_linenumber + 1 AS line_no, l.l_partkey AS product_id,
       CAST(l.l_quantity AS INTEGER) AS quantity, l.l_extendedprice AS unit_price
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderkey % 10 <> 0
"""

ORACLE["events_by_type_view"] = \
    "SELECT event_type, COUNT(*) AS n, MAX(ts) AS last_ts FROM events GROUP BY event_type"

ORACLE["hybrid_window"] = """
WITH a AS (SELECT user_id, value, (epoch_us(ts) // 1000) AS t, event_id,
                  (epoch_us(ts) // 1000) - ((epoch_us(ts) // 1000) % 86400000) AS win FROM events),
b AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY user_id, win ORDER BY t, event_id) - 1) // 3
                AS bkt FROM a)
SELECT user_id, make_timestamp(win * 1000) AS window_start,
       make_timestamp((win + 86400000) * 1000) AS window_end,
       CAST(COUNT(*) AS INTEGER) AS num_orders, ROUND(SUM(COALESCE(value, 0)), 2) AS total_price
FROM b GROUP BY user_id, win, bkt
"""

def _early_fire_sql(order: str) -> str:
    return f"""
WITH a AS (SELECT user_id, value, (epoch_us(ts) // 1000) AS t, event_id, {_K} * 10000000 + event_id AS arrival,
                  (epoch_us(ts) // 1000) - ((epoch_us(ts) // 1000) % 86400000) AS win FROM events),
b AS (SELECT *, CASE WHEN LAG(win) OVER w IS NOT DISTINCT FROM win THEN 0 ELSE 1 END AS nw
      FROM a WINDOW w AS (PARTITION BY user_id ORDER BY {order})),
c AS (SELECT *, SUM(nw) OVER (PARTITION BY user_id ORDER BY {order}
                              ROWS UNBOUNDED PRECEDING) AS isl FROM b)
SELECT user_id, make_timestamp(win * 1000) AS window_start,
       make_timestamp((win + 86400000) * 1000) AS window_end,
       CAST(ROW_NUMBER() OVER s AS INTEGER) AS num_orders,
       ROUND(SUM(COALESCE(value, 0)) OVER (s ROWS UNBOUNDED PRECEDING), 2) AS total_price,
       event_id
FROM c WINDOW s AS (PARTITION BY user_id, isl ORDER BY {order})
"""


ORACLE["early_fire_window"] = _early_fire_sql("t, event_id")
ORACLE["early_fire_window_arrival"] = _early_fire_sql("arrival")
