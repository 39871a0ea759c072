"""The same results in plain SQL, written the row-by-row way: running sums
over all copies where the engine folds them, a fold over each user's events in
turn where the engine settles all of them at once. The engine's results are checked against these."""

from __future__ import annotations

from stampcard.plans.workload import LEDGER_CUT, NOW

_INPUTS = f"""
base AS (
  SELECT 'E' || event_id AS event_id, event_id AS n, user_id,
         CAST(ts AS DATE) AS checkin_date, ts AS event_timestamp,
         strftime(ts, '%Y-%m') AS year_month, event_type,
         event_id * 10 AS arrival_seq
  FROM events),
checkins AS (
  SELECT event_id, n, user_id, checkin_date, event_timestamp, year_month, arrival_seq
  FROM base
  UNION ALL
  SELECT event_id, n, user_id, checkin_date, event_timestamp, year_month, arrival_seq + 1005
  FROM base WHERE event_type = 'purchase'
  UNION ALL
  SELECT event_id, n, user_id, checkin_date + 30, event_timestamp, year_month, arrival_seq + 3007
  FROM base WHERE event_type = 'click'
  UNION ALL
  SELECT event_id, n, user_id + 1, checkin_date, event_timestamp, year_month, arrival_seq + 2003
  FROM base WHERE event_type = 'error'),
logged AS (SELECT * FROM base WHERE event_timestamp < TIMESTAMP '{LEDGER_CUT}'),
daily_ranked AS (
  SELECT user_id, checkin_date,
         row_number() OVER (PARTITION BY user_id, date_trunc('month', checkin_date)
                            ORDER BY checkin_date) AS checkin_order
  FROM (SELECT DISTINCT user_id, checkin_date FROM logged)),
daily AS (SELECT * FROM daily_ranked WHERE checkin_order <= 7),
counts AS (
  SELECT user_id, year(checkin_date) AS y, month(checkin_date) AS m, count(*) AS month_count
  FROM daily GROUP BY ALL),
looked_up AS (
  SELECT c.*, year(c.checkin_date) AS y, month(c.checkin_date) AS m,
         coalesce(k.month_count, 0) AS month_count,
         EXISTS (SELECT 1 FROM logged g WHERE g.event_id = c.event_id) AS in_ledger
  FROM checkins c LEFT JOIN counts k
    ON k.user_id = c.user_id AND k.y = year(c.checkin_date) AND k.m = month(c.checkin_date)),
prior_marks AS (
  SELECT *, coalesce(sum(CASE WHEN in_ledger OR month_count < 7 THEN 1 ELSE 0 END) OVER (
              PARTITION BY user_id, event_id ORDER BY arrival_seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS marks_before
  FROM looked_up),
snapshot AS (
  SELECT *, CASE WHEN marks_before > 0 THEN 'DUP_STATE'
                 WHEN in_ledger THEN 'DUP_LEDGER'
                 WHEN month_count >= 7 THEN 'LIMIT'
                 ELSE 'ACCEPT' END AS status,
         CAST(month_count + 1 AS INTEGER) AS checkin_order
  FROM prior_marks),
turns AS (
  SELECT *, y * 100 + m AS ym, row_number() OVER (PARTITION BY user_id ORDER BY arrival_seq) AS turn
  FROM looked_up),
fold AS (
  SELECT user_id, CAST(0 AS BIGINT) AS turn, CAST([] AS VARCHAR[]) AS marked, CAST([] AS BIGINT[]) AS taken,
         CAST(NULL AS BIGINT) AS arrival_seq, CAST(NULL AS VARCHAR) AS status,
         CAST(NULL AS BIGINT) AS used
  FROM (SELECT DISTINCT user_id FROM looked_up)
  UNION ALL
  SELECT user_id, turn,
         CASE WHEN status IN ('ACCEPT', 'DUP_LEDGER') THEN list_append(marked, event_id) ELSE marked END,
         CASE WHEN status = 'ACCEPT' THEN list_append(taken, ym) ELSE taken END,
         arrival_seq, status, used
  FROM (
    SELECT *, CASE WHEN list_contains(marked, event_id) THEN 'DUP_STATE'
                   WHEN in_ledger THEN 'DUP_LEDGER'
                   WHEN used >= 7 THEN 'LIMIT'
                   ELSE 'ACCEPT' END AS status
    FROM (
      SELECT t.user_id, t.turn, t.event_id, t.ym, t.arrival_seq, t.in_ledger, f.marked, f.taken,
             t.month_count + len([x FOR x IN f.taken IF x = t.ym]) AS used
      FROM fold f JOIN turns t ON t.user_id = f.user_id AND t.turn = f.turn + 1))),
sequential AS (
  SELECT l.*, f.status, CAST(f.used + 1 AS INTEGER) AS checkin_order
  FROM looked_up l JOIN fold f ON f.user_id = l.user_id AND f.arrival_seq = l.arrival_seq)
"""

_DATE = "strftime({0}, '%Y-%m-%d')"
_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
_POINTS = """CAST(CASE {0} WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 5
  WHEN 5 THEN 8 WHEN 6 THEN 13 ELSE 21 END AS INTEGER)"""
_NOW_TEXT = f"strftime(TIMESTAMP '{NOW}', '%Y-%m-%d %H:%M:%S.%f')"
_NOW_MILLIS = f"epoch_ms(TIMESTAMP '{NOW}')"


def _processed(table: str) -> str:
    return f"""
processed AS (
  SELECT event_id, user_id, checkin_date, event_timestamp, year_month,
         CASE WHEN status = 'ACCEPT' THEN {_POINTS.format("checkin_order")} ELSE 0 END
           AS points_earned,
         CASE WHEN status = 'ACCEPT' THEN checkin_order ELSE 0 END AS checkin_order,
         status IN ('DUP_STATE', 'DUP_LEDGER') AS duplicate,
         CASE WHEN status IN ('DUP_STATE', 'DUP_LEDGER') THEN 'Duplicate event'
              WHEN status = 'LIMIT' THEN 'Maximum 7 check-ins per month reached' END
           AS error_message,
         arrival_seq
  FROM {table})
"""


_APPLIED = """
users AS (SELECT c_custkey AS id FROM customer),
eligible AS (
  SELECT * FROM processed p
  WHERE NOT duplicate AND error_message IS NULL),
strange AS (
  SELECT arrival_seq FROM eligible p
  WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.id = p.user_id)
    AND NOT EXISTS (SELECT 1 FROM daily d
                    WHERE d.user_id = p.user_id AND d.checkin_date = p.checkin_date)),
guarded AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, checkin_date ORDER BY arrival_seq) > 1
            OR EXISTS (SELECT 1 FROM daily d WHERE d.user_id = e.user_id
                       AND d.checkin_date = e.checkin_date) AS same_day
  FROM eligible e),
applied AS (
  SELECT * FROM guarded WHERE NOT same_day
    AND arrival_seq NOT IN (SELECT arrival_seq FROM strange))
"""


def _sql(body: str, *more: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([_INPUTS.strip(), *[part.strip() for part in more]]) + "\n" + body


def _transactions(table: str, tx_id: str) -> str:
    return f"""
tx AS (
  SELECT {tx_id} AS transaction_id, event_id, user_id, checkin_date, year_month,
         {_POINTS.format("checkin_order")} AS points_earned, checkin_order,
         event_timestamp, n
  FROM {table} WHERE status = 'ACCEPT')
"""


_CLOCK_ID = (
    "user_id || '_' || year_month || '_' || checkin_order || '_' || " + _NOW_MILLIS
)
_EVENT_ID = "user_id || '_' || year_month || '_' || checkin_order || '_' || event_id"

_TX_COLUMNS = f"""
SELECT transaction_id, event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date,
       year_month, points_earned, checkin_order,
       {_TIME.format("event_timestamp")} AS event_timestamp, {_NOW_TEXT} AS processed_at,
       'app' AS metadata_source, '1' AS metadata_version, CAST(n AS VARCHAR) AS metadata_request_id,
       CAST(NULL AS VARCHAR) AS metadata_client_ip, CAST(NULL AS VARCHAR) AS metadata_user_agent
FROM tx"""

_PROCESSED_COLUMNS = f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date,
       {_TIME.format("event_timestamp")} AS event_timestamp, year_month, points_earned,
       checkin_order, duplicate, error_message, arrival_seq
FROM processed"""

_ISO = (
    "regexp_replace(strftime({0}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '')"
)
_JSON = f"""'{{"transactionId":"' || transaction_id || '","eventId":"' || event_id
  || '","userId":' || user_id || ',"checkinDate":"' || strftime(checkin_date, '%Y-%m-%d')
  || '","yearMonth":"' || year_month || '","pointsEarned":' || points_earned
  || ',"checkinOrder":' || checkin_order || ',"eventTimestamp":"'
  || {_ISO.format("event_timestamp")} || '","processedAt":"'
  || {_ISO.format(f"TIMESTAMP '{NOW}'")}
  || '","metadata":{{"source":"app","version":"1","requestId":"' || n
  || '","clientIp":null,"userAgent":null}}}}'"""

_ORDERS = """
orders_in AS (
  SELECT 'O' || o_orderkey AS event_id, o_custkey AS user_id,
         CAST(o_orderdate AS DATE) AS checkin_date, o_orderdate AS event_timestamp,
         strftime(o_orderdate, '%Y-%m') AS year_month, o_orderkey AS arrival_seq
  FROM orders),
orders_ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id, year(checkin_date), month(checkin_date)
                                    ORDER BY arrival_seq) AS INTEGER) AS k
  FROM orders_in)
"""

ORACLES: dict[str, str] = {
    "award_points_live": _sql(_TX_COLUMNS, _transactions("snapshot", _CLOCK_ID)),
    "award_points_sequential": _sql(_TX_COLUMNS, _transactions("sequential", _CLOCK_ID)),
    "audit_checkins": _sql(_PROCESSED_COLUMNS, _processed("snapshot")),
    "audit_checkins_sequential": _sql(_PROCESSED_COLUMNS, _processed("sequential")),
    "decode_checkins": _sql(f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date,
       {_TIME.format("event_timestamp")} AS event_timestamp, year_month,
       'app' AS metadata_source, '1' AS metadata_version, CAST(n AS VARCHAR) AS metadata_request_id,
       CAST(NULL AS VARCHAR) AS metadata_client_ip, CAST(NULL AS VARCHAR) AS metadata_user_agent,
       arrival_seq
FROM checkins"""),
    "decode_quarantine": """
SELECT event_id * 10 AS arrival_seq, outcome,
       CASE WHEN outcome = 'OK' THEN
         CASE WHEN event_type = 'click' AND value >= 60 THEN '' ELSE 'E' END || event_id END AS event_id,
       CASE WHEN outcome = 'OK' THEN user_id END AS user_id
FROM (
  SELECT *, CASE
    WHEN event_type = 'view' AND value < 40 THEN 'MALFORMED'
    WHEN event_type = 'view' AND value < 60 THEN 'NULL_RECORD'
    WHEN event_type = 'view' THEN 'OK'
    WHEN event_type = 'click' THEN 'OK'
    WHEN event_type = 'purchase' AND value < 60 THEN 'NULL_EVENT_ID'
    WHEN event_type = 'purchase' THEN 'NULL_USER_ID'
    WHEN event_type = 'signup' AND value < 60 THEN 'NULL_CHECKIN_DATE'
    WHEN event_type = 'signup' AND value < 75 THEN 'OK'
    ELSE 'MALFORMED' END AS outcome
  FROM events)""",
    "quota_month": _sql("""
SELECT arrival_seq, CAST(year(checkin_date) AS INTEGER) AS year,
       CAST(month(checkin_date) AS INTEGER) AS month, year_month
FROM checkins"""),
    "points_ladder": _sql(f"""
SELECT arrival_seq, CAST(day(checkin_date) AS INTEGER) AS checkin_order,
       {_POINTS.format("day(checkin_date)")} AS points_earned
FROM checkins"""),
    "transaction_ids": _sql(f"""
SELECT event_id, user_id, {_CLOCK_ID} AS transaction_id, 'reference' AS id_mode
FROM snapshot WHERE status = 'ACCEPT'
UNION ALL
SELECT event_id, user_id, {_EVENT_ID} AS transaction_id, 'deterministic' AS id_mode
FROM snapshot WHERE status = 'ACCEPT'"""),
    "checkin_order_snapshot": _sql(f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date, checkin_order, arrival_seq
FROM snapshot WHERE status = 'ACCEPT'"""),
    "checkin_order_sequential": _sql(f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date, checkin_order, arrival_seq
FROM sequential WHERE status = 'ACCEPT'"""),
    "many_month_sequential": f"WITH {_ORDERS.strip()}" + f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date,
       {_TIME.format("event_timestamp")} AS event_timestamp, year_month,
       CAST(CASE k WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END AS INTEGER) AS points_earned,
       CASE WHEN k <= 2 THEN k ELSE 0 END AS checkin_order, false AS duplicate,
       CASE WHEN k > 2 THEN 'Maximum 2 check-ins per month reached' END AS error_message,
       arrival_seq
FROM orders_ranked""",
    "monthly_quota": _sql("""
SELECT arrival_seq, user_id, month_count, month_count >= 7 AS over_quota FROM looked_up"""),
    "monthly_counts": _sql("""
SELECT user_id, CAST(year(checkin_date) AS INTEGER) AS year, CAST(month(checkin_date) AS INTEGER) AS month,
       count(DISTINCT checkin_date) AS month_count
FROM checkins GROUP BY ALL"""),
    "ledger_duplicates": _sql("SELECT arrival_seq, event_id, user_id, in_ledger FROM looked_up"),
    "new_events_anti_join": _sql(f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date,
       {_TIME.format("event_timestamp")} AS event_timestamp, year_month, arrival_seq
FROM looked_up WHERE NOT in_ledger"""),
    "dedup_first_arrival": _sql(f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date,
       {_TIME.format("event_timestamp")} AS event_timestamp, year_month,
       'app' AS metadata_source, '1' AS metadata_version, CAST(n AS VARCHAR) AS metadata_request_id,
       CAST(NULL AS VARCHAR) AS metadata_client_ip, CAST(NULL AS VARCHAR) AS metadata_user_agent,
       arrival_seq
FROM checkins c
WHERE NOT EXISTS (SELECT 1 FROM checkins e WHERE e.user_id = c.user_id
                  AND e.event_id = c.event_id AND e.arrival_seq < c.arrival_seq)"""),
    "decision_status": _sql("""
SELECT arrival_seq, event_id, user_id, status,
       CASE WHEN status = 'ACCEPT' THEN checkin_order END AS checkin_order
FROM snapshot"""),
    "decision_metrics": _sql("SELECT status, count(*) AS n FROM snapshot GROUP BY status"),
    "insert_ignore_events": _sql(f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date, arrival_seq
FROM looked_up
WHERE NOT in_ledger
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival_seq) = 1"""),
    "same_day_guard": _sql(f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date, arrival_seq, same_day
FROM guarded""", _processed("snapshot"), _APPLIED),
    "unknown_users": _sql("""
SELECT event_id, user_id, arrival_seq FROM checkins
WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""),
    "sink_routing": _sql("""
SELECT arrival_seq, event_id, user_id, duplicate, error_message,
       CASE WHEN duplicate OR error_message IS NOT NULL THEN 'LOG_ONLY' ELSE 'APPLY' END AS route
FROM processed""", _processed("snapshot")),
    "ledger_daily_rows": _sql(f"""
SELECT user_id, {_DATE.format("checkin_date")} AS checkin_date, points_earned, checkin_order,
       {_NOW_TEXT} AS created_at
FROM applied""", _processed("sequential"), _APPLIED),
    "points_history_rows": _sql(f"""
SELECT user_id, points_earned AS points, 'CHECKIN' AS transaction_type,
       'Daily check-in #' || checkin_order || ' (event-driven)' AS description,
       {_NOW_TEXT} AS created_at
FROM applied""", _processed("sequential"), _APPLIED),
    "ledger_event_log": _sql(f"""
SELECT event_id, user_id, {_DATE.format("checkin_date")} AS checkin_date,
       {_TIME.format("event_timestamp")} AS event_timestamp, year_month, points_earned,
       arrival_seq IN (SELECT arrival_seq FROM applied) AS processed,
       CASE WHEN arrival_seq IN (SELECT arrival_seq FROM applied) THEN {_NOW_TEXT} END
         AS processed_at,
       error_message, {_NOW_TEXT} AS created_at, {_NOW_TEXT} AS updated_at
FROM processed p
WHERE arrival_seq NOT IN (SELECT arrival_seq FROM strange)
  AND NOT EXISTS (SELECT 1 FROM logged g WHERE g.event_id = p.event_id)
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival_seq) = 1""",
        _processed("sequential"), _APPLIED),
    "user_balances": _sql(f"""
SELECT u.id, CAST(coalesce(sum(a.points_earned), 0) AS BIGINT) AS total_points,
       CASE WHEN count(a.user_id) > 0 THEN {_NOW_TEXT} END AS updated_at
FROM users u LEFT JOIN applied a ON a.user_id = u.id
GROUP BY u.id""", _processed("sequential"), _APPLIED),
    "encode_transactions": _sql(
        f"SELECT {_JSON} AS value FROM tx", _transactions("snapshot", _CLOCK_ID)
    ),
    "kafka_records": _sql(
        f"SELECT CAST(user_id AS VARCHAR) AS key, {_JSON} AS value FROM tx",
        _transactions("snapshot", _CLOCK_ID),
    ),
}

# The streams take the check-ins in three batches, four days apart: what the
# first batch marked has expired in the third one.
_BATCHES = """
batched AS (
  SELECT *, CASE WHEN arrival_seq < h THEN 0 WHEN arrival_seq < h + 1500 THEN 1 ELSE 2 END AS batch
  FROM looked_up, (SELECT max(event_id) * 10 // 2 AS h FROM events))
"""


def _clock(batch: str) -> str:
    return f"strftime(TIMESTAMP '{NOW}' + INTERVAL 4 DAY * {batch}, '%Y-%m-%d %H:%M:%S.%f')"


_REMEMBERED = """
marking AS (
  SELECT user_id, event_id, min(CASE WHEN {0} AND batch = 0 THEN arrival_seq END) AS a0,
         min(CASE WHEN {0} AND batch = 1 THEN arrival_seq END) AS a1,
         min(CASE WHEN {0} AND batch = 2 THEN arrival_seq END) AS a2
  FROM batched GROUP BY ALL),
ruled AS (
  SELECT b.*, CASE batch WHEN 0 THEN false WHEN 1 THEN a0 IS NOT NULL ELSE a1 IS NOT NULL AND a0 IS NULL END
              OR arrival_seq > coalesce(CASE batch WHEN 0 THEN a0 WHEN 1 THEN a1 ELSE a2 END, arrival_seq) AS in_state
  FROM batched b JOIN marking m ON m.user_id = b.user_id AND m.event_id = b.event_id)
"""

ORACLES["dedup_stream_available_now"] = _sql(
    "SELECT event_id, user_id, arrival_seq FROM ruled WHERE NOT in_state", _BATCHES, _REMEMBERED.format("true")
)
ORACLES["live_stream_available_now"] = _sql(
    _TX_COLUMNS.replace(_NOW_TEXT, _clock("batch")),
    _BATCHES,
    _REMEMBERED.format("(in_ledger OR month_count < 7)"),
    """
streamed AS (
  SELECT *, CASE WHEN in_state THEN 'DUP_STATE' WHEN in_ledger THEN 'DUP_LEDGER'
                 WHEN month_count >= 7 THEN 'LIMIT' ELSE 'ACCEPT' END AS status,
         CAST(month_count + 1 AS INTEGER) AS checkin_order
  FROM ruled)""",
    _transactions("streamed", _EVENT_ID).replace("event_timestamp, n\n", "event_timestamp, n, batch\n"),
)


def _ledger_batch(b: int) -> str:
    """One batch of the ledger stream: its events are folded in turn against the
    ledger as the batch before left it (``days_b``, ``log_b``)."""
    return f"""
seen_{b} AS (
  SELECT c.user_id, c.event_id, c.checkin_date, c.arrival_seq,
         year(c.checkin_date) * 100 + month(c.checkin_date) AS ym,
         row_number() OVER (PARTITION BY c.user_id ORDER BY c.arrival_seq) AS turn,
         (SELECT count(*) FROM days_{b} d WHERE d.user_id = c.user_id
            AND date_trunc('month', d.checkin_date) = date_trunc('month', c.checkin_date)) AS month_count,
         EXISTS (SELECT 1 FROM log_{b} g WHERE g.event_id = c.event_id) AS in_ledger
  FROM batched c WHERE c.batch = {b}),
fold_{b} AS (
  SELECT user_id, CAST(0 AS BIGINT) AS turn, CAST([] AS VARCHAR[]) AS marked, CAST([] AS BIGINT[]) AS taken,
         CAST(NULL AS BIGINT) AS arrival_seq, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS BIGINT) AS used
  FROM (SELECT DISTINCT user_id FROM seen_{b})
  UNION ALL
  SELECT user_id, turn,
         CASE WHEN status IN ('ACCEPT', 'DUP_LEDGER') THEN list_append(marked, event_id) ELSE marked END,
         CASE WHEN status = 'ACCEPT' THEN list_append(taken, ym) ELSE taken END, arrival_seq, status, used
  FROM (
    SELECT *, CASE WHEN list_contains(marked, event_id) THEN 'DUP_STATE' WHEN in_ledger THEN 'DUP_LEDGER'
                   WHEN used >= 7 THEN 'LIMIT' ELSE 'ACCEPT' END AS status
    FROM (
      SELECT t.*, f.marked, f.taken, t.month_count + len([x FOR x IN f.taken IF x = t.ym]) AS used
      FROM fold_{b} f JOIN seen_{b} t ON t.user_id = f.user_id AND t.turn = f.turn + 1))),
told_{b} AS (
  SELECT s.*, f.status, CAST(f.used + 1 AS INTEGER) AS checkin_order,
         f.status = 'ACCEPT' AND NOT EXISTS (SELECT 1 FROM customer u WHERE u.c_custkey = s.user_id)
         AND NOT EXISTS (SELECT 1 FROM days_{b} d WHERE d.user_id = s.user_id AND d.checkin_date = s.checkin_date) AS strange
  FROM seen_{b} s JOIN fold_{b} f ON f.user_id = s.user_id AND f.arrival_seq = s.arrival_seq),
added_{b} AS (
  SELECT user_id, checkin_date, checkin_order, {b} AS batch FROM told_{b} s
  WHERE status = 'ACCEPT' AND NOT strange
    AND NOT EXISTS (SELECT 1 FROM days_{b} d WHERE d.user_id = s.user_id AND d.checkin_date = s.checkin_date)
  QUALIFY row_number() OVER (PARTITION BY user_id, checkin_date ORDER BY arrival_seq) = 1),
days_{b + 1} AS (SELECT user_id, checkin_date FROM days_{b} UNION ALL SELECT user_id, checkin_date FROM added_{b}),
log_{b + 1} AS (SELECT event_id FROM log_{b} UNION SELECT event_id FROM told_{b} WHERE NOT strange)"""


ORACLES["ledger_stream_available_now"] = _sql(
    f"""
SELECT u.c_custkey AS id,
       CAST(coalesce(sum({_POINTS.format("a.checkin_order")}) FILTER (a.user_id IS NOT NULL), 0) AS BIGINT) AS total_points,
       CASE WHEN count(a.user_id) > 0 THEN {_clock("max(a.batch)")} END AS updated_at
FROM customer u LEFT JOIN (
  SELECT * FROM added_0 UNION ALL SELECT * FROM added_1 UNION ALL SELECT * FROM added_2) a ON a.user_id = u.c_custkey
GROUP BY u.c_custkey""",
    _BATCHES,
    "days_0 AS (SELECT user_id, checkin_date FROM daily)",
    "log_0 AS (SELECT event_id FROM logged)",
    *[_ledger_batch(b) for b in range(3)],
)
