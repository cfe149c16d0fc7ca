"""The same answers in plain SQL over the same tables."""

from __future__ import annotations

_MICROS = "'%Y-%m-%d %H:%M:%S.%f'"

# Events as transactions: position i of the event's document, with its place in
# the topic (h = ingest hour, p = topic partition, o = offset).
_TRANSACTIONS = """
tx AS (
  SELECT user_id * 2 + i // 2 AS TransactionId,
         CAST(CAST(value AS DECIMAL(10,2)) + i AS DECIMAL(10,2)) AS Amount,
         event_id AS CustomerId,
         ts + i * INTERVAL 1 HOUR AS TransactionDateTime,
         upper(event_type) AS Location,
         CASE WHEN event_id % 3 = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS Status,
         date_trunc('hour', ts) AS h, ts, event_id % 4 AS p, event_id // 4 AS o, i
  FROM (SELECT *, unnest(range(0, event_id % 4 + 1)) AS i FROM events)
)"""


def _latest(ingested: str, where: str = "true") -> str:
    """The newest row per id; bronze received a row at `ingested`."""
    return f"""{_TRANSACTIONS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY TransactionId
                               ORDER BY {ingested} DESC, ts DESC, p DESC, o DESC, i DESC) AS rn
  FROM tx WHERE {where}
),
latest AS (SELECT * FROM ranked WHERE rn = 1)"""


_LATEST = _latest("h")

_SILVER = f"""TransactionId, CAST(Amount AS VARCHAR) AS Amount, CustomerId,
  strftime(TransactionDateTime, {_MICROS}) AS TransactionDateTime,
  strftime(TransactionDateTime, '%Y-%m-%d') AS TransactionDate, Location, Status"""

_SNAPSHOT = f"WITH {_LATEST} SELECT {_SILVER}, CAST(p AS INTEGER) AS _batch_id FROM latest"
# With real bronze appends, one per topic partition, the append's time decides first.
_SNAPSHOT_BY_ARRIVAL = f"WITH {_latest('p')} SELECT {_SILVER}, CAST(p AS INTEGER) AS _batch_id FROM latest"

# Orders and events as silver rows; every other order shares its id with an event.
_SIDES = """
o AS (
  SELECT o_orderkey AS TransactionId, CAST(o_totalprice AS DECIMAL(10,2)) AS Amount, o_custkey AS CustomerId,
         date_trunc('month', o_orderdate) AS TransactionDateTime,
         upper(o_orderpriority) AS Location, upper(o_orderstatus) AS Status
  FROM orders
),
e AS (
  SELECT event_id * 2 AS TransactionId, CAST(value AS DECIMAL(10,2)) AS Amount, user_id AS CustomerId,
         ts AS TransactionDateTime, upper(event_type) AS Location, 'EVENT' AS Status
  FROM events
)"""
_EVENTS_WIN = "SELECT * FROM e UNION ALL SELECT * FROM o WHERE TransactionId NOT IN (SELECT TransactionId FROM e)"
_ORDERS_WIN = "SELECT * FROM o UNION ALL SELECT * FROM e WHERE TransactionId NOT IN (SELECT TransactionId FROM o)"

_EVENT_MESSAGES = """SELECT '/in/' || event_id || '.xml' AS key, CAST(event_id % 4 AS VARCHAR) AS partition,
               CAST(event_id // 4 AS VARCHAR) AS "offset\""""

_ORDER_REASON = """CASE o_orderkey % 13
    WHEN 0 THEN 'bad_xml' WHEN 2 THEN 'bad_base64' WHEN 3 THEN 'bad_envelope'
    WHEN 4 THEN 'bad_utf8' WHEN 5 THEN 'unread_transactions'
    WHEN 10 THEN 'unread_transactions' WHEN 11 THEN 'unread_transactions' WHEN 12 THEN 'unread_transactions' END"""

# Orders as transactions of large files; some opening tags belong to no transaction.
_RECORDS = """
        SELECT CAST(CASE WHEN i = 1 THEN -o_orderkey ELSE o_orderkey END AS BIGINT) AS "TransactionId",
               CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS "Amount", o_custkey AS "CustomerId",
               upper(o_orderpriority) AS "Location", CAST(0 AS BIGINT) AS n_tags
        FROM (SELECT *, unnest(range(0, CASE o_orderkey % 7 WHEN 1 THEN 2 WHEN 2 THEN 0 ELSE 1 END)) AS i FROM orders)
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, CAST(sum(CASE WHEN o_orderkey % 7 IN (2, 4) THEN 1 ELSE 0 END) AS BIGINT) FROM orders"""

ORACLE: dict[str, str] = {
    "envelope_roundtrip": """
        SELECT url AS path, octet_length(encode(html)) AS declared_bytes,
               octet_length(encode(html)) AS n_bytes, md5(html) AS md5
        FROM pages""",
    "topic_projection": """
        SELECT CAST(event_id AS VARCHAR) AS key, props AS value, event_type AS topic,
               CAST(user_id % 8 AS VARCHAR) AS partition, CAST(event_id AS VARCHAR) AS "offset",
               CAST(ts AS VARCHAR) AS "timestamp", '0' AS "timestampType"
        FROM events""",
    "stream_landing": """
        SELECT true AS key_is_path, octet_length(encode(html)) + 1 AS n_bytes, md5(html || chr(10)) AS md5 FROM pages""",
    "bronze_partitions": """
        SELECT strftime(ts, '%Y-%m-%d') AS _raw_insert_date, strftime(ts, '%H') AS _raw_insert_hour,
               count(*) AS n_rows
        FROM events GROUP BY 1, 2""",
    "stream_bronze": f"""
        SELECT '/in/' || event_id || '.xml' AS key, 'transactions' AS topic,
               CAST(event_id % 4 AS VARCHAR) AS partition, CAST(event_id // 4 AS VARCHAR) AS "offset",
               strftime(ts, {_MICROS}) AS "timestamp", true AS audit_consistent
        FROM events""",
    "bronze_failed_batch": """
        SELECT CAST(0 AS INTEGER) AS _batch_id,
               count(*) AS n_rows, count(*) AS n_payloads, count(*) AS n_explained
        FROM events""",
    "empty_batch": f"{_EVENT_MESSAGES} FROM events",
    "interval_trigger": f"{_EVENT_MESSAGES} FROM events",
    "default_trigger": f"{_EVENT_MESSAGES} FROM events",
    "restarted_stream": f"{_EVENT_MESSAGES}, CAST(2 AS INTEGER) AS attempts FROM events",
    "merged_bronze": f"""
        {_EVENT_MESSAGES}, CASE WHEN event_id % 4 > 1 THEN 'h' || event_id // 4 END AS headers,
               CASE WHEN event_id % 4 > 1 THEN '2024-03-02' ELSE '2024-03-01' END AS _raw_insert_date
        FROM events""",
    "bronze_dedup_offsets": f"""
        SELECT 'transactions' AS topic, CAST(event_id % 4 AS VARCHAR) AS partition,
               CAST(event_id // 4 AS VARCHAR) AS "offset", '/in/' || event_id || '.xml' AS key,
               strftime(date_trunc('hour', ts) + INTERVAL 1 DAY, {_MICROS}) AS _raw_insert_timestamp
        FROM events""",
    "document_classes": f"""
        WITH d AS (SELECT o_orderkey % 13 AS k, {_ORDER_REASON} AS reason FROM orders)
        SELECT CASE WHEN reason IS NOT NULL THEN 'malformed' WHEN k = 1 THEN 'empty' ELSE 'valid' END AS class,
               coalesce(reason, 'none') AS reason, count(*) AS n_documents
        FROM d GROUP BY 1, 2""",
    "malformed_rows": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS key, {_ORDER_REASON} AS _reason,
               CASE o_orderkey % 13
                 WHEN 2 THEN '{{"path":"p","content":"###' || o_orderkey || '"}}'
                 WHEN 4 THEN base64(encode(CAST(o_orderkey AS VARCHAR)) || '\\xFF'::BLOB)
                 WHEN 10 THEN '<Data><Transaction/></Data><Data><Transaction><TransactionId>' || o_orderkey
                              || '</TransactionId></Transaction></Data>'
                 WHEN 11 THEN repeat('<Data><transaction><TransactionId>' || o_orderkey
                                     || '</TransactionId></transaction></Data>', 2)
                 WHEN 12 THEN '<Data><g><transaction><TransactionId>' || o_orderkey
                              || '</TransactionId></transaction></g></Data>'
                 WHEN 0 THEN '<Data><Transaction><TransactionId>' || o_orderkey
                 WHEN 3 THEN 'no envelope ' || o_orderkey
                 WHEN 5 THEN '<Data/><Data><Transaction><TransactionId>' || o_orderkey
                             || '</TransactionId></Transaction></Data>' END AS corrupt_text
        FROM orders WHERE o_orderkey % 13 IN (0, 2, 3, 4, 5, 10, 11, 12)""",
    "batch_counts": """
        WITH d AS (SELECT o_orderkey % 13 AS k FROM orders)
        SELECT count(*) AS documents,
               count_if(k IN (0, 2, 3, 4, 5, 10, 11, 12)) AS malformed,
               count_if(k = 1) AS empty,
               count_if(k IN (6, 7, 8, 9, 11)) AS valid,
               count_if(k = 10) AS rejected
        FROM d""",
    "flatten_transactions": f"""
        WITH {_TRANSACTIONS}
        SELECT '/in/' || CustomerId || '.xml' AS key, i AS position, CAST(TransactionId AS VARCHAR) AS TransactionId,
               CAST(Amount AS VARCHAR) AS Amount, CAST(CustomerId AS VARCHAR) AS CustomerId,
               strftime(TransactionDateTime, '%Y-%m-%dT%H:%M:%S.%f') AS DateTime,
               upper(Location[1]) || lower(Location[2:]) AS Location,
               upper(Status[1]) || lower(Status[2:]) AS Result
        FROM tx""",
    "clean_amounts": """
        WITH p AS (SELECT o_orderkey, o_orderkey % 5 AS k, CAST(o_totalprice AS DECIMAL(10,2)) AS price FROM orders)
        SELECT o_orderkey,
               CASE k WHEN 3 THEN CAST(price + CAST(0.01 AS DECIMAL(10,2)) AS VARCHAR)
                      WHEN 4 THEN CAST(price AS VARCHAR) END AS amount,
               k IN (0, 1) AS invalid
        FROM p""",
    "clean_labels": f"""
        SELECT event_id, upper(event_type) AS location, upper(event_type) || ' / OK' AS status,
               strftime(ts, '%Y-%m-%d') AS "TransactionDate", strftime(ts, {_MICROS}) AS "TransactionDateTime"
        FROM events""",
    "reject_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(o_orderkey AS VARCHAR) AS "offset",
               CAST(0 AS BIGINT) AS position,
               CASE WHEN o_orderkey % 6 IN (2, 3) THEN 'null_key' ELSE 'bad_type' END AS _reason,
               CASE WHEN o_orderkey % 6 = 4 THEN '1.5' ELSE CAST(o_custkey AS VARCHAR) END AS raw_customer,
               CASE WHEN o_orderkey % 6 = 5 THEN 'not-a-date'
                    ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS raw_time
        FROM orders WHERE o_orderkey % 6 <> 0""",
    "clean_siblings": f"""
        WITH o AS (
          SELECT o_orderkey AS TransactionId, CAST(o_totalprice AS DECIMAL(10,2)) AS Amount, o_custkey AS CustomerId,
                 o_orderdate AS TransactionDateTime, upper(o_orderpriority) AS Location, upper(o_orderstatus) AS Status
          FROM orders
        )
        SELECT {_SILVER} FROM o""",
    "latest_per_key": f"WITH {_LATEST} SELECT {_SILVER} FROM latest",
    "latest_by_user": f"""
        WITH r AS (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
        )
        SELECT user_id, event_id, event_type, strftime(ts, {_MICROS}) AS ts FROM r WHERE rn = 1""",
    "merge_upsert": f"WITH {_SIDES}, m AS ({_EVENTS_WIN}) SELECT {_SILVER} FROM m",
    "merge_null_keys": f"""
        WITH {_SIDES},
        t AS (SELECT * REPLACE (CASE WHEN TransactionId % 6 <> 0 THEN TransactionId END AS TransactionId) FROM o),
        s AS (SELECT * REPLACE (CASE WHEN TransactionId % 6 <> 0 THEN TransactionId END AS TransactionId) FROM e),
        m AS (SELECT * FROM s UNION ALL
              SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.TransactionId = t.TransactionId))
        SELECT {_SILVER} FROM m""",
    "merge_order_guard": f"WITH {_SIDES}, m AS ({_EVENTS_WIN}) SELECT {_SILVER} FROM m",
    "merge_last_processed": f"WITH {_SIDES}, m AS ({_ORDERS_WIN}) SELECT {_SILVER} FROM m",
    "merge_partition_move": f"""
        WITH {_SIDES}, m AS ({_EVENTS_WIN})
        SELECT strftime(TransactionDateTime, '%Y-%m-%d') AS "TransactionDate", count(*) AS n_rows FROM m GROUP BY 1""",
    "fold_batches": _SNAPSHOT,
    "fold_onto_base": _SNAPSHOT,
    "fold_onto_buckets": _SNAPSHOT,
    "compacted_silver": _SNAPSHOT,
    "stream_silver": _SNAPSHOT_BY_ARRIVAL,
    "stream_failed_batch": f"""
        WITH {_latest("p", where="p <> 2")}
        SELECT 'silver' AS zone, p AS batch_id, count(*) AS n_rows FROM latest GROUP BY p
        UNION ALL
        SELECT 'failed' AS zone, CAST(2 AS BIGINT) AS batch_id, count(*) AS n_rows FROM events WHERE event_id % 4 = 2""",
    "dlq_replay": _SNAPSHOT_BY_ARRIVAL,
    "end_to_end": f"""
        WITH s AS (
          SELECT s_suppkey, unnest(range(0, 3)) AS i, s_acctbal, s_name FROM supplier
        ),
        tx AS (
          SELECT s_suppkey * 2 + i // 2 AS TransactionId,
                 CAST(CAST(s_acctbal AS DECIMAL(10,2)) + i AS DECIMAL(10,2)) AS Amount, s_suppkey AS CustomerId,
                 TIMESTAMP '2024-01-31 04:08:41' AS TransactionDateTime, upper(s_name) AS Location, 'SUCCESS' AS Status
          FROM s WHERE i <> 0
        )
        SELECT {_SILVER} FROM tx""",
    "latest20_bronze": f"""
        SELECT '/in/' || event_id || '.xml' AS key, CAST(event_id % 4 AS VARCHAR) AS partition,
               CAST(event_id // 4 AS VARCHAR) AS "offset",
               strftime(date_trunc('hour', ts), {_MICROS}) AS _raw_insert_timestamp
        FROM events ORDER BY date_trunc('hour', ts) DESC, event_id % 4 DESC, event_id // 4 DESC LIMIT 20""",
    "latest20_silver": f"""
        WITH {_LATEST}
        SELECT {_SILVER}, CAST(p AS INTEGER) AS _batch_id,
               CAST(epoch(TIMESTAMP '2024-03-01 12:00:00') + p * 86400 AS BIGINT) AS processed_at
        FROM latest ORDER BY p DESC, TransactionId DESC LIMIT 20""",
    "schema_inference": """
        SELECT * FROM (VALUES
          ('Transaction[].Amount', 'double'), ('Transaction[].CustomerId', 'bigint'),
          ('Transaction[].DateTime', 'timestamp'), ('Transaction[].Location', 'string'),
          ('Transaction[].Result', 'string'), ('Transaction[].TransactionId', 'string')) AS t(field, type)""",
    "literal_schema": """
        SELECT o_orderkey, o_orderkey * 2 + i AS id, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS amount,
               o_custkey AS customer, o_orderpriority AS place, 'timestamp' AS time_type
        FROM (SELECT *, unnest(range(0, 2)) AS i FROM orders)""",
    "generate_documents": """
        SELECT o_orderkey, true AS size_ok, true AS ids_ok, true AS customers_ok, true AS amounts_ok,
               true AS locations_ok, true AS results_ok, true AS times_ok
        FROM orders""",
    "large_document_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) AS "TransactionId",
               CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS "Amount",
               CAST(o_custkey AS VARCHAR) AS "CustomerId",
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "DateTime",
               o_orderpriority AS "Location", o_orderstatus AS "Result", false AS corrupt
        FROM orders""",
    "stream_repeated_messages": f"""
        WITH d AS (SELECT o_orderkey % 13 AS k, {_ORDER_REASON} AS reason FROM orders)
        SELECT 'malformed' AS zone, reason, count(*) AS n_rows FROM d WHERE reason IS NOT NULL GROUP BY reason
        UNION ALL SELECT 'rejected', 'null_key', count(*) FROM d WHERE k = 10
        UNION ALL SELECT 'silver', 'none', count(*) FROM d WHERE k IN (6, 7, 8, 9, 11)
        UNION ALL SELECT 'counted', 'none', count(*) FROM d""",
    "stream_isolated_poison": f"""
        WITH {_latest("p", where="CustomerId % 20000 <> 3")}
        SELECT 'silver' AS zone, p AS batch_id, '' AS key, count(*) AS n_rows FROM latest GROUP BY p
        UNION ALL
        SELECT 'failed', event_id % 4, '/in/' || event_id || '.xml', 1 FROM events WHERE event_id % 20000 = 3""",
    "latest20_partitions": f"""
        SELECT '/in/' || event_id || '.xml' AS key, CAST(event_id % 4 AS VARCHAR) AS partition,
               CAST(event_id // 4 AS VARCHAR) AS "offset",
               strftime(date_trunc('day', ts), {_MICROS}) AS _raw_insert_timestamp
        FROM events ORDER BY date_trunc('day', ts) DESC, event_id % 4 DESC, event_id // 4 DESC LIMIT 20""",
    "split_documents": _RECORDS,
    "stream_split_documents": _RECORDS,
    "batch_outcomes": """
        SELECT CAST(1 AS INTEGER) AS run, 'failed' AS event, CAST(NULL AS BIGINT) AS batch_id,
               CAST(NULL AS BOOLEAN) AS read, CAST(NULL AS BOOLEAN) AS timed, true AS explained, true AS settled
        UNION ALL
        SELECT 2, 'batch', 0, true, true, NULL, true
        UNION ALL
        SELECT 2, 'ended', NULL, NULL, NULL, NULL, true""",
}
