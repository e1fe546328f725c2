"""SQL over the given tables that must give the rows of the query of the same name."""

from __future__ import annotations

from runledger.plans.inputs import NOW_MICROS
from runledger.plans.queries import CONVERSATION, PREFIX, RUN


def _time(micros: str) -> str:
    text = f"strftime(make_timestamp({micros}), '%Y-%m-%dT%H:%M:%S.%f')"
    return f"regexp_replace({text}, '\\.?0+$', '') || 'Z'"


RAW = f"""
raw AS (
  SELECT event_id, event_id + 1 AS id, ts, user_id, event_type, value, props,
    CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN '' ELSE 'run-' || user_id END AS agentic_run_id,
    CASE WHEN event_type IN ('view', 'click') THEN 'planning'
         WHEN event_type IN ('purchase', 'signup') THEN 'execution' ELSE '' END AS phase,
    CASE WHEN event_id % 5 <> 0 THEN epoch_us(ts)
         WHEN event_id % 55 <> 0 THEN epoch_us(ts) + 1000000
         ELSE {NOW_MICROS} END AS ts_us,
    event_type AS event,
    CAST(json(props) AS VARCHAR) AS body,
    CASE user_id % 3 WHEN 0 THEN 'audit-service' WHEN 1 THEN 'other' END AS service
  FROM events)"""

LOGS = f"WITH {RAW}, logs AS (SELECT * FROM raw WHERE agentic_run_id <> '')"

TURNS = f"""
turns AS (
  SELECT 'conv-' || conv_id AS agentic_run_id, role AS phase, 'chat.turn' AS event, text,
    row_number() OVER (ORDER BY conv_id, turn) AS id,
    {NOW_MICROS} + turn * 1500000 AS ts_us
  FROM conversations)"""

RECORD = (
    "'{\"id\":' || id || ',\"phase\":\"' || phase || '\",\"timestamp\":\"' || "
    f"{_time('ts_us')}"
    " || '\",\"event\":\"' || event || '\",\"body\":' || body || '}'"
)

ROW = "phase, ts_us, event, body"

RANKED = f"""{LOGS}, ranked AS (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY agentic_run_id) AS n
  FROM logs WINDOW w AS (PARTITION BY agentic_run_id ORDER BY id))"""

ROUTED = f"""WITH {RAW}, routed AS (
  SELECT *, CASE WHEN service = 'audit-service' THEN 0 WHEN event_type = 'error' THEN 1 END AS route FROM raw)"""

NOISY = f"""{LOGS}, listed AS (
  SELECT agentic_run_id FROM logs WHERE event = 'error' GROUP BY 1 HAVING count(*) > 12
  UNION ALL SELECT 'run-unknown')"""

DELETED = """
  SELECT count(logs.id) AS deleted, listed.agentic_run_id
  FROM listed LEFT JOIN logs ON logs.agentic_run_id = listed.agentic_run_id GROUP BY 2"""

PLACED = f"""WITH {RAW}, placed AS (
  SELECT *, event_id // 100 AS envelope,
    CASE service WHEN 'audit-service' THEN 0 WHEN 'other' THEN 1 ELSE 2 END AS place
  FROM raw)"""


def _page(condition: str, limit: int) -> str:
    return f"{LOGS} SELECT id, {ROW} FROM logs WHERE agentic_run_id = '{RUN}' AND {condition} ORDER BY id LIMIT {limit}"


def _histogram(source: str, value: str, total: str) -> str:
    bounds = [0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000]

    def double(bound):
        return f"CAST({'NULL' if bound is None else bound} AS DOUBLE)"

    pairs = zip([None, *bounds], [*bounds, None])
    rows = [f"({i}, {double(lo)}, {double(hi)})" for i, (lo, hi) in enumerate(pairs)]
    return f"""{source}, b(bucket, lo, le) AS (VALUES {', '.join(rows)})
    SELECT bucket, le, count(v) AS n, (SELECT count(*) FROM vals) AS count, (SELECT {total} FROM vals) AS sum
    FROM b LEFT JOIN (SELECT {value} AS v FROM vals) ON (lo IS NULL OR v > lo) AND (le IS NULL OR v <= le)
    GROUP BY 1, 2"""


_SOURCE_ROWS = "agentic_run_id, phase, ts_us, event, body"
_FULL = f"WITH {RAW} SELECT agentic_run_id, service, event_type AS scope_name, {ROW} FROM raw"

_DOUBLE = "CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END"
_ARRAY = "'[' || user_id || ',\"' || event_type || '\"]'"
_DEEP = f"""'{{"deep":[{{"n":"' || event_type || '"}},' || {_DOUBLE} || ']}}'"""
_NESTED = "'{\"click\":' || (event_type = 'click') || ',\"list\":[' || user_id || ']}'"


def _kinds(text: str) -> str:
    return (
        f"CASE event_id % 6 WHEN 0 THEN {text} WHEN 1 THEN CAST(value > 50 AS VARCHAR) "
        f"WHEN 2 THEN CAST(user_id AS VARCHAR) WHEN 3 THEN {_DOUBLE} WHEN 4 THEN {_ARRAY} ELSE {_NESTED} END"
    )


ORACLES: dict[str, str] = {
    "extract_rows": f"{LOGS} SELECT id, agentic_run_id, {ROW} FROM logs",
    "event_time": f"WITH {RAW} SELECT id, {_time('ts_us')} AS time FROM raw",
    "skipped_inserted": f"""WITH {RAW} SELECT count(*) AS records, count(*) FILTER (agentic_run_id <> '') AS inserted,
        count(*) FILTER (agentic_run_id = '') AS skipped FROM raw""",
    "any_value_decode": f"""SELECT event_id, {_kinds("CAST(to_json(event_type) AS VARCHAR)")} AS body,
        {_kinds("event_type")} AS text FROM events""",
    "any_value_deep": f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN {_DEEP} ELSE CAST(user_id AS VARCHAR) END AS body,
        CASE WHEN event_id % 2 = 0 THEN {_DEEP} ELSE CAST(user_id AS VARCHAR) END AS text FROM events""",
    "body_raw": f"""SELECT event_id, CASE WHEN value > 99 THEN '{{"raw":"NaN"}}' WHEN value < 1 THEN '{{"raw":"-Inf"}}' ELSE {_DOUBLE} END AS body,
        CASE WHEN value > 99 THEN 'NaN' WHEN value < 1 THEN '-Inf' ELSE {_DOUBLE} END AS text FROM events""",
    "body_json": "SELECT event_id, CAST(json(props) AS VARCHAR) AS body FROM events",
    "body_string_json": "SELECT conv_id, turn, CAST(to_json(text) AS VARCHAR) AS body FROM conversations",
    "document_body_text": "SELECT doc_id, CAST(to_json(text) AS VARCHAR) AS body, text FROM documents",
    "event_body_text": f"WITH {RAW} SELECT id, body AS text FROM raw",
    "body_text": f"WITH {TURNS} SELECT agentic_run_id, id, text FROM turns",
    "rfc3339": f"SELECT event_id, {_time('epoch_us(ts)')} AS time FROM events",
    "page_first": _page("id > 0", 10),
    "page_next": f"""{RANKED} SELECT id, {ROW} FROM ranked
        WHERE agentic_run_id = '{RUN}' AND rn BETWEEN 11 AND 20""",
    "page_phase": _page("phase = 'execution'", 5),
    "page_capped": _page("id > 0", 1000),
    "next_cursor": f"""{RANKED} SELECT '{RUN}' AS agentic_run_id, count(*) AS records, max(n) > 10 AS has_more,
        max(id) AS next_after FROM ranked WHERE agentic_run_id = '{RUN}' AND rn <= 10""",
    "pages_for_runs": f"{RANKED} SELECT agentic_run_id, id, n > 10 AS has_more, {ROW} FROM ranked WHERE rn <= 10",
    "pages_for_cursors": f"""{LOGS}, cursors AS (
          SELECT agentic_run_id AS run, min(id) AS after FROM logs WHERE phase = '' GROUP BY 1),
        ranked AS (
          SELECT logs.*, row_number() OVER (PARTITION BY agentic_run_id ORDER BY id) AS rn,
            count(*) OVER (PARTITION BY agentic_run_id) AS n
          FROM logs JOIN cursors ON agentic_run_id = run WHERE id > after AND phase = 'planning')
        SELECT agentic_run_id, id, n > 5 AS has_more, {ROW} FROM ranked WHERE rn <= 5""",
    "page_bounds": f"""{RANKED} SELECT agentic_run_id, count(*) AS records, max(n) > 10 AS has_more,
        max(id) AS next_after FROM ranked WHERE rn <= 10 GROUP BY 1""",
    "page_walk": f"{RANKED} SELECT agentic_run_id, id, (rn - 1) // 10 AS page FROM ranked",
    "page_walk_sliced": f"{RANKED} SELECT agentic_run_id, id, (rn - 1) // 10 AS page FROM ranked",
    "count_run": f"{LOGS} SELECT count(*) AS n FROM logs WHERE agentic_run_id = '{RUN}'",
    "count_by_run": f"{LOGS} SELECT agentic_run_id, count(*) AS n FROM logs GROUP BY 1",
    "count_prefix": f"{LOGS} SELECT count(*) AS n FROM logs WHERE agentic_run_id LIKE '{PREFIX}%'",
    "assign_ids": "SELECT event_id, row_number() OVER (ORDER BY event_type, ts, event_id) AS id FROM events",
    "assign_order_ids": """SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id
        FROM orders""",
    "batch_counts": "SELECT event_id // 100 AS batch, count(*) AS records FROM events GROUP BY 1",
    "batch_slots": f"""WITH {RAW} SELECT ts_us // 1000000 * 1000000 AS slot_us, count(*) AS records
        FROM raw GROUP BY 1""",
    "batch_histogram": _histogram(
        f"WITH {RAW}, vals AS (SELECT count(*) AS v0 FROM raw GROUP BY ts_us // 3600000000)", "v0", "CAST(sum(v0) AS DOUBLE)"
    ),
    "value_histogram": _histogram("WITH vals AS (SELECT value AS v0 FROM events)", "v0", "round(sum(v0), 2)"),
    "route_counts": f"""{ROUTED}
        SELECT 'store' AS pipeline, count(*) AS records FROM routed WHERE route IS NOT NULL
        UNION ALL SELECT 'alerts', count(*) FROM routed WHERE route = 1
        UNION ALL SELECT 'unmatched', count(*) FROM routed WHERE route IS NULL""",
    "route_matched": f"{ROUTED} SELECT event_id FROM routed WHERE route IS NOT NULL",
    "route_default": f"{ROUTED} SELECT event_id FROM routed WHERE route IS NULL",
    "route_none": "SELECT event_id FROM events",
    "fan_out": f"""{ROUTED}
        SELECT 'store' AS pipeline, id FROM routed WHERE route IS NOT NULL AND agentic_run_id <> ''
        UNION ALL SELECT 'alerts', id FROM routed WHERE route = 1""",
    "fan_in": f"""{LOGS}, {TURNS} SELECT agentic_run_id, phase, event FROM logs
        UNION ALL SELECT agentic_run_id, phase, event FROM turns""",
    "otlp_roundtrip": _FULL,
    "otlp_order": f"""{PLACED} SELECT envelope,
          CAST(dense_rank() OVER (PARTITION BY envelope ORDER BY place) - 1 AS INTEGER) AS ri,
          CAST(dense_rank() OVER (PARTITION BY envelope, place ORDER BY event_type) - 1 AS INTEGER) AS si,
          CAST(row_number() OVER (PARTITION BY envelope, place, event_type ORDER BY event_id) - 1 AS INTEGER) AS li,
          CASE WHEN event_id % 55 = 0 THEN 0 ELSE (epoch_us(ts) + 1000000) * 1000 END AS observed
        FROM placed""",
    "otlp_hot_envelope": f"WITH {RAW} SELECT service, count(*) AS records, true AS bounded FROM raw GROUP BY 1",
    "otlp_files": _FULL,
    "envelope_routing": f"""{PLACED} SELECT CASE WHEN place = 0 THEN 'store' ELSE 'unmatched' END AS pipeline,
        envelope, count(*) AS records FROM placed GROUP BY 1, 2""",
    "records_json": f"{LOGS} SELECT {RECORD} AS value FROM logs",
    "json_page": f"""{LOGS}, page AS (
          SELECT *, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS n FROM logs
          WHERE agentic_run_id = '{RUN}' AND phase = 'planning')
        SELECT '{{"agentic_run_id":"{RUN}","phase":"planning","records":[' || string_agg({RECORD}, ',' ORDER BY id)
          || '],"has_more":' || (max(n) > 5) || '}}' AS value FROM page WHERE rn <= 5""",
    "text_page": f"""WITH {TURNS}, page AS (
          SELECT *, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS n FROM turns
          WHERE agentic_run_id = '{CONVERSATION}')
        SELECT CAST(1 AS INTEGER) AS line_no, 'agentic_run_id: {CONVERSATION}' AS line
        UNION ALL SELECT 2, 'records: ' || count(*) FROM page WHERE rn <= 2
        UNION ALL SELECT 3, 'has_more: ' || (count(*) > 2) FROM page
        UNION ALL SELECT 4, ''
        UNION ALL SELECT CAST(4 + rn AS INTEGER), {_time('ts_us')} || ': ' || text FROM page WHERE rn <= 2""",
    "json_pages": f"""{RANKED} SELECT agentic_run_id, '{{"agentic_run_id":"' || agentic_run_id || '","records":['
          || string_agg({RECORD}, ',' ORDER BY id) || '],"has_more":' || (max(n) > 10) || '}}' AS value
        FROM ranked WHERE rn <= 10 GROUP BY 1""",
    "text_pages": f"""WITH {TURNS}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY agentic_run_id ORDER BY id) AS rn,
            count(*) OVER (PARTITION BY agentic_run_id) AS n FROM turns)
        SELECT agentic_run_id, CAST(1 AS INTEGER) AS line_no, 'agentic_run_id: ' || agentic_run_id AS line
        FROM ranked WHERE rn = 1
        UNION ALL SELECT agentic_run_id, 2, 'records: ' || least(n, 3) FROM ranked WHERE rn = 1
        UNION ALL SELECT agentic_run_id, 3, 'has_more: ' || (n > 3) FROM ranked WHERE rn = 1
        UNION ALL SELECT agentic_run_id, 4, '' FROM ranked WHERE rn = 1
        UNION ALL SELECT agentic_run_id, CAST(4 + rn AS INTEGER), {_time('ts_us')} || ': ' || text
        FROM ranked WHERE rn <= 3""",
    "purge_survivors": f"""{NOISY} SELECT agentic_run_id, id FROM logs
        WHERE agentic_run_id NOT IN (SELECT agentic_run_id FROM listed)""",
    "purge_counts": f"{NOISY} {DELETED}",
    "delete_result": f"""{NOISY}, deleted AS ({DELETED})
        SELECT '{{"deleted":' || deleted || ',"agentic_run_id":"' || agentic_run_id || '"}}' AS value FROM deleted""",
    "delete_run": f"""{LOGS} SELECT agentic_run_id, id,
        (SELECT count(*) FROM logs WHERE agentic_run_id = '{RUN}') AS deleted
        FROM logs WHERE agentic_run_id <> '{RUN}'""",
    "purge_table": f"""{NOISY}, deleted AS ({DELETED})
        SELECT agentic_run_id, id, CAST(NULL AS BIGINT) AS deleted FROM logs
        WHERE agentic_run_id NOT IN (SELECT agentic_run_id FROM listed)
        UNION ALL SELECT agentic_run_id, CAST(NULL AS BIGINT), deleted FROM deleted""",
    "run_directory": f"""{NOISY}, left_over AS (
          SELECT * FROM logs WHERE agentic_run_id NOT IN (SELECT agentic_run_id FROM listed) AND agentic_run_id <> '{RUN}')
        SELECT agentic_run_id, count(*) AS n FROM left_over GROUP BY 1
        UNION ALL SELECT '{PREFIX}*', count(*) FROM left_over WHERE agentic_run_id LIKE '{PREFIX}%'""",
    "compacted_table": f"{LOGS} SELECT agentic_run_id, id, id % 5 AS batch_id, {ROW}, true AS fewer_files FROM logs",
    "replayed_batch": f"{LOGS} SELECT agentic_run_id, id, CAST(7 AS BIGINT) AS batch_id, {ROW} FROM logs",
    "empty_batch": f"{LOGS} SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n, 8 AS buckets FROM logs",
    "after_id": f"{LOGS} SELECT id, phase, event FROM logs WHERE agentic_run_id = '{RUN}' AND id > 500",
    "stream_ingest": f"{LOGS} SELECT {_SOURCE_ROWS} FROM logs",
    "jdbc_columns": f"{LOGS} SELECT {_SOURCE_ROWS} FROM logs",
    "stream_ids": f"""{LOGS} SELECT count(*) AS records, count(DISTINCT id) AS ids, true AS dense, true AS in_range
        FROM logs""",
    "stream_replay": f"{LOGS} SELECT {_SOURCE_ROWS} FROM logs",
    "stream_resent": f"""{LOGS} SELECT {_SOURCE_ROWS} FROM (
        SELECT DISTINCT {_SOURCE_ROWS}, service, ts, event_id % 5 = 0, event_id % 55 = 0 FROM logs)""",
    "stream_restart": f"""{LOGS}, {TURNS} SELECT {_SOURCE_ROWS} FROM logs
        UNION ALL SELECT agentic_run_id, phase, ts_us, event, CAST(to_json(text) AS VARCHAR) AS body FROM turns""",
    "stream_page_walk": f"""{RANKED} SELECT agentic_run_id, (rn - 1) // 10 AS page, count(*) AS records, count(DISTINCT id) AS ids
        FROM ranked GROUP BY 1, 2""",
    "stream_route": f"""WITH {RAW} SELECT 'store' AS pipeline, agentic_run_id, phase, event FROM raw
          WHERE service = 'audit-service' AND agentic_run_id <> ''
        UNION ALL SELECT 'unmatched', agentic_run_id, phase, event FROM raw
          WHERE service IS DISTINCT FROM 'audit-service'""",
    "stream_counters": f"""WITH {RAW} SELECT count(*) AS records, count(*) FILTER (agentic_run_id <> '') AS inserted,
        count(*) FILTER (agentic_run_id = '') AS skipped,
        0 AS rejected FROM raw""",
    "insert_duration": "SELECT bucket, le, true AS a_time_each, true AS took_time FROM ("
    + _histogram("WITH vals AS (SELECT event_id AS v0 FROM events)", "v0", "sum(v0)") + ")",
    "rejected_lines": f"""WITH {RAW}, placed AS (SELECT *, event_id // 100 AS envelope, event_id // 100 % 7 IN (3, 5) AS bad FROM raw)
        SELECT unnest(['records', 'skipped', 'stored', 'rejected', 'kept apart']) AS what,
          unnest([count(*) FILTER (NOT bad), count(*) FILTER (NOT bad AND agentic_run_id = ''),
            count(*) FILTER (NOT bad AND agentic_run_id <> ''), count(DISTINCT envelope) FILTER (bad),
            count(DISTINCT envelope) FILTER (bad)]) AS n FROM placed""",
    "trace_forward": f"WITH {RAW} SELECT service, hex(event_id) AS span_id, event_type AS name FROM raw",
    "signal_traces": f"""{LOGS} SELECT 'records' AS what, count(*) AS n FROM logs
        UNION ALL SELECT 'spans', count(*) FROM events""",
    "signal_split": f"{LOGS} SELECT agentic_run_id, count(*) AS n FROM logs GROUP BY 1",
}
