"""The expected result of every query as DuckDB SQL over ``events``.

The statements share no logic with the jobs: they apply the fixture's rules to the table itself and never
look at JSON, so parsing, typing and storing are all under test.
"""

from __future__ import annotations

from sluicebox.catalog.fixtures import AS_OF, MALFORMED

_AS_OF = f"TIMESTAMP '{AS_OF}'"

# What each event's record says, before any quality decision.
_SOURCE = """
source AS (
  SELECT event_id, ts, event_type, value,
    substr('ABC', CAST(user_id % 3 + 1 AS INTEGER), 1) AS letter,
    CASE event_id % 4 WHEN 0 THEN 'ATM' WHEN 1 THEN 'POS' WHEN 2 THEN 'WEB' ELSE 'MOBILE' END AS event_channel,
    event_id % 25 = 6 AS malformed,
    CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 10 = 7 THEN 'N/A'
         WHEN event_id % 10 = 9 THEN '-' || CAST(value AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS amount_text,
    CASE WHEN event_id % 10 IN (3, 7) THEN NULL WHEN event_id % 10 = 9 THEN -value ELSE value END AS amount_value,
    CASE WHEN event_id % 50 = 8 THEN 'garbage' WHEN event_id % 2 = 0 THEN strftime(ts, '%d/%m/%y %H:%M')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time_text,
    CASE WHEN event_id % 50 = 8 THEN NULL WHEN event_id % 2 = 0 THEN date_trunc('minute', ts)
         ELSE date_trunc('second', ts) END AS time_value,
    CASE WHEN event_id % 30 <> 1 THEN '****' || CAST(user_id + 1000 AS VARCHAR) END AS card,
    CASE WHEN event_id % 15 <> 4 THEN 'B' || CAST(event_id % 20 AS VARCHAR) END AS branch,
    CASE WHEN event_id % 15 <> 4 THEN CASE WHEN event_type = 'error' THEN 'WARN' ELSE 'OK' END END AS device,
    CAST(event_id % 3 AS INTEGER) AS broker_partition
  FROM events
),
records AS (
  SELECT *, CASE WHEN event_id % 20 <> 5 THEN 'BANK_' || letter END AS event_bank,
    'bank_' || lower(letter) || '_' || lower(event_channel) || '_transactions' AS input_topic
  FROM source
)"""

# The same after parsing and judging.
_SCORED = f"""{_SOURCE},
parsed AS (
  SELECT event_id, ts,
    CASE WHEN NOT malformed THEN 'E' || CAST(event_id AS VARCHAR) END AS transaction_id,
    CASE WHEN malformed THEN {_AS_OF} ELSE coalesce(time_value, {_AS_OF}) END AS event_timestamp,
    CASE WHEN NOT malformed THEN event_bank END AS bank_id,
    CASE WHEN NOT malformed THEN event_channel END AS channel,
    CASE WHEN NOT malformed THEN amount_value END AS amount,
    CASE WHEN NOT malformed THEN time_text END AS raw_time,
    CASE WHEN NOT malformed THEN card END AS card_number,
    CASE WHEN NOT malformed THEN sha256(card) END AS masked_card,
    CASE WHEN NOT malformed THEN device END AS status,
    CASE WHEN NOT malformed THEN branch END AS location
  FROM records
),
scored AS (
  SELECT *, CASE WHEN transaction_id IS NULL OR amount IS NULL OR bank_id IS NULL THEN 'HARD_REJECT'
                 WHEN status IS NULL OR location IS NULL THEN 'WARNING_MISSING_CONTEXT' ELSE 'CLEAN' END AS quality_score
  FROM parsed
),
clean AS (SELECT * FROM scored WHERE quality_score = 'CLEAN'),
rejected AS (SELECT * FROM scored WHERE quality_score <> 'CLEAN'),
dated AS (SELECT * FROM clean WHERE event_timestamp <> {_AS_OF}),
instants AS (
  SELECT masked_card, event_timestamp, count(*) AS n, sum(amount) AS s FROM clean WHERE masked_card IS NOT NULL GROUP BY ALL
)"""

_CUSTOMER_EVENTS = """(
    SELECT c_custkey AS event_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS ts,
      c_nationkey AS user_id, c_mktsegment AS event_type, c_acctbal AS value
    FROM customer)"""

_FLAT = """
flat AS (
  SELECT event_id, ts, event_type, value,
    'bank_' || lower(substr('ABC', CAST(user_id % 3 + 1 AS INTEGER), 1)) AS bank_dir,
    CASE event_id % 4 WHEN 0 THEN 'atm' WHEN 1 THEN 'pos' WHEN 2 THEN 'web' ELSE 'mobile' END AS channel_dir,
    event_id % 20 AS i, event_id % 10 AS a, event_id % 12 AS t, event_id % 33 AS b, event_id % 35 AS c
  FROM {table} AS event_rows
),
checked AS (
  SELECT *, concat_ws(',',
      CASE WHEN i IN (5, 15) THEN 'missing_transaction_id' END,
      CASE WHEN a IN (3, 5) THEN 'missing_amount' END,
      CASE WHEN t IN (3, 4) THEN 'missing_timestamp' END,
      CASE WHEN b = 11 THEN 'missing_bank_id' END,
      CASE WHEN c = 12 THEN 'missing_channel' END,
      CASE WHEN a IN (5, 6, 7) OR (a = 9 AND value <> 0) OR (a IN (0, 1, 2, 4) AND value < 0) THEN 'invalid_amount' END,
      CASE WHEN t IN (1, 3, 8, 10) THEN 'invalid_timestamp' END) AS issues,
    CASE WHEN i NOT IN (5, 15) THEN 'E' || CAST(event_id AS VARCHAR) END AS transaction_id,
    CASE WHEN a IN (3, 5, 7) THEN NULL WHEN a = 9 THEN -abs(value) WHEN a = 8 THEN 1.0 ELSE value END AS amount,
    CASE WHEN t IN (3, 4) THEN NULL WHEN t = 8 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
         WHEN t = 10 THEN strftime(ts, '%d/%m/%y %H:%M') WHEN t = 6 THEN strftime(ts, '%Y%m%dT%H%M%S')
         WHEN t = 2 THEN strftime(ts, '%G-W%V-%u') WHEN t = 1 THEN '2024-02-30T10:00:00'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
    CASE WHEN b <> 11 THEN upper(bank_dir) END AS bank_id,
    CASE WHEN c <> 12 THEN upper(channel_dir) END AS channel
  FROM flat
)"""

_SILVER = f"transaction_id, event_timestamp, bank_id, channel, amount, masked_card, status, quality_score, {_AS_OF} AS processed_at"
_CHOSEN = "bank_id IN ('BANK_A', 'BANK_C')"

_MEMBERS = """concat_ws(',',
      CASE WHEN event_bank IS NOT NULL THEN '"bank_id":"' || event_bank || '"' END,
      '"channel":"' || event_channel || '"',
      '"raw_payload":{' || concat_ws(',',
        '"atmCode":"A' || CAST(event_id % 50 AS VARCHAR) || '"',
        CASE WHEN amount_text IS NOT NULL THEN '"trxAmt":"' || amount_text || '"' END,
        '"trxTime":"' || time_text || '"',
        CASE WHEN card IS NOT NULL THEN '"cardNumber":"' || card || '"' END,
        CASE WHEN event_id % 40 = 17 THEN '"extra_field":' || CAST(event_id % 100 AS VARCHAR) END) || '}',
      '"ingest_time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '"',
      '"source_event_id":"E' || CAST(event_id AS VARCHAR) || '"',
      CASE WHEN branch IS NOT NULL
           THEN '"extra_metadata":{"branch_id":"' || branch || '","device_status":"' || device || '"}' END)"""

_BRONZE = f"""
  SELECT CAST(NULL AS VARCHAR) AS key, CASE WHEN malformed THEN '{MALFORMED}' ELSE '{{' || {_MEMBERS} || '}}' END AS raw_payload,
    input_topic AS topic, broker_partition AS partition, event_id AS "offset", ts AS ingest_time
  FROM records"""


_PUBLISHED = f"""
      'E' || CAST(event_id AS VARCHAR) AS transaction_id, event_bank AS bank_id, event_channel AS channel,
      'A' || CAST(event_id % 50 AS VARCHAR) AS atm_code, amount_text AS trx_amt, time_text AS trx_time, card AS card_number,
      CASE WHEN event_id % 40 = 17 THEN CAST(event_id % 100 AS VARCHAR) END AS extra_field,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_ingest_time, branch AS branch_id, device AS status,
      strftime({_AS_OF}, '%Y-%m-%dT%H:%M:%S') AS published_at"""

_FLAT_TEXT = """'{' || concat_ws(', ',
      CASE WHEN i = 15 THEN '"transaction_id": null' WHEN i <> 5 THEN '"transaction_id": "E' || CAST(event_id AS VARCHAR) || '"' END,
      CASE a WHEN 3 THEN NULL WHEN 7 THEN '"amount": "N/A"' WHEN 9 THEN '"amount": ' || CAST(-abs(value) AS VARCHAR)
             WHEN 5 THEN '"amount": null' WHEN 8 THEN '"amount": true'
             WHEN 6 THEN '"amount": "' || CAST(value AS VARCHAR) || '"' ELSE '"amount": ' || CAST(value AS VARCHAR) END,
      CASE t WHEN 4 THEN NULL WHEN 3 THEN '"timestamp": null' WHEN 8 THEN '"timestamp": ' || "timestamp"
             ELSE '"timestamp": "' || "timestamp" || '"' END,
      CASE WHEN b <> 11 THEN '"bank_id": "' || upper(bank_dir) || '"' END,
      CASE WHEN c = 12 THEN '"channel": null' ELSE '"channel": "' || upper(channel_dir) || '"' END,
      '"note": "' || event_type || '"') || '}'"""

# The amounts of the extreme fixture, apart: counts of what is no number, and two sums whose order does not matter.
_EXTREME = """
        SELECT *, CASE WHEN event_id % 101 = 0 THEN 'nan' WHEN event_id % 103 = 0 THEN 'inf' WHEN event_id % 107 = 0 THEN '-inf' END AS odd,
          CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0 THEN NULL
               WHEN event_id % 13 = 1 THEN NULL WHEN event_id % 13 = 2 THEN 0.0000004 ELSE amount END AS fine,
          CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0 AND event_id % 107 <> 0 AND event_id % 13 = 1 THEN 1e22 END AS huge
        FROM clean"""


def _extreme_sum(over: str = "") -> str:
    """The kind of a sum and its value, over a group or a window."""
    odd = {k: f"count(CASE WHEN odd = '{k}' THEN 1 END) {over} > 0" for k in ("nan", "inf", "-inf")}
    return f"""
          CASE WHEN {odd['nan']} OR ({odd['inf']} AND {odd['-inf']}) THEN 'nan' WHEN {odd['inf']} THEN 'inf'
               WHEN {odd['-inf']} THEN '-inf' ELSE 'number' END AS kind,
          coalesce(CAST(sum(CAST(fine AS DECIMAL(28, 7))) {over} AS DOUBLE), 0) + coalesce(sum(huge) {over}, 0) AS total"""


def _source(body: str) -> str:
    return f"WITH {_SOURCE.strip()} {body}"


def _scored(body: str) -> str:
    return f"WITH {_SCORED.strip()} {body}"


def _flat(body: str, table: str = "events") -> str:
    return f"WITH {_FLAT.strip().format(table=table)} {body}"


def _incidents(threshold: str, minutes: int, quiet: int) -> str:
    width = f"INTERVAL {minutes} MINUTE"
    return f"""
        SELECT min(window_start) AS incident_start, max(window_start) + {width} AS incident_end, count(*) AS windows,
          sum(total)::BIGINT AS total, sum(rejected)::BIGINT AS rejected, max(rejected / total) AS peak_rate
        FROM (
          SELECT *, sum(CASE WHEN before >= window_start - {width} * {1 + quiet} THEN 0 ELSE 1 END) OVER (ORDER BY window_start) AS incident
          FROM (
            SELECT *, lag(window_start) OVER (ORDER BY window_start) AS before
            FROM (
              SELECT time_bucket({width}, event_timestamp) AS window_start, count(*) AS total,
                count(*) FILTER (WHERE quality_score <> 'CLEAN') AS rejected
              FROM scored GROUP BY 1
            ) AS windows WHERE rejected / total > {threshold}
          ) AS alerts
        ) AS numbered GROUP BY incident"""


ORACLE: dict[str, str] = {
    "topic_filter": _source("SELECT input_topic AS topic, count(*) AS n FROM records GROUP BY input_topic"),
    "bronze_ingest": _source(_BRONZE),
    "bronze_stream": _source(_BRONZE),
    "bronze_scan": _source(_BRONZE),
    "schema_parse": _source("""
        SELECT event_id,
          CASE WHEN NOT malformed THEN event_bank END AS bank_id,
          CASE WHEN NOT malformed THEN event_channel END AS channel,
          CASE WHEN NOT malformed THEN 'A' || CAST(event_id % 50 AS VARCHAR) END AS atm_code,
          CASE WHEN NOT malformed THEN amount_text END AS trx_amt,
          CASE WHEN NOT malformed THEN time_text END AS trx_time,
          CASE WHEN NOT malformed THEN card END AS card_number,
          CASE WHEN NOT malformed AND event_id % 40 = 17 THEN CAST(event_id % 100 AS VARCHAR) END AS extra_field,
          CASE WHEN NOT malformed THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS event_ingest_time,
          CASE WHEN NOT malformed THEN 'E' || CAST(event_id AS VARCHAR) END AS source_event_id,
          CASE WHEN NOT malformed THEN branch END AS branch_id,
          CASE WHEN NOT malformed THEN device END AS device_status
        FROM records"""),
    "flatten": _scored("""
        SELECT transaction_id, bank_id, channel, amount, raw_time, card_number, status, location, ts AS ingest_time
        FROM parsed"""),
    "amount_cast": _scored("SELECT transaction_id, amount FROM parsed"),
    "masked_card": _scored("SELECT transaction_id, masked_card FROM parsed"),
    "event_timestamp": _scored("SELECT transaction_id, event_timestamp FROM parsed"),
    "quality_score": _scored("SELECT transaction_id, amount, bank_id, status, location, quality_score FROM scored"),
    "quality_score_documented": _scored("""
        SELECT transaction_id, amount, status,
          CASE WHEN amount IS NULL THEN 'MISSING_AMOUNT' WHEN amount < 0 THEN 'INVALID_VALUE'
               WHEN status = 'WARN' THEN 'DEVICE_WARNING' ELSE 'CLEAN' END AS quality_score
        FROM parsed"""),
    "silver_full": _scored(f"SELECT {_SILVER} FROM scored"),
    "silver_clean": _scored(f"SELECT {_SILVER} FROM clean"),
    "garbage_rejected": _scored(f"SELECT {_SILVER} FROM rejected"),
    "route_counts": _scored("""
        SELECT CASE WHEN quality_score = 'CLEAN' THEN 'silver' ELSE 'garbage' END AS route, quality_score, count(*) AS n
        FROM scored GROUP BY quality_score"""),
    "clean_feed": _scored(f"""
        SELECT transaction_id AS key, {_SILVER}, CAST(8 + CASE WHEN masked_card IS NULL THEN 0 ELSE 1 END AS BIGINT) AS members
        FROM clean"""),
    "publish_frame": _source(f"SELECT input_topic AS topic, {_PUBLISHED} FROM records WHERE event_bank IS NOT NULL"),
    "publish_named_topic": _source(f"SELECT 'bank_a_atm_transactions' AS topic, {_PUBLISHED} FROM records"),
    "publish_unroutable": _source(f"SELECT {_PUBLISHED} FROM records WHERE event_bank IS NULL"),
    "silver_scan": _scored(f"SELECT {_SILVER} FROM clean"),
    "garbage_scan": _scored(f"SELECT {_SILVER} FROM rejected"),
    "silver_roundtrip": _scored(f"SELECT {_SILVER} FROM clean UNION ALL SELECT {_SILVER} FROM clean"),
    "garbage_roundtrip": _scored(f"SELECT {_SILVER} FROM rejected UNION ALL SELECT {_SILVER} FROM rejected"),
    "garbage_optional": _scored("""
        SELECT 'present' AS layer, count(*) AS n FROM rejected UNION ALL SELECT 'absent' AS layer, 0 AS n"""),
    "csv_roundtrip": _scored(f"SELECT {_SILVER} FROM clean"),
    "csv_bank_export": _scored(f"SELECT {_SILVER} FROM clean WHERE {_CHOSEN}"),
    "csv_hard_texts": _scored(f"""
        SELECT * REPLACE (' a "b", c' || chr(10) || status || ' ' AS status, processed_at + INTERVAL 123456 MICROSECOND AS processed_at)
        FROM (SELECT {_SILVER} FROM clean)"""),
    "silver_stream_restart": _scored(f"SELECT {_SILVER} FROM scored UNION ALL SELECT {_SILVER} FROM scored"),
    "silver_stream": _scored(f"""
        SELECT CASE WHEN quality_score = 'CLEAN' THEN 'silver' ELSE 'garbage' END AS layer, {_SILVER} FROM scored"""),
    "layers_compacted": _scored(f"""
        SELECT CASE WHEN quality_score = 'CLEAN' THEN 'silver' ELSE 'garbage' END AS layer, stage, {_SILVER}
        FROM scored CROSS JOIN (VALUES ('before'), ('compacted'), ('dropped'), ('continued'), ('continued')) AS stages(stage)"""),
    "fan_out_status": _scored("""
        SELECT 'silver' AS sink, true AS ok, count(*) AS rows FROM clean
        UNION ALL SELECT 'csv', true, count(*) FROM clean
        UNION ALL SELECT 'garbage', true, count(*) FROM rejected
        UNION ALL SELECT 'feed', false, 0"""),
    "report_figures": _scored(f"""
        SELECT count(*) AS total_bronze, count(*) FILTER (WHERE quality_score = 'CLEAN') AS total_silver,
          count(*) FILTER (WHERE quality_score <> 'CLEAN') AS total_garbage,
          count(DISTINCT CASE WHEN quality_score = 'CLEAN' THEN bank_id END) AS active_banks, max({_AS_OF}) AS last_processed,
          count(*) FILTER (WHERE quality_score = 'CLEAN') / count(*) * 100 AS health_rate,
          strftime(max({_AS_OF}), '%H:%M:%S') AS last_pulse
        FROM scored"""),
    "layer_counts": _scored("""
        SELECT 'bronze' AS layer, count(*) AS n FROM scored
        UNION ALL SELECT 'silver' AS layer, count(*) AS n FROM clean
        UNION ALL SELECT 'garbage' AS layer, count(*) AS n FROM rejected"""),
    "health_rate": _scored("""
        SELECT count(*) AS total_bronze, count(*) FILTER (WHERE quality_score = 'CLEAN') AS total_silver,
          count(*) FILTER (WHERE quality_score = 'CLEAN') / count(*) * 100 AS health_rate
        FROM scored"""),
    "bank_distribution": _scored('SELECT bank_id, count(*) AS "count" FROM clean GROUP BY bank_id'),
    "bank_share": _scored("""
        SELECT bank_id, count(*) AS "count", count(*) / sum(count(*)) OVER () AS share FROM clean GROUP BY bank_id"""),
    "freshness": _scored(f"""
        SELECT max({_AS_OF}) AS last_processed, strftime(max({_AS_OF}), '%H:%M:%S') AS last_pulse FROM clean"""),
    "distinct_banks": _scored("SELECT DISTINCT bank_id FROM clean"),
    "bank_filter": _scored(f"SELECT {_SILVER} FROM clean WHERE {_CHOSEN}"),
    "card_lookup": _scored(f"""
        SELECT {_SILVER} FROM clean WHERE masked_card IN (SELECT sha256('****' || n) FROM (VALUES ('1003'), ('1008'), ('1013'), ('99999')) AS asked(n))"""),
    "transaction_lookup": _scored(f"SELECT {_SILVER} FROM clean WHERE transaction_id IN ('E2', 'E40', 'E94', 'E412', 'E3', 'EX')"),
    "masking_sample": _scored(f"""
        SELECT transaction_id, bank_id, amount, masked_card, quality_score FROM clean WHERE {_CHOSEN}
        ORDER BY transaction_id LIMIT 10"""),
    "bronze_sample": _source(f"""SELECT * FROM ({_BRONZE}) AS bronze ORDER BY "offset" LIMIT 20"""),
    "silver_sample": _scored(f"SELECT {_SILVER} FROM clean WHERE {_CHOSEN} ORDER BY transaction_id LIMIT 30"),
    "flat_scan": _flat(
        "SELECT bank_dir, channel_dir, transaction_id, event_type AS note, issues FROM checked", _CUSTOMER_EVENTS
    ),
    "flat_stream": _flat("""
        SELECT bank_dir, channel_dir, transaction_id,
          array_to_string(list_sort(string_split(issues, ',')), ',') AS issues
        FROM checked""", _CUSTOMER_EVENTS),
    "flat_issues": _flat("SELECT event_id, issues FROM checked"),
    "flat_canonical": _flat('SELECT event_id, transaction_id, amount, "timestamp", bank_id, channel FROM checked'),
    "flat_counts": _flat("""
        SELECT bank_dir, channel_dir, count(*) AS n FROM flat GROUP BY bank_dir, channel_dir
        UNION ALL SELECT 'bank_d', 'atm', 0""", _CUSTOMER_EVENTS),
    "flat_trailing_text": _flat("""
        SELECT event_id, CASE WHEN event_id % 6 = 5 THEN issues ELSE 'invalid_json' END AS issues FROM checked"""),
    "flat_silver": _flat("""
        SELECT event_id, bank_dir, channel_dir, transaction_id, a = 8 AS is_bool, amount, "timestamp", bank_id, channel
        FROM checked WHERE issues = ''"""),
    "flat_rerun": _flat("""
        SELECT event_id, bank_dir, channel_dir, transaction_id, a = 8 AS is_bool, amount, "timestamp", bank_id, channel
        FROM checked WHERE issues = ''"""),
    "flat_garbage": _flat(f"""
        SELECT event_id, bank_dir, channel_dir, unnest(string_split(issues, ',')) AS issue, {_FLAT_TEXT} AS event_text
        FROM checked WHERE issues <> ''"""),
    "kpi_window": _scored("""
        SELECT date_trunc('day', event_timestamp) AS window_start,
          date_trunc('day', event_timestamp) + INTERVAL 1 DAY AS window_end, bank_id, channel, count(*) AS txn_count,
          CAST(sum(CAST(amount AS DECIMAL(18, 6))) AS DOUBLE) AS total_amount
        FROM clean GROUP BY ALL"""),
    "velocity": _scored("""
        SELECT masked_card, event_timestamp, txn_count, txn_count_span,
          CAST(amount_sum AS DOUBLE) / txn_count_span AS avg_amount_span
        FROM (
          SELECT DISTINCT masked_card, event_timestamp,
            count(*) OVER (PARTITION BY masked_card, event_timestamp) AS txn_count,
            count(*) OVER span AS txn_count_span,
            sum(CAST(amount AS DECIMAL(18, 6))) OVER span AS amount_sum
          FROM clean WHERE masked_card IS NOT NULL
          WINDOW span AS (PARTITION BY masked_card ORDER BY event_timestamp
                          RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
        ) AS windows"""),
    "kpi_window_extremes": _scored(f"""
        SELECT * EXCLUDE (total), CASE WHEN kind = 'number' THEN total END AS total_amount
        FROM (
          SELECT date_trunc('day', event_timestamp) AS window_start,
            date_trunc('day', event_timestamp) + INTERVAL 1 DAY AS window_end, bank_id, channel, count(*) AS txn_count,
            {_extreme_sum()}
          FROM ({_EXTREME}) GROUP BY 1, 2, 3, 4
        ) AS sums"""),
    "velocity_extremes": _scored(f"""
        SELECT masked_card, event_timestamp, txn_count, txn_count_span, kind,
          CASE WHEN kind = 'number' THEN total / txn_count_span END AS avg_amount_span
        FROM (
          SELECT DISTINCT masked_card, event_timestamp,
            count(*) OVER (PARTITION BY masked_card, event_timestamp) AS txn_count, count(*) OVER span AS txn_count_span,
            {_extreme_sum('OVER span')}
          FROM ({_EXTREME}) WHERE masked_card IS NOT NULL
          WINDOW span AS (PARTITION BY masked_card ORDER BY event_timestamp
                          RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
        ) AS windows"""),
    "garbage_alert": _scored("""
        SELECT date_trunc('hour', event_timestamp) AS window_start, count(*) AS total,
          count(*) FILTER (WHERE quality_score <> 'CLEAN') AS rejected,
          count(*) FILTER (WHERE quality_score <> 'CLEAN') / count(*) AS reject_rate
        FROM scored GROUP BY 1
        HAVING count(*) FILTER (WHERE quality_score <> 'CLEAN') / count(*) > 0.35"""),
    "garbage_incidents": _scored(_incidents("0.35", 60, 0)),
    "garbage_incidents_with_pauses": _scored(_incidents("0.3", 30, 2)),
    "card_sessions": _scored("""
        SELECT masked_card, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end, sum(n)::BIGINT AS txn_count,
          CAST(sum(amount) AS DOUBLE) AS total_amount
        FROM (
          SELECT *, sum(CASE WHEN before >= event_timestamp - INTERVAL 6 HOUR THEN 0 ELSE 1 END)
            OVER (PARTITION BY masked_card ORDER BY event_timestamp) AS session
          FROM (
            SELECT *, lag(event_timestamp) OVER (PARTITION BY masked_card ORDER BY event_timestamp) AS before
            FROM (
              SELECT masked_card, event_timestamp, count(*) AS n, sum(CAST(amount AS DECIMAL(18, 6))) AS amount
              FROM clean WHERE masked_card IS NOT NULL GROUP BY ALL
            ) AS instants
          ) AS ordered
        ) AS numbered GROUP BY masked_card, session"""),
    "decayed_averages": _scored("""
        SELECT masked_card, event_timestamp, txn_count, round(sum(n * share), 6) AS decayed_count,
          round(sum(s * share) / sum(n * share), 6) AS decayed_average
        FROM (
          SELECT a.masked_card, a.event_timestamp, a.n AS txn_count, b.n, b.s,
            pow(2.0, (epoch(b.event_timestamp) - epoch(a.event_timestamp)) / 21600.0) AS share
          FROM instants AS a JOIN instants AS b ON a.masked_card = b.masked_card AND b.event_timestamp <= a.event_timestamp
        ) AS shares GROUP BY masked_card, event_timestamp, txn_count"""),
    "kpi_sketches": _scored("""
        SELECT period, date_trunc(period, event_timestamp)::TIMESTAMP AS window_start, bank_id, count(*) AS txn_count,
          CAST(sum(CAST(amount AS DECIMAL(18, 6))) AS DOUBLE) AS total_amount, count(DISTINCT masked_card) AS distinct_cards,
          true AS cards_near, true AS median_near, true AS p95_near
        FROM clean CROSS JOIN (VALUES ('day'), ('month')) AS periods(period) GROUP BY 1, 2, 3"""),
    "offset_audit": _source("""
        SELECT input_topic AS topic, broker_partition AS partition, 'missing' AS kind, before + 1 AS first_offset, event_id - 1 AS last_offset,
          event_id - before - 1 AS records
        FROM (SELECT *, lag(event_id) OVER (PARTITION BY input_topic, broker_partition ORDER BY event_id) AS before FROM records)
        WHERE event_id - before > 1
        UNION ALL SELECT input_topic, broker_partition, 'repeated', event_id, event_id, 1 FROM records WHERE event_id % 97 = 0"""),
    "velocity_stream": _scored("""
        SELECT masked_card, event_timestamp, txn_count, txn_count_span, CAST(amount_sum AS DOUBLE) / txn_count_span AS avg_amount_span
        FROM (
          SELECT DISTINCT masked_card, event_timestamp,
            count(*) OVER (PARTITION BY masked_card, event_timestamp) AS txn_count,
            count(*) OVER span AS txn_count_span, sum(CAST(amount AS DECIMAL(18, 6))) OVER span AS amount_sum
          FROM dated WHERE masked_card IS NOT NULL
          WINDOW span AS (PARTITION BY masked_card ORDER BY event_timestamp
                          RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
        ) AS windows
        WHERE date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR <=
          (SELECT max(event_timestamp) FILTER (WHERE masked_card IS NOT NULL) FROM dated) - INTERVAL 2 HOUR"""),
    "kpi_stream": _scored("""
        SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, bank_id, channel, count(*) AS txn_count,
          CAST(sum(CAST(amount AS DECIMAL(18, 6))) AS DOUBLE) AS total_amount
        FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, event_timestamp) AS window_start FROM dated) AS rows
        WHERE window_start + INTERVAL 8 HOUR <= (SELECT max(event_timestamp) FROM dated) GROUP BY ALL"""),
    "kpi_undated": _scored(f"SELECT {_SILVER} FROM clean WHERE event_timestamp = {_AS_OF}"),
    "bronze_without_repeats": _source(_BRONZE),
    "bronze_timed_trigger": _source(_BRONZE),
    "ingest_two_queries": _source("SELECT input_topic AS topic, count(*) AS n FROM records GROUP BY input_topic"),
    "layers_required": _scored("""
        SELECT 'bronze' AS layer, count(*) AS n, 'silver' AS named_when_absent FROM scored
        UNION ALL SELECT 'silver', count(*), 'silver' FROM clean"""),
    "health_text": _scored("""
        SELECT count(*) AS total_bronze, count(*) FILTER (WHERE quality_score = 'CLEAN') AS total_silver,
          printf('%.1f%%', count(*) FILTER (WHERE quality_score = 'CLEAN') / count(*) * 100) AS health
        FROM scored"""),
}
