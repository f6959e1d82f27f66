"""The registered queries again, in SQL over the same tables."""

from __future__ import annotations

from pagemill.plans.queries import HISTOGRAM_BOUNDS, IN_FLIGHT_AT, PROVIDER_LIMIT
from pagemill.plans.tables import MAX_BYTES, MAX_PAGES

# Documents as pages, with request sizes.
PAGES = """
page_rows AS MATERIALIZED (
  SELECT *, s3_key || '_' || page_no AS custom_id
  FROM (SELECT 'parquets/' || source || '.parquet' AS s3_key, doc_id, lang, text,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_no
        FROM documents)),
sizes AS MATERIALIZED (
  SELECT s3_key, doc_id, page_no, custom_id, text,
         134 + length(custom_id) + 4 * ((octet_length(encode(text)) + 2) // 3) AS size
  FROM page_rows)"""


def _greedy(sequence: str) -> str:
    """Greedy batches along ``pos`` within ``shard``."""
    full = f"g.held >= {MAX_BYTES} OR g.n >= {MAX_PAGES}"
    return f"""
placed AS MATERIALIZED ({sequence}),
greedy AS (
  SELECT shard, pos, s3_key, doc_id, page_no, custom_id, size,
         0 AS batch_no, size AS held, 1 AS n
  FROM placed WHERE pos = 1
  UNION ALL
  SELECT p.shard, p.pos, p.s3_key, p.doc_id, p.page_no, p.custom_id, p.size,
         CASE WHEN {full} THEN g.batch_no + 1 ELSE g.batch_no END,
         CASE WHEN {full} THEN p.size ELSE g.held + p.size END,
         CASE WHEN {full} THEN 1 ELSE g.n + 1 END
  FROM greedy g JOIN placed p ON p.shard = g.shard AND p.pos = g.pos + 1)"""


BY_FILE = _greedy("SELECT s3_key AS shard, page_no AS pos, * FROM sizes")
MIXED = _greedy("SELECT 0 AS shard, row_number() OVER (ORDER BY s3_key, page_no) AS pos, * FROM sizes")

SUMMARY = """
summary AS (
  SELECT * EXCLUDE (a, b), 'jsonl/' || sha256(a || ',' || b || ',' || n_pages) || '.jsonl' AS batch_key
  FROM (SELECT shard, batch_no, count(*) AS n_pages, CAST(sum(size) AS BIGINT) AS n_bytes,
               arg_min(custom_id, pos) AS first_id, arg_max(custom_id, pos) AS last_id,
               sum(CAST('0x' || substr(md5(custom_id || ':' || size), 1, 15) AS HUGEINT)) AS a,
               sum(CAST('0x' || substr(md5(custom_id || ':' || size), 17, 15) AS HUGEINT)) AS b
        FROM greedy GROUP BY shard, batch_no))"""

NAMED = f"WITH RECURSIVE {PAGES}, {BY_FILE}, {SUMMARY}"

# The same pages with the PDF header counted, which toxic ones lack.
PDF_PAGES = PAGES.replace(
    "octet_length(encode(text))",
    "octet_length(encode(text)) + CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 0 ELSE 5 END",
)
PDF_NAMED = f"WITH RECURSIVE {PDF_PAGES}, {BY_FILE}, {SUMMARY}"

# Pages as sent: toxic ones lack the header and are put aside.
PAYLOAD = """
payload AS (
  SELECT g.*, s.batch_key, d.text, coalesce(l.toxic, 0) = 1 AS aside
  FROM greedy g JOIN summary s USING (shard, batch_no)
  JOIN documents d ON d.doc_id = g.doc_id LEFT JOIN labels l ON l.doc_id = g.doc_id),
sent AS (
  SELECT batch_key, custom_id, '%PDF-' || text AS markdown,
         row_number() OVER (PARTITION BY batch_key ORDER BY pos) - 1 AS index
  FROM payload WHERE NOT aside)"""
SENT = f"{PDF_NAMED}, {PAYLOAD}"

KEY = "'parquets/' || user_id || '.parquet'"
QUOTED = f"""'"' || {KEY} || '"'"""
MESSAGES = f"""
messages AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id,
    CASE WHEN event_type <> 'signup' THEN CAST(event_id % 5 + 1 AS INTEGER) ELSE 1 END AS receive_count,
    CASE event_id % 12
      WHEN 0 THEN '{{"s3_key": ' || {QUOTED} || '}}'
      WHEN 1 THEN {KEY}
      WHEN 2 THEN '{{"bucket": "b", "key": ' || {QUOTED} || ', "job_id": "j1"}}'
      WHEN 3 THEN '{{"s3_key": "", "key": ' || {QUOTED} || '}}'
      WHEN 4 THEN '{{"s3_keys": [' || {QUOTED} || ', "extra/' || event_type || '"]}}'
      WHEN 5 THEN '{{}}'
      WHEN 6 THEN {QUOTED}
      WHEN 7 THEN CAST(user_id AS VARCHAR)
      WHEN 8 THEN '{{"s3_key": 0, "s3Uri": "s3://store/' || {KEY} || '"}}'
      WHEN 9 THEN '{{"s3_keys": [], "key": false, "s3_uri": ' || {QUOTED} || '}}'
      WHEN 10 THEN '{{"s3_key": ' || (user_id + 1) || '}}'
      ELSE props END AS body
  FROM events)"""


def _field(name: str) -> str:
    """Text of a field that is not empty, NULL otherwise."""
    kind, value = f"json_type(body, '$.{name}')", f"json_extract_string(body, '$.{name}')"
    return f"""CASE {kind}
        WHEN 'VARCHAR' THEN nullif({value}, '')
        WHEN 'BOOLEAN' THEN nullif({value}, 'false')
        WHEN 'ARRAY' THEN nullif({value}, '[]')
        WHEN 'OBJECT' THEN nullif({value}, '{{}}')
        WHEN 'NULL' THEN NULL
        ELSE CASE WHEN TRY_CAST({value} AS DOUBLE) = 0 THEN NULL ELSE {value} END END"""


FIELDS = ["s3_keys", "s3_key", "key", "s3Uri", "s3_uri"]
_KIND = "\n".join(
    f"WHEN json_valid(body) AND {_field(f)} IS NOT NULL THEN json_type(body, '$.{f}')" for f in FIELDS
)
_VALUE = "\n".join(f"WHEN json_valid(body) AND {_field(f)} IS NOT NULL THEN {_field(f)}" for f in FIELDS)
KEYED = f"""{MESSAGES},
named AS (
  SELECT message_id, receive_count, body,
    CASE WHEN NOT json_valid(body) THEN 'VARCHAR'
         WHEN json_type(body) <> 'OBJECT' THEN 'INVALID'
         {_KIND} ELSE 'VARCHAR' END AS kind,
    CASE WHEN NOT json_valid(body) THEN body {_VALUE} ELSE body END AS value
  FROM messages)"""

LOG = f"""
log AS (
  SELECT {KEY} AS s3_key, event_type, ts, event_id,
    CASE event_type WHEN 'signup' THEN 'enqueued' WHEN 'view' THEN 'processing'
                    WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' END AS status,
    CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS total_pages,
    CASE WHEN event_type = 'error' THEN substr(repeat(props, 120), 1, 1024) END AS last_error
  FROM events)"""

STATE = f"""WITH {LOG}
SELECT s3_key,
  arg_max(status, (ts, event_id)) FILTER (WHERE status IS NOT NULL) AS status,
  count(*) FILTER (WHERE event_type = 'error') AS attempts,
  count(*) FILTER (WHERE event_type = 'click') AS pages_processed,
  arg_max(total_pages, (ts, event_id)) FILTER (WHERE total_pages IS NOT NULL) AS total_pages,
  arg_max(last_error, (ts, event_id)) FILTER (WHERE last_error IS NOT NULL) AS last_error,
  CAST(floor(epoch(min(ts) FILTER (WHERE event_type = 'signup'))) AS BIGINT) AS enqueued_at,
  strftime(max(ts) FILTER (WHERE event_type <> 'signup'), '%Y-%m-%dT%H:%M:%S.%fZ') AS last_updated
FROM log GROUP BY s3_key"""

LATEST = f"""{LOG},
latest AS (
  SELECT s3_key, arg_max(status, (ts, event_id)) AS status
  FROM log WHERE status IS NOT NULL GROUP BY s3_key)"""

REGISTERED = """
keys AS (SELECT 'docs/' || doc_id || '.parquet' AS s3_key FROM documents),
registered AS (
  SELECT 'docs/' || doc_id || '.parquet' AS s3_key, CAST(toxic AS BIGINT) AS attempts,
         CASE WHEN toxic = 1 THEN 'failed' WHEN quality = 1 THEN 'done' ELSE 'enqueued' END AS status
  FROM labels)"""

OUTCOMES = """
outcomes AS (
  SELECT event_type AS queue, CAST(event_id AS VARCHAR) AS message_id, ts AS started_at,
    CASE WHEN event_id % 7 = 0 THEN 'forwarded_to_dlq' WHEN event_id % 11 = 0 THEN 'failed'
         WHEN event_id % 13 = 0 THEN 'write_failed' ELSE 'processed' END AS outcome,
    CASE WHEN event_id % 17 <> 0
         THEN make_timestamp(epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 10000000) END AS finished_at,
    CAST(round(value * 100) AS BIGINT) AS hundredths
  FROM events)"""

BREAK_TAG = r"(?i)<br[ \t\r\n]*/?>"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def _clean(column: str) -> str:
    tagless = f"regexp_replace({column}, '{BREAK_TAG}', ' ', 'g')"
    plain = f"regexp_replace({tagless}, '{CONTROL}', '', 'g')"
    return rf"trim(regexp_replace({plain}, '[ \t]+', ' ', 'g'), ' ')"


NORMAL = (
    r"trim(regexp_replace(translate(lower(text), '‘’‚“”„«»–—−' || chr(160), '''''''""" + '"""""' + r"--- '), "
    r"'[ \t\r\n\x0B\x0C]+', ' ', 'g'), ' ')"
)


def _words(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


TOKENS = f"""
words AS (SELECT doc_id, {_words(NORMAL)} AS w FROM documents),
tokens AS (
  SELECT doc_id, CAST(unnest(range(len(w))) AS BIGINT) AS pos, unnest(w) AS token FROM words)"""

ENTITIES = f"""WITH {TOKENS},
aliases AS (
  SELECT alias, 'item-' || min(item_id) AS canonical
  FROM (SELECT item_id, unnest({_words(NORMAL)}) AS alias FROM benchmark) GROUP BY alias)
SELECT doc_id, count(*) AS n_tokens, count(canonical) AS n_entities,
       count(DISTINCT canonical) AS n_distinct, min(canonical) AS first_entity,
       CAST(sum(pos) FILTER (WHERE canonical IS NOT NULL) AS BIGINT) AS pos_sum
FROM tokens LEFT JOIN aliases ON token = alias GROUP BY doc_id"""

_BOUNDS = ", ".join(f"({i}, CAST({b} AS DOUBLE))" for i, b in enumerate(HISTOGRAM_BOUNDS))

ORACLE = {
    "page_ordinals": f"WITH {PAGES} SELECT doc_id, s3_key, page_no FROM page_rows",
    "pages_per_file": """
        SELECT 'parquets/' || source || '.parquet' AS s3_key, count(*) AS total_pages
        FROM documents GROUP BY source""",
    "page_requests": f"""WITH {PAGES}
        SELECT custom_id, 'image_url' AS document_type,
               'data:image/jpeg;base64,' || base64(encode(text)) AS image_url,
               true AS include_image_base64
        FROM page_rows""",
    "request_lines": f"""WITH {PAGES}
        SELECT custom_id, '{{"custom_id":"' || custom_id || '","body":{{"document":{{"type":"image_url",'
          || '"image_url":"data:image/jpeg;base64,' || base64(encode(text))
          || '"}},"include_image_base64":true}}}}' AS line
        FROM page_rows""",
    "request_sizes": f"WITH {PAGES} SELECT custom_id, size FROM sizes",
    "text_id_sizes": r"""
        SELECT doc_id, 134 + length(text) + 4 * ((n_chars + 2) // 3)
          + length(text) - length(regexp_replace(text, '["\\\n\r\t\x08\x0C]', '', 'g'))
          + 5 * (length(text) - length(regexp_replace(text, '[\x00-\x07\x0B\x0E-\x1F\x7F\x{80}-\x{FFFF}]', '', 'g')))
          + 11 * (length(text) - length(regexp_replace(text, '[\x{10000}-\x{10FFFF}]', '', 'g'))) AS size
        FROM documents""",
    "page_batches": f"""{NAMED}
        SELECT shard AS s3_key, CAST(batch_no AS BIGINT) AS batch_no, n_pages, n_bytes,
               first_id, last_id, batch_key
        FROM summary""",
    "page_batches_mixed": f"""WITH RECURSIVE {PAGES}, {MIXED}, {SUMMARY}
        SELECT CAST(batch_no AS BIGINT) AS batch_no, n_pages, n_bytes, first_id, last_id, batch_key
        FROM summary""",
    "stream_mixed_batches": f"""WITH RECURSIVE {PAGES}, {MIXED}, {SUMMARY}
        SELECT batch_key, n_pages, n_bytes, first_id, last_id FROM summary""",
    "batch_members": f"""WITH RECURSIVE {PAGES}, {BY_FILE}
        SELECT custom_id, CAST(batch_no AS BIGINT) AS batch_no, CAST(held AS BIGINT) AS running_bytes,
               CAST(n AS BIGINT) AS running_pages
        FROM greedy""",
    "page_batches_by_count": f"""WITH {PAGES}
        SELECT custom_id, (page_no - 1) // {MAX_PAGES} AS batch_no FROM page_rows""",
    "batch_announcements": f"""{NAMED}
        SELECT batch_key, '{{"s3_key":"' || batch_key || '"}}' AS body FROM summary""",
    "batch_round_trip": f"""{NAMED}
        SELECT s.batch_key, row_number() OVER (PARTITION BY s.batch_key ORDER BY g.pos) AS line_no,
               g.custom_id, d.text, false AS malformed
        FROM greedy g JOIN summary s USING (shard, batch_no) JOIN documents d ON d.doc_id = g.doc_id""",
    "container_round_trip": f"""{NAMED}
        SELECT s.batch_key, row_number() OVER (PARTITION BY s.batch_key ORDER BY g.pos) AS line_no,
               g.custom_id, d.text, false AS malformed
        FROM greedy g JOIN summary s USING (shard, batch_no) JOIN documents d ON d.doc_id = g.doc_id""",
    "page_table_round_trip": f"WITH {PAGES} SELECT s3_key, page_no, text FROM page_rows",
    "page_file_scan": "SELECT row_number() OVER (ORDER BY doc_id) AS page_no, text FROM documents",
    "message_keys": f"""WITH {KEYED}
        SELECT message_id, receive_count, CASE kind WHEN 'VARCHAR' THEN regexp_replace(value, '^s3://[^/]*/', '') END AS s3_key
        FROM named WHERE kind <> 'ARRAY'
        UNION ALL
        SELECT message_id, receive_count, unnest(from_json(value, '["VARCHAR"]')) AS s3_key
        FROM named WHERE kind = 'ARRAY'""",
    "poison_split": f"""WITH {MESSAGES}
        SELECT message_id, receive_count,
               CASE WHEN receive_count >= 3 THEN 'forwarded_to_dlq' END AS outcome,
               receive_count >= 3 AS acknowledged
        FROM messages""",
    "raw_dead_letters": f"""WITH {MESSAGES}
        SELECT body, count(*) AS n FROM messages WHERE receive_count >= 3 GROUP BY body""",
    "failed_dead_letters": f"""WITH {LATEST}
        SELECT '{{"failed_keys":["' || s3_key || '"],"reason":"worker_processing_failed"}}' AS body,
               'worker_processing_failed' AS reason, s3_key AS keys, '2024-02-01T03:04:05.678901Z' AS at
        FROM latest WHERE status = 'failed'
        UNION ALL
        SELECT '{{"failed_pages":"' || s3_key || '","reason":"ocr_processing_failed"}}',
               'ocr_processing_failed', s3_key, '2024-02-01T03:04:05.678901Z'
        FROM latest WHERE status = 'failed'""",
    "retry_split": f"""WITH state AS ({STATE})
        SELECT s3_key, attempts, CASE WHEN attempts < 15 THEN 'again' ELSE 'given up' END AS route
        FROM state WHERE status = 'failed'""",
    "latest_state": STATE,
    "compacted_state": STATE,
    "state_counters": f"""WITH {LOG}
        SELECT 'pages' AS stage, s3_key, count(*) FILTER (WHERE event_type = 'click') AS pages_processed,
               count(*) FILTER (WHERE event_type = 'error') AS attempts
        FROM log GROUP BY s3_key""",
    "skip_done": f"""WITH {REGISTERED}
        SELECT s3_key FROM keys k
        WHERE NOT EXISTS (SELECT 1 FROM registered r WHERE r.s3_key = k.s3_key AND r.status = 'done')""",
    "skipped_results": f"""WITH {REGISTERED}
        SELECT s3_key, 'skipped' AS status, 'already_done' AS reason
        FROM keys SEMI JOIN (SELECT s3_key FROM registered WHERE status = 'done') USING (s3_key)""",
    "register_absent": f"""WITH {REGISTERED}
        SELECT 'pages' AS stage, s3_key, 'registered' AS event, 'enqueued' AS status,
               CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) AS at
        FROM keys ANTI JOIN registered USING (s3_key)""",
    "state_lookup": f"""WITH {REGISTERED}
        SELECT s3_key, status, attempts FROM keys LEFT JOIN registered USING (s3_key)""",
    "pending_keys": f"""WITH {LATEST}
        SELECT s3_key FROM latest WHERE status IN ('enqueued', 'processing')""",
    "response_keys": """
        SELECT doc_id, 'ocr/v1.' || doc_id || '_ocr_pages.jsonl' AS response_key FROM documents""",
    "object_paths": """
        SELECT doc_id, lang || '/docs/' || doc_id || '.parquet' AS path FROM documents""",
    "decode_round_trip": "SELECT doc_id, lang = 'fr' AS was_gzip, text FROM documents",
    "quarantined_pages": f"{SENT} SELECT custom_id, page_no FROM payload WHERE aside",
    "ocr_quarantine": f"{SENT} SELECT batch_key, custom_id FROM payload WHERE aside",
    "ocr_pages": f"""{SENT}
        SELECT batch_key, CAST(index AS INTEGER) AS index, markdown, CAST(0 AS BIGINT) AS n_images,
               CAST(200 AS INTEGER) AS dpi, CAST(2339 AS INTEGER) AS height, CAST(1654 AS INTEGER) AS width,
               'text' AS model, custom_id
        FROM sent""",
    "ocr_pages_by_manifest": f"""{SENT}
        SELECT 'ocr/' || replace(replace(batch_key, 'jsonl/', ''), '.jsonl', '') || '_ocr_pages.jsonl'
                 AS response_key,
               CAST(index AS INTEGER) AS index, custom_id, markdown
        FROM sent""",
    "ocr_usage": f"""{SENT}
        SELECT batch_key, 'text' AS model, count(*) AS pages_processed,
               CAST(sum(octet_length(encode(markdown))) AS BIGINT) AS doc_size_bytes
        FROM sent GROUP BY batch_key""",
    "ocr_errors": f"""{SENT}
        SELECT batch_key,
               CASE WHEN count(markdown) = 0 THEN 'LookupError: no valid page'
                    WHEN sum(octet_length(encode(markdown))) > {PROVIDER_LIMIT}
                    THEN 'ValueError: document too large' END AS error
        FROM summary LEFT JOIN sent USING (batch_key) GROUP BY batch_key""",
    "outcome_counts": f"""WITH {OUTCOMES}
        SELECT queue, count(*) AS received, count(*) FILTER (WHERE outcome = 'processed') AS processed,
               count(*) FILTER (WHERE outcome <> 'processed') AS failed,
               count(*) FILTER (WHERE outcome = 'write_failed') AS write_failed
        FROM outcomes GROUP BY queue""",
    "proc_time_histogram": f"""WITH {OUTCOMES},
        bounds(bucket, le) AS (VALUES {_BOUNDS}, ({len(HISTOGRAM_BOUNDS)}, CAST(NULL AS DOUBLE))),
        queues AS (SELECT DISTINCT queue FROM outcomes WHERE outcome = 'processed')
        SELECT q.queue, b.bucket, b.le,
               count(*) FILTER (WHERE b.le IS NULL OR o.hundredths / 100 <= b.le) AS cumulative
        FROM queues q, bounds b JOIN outcomes o ON o.queue = q.queue AND o.outcome = 'processed'
        GROUP BY q.queue, b.bucket, b.le""",
    "proc_time_totals": f"""WITH {OUTCOMES}
        SELECT queue, count(*) AS n, CAST(CAST(sum(hundredths) AS DECIMAL(18,0)) / 100 AS DOUBLE) AS total_seconds
        FROM outcomes WHERE outcome = 'processed' GROUP BY queue""",
    "in_flight": f"""WITH {OUTCOMES}
        SELECT count(*) AS in_flight FROM outcomes
        WHERE started_at <= TIMESTAMP '{IN_FLIGHT_AT}'
          AND (finished_at IS NULL OR finished_at > TIMESTAMP '{IN_FLIGHT_AT}')""",
    "in_flight_series": f"""WITH {OUTCOMES},
        changes AS (
          SELECT date_trunc('hour', started_at) AS period, 1 AS change FROM outcomes
          UNION ALL
          SELECT date_trunc('hour', finished_at), -1 FROM outcomes WHERE finished_at IS NOT NULL),
        totals AS (SELECT period, sum(change) AS change FROM changes GROUP BY period)
        SELECT CAST(epoch(period) AS BIGINT) AS period,
               CAST(sum(change) OVER (ORDER BY period) AS BIGINT) AS in_flight
        FROM totals""",
    "acknowledged": f"""WITH {OUTCOMES}
        SELECT message_id, outcome IN ('processed', 'forwarded_to_dlq') AS acknowledged FROM outcomes""",
    "clean_text": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
    "clean_markup": f"SELECT page_id, {_clean('html')} AS html FROM pages",
    "normalized_text": f"SELECT doc_id, {NORMAL} AS text FROM documents",
    "tokens": f"WITH {TOKENS} SELECT doc_id, pos, token FROM tokens",
    "token_counts": f"SELECT doc_id, CAST(len({_words('text')}) AS BIGINT) AS n_tokens FROM documents",
    "kept_docs": rf"""
        SELECT doc_id, lang FROM documents
        WHERE lang IN ('en', 'fr', 'de') AND length(text) >= 200 AND len({_words('text')}) >= 30
          AND length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) / length(text) >= 0.7""",
    "entity_expansion": ENTITIES,
    "entity_expansion_salted": ENTITIES,
    "enriched_docs": f"""WITH cleaned AS (SELECT doc_id, lang, {_clean('text')} AS text FROM documents),
        words AS (SELECT DISTINCT doc_id, unnest({_words(NORMAL)}) AS token FROM cleaned),
        aliases AS (
          SELECT alias, 'item-' || min(item_id) AS canonical
          FROM (SELECT item_id, unnest({_words(NORMAL)}) AS alias FROM benchmark) GROUP BY alias),
        entities AS (
          SELECT doc_id, string_agg(canonical, ',' ORDER BY canonical) AS entities
          FROM (SELECT DISTINCT doc_id, canonical FROM words JOIN aliases ON token = alias) GROUP BY doc_id)
        SELECT doc_id, text, '{{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || length(text)
          || ',"n_tokens":' || len({_words('text')})
          || ',"n_lines":' || (length(text) - length(replace(text, chr(10), '')) + 1)
          || ',"sha256":"' || sha256(text) || '"}}' AS metadata, coalesce(entities, '') AS entities
        FROM cleaned LEFT JOIN entities USING (doc_id)""",
    "stream_message_keys": f"""WITH {KEYED}
        SELECT message_id, receive_count, CASE kind WHEN 'VARCHAR' THEN regexp_replace(value, '^s3://[^/]*/', '') END AS s3_key
        FROM named WHERE kind <> 'ARRAY'
        UNION ALL
        SELECT message_id, receive_count, unnest(from_json(value, '["VARCHAR"]')) AS s3_key
        FROM named WHERE kind = 'ARRAY'""",
    "stream_state": STATE,
    "stream_outcome_counts": f"""WITH {OUTCOMES}
        SELECT queue, count(*) AS received, count(*) FILTER (WHERE outcome = 'processed') AS processed,
               count(*) FILTER (WHERE outcome <> 'processed') AS failed,
               count(*) FILTER (WHERE outcome = 'write_failed') AS write_failed
        FROM outcomes GROUP BY queue""",
    "stream_carried_batches": f"""WITH RECURSIVE page_rows AS (
          SELECT 'parquets/' || source || '.parquet' AS s3_key, doc_id, doc_id AS page_no, text,
                 row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank
          FROM documents),
        sizes AS MATERIALIZED (
          SELECT *, s3_key || '_' || doc_id AS custom_id,
                 134 + length(s3_key || '_' || doc_id) + 4 * ((octet_length(encode(text)) + 2) // 3) AS size
          FROM page_rows),
        {_greedy("SELECT s3_key AS shard, rank AS pos, * FROM sizes")}
        SELECT s3_key, doc_id, size, CAST(batch_no AS BIGINT) AS batch_no,
               held >= {MAX_BYTES} OR n >= {MAX_PAGES} AS closes
        FROM greedy""",
    "stream_page_batches": f"""{PDF_NAMED}
        SELECT batch_key, n_pages, n_bytes, first_id, last_id FROM summary""",
    "stream_ocr_pages": f"""{PDF_NAMED}, {PAYLOAD}
        SELECT batch_key, CAST(index AS INTEGER) AS index, custom_id, markdown FROM sent""",
    "stream_job_state": """
        SELECT 'parquets/' || source || '.parquet' AS s3_key, 'done' AS status, CAST(0 AS BIGINT) AS attempts,
               count(*) AS pages_processed, count(*) AS total_pages, CAST(NULL AS VARCHAR) AS last_error
        FROM documents GROUP BY source
        UNION ALL
        SELECT 'parquets/absent.parquet', 'failed', 4, 0, NULL, 'object not found'""",
    "stream_dead_letters": f"""WITH {KEYED},
        good AS (SELECT * FROM named WHERE receive_count < 3),
        keyed AS (
          SELECT regexp_replace(value, '^s3://[^/]*/', '') AS s3_key FROM good WHERE kind = 'VARCHAR'
          UNION
          SELECT unnest(from_json(value, '["VARCHAR"]')) FROM good WHERE kind = 'ARRAY')
        SELECT body, CAST(NULL AS VARCHAR) AS reason, count(*) AS n
        FROM named WHERE receive_count >= 3 OR kind NOT IN ('VARCHAR', 'ARRAY') GROUP BY body
        UNION ALL
        SELECT CAST(to_json({{'failed_keys': [s3_key], 'reason': 'worker_processing_failed'}}) AS VARCHAR),
               'worker_processing_failed', 1
        FROM keyed""",
    "doc_metadata": f"""
        SELECT doc_id, '{{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || length(text)
          || ',"n_tokens":' || len({_words('text')})
          || ',"n_lines":' || (length(text) - length(replace(text, chr(10), '')) + 1)
          || ',"sha256":"' || sha256(text) || '"}}' AS metadata
        FROM documents""",
}
