"""What each query must give, as ANSI SQL over the ``events`` table.

The statements share common table expressions; each names the ones it needs.
"""

from __future__ import annotations

# Records: key and payload as text, headers as a list of (k, v).
REC = """
rec AS (
  SELECT event_id, user_id, event_type,
    'app.' || event_type AS topic,
    CAST(user_id % 4 AS INTEGER) AS part,
    CAST(row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1 AS BIGINT) AS off,
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN '' ELSE CAST(user_id AS VARCHAR) END AS key_text,
    CASE event_id % 23 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'not-json' WHEN 3 THEN '"hello"'
      WHEN 4 THEN '[1,2,3]' WHEN 5 THEN '1 2' ELSE props END AS val,
    CASE event_id % 7
      WHEN 0 THEN NULL
      WHEN 1 THEN [{'k': 'traceparent', 'v': '00-0af7651916cd43dd8448eb211c80319c-b7ad6b7169203331-01'}]
      WHEN 2 THEN [{'k': 'region', 'v': 'old'}, {'k': 'region', 'v': 'r' || (user_id % 3)}]
      WHEN 3 THEN [{'k': 'region', 'v': 'r' || (user_id % 3)}, {'k': 'empty', 'v': CAST(NULL AS VARCHAR)}]
      ELSE [{'k': 'region', 'v': 'r' || (user_id % 3)},
            {'k': 'traceparent', 'v': '00-0af7651916cd43dd8448eb211c80319c-b7ad6b7169203331-01'},
            {'k': 'tracestate', 'v': 'vendor=x'}, {'k': 'baggage', 'v': 'tenant=1'}]
    END AS headers,
    CASE WHEN event_type = 'error' THEN 100 + event_id % 3 ELSE event_id % 13 END AS batch_id,
    value / 1000 AS duration_s
  FROM events)"""

# One row per header; the last of a key counts; JSON text of the map per event.
FIELDS = """
header AS (SELECT event_id, unnest(headers) AS h, generate_subscripts(headers, 1) AS i FROM rec),
field AS (
  SELECT event_id, h.k AS k, max_by(coalesce(h.v, ''), i) AS v FROM header
  WHERE h.k NOT IN ('traceparent', 'tracestate', 'baggage') GROUP BY event_id, h.k),
fields AS (
  SELECT event_id, '{' || string_agg('"' || k || '":"' || v || '"', ',' ORDER BY k) || '}' AS fields_text,
    CAST(count(*) AS INTEGER) AS n_fields, max(CASE WHEN k = 'region' THEN v END) AS region,
    string_agg(k || '=' || hex(encode(v)), '|' ORDER BY k) AS out_headers
  FROM field GROUP BY event_id),
header_text AS (
  SELECT event_id, string_agg(h.k || '=' || coalesce(hex(encode(h.v)), 'null'), '|' ORDER BY i) AS headers_text
  FROM header GROUP BY event_id)"""

# Payload as message, format auto.
MSG = """
msg AS (
  SELECT event_id, val,
    CASE WHEN val IS NULL THEN 'null' WHEN NOT json_valid(val) THEN 'string'
      ELSE CASE WHEN json_type(val) = 'VARCHAR' THEN 'string' ELSE 'json' END END AS kind
  FROM rec),
decoded AS (
  SELECT event_id, val, kind,
    CASE WHEN kind = 'json' THEN CAST(json(val) AS VARCHAR) END AS json_text,
    CASE WHEN kind = 'json' THEN json_extract_string(val, '$.k') END AS k_text,
    CASE WHEN kind = 'string' THEN CASE WHEN json_valid(val) THEN json_extract_string(val, '$') ELSE val END END AS text
  FROM msg)"""

ING = """
ing AS (
  SELECT rec.*, decoded.kind, decoded.json_text, decoded.k_text, decoded.text, fields.fields_text, fields.out_headers,
    header_text.headers_text, s.ord AS sub_ord,
    CASE s.ord WHEN 0 THEN 'web/click' WHEN 1 THEN 'web/' || key_text || '/view'
      WHEN 2 THEN 'shop/' || region || '/purchase' WHEN 3 THEN 'user/' || k_text || '/signup' END AS bus_topic
  FROM rec JOIN decoded USING (event_id) LEFT JOIN fields USING (event_id) LEFT JOIN header_text USING (event_id)
  LEFT JOIN (
    SELECT topic AS sub_topic, min(ord) AS ord
    FROM (VALUES (0, 'app.click'), (1, 'app.view'), (2, 'app.purchase'), (3, 'app.signup'), (4, 'app.click')) v(ord, topic)
    GROUP BY topic) s ON s.sub_topic = rec.topic),
ingested AS (
  SELECT *,
    CASE WHEN sub_ord IS NULL THEN 'no_subscription' WHEN bus_topic IS NULL THEN 'topic_error'
      WHEN CAST(k_text AS INTEGER) >= 90 THEN 'handler_error' ELSE 'ok' END AS status,
    CASE WHEN sub_ord IS NULL THEN 'kafka consumer: no subscription found for topic "' || topic || '"'
      WHEN bus_topic IS NULL THEN 'kafka consumer: resolve bus topic for "' || topic || '": unresolved reference'
      WHEN CAST(k_text AS INTEGER) >= 90 THEN 'k out of range' END AS error
  FROM ing)"""

INGESTED = ",".join([REC, FIELDS, MSG, ING])

BUS = """
bus AS (
  SELECT event_id, user_id,
    CASE event_type WHEN 'click' THEN 'meter/' || user_id || '/level' WHEN 'view' THEN 'meter/' || user_id
      WHEN 'purchase' THEN 'shop/eu/purchase/' || user_id WHEN 'signup' THEN '$SYS/' || user_id || '/signup'
      ELSE 'gate/open' END AS topic,
    CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN 'string' WHEN 2 THEN 'bytes' ELSE 'json' END AS kind,
    props,
    CASE WHEN event_id % 5 <> 0 THEN 'r' || (user_id % 3) END AS region,
    CASE WHEN event_id % 5 <> 0 THEN 'given' END AS device,
    value / 1000 AS duration_s
  FROM events)"""

# The bus events' own fields as headers, ordered by key.
BUS_HEADERS = "CASE WHEN region IS NULL THEN '' ELSE 'meterId=' || hex(encode(device)) || '|region=' || hex(encode(region)) END"


def mapped(rules: list[tuple[int, str, bool, str, str]], default: str, key_error: str = "false") -> str:
    """First match per event; a rule is ``(ord, regex, starts wild, target, key expression)``."""
    values = ", ".join(
        f"({ord_}, '{regex}', {str(wild).lower()}, '{target}')" for ord_, regex, wild, target, _ in rules
    )
    keys = " ".join(f"WHEN {ord_} THEN {key}" for ord_, _, _, _, key in rules)
    fallback = {"error": "NULL", "slash_to_dot": "replace(topic, '/', '.')", "ignore": "''"}[default]
    return f"""
rules AS (SELECT * FROM (VALUES {values}) v(ord, re, wild, target)),
topics AS (
  SELECT topic, min(ord) AS ord FROM (SELECT DISTINCT topic FROM bus) t
  JOIN rules ON regexp_full_match(topic, re) AND NOT (wild AND starts_with(topic, '$')) GROUP BY topic),
matched AS (
  SELECT bus.*, topics.ord AS mapping_ord,
    CASE WHEN topics.ord IS NULL THEN {fallback} ELSE rules.target END AS target,
    CASE topics.ord {keys} END AS key_text,
    coalesce({key_error}, false) AS key_failed
  FROM bus LEFT JOIN topics USING (topic) LEFT JOIN rules ON rules.ord = topics.ord),
routed AS (
  SELECT *,
    CASE WHEN NOT key_failed THEN target END AS kafka_topic,
    CASE WHEN NOT key_failed THEN hex(encode(key_text)) END AS key_hex,
    CASE WHEN key_failed THEN 'key_error' WHEN target IS NULL THEN 'unmatched' WHEN target = '' THEN 'ignored'
      ELSE 'ok' END AS status,
    CASE WHEN key_failed THEN 'kafka producer: resolve key for "' || topic || '": bad device'
      WHEN target IS NULL THEN 'kafka producer: no topic mapping matched for topic "' || topic
        || '" and default_topic_transform is error' END AS error
  FROM matched)"""


NO_KEY = "CAST(NULL AS VARCHAR)"
REGION_KEY = "coalesce(region, '')"
DEVICE = (0, "meter/[^/]*/level", False, "meter.levels", "split_part(topic, '/', 2)")
SENSORS = (1, "meter(/.*)?", False, "meters", NO_KEY)
SHOP = (2, "shop/[^/]*/purchase/[^/]*", False, "shop.purchases", REGION_KEY)
SHADOWED = (3, "meter/[^/]*/level", False, "shadowed", NO_KEY)
SIGNUPS = (4, "[^/]*/[^/]*/signup", True, "signups", NO_KEY)
OPS = (5, "ops(/.*)?", False, "", NO_KEY)
MAPPINGS = [DEVICE, SENSORS, SHOP, SHADOWED, SIGNUPS, OPS]


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def routed(rules: list[tuple[int, str, bool, str, str]], default: str = "error", key_error: str = "false") -> str:
    return with_(
        BUS,
        mapped(rules, default, key_error),
        select="SELECT event_id, topic, mapping_ord, kafka_topic, key_hex, status, error FROM routed",
    )


def renumbered(*rules: tuple[int, str, bool, str, str]) -> list[tuple[int, str, bool, str, str]]:
    return [(i, *rule[1:]) for i, rule in enumerate(rules)]


# The value of an outbound record in format auto.
AUTO_VALUE = """CASE kind WHEN 'string' THEN hex(encode('hello')) WHEN 'bytes' THEN hex(encode(props))
  WHEN 'json' THEN hex(encode(CAST(json(props) AS VARCHAR))) END"""

OUTBOUND = ",".join([
    BUS,
    mapped(MAPPINGS, "slash_to_dot"),
    f"""
outbound AS (
  SELECT event_id, kafka_topic AS topic, key_hex, {AUTO_VALUE} AS value_hex, {BUS_HEADERS} AS headers_text, duration_s,
    event_id % 47 = 0 AS refused
  FROM routed WHERE status = 'ok')""",
])

POSITIONS = """
sizes AS (SELECT topic, part, CAST(max(off) + 1 AS BIGINT) AS n FROM rec GROUP BY topic, part),
watermarks AS (
  SELECT topic, part, CAST(n + part * 3 AS BIGINT) AS high_watermark FROM sizes
  UNION ALL SELECT 'app.click', 9, 50),
committed AS (SELECT topic, part, n // 2 AS next_offset FROM sizes WHERE part < 2),
lag AS (
  SELECT w.topic, w.part, CAST(CASE WHEN n IS NULL THEN 0 ELSE greatest(high_watermark - n, 0) END AS DOUBLE) AS lag
  FROM watermarks w LEFT JOIN sizes s ON s.topic = w.topic AND s.part = w.part),
early AS (SELECT topic, part, n * 3 // 4 AS high_watermark FROM sizes WHERE part < 3)"""


def resumed(first: str, watermarks: str = "watermarks") -> str:
    return with_(
        REC,
        POSITIONS,
        select=f"""SELECT event_id, rec.topic, rec.part, off FROM rec
LEFT JOIN committed c ON c.topic = rec.topic AND c.part = rec.part
LEFT JOIN {watermarks} w ON w.topic = rec.topic AND w.part = rec.part
WHERE off >= coalesce({first}, 0)""",
    )


def positions(condition: str) -> str:
    return with_(
        INGESTED,
        select=f"""SELECT topic, part, CAST(max(off) + 1 AS BIGINT) AS next_offset
FROM ingested WHERE {condition} GROUP BY topic, part""",
    )


# A poll takes a share of the event ids.
POLLS = """
polls AS (
  SELECT ids, greatest(4, (ids + 1048575) // 1048576) AS n_polls FROM (SELECT max(event_id) + 1 AS ids FROM rec)),
polled AS (SELECT rec.*, CAST(event_id * n_polls // ids AS BIGINT) AS poll FROM rec, polls)"""


def decoded_as(kind: str, failed: str, json: str, text: str, raw: str) -> str:
    return with_(
        REC,
        MSG,
        select=f"""SELECT event_id, {failed} AS decode_failed, {kind} AS kind, {json} AS json_text,
  CAST(CASE WHEN {json} IS NOT NULL THEN k_text END AS DOUBLE) AS k, {text} AS text, {raw} AS raw_hex FROM decoded""",
    )


def encoded_as(value: str, failed: str = "false") -> str:
    return with_(
        BUS,
        select=f"""SELECT event_id, {value} AS value_hex,
  CASE WHEN {failed} THEN 'serialize_error' ELSE 'ok' END AS status,
  CASE WHEN {failed} THEN 'kafka producer: serialize payload: bytes format needs bytes or string' END AS error FROM bus""",
    )


def histogram(source: str, condition: str, *ctes: str) -> str:
    d = "duration_s"
    return with_(
        *ctes,
        select=f"""SELECT topic, count(*) AS n, round(sum({d}), 6) AS total, min({d}) AS shortest, max({d}) AS longest,
  count(*) FILTER ({d} <= 0.005) AS bucket_0,
  count(*) FILTER ({d} > 0.005 AND {d} <= 0.01) AS bucket_1,
  count(*) FILTER ({d} > 0.01 AND {d} <= 0.025) AS bucket_2,
  count(*) FILTER ({d} > 0.025 AND {d} <= 0.05) AS bucket_3,
  count(*) FILTER ({d} > 0.05 AND {d} <= 0.1) AS bucket_4,
  count(*) FILTER ({d} > 0.1) AS bucket_5
FROM {source} WHERE {condition} GROUP BY topic""",
    )


RESOLVED = with_(INGESTED, select="SELECT event_id, topic, bus_topic, status FROM (SELECT event_id, topic, bus_topic, "
                 "CASE WHEN status = 'handler_error' THEN 'ok' ELSE status END AS status FROM ingested)")

CUSTOM_RESOLVED = with_(
    REC,
    FIELDS,
    select="""SELECT event_id, bus_topic, status,
  CASE status WHEN 'no_subscription' THEN 'kafka consumer: no subscription found for topic "' || topic || '"'
    WHEN 'topic_error' THEN 'kafka consumer: resolve bus topic for "' || topic || '": '
      || CASE WHEN topic = 'app.view' AND key_text = '' THEN 'empty key' ELSE 'unresolved reference' END END AS error
FROM (
  SELECT *, CASE WHEN topic NOT IN ('app.view', 'app.click', 'app.error') THEN 'no_subscription'
      WHEN bus_topic IS NULL THEN 'topic_error' ELSE 'ok' END AS status
  FROM (
    SELECT event_id, topic, key_text,
      CASE topic WHEN 'app.view' THEN CASE WHEN key_text IS NULL THEN 'visitor/app.view'
          WHEN key_text <> '' THEN 'visitor/' || key_text || '/app.view' END
        WHEN 'app.click' THEN 'click/' || part
        WHEN 'app.error' THEN 'error/' || region END AS bus_topic
    FROM rec LEFT JOIN fields USING (event_id)))""",
)

CUSTOM_CODEC = with_(
    REC,
    select="""SELECT event_id, failed AS decode_failed,
  CASE WHEN val IS NULL THEN 'null' WHEN failed THEN 'bytes' ELSE 'string' END AS kind,
  CASE WHEN starts_with(val, '{') THEN hex(encode('<' || upper(val) || '>')) END AS value_hex,
  CASE WHEN failed THEN 'serialize_error' ELSE 'ok' END AS status,
  CASE WHEN failed THEN 'kafka producer: serialize payload: angled format takes no bytes' END AS error
FROM (SELECT *, val IS NOT NULL AND NOT starts_with(val, '{') AS failed FROM rec)""",
)

DLQ = """
dead AS (
  SELECT event_id, hex(encode(key_text)) AS key_hex, hex(encode(val)) AS value_hex,
    coalesce(headers_text || '|', '') || 'dlq-error=' || hex(encode(error))
      || '|dlq-original-topic=' || hex(encode(topic))
      || '|dlq-timestamp=' || hex(encode('2026-01-02T03:04:05Z')) AS headers_text
  FROM ingested WHERE error IS NOT NULL)"""

ROUTE_MANY = with_(
    BUS,
    select="""SELECT event_id, 'meters' AS producer, CASE WHEN topic LIKE 'meter/%/level' THEN 'meter.levels' ELSE 'meters' END AS kafka_topic,
  CASE WHEN topic LIKE 'meter/%/level' THEN hex(encode(split_part(topic, '/', 2))) END AS key_hex, 'ok' AS status
FROM bus WHERE topic LIKE 'meter/%'
UNION ALL SELECT event_id, 'shop', 'shop.purchases', hex(encode(coalesce(region, ''))), 'ok' FROM bus WHERE topic LIKE 'shop/%/purchase/%'
UNION ALL SELECT event_id, 'audit', 'audit', NULL, 'ok' FROM bus WHERE NOT starts_with(topic, '$')""",
)

# A rule per user: meter/<id>/+ where the id leaves 0 by 3, shop/+/purchase/<id> where it leaves 1.
BY_USER = with_(
    BUS,
    select="""SELECT event_id, topic, mapping_ord, kafka_topic, CASE WHEN kafka_topic IS NULL THEN 'unmatched' ELSE 'ok' END AS status,
  CASE WHEN kafka_topic IS NULL THEN 'kafka producer: no topic mapping matched for topic "' || topic
    || '" and default_topic_transform is error' END AS error
FROM (
  SELECT event_id, topic,
    CASE WHEN user_id % 3 = 0 AND topic LIKE 'meter/%/level' THEN user_id
      WHEN user_id % 3 = 1 AND topic LIKE 'shop/%' THEN user_id END AS mapping_ord,
    CASE WHEN user_id % 3 = 0 AND topic LIKE 'meter/%/level' THEN 'device.' || user_id
      WHEN user_id % 3 = 1 AND topic LIKE 'shop/%' THEN 'buyer.' || user_id END AS kafka_topic
  FROM bus)""",
)

BRIDGED = """
bridged AS (
  SELECT event_id, topic AS source_topic, status AS ingest_status, error, kind, json_text, text, val, out_headers, bus_topic,
    CASE WHEN status <> 'ok' THEN NULL WHEN bus_topic = 'web/click' THEN 'clicks'
      WHEN regexp_full_match(bus_topic, 'web/[^/]*/view') THEN 'views'
      WHEN regexp_full_match(bus_topic, 'shop/[^/]*(/.*)?') THEN 'purchases'
      ELSE replace(bus_topic, '/', '.') END AS kafka_topic,
    CASE WHEN status = 'ok' AND (regexp_full_match(bus_topic, 'web/[^/]*/view') OR starts_with(bus_topic, 'shop/'))
      THEN split_part(bus_topic, '/', 2) END AS key_text,
    CASE WHEN status = 'ok' AND bus_topic = '' THEN 'ignored' ELSE status END AS status
  FROM ingested)"""


# The bridge without fallback: what matches no mapping fails, as an event of the bus topic.
STRICT_BRIDGE = """
strict AS (
  SELECT * REPLACE (CASE WHEN lost THEN 'unmatched' ELSE status END AS status,
    CASE WHEN lost THEN 'kafka producer: no topic mapping matched for topic "' || bus_topic
      || '" and default_topic_transform is error' ELSE error END AS error)
  FROM (SELECT b.*, i.key_text AS own_key, i.headers_text, b.status = 'ok' AND starts_with(b.bus_topic, 'user/') AS lost,
      i.part, i.off, i.topic FROM bridged b JOIN ingested i USING (event_id))),
strict_dead AS (
  SELECT event_id, hex(encode(own_key)) AS key_hex, hex(encode(val)) AS value_hex,
    coalesce(headers_text || '|', '') || 'dlq-error=' || hex(encode(error))
      || '|dlq-original-topic=' || hex(encode(source_topic)) AS headers_text
  FROM strict WHERE error IS NOT NULL),
strict_sent AS (
  SELECT kafka_topic AS topic, hex(encode(key_text)) AS key_hex,
    CASE kind WHEN 'json' THEN hex(encode(json_text)) WHEN 'string' THEN hex(encode(text)) END AS value_hex,
    coalesce(out_headers, '') AS headers_text FROM strict WHERE status = 'ok')"""

# All statuses of MAPPINGS_ALL in format bytes.
OUTCOMES = ",".join([
    BUS,
    mapped(
        [DEVICE, (1, "meter(/.*)?", False, "", NO_KEY), *MAPPINGS[2:]],
        "error",
        "topics.ord = 0 AND ends_with(split_part(topic, '/', 2), '0')",
    ),
    f"""
outcomes AS (
  SELECT event_id, topic, kafka_topic, key_hex,
    CASE WHEN status = 'ok' AND kind <> 'json' THEN {AUTO_VALUE} END AS value_hex,
    CASE WHEN status = 'ok' AND kind <> 'json' THEN {BUS_HEADERS} ELSE '' END AS headers_text,
    CASE WHEN status = 'ok' AND kind = 'json' THEN 'serialize_error' ELSE status END AS status,
    CASE WHEN status = 'ok' AND kind = 'json' THEN 'kafka producer: serialize payload: bytes format needs bytes or string'
      ELSE error END AS error
  FROM routed)""",
])

TEXTS = """
texts AS (
  SELECT 'documents' AS src, doc_id AS id, text FROM documents
  UNION ALL SELECT 'pages', page_id, html FROM pages
  UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations)"""

# The rule of each user for topics meter/<user>[/level], in 24 shapes by the id; the lowest id that fits counts.
BY_SHAPE = with_(
    BUS,
    select="""SELECT event_id, topic, mapping_ord, kafka_topic,
  CASE WHEN mapping_ord IS NULL THEN NULL ELSE hex(encode(
    CASE WHEN (mapping_ord % 24) & 2 > 0
      THEN CASE WHEN (mapping_ord % 24) & 4 > 0 AND (mapping_ord % 24) // 8 <> 1
        THEN split_part(topic, '/', 3) ELSE split_part(topic, '/', 2) END
      ELSE coalesce(region, '') END)) END AS key_hex,
  CASE WHEN mapping_ord IS NULL THEN 'ignored' ELSE 'ok' END AS status
FROM (
  SELECT bus.*, CAST(m.ord AS INTEGER) AS mapping_ord, CASE WHEN m.ord IS NULL THEN '' ELSE 'user.' || m.ord END AS kafka_topic
  FROM bus LEFT JOIN (
    SELECT topic, min(ord) AS ord FROM (SELECT DISTINCT topic FROM bus) JOIN (
      SELECT ord, '^' || CASE kind WHEN 0 THEN a || '/' || b || '/' || c
          WHEN 1 THEN a || '/' || b || '(/.*)?' ELSE a || '/' || b || '/' || c || '(/.*)?' END || '$' AS re, wild
      FROM (
        SELECT DISTINCT user_id AS ord, (user_id % 24) // 8 AS kind, (user_id % 24) & 1 > 0 AS wild,
          CASE WHEN (user_id % 24) & 1 > 0 THEN '[^/]*' ELSE 'meter' END AS a,
          CASE WHEN (user_id % 24) & 2 > 0 THEN '[^/]*' ELSE CAST(user_id AS VARCHAR) END AS b,
          CASE WHEN (user_id % 24) & 4 > 0 THEN '[^/]*' ELSE 'reading' END AS c
        FROM events)) ON regexp_matches(topic, re) AND NOT (wild AND starts_with(topic, '$'))
    GROUP BY topic) m USING (topic))""",
)


def measures(name: str, unit: str, attributes_text: str, source: str, condition: str) -> str:
    """A histogram per topic, one row per measure."""
    d = "duration_s"
    rows = {
        "count": "count(*)",
        "sum": f"round(sum({d}), 6)",
        "min": f"min({d})",
        "max": f"max({d})",
        "bucket_0": f"count(*) FILTER ({d} <= 0.005)",
        "bucket_1": f"count(*) FILTER ({d} > 0.005 AND {d} <= 0.01)",
        "bucket_2": f"count(*) FILTER ({d} > 0.01 AND {d} <= 0.025)",
        "bucket_3": f"count(*) FILTER ({d} > 0.025 AND {d} <= 0.05)",
        "bucket_4": f"count(*) FILTER ({d} > 0.05 AND {d} <= 0.1)",
        "bucket_5": f"count(*) FILTER ({d} > 0.1)",
    }
    return "\nUNION ALL ".join(
        f"SELECT '{name}', '{unit}', {attributes_text}, '{measure}', {value} FROM {source} WHERE {condition} GROUP BY topic"
        for measure, value in rows.items()
    )


def attributes(**named: str) -> str:
    """JSON text of the attribute map, keys in order; a value is a SQL expression."""
    pairs = " || ',' || ".join(f"'\"{name}\":\"' || {value} || '\"'" for name, value in sorted(named.items()))
    return f"'{{' || {pairs} || '}}'"


ALWAYS = {"client.name": "'main'", "messaging.system": "'kafka'"}
PER_TOPIC = {**ALWAYS, "messaging.destination.name": "topic"}
SEND = {**PER_TOPIC, "messaging.operation.name": "'send'"}
PER_PARTITION = {**PER_TOPIC, "messaging.destination.partition.id": "part"}

REPORT = with_(
    INGESTED,
    POSITIONS,
    OUTBOUND,
    select=f"""SELECT 'messaging.client.consumed.messages' AS name, '{{message}}' AS unit,
  {attributes(**PER_TOPIC)} AS attributes_text, 'value' AS measure, CAST(count(*) AS DOUBLE) AS value
FROM ingested WHERE status = 'ok' GROUP BY topic
UNION ALL SELECT 'kafka.consumer.errors', '{{error}}', {attributes(**PER_TOPIC)}, 'value', count(*)
FROM ingested WHERE status <> 'ok' GROUP BY topic
UNION ALL SELECT 'kafka.consumer.lag', '{{message}}', {attributes(**PER_PARTITION)}, 'value', lag FROM lag
UNION ALL SELECT 'kafka.consumer.commits', '{{operation}}', {attributes(**ALWAYS)}, 'value', count(DISTINCT batch_id)
FROM ingested WHERE status = 'ok'
UNION ALL SELECT 'messaging.client.sent.messages', '{{message}}', {attributes(**SEND)}, 'value', count(*)
FROM outbound WHERE NOT refused GROUP BY topic
UNION ALL SELECT 'kafka.producer.errors', '{{error}}', {attributes(**PER_TOPIC)}, 'value', count(*)
FROM outbound WHERE refused GROUP BY topic
UNION ALL {measures("messaging.process.duration", "s", attributes(**PER_TOPIC), "ingested", "status IN ('ok', 'handler_error')")}
UNION ALL {measures("messaging.client.operation.duration", "s", attributes(**SEND), "outbound", "NOT refused")}""",
)

STREAM_COUNTS = with_(
    INGESTED,
    select="""SELECT 'record' AS what, topic, status, count(*) AS n FROM ingested GROUP BY topic, status
UNION ALL SELECT 'event', split_part(bus_topic, '/', 1), NULL, count(*) FROM ingested WHERE status = 'ok' GROUP BY 2
UNION ALL SELECT 'dead letter', 'app.dlq', NULL, count(*) FROM ingested WHERE status <> 'ok'""",
)

ORACLES: dict[str, str] = {
    "scan_subscribed": with_(
        REC,
        select="SELECT event_id, topic, part, hex(encode(val)) AS value_hex FROM rec WHERE topic IN ('app.click', 'app.view')",
    ),
    "log_round_trip": with_(
        OUTBOUND,
        select="""SELECT topic, key_hex, value_hex, headers_text FROM outbound WHERE topic IN ('shop.purchases', 'meters')""",
    ),
    "resume_stored": resumed("coalesce(next_offset, high_watermark)"),
    "resume_earliest": resumed("coalesce(next_offset, 0)"),
    "resume_latest": resumed("coalesce(next_offset, high_watermark)"),
    "resume_range": with_(
        REC,
        POSITIONS,
        select="""SELECT w.topic, w.part, least(coalesce(next_offset, high_watermark), high_watermark) AS first,
  high_watermark AS "end" FROM watermarks w LEFT JOIN committed c ON c.topic = w.topic AND c.part = w.part""",
    ),
    "resume_log": resumed("coalesce(next_offset, 0)"),
    "resume_new_partition": resumed("coalesce(next_offset, high_watermark)", "early"),
    "committed_positions": positions("status = 'ok'"),
    "committed_positions_dlq": positions("true"),
    "committed_positions_periodic": positions("true"),
    "subscription_lookup": with_(
        INGESTED,
        select="""SELECT event_id, topic, sub_ord,
  CASE WHEN sub_ord IS NULL THEN 'no_subscription' ELSE 'ok' END AS status,
  CASE WHEN sub_ord IS NULL THEN error END AS error FROM ingested""",
    ),
    "key_decode": with_(
        REC,
        select="SELECT event_id, key_text, key_text IS NULL AS no_key, CAST(length(key_text) AS INTEGER) AS key_length FROM rec",
    ),
    "headers_to_fields": with_(
        REC,
        FIELDS,
        select="""SELECT event_id, fields_text, coalesce(headers_text, '') AS headers_text
FROM rec LEFT JOIN fields USING (event_id) LEFT JOIN header_text USING (event_id)""",
    ),
    "trace_header_filter": with_(
        REC,
        FIELDS,
        select="""SELECT event_id, CAST(len(headers) AS INTEGER) AS n_headers, n_fields,
  CASE WHEN n_fields IS NOT NULL THEN false END AS has_trace FROM rec LEFT JOIN fields USING (event_id)""",
    ),
    "decode_auto": decoded_as("kind", "false", "json_text", "text", "CAST(NULL AS VARCHAR)"),
    "decode_json": decoded_as(
        "CASE WHEN val IS NOT NULL AND NOT json_valid(val) THEN 'bytes' ELSE kind END",
        "val IS NOT NULL AND NOT json_valid(val)",
        "json_text",
        "CASE WHEN json_valid(val) THEN text END",
        "CASE WHEN NOT json_valid(val) THEN hex(encode(val)) END",
    ),
    "decode_string": decoded_as(
        "CASE WHEN val IS NULL THEN 'null' ELSE 'string' END", "false", "CAST(NULL AS VARCHAR)", "val", "CAST(NULL AS VARCHAR)"
    ),
    "decode_bytes": decoded_as(
        "CASE WHEN val IS NULL THEN 'null' ELSE 'bytes' END",
        "false",
        "CAST(NULL AS VARCHAR)",
        "CAST(NULL AS VARCHAR)",
        "hex(encode(val))",
    ),
    "decode_failures": with_(
        REC,
        select="""SELECT topic, count(*) AS n, count(*) FILTER (val IS NOT NULL AND NOT json_valid(val)) AS n_failed,
  count(*) FILTER (val IS NOT NULL AND NOT json_valid(val)) AS n_raw FROM rec GROUP BY topic""",
    ),
    "encode_auto": encoded_as(AUTO_VALUE),
    "encode_json": encoded_as(AUTO_VALUE.replace("'hello'", "'\"hello\"'")),
    "encode_string": encoded_as(AUTO_VALUE),
    "encode_bytes": encoded_as(f"CASE WHEN kind <> 'json' THEN {AUTO_VALUE} END", "kind = 'json'"),
    "custom_codec": CUSTOM_CODEC,
    "resolve_topic": RESOLVED,
    "resolve_topic_custom": CUSTOM_RESOLVED,
    "resolve_topic_errors": with_(
        INGESTED,
        select="SELECT topic, error, count(*) AS n FROM ingested WHERE status = 'topic_error' GROUP BY topic, error",
    ),
    "deliver_status": with_(INGESTED, select="SELECT event_id, topic, bus_topic, status, error FROM ingested"),
    "outcome_split": with_(
        INGESTED,
        select="""SELECT topic, CASE WHEN status = 'ok' THEN 'success' ELSE 'dead_letter' END AS outcome_dlq,
  CASE WHEN status = 'ok' THEN 'success' ELSE 'dropped' END AS outcome, count(*) AS n FROM ingested GROUP BY 1, 2, 3""",
    ),
    "dlq_records": with_(
        INGESTED, DLQ, select="SELECT event_id, 'app.dlq' AS topic, key_hex, value_hex, headers_text FROM dead"
    ),
    "route_exact": routed([*MAPPINGS, (6, "gate/open", False, "gates", NO_KEY)]),
    "route_plus": routed(renumbered(SHOP, SHADOWED), "ignore"),
    "route_hash": routed(renumbered(SENSORS), "ignore"),
    "route_reserved": routed([*MAPPINGS, (6, "\\$SYS(/.*)?", False, "sys", NO_KEY)]),
    "route_capture": with_(
        BUS,
        select="""SELECT event_id,
  CASE WHEN topic LIKE 'meter/%/level' THEN '{"meterId":"' || user_id || '"}' END AS device_text,
  CASE WHEN topic LIKE 'shop/%' THEN '{"region":"eu","rest":"purchase/' || user_id || '"}' END AS purchase_text FROM bus""",
    ),
    "route_first_match": routed(MAPPINGS, "slash_to_dot"),
    "route_field_merge": with_(
        BUS,
        select="""SELECT event_id,
  CASE WHEN topic LIKE 'meter/%/level' THEN '{"meterId":"' || user_id || '"'
    || coalesce(',"region":"' || region || '"', '') || '}' END AS merged_text,
  '{"meterId":"' || device || '","region":"' || region || '"}' AS fields_text FROM bus""",
    ),
    "route_key": routed(renumbered(DEVICE, SHOP, (2, "gate(/.*)?", False, "gates", REGION_KEY)), "ignore"),
    "route_key_error": routed(
        MAPPINGS, key_error="topics.ord = 0 AND ends_with(split_part(topic, '/', 2), '0')"
    ),
    "fallback_error": routed(MAPPINGS),
    "fallback_slash_to_dot": routed(renumbered(SIGNUPS, OPS), "slash_to_dot"),
    "fallback_ignore": routed(MAPPINGS, "ignore"),
    "route_empty_target": routed([DEVICE, (1, "meter(/.*)?", False, "", NO_KEY), *MAPPINGS[2:]]),
    "fields_to_headers": with_(BUS, select=f"SELECT event_id, {BUS_HEADERS} AS headers_text FROM bus"),
    "produced_records": with_(OUTBOUND, select="SELECT event_id, topic, key_hex, value_hex, headers_text FROM outbound"),
    "route_rule_table": with_(
        BUS,
        mapped(MAPPINGS, "slash_to_dot"),
        select="SELECT event_id, topic, mapping_ord, kafka_topic, status FROM routed",
    ),
    "route_rule_table_by_user": BY_USER,
    "route_rule_table_keyed": routed(MAPPINGS, "slash_to_dot"),
    "route_rule_table_shapes": BY_SHAPE,
    "route_rule_table_trie": BY_SHAPE,
    "route_many": ROUTE_MANY,
    "produce_outcomes": with_(
        OUTCOMES, select="SELECT event_id, kafka_topic, key_hex, value_hex, headers_text, status, error FROM outcomes"
    ),
    "decode_texts": with_(
        TEXTS,
        select="""SELECT src, id, CASE WHEN text IS NULL THEN 'null' WHEN json_valid(text) AND json_type(text) <> 'VARCHAR' THEN 'json'
  ELSE 'string' END AS kind, CASE WHEN NOT json_valid(text) THEN md5(text)
  WHEN json_type(text) = 'VARCHAR' THEN md5(json_extract_string(text, '$')) END AS text_md5, false AS decode_failed FROM texts""",
    ),
    "encode_texts": with_(
        TEXTS,
        select="""SELECT src, id, md5(CAST(to_json(text) AS VARCHAR)) AS value_md5, 'string' AS kind, md5(text) AS text_md5 FROM texts""",
    ),
    "m_consumed": with_(INGESTED, select="SELECT topic, count(*) AS n FROM ingested WHERE status = 'ok' GROUP BY topic"),
    "m_consumer_errors": with_(
        INGESTED, select="SELECT topic, count(*) AS n FROM ingested WHERE status <> 'ok' GROUP BY topic"
    ),
    "m_process_duration": histogram("ingested", "status IN ('ok', 'handler_error')", INGESTED),
    "m_lag": with_(REC, POSITIONS, select="SELECT topic, part, lag FROM lag"),
    "m_lag_stale": with_(
        REC,
        POSITIONS,
        select="""SELECT e.topic, e.part, CAST(greatest(high_watermark - n, 0) AS DOUBLE) AS lag
FROM early e JOIN sizes s ON s.topic = e.topic AND s.part = e.part""",
    ),
    "m_commits": with_(INGESTED, select="SELECT count(DISTINCT batch_id) AS n FROM ingested WHERE status = 'ok'"),
    "m_commits_dlq": with_(INGESTED, select="SELECT count(DISTINCT batch_id) AS n FROM ingested"),
    "m_sent": with_(OUTBOUND, select="SELECT topic, count(*) AS n FROM outbound WHERE NOT refused GROUP BY topic"),
    "m_producer_errors": with_(OUTBOUND, select="SELECT topic, count(*) AS n FROM outbound WHERE refused GROUP BY topic"),
    "m_produce_duration": histogram("outbound", "NOT refused", OUTBOUND),
    "m_attrs": with_(
        OUTBOUND,
        select=f"SELECT count(*) AS n, {attributes(**SEND)} AS attributes_text FROM outbound WHERE NOT refused GROUP BY topic",
    ),
    "m_report": REPORT,
    "stream_ingest_counts": STREAM_COUNTS,
    "stream_route_counts": with_(
        OUTBOUND,
        select="""SELECT topic, count(*) AS n, count(key_hex) AS n_keys,
  CAST(sum(CASE WHEN headers_text = '' THEN 0 ELSE 2 END) AS BIGINT) AS n_headers FROM outbound GROUP BY topic""",
    ),
    "stream_running_counts": with_(
        INGESTED, select="SELECT topic, status, count(*) AS n FROM ingested GROUP BY topic, status"
    ),
    "stream_produce_failures": with_(
        OUTCOMES,
        select="""SELECT CASE WHEN status <> 'ok' THEN event_id END AS event_id,
  CASE WHEN status = 'ok' THEN kafka_topic ELSE topic END AS topic, status, error,
  CASE WHEN status = 'ok' THEN key_hex END AS key_hex, value_hex FROM outcomes WHERE status <> 'ignored'""",
    ),
    "stream_progress": with_(
        INGESTED,
        select="""SELECT 'polled' AS what, count(*) AS n FROM ingested
UNION ALL SELECT 'delivered', count(*) FROM ingested WHERE status = 'ok'
UNION ALL SELECT 'failed', count(*) FROM ingested WHERE status <> 'ok'
UNION ALL SELECT 'undecoded', 0""",
    ),
    "stream_positions": with_(
        INGESTED,
        POLLS,
        select="""SELECT topic, part, CAST(max(off) + 1 AS BIGINT) AS n FROM ingested WHERE status = 'ok' GROUP BY topic, part
UNION ALL SELECT 'commits', NULL, count(DISTINCT poll) FROM polled JOIN ingested USING (event_id) WHERE status = 'ok'""",
    ),
    "stream_lag": with_(
        REC,
        POSITIONS,
        POLLS,
        select="""SELECT p.poll, w.topic, w.part,
  CAST(coalesce(greatest(high_watermark - last - 1, 0), 0) AS DOUBLE) AS lag
FROM watermarks w CROSS JOIN (SELECT DISTINCT poll FROM polled) p
LEFT JOIN (SELECT poll, topic, part, max(off) AS last FROM polled GROUP BY ALL) l
  ON l.poll = p.poll AND l.topic = w.topic AND l.part = w.part""",
    ),
    "stream_dlq_refused": with_(
        INGESTED,
        select="""SELECT topic, part, CAST(max(off) + 1 AS BIGINT) AS n FROM ingested
WHERE status = 'ok' OR part <> 1 GROUP BY topic, part
UNION ALL SELECT 'app.dlq', NULL, count(*) FROM ingested WHERE status <> 'ok' AND part <> 1""",
    ),
    "stream_sent": with_(
        OUTBOUND,
        """
answered AS (SELECT topic, coalesce(key_hex LIKE '%37', false) AS no FROM outbound)""",
        select="""SELECT what, topic, count(*) AS n FROM answered, (VALUES ('sent'), ('timed'), ('arrived')) v(what)
WHERE NOT no GROUP BY what, topic
UNION ALL SELECT 'errors', topic, count(*) FROM answered WHERE no GROUP BY topic""",
    ),
    "stream_durations": histogram("ingested", "status IN ('ok', 'handler_error')", INGESTED),
    "stream_replayed": with_(
        OUTBOUND,
        select="SELECT topic, key_hex, value_hex, headers_text FROM outbound WHERE topic IN ('shop.purchases', 'meters', 'nobody')",
    ),
    "stream_python_handler": with_(INGESTED, select="SELECT event_id, status, error FROM ingested"),
    "stream_restart": with_(OUTBOUND, select="SELECT topic, key_hex, value_hex, headers_text FROM outbound"),
    "stream_bridge": with_(
        INGESTED,
        BRIDGED,
        STRICT_BRIDGE,
        select="""SELECT topic, key_hex, value_hex, headers_text FROM strict_sent
UNION ALL SELECT 'app.dlq', key_hex, value_hex, headers_text FROM strict_dead""",
    ),
    "bridge_dlq": with_(
        INGESTED,
        BRIDGED,
        STRICT_BRIDGE,
        select="""SELECT event_id, 'app.dlq' AS topic, key_hex, value_hex,
  headers_text || '|dlq-timestamp=' || hex(encode('2026-01-02T03:04:05Z')) AS headers_text FROM strict_dead""",
    ),
    "bridge_positions": with_(
        INGESTED,
        BRIDGED,
        STRICT_BRIDGE,
        select="""SELECT topic, part, CAST(max(off) + 1 AS BIGINT) AS next_offset FROM strict
WHERE status = 'ok' GROUP BY topic, part""",
    ),
    "bridge_counts": with_(
        INGESTED,
        BRIDGED,
        select="""SELECT source_topic, kafka_topic, status, count(*) AS n, count(key_text) AS n_keys
FROM bridged GROUP BY source_topic, kafka_topic, status""",
    ),
    "bridge_records": with_(
        INGESTED,
        BRIDGED,
        select="""SELECT event_id, kafka_topic AS topic, hex(encode(key_text)) AS key_hex,
  CASE kind WHEN 'json' THEN hex(encode(json_text)) WHEN 'string' THEN hex(encode(text)) END AS value_hex,
  coalesce(out_headers, '') AS headers_text FROM bridged WHERE status = 'ok'""",
    ),
}
