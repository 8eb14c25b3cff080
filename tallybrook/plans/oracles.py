"""The registered queries as plain SQL over the test tables, for a second engine to check."""

_CONTENT = """
content AS (
  SELECT p_partkey AS id, concat('part-', CAST(p_partkey AS VARCHAR)) AS slug, p_name AS title,
    CASE p_partkey % 3 WHEN 0 THEN 'podcast' WHEN 1 THEN 'newsletter' ELSE 'video' END AS content_type,
    CASE WHEN p_partkey % 3 = 1 THEN CAST(NULL AS INT) ELSE p_size * 60 END AS length_seconds,
    CAST(DATE '2023-01-01' + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) AS publish_ts
  FROM part)"""

_EVENTS = """
engagement_events AS (
  SELECT event_id AS id,
    CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS content_id,
    CASE WHEN event_id % 20 = 0 THEN NULL ELSE user_id END AS user_id,
    CASE event_type WHEN 'view' THEN 'play' WHEN 'signup' THEN 'pause'
      WHEN 'purchase' THEN 'finish' WHEN 'click' THEN 'click' END AS event_type,
    ts AS event_ts,
    CASE WHEN event_type = 'click' THEN NULL ELSE CAST(round(value * 1000) AS INT) END AS duration_ms,
    CASE event_id % 6 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' WHEN 2 THEN 'web-chrome'
      WHEN 3 THEN 'web-safari' WHEN 4 THEN 'web-edge' END AS device,
    props AS raw_payload, ts + to_minutes(event_id % 7) AS updated_at
  FROM events)"""

_ENRICHED = """
measured AS (
  SELECT e.*, c.content_type, c.length_seconds,
    CAST(e.duration_ms AS DOUBLE) / CAST(1000 AS DOUBLE) AS engagement_seconds,
    CASE WHEN c.length_seconds > 0 THEN
      (CAST(e.duration_ms AS BIGINT) * 20 + c.length_seconds) // (CAST(c.length_seconds AS BIGINT) * 2) END AS pct
  FROM engagement_events e LEFT JOIN content c ON e.content_id = c.id),
enriched AS (
  SELECT id, content_id, user_id, event_type, event_ts, duration_ms, device, content_type, length_seconds,
    engagement_seconds, CAST(pct AS DOUBLE) / CAST(100 AS DOUBLE) AS engagement_pct
  FROM measured)"""

_METRICS = """
joined AS (
  SELECT c.id AS cid, c.slug, c.title, c.content_type AS ctype, c.length_seconds AS clength, c.publish_ts, e.*
  FROM content c LEFT JOIN engagement_events e ON c.id = e.content_id),
exported AS (
  SELECT cid AS content_id, slug AS content_slug, title AS content_title, ctype AS content_type,
    clength AS content_length_seconds, publish_ts AS content_publish_ts,
    count(id) AS total_events,
    count(CASE WHEN event_type = 'play' THEN 1 END) AS play_count,
    count(CASE WHEN event_type = 'pause' THEN 1 END) AS pause_count,
    count(CASE WHEN event_type = 'finish' THEN 1 END) AS finish_count,
    count(CASE WHEN event_type = 'click' THEN 1 END) AS click_count,
    CAST(sum(duration_ms) AS BIGINT) AS total_duration_ms,
    avg(duration_ms) AS avg_duration_ms,
    max(event_ts) AS last_event_ts, min(event_ts) AS first_event_ts,
    count({users}) AS unique_users,
    CASE WHEN count(CASE WHEN event_type = 'play' THEN 1 END) > 0
      THEN CAST(count(CASE WHEN event_type = 'finish' THEN 1 END) AS DOUBLE)
        / CAST(count(CASE WHEN event_type = 'play' THEN 1 END) AS DOUBLE)
      ELSE CAST(0 AS DOUBLE) END AS completion_rate
  FROM joined GROUP BY cid, slug, title, ctype, clength, publish_ts),
metrics AS (
  SELECT *, total_events * CAST(0.3 AS DOUBLE) + unique_users * CAST(0.4 AS DOUBLE)
    + completion_rate * CAST(100 AS DOUBLE) * CAST(0.3 AS DOUBLE) AS engagement_score
  FROM exported)"""

_DAILY = """
daily AS (
  SELECT c.id AS content_id, c.slug AS content_slug, c.title AS content_title,
    c.content_type AS content_type, c.length_seconds AS length_seconds, m.event_type,
    CAST(m.event_ts AS DATE) AS event_date, count(m.id) AS events_count,
    CAST(sum(m.duration_ms) AS BIGINT) AS total_duration_ms, avg(m.duration_ms) AS avg_duration_ms,
    count(m.user_id) AS unique_users,
    avg(m.duration_ms) / CAST(1000 AS DOUBLE) AS avg_engagement_seconds,
    avg(m.pct) / CAST(100 AS DOUBLE) AS avg_engagement_pct
  FROM content c JOIN measured m ON c.id = m.content_id
  WHERE m.event_ts IS NOT NULL
  GROUP BY c.id, c.slug, c.title, c.content_type, c.length_seconds, m.event_type, CAST(m.event_ts AS DATE))"""

_TYPES = """
types AS (
  SELECT c.content_type, {items} AS total_content_items, count(e.id) AS total_events,
    count(CASE WHEN e.event_type = 'play' THEN 1 END) AS total_plays,
    count(CASE WHEN e.event_type = 'finish' THEN 1 END) AS total_finishes,
    avg(e.duration_ms) AS avg_duration_ms, count(e.user_id) AS total_unique_users
  FROM content c LEFT JOIN engagement_events e ON c.id = e.content_id GROUP BY c.content_type),
type_analysis AS (
  SELECT *, CAST(total_events AS DOUBLE) / total_content_items AS avg_events_per_content,
    CASE WHEN total_plays > 0 THEN CAST(total_finishes AS DOUBLE) / total_plays
      ELSE CAST(0 AS DOUBLE) END AS completion_rate
  FROM types)"""

_DEVICES = """
devices AS (
  SELECT device, count(*) AS total_events,
    count(CASE WHEN event_type = 'play' THEN 1 END) AS play_count,
    count(CASE WHEN event_type = 'finish' THEN 1 END) AS finish_count,
    avg(duration_ms) AS avg_duration_ms, count(user_id) AS unique_users,
    CASE WHEN count(CASE WHEN event_type = 'play' THEN 1 END) > 0
      THEN CAST(count(CASE WHEN event_type = 'finish' THEN 1 END) AS DOUBLE)
        / count(CASE WHEN event_type = 'play' THEN 1 END)
      ELSE CAST(0 AS DOUBLE) END AS completion_rate
  FROM engagement_events GROUP BY device)"""

_SUMMARY = """
summary AS (
  SELECT coalesce(CAST(avg(total_events) AS DECIMAL(10,2)), CAST(0 AS DECIMAL(10,2))) AS avg_events,
    coalesce(CAST(avg(engagement_score) AS DECIMAL(10,2)), CAST(0 AS DECIMAL(10,2))) AS avg_engagement_score,
    coalesce(CAST(sum(total_events) AS BIGINT), 0) AS total_events
  FROM metrics)"""

_COUNTS = """
table_counts AS (
  SELECT 'content_engagement_metrics' AS table_name, count(*) AS n FROM metrics
  UNION ALL SELECT 'content_type_analysis', count(*) FROM type_analysis
  UNION ALL SELECT 'device_analysis', count(*) FROM devices)"""

_STATS = """
stats AS (
  SELECT 'stats:total_events' AS key, count(*) AS n FROM engagement_events
  UNION ALL
  SELECT concat('stats:events:', coalesce(event_type, 'None')), count(*) FROM engagement_events GROUP BY event_type)"""

_RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY id DESC) AS by_content,
    row_number() OVER (PARTITION BY event_type ORDER BY id DESC) AS by_type
  FROM {source})"""


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


_RECORD = f"""json_object('id', id, 'content_id', CAST(content_id AS VARCHAR), 'user_id', CAST(user_id AS VARCHAR),
    'event_type', event_type, 'event_ts', {_iso('event_ts')}, 'duration_ms', duration_ms, 'device', device,
    'content_type', content_type, 'length_seconds', length_seconds,
    'engagement_seconds', engagement_seconds, 'engagement_pct', engagement_pct)"""

_RECORDS = f"records AS (SELECT *, {_RECORD} AS record FROM ranked)"

_VIEW = f"""
newest_content AS (
  SELECT *, json_object('id', CAST(id AS VARCHAR), 'slug', slug, 'title', title, 'content_type', content_type,
    'length_seconds', length_seconds, 'publish_ts', {_iso('publish_ts')}) AS record
  FROM content ORDER BY publish_ts DESC, id LIMIT 50),
newest_events AS (
  SELECT *, json_object('id', id, 'content_id', CAST(content_id AS VARCHAR), 'event_type', event_type,
    'event_ts', {_iso('event_ts')}, 'duration_ms', duration_ms, 'device', device) AS record
  FROM engagement_events ORDER BY event_ts DESC, id LIMIT 20),
keyed AS (
  SELECT 'content' AS family, 'content:' || id AS key, CAST(record AS VARCHAR) AS value FROM newest_content
  UNION ALL SELECT 'content_list', 'content:list',
    '[' || string_agg(CAST(record AS VARCHAR), ',' ORDER BY publish_ts DESC, id) || ']' FROM newest_content
  UNION ALL SELECT 'content_list', 'content:count', CAST(count(*) AS VARCHAR) FROM newest_content
  UNION ALL SELECT 'stats', key, CAST(n AS VARCHAR) FROM stats
  UNION ALL SELECT 'stats', 'engagement:recent',
    '[' || string_agg(CAST(record AS VARCHAR), ',' ORDER BY event_ts DESC, id) || ']' FROM newest_events
  UNION ALL SELECT 'analysis', 'analysis:' || table_name || ':count', CAST(n AS VARCHAR) FROM table_counts
  UNION ALL SELECT 'analysis', 'analysis:metrics:summary',
    CAST(json_object('avg_events', CAST(avg_events AS DOUBLE), 'avg_engagement_score',
      CAST(avg_engagement_score AS DOUBLE), 'total_events', total_events) AS VARCHAR) FROM summary
  UNION ALL SELECT 'cache', 'cache:last_update', '2024-02-01T00:00:00.000000+00:00'
  UNION ALL SELECT 'event', 'event:' || id, CAST(record AS VARCHAR) FROM records
  UNION ALL SELECT 'content_events', 'content:' || content_id || ':events',
    '[' || string_agg(CAST(record AS VARCHAR), ',' ORDER BY id DESC) || ']'
    FROM records WHERE content_id IS NOT NULL AND by_content <= 100 GROUP BY content_id
  UNION ALL SELECT 'type_events', 'events:' || coalesce(event_type, 'None'),
    '[' || string_agg(CAST(record AS VARCHAR), ',' ORDER BY id DESC) || ']'
    FROM records WHERE by_type <= 1000 GROUP BY event_type)"""

_CHANGED = """
changed AS (
  SELECT CASE WHEN event_type = 'finish' THEN id + 10000000000 ELSE id END AS id, content_id, user_id, event_type,
    event_ts, CASE WHEN event_type IN ('play', 'pause') THEN duration_ms * 2 ELSE duration_ms END AS duration_ms,
    device, raw_payload,
    CASE event_type WHEN 'play' THEN updated_at + INTERVAL 1 DAY WHEN 'pause' THEN updated_at - INTERVAL 1 DAY
      ELSE updated_at END AS updated_at
  FROM engagement_events WHERE event_type IS NOT NULL)"""

_INCOMING = """
incoming AS (
  SELECT p_partkey + 10000000000 AS id, 'part-' || (p_partkey // 2 * 3) AS slug, p_name AS title FROM part),
inserted AS (
  SELECT * FROM incoming i
  WHERE i.slug NOT IN (SELECT slug FROM content)
  QUALIFY row_number() OVER (PARTITION BY slug ORDER BY id) = 1)"""

_FAULTY = """
faulty_content AS (
  SELECT p_partkey AS id, replace(p_name, ' ', '-') AS slug, CASE WHEN p_size > 5 THEN p_name END AS title,
    lower(p_type) AS content_type FROM part),
faulty_events AS (
  SELECT event_id AS id, CASE WHEN event_type <> 'click' THEN event_type END AS event_type,
    CASE WHEN event_type <> 'error' THEN ts END AS event_ts,
    CASE WHEN value > 1.0 THEN ts END AS updated_at, user_id AS session_id FROM events)"""

_SOURCES = (_CONTENT, _EVENTS)
_USERS = _METRICS.format(users="user_id")
_ALL_TYPES = _TYPES.format(items="count(c.id)")
_RING_COLUMNS = "id, content_id, event_type, event_ts, duration_ms"


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + then


def _over_sources(then: str, *parts: str) -> str:
    return _with(*_SOURCES, *parts, then=then)


BATCH_SQL = {
    "enriched_events": _over_sources("SELECT * FROM enriched", _ENRICHED),
    "content_engagement_metrics": _over_sources("SELECT * FROM metrics", _USERS),
    "content_engagement_metrics_distinct": _over_sources(
        "SELECT * FROM metrics", _METRICS.format(users="DISTINCT user_id")
    ),
    "content_engagement_daily": _over_sources("SELECT * FROM daily", _ENRICHED, _DAILY),
    "content_engagement_daily_export": _over_sources(
        """
        SELECT c.id AS content_id, c.slug AS content_slug, c.title AS content_title, c.content_type,
          CAST(e.event_ts AS DATE) AS event_date, count(e.id) AS events_count,
          count(CASE WHEN e.event_type = 'play' THEN 1 END) AS play_count,
          count(CASE WHEN e.event_type = 'finish' THEN 1 END) AS finish_count,
          CAST(sum(e.duration_ms) AS BIGINT) AS total_duration_ms, count(e.user_id) AS unique_users
        FROM content c JOIN engagement_events e ON c.id = e.content_id
        GROUP BY c.id, c.slug, c.title, c.content_type, CAST(e.event_ts AS DATE)
        """
    ),
    "content_metrics_export": _over_sources("SELECT * FROM exported", _USERS),
    "content_type_analysis": _over_sources("SELECT * FROM type_analysis", _ALL_TYPES),
    "content_type_analysis_corrected": _over_sources(
        "SELECT * FROM type_analysis", _TYPES.format(items="count(DISTINCT c.id)")
    ),
    "device_analysis": _over_sources("SELECT * FROM devices", _DEVICES),
    "content_by_type": _over_sources("SELECT content_type, count(*) AS n FROM content GROUP BY content_type"),
    "events_by_type": _over_sources("SELECT event_type, count(*) AS n FROM engagement_events GROUP BY event_type"),
    "first_content": _over_sources("SELECT * FROM content ORDER BY id LIMIT 10"),
    "recent_content": _over_sources("SELECT * FROM content ORDER BY publish_ts DESC, id LIMIT 50"),
    "recent_events": _over_sources(
        "SELECT id, content_id, event_type, event_ts, duration_ms, device"
        " FROM engagement_events ORDER BY event_ts DESC, id LIMIT 20"
    ),
    "latest_ten_events": _over_sources(
        "SELECT * FROM engagement_events ORDER BY event_ts DESC, id LIMIT 10"
    ),
    "latest_events_per_content": _over_sources(
        f"SELECT {_RING_COLUMNS}, CAST(by_content AS INT) AS rank FROM ranked"
        " WHERE content_id IS NOT NULL AND by_content <= 100",
        _RANKED.format(source="engagement_events"),
    ),
    "latest_events_per_type": _over_sources(
        f"SELECT {_RING_COLUMNS}, CAST(by_type AS INT) AS rank FROM ranked WHERE by_type <= 1000",
        _RANKED.format(source="engagement_events"),
    ),
    "ring_head": _over_sources(
        f"SELECT {_RING_COLUMNS}, CAST(by_content AS INT) AS rank FROM ranked"
        " WHERE content_id IS NOT NULL AND by_content <= 11",
        _RANKED.format(source="engagement_events"),
    ),
    "metrics_summary": _over_sources("SELECT * FROM summary", _USERS, _SUMMARY),
    "metrics_by_events": _over_sources("SELECT * FROM metrics ORDER BY total_events DESC", _USERS),
    "todays_daily_by_events": _over_sources(
        "SELECT * FROM daily WHERE event_date = DATE '2024-01-15' ORDER BY events_count DESC", _ENRICHED, _DAILY
    ),
    "analysis_table_counts": _over_sources(
        "SELECT * FROM table_counts", _USERS, _ALL_TYPES, _DEVICES, _COUNTS
    ),
    "event_stats": _over_sources("SELECT * FROM stats", _STATS),
    "serving_view": _over_sources(
        """
        SELECT family, key, value, 3600 AS ttl_seconds, TIMESTAMP '2024-02-01 00:00:00' AS written_at,
          TIMESTAMP '2024-02-01 01:00:00' AS expires_at
        FROM keyed
        """,
        _ENRICHED, _USERS, _ALL_TYPES, _DEVICES, _SUMMARY, _COUNTS, _STATS,
        _RANKED.format(source="enriched"), _RECORDS, _VIEW,
    ),
    "serving_keys": _over_sources(
        "SELECT split_part(key, ':', 1) AS family, count(DISTINCT key) AS n_keys FROM keyed GROUP BY 1",
        _ENRICHED, _USERS, _ALL_TYPES, _DEVICES, _SUMMARY, _COUNTS, _STATS,
        _RANKED.format(source="enriched"), _RECORDS, _VIEW,
    ),
    "serving_lookup": _over_sources(
        "SELECT 'event:' || id AS key, CAST(record AS VARCHAR) AS value, 3600 AS ttl_seconds FROM records WHERE id = 76",
        _ENRICHED, _RANKED.format(source="enriched"), _RECORDS,
    ),
    "incremental_by_id": _over_sources("SELECT * FROM enriched WHERE id > 0 ORDER BY id LIMIT 1000", _ENRICHED),
    "incremental_by_updated_at": _over_sources(
        """
        SELECT e.id, CAST(e.content_id AS VARCHAR) AS content_id, CAST(e.user_id AS VARCHAR) AS user_id,
          e.event_type, e.event_ts, e.duration_ms, e.device, e.raw_payload, e.updated_at, c.slug AS content_slug, c.title AS content_title, c.content_type
        FROM engagement_events e LEFT JOIN content c ON e.content_id = c.id
        """
    ),
    "content_insert_if_absent": _with(_CONTENT, _INCOMING, then="SELECT * FROM inserted"),
    "events_insert_serial": _over_sources(
        """
        SELECT (SELECT max(id) FROM engagement_events)
            + row_number() OVER (ORDER BY substr(md5(slug), 1, 3), slug) AS id, slug, title
        FROM inserted
        """,
        _INCOMING,
    ),
    "events_upsert": _over_sources(
        """
        SELECT e.id, e.content_id, e.user_id, e.event_type, e.event_ts,
          CASE WHEN e.event_type = 'play' THEN e.duration_ms * 2 ELSE e.duration_ms END AS duration_ms,
          e.device, e.raw_payload,
          CASE WHEN e.event_type IN ('play', 'click') THEN TIMESTAMP '2024-03-01 00:00:00'
            ELSE e.updated_at END AS updated_at
        FROM engagement_events e
        UNION ALL SELECT * FROM changed WHERE event_type = 'finish'
        """,
        _CHANGED,
    ),
    "apply_change_feed": _over_sources(
        """
        SELECT e.* FROM engagement_events e WHERE e.id NOT IN (SELECT id FROM changed)
        UNION ALL SELECT * FROM changed WHERE event_type <> 'pause'
        """,
        _CHANGED,
    ),
    "cascade_delete_events": _over_sources(
        """
        SELECT * FROM engagement_events WHERE content_id IS NULL
          OR content_id NOT IN (SELECT id FROM content WHERE content_type = 'newsletter')
        """
    ),
    "quality_orphans": _over_sources(
        """
        SELECT id, content_id FROM engagement_events WHERE content_id IS NOT NULL
          AND content_id NOT IN (SELECT id FROM content WHERE content_type <> 'newsletter')
        """
    ),
    "quality_domain": _with(
        _FAULTY,
        then="""
        SELECT 'content' AS table_name, CAST(id AS VARCHAR) AS row_id, 'content_type' AS column_name,
          content_type AS bad_value FROM faulty_content
        WHERE content_type NOT IN ('podcast', 'newsletter', 'video')
        UNION ALL
        SELECT 'engagement_events', CAST(id AS VARCHAR), 'event_type', event_type FROM faulty_events
        WHERE event_type NOT IN ('play', 'pause', 'finish', 'click')
        """,
    ),
    "quality_nulls": _with(
        _FAULTY,
        then="""
        SELECT 'content' AS table_name, CAST(id AS VARCHAR) AS row_id, 'slug' AS column_name
        FROM faulty_content WHERE slug IS NULL
        UNION ALL SELECT 'content', CAST(id AS VARCHAR), 'title' FROM faulty_content WHERE title IS NULL
        UNION ALL SELECT 'engagement_events', CAST(id AS VARCHAR), 'event_ts' FROM faulty_events WHERE event_ts IS NULL
        UNION ALL SELECT 'engagement_events', CAST(id AS VARCHAR), 'updated_at' FROM faulty_events WHERE updated_at IS NULL
        """,
    ),
    "quality_duplicates": _with(
        _FAULTY,
        then="""
        SELECT 'content' AS table_name, 'id' AS key_column, CAST(id AS VARCHAR) AS key_value, count(*) AS n_rows
        FROM faulty_content GROUP BY id HAVING count(*) > 1
        UNION ALL SELECT 'content', 'slug', slug, count(*) FROM faulty_content GROUP BY slug HAVING count(*) > 1
        UNION ALL SELECT 'engagement_events', 'id', CAST(id AS VARCHAR), count(*) FROM faulty_events
        GROUP BY id HAVING count(*) > 1
        UNION ALL SELECT 'engagement_events', 'session_id', CAST(session_id AS VARCHAR), count(*) FROM faulty_events
        WHERE session_id IS NOT NULL GROUP BY session_id HAVING count(*) > 1
        """,
    ),
    "quality_split": _with(
        _FAULTY,
        then="""
        SELECT CASE WHEN event_type NOT IN ('play', 'pause', 'finish', 'click') THEN 'event_type not allowed'
          WHEN event_ts IS NULL THEN 'event_ts missing' WHEN updated_at IS NULL THEN 'updated_at missing'
          ELSE 'valid' END AS reason, count(*) AS n
        FROM faulty_events GROUP BY 1
        """,
    ),
    "payload_join_by_slug": _over_sources(
        """
        SELECT c.id AS content_id, p.event_type, p.duration_ms, p.device,
          CAST(json_extract_string(p.raw_payload, '$.k') AS INT) AS k
        FROM (
          SELECT 'part-' || json_extract_string(raw_payload, '$.k') AS slug, event_type, duration_ms, device, raw_payload
          FROM engagement_events
          UNION ALL SELECT * FROM (VALUES
            ('part-7', 'play', 300000, 'ios', '{"k": 7}'),
            ('part-7', 'finish', 1800000, 'ios', '{"k": 7}'),
            ('part-9', 'click', NULL, 'web-edge', '{"k": 9}'),
            ('part-none', 'click', NULL, 'web-edge', '{"k": 0}')) v
        ) p JOIN content c ON c.slug = p.slug
        """
    ),
}

STREAM_SQL = {
    "stream_enrich": BATCH_SQL["enriched_events"],
    "stream_rings": _over_sources(
        """
        SELECT 'content_id' AS ring, id, content_id, event_type, engagement_pct, CAST(by_content AS INT) AS rank
        FROM ranked WHERE content_id IS NOT NULL AND by_content <= 100
        UNION ALL
        SELECT 'event_type', id, content_id, event_type, engagement_pct, CAST(by_type AS INT)
        FROM ranked WHERE by_type <= 1000
        """,
        _ENRICHED, _RANKED.format(source="enriched"),
    ),
    "stream_totals": _over_sources(
        """
        SELECT count(*) AS total_events, max(id) AS latest_id,
          count(CASE WHEN id >= lo + 3 * ((hi - lo) // 4 + 1) THEN 1 END) AS event_count
        FROM engagement_events, (SELECT min(id) AS lo, max(id) AS hi FROM engagement_events)
        """
    ),
    "stream_heartbeat": _over_sources(
        """
        SELECT 'streaming:last_update' AS key, max(id) AS latest_id, 60 AS ttl_seconds,
          count(CASE WHEN id >= lo + 3 * ((hi - lo) // 4 + 1) THEN 1 END) AS event_count
        FROM engagement_events, (SELECT min(id) AS lo, max(id) AS hi FROM engagement_events)
        """
    ),
    "stream_serving_view": _over_sources(
        """
        SELECT family, key, value, 3600 AS ttl_seconds FROM keyed
        WHERE family IN ('event', 'content_events', 'type_events')
        UNION ALL
        SELECT 'streaming', 'streaming:latest_event_id', CAST(max(id) AS VARCHAR), CAST(NULL AS INT)
        FROM engagement_events
        UNION ALL
        SELECT 'streaming', 'streaming:total_events', CAST(count(*) AS VARCHAR), CAST(NULL AS INT)
        FROM engagement_events
        """,
        _ENRICHED, _USERS, _ALL_TYPES, _DEVICES, _SUMMARY, _COUNTS, _STATS,
        _RANKED.format(source="enriched"), _RECORDS, _VIEW,
    ),
    "stream_window_5m": _over_sources(
        """
        SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
          time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end,
          event_type, count(*) AS n_events, CAST(sum(duration_ms) AS BIGINT) AS total_duration_ms
        FROM engagement_events
        GROUP BY 1, 2, 3
        """
    ),
    "stream_window_late": _over_sources(
        """
        SELECT window_start, event_type, count(CASE WHEN NOT late THEN 1 END) AS n_events, count(CASE WHEN late THEN 1 END) AS n_late
        FROM (
          SELECT time_bucket(INTERVAL 5 MINUTE, e.event_ts) AS window_start, e.event_type,
            coalesce(time_bucket(INTERVAL 5 MINUTE, e.event_ts) + INTERVAL 5 MINUTE <= w.newest - INTERVAL 10 MINUTE, false) AS late
          FROM engagement_events e
          JOIN (SELECT t.turn, max(o.event_ts) AS newest FROM (SELECT DISTINCT id % 4 AS turn FROM engagement_events) t
                LEFT JOIN engagement_events o ON o.id % 4 < t.turn GROUP BY t.turn) w ON w.turn = e.id % 4)
        GROUP BY 1, 2
        """
    ),
    "stream_parse_envelope": _over_sources(
        """
        SELECT CAST(content_id AS VARCHAR) AS kafka_key, event_ts, event_ts AS kafka_timestamp, CAST(id % 4 AS INT) AS partition, id // 4 AS "offset",
          id, content_id, user_id, event_type, duration_ms, device, raw_payload
        FROM engagement_events
        WHERE event_type IS NOT NULL AND id % 11 <> 5 AND id % 13 <> 6 AND id % 17 <> 7 AND id % 19 <> 8
        """
    ),
    "stream_quarantine": _over_sources(
        """
        SELECT CAST(content_id AS VARCHAR) AS kafka_key, event_ts AS kafka_timestamp,
          CAST(id % 4 AS INT) AS partition, id // 4 AS "offset",
          CASE WHEN event_type IS NULL THEN 'error at ' || coalesce(device, 'no device')
            WHEN id % 11 = 5 THEN '{"id":' || id || ',"event_ts":"2024-01-01","duration_ms":"soon"}'
            WHEN id % 13 = 6 THEN '{"id":' || id || ',"event_ts":"never","duration_ms":2.5}'
            WHEN id % 17 = 7 THEN '{"device":"' || id || '"}'
            ELSE '{"id":' || id || ',"event_ts":"2024' END AS json_value,
          CASE WHEN event_type IS NULL THEN 'body: no JSON object'
            WHEN id % 11 = 5 THEN 'duration_ms: not int'
            WHEN id % 13 = 6 THEN 'event_ts: not timestamp; duration_ms: not int'
            WHEN id % 17 = 7 THEN 'id: missing; event_ts: missing'
            ELSE 'body: no JSON object' END AS fault
        FROM engagement_events
        WHERE event_type IS NULL OR id % 11 = 5 OR id % 13 = 6 OR id % 17 = 7 OR id % 19 = 8
        """
    ),
    "poll_updated_at": _over_sources(
        """
        SELECT e.*, c.slug AS content_slug, c.title AS content_title, c.content_type
        FROM engagement_events e LEFT JOIN content c ON e.content_id = c.id
        """
    ),
    "poll_by_id": BATCH_SQL["enriched_events"],
    "partitioned_export": _over_sources(
        """
        SELECT e.*, c.slug AS content_slug, c.title AS content_title, c.content_type,
          CAST(strftime(e.event_ts, '%Y%m') AS INT) AS event_month
        FROM engagement_events e LEFT JOIN content c ON e.content_id = c.id
        """
    ),
}
STREAM_SQL["stream_compacted"] = STREAM_SQL["stream_serving_view"]
BATCH_SQL["users_by_range"] = _over_sources(
    """
    SELECT r.first_day, r.last_day, e.event_type, count(DISTINCT e.user_id) AS unique_users, TRUE AS sketch_is_near
    FROM engagement_events e JOIN (VALUES (DATE '2024-01-01', DATE '2024-01-31'), (DATE '2024-01-08', DATE '2024-01-14'),
      (DATE '2024-01-15', DATE '2024-01-15')) r(first_day, last_day)
      ON CAST(e.event_ts AS DATE) BETWEEN r.first_day AND r.last_day
    WHERE e.user_id IS NOT NULL GROUP BY ALL
    """
)
BATCH_SQL["payload_fields"] = _over_sources(
    "SELECT id, CAST(json_extract_string(raw_payload, '$.k') AS BIGINT) AS k FROM engagement_events"
)
BATCH_SQL["typed_tables"] = _over_sources(
    """
    SELECT e.id, e.content_id, e.user_id, e.event_type, e.event_ts, e.duration_ms, coalesce(e.device, 'unknown') AS device,
      e.raw_payload, CASE WHEN e.device IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE e.updated_at END AS updated_at
    FROM engagement_events e JOIN content c ON c.id = e.content_id
    """
)
