"""DuckDB SQL oracles for the chat plans."""

_MSG = """msgs AS (
  SELECT conv_id || '-' || turn AS message_id, conv_id || ':' || role AS connection_id,
         'room-' || conv_id AS room, CASE WHEN role = 'system' THEN 'notice' ELSE 'message' END AS type,
         turn AS ts, role
  FROM conversations),
conns AS (SELECT DISTINCT conv_id || ':' || role AS connection_id, 'room-' || conv_id AS room, role AS user_id
          FROM conversations WHERE role <> 'system')"""

_MARKS = """marks AS (
  SELECT CAST(user_id AS VARCHAR) AS connection_id, ts,
         CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN 1 ELSE 2 END AS kind,
         CASE WHEN event_type = 'signup' THEN 'room-' || json_extract_string(props, '$.k') END AS room,
         CASE WHEN event_type = 'click' THEN event_id END AS message_id
  FROM events WHERE event_type IN ('signup', 'error', 'click'))"""

SQL = {
    "chat_senders": f"""
WITH {_MSG}
SELECT m.message_id, m.room, c.user_id,
       CASE WHEN c.connection_id IS NULL THEN 'Connection not found' END AS error
FROM msgs m LEFT JOIN conns c ON c.connection_id = m.connection_id
""",
    "chat_fanout": f"""
WITH {_MSG}
SELECT m.room, m.message_id, c.connection_id AS to_connection
FROM msgs m JOIN conns s ON s.connection_id = m.connection_id
JOIN conns c ON c.room = m.room
WHERE m.type = 'message'
""",
    "chat_room_deliveries": f"""
WITH {_MSG},
mm AS (SELECT m.room, COUNT(*) AS messages FROM msgs m JOIN conns s ON s.connection_id = m.connection_id
       WHERE m.type = 'message' GROUP BY m.room),
cc AS (SELECT room, COUNT(*) AS n FROM conns GROUP BY room)
SELECT mm.room, mm.messages, COALESCE(cc.n, 0) AS connections, mm.messages * COALESCE(cc.n, 0) AS deliveries
FROM mm LEFT JOIN cc ON cc.room = mm.room
""",
    "chat_room_history": f"""
WITH {_MSG}
SELECT room, message_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT room, message_id, row_number() OVER (PARTITION BY room ORDER BY ts DESC, message_id DESC) AS rank
  FROM msgs) WHERE rank <= 3
""",
    "chat_presence": f"""
WITH {_MARKS},
seen AS (SELECT * FROM marks WHERE kind < 2 AND ts <= TIMESTAMP '2024-01-31 00:00:00'),
per AS (SELECT connection_id,
               arg_max(ts, (ts, kind)) FILTER (WHERE kind = 0) AS cts,
               arg_max(room, (ts, kind)) FILTER (WHERE kind = 0) AS croom,
               max(ts) FILTER (WHERE kind = 1) AS dts
        FROM seen GROUP BY connection_id)
SELECT croom AS room, COUNT(*) AS active_connections FROM per
WHERE cts IS NOT NULL AND cts + INTERVAL 24 HOUR > TIMESTAMP '2024-01-31 00:00:00'
  AND (dts IS NULL OR dts < cts)
GROUP BY croom
""",
    "chat_room_users": f"""
WITH {_MARKS},
seen AS (SELECT * FROM marks WHERE kind < 2 AND ts <= TIMESTAMP '2024-01-31 00:00:00'),
per AS (SELECT connection_id, arg_max(ts, (ts, kind)) FILTER (WHERE kind = 0) AS cts,
               arg_max(room, (ts, kind)) FILTER (WHERE kind = 0) AS croom, max(ts) FILTER (WHERE kind = 1) AS dts
        FROM seen GROUP BY connection_id)
SELECT croom AS room, connection_id AS user_id, strftime(cts, '%Y-%m-%dT%H:%M:%S.%f') AS since FROM per
WHERE cts IS NOT NULL AND cts + INTERVAL 24 HOUR > TIMESTAMP '2024-01-31 00:00:00' AND (dts IS NULL OR dts < cts)
""",
    "chat_message_rows": """
SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(user_id AS VARCHAR) AS connection_id,
       CASE event_id % 4 WHEN 0 THEN 'default' WHEN 1 THEN NULL ELSE 'r' END AS room, 'message' AS type,
       event_type AS message, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at,
       CAST(floor(epoch(ts)) AS BIGINT) + 604800 AS ttl
FROM events
""",
    "chat_membership": f"""
WITH {_MARKS},
w AS (SELECT *,
        last_value(CASE WHEN kind = 0 THEN ts END IGNORE NULLS) OVER win AS cts,
        last_value(CASE WHEN kind = 0 THEN room END IGNORE NULLS) OVER win AS croom,
        last_value(CASE WHEN kind = 1 THEN ts END IGNORE NULLS) OVER win AS dts
      FROM marks
      WINDOW win AS (PARTITION BY connection_id ORDER BY ts, kind, message_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT message_id, connection_id,
       CASE WHEN cts IS NOT NULL AND (dts IS NULL OR dts < cts) AND ts < cts + INTERVAL 24 HOUR
            THEN croom END AS room
FROM w WHERE kind = 2
""",
}
