"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

from tidelog.plans import inputs, queries

_LEVEL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in inputs.EVENT_LEVELS.items()) + " END"

_LOGS = f"""
logs AS (
  SELECT 'output' || (user_id % 12 + 1) || '.log' AS file_name, event_id AS pos,
         strftime(ts, '%H:%M:%S.%g') AS clock, {_LEVEL} AS lvl, ts, user_id, event_type, props
  FROM events
),
lines AS (
  SELECT file_name, pos, ts, lvl, clock, props, event_type, user_id,
         clock || ' [thread-' || user_id || '] ' || format('{{:<5}}', lvl)
           || ' app.Logger - ' AS head
  FROM logs
),
plain AS (SELECT file_name, pos, ts, lvl, clock, props, user_id, head || props AS value FROM lines),
wordy AS (
  SELECT file_name, pos,
         head || chr(9) || event_type || ' - ' || props || ' ' || chr(9) || ' - ' AS value
  FROM lines
),
levelled AS (
  SELECT *, coalesce(list_filter(string_split(value, ' '),
                     lambda t: t IN ('DEBUG', 'INFO', 'WARN', 'ERROR'))[1], '') AS level
  FROM plain
),
records AS (
  SELECT pos, clock AS timestamp, level, props AS message, file_name AS filename FROM levelled
),
stored AS (
  SELECT sha256(concat_ws(chr(1), file_name, '', CAST(pos AS VARCHAR), clock, lvl, props)) AS log_id,
         file_name, clock AS timestamp, lvl AS log_type, props AS log_message, ts AS event_ts,
         pos AS src_pos
  FROM logs
)"""

# The dashboard's colour and place of each level.
_COLORS = "CASE {0} WHEN 'WARN' THEN '#f64740' WHEN 'ERROR' THEN '#c3423f' WHEN 'SEVERE' THEN '#fabc2a' " \
          "WHEN 'WARNING' THEN '#5c80bc' WHEN 'DEBUG' THEN '#1c5253' WHEN 'INFO' THEN '#453643' END"
_ORDER = "CAST(CASE {0} WHEN 'WARN' THEN 0 WHEN 'ERROR' THEN 1 WHEN 'SEVERE' THEN 2 WHEN 'WARNING' THEN 3 " \
         "WHEN 'DEBUG' THEN 4 WHEN 'INFO' THEN 5 END AS INTEGER)"


def _over_logs(body: str, more: str = "", recursive: bool = False) -> str:
    extra = f",{more}" if more else ""
    return f"WITH {'RECURSIVE ' if recursive else ''}{_LOGS}{extra}\n{body}"


# A blank is any character up to U+0020.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_DOC_LINES = """
docs AS (
  SELECT lang || '.log' AS filename, doc_id AS pos,
         '00:00:00.000 [' || source || '] INFO  app.Documents - ' || text AS value
  FROM documents
)"""


def _chain(key: str, minutes: int) -> str:
    """Openings of event-anchored windows, one recursion step per window."""
    key_list = f"{key}, " if key else ""
    same = f"s.{key} = c.{key} AND " if key else ""
    group = f"GROUP BY {key}" if key else ""
    keep = f"c.{key}, " if key else ""
    return f"""
chain AS (
  SELECT {key_list}CAST(0 AS BIGINT) AS window_idx, min(event_ts) AS window_start FROM stored {group}
  UNION ALL
  SELECT {keep}c.window_idx + 1,
         (SELECT min(event_ts) FROM stored s
          WHERE {same}s.event_ts > c.window_start + INTERVAL {minutes} MINUTE)
  FROM chain c
  WHERE EXISTS (SELECT 1 FROM stored s
                WHERE {same}s.event_ts > c.window_start + INTERVAL {minutes} MINUTE)
),
labelled AS (
  SELECT s.*, c.window_idx, c.window_start, c.window_start + INTERVAL {minutes} MINUTE AS window_end
  FROM stored s JOIN chain c
    ON {same}s.event_ts BETWEEN c.window_start AND c.window_start + INTERVAL {minutes} MINUTE
)"""


_SERIES = f"""
levels(ord, level) AS (
  VALUES (0, 'WARN'), (1, 'ERROR'), (2, 'SEVERE'), (3, 'WARNING'), (4, 'DEBUG'), (5, 'INFO')
),
series AS (
  SELECT w.window_idx, l.ord, l.level, {_COLORS.format('l.level')} AS color,
         CAST(w.window_idx AS VARCHAR) AS x,
         (SELECT count(*) FROM labelled r WHERE r.window_idx = w.window_idx AND r.log_type = l.level) AS y
  FROM (SELECT DISTINCT window_idx FROM labelled) w CROSS JOIN levels l
)"""

_ALERTS = f"""
errors AS (
  SELECT time_bucket(INTERVAL {queries.SLICE_SECONDS} SECOND, event_ts) AS window_start, log_message,
         row_number() OVER (PARTITION BY time_bucket(INTERVAL {queries.SLICE_SECONDS} SECOND, event_ts)
                            ORDER BY event_ts, file_name, src_pos) AS n
  FROM stored WHERE log_type = 'ERROR'
),
alerts AS (
  SELECT window_start, count(*) AS n_errors,
         max(CASE WHEN n = 1 THEN log_message END) AS message1,
         max(CASE WHEN n = 2 THEN log_message END) AS message2,
         max(CASE WHEN n = 3 THEN log_message END) AS message3
  FROM errors GROUP BY window_start HAVING count(*) >= 3
)"""


def _escaped(column: str) -> str:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#39;")):
        column = f"replace({column}, '{plain}', '{safe}')"
    return column


def _tod(bound: str) -> str:
    return (bound + ":00" if len(bound) == 5 else bound) + ("" if "." in bound else ".000")


_IN_DAY = f"clock BETWEEN '{_tod(queries.DAY_WINDOW[0])}' AND '{_tod(queries.DAY_WINDOW[1])}'"

_FILE_WINDOWS = "file_windows(file_name, lo, hi) AS (VALUES " + ", ".join(
    f"('output{i}.log', '{_tod(lo)}', '{_tod(hi)}')" for i, (lo, hi) in enumerate(queries.FILE_WINDOWS, 1)
) + ")"

_MARKS = """
ranked AS (
  SELECT file_name, clock, pos,
         row_number() OVER (PARTITION BY file_name ORDER BY clock DESC, pos DESC) AS n
  FROM plain WHERE clock BETWEEN '08:00:00.000' AND '12:00:00.000'
),
marks AS (SELECT file_name, clock AS last_tod, pos AS last_pos FROM ranked WHERE n = 1)"""

_ORDER_SPANS = """r AS (
  SELECT DISTINCT lo, hi FROM (
    SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY l_orderkey)
)"""

_BUCKETS = "CASE " + " ".join(
    f"WHEN value >= {lo} AND value <= {hi} THEN '{name}'" for name, lo, hi in queries.SCORE_RANGES
) + " ELSE 'other' END"

_ENVELOPE = "to_json({'timestamp': timestamp, 'level': level, 'message': message, 'filename': filename, 'pos': pos})"

_MESSAGES = f"""
good AS (SELECT *, CAST({_ENVELOPE} AS VARCHAR) AS env FROM records),
messages AS (
  SELECT *, CASE pos % 10
    WHEN 0 THEN env || ' junk'
    WHEN 1 THEN env || ', {{"a": 1}}'
    WHEN 2 THEN replace(env, '"level":', '"lvl":')
    WHEN 3 THEN regexp_replace(env, '"timestamp":"[^"]*"', '"timestamp":7')
    WHEN 4 THEN regexp_replace(env, '"filename":"[^"]*"', '"filename":null')
    WHEN 5 THEN '[' || env || ']'
    WHEN 6 THEN replace(env, '"', '''')
    WHEN 7 THEN ' ' || env || chr(10)
    ELSE env END AS value
  FROM good
)"""


def _profile(source: str, text: str, by: str, shortest: int, longest: int) -> str:
    return f"""
SELECT {by}, count(*) AS n_rows, min(length({text})) AS min_length, max(length({text})) AS max_length,
       avg(length({text})) AS avg_length,
       count(*) FILTER (WHERE length({text}) NOT BETWEEN {shortest} AND {longest}) AS n_bad_length,
       count(*) FILTER (WHERE regexp_matches({text}, '[^\\x20-\\x7E]')) AS n_bad_symbols
FROM {source} GROUP BY {by}"""


def _rate(source: str, text: str, by: str, pattern: str) -> str:
    return f"""
SELECT {by}, count(*) AS n_rows, count(*) FILTER (WHERE regexp_matches({text}, '{pattern}')) AS n_hits,
       avg(CASE WHEN regexp_matches({text}, '{pattern}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS hit_rate
FROM {source} GROUP BY {by}"""


def _holdout(start: int, stop: int, max_test: int) -> str:
    limit = f"AND m <= {max_test}" if max_test else ""
    return f"""
WITH numbered AS (
  SELECT o_custkey AS user_id, o_orderkey AS pos, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n
  FROM orders
),
counted AS (
  SELECT *, n BETWEEN {start} AND {stop} AS candidate,
         sum(CASE WHEN n BETWEEN {start} AND {stop} THEN 1 ELSE 0 END)
           OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS m
  FROM numbered
)
SELECT user_id, pos, o_totalprice, candidate {limit} AS is_test FROM counted"""


_HALF_DAY_STEPS = """
timed AS (
  SELECT file_name, pos, clock,
         CAST(substr(clock, 1, 2) AS INTEGER) * 3600 + CAST(substr(clock, 4, 2) AS INTEGER) * 60
           + CAST(substr(clock, 7, 2) AS INTEGER) AS sec
  FROM plain
),
stepped AS (
  SELECT *, CASE WHEN lag(sec) OVER (PARTITION BY file_name ORDER BY pos) - sec > 43200 THEN 1 ELSE 0 END AS step
  FROM timed
),
dated AS (
  SELECT *, sum(step) OVER (PARTITION BY file_name ORDER BY pos ROWS UNBOUNDED PRECEDING) AS days
  FROM stepped
)"""


def oracle() -> dict[str, str]:
    """SQL text by query name."""
    stored = "log_id, file_name, timestamp, log_type, log_message, event_ts, src_pos"
    return {
        "parse_level": _over_logs("SELECT pos, level FROM levelled"),
        "parse_message_tail": _over_logs(
            "SELECT pos, trim(list_filter(string_split(value, ' - '), lambda t: t <> '')[-1], "
            f"{_BLANKS}) AS message FROM wordy"
        ),
        "parse_message_full": _over_logs(
            f"SELECT pos, trim(substr(value, instr(value, ' - ') + 3), {_BLANKS}) AS message FROM wordy"
        ),
        "parse_timestamp": _over_logs(
            "SELECT pos, regexp_extract(value, '[0-9]{2}:[0-9]{2}:[0-9]{2}\\.[0-9]{3}') AS timestamp FROM plain"
        ),
        "parse_line": _over_logs("SELECT * FROM records"),
        "parse_documents": f"""
WITH {_DOC_LINES},
cut AS (
  SELECT *, trim(substr(value, instr(value, ' - ') + 3), {_BLANKS}) AS message FROM docs
)
SELECT pos, '00:00:00.000' AS timestamp, 'INFO' AS level, message, filename,
       CAST(length(message) AS INTEGER) AS n_chars
FROM cut""",
        "leading_time": _over_logs("SELECT pos, string_split(value, ' ')[1] AS tod FROM plain"),
        "instance_of_file": _over_logs(
            "SELECT file_name, CAST(replace(replace(file_name, 'output', ''), '.log', '') AS INTEGER) AS instance, "
            "count(*) AS n_lines FROM plain GROUP BY 1, 2"
        ),
        "encode_envelope": _over_logs(f"SELECT pos, CAST({_ENVELOPE} AS VARCHAR) AS value FROM records"),
        "decode_envelope": _over_logs(
            """SELECT pos AS msg_id, pos % 10 >= 7 AS valid,
       CASE WHEN pos % 10 >= 7 THEN timestamp END AS timestamp,
       CASE WHEN pos % 10 >= 7 THEN level END AS level,
       CASE WHEN pos % 10 >= 7 THEN message END AS message,
       CASE WHEN pos % 10 >= 7 THEN filename END AS filename,
       CASE WHEN pos % 10 >= 7 THEN pos END AS pos
FROM messages""",
            _MESSAGES,
        ),
        "decode_rejects": _over_logs("SELECT pos AS msg_id, value FROM messages WHERE pos % 10 < 7", _MESSAGES),
        "to_log_data": _over_logs(
            f"""SELECT sha256(concat_ws(chr(1), filename, '{queries.DAY}', CAST(pos AS VARCHAR), timestamp, level, message)) AS log_id,
       filename AS file_name, timestamp, level AS log_type, message AS log_message,
       CAST('{queries.DAY} ' || timestamp AS TIMESTAMP) AS event_ts, pos AS src_pos
FROM records"""
        ),
        "log_table_scan": _over_logs(
            f"SELECT {stored}, CAST(CAST(event_ts AS DATE) AS VARCHAR) AS event_date FROM stored"
        ),
        "upsert_log_data": _over_logs(
            """SELECT CAST(CAST(event_ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n_rows,
       min(log_id) AS min_id, max(log_id) AS max_id, max(src_pos) AS last_pos
FROM stored GROUP BY 1"""
        ),
        "latest_row_per_user": _over_logs(
            """SELECT user_id, ts, pos, lvl AS log_type, props AS log_message
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, pos DESC) AS n FROM logs)
WHERE n = 1"""
        ),
        "log_table_view": _over_logs("SELECT timestamp, log_type, log_message, file_name FROM stored"),
        "consolidate": _over_logs(
            "SELECT file_name, pos, value, row_number() OVER (ORDER BY file_name, pos) - 1 AS line_no FROM plain"
        ),
        "assign_dates": _over_logs(
            f"""SELECT file_name, pos,
       CAST((DATE '{queries.DAY}' + CAST(days AS INTEGER)) || ' ' || clock AS TIMESTAMP) AS event_ts
FROM dated""",
            _HALF_DAY_STEPS,
        ),
        "error_rows": _over_logs("SELECT log_id, log_type, log_message FROM stored WHERE log_type = 'ERROR'"),
        "filter_levels": _over_logs("SELECT log_id, log_type FROM stored WHERE log_type IN ('WARN', 'SEVERE')"),
        "filter_levels_empty": _over_logs("SELECT log_id, log_type FROM stored"),
        "search_messages": _over_logs(
            """SELECT src_pos, log_type, log_message FROM stored
WHERE contains(lower(log_message), '"k": 7') AND log_type IN ('ERROR', 'INFO', 'SEVERE')"""
        ),
        "search_documents": "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'than')",
        "time_window": _over_logs(f"SELECT file_name, pos, value, clock AS tod FROM plain WHERE {_IN_DAY}"),
        "stored_time_range": _over_logs(
            f"SELECT {stored} FROM stored WHERE event_ts BETWEEN TIMESTAMP '{queries.STORED_RANGE[0]}' "
            f"AND TIMESTAMP '{queries.STORED_RANGE[1]}'"
        ),
        "file_time_window": _over_logs(
            "SELECT file_name, pos, value, clock AS tod FROM plain JOIN file_windows USING (file_name) "
            "WHERE clock BETWEEN lo AND hi",
            _FILE_WINDOWS,
        ),
        "resume_marks": _over_logs("SELECT * FROM marks", _MARKS),
        "resume_after_mark": _over_logs(
            f"""SELECT p.file_name, p.pos, p.value, p.clock AS tod
FROM plain p LEFT JOIN marks m USING (file_name)
WHERE p.{_IN_DAY} AND (m.last_tod IS NULL OR (p.clock, p.pos) > (m.last_tod, m.last_pos))""",
            _MARKS,
        ),
        "first_n_json": _over_logs(
            """SELECT CAST(to_json({'log_id': log_id, 'file_name': file_name, 'timestamp': timestamp,
       'log_type': log_type, 'log_message': log_message, 'src_pos': src_pos}) AS VARCHAR) AS json
FROM (SELECT * FROM stored ORDER BY timestamp, log_id LIMIT 15)"""
        ),
        "level_counts": _over_logs(
            f"""SELECT level AS id, count(*) AS value, min(pos) AS first_seen, level AS label,
       {_COLORS.format('level')} AS color, {_ORDER.format('level')} AS ord
FROM records GROUP BY level"""
        ),
        "level_counts_stored": _over_logs(
            f"""SELECT log_type AS id, count(*) AS value, log_type AS label,
       {_COLORS.format('log_type')} AS color, {_ORDER.format('log_type')} AS ord
FROM stored GROUP BY log_type"""
        ),
        "tumbling_count": _over_logs(
            f"""SELECT make_timestamp(CAST(floor(epoch(event_ts) / {queries.SLICE_SECONDS}) AS BIGINT)
                      * {queries.SLICE_SECONDS} * 1000000) AS window_start, count(*) AS n_logs
FROM stored WHERE log_type = 'ERROR' GROUP BY 1"""
        ),
        "anchored_windows": _over_logs(
            "SELECT src_pos, event_ts, window_idx, window_start, window_end FROM labelled",
            _chain("", queries.ANCHOR_MINUTES),
            recursive=True,
        ),
        "anchored_windows_by_file": _over_logs(
            "SELECT file_name, src_pos, event_ts, window_idx, window_start, window_end FROM labelled",
            _chain("file_name", queries.KEYED_MINUTES).replace(
                "SELECT s.*, c.window_idx", "SELECT s.file_name, s.src_pos, s.event_ts, c.window_idx"
            ),
            recursive=True,
        ),
        "window_level_series": _over_logs(
            "SELECT * FROM series", _chain("", queries.ANCHOR_MINUTES) + "," + _SERIES, recursive=True
        ),
        "filter_series": _over_logs(
            "SELECT * FROM series WHERE level IN ('ERROR', 'WARNING')",
            _chain("", queries.ANCHOR_MINUTES) + "," + _SERIES,
            recursive=True,
        ),
        "filter_level_counts": _over_logs(
            f"""SELECT log_type AS id, count(*) AS value, log_type AS label,
       {_COLORS.format('log_type')} AS color, {_ORDER.format('log_type')} AS ord
FROM stored WHERE log_type IN ('SEVERE', 'DEBUG', 'WARNING') GROUP BY log_type"""
        ),
        "line_chart": _over_logs(
            """SELECT level AS id, color,
       '[' || string_agg('{"x":"' || x || '","y":' || y || '}', ',' ORDER BY window_idx) || ']' AS data
FROM series GROUP BY level, color""",
            _chain("", queries.ANCHOR_MINUTES) + "," + _SERIES,
            recursive=True,
        ),
        "alert_batches": _over_logs("SELECT * FROM alerts", _ALERTS),
        "alert_body": _over_logs(
            "SELECT window_start, "
            + " || ".join(f"'<p>' || {_escaped(f'message{i}')} || '</p>'" for i in (1, 2, 3))
            + " AS body FROM alerts",
            _ALERTS,
        ),
        "range_bucket": f"SELECT event_id, value, {_BUCKETS} AS bucket FROM events",
        "nested_ranges": """
WITH r AS (
  SELECT DISTINCT lo, hi FROM (
    SELECT min(value) AS lo, max(value) AS hi FROM events GROUP BY user_id, event_type)
),
reached AS (
  SELECT a.lo, a.hi, b.lo AS reach_lo, b.hi AS reach_hi,
         row_number() OVER (PARTITION BY a.lo, a.hi ORDER BY b.hi DESC, b.lo) AS n
  FROM r a JOIN r b ON (b.lo < a.lo) OR (b.lo = a.lo AND b.hi > a.hi)
)
SELECT a.lo, a.hi,
       EXISTS (SELECT 1 FROM r b WHERE (a.lo <> b.lo OR a.hi <> b.hi) AND a.lo >= b.lo AND a.hi <= b.hi)
         AS is_nested,
       EXISTS (SELECT 1 FROM r b WHERE (a.lo <> b.lo OR a.hi <> b.hi) AND a.lo < b.hi AND b.lo < a.hi)
         AS is_overlapping,
       x.reach_lo, x.reach_hi
FROM r a LEFT JOIN reached x ON x.lo = a.lo AND x.hi = a.hi AND x.n = 1""",
        "range_lookup": """
WITH r AS (
  SELECT p_retailprice * p_size AS lo, p_retailprice * p_size + p_size * 20 AS hi, CAST(p_partkey AS VARCHAR) AS name
  FROM part
),
v AS (SELECT DISTINCT l_extendedprice FROM lineitem),
met AS (
  SELECT l_extendedprice, name, row_number() OVER (PARTITION BY l_extendedprice ORDER BY lo, hi, name) AS n
  FROM v JOIN r ON l_extendedprice >= lo AND l_extendedprice <= hi
)
SELECT l_orderkey, l_linenumber, l.l_extendedprice, coalesce(name, 'other') AS bucket
FROM lineitem l LEFT JOIN met ON met.l_extendedprice = l.l_extendedprice AND n = 1""",
        "container_counts": f"""
WITH {_ORDER_SPANS}
SELECT lo, hi, count(o) FILTER (a AND NOT o) AS n_around, count(o) FILTER (b AND NOT o) AS n_inside FROM (
  SELECT r.lo, r.hi, s.lo = r.lo AND s.hi = r.hi AS o,
         s.lo <= r.lo AND s.hi >= r.hi AS a, s.lo >= r.lo AND s.hi <= r.hi AS b
  FROM r JOIN r s ON s.lo <= r.hi AND s.hi >= r.lo
) GROUP BY lo, hi""",
        "innermost_containers": f"""
WITH RECURSIVE {_ORDER_SPANS},
around AS (
  SELECT r.lo, r.hi, s.lo AS up_lo, s.hi AS up_hi,
         row_number() OVER (PARTITION BY r.lo, r.hi ORDER BY s.lo DESC, s.hi) AS n
  FROM r JOIN r s ON s.lo <= r.lo AND s.hi >= r.hi AND (s.lo <> r.lo OR s.hi <> r.hi)
),
links AS (SELECT r.lo, r.hi, up_lo, up_hi FROM r LEFT JOIN around a ON a.lo = r.lo AND a.hi = r.hi AND n = 1),
chain AS (
  SELECT *, CAST(0 AS BIGINT) AS depth FROM links WHERE up_lo IS NULL
  UNION ALL
  SELECT l.*, depth + 1 FROM links l JOIN chain c ON l.up_lo = c.lo AND l.up_hi = c.hi
)
SELECT * FROM chain""",
        "pattern_rate": _over_logs(_rate("stored", "log_message", "log_type", queries.NUMBER_PATTERN)),
        "pattern_rate_documents": _rate("documents", "text", "lang", "[A-Z][5-9a-z][f-w]"),
        "length_profile": _over_logs(_profile("stored", "log_message", "log_type", 9, 50)),
        "length_profile_documents": _profile("documents", "text", "lang", 10, 2000),
        "holdout_split": _holdout(1, 10, 1000),
        "holdout_split_unlimited": _holdout(5, 7, 0),
        "kfold_split": "SELECT o_custkey AS user_id, o_orderkey AS pos, o_totalprice, "
        "CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 3000 + 1 AS INTEGER) AS fold FROM orders",
        "kfold_sparse": "SELECT o_custkey AS user_id, 53 * o_orderkey AS pos, o_totalprice, "
        "CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 3000 + 1 AS INTEGER) AS fold FROM orders",
        "fold_parts": """
WITH folds AS (
  SELECT o_custkey AS user_id, o_orderkey AS pos, o_totalprice,
         CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 3000 + 1 AS INTEGER) AS fold
  FROM orders
),
parts AS (SELECT *, CASE WHEN fold = 2 THEN 'test' ELSE 'base' END AS part FROM folds)
SELECT *, row_number() OVER (PARTITION BY part ORDER BY pos) - 1 AS place FROM parts""",
        "time_window_order": _over_logs(
            f"""SELECT file_name, pos, row_number() OVER (ORDER BY clock, file_name, pos) - 1 AS place
FROM plain WHERE {_IN_DAY}"""
        ),
        "upsert_same_text": _over_logs(
            """SELECT filename AS file_name, level AS log_type, count(*) AS n_rows, count(*) AS n_keys
FROM records GROUP BY 1, 2"""
        ),
        "upsert_replay_other_day": _over_logs(
            f"""SELECT event_date, n AS n_rows, n AS n_keys
FROM (SELECT count(*) AS n FROM records),
     (SELECT unnest(['{queries.DAY}', '{queries.OTHER_DAY}']) AS event_date)"""
        ),
        "time_seek": _over_logs(
            f"SELECT value, clock AS tod, covered FROM plain, (VALUES ('first'), ('all')) AS c(covered) WHERE {_IN_DAY}"
        ),
        "time_index": _over_logs(
            """SELECT CAST(sum(breaks) AS BIGINT) AS n_untimed, CAST(sum(size) AS BIGINT) AS n_bytes,
       min(clock) AS least, max(clock) AS greatest
FROM (SELECT 0 AS breaks, strlen(value) + 1 AS size, clock FROM plain
      UNION ALL
      SELECT length(text) - length(replace(text, chr(10), '')),
             strlen('00:00:00.000 [' || source || '] INFO  app.Documents - ' || text) + 1, '00:00:00.000' FROM documents)"""
        ),
        "consolidated_files": _over_logs("SELECT value FROM plain"),
        "tail_backlog": _over_logs(
            "SELECT value, count(*) AS times, CAST(3 AS BIGINT) AS runs, true AS bounded FROM plain GROUP BY value"
        ),
        "tail_restart": _over_logs(
            f"""SELECT timestamp, level AS log_type, message AS log_message,
       CAST('{queries.DAY} ' || timestamp AS TIMESTAMP) AS event_ts
FROM records r JOIN plain p USING (pos) WHERE p.{_IN_DAY}"""
        ),
        "scan_log_dir": _over_logs("SELECT timestamp, level, message FROM records"),
        "delimited_read": """
SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(o_orderkey AS INTEGER) AS item_id,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating,
       CAST(epoch(o_orderdate) AS BIGINT) AS ts
FROM orders""",
        "stream_tumbling": """
SELECT date_trunc('hour', ts) AS window_start, count(*) AS n_logs
FROM events WHERE event_type = 'error' GROUP BY 1""",
        "stream_late_rows": f"""
WITH parts AS (
  SELECT event_id, ts, date_trunc('hour', ts) AS window_start,
         ts >= TIMESTAMP '{queries.STREAM_CUTS[0]}' AND ts < TIMESTAMP '{queries.STREAM_CUTS[1]}' AS last FROM events
),
mark AS (SELECT max(ts) - INTERVAL {queries.LATE_DAYS} DAY AS watermark FROM parts WHERE NOT last),
told AS (SELECT *, last AND window_start + INTERVAL 1 HOUR <= watermark AS late FROM parts, mark)
SELECT window_start, CASE WHEN count(*) > count(*) FILTER (late) THEN count(*) FILTER (NOT late) END AS n_logs,
       max(watermark) FILTER (late) AS watermark,
       CASE WHEN bool_or(late) THEN count(*) FILTER (late) END AS n_late, min(event_id) FILTER (late) AS least_id
FROM told GROUP BY window_start""",
        "stream_anchored": _over_logs(
            "SELECT file_name, CAST(src_pos AS VARCHAR) AS log_id, event_ts, log_type, window_idx, "
            "window_start, false AS is_late FROM labelled",
            _chain("file_name", queries.KEYED_MINUTES).replace(
                "SELECT s.*, c.window_idx",
                "SELECT s.file_name, s.src_pos, s.event_ts, s.log_type, c.window_idx",
            ),
            recursive=True,
        ),
        "stream_alert": _over_logs(
            "SELECT n_errors, message1, message2, message3, "
            + " || ".join(f"'<p>' || {_escaped(f'message{i}')} || '</p>'" for i in (1, 2, 3))
            + """ AS body
FROM (SELECT count(*) AS n_errors, max(CASE WHEN n = 1 THEN message END) AS message1,
             max(CASE WHEN n = 2 THEN message END) AS message2,
             max(CASE WHEN n = 3 THEN message END) AS message3
      FROM (SELECT message, row_number() OVER (ORDER BY filename, pos) AS n
            FROM records WHERE level = 'ERROR'))"""
        ),
        "stream_files_to_store": _over_logs(
            f"""SELECT timestamp, level AS log_type, message AS log_message,
       CAST('{queries.DAY} ' || timestamp AS TIMESTAMP) AS event_ts, '{queries.DAY}' AS event_date
FROM records r JOIN plain p USING (pos) WHERE p.{_IN_DAY}"""
        ),
    }
