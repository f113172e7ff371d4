"""The catalog's queries written for DuckDB over the same tables.

The SQL restates each operator's meaning from the raw ``events`` table and shares
nothing with the Spark code but the fixed value lists and parameters.
"""

from eventide.plans.catalog import FIRST_DAY, LAST_DAY, LOGGED_AT
from eventide.schemas import EVENT_TYPES
from eventide.sources.testdata import N_BROWSERS, N_COUNTRIES, N_DEVICES, N_PAGES, QUIET_SLOTS


def _strings(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _numbered(prefix: str, values: int) -> str:
    return f"'{prefix}' || CAST(k % {values} AS VARCHAR)"


USER_EVENTS = f"""
raw AS (
    SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
),
user_events AS (
    SELECT event_id,
           CAST(event_id AS VARCHAR) AS id,
           printf('user-%03d', user_id) AS user_id,
           'sess-' || CAST(user_id % 20 AS VARCHAR) AS session_id,
           CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'login'
                ELSE event_type END AS event_type,
           {_numbered('/page-', N_PAGES)} AS page,
           value * 1000 AS duration_ms,
           {_numbered('device-', N_DEVICES)} AS device,
           {_numbered('browser-', N_BROWSERS)} AS browser,
           {_numbered('country-', N_COUNTRIES)} AS country,
           ts AS timestamp
    FROM raw
)"""

EVENTS_JSON = f"""{USER_EVENTS},
good AS (
    SELECT event_id, id, '{{"id":"' || id || '","user_id":"' || user_id
        || '","session_id":"' || session_id || '","event_type":"' || event_type
        || '","page":"' || page || '","duration_ms":' || CAST(duration_ms AS VARCHAR)
        || ',"metadata":{{"device":"' || device || '","browser":"' || browser
        || '","country":"' || country || '"}},"timestamp":"'
        || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}}' AS good
    FROM user_events
),
events_json AS (
    SELECT event_id, id, CASE event_id % 20
        WHEN 0 THEN left(good, length(good) - 1)
        WHEN 1 THEN good || ' trailing'
        WHEN 2 THEN replace(good, '"page":', '"pg":')
        WHEN 3 THEN regexp_replace(good, '"session_id":"[^"]*"', '"session_id":null')
        WHEN 4 THEN regexp_replace(good, '"user_id":"[^"]*"', '"user_id":5')
        WHEN 5 THEN regexp_replace(good, '"duration_ms":([^,]*)', '"duration_ms":"\\1"')
        WHEN 6 THEN '{{"id":"first",' || substr(good, 2)
        WHEN 7 THEN '{{"extra":{{"id":1}},' || substr(good, 2)
        WHEN 8 THEN ''
        WHEN 9 THEN '{{"ID":"first",' || substr(good, 2)
        WHEN 10 THEN left(good, length(good) - 1) || ',"ID":5}}'
        WHEN 11 THEN left(good, length(good) - 1) || ',"id":null}}'
        WHEN 12 THEN '{{"duration_ms":"x",' || substr(good, 2)
        WHEN 13 THEN '{{"metadata":{{"extra":"1"}},' || substr(good, 2)
        ELSE good END AS value
    FROM good
)"""


def _windows(size: str) -> str:
    return f"""{USER_EVENTS},
bucketed AS (
    SELECT *, time_bucket(INTERVAL {size}, timestamp) AS window_start FROM user_events
),
windows AS (
    SELECT window_start,
           window_start + INTERVAL {size} AS window_end,
           count(*) AS total_events,
           count(DISTINCT user_id) AS unique_users,
           avg(duration_ms) AS raw_avg,
           round(raw_avg, 6) AS avg_duration_ms
    FROM bucketed GROUP BY window_start
)"""


HOURLY = _windows("1 HOUR")
TEN_MINUTES = _windows("10 MINUTES")

TYPE_COUNTS = """
type_counts AS (
    SELECT window_start, event_type, count(*) AS n FROM bucketed GROUP BY ALL
)"""

RANKED_PAGES = """
ranked_pages AS (
    SELECT window_start, page, n,
           row_number() OVER (PARTITION BY window_start ORDER BY n DESC, page) AS rank
    FROM (SELECT window_start, page, count(*) AS n FROM bucketed GROUP BY ALL)
    QUALIFY rank <= 5
)"""

# Windows with the nested columns as JSON text.
FULL = f"""{HOURLY},{TYPE_COUNTS},{RANKED_PAGES},
stored AS (
    SELECT w.*, c.event_counts, p.top_pages
    FROM windows w
    JOIN (SELECT window_start,
                 '{{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}}'
                 AS event_counts
          FROM type_counts GROUP BY window_start) c USING (window_start)
    JOIN (SELECT window_start,
                 '[' || string_agg('{{"page":"' || page || '","count":' || n || '}}', ','
                                   ORDER BY rank) || ']' AS top_pages
          FROM ranked_pages GROUP BY window_start) p USING (window_start)
)"""

DIRTY = f"""{FULL},
dirty AS (
    SELECT window_start, window_end, total_events, unique_users, avg_duration_ms,
           event_counts, 0 AS seq FROM stored
    UNION ALL
    SELECT window_start, window_end, total_events + 1, unique_users, avg_duration_ms,
           event_counts, 1 FROM stored WHERE hour(window_start) % 6 = 0
    UNION ALL
    SELECT window_start, window_end, 0, 0, 0.0, '{{}}', -1
    FROM stored WHERE hour(window_start) % 6 = 1
    UNION ALL
    SELECT window_start + INTERVAL 100 MICROSECONDS, window_end + INTERVAL 100 MICROSECONDS,
           total_events, unique_users, avg_duration_ms, event_counts, 2
    FROM stored WHERE hour(window_start) % 6 = 2
),
deduped AS (
    SELECT * EXCLUDE (seq) FROM dirty
    QUALIFY row_number() OVER (PARTITION BY window_start, window_end ORDER BY seq) = 1
)"""

TYPE_TOTALS = f"""{HOURLY},{TYPE_COUNTS},
type_totals AS (
    SELECT event_type, CAST(sum(n) AS BIGINT) AS total_count FROM type_counts GROUP BY event_type
)"""

# Stored text of two hours in seven cannot be read.
STORED_TYPE_TOTALS = f"""{HOURLY},{TYPE_COUNTS},
type_totals AS (
    SELECT event_type, CAST(sum(n) AS BIGINT) AS total_count FROM type_counts
    WHERE hour(window_start) % 7 > 1 GROUP BY event_type
)"""

PAGE_TOTALS = f"""{HOURLY},{RANKED_PAGES},
page_totals AS (
    SELECT page, CAST(sum(n) AS BIGINT) AS count FROM ranked_pages
    WHERE hour(window_start) % 7 > 1 GROUP BY page
),
best_pages AS (SELECT * FROM page_totals ORDER BY count DESC, page LIMIT 10)"""

HEATMAP = f"""{HOURLY},
heatmap AS (
    SELECT day_idx, hour, CAST(coalesce(sum(w.unique_users), 0) AS BIGINT) AS unique_users
    FROM (SELECT unnest(range(7)) AS day_idx) d
    CROSS JOIN (SELECT unnest(range(24)) AS hour) h
    LEFT JOIN windows w
        ON isodow(w.window_start) - 1 = day_idx AND hour(w.window_start) = hour
    GROUP BY day_idx, hour
)"""

EVENT_ERRORS = f"""nullif(concat_ws('; ',
    CASE WHEN id = '' THEN 'id: must not be empty'
         WHEN strlen(id) > 36 THEN 'id: length ' || strlen(id) || ' exceeds 36 chars' END,
    CASE WHEN user_id = '' THEN 'user_id: must not be empty'
         WHEN NOT regexp_full_match(user_id, '[a-zA-Z0-9_-]+')
         THEN 'user_id: contains invalid characters (allowed: a-z A-Z 0-9 _ -)' END,
    CASE WHEN session_id = '' THEN 'session_id: must not be empty'
         WHEN strlen(session_id) > 36
         THEN 'session_id: length ' || strlen(session_id) || ' exceeds 36 chars' END,
    CASE WHEN event_type NOT IN ({_strings(EVENT_TYPES)})
         THEN 'event_type: ''' || event_type || ''' is not valid (allowed: {", ".join(EVENT_TYPES)})'
         END,
    CASE WHEN NOT starts_with(page, '/') THEN 'page: ''' || page || ''' must start with ''/''' END,
    CASE WHEN duration_ms < 0 THEN printf('duration_ms: %.2f must be >= 0', duration_ms)
         WHEN duration_ms > 300000
         THEN printf('duration_ms: %.2f exceeds max 300000 ms (5 minutes)', duration_ms) END
), '')"""


def _json_event(text: str) -> str:
    """Fields of a JSON event, and whether all six have the right type."""
    names = ["id", "user_id", "session_id", "event_type", "page"]
    values = ", ".join(f"json_extract_string({text}, '$.{n}') AS {n}" for n in names)
    typed = " AND ".join(f"json_type({text}, '$.{n}') = 'VARCHAR'" for n in names)
    number = f"json_type({text}, '$.duration_ms') IN ('UBIGINT', 'BIGINT', 'DOUBLE')"
    return (
        f"{values}, TRY_CAST(json_extract_string({text}, '$.duration_ms') AS DOUBLE) "
        f"AS duration_ms, coalesce({typed} AND {number}, false) AS typed"
    )


# Whether the fields of a JSON event have readable types; absent and null ones do.
_READABLE = """coalesce(json_type(v, '$.user_id'), 'NULL') IN ('VARCHAR', 'NULL')
              AND coalesce(json_type(v, '$.session_id'), 'NULL') IN ('VARCHAR', 'NULL')
              AND coalesce(json_type(v, '$.duration_ms'), 'NULL')
                  IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL')"""


OUTCOMES = f"""{EVENTS_JSON},
            records AS (
                SELECT event_id, value AS v,
                       value <> '' AND json_valid(value) AND NOT ends_with(value, ',"ID":5}}')
                       AND NOT starts_with(value, '{{"duration_ms":"x"') AS whole
                FROM events_json
            ),
            outcomes AS (
                SELECT CASE WHEN NOT whole THEN 'rejected' WHEN NOT ({_READABLE}) THEN 'rejected'
                            WHEN event_id % 7 = 0 THEN 'undated' ELSE 'accepted' END AS outcome
                FROM (SELECT event_id, whole, CASE WHEN whole THEN v END AS v FROM records)
            )"""


def _clean_step(columns: str, where: str = "") -> str:
    return f"WITH {DIRTY} SELECT {columns} FROM deduped {where}"


_BASE = (
    "window_start, window_end, total_events, unique_users, avg_duration_ms, event_counts"
)
_MILLIS = (
    "date_trunc('millisecond', window_start) AS window_start, "
    "date_trunc('millisecond', window_end) AS window_end, "
    "total_events, unique_users, avg_duration_ms, event_counts"
)
_SPAN = "((epoch_ms(window_end) - epoch_ms(window_start)) / 1000.0)"
_DURATION = f"{_MILLIS}, CAST({_SPAN} AS DOUBLE) AS window_duration_sec"
_RATE = (
    f"{_DURATION}, round(CASE WHEN {_SPAN} > 0 THEN CAST(total_events AS DOUBLE) / {_SPAN} "
    "ELSE 0.0 END, 6) AS events_per_second"
)
_NONEMPTY = "WHERE total_events > 0"

AGGREGATE = f"""WITH {FULL}
    SELECT window_start, window_end, total_events, event_counts, unique_users,
           avg_duration_ms, top_pages
    FROM stored"""

HOURLY_TOTALS = f"""WITH {TEN_MINUTES}
    SELECT date_trunc('hour', window_start) AS hour,
           CAST(sum(total_events) AS BIGINT) AS total_events,
           round(avg(raw_avg), 6) AS avg_duration_ms
    FROM windows WHERE total_events > 0 GROUP BY 1 ORDER BY 2 DESC, 1"""


def oracle_sql() -> dict[str, str]:
    return {
        # Of two equal keys the last counts unless it is null, in any letter case; metadata
        # objects are merged. So what was put before or behind a good record is cut off.
        "decode_events": f"""WITH {EVENTS_JSON},
            valid AS (
                SELECT regexp_replace(regexp_replace(value,
                           '^\\{{"(id|ID)":"first",|^\\{{"metadata":\\{{"extra":"1"\\}},', '{{'),
                           ',"id":null\\}}$', '}}') AS v,
                       starts_with(value, '{{"metadata":{{"extra"') AS extra
                FROM events_json
                WHERE value <> '' AND json_valid(value) AND NOT ends_with(value, ',"ID":5}}')
                  AND NOT starts_with(value, '{{"duration_ms":"x"')
            )
            SELECT coalesce(json_extract_string(v, '$.id'), '') AS id,
                   coalesce(json_extract_string(v, '$.user_id'), '') AS user_id,
                   coalesce(json_extract_string(v, '$.session_id'), '') AS session_id,
                   coalesce(json_extract_string(v, '$.event_type'), '') AS event_type,
                   coalesce(json_extract_string(v, '$.page'), '') AS page,
                   round(CAST(json_extract_string(v, '$.duration_ms') AS DOUBLE), 6) AS duration_ms,
                   '{{"browser":"' || json_extract_string(v, '$.metadata.browser')
                       || '","country":"' || json_extract_string(v, '$.metadata.country')
                       || '","device":"' || json_extract_string(v, '$.metadata.device')
                       || CASE WHEN extra THEN '","extra":"1' ELSE '' END || '"}}' AS metadata,
                   strptime(json_extract_string(v, '$.timestamp'), '%Y-%m-%dT%H:%M:%S.%fZ')
                       AS timestamp
            FROM valid
            WHERE {_READABLE}""",
        "stream_decode_split": f"""WITH {OUTCOMES}
            SELECT outcome, count(*) AS n FROM outcomes GROUP BY 1""",
        "stream_decode_counts": f"""WITH {OUTCOMES}
            SELECT count(*) FILTER (outcome = 'accepted') AS accepted,
                   count(*) FILTER (outcome = 'rejected') AS rejected,
                   count(*) FILTER (outcome = 'undated') AS undated
            FROM outcomes""",
        "encode_events": f"""WITH {USER_EVENTS}
            SELECT user_id AS key, id, event_type, page, round(duration_ms, 6) AS duration_ms
            FROM user_events""",
        "validate_events": f"""WITH {USER_EVENTS}
            SELECT id, {EVENT_ERRORS} IS NULL AS is_valid, coalesce({EVENT_ERRORS}, '') AS errors
            FROM user_events""",
        "validate_json_events": f"""WITH {EVENTS_JSON},
            checked AS (
                SELECT id AS event, CASE WHEN value <> '' AND json_valid(value) THEN value END AS v
                FROM events_json
            ),
            fields AS (
                SELECT event, len(known) = len(list_distinct(known)) AS distinct_keys,
                       {_json_event("v")}
                FROM (SELECT *, list_filter(json_keys(v), lambda k: k IN (
                          'id', 'user_id', 'session_id', 'event_type', 'page', 'duration_ms'
                      )) AS known FROM checked)
            )
            SELECT event AS id,
                   coalesce(typed AND distinct_keys AND {EVENT_ERRORS} IS NULL, false) AS is_valid
            FROM fields""",
        "validate_batch": f"""WITH {EVENTS_JSON},
            batches AS (
                SELECT event_id // 50 AS batch_id, string_agg(
                    CASE WHEN event_id % 20 NOT IN (0, 1, 8) OR (event_id // 50) % 4 = 0 THEN value
                         WHEN (event_id // 50) % 4 = 1 THEN '7' ELSE '{{}}' END,
                    ',' ORDER BY event_id) AS records
                FROM events_json GROUP BY 1
            ),
            texts AS (
                SELECT batch_id, CASE WHEN batch_id % 10 = 9 THEN '{{"v":[' || records || ']}}'
                                      ELSE '[' || records || ']' END AS text
                FROM batches
            ),
            arrays AS (
                SELECT batch_id, CASE WHEN json_valid(text) THEN text END AS text FROM texts
            ),
            elements AS (
                SELECT batch_id, pos, json_extract(text, '$[' || pos || ']') AS e
                FROM (SELECT batch_id, text,
                             unnest(range(CAST(json_array_length(text) AS BIGINT))) AS pos
                      FROM arrays WHERE json_type(text) = 'ARRAY')
            ),
            -- The last of equal keys counts: a null id, a number after a text.
            last AS (
                SELECT batch_id, pos, ends_with(CAST(e AS VARCHAR), ',"id":null}}') AS null_id,
                       regexp_replace(CAST(e AS VARCHAR), '^\\{{"duration_ms":"x",', '{{') AS e
                FROM elements
            ),
            fields AS (SELECT batch_id, pos, null_id, {_json_event("e")} FROM last)
            SELECT batch_id, pos,
                   coalesce(typed AND NOT null_id AND {EVENT_ERRORS} IS NULL, false) AS is_valid
            FROM fields
            UNION ALL
            SELECT batch_id, 0, false FROM arrays
            WHERE text IS NULL OR json_type(text) <> 'ARRAY'""",
        "validate_windows": f"""WITH {TEN_MINUTES}
            SELECT window_start, avg_duration_ms * 3 BETWEEN 0 AND 300000 AS is_valid,
                   CASE WHEN avg_duration_ms * 3 > 300000
                        THEN printf('duration_ms: %.2f exceeds max 300000 ms (5 minutes)',
                                    avg_duration_ms * 3)
                        ELSE '' END AS errors
            FROM windows""",
        "validation_summary": f"""WITH {USER_EVENTS},
            verdicts AS (SELECT {EVENT_ERRORS} AS errors FROM user_events)
            SELECT CASE WHEN errors IS NULL THEN 'valid' ELSE 'invalid' END AS rule, count(*) AS n
            FROM verdicts GROUP BY 1
            UNION ALL
            SELECT split_part(error, ':', 1), count(*)
            FROM (SELECT unnest(string_split(errors, '; ')) AS error FROM verdicts)
            GROUP BY 1""",
        "window_totals": f"WITH {HOURLY} SELECT window_start, window_end, total_events FROM windows",
        "window_event_counts": f"""WITH {HOURLY},{TYPE_COUNTS}
            SELECT window_start, event_type, n FROM type_counts""",
        "window_unique_users": f"""WITH {HOURLY}
            SELECT window_start, window_end, unique_users FROM windows""",
        "window_avg_duration": f"""WITH {HOURLY}
            SELECT window_start, window_end, avg_duration_ms FROM windows""",
        "window_top_pages": f"""WITH {HOURLY},{RANKED_PAGES}
            SELECT window_start, rank, page, n FROM ranked_pages""",
        "window_aggregate": AGGREGATE,
        "window_rollup": AGGREGATE,
        "distinct_users_by_span": f"""WITH {USER_EVENTS}
            SELECT span, date_trunc(span, timestamp) AS span_start, count(DISTINCT user_id) AS unique_users
            FROM user_events, (VALUES ('day'), ('week'), ('month')) AS spans(span) GROUP BY 1, 2""",
        "windows_zero_filled": f"""WITH {TEN_MINUTES},
            moved AS (
                SELECT * EXCLUDE (window_start, window_end), window_start + later AS window_start,
                       window_end + later AS window_end
                FROM (SELECT *, CASE WHEN day(window_start) % 3 = 0 THEN INTERVAL 3 MINUTES
                                     ELSE INTERVAL 0 MINUTES END AS later FROM windows)
            ),
            spine AS (
                SELECT unnest(generate_series(min(window_start), max(window_start),
                                              INTERVAL 10 MINUTES)) AS slot
                FROM moved
            )
            SELECT window_start, total_events, unique_users, avg_duration_ms FROM moved
            UNION ALL
            SELECT slot, 0, 0, 0.0 FROM spine
            WHERE NOT EXISTS (SELECT 1 FROM moved WHERE window_start < slot + INTERVAL 10 MINUTES
                                                    AND window_end > slot)""",
        "windows_per_collector": f"""WITH {USER_EVENTS},
            anchors AS (
                SELECT collector, (SELECT date_trunc('day', min(ts)) FROM events) + after AS started_at
                FROM (VALUES ('c0', INTERVAL '-7 seconds'), ('c1', INTERVAL '-3 minutes'),
                             ('c1', INTERVAL '9 days 7 hours 3 minutes 20 seconds'),
                             ('c1', INTERVAL '9 days 7 hours 25 minutes 41.5 seconds')) AS v(collector, after)
            ),
            bucketed AS (
                SELECT e.*, a.collector, a.started_at
                           + to_hours(date_diff('microsecond', a.started_at, e.timestamp) // 3600000000) AS window_start
                FROM (SELECT *, 'c' || CAST(event_id % 2 AS VARCHAR) AS collector FROM user_events) e
                ASOF JOIN anchors a ON e.collector = a.collector AND e.timestamp >= a.started_at
            ),
            types AS (
                SELECT collector, window_start, '{{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}}' AS event_counts
                FROM (SELECT collector, window_start, event_type, count(*) AS n FROM bucketed GROUP BY ALL) GROUP BY ALL
            ),
            pages AS (
                SELECT collector, window_start,
                       '[' || string_agg('{{"page":"' || page || '","count":' || n || '}}', ',' ORDER BY rank) || ']' AS top_pages
                FROM (SELECT *, row_number() OVER (PARTITION BY collector, window_start ORDER BY n DESC, page) AS rank
                      FROM (SELECT collector, window_start, page, count(*) AS n FROM bucketed GROUP BY ALL) QUALIFY rank <= 5)
                GROUP BY ALL
            )
            SELECT collector, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS total_events,
                   any_value(event_counts) AS event_counts, count(DISTINCT user_id) AS unique_users,
                   round(avg(duration_ms), 6) AS avg_duration_ms, any_value(top_pages) AS top_pages
            FROM bucketed JOIN types USING (collector, window_start) JOIN pages USING (collector, window_start)
            GROUP BY collector, window_start""",
        "stream_window_aggregate": AGGREGATE,
        "stream_closed_windows": f"""{AGGREGATE}
            WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events)
                                - INTERVAL 10 MINUTES""",
        "stream_quiet_windows": f"""WITH {TEN_MINUTES},
            spine AS (
                SELECT unnest(generate_series(min(window_start), max(window_start) + INTERVAL {QUIET_SLOTS * 10} MINUTES,
                                              INTERVAL 10 MINUTES)) AS slot
                FROM windows
            )
            SELECT slot AS window_start, coalesce(total_events, 0) AS total_events,
                   coalesce(unique_users, 0) AS unique_users, coalesce(avg_duration_ms, 0.0) AS avg_duration_ms
            FROM spine LEFT JOIN windows ON window_start = slot""",
        "stream_corrected_windows": f"""{AGGREGATE}
            WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES""",
        "stream_late_events": f"""WITH {HOURLY}
            SELECT window_start, total_events AS late FROM windows
            WHERE day(window_start) BETWEEN 9 AND 16""",
        "stream_drain_once": f"""WITH {HOURLY}
            SELECT CAST(1 AS BIGINT) AS run, count(*) AS new_rows FROM windows
            UNION ALL SELECT 2, 0 UNION ALL SELECT 3, 0""",
        "cycles_in_turn": f"""WITH {HOURLY}
            SELECT count(*) AS total_windows, CAST(sum(total_events) AS BIGINT) AS total_events
            FROM windows WHERE raw_avg BETWEEN 0 AND 300000
            GROUP BY least((day(window_start) - 1) // 8, 3)""",
        "clean_dedup": _clean_step(_BASE),
        "clean_filter_nonempty": _clean_step(_BASE, _NONEMPTY),
        "clean_cast_ms": _clean_step(_MILLIS, _NONEMPTY),
        "clean_duration": _clean_step(_DURATION, _NONEMPTY),
        "clean_events_per_second": _clean_step(_RATE, _NONEMPTY),
        "clean_windows": _clean_step(_RATE, _NONEMPTY),
        "cleaning_audit": f"""WITH {DIRTY},
            sizes AS (
                SELECT (SELECT count(*) FROM dirty) AS loaded,
                       (SELECT count(*) FROM deduped) AS uniq,
                       (SELECT count(*) FROM deduped WHERE total_events > 0) AS kept
            )
            SELECT CAST(1 AS BIGINT) AS step, 'Конвертация в DataFrame' AS description,
                   loaded AS rows_before, loaded AS rows_after FROM sizes
            UNION ALL SELECT 2, 'Удаление дубликатов', loaded, uniq FROM sizes
            UNION ALL SELECT 3, 'Фильтрация total_events > 0', uniq, kept FROM sizes
            UNION ALL SELECT 4, 'Приведение типов datetime[ms, UTC]', kept, kept FROM sizes
            UNION ALL SELECT 5, 'Добавление window_duration_sec', kept, kept FROM sizes
            UNION ALL SELECT 6, 'Добавление events_per_second', kept, kept FROM sizes""",
        "windows_at_rest": f"""WITH {FULL}
            SELECT window_start, window_end, total_events, unique_users, avg_duration_ms,
                   top_pages, event_counts
            FROM stored""",
        "windows_roundtrip": AGGREGATE,
        "windows_union_schemas": f"""WITH {FULL},
            layouts AS (SELECT unnest(['now', 'old', 'fractional', 'wider']) AS layout)
            SELECT window_start, window_end, CAST(total_events AS DOUBLE) AS total_events,
                   unique_users, avg_duration_ms, top_pages,
                   CASE WHEN layout <> 'old' THEN event_counts END AS event_counts,
                   CASE WHEN layout = 'wider' THEN 'c1' END AS collector
            FROM stored CROSS JOIN layouts ORDER BY window_start""",
        "window_export": f"""WITH {HOURLY}
            SELECT window_start, window_end, total_events, unique_users, avg_duration_ms
            FROM windows""",
        "window_log_lines": f"""WITH {HOURLY}
            SELECT window_start,
                   '{{"avg_duration":"' || printf('%.2f', avg_duration_ms)
                   || '","level":"INFO","msg":"window aggregated","total_events":' || total_events
                   || ',"ts":"{LOGGED_AT}","unique_users":' || unique_users
                   || ',"window_end":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%SZ')
                   || '","window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ')
                   || '"}}' AS line
            FROM windows""",
        "windows_date_range": f"""WITH {HOURLY}
            SELECT window_start, window_end, total_events, unique_users, avg_duration_ms
            FROM windows
            WHERE window_start BETWEEN TIMESTAMP '{FIRST_DAY} 00:00:00'
                                   AND TIMESTAMP '{LAST_DAY} 23:59:59.999999'""",
        "events_timeseries": f"""WITH {HOURLY}
            SELECT window_start, total_events FROM windows ORDER BY window_start""",
        "performance_table": f"""WITH {HOURLY}
            SELECT window_start, window_end, total_events, unique_users,
                   round(avg_duration_ms, 2) AS avg_duration_ms
            FROM windows ORDER BY window_start DESC""",
        "hourly_rollup": f"""WITH {TEN_MINUTES}
            SELECT date_trunc('hour', window_start) AS hour,
                   CAST(sum(total_events) AS BIGINT) AS total_events,
                   round(avg(raw_avg), 6) AS avg_duration_ms,
                   CAST(sum(unique_users) AS BIGINT) AS unique_users,
                   count(*) AS window_count
            FROM windows GROUP BY 1 ORDER BY 1""",
        "hourly_report": f"""WITH {TEN_MINUTES}
            SELECT date_trunc('hour', window_start) AS hour,
                   CAST(sum(total_events) AS BIGINT) AS total_events,
                   round(avg(raw_avg), 6) AS avg_duration_ms,
                   CAST(sum(unique_users) AS BIGINT) AS unique_users,
                   round(percentile_cont(0.5) WITHIN GROUP (ORDER BY raw_avg), 6)
                       AS median_duration
            FROM windows WHERE total_events > 0 GROUP BY 1 ORDER BY 2 DESC, 1""",
        "hourly_totals": HOURLY_TOTALS,
        "hourly_totals_sql": HOURLY_TOTALS,
        "users_heatmap": f"WITH {HEATMAP} SELECT day_idx, hour, unique_users FROM heatmap",
        "users_heatmap_pivot": f"""WITH {HEATMAP}
            SELECT hour, {", ".join(
                f"CAST(sum(unique_users) FILTER (day_idx = {d}) AS BIGINT) AS d{d}"
                for d in range(7))}
            FROM heatmap GROUP BY hour""",
        "analysis_summary": f"""WITH {HOURLY}
            SELECT count(*) AS total_windows,
                   CAST(coalesce(sum(total_events), 0) AS BIGINT) AS total_events,
                   round(CASE WHEN count(*) > 0 THEN sum(total_events) / count(*) ELSE 0.0 END, 6)
                       AS avg_events_per_window
            FROM windows""",
        "peak_window": f"""WITH {HOURLY}
            SELECT window_start, window_end, total_events FROM windows
            ORDER BY total_events DESC, window_start LIMIT 1""",
        "analysis_result": f"""WITH {FULL}
            SELECT count(*) AS total_windows,
                   CAST(sum(total_events) AS BIGINT) AS total_events,
                   round(sum(total_events) / count(*), 6) AS avg_events_per_window,
                   arg_min(window_start, (-total_events, window_start)) AS peak_start,
                   max(total_events) AS peak_events,
                   (SELECT '{{' || string_agg('"' || event_type || '":' || n, ','
                                              ORDER BY event_type) || '}}'
                    FROM (SELECT event_type, sum(n) AS n FROM type_counts GROUP BY 1))
                       AS event_distribution,
                   TIMESTAMP '2024-02-01 00:00:00' AS generated_at
            FROM stored""",
        "kpi_metrics": f"""WITH {HOURLY}
            SELECT CAST(sum(total_events) AS BIGINT) AS total_events,
                   CAST(sum(unique_users) AS BIGINT) AS unique_users,
                   round(coalesce(avg(raw_avg), 0.0), 6) AS avg_duration_ms,
                   count(*) AS windows
            FROM windows""",
        "duration_histogram": f"""WITH {HOURLY},
            ends AS (
                SELECT min(raw_avg) AS lo, max(raw_avg) AS hi, avg(raw_avg) AS mean,
                       (hi - lo) / 40 AS width
                FROM windows
            )
            SELECT CAST(CASE WHEN width > 0
                             THEN least(floor((raw_avg - lo) / width), 39)
                             ELSE 0 END AS BIGINT) AS bin,
                   round(any_value(ends.lo) + bin * any_value(width), 6) AS lo,
                   round(any_value(ends.lo) + (bin + 1) * any_value(width), 6) AS hi,
                   count(*) AS n,
                   round(any_value(ends.mean), 6) AS mean
            FROM windows CROSS JOIN ends GROUP BY bin ORDER BY bin""",
        "duration_histogram_round": f"""WITH {HOURLY},
            ends AS (SELECT min(raw_avg) AS lo, max(raw_avg) AS hi, avg(raw_avg) AS mean FROM windows),
            steps AS (
                SELECT CASE WHEN e < 0 THEN m / pow(10.0, -e) ELSE m * pow(10.0, e) END AS step
                FROM (SELECT unnest([1, 2, 5]) AS m) CROSS JOIN (SELECT unnest(range(-12, 13)) AS e)
            ),
            chosen AS (
                SELECT lo, hi, mean, CASE WHEN hi > lo THEN min(step) ELSE 1.0 END AS step
                FROM ends CROSS JOIN steps
                WHERE floor(hi / step) - floor(lo / step) < 40 GROUP BY lo, hi, mean
            )
            SELECT CAST(floor(raw_avg / step) AS BIGINT) AS bin,
                   round(floor(raw_avg / step) * step, 6) AS lo,
                   round((floor(raw_avg / step) + 1) * step, 6) AS hi,
                   count(*) AS n, round(step, 6) AS step, round(mean, 6) AS mean
            FROM windows CROSS JOIN chosen GROUP BY ALL ORDER BY bin""",
        "event_distribution": f"""WITH {TYPE_TOTALS}
            SELECT event_type, total_count FROM type_totals ORDER BY 2 DESC, 1""",
        "event_distribution_json": f"""WITH {STORED_TYPE_TOTALS}
            SELECT event_type, total_count FROM type_totals ORDER BY 2 DESC, 1""",
        "event_distribution_filtered": f"""WITH {STORED_TYPE_TOTALS}
            SELECT event_type, total_count FROM type_totals
            WHERE event_type IN ({_strings(EVENT_TYPES)}) ORDER BY 2, 1""",
        "event_type_shares": f"""WITH {STORED_TYPE_TOTALS}
            SELECT event_type AS key, total_count AS count,
                   round(total_count / sum(total_count) OVER (), 6) AS share
            FROM type_totals""",
        "page_totals": f"WITH {PAGE_TOTALS} SELECT page, count FROM page_totals",
        "top_pages": f"WITH {PAGE_TOTALS} SELECT page, count FROM best_pages",
        "page_shares": f"""WITH {PAGE_TOTALS}
            SELECT page AS key, count, round(count / sum(count) OVER (), 6) AS share
            FROM best_pages""",
        "cycle_summary": f"""WITH {DIRTY},
            gated AS (SELECT * FROM dirty WHERE avg_duration_ms BETWEEN 0 AND 300000),
            first_copies AS (
                SELECT * FROM gated QUALIFY
                    row_number() OVER (PARTITION BY window_start, window_end ORDER BY seq) = 1
            )
            SELECT (SELECT count(*) FROM first_copies WHERE total_events > 0) AS clean_windows,
                   count(*) AS total_windows,
                   CAST(sum(total_events) AS BIGINT) AS total_events,
                   round(sum(total_events) / count(*), 6) AS avg_events_per_window,
                   arg_min(date_trunc('millisecond', window_start),
                           (-total_events, window_start)) AS peak_start,
                   max(total_events) AS peak_events
            FROM gated""",
    }
