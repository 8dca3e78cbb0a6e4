"""Oracle SQL (DuckDB dialect) for the registered queries.

Each string runs on the test tables as views and must give the same rows,
column names and types as the Spark query of the same key.
"""

from __future__ import annotations

# The events table as the detector sees it (see sources/events.py).
def events_cte(name: str = "ev", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT ts AS unixTime,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS categoryId,
         CAST(user_id AS VARCHAR) AS ipAddress,
         event_type AS eventType
  FROM events WHERE {where})"""


EVENTS_CTE = events_cte()


def windows_cte(source: str = "ev", slide_minutes: int = 720, panes: int = 2) -> str:
    """Sliding windows as SQL: an event at t lies in the windows starting at
    bucket(t) - i * slide for i in 0 .. panes-1 (epoch-aligned buckets)."""
    shifts = ", ".join(str(i) for i in range(panes))
    return f"""wx AS (
  SELECT *, unnest([{shifts}]) AS i FROM {source}),
win AS (
  SELECT time_bucket(INTERVAL '{slide_minutes} minutes', unixTime, TIMESTAMP '1970-01-01')
           - i * INTERVAL '{slide_minutes} minutes' AS window_start,
         time_bucket(INTERVAL '{slide_minutes} minutes', unixTime, TIMESTAMP '1970-01-01')
           - i * INTERVAL '{slide_minutes} minutes' + INTERVAL '{slide_minutes * panes} minutes' AS window_end,
         unixTime, categoryId, ipAddress, eventType
  FROM wx)"""


FEATURES_SELECT = """SELECT window_start, window_end, ipAddress,
         count(unixTime) AS amount,
         CAST(count(CASE WHEN eventType = 'click' THEN unixTime END) AS DOUBLE)
           / NULLIF(count(CASE WHEN eventType = 'view' THEN unixTime END), 0) AS rate,
         CAST(count(DISTINCT categoryId) AS INTEGER) AS categories
  FROM win GROUP BY window_start, window_end, ipAddress"""

FLAG_WHERE = "amount > 10 OR rate > 3 OR categories > 5"


def features_sql(source_cte: str = EVENTS_CTE, slide_minutes: int = 720, panes: int = 2) -> str:
    return f"WITH {source_cte},\n{windows_cte('ev', slide_minutes, panes)},\nfeat AS ({FEATURES_SELECT})"


def flagged_sql(source_cte: str = EVENTS_CTE) -> str:
    return f"{features_sql(source_cte)}\nSELECT * FROM feat WHERE {FLAG_WHERE}"


def _printf_object(quote: str = '"') -> str:
    q = quote
    return (f"""printf('{{{q}unix_time{q}: %d, {q}category_id{q}: %d, {q}ip{q}: "%s", {q}type{q}: "%s"}}', """
            "CAST(epoch(date_trunc('second', ts)) AS BIGINT), "
            "CAST(json_extract_string(props, '$.k') AS INTEGER), CAST(user_id AS VARCHAR), event_type)")


# Raw lines rendered from events, shape by event type (sources/events.py).
LINES_CTE = f"""lines AS (
  SELECT event_id, ts, user_id, event_type,
         {_printf_object()} AS plain,
         {_printf_object('')} AS broken
  FROM events),
raw AS (
  SELECT event_id, event_type,
         CASE event_type
           WHEN 'purchase' THEN '"' || replace(plain, '"', '\\"') || '",'
           WHEN 'signup' THEN '[' || plain || ','
           WHEN 'error' THEN broken
           ELSE plain || ',' END AS value,
         '"' || replace(plain, '"', '\\"') || '"' AS kafka_value
  FROM lines)"""

GROOM = "regexp_extract(replace({col}, '\\', ''), '(\\{{.*\\}})', 1)"
GROOM_ANCHORED = "regexp_extract(replace({col}, '\\', ''), '^\\[?(\\{{.*\\}})[\\,\\]]?$', 1)"


def parsed_sql(col: str = "value", time_type: str = "timestamp") -> str:
    """Groomed lines parsed by DuckDB's JSON functions; lines that are not
    valid JSON or lack time or address are dropped."""
    unix = "CAST(json_extract(j, '$.unix_time') AS BIGINT)"
    time = f"make_timestamp({unix} * 1000000)" if time_type == "timestamp" else unix
    return f"""WITH {LINES_CTE},
groomed AS (SELECT {GROOM.format(col=col)} AS j FROM raw),
ok AS (SELECT j FROM groomed WHERE j <> '' AND json_valid(j))
SELECT {time} AS unixTime,
       CAST(json_extract(j, '$.category_id') AS INTEGER) AS categoryId,
       json_extract_string(j, '$.ip') AS ipAddress,
       json_extract_string(j, '$.type') AS eventType
FROM ok
WHERE json_extract(j, '$.unix_time') IS NOT NULL AND json_extract_string(j, '$.ip') IS NOT NULL"""


def flagged_cte(source: str, name: str) -> str:
    """Flagged daily windows of the events in CTE ``source`` as CTE ``name``."""
    return f"""{name}_wx AS (SELECT *, unnest([0, 1]) AS i FROM {source}),
{name}_win AS (
  SELECT time_bucket(INTERVAL '720 minutes', unixTime, TIMESTAMP '1970-01-01')
           - i * INTERVAL '720 minutes' AS window_start,
         time_bucket(INTERVAL '720 minutes', unixTime, TIMESTAMP '1970-01-01')
           - i * INTERVAL '720 minutes' + INTERVAL '1440 minutes' AS window_end,
         unixTime, categoryId, ipAddress, eventType
  FROM {name}_wx),
{name}_feat AS ({FEATURES_SELECT.replace('FROM win', f'FROM {name}_win')}),
{name} AS (SELECT * FROM {name}_feat WHERE {FLAG_WHERE})"""


def bots_cte(as_of: str) -> str:
    """The bot table built from the events before ``as_of``: one row per
    flagged address, latest window end, created at that end."""
    return f"""{events_cte('early', f"ts < TIMESTAMP '{as_of}'")},
{flagged_cte('early', 'early_flagged')},
bots AS (SELECT ipAddress, max(window_end) AS "end", max(window_end) AS created_at
         FROM early_flagged GROUP BY ipAddress)"""


def block_list_rounds_sql(round_days: int = 5) -> str:
    """The self-feeding block list of ``availableNow`` rounds over
    ``round_days`` slices of events, as one SQL query.

    An address keeps all its events until it is listed, so its state in a
    window after round r is the aggregate of its events there up to round r.
    It is listed in the first round r in which a window it touched in round
    r crosses a threshold; its entry holds the latest end of those windows
    and is created at the end of round r. Times are whole seconds, as the
    raw lines carry them.
    """
    step = round_days * 86400
    return f"""WITH ev AS (
  SELECT date_trunc('second', ts) AS unixTime,
         CAST(floor(epoch(ts) / {step}) AS BIGINT) AS r,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS categoryId,
         CAST(user_id AS VARCHAR) AS ipAddress, event_type AS eventType
  FROM events),
wx AS (SELECT *, unnest([0, 1]) AS i FROM ev),
win AS (
  SELECT time_bucket(INTERVAL '720 minutes', unixTime, TIMESTAMP '1970-01-01') - i * INTERVAL '720 minutes' AS window_start,
         r, categoryId, ipAddress, eventType
  FROM wx),
cell AS (
  SELECT ipAddress, window_start, r, count(*) AS n,
         count(CASE WHEN eventType = 'click' THEN 1 END) AS c,
         count(CASE WHEN eventType = 'view' THEN 1 END) AS v
  FROM win GROUP BY ipAddress, window_start, r),
cum AS (
  SELECT ipAddress, window_start, r,
         sum(n) OVER w AS amount, sum(c) OVER w AS clicks, sum(v) OVER w AS views
  FROM cell WINDOW w AS (PARTITION BY ipAddress, window_start ORDER BY r)),
first_cat AS (
  SELECT ipAddress, window_start, categoryId, min(r) AS r0
  FROM win WHERE categoryId IS NOT NULL GROUP BY ipAddress, window_start, categoryId),
state AS (
  SELECT cum.ipAddress, cum.window_start, cum.r, cum.amount, cum.clicks, cum.views,
         count(first_cat.categoryId) AS categories
  FROM cum LEFT JOIN first_cat
    ON first_cat.ipAddress = cum.ipAddress AND first_cat.window_start = cum.window_start
   AND first_cat.r0 <= cum.r
  GROUP BY ALL),
flag AS (
  SELECT * FROM state
  WHERE amount > 10 OR CAST(clicks AS DOUBLE) / NULLIF(views, 0) > 3 OR categories > 5),
listed AS (SELECT ipAddress, min(r) AS r FROM flag GROUP BY ipAddress)
SELECT flag.ipAddress,
       max(flag.window_start) + INTERVAL '1 day' AS "end",
       TIMESTAMP '1970-01-01' + to_seconds((listed.r + 1) * {step}) AS created_at
FROM flag JOIN listed ON flag.ipAddress = listed.ipAddress AND flag.r = listed.r
GROUP BY flag.ipAddress, listed.r"""


def commits_sql(ends) -> str:
    """Runs over the events before each of ``ends``; the first run that flags an
    address lists it, with the latest end that this run flags."""
    parts, ctes = [], []
    for i, end in enumerate(ends):
        ctes += [events_cte(f"ev{i}", f"ts < TIMESTAMP '{end.isoformat(sep=' ')}'"), flagged_cte(f"ev{i}", f"f{i}")]
        parts.append(f"""SELECT {i} AS run, ipAddress, max(window_end) AS "end", TIMESTAMP '{end.isoformat(sep=' ')}' AS created_at
FROM f{i} GROUP BY ipAddress""")
    return f"""WITH {", ".join(ctes)},
runs AS ({" UNION ALL ".join(parts)})
SELECT ipAddress, "end", created_at FROM runs QUALIFY row_number() OVER (PARTITION BY ipAddress ORDER BY run) = 1"""


def block_list_expiry_sql(round_days: int, ttl_hours: int) -> str:
    """The self-feeding block list with expiry, round by round.

    A window touches at most two neighbouring rounds, so its state after round
    r holds the address's events of round r and, unless they were dropped,
    of round r - 1 (``with_last``). An entry made at the end of round L is alive at
    the start of the rounds up to L + ``span``.
    """
    step = round_days * 86400
    span = -(-ttl_hours * 3600 // step)     # rounds that begin while an entry is alive
    feat = """SELECT ipAddress, window_start, r FROM {rows} GROUP BY ipAddress, window_start, r HAVING max(own) = 1 AND (count(*) > 10
         OR CAST(count(CASE WHEN eventType = 'click' THEN 1 END) AS DOUBLE) / NULLIF(count(CASE WHEN eventType = 'view' THEN 1 END), 0) > 3
         OR count(DISTINCT categoryId) > 5)"""
    return f"""WITH RECURSIVE ev AS (
  SELECT date_trunc('second', ts) AS unixTime, CAST(floor(epoch(ts) / {step}) AS BIGINT) AS r,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS categoryId,
         CAST(user_id AS VARCHAR) AS ipAddress, event_type AS eventType
  FROM events),
win AS (
  SELECT time_bucket(INTERVAL '720 minutes', unixTime, TIMESTAMP '1970-01-01') - i * INTERVAL '720 minutes' AS window_start,
         r, 1 AS own, categoryId, ipAddress, eventType
  FROM (SELECT *, unnest([0, 1]) AS i FROM ev)),
twice AS (SELECT * FROM win UNION ALL SELECT window_start, r + 1, 0, categoryId, ipAddress, eventType FROM win),
alone AS ({feat.format(rows='win')}),
with_last AS ({feat.format(rows='twice')}),
flags AS (
  SELECT ipAddress, r, max(CASE WHEN k = 'both' THEN window_start END) AS both_start, max(CASE WHEN k = 'alone' THEN window_start END) AS alone_start
  FROM (SELECT 'both' AS k, * FROM with_last UNION ALL SELECT 'alone', * FROM alone) GROUP BY ipAddress, r),
bounds AS (SELECT min(r) AS lo, max(r) AS hi FROM ev),
rounds AS (
  SELECT ipAddress, (SELECT lo FROM bounds) - 1 AS r, CAST(NULL AS BIGINT) AS listed, CAST(NULL AS TIMESTAMP) AS last_start
  FROM (SELECT DISTINCT ipAddress FROM flags)
  UNION ALL
  SELECT x.ipAddress, x.r + 1,
         CASE WHEN coalesce(x.r + 1 - listed <= {span}, false) THEN listed
              WHEN coalesce(x.r - listed <= {span} AND x.r <> listed, false) THEN CASE WHEN alone_start IS NOT NULL THEN x.r + 1 ELSE listed END
              WHEN both_start IS NOT NULL THEN x.r + 1 ELSE listed END,
         CASE WHEN coalesce(x.r + 1 - listed <= {span}, false) THEN last_start
              WHEN coalesce(x.r - listed <= {span} AND x.r <> listed, false) THEN CASE WHEN alone_start IS NOT NULL THEN alone_start ELSE last_start END
              WHEN both_start IS NOT NULL THEN both_start ELSE last_start END
  FROM rounds x LEFT JOIN flags f ON f.ipAddress = x.ipAddress AND f.r = x.r + 1
  WHERE x.r < (SELECT hi FROM bounds))
SELECT ipAddress, last_start + INTERVAL '1 day' AS "end", TIMESTAMP '1970-01-01' + to_seconds((listed + 1) * {step}) AS created_at
FROM rounds WHERE r = (SELECT hi FROM bounds) AND (r + 1 - (listed + 1)) * {step} < {ttl_hours * 3600}"""


SECONDS_CTE = events_cte("raw_ev").replace("SELECT ts AS unixTime", "SELECT date_trunc('second', ts) AS unixTime, event_id, ts")


def late_rows_sql(round_days: int, delay_seconds: int = 60) -> str:
    """Per window and address, events that an update-mode aggregate keeps and
    events that come after the window was closed. An event arrives in the round
    of its time, or one or two rounds later; a round drops what lies in windows
    that end by the watermark of all earlier rounds."""
    step = round_days * 86400
    return f"""WITH {SECONDS_CTE},
ev AS (
  SELECT *, CAST(floor(epoch(ts) / {step}) AS BIGINT) + {ARRIVAL_DELAY} AS arrival FROM raw_ev),
marks AS (SELECT arrival, max(unixTime) AS latest FROM ev GROUP BY arrival),
before AS (
  SELECT a.arrival, max(b.latest) - INTERVAL '{delay_seconds} seconds' AS watermark
  FROM marks a LEFT JOIN marks b ON b.arrival < a.arrival GROUP BY a.arrival),
win AS (
  SELECT time_bucket(INTERVAL '720 minutes', unixTime, TIMESTAMP '1970-01-01') - i * INTERVAL '720 minutes' AS window_start,
         ipAddress, arrival FROM (SELECT *, unnest([0, 1]) AS i FROM ev)),
seen AS (
  SELECT window_start, window_start + INTERVAL '1440 minutes' AS window_end, ipAddress,
         coalesce(window_start + INTERVAL '1440 minutes' <= watermark, false) AS late
  FROM win JOIN before ON before.arrival = win.arrival)
SELECT window_start, window_end, ipAddress, count(*) FILTER (NOT late) AS kept, count(*) FILTER (late) AS late
FROM seen GROUP BY window_start, window_end, ipAddress"""


# Rounds by which an event comes late (the same in Spark and DuckDB).
ARRIVAL_DELAY = "CASE WHEN event_id % 97 = 0 THEN 2 WHEN event_id % 10 = 0 THEN 1 ELSE 0 END"


def closed_windows_sql(select: str, delay_seconds: int = 60) -> str:
    """Windows that have closed by the last watermark."""
    return f"""WITH {SECONDS_CTE}, ev AS (SELECT unixTime, categoryId, ipAddress, eventType FROM raw_ev),
{windows_cte('ev')},
feat AS ({FEATURES_SELECT}),
mark AS (SELECT max(unixTime) - INTERVAL '{delay_seconds} seconds' AS watermark FROM ev)
SELECT {select} FROM feat, mark WHERE window_end <= watermark"""


def state_lookup_sql(ttl_hours: int) -> str:
    """Listings at the first event that crosses a threshold. A window's crossing
    time comes from running counts over its events in order; an address is
    listed at the earliest crossing among windows that begin once its last
    entry has expired."""
    order = "ORDER BY unixTime, eventType, categoryId NULLS FIRST ROWS UNBOUNDED PRECEDING"
    return f"""WITH RECURSIVE {SECONDS_CTE}, ev AS (SELECT unixTime, categoryId, ipAddress, eventType FROM raw_ev),
{windows_cte('ev')},
marked AS (
  SELECT *, categoryId IS NOT NULL AND row_number() OVER (PARTITION BY ipAddress, window_start, categoryId ORDER BY unixTime, eventType) = 1 AS first_seen
  FROM win),
running AS (
  SELECT ipAddress, window_start, unixTime, count(*) OVER w AS amount, count(*) FILTER (eventType = 'click') OVER w AS clicks,
         count(*) FILTER (eventType = 'view') OVER w AS views, count(*) FILTER (first_seen) OVER w AS categories
  FROM marked WINDOW w AS (PARTITION BY ipAddress, window_start {order})),
crossed AS (
  SELECT ipAddress, window_start, min(unixTime) AS hit FROM running
  WHERE amount > 10 OR CAST(clicks AS DOUBLE) / NULLIF(views, 0) > 3 OR categories > 5 GROUP BY ipAddress, window_start),
listed AS (
  SELECT ipAddress, TIMESTAMP '1900-01-01' AS since, min(hit) AS hit FROM crossed GROUP BY ipAddress
  UNION ALL
  SELECT l.ipAddress, l.hit + INTERVAL {ttl_hours} HOUR, min(c.hit) FROM listed l
  JOIN crossed c ON c.ipAddress = l.ipAddress AND c.window_start >= l.hit + INTERVAL {ttl_hours} HOUR GROUP BY l.ipAddress, l.hit)
SELECT l.ipAddress, max(c.window_start) + INTERVAL 1 DAY AS "end", l.hit AS listed_at
FROM listed l JOIN crossed c ON c.ipAddress = l.ipAddress AND c.hit = l.hit AND c.window_start >= l.since GROUP BY l.ipAddress, l.hit"""
