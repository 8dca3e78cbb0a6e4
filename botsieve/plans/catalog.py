"""Registry of named queries over the test tables, with their oracle SQL.

Every query reads whole tables of ``sf_dir`` (or rows Spark derives from
them) and returns a batch DataFrame. Window structs are flattened to
``window_start, window_end`` as TIMESTAMP_NTZ wall-clock values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botsieve.functions.features import click_view_rate, count_of_type, ts_lit
from botsieve.functions.parse import corrupt_records, decode_value, groom, parse_events
from botsieve.operators import relational as R
from botsieve.operators.blocklist import (active, antijoin_bots, flagged_ips, merge_into, one_row_per_ip, read_bots,
                                          semijoin_bots, write_bots)
from botsieve.operators.committed import CommittedBots
from botsieve.operators.jointree import Join, Table, join_tree
from botsieve.operators.ranges import range_join
from botsieve.operators.windows import flatten_window, window_features
from botsieve.params import DAILY, Thresholds, WindowSpec
from botsieve.plans import oracle as O
from botsieve.plans.detect import bots_as_of, flagged_after_lookup, flagged_windows
from botsieve.session import pin_utc, work_dir
from botsieve.sources.events import clicks_from_events, event_lines, kafka_records
from botsieve.sources.shared_files import SharedFiles
from botsieve.sources.tables import as_global_view, as_view, table
from botsieve.streaming.closing import run_distinct_categories
from botsieve.streaming.rounds import (round_starts, stream_antijoin, stream_block_list, stream_block_list_expiry,
                                       stream_closed_windows, stream_flagged_windows, stream_kafka_parse,
                                       stream_late_rows, stream_rows, stream_running, stream_state_lookup, stream_tee,
                                       stream_text)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return clicks_from_events(table(spark, sf_dir, "events"))


# ---------------------------------------------------------------- features --

@register("flagged_windows", O.flagged_sql())
def q_flagged_windows(spark, sf_dir):
    """Q1/F1/A5 in batch: 1 day / 12 h windows, thresholds 10 / 3 / 5."""
    return flatten_window(flagged_windows(clicks(spark, sf_dir), DAILY, Thresholds()), ntz=True)


@register("sliding_window_counts", f"""WITH {O.EVENTS_CTE},
{O.windows_cte('ev', 5, 2)}
SELECT window_start, window_end, ipAddress, count(unixTime) AS amount
FROM win GROUP BY window_start, window_end, ipAddress""")
def q_sliding_window_counts(spark, sf_dir):
    """10 min / 5 min windows, every event in two of them, no threshold."""
    feats = (clicks(spark, sf_dir)
             .groupBy(F.window("unixTime", WindowSpec().duration, WindowSpec().slide), "ipAddress")
             .agg(F.count("unixTime").alias("amount")))
    return flatten_window(feats, ntz=True)


@register("window_amount", f"""{O.features_sql()}
SELECT window_start, window_end, ipAddress, amount FROM feat""")
def q_window_amount(spark, sf_dir):
    """A1: events per (window, address)."""
    feats = window_features(clicks(spark, sf_dir), DAILY)
    return flatten_window(feats.select("window", "ipAddress", "amount"), ntz=True)


@register("click_view_rate", f"""WITH {O.EVENTS_CTE},
{O.windows_cte('ev', 720, 2)}
SELECT window_start, window_end, ipAddress,
       count(CASE WHEN eventType = 'click' THEN unixTime END) AS clicks,
       count(CASE WHEN eventType = 'view' THEN unixTime END) AS views,
       CAST(count(CASE WHEN eventType = 'click' THEN unixTime END) AS DOUBLE)
         / NULLIF(count(CASE WHEN eventType = 'view' THEN unixTime END), 0) AS rate
FROM win GROUP BY window_start, window_end, ipAddress""")
def q_click_view_rate(spark, sf_dir):
    """Clicks, views and their ratio (null without views)."""
    feats = (clicks(spark, sf_dir)
             .groupBy(F.window("unixTime", DAILY.duration, DAILY.slide), "ipAddress")
             .agg(count_of_type("click").alias("clicks"), count_of_type("view").alias("views"),
                  click_view_rate()))
    return flatten_window(feats, ntz=True)


@register("distinct_categories", f"""{O.features_sql()}
SELECT window_start, window_end, ipAddress, categories FROM feat""")
def q_distinct_categories(spark, sf_dir):
    """``size(collect_set(categoryId))`` per (window, address)."""
    feats = window_features(clicks(spark, sf_dir), DAILY)
    return flatten_window(feats.select("window", "ipAddress", "categories"), ntz=True)


# ----------------------------------------------------------------- parsing --

def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return event_lines(table(spark, sf_dir, "events"))


@register("groom_lines", f"""WITH {O.LINES_CTE}
SELECT {O.GROOM.format(col='value')} AS json FROM raw""")
def q_groom_lines(spark, sf_dir):
    """Backslashes out, greedy ``{...}`` cut (empty string without match)."""
    return lines(spark, sf_dir).select(groom("value").alias("json"))


@register("groom_lines_anchored", f"""WITH {O.LINES_CTE}
SELECT {O.GROOM_ANCHORED.format(col='value')} AS json FROM raw""")
def q_groom_lines_anchored(spark, sf_dir):
    """The anchored array-line pattern; a quoted line gives an empty string."""
    return lines(spark, sf_dir).select(groom("value", anchored=True).alias("json"))


@register("parse_events", O.parsed_sql())
def q_parse_events(spark, sf_dir):
    """P5/P7/P8/P9 and the explicit key check: lines -> typed events."""
    parsed = parse_events(lines(spark, sf_dir))
    return parsed.withColumn("unixTime", F.col("unixTime").cast("timestamp_ntz"))


@register("corrupt_records", f"""WITH {O.LINES_CTE},
groomed AS (SELECT {O.GROOM.format(col='value')} AS j FROM raw)
SELECT j AS value FROM groomed WHERE j <> '' AND NOT json_valid(j)""")
def q_corrupt_records(spark, sf_dir):
    """Groomed lines the JSON reader rejects."""
    return corrupt_records(lines(spark, sf_dir))


@register("kafka_value_decode", """WITH """ + O.LINES_CTE + """
SELECT event_id AS "offset", CAST(user_id % 3 AS INTEGER) AS "partition", kafka_value AS value
FROM raw JOIN lines USING (event_id)""")
def q_kafka_value_decode(spark, sf_dir):
    """Kafka records (value bytes) -> value string."""
    pin_utc(spark)
    recs = kafka_records(table(spark, sf_dir, "events"))
    return recs.select("offset", "partition", decode_value("value").alias("value"))


@register("parse_events_long", O.parsed_sql("kafka_value", time_type="long"))
def q_parse_events_long(spark, sf_dir):
    """P6 + P1: Kafka values parsed with epoch seconds kept as BIGINT."""
    pin_utc(spark)
    recs = kafka_records(table(spark, sf_dir, "events"))
    return parse_events(recs, "value", time_type="long")


# -------------------------------------------------------------- block list --
# The bot table of the batch queries is what a detector run over the events
# before AS_OF leaves; the queries then run over all events.
AS_OF = datetime(2024, 1, 15)
MERGE_TIME = datetime(2024, 2, 1)
ACTIVE_AS_OF = datetime(2024, 1, 15, 12)
BOTS_SQL = O.bots_cte(AS_OF.isoformat(sep=" "))
NTZ_BOT_COLS = ['ipAddress', 'CAST("end" AS TIMESTAMP) AS "end"', "CAST(created_at AS TIMESTAMP) AS created_at"]


_BOT_TABLES: dict[tuple, str] = {}


def bots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bot table as a stored table: derived from ``events``, written to the
    shared folder and read from there (so the size check and the joins scan it
    instead of deriving it again). It is derived anew once the files of
    ``events`` are others than those it came from, or the table is gone."""
    files = SharedFiles(spark)
    events = f"{sf_dir.rstrip('/')}/events.parquet"
    key = (spark.sparkContext.applicationId, events, *sorted(files.names(events).items()))
    path = _BOT_TABLES.get(key)
    if path is None or "_SUCCESS" not in files.names(path):
        path = work_dir(spark, "bots")
        write_bots(bots_as_of(clicks(spark, sf_dir), AS_OF, DAILY, Thresholds()), path)
        _BOT_TABLES[key] = path
    pin_utc(spark)
    return read_bots(spark, path)


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


@register("flagged_ips", f"""WITH {O.EVENTS_CTE},
{O.flagged_cte('ev', 'flagged')}
SELECT ipAddress, window_end AS "end" FROM flagged""")
def q_flagged_ips(spark, sf_dir):
    """``select("ipAddress", "window.end")`` of the flagged windows."""
    return ntz(flagged_ips(flagged_windows(clicks(spark, sf_dir), DAILY)), "end")


@register("bots_table_scan", f"""WITH {BOTS_SQL}
SELECT * FROM bots""")
def q_bots_table_scan(spark, sf_dir):
    """S3/K1/K5: the bot table written to the shared folder and read back."""
    return ntz(bots(spark, sf_dir), "end", "created_at")


@register("bots_view_sql", f"""WITH {BOTS_SQL}
SELECT CAST(CAST("end" AS DATE) AS TIMESTAMP) AS day, count(*) AS bots FROM bots GROUP BY 1""")
def q_bots_view_sql(spark, sf_dir):
    """The bot table as temp view ``bots``, queried with SQL."""
    as_view(bots(spark, sf_dir), "bots")
    return spark.sql("SELECT CAST(CAST(`end` AS DATE) AS TIMESTAMP_NTZ) AS day, count(*) AS bots "
                     "FROM bots GROUP BY 1")


@register("events_global_view", f"""WITH {O.EVENTS_CTE}
SELECT eventType, count(*) AS events, count(DISTINCT ipAddress) AS addresses FROM ev GROUP BY eventType""")
def q_events_global_view(spark, sf_dir):
    """Parsed events as global temp view ``events`` (also works on a stream)."""
    as_global_view(clicks(spark, sf_dir), "events")
    return spark.sql("SELECT eventType, count(*) AS events, count(DISTINCT ipAddress) AS addresses "
                     "FROM global_temp.events GROUP BY eventType")


@register("antijoin_bots", f"""WITH {O.EVENTS_CTE}, {BOTS_SQL}
SELECT * FROM ev WHERE NOT EXISTS (SELECT 1 FROM bots WHERE bots.ipAddress = ev.ipAddress)""")
def q_antijoin_bots(spark, sf_dir):
    """Events of addresses not on the list (size-checked broadcast)."""
    return ntz(antijoin_bots(clicks(spark, sf_dir), bots(spark, sf_dir)), "unixTime")


@register("bot_lookup_semi", f"""WITH {O.EVENTS_CTE}, {BOTS_SQL}
SELECT * FROM ev WHERE EXISTS (SELECT 1 FROM bots WHERE bots.ipAddress = ev.ipAddress)""")
def q_bot_lookup_semi(spark, sf_dir):
    """Events of listed addresses (the positive key probe)."""
    return ntz(semijoin_bots(clicks(spark, sf_dir), bots(spark, sf_dir)), "unixTime")


@register("flagged_after_lookup", f"""WITH {O.EVENTS_CTE}, {BOTS_SQL},
kept AS (SELECT * FROM ev WHERE NOT EXISTS (SELECT 1 FROM bots WHERE bots.ipAddress = ev.ipAddress)),
{O.flagged_cte('kept', 'flagged')}
SELECT * FROM flagged""")
def q_flagged_after_lookup(spark, sf_dir):
    """Q2 (flagship) in batch: lookup, then windows and thresholds."""
    out = flagged_after_lookup(clicks(spark, sf_dir), bots(spark, sf_dir), DAILY, Thresholds())
    return flatten_window(out, ntz=True)


@register("block_list_merge", f"""WITH {O.EVENTS_CTE}, {BOTS_SQL},
{O.flagged_cte('ev', 'flagged')},
fresh AS (SELECT ipAddress, max(window_end) AS "end", TIMESTAMP '{MERGE_TIME.isoformat(sep=' ')}' AS created_at
          FROM flagged WHERE ipAddress NOT IN (SELECT ipAddress FROM bots) GROUP BY ipAddress)
SELECT * FROM bots UNION ALL SELECT * FROM fresh""")
def q_block_list_merge(spark, sf_dir):
    """K1/K2: put-if-absent of all flagged addresses into the bot table."""
    path = work_dir(spark, "bots-merge")
    write_bots(bots(spark, sf_dir), path)
    merge_into(path, flagged_windows(clicks(spark, sf_dir), DAILY), created_at=MERGE_TIME)
    return ntz(read_bots(spark, path), "end", "created_at")


COMMITS = (datetime(2024, 1, 12), datetime(2024, 1, 18), datetime(2024, 2, 1))


@register("block_list_commits", O.commits_sql(COMMITS))
def q_block_list_commits(spark, sf_dir):
    """K1-K3: three detector runs over overlapping spans of events, merged into
    one commit-logged table. The second run plans its merge before the first
    commits, loses the race, and merges anew: one row per address, that of the
    first commit."""
    events = clicks(spark, sf_dir)
    path = work_dir(spark, "bots-commits")
    runs = [one_row_per_ip(flagged_ips(flagged_windows(events.where(F.col("unixTime") < ts_lit(end)), DAILY, Thresholds()))) for end in COMMITS]
    first, second = CommittedBots(spark, path), CommittedBots(spark, path)
    second.before_commit = [lambda: first.merge(runs[0], created_at=COMMITS[0])]
    second.merge(runs[1], created_at=COMMITS[1])
    second.merge(runs[2], created_at=COMMITS[2])
    return ntz(second.read(), "end", "created_at")


@register("block_list_active", f"""WITH {BOTS_SQL}
SELECT * FROM bots
WHERE created_at > TIMESTAMP '{ACTIVE_AS_OF.isoformat(sep=' ')}' - INTERVAL 24 HOUR
  AND created_at <= TIMESTAMP '{ACTIVE_AS_OF.isoformat(sep=' ')}'""")
def q_block_list_active(spark, sf_dir):
    """K4: entries alive at ACTIVE_AS_OF under the 24 h created-expiry."""
    return ntz(active(bots(spark, sf_dir), ACTIVE_AS_OF), "end", "created_at")


# -------------------------------------------------------------- relational --

def t(spark: SparkSession, sf_dir: str, *names: str):
    pin_utc(spark)
    return [table(spark, sf_dir, n) for n in names]


@register("table_project", """SELECT l_orderkey, l_linenumber, l_quantity AS qty,
       l_extendedprice * (1.0 - l_discount) AS revenue, 'USD' AS currency FROM lineitem""")
def q_table_project(spark, sf_dir):
    return R.project(*t(spark, sf_dir, "lineitem"))


@register("table_filter", """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""")
def q_table_filter(spark, sf_dir):
    return R.filter_rows(*t(spark, sf_dir, "lineitem"))


@register("table_sort", """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderkey""")
def q_table_sort(spark, sf_dir):
    return R.sort_all(*t(spark, sf_dir, "orders"))


@register("table_topk", """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_table_topk(spark, sf_dir):
    return R.top_k(*t(spark, sf_dir, "orders"), k=10)


@register("table_union_all", """SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, 'customer' AS kind FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier
UNION ALL SELECT n_name, n_nationkey, CAST(NULL AS DOUBLE), 'nation' FROM nation""")
def q_table_union_all(spark, sf_dir):
    return R.union_all(*t(spark, sf_dir, "customer", "supplier", "nation"))


@register("table_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def q_table_distinct(spark, sf_dir):
    return R.distinct_rows(*t(spark, sf_dir, "orders"))


@register("table_group_agg", """SELECT l_returnflag, l_linestatus,
       sum(l_quantity) AS sum_qty,
       CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS DOUBLE) AS sum_base_price,
       CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))) AS DECIMAL(38,4)) AS DOUBLE) AS sum_disc_price,
       avg(l_quantity) AS avg_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS avg_price,
       min(l_discount) AS min_disc, max(l_discount) AS max_disc,
       min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
       count(*) AS count_order
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_table_group_agg(spark, sf_dir):
    return R.group_agg(*t(spark, sf_dir, "lineitem"))


@register("table_nested_agg", """WITH per_cust AS (
  SELECT c_custkey, count(o_orderkey) AS c_count FROM customer LEFT JOIN orders ON c_custkey = o_custkey
  GROUP BY c_custkey)
SELECT c_count, count(*) AS custdist FROM per_cust GROUP BY c_count""")
def q_table_nested_agg(spark, sf_dir):
    return R.nested_agg(*t(spark, sf_dir, "customer", "orders"))


@register("table_having", """SELECT l_orderkey, sum(l_quantity) AS total_qty, count(*) AS lines
FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 150""")
def q_table_having(spark, sf_dir):
    return R.having(*t(spark, sf_dir, "lineitem"), min_qty=150.0)


@register("table_count_distinct", """SELECT l_returnflag, count(*) AS n_lines,
       count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts
FROM lineitem GROUP BY l_returnflag""")
def q_table_count_distinct(spark, sf_dir):
    return R.count_distinct(*t(spark, sf_dir, "lineitem"))


@register("join_inner", """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_join_inner(spark, sf_dir):
    return R.join_inner(*t(spark, sf_dir, "orders", "customer"))


@register("join_left", """SELECT c_custkey, c_name, o_orderkey, o_orderstatus
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def q_join_left(spark, sf_dir):
    return R.join_left(*t(spark, sf_dir, "customer", "orders"))


@register("join_right", """SELECT c_custkey, o_orderkey, o_orderstatus
FROM orders RIGHT JOIN customer ON o_custkey = c_custkey""")
def q_join_right(spark, sf_dir):
    return R.join_right(*t(spark, sf_dir, "orders", "customer"))


@register("join_full", """WITH qty AS (SELECT l_partkey, sum(l_quantity) AS shipped_qty FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, l_partkey, p_name, shipped_qty FROM part FULL OUTER JOIN qty ON p_partkey = l_partkey""")
def q_join_full(spark, sf_dir):
    return R.join_full(*t(spark, sf_dir, "part", "lineitem"))


@register("join_semi", """SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def q_join_semi(spark, sf_dir):
    return R.join_semi(*t(spark, sf_dir, "customer", "orders"))


@register("join_anti", """SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def q_join_anti(spark, sf_dir):
    return R.join_anti(*t(spark, sf_dir, "customer", "orders"))


@register("join_self", """SELECT a.o_orderkey, b.o_orderkey AS next_orderkey, b.o_totalprice - a.o_totalprice AS price_change
FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1""")
def q_join_self(spark, sf_dir):
    return R.join_self(*t(spark, sf_dir, "orders"))


@register("join_derived", """WITH revenue AS (
  SELECT l_orderkey, CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))) AS DECIMAL(38,4)) AS DOUBLE) AS revenue
  FROM lineitem GROUP BY l_orderkey),
recent AS (
  SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01')
SELECT o_orderkey, o_orderdate, o_orderpriority, revenue FROM recent JOIN revenue ON o_orderkey = l_orderkey""")
def q_join_derived(spark, sf_dir):
    return R.join_derived(*t(spark, sf_dir, "lineitem", "orders"))


@register("join_range", f"""WITH {O.EVENTS_CTE},
{O.flagged_cte('ev', 'flagged')},
blocked AS (SELECT ipAddress, window_end AS blocked_from, window_end + INTERVAL 24 HOUR AS blocked_until FROM flagged)
SELECT ev.unixTime, ev.categoryId, ev.ipAddress, ev.eventType, blocked_from, blocked_until
FROM ev JOIN blocked ON blocked.ipAddress = ev.ipAddress AND unixTime >= blocked_from AND unixTime < blocked_until""")
def q_join_range(spark, sf_dir):
    """J3 with a non-equi condition: events of an address while it is blocked."""
    events = clicks(spark, sf_dir)
    blocked = flagged_windows(events, DAILY).select(F.col("ipAddress").alias("blocked_address"), F.col("window.end").alias("blocked_from"),
                                                    (F.col("window.end") + F.expr("INTERVAL 24 HOURS")).alias("blocked_until"))
    out = range_join(events, blocked, [("ipAddress", "blocked_address")], "unixTime", "blocked_from", "blocked_until", width_seconds=43_200)
    return ntz(out.drop("blocked_address"), "unixTime", "blocked_from", "blocked_until")


@register("join_renamed", """SELECT a.l_orderkey AS a_l_orderkey, a.l_linenumber AS a_l_linenumber, pa.p_brand AS pa_p_brand,
       b.l_linenumber AS b_l_linenumber, pb.p_brand AS pb_p_brand, o_orderpriority
FROM (lineitem a JOIN part pa ON a.l_partkey = pa.p_partkey)
JOIN (lineitem b JOIN part pb ON b.l_partkey = pb.p_partkey) ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber
JOIN orders ON o_orderkey = a.l_orderkey""")
def q_join_renamed(spark, sf_dir):
    """A tree of joins over tables whose columns clash (each line of an order
    with the next one and both their parts), renamed by one pass."""
    lines, parts, orders = t(spark, sf_dir, "lineitem", "part", "orders")
    lines, parts = lines.select("l_orderkey", "l_linenumber", "l_partkey"), parts.select("p_partkey", "p_brand")
    side = {k: Join(Table(k, lines), Table(f"p{k}", parts), [((k, "l_partkey"), (f"p{k}", "p_partkey"))]) for k in "ab"}
    pairs = Join(side["a"], side["b"], [(("a", "l_orderkey"), ("b", "l_orderkey"))],
                 where=lambda at: at("a", "l_linenumber") + 1 == at("b", "l_linenumber"))
    tree = Join(pairs, Table("o", orders.select("o_orderkey", "o_orderpriority")), [(("a", "l_orderkey"), ("o", "o_orderkey"))])
    return join_tree(tree).select("a_l_orderkey", "a_l_linenumber", "pa_p_brand", "b_l_linenumber", "pb_p_brand", "o_orderpriority")


@register("join_nested_names", """SELECT sn.n_name AS supp_nation, cn.n_name AS cust_nation,
       CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))) AS DECIMAL(38,4)) AS DOUBLE) AS revenue,
       count(*) AS lines
FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey
GROUP BY sn.n_name, cn.n_name""")
def q_join_nested_names(spark, sf_dir):
    return R.join_nested_names(*t(spark, sf_dir, "lineitem", "orders", "customer", "supplier", "nation"))


@register("expr_null_handling", """WITH per_cust AS (
  SELECT c_custkey, c_mktsegment, count(o_orderkey) AS c_count
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment)
SELECT c_custkey, nullif(c_count, 0) AS orders_or_null,
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'OTHER') AS segment FROM per_cust""")
def q_expr_null_handling(spark, sf_dir):
    return R.null_handling(*t(spark, sf_dir, "customer", "orders"))


@register("expr_conditions", """SELECT p_partkey, p_name LIKE '%red%' AS is_red, p_size IN (1, 5, 10) AS small_size,
       (p_retailprice > 1000 AND NOT p_brand = 'Brand#1') AS pricey, p_type IS NULL AS no_type,
       CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 30 THEN 'M' ELSE 'L' END AS size_band
FROM part WHERE p_size BETWEEN 1 AND 40 OR p_name LIKE 'blue%'""")
def q_expr_conditions(spark, sf_dir):
    return R.conditions(*t(spark, sf_dir, "part"))


@register("expr_dates", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y,
       CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d,
       CAST(CAST(o_orderdate AS DATE) + 30 AS TIMESTAMP) AS due FROM orders""")
def q_expr_dates(spark, sf_dir):
    return R.dates(*t(spark, sf_dir, "orders"))


@register("expr_math", """SELECT l_orderkey, l_linenumber, abs(l_discount - 0.05) AS disc_gap,
       CAST(ceil(l_extendedprice) AS BIGINT) AS price_ceil, CAST(floor(l_extendedprice) AS BIGINT) AS price_floor,
       round(l_extendedprice) AS price_round, sqrt(l_quantity) AS qty_sqrt FROM lineitem""")
def q_expr_math(spark, sf_dir):
    return R.math(*t(spark, sf_dir, "lineitem"))


@register("expr_strings", """SELECT c_custkey, lower(c_name) AS lower_name, upper(c_mktsegment) AS upper_segment,
       CAST(length(c_name) AS INTEGER) AS name_len, substring(c_name, 10, 9) AS name_digits,
       c_name || '-' || c_mktsegment AS label, trim('  ' || c_mktsegment || '  ') AS trimmed FROM customer""")
def q_expr_strings(spark, sf_dir):
    return R.strings(*t(spark, sf_dir, "customer"))


# --------------------------------------------------------------- streaming --

@register("stream_text_source", f"""WITH {O.LINES_CTE}
SELECT value FROM raw""")
def q_stream_text_source(spark, sf_dir):
    """Raw lines through ``readStream.text`` into a parquet sink."""
    pin_utc(spark)
    return stream_text(spark, table(spark, sf_dir, "events"))


@register("stream_flagged_windows", O.flagged_sql())
def q_stream_flagged_windows(spark, sf_dir):
    """Q1 streaming: 5-day rounds, update mode, last value per key, then F1.
    Same rows as ``flagged_windows``."""
    pin_utc(spark)
    out = stream_flagged_windows(spark, table(spark, sf_dir, "events"), DAILY, Thresholds())
    return flatten_window(out, ntz=True)


@register("stream_antijoin_bots", f"""WITH {O.EVENTS_CTE}, {BOTS_SQL}
SELECT date_trunc('second', unixTime) AS unixTime, categoryId, ipAddress, eventType FROM ev
WHERE NOT EXISTS (SELECT 1 FROM bots WHERE bots.ipAddress = ev.ipAddress)""")
def q_stream_antijoin_bots(spark, sf_dir):
    """J1 on a stream: parsed lines minus the bot table (stream-static anti join)."""
    pin_utc(spark)
    out = stream_antijoin(spark, table(spark, sf_dir, "events"), bots(spark, sf_dir))
    return ntz(out, "unixTime")


@register("stream_block_list", O.block_list_rounds_sql(5))
def q_stream_block_list(spark, sf_dir):
    """Q2 flagship as a stream: the self-feeding block list over 5-day rounds.

    Each round reads what the earlier rounds wrote. The oracle gets the same
    table in one pass: an address counts all its events until it is listed,
    so its listing round follows from cumulative per-round window counts.
    """
    pin_utc(spark)
    out = stream_block_list(spark, table(spark, sf_dir, "events"), DAILY, Thresholds())
    return ntz(out, "end", "created_at")


@register("stream_block_list_expiry", O.block_list_expiry_sql(5, 240))
def q_stream_block_list_expiry(spark, sf_dir):
    """Q2 + K4 as a stream: entries expire after 10 days, an expired address
    counts and may be listed again. The rows alive after the last round."""
    pin_utc(spark)
    events = table(spark, sf_dir, "events")
    bots = stream_block_list_expiry(spark, events, DAILY, ttl_hours=240)
    starts = round_starts(events, 5)
    last = starts[-1] + timedelta(days=5) if starts else None
    return ntz(bots.read(last, 240), "end", "created_at")


@register("stream_late_rows", O.late_rows_sql(5))
def q_stream_late_rows(spark, sf_dir):
    """A tenth of the events come one round late and a few two. Per window
    and address what the aggregate kept and what came after the window closed;
    together they are all events of the window."""
    pin_utc(spark)
    job = stream_late_rows(spark, table(spark, sf_dir, "events"), DAILY, F.expr(O.ARRIVAL_DELAY))
    kept = flatten_window(job.kept(), ntz=True).select("window_start", "window_end", "ipAddress", F.col("amount").alias("kept"))
    late = flatten_window(job.late(), ntz=True).groupBy("window_start", "window_end", "ipAddress").agg(F.count("*").alias("late"))
    both = kept.join(late, ["window_start", "window_end", "ipAddress"], "full")
    zero = F.lit(0).cast("bigint")
    return both.select("window_start", "window_end", "ipAddress", F.coalesce("kept", zero).alias("kept"), F.coalesce("late", zero).alias("late"))


@register("stream_closed_windows", O.closed_windows_sql("window_start, window_end, ipAddress, amount, rate, categories"))
def q_stream_closed_windows(spark, sf_dir):
    """W5 in append mode: each window once, when it closes; open ones are left out."""
    pin_utc(spark)
    return flatten_window(stream_closed_windows(spark, table(spark, sf_dir, "events"), DAILY), ntz=True)


@register("stream_distinct_categories", O.closed_windows_sql("window_start, window_end, ipAddress, categories"))
def q_stream_distinct_categories(spark, sf_dir):
    """W3/A4 with bounded state: deduplication, then a count, in append mode."""
    pin_utc(spark)
    return flatten_window(stream_closed_windows(spark, table(spark, sf_dir, "events"), DAILY, run_distinct_categories), ntz=True)


@register("stream_corrupt_records", ORACLE["corrupt_records"])
def q_stream_corrupt_records(spark, sf_dir):
    """P16/K6 on a stream: the dead letters that the windows' own query leaves."""
    pin_utc(spark)
    return stream_tee(spark, table(spark, sf_dir, "events"), DAILY).dead_letters().select("value")


@register("stream_row_writer", f"""WITH {O.SECONDS_CTE}, ev AS (SELECT unixTime, ipAddress, categoryId, eventType FROM raw_ev),
{O.windows_cte('ev')}
SELECT window_start, window_end, ipAddress, count(unixTime) AS amount FROM win GROUP BY window_start, window_end, ipAddress""")
def q_stream_row_writer(spark, sf_dir):
    """Window updates through a per-row writer, staged per partition and epoch."""
    pin_utc(spark)
    return ntz(stream_rows(spark, table(spark, sf_dir, "events"), DAILY), "window_start", "window_end")


@register("stream_kafka_parse", ORACLE["parse_events_long"])
def q_stream_kafka_parse(spark, sf_dir):
    """Q4/S2 on a stream: a third of the records is sent twice; each is parsed once."""
    pin_utc(spark)
    return stream_kafka_parse(spark, table(spark, sf_dir, "events"), F.col("event_id") % 3 == 0)


@register("stream_running", f"""WITH {O.SECONDS_CTE}, ev AS (SELECT unixTime, categoryId, ipAddress, eventType FROM raw_ev),
{O.windows_cte('ev')}
{O.FEATURES_SELECT}""")
def q_stream_running(spark, sf_dir):
    """Window updates of a query on a processing-time trigger, fed while it runs."""
    pin_utc(spark)
    return flatten_window(stream_running(spark, table(spark, sf_dir, "events"), DAILY), ntz=True)


@register("stream_state_lookup", O.state_lookup_sql(24))
def q_stream_state_lookup(spark, sf_dir):
    """F2/Q3 against keyed state: addresses listed at the event that crosses a
    threshold, silent for 24 h from then, and listed again if they cross anew."""
    pin_utc(spark)
    return ntz(stream_state_lookup(spark, table(spark, sf_dir, "events"), DAILY, ttl_hours=24), "end", "listed_at")


FLAGSHIP = "flagged_after_lookup"


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
