"""Relational queries on ordinary tables.

The detector's original hands these operators to its table store through a
Catalyst rule; on Spark they are plain DataFrame plans and Catalyst/AQE pick
the physical strategy. Choices made for scale:

* Money is summed as DECIMAL: exact, and independent of summation order;
  the exact sum is handed out as the nearest double.
* Aggregate before joining where the join only needs the aggregate (orders
  per customer, quantity per part): the partial aggregate shrinks the
  shuffle to one row per key and task.
* Only ``nation``/``region`` (fixed 25/5 rows) get a broadcast hint; the
  other dimensions grow with the data and are left to AQE, which converts a
  join to broadcast at run time when the measured side is small, and splits
  skewed partitions of sort-merge joins.
* Sort keys end with a unique column, so range partitioning can split a hot
  value and the order is total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Inputs narrow enough that a price x (1 - discount) product has precision
# <= 18 and stays in Spark's long-backed decimal (no BigDecimal per row).
MONEY = "decimal(12,2)"
FRACTION = "decimal(3,2)"


def money(col: str):
    return F.col(col).cast(MONEY)


def dsum(expr, scale: int = 2):
    """Exact decimal sum, handed out as a double.

    The sum itself is exact and order independent; the result is the double
    nearest to it, the type every reader (pandas, Arrow, JSON) takes as is.
    """
    return F.sum(expr).cast(f"decimal(38,{scale})").cast("double")


def disc_price():
    """extendedprice * (1 - discount), exact in decimals."""
    return money("l_extendedprice") * (F.lit(1).cast(FRACTION) - F.col("l_discount").cast(FRACTION))


# ----------------------------------------------------------- projections --

def project(lineitem: DataFrame) -> DataFrame:
    """Columns, a computed column, a literal, aliases."""
    return lineitem.select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("qty"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("revenue"),
        F.lit("USD").alias("currency"))


def filter_rows(lineitem: DataFrame) -> DataFrame:
    """R2: a conjunction of predicates; all of them reach the parquet scan."""
    return (lineitem
            .where((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                   & F.col("l_discount").between(0.05, 0.07)
                   & (F.col("l_quantity") < 24))
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate"))


def sort_all(orders: DataFrame) -> DataFrame:
    """A global order (range partitioned), ties broken by the unique key."""
    return (orders.select("o_orderkey", "o_totalprice", "o_orderdate")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")))


def top_k(orders: DataFrame, k: int = 10) -> DataFrame:
    """Order + limit; planned as a per-partition top-k and one merge."""
    return sort_all(orders).limit(k)


def union_all(customer: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """N children with one output schema."""
    return (customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
                            F.col("c_acctbal").alias("acctbal"), F.lit("customer").alias("kind"))
            .unionByName(supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
                                         F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("kind")))
            .unionByName(nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("nationkey"),
                                       F.lit(None).cast("double").alias("acctbal"), F.lit("nation").alias("kind"))))


def distinct_rows(orders: DataFrame) -> DataFrame:
    """Distinct combinations (a partial aggregate before the shuffle)."""
    return orders.select("o_orderstatus", "o_orderpriority").distinct()


# ----------------------------------------------------------- aggregation --

def group_agg(lineitem: DataFrame) -> DataFrame:
    """Pricing summary per return flag and line status."""
    n = F.count(F.lit(1))
    return (lineitem.groupBy("l_returnflag", "l_linestatus")
            .agg(F.sum("l_quantity").alias("sum_qty"),
                 dsum(money("l_extendedprice")).alias("sum_base_price"),
                 dsum(disc_price(), 4).alias("sum_disc_price"),
                 F.avg("l_quantity").alias("avg_qty"),
                 (dsum(money("l_extendedprice")) / n).alias("avg_price"),
                 F.min("l_discount").alias("min_disc"),
                 F.max("l_discount").alias("max_disc"),
                 F.min("l_shipdate").alias("first_ship"),
                 F.max("l_shipdate").alias("last_ship"),
                 n.alias("count_order")))


def orders_per_customer(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Order count per customer, 0 for none: aggregate orders first, then a
    left join to the (unique-keyed) customers."""
    per_cust = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return (customer.join(per_cust, customer["c_custkey"] == per_cust["o_custkey"], "left")
            .select("c_custkey", "c_mktsegment", F.coalesce("n_orders", F.lit(0)).alias("c_count")))


def nested_agg(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """An aggregate over an aggregate (customers per order count)."""
    return (orders_per_customer(customer, orders)
            .groupBy("c_count").agg(F.count(F.lit(1)).alias("custdist")))


def having(lineitem: DataFrame, min_qty: float = 150.0) -> DataFrame:
    """A filter above a group by."""
    return (lineitem.groupBy("l_orderkey")
            .agg(F.sum("l_quantity").alias("total_qty"), F.count(F.lit(1)).alias("lines"))
            .where(F.col("total_qty") > min_qty))


def count_distinct(lineitem: DataFrame) -> DataFrame:
    """COUNT and COUNT(DISTINCT ..) per group, BIGINT results."""
    return (lineitem.groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.count_distinct("l_orderkey").alias("n_orders"),
                 F.count_distinct("l_partkey").alias("n_parts")))


# ----------------------------------------------------------------- joins --

def join_inner(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """J3 inner: each order with its customer."""
    return (orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner")
            .select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment"))


def join_left(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """J3 left outer: every customer, its orders or nulls."""
    return (customer.join(orders, customer["c_custkey"] == orders["o_custkey"], "left")
            .select("c_custkey", "c_name", "o_orderkey", "o_orderstatus"))


def join_right(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """J3 right outer: the preserved side on the right."""
    return (orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "right")
            .select("c_custkey", "o_orderkey", "o_orderstatus"))


def join_full(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """J3 full outer: parts and per-part shipped quantity, both sides kept.

    The lineitem side is aggregated to one row per part first.
    """
    qty = lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("shipped_qty"))
    return (part.join(qty, part["p_partkey"] == qty["l_partkey"], "full")
            .select("p_partkey", "l_partkey", "p_name", "shipped_qty"))


def join_semi(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """J3 left semi (EXISTS)."""
    return (customer.join(orders, customer["c_custkey"] == orders["o_custkey"], "left_semi")
            .select("c_custkey", "c_name"))


def join_anti(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """J3 left anti (NOT EXISTS)."""
    return (customer.join(orders, customer["c_custkey"] == orders["o_custkey"], "left_anti")
            .select("c_custkey", "c_name"))


def join_self(orders: DataFrame) -> DataFrame:
    """J4 self join through aliases: each order next to the following key.

    The join key is unique on both sides, so a row has at most one partner;
    both sides scan the same table and Spark reuses one exchange for both.
    """
    a, b = orders.alias("a"), orders.alias("b")
    return (a.join(b, F.col("b.o_orderkey") == F.col("a.o_orderkey") + 1, "inner")
            .select(F.col("a.o_orderkey").alias("o_orderkey"),
                    F.col("b.o_orderkey").alias("next_orderkey"),
                    (F.col("b.o_totalprice") - F.col("a.o_totalprice")).alias("price_change")))


def join_derived(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """J4 join of derived tables: per-order revenue with the orders of one year."""
    revenue = lineitem.groupBy("l_orderkey").agg(dsum(disc_price(), 4).alias("revenue"))
    recent = (orders.where((F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                           & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
              .select("o_orderkey", "o_orderdate", "o_orderpriority"))
    return (recent.join(revenue, recent["o_orderkey"] == revenue["l_orderkey"], "inner")
            .select("o_orderkey", "o_orderdate", "o_orderpriority", "revenue"))


def join_nested_names(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                      supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Nested joins that meet ``nation`` twice; the clashing columns get
    their own aliases (supplier nation vs customer nation).

    The facts are joined and aggregated on the integer nation keys; the names
    are attached to the aggregate (at most 25 x 25 rows) at the end. Strings
    stay out of the shuffles, and a dimension joined to ``nation`` early would
    look (to the size estimate, which multiplies join sides) larger than the
    fact table it should be joined to.
    """
    lines = lineitem.select("l_orderkey", "l_suppkey", disc_price().alias("volume"))
    supp = supplier.select("s_suppkey", "s_nationkey")
    ords = (orders.select("o_orderkey", "o_custkey")
            .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")))
    per_pair = (lines.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
                .join(ords, F.col("l_orderkey") == F.col("o_orderkey"))
                .groupBy("s_nationkey", "c_nationkey")
                .agg(dsum(F.col("volume"), 4).alias("revenue"), F.count(F.lit(1)).alias("lines")))
    sn = F.broadcast(nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("supp_nation")))
    cn = F.broadcast(nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cust_nation")))
    return (per_pair.join(sn, F.col("s_nationkey") == F.col("sn_key"))
            .join(cn, F.col("c_nationkey") == F.col("cn_key"))
            .select("supp_nation", "cust_nation", "revenue", "lines"))


# ----------------------------------------------------- scalar families --

def null_handling(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """``coalesce`` and ``nullif``."""
    return (orders_per_customer(customer, orders)
            .select("c_custkey",
                    F.nullif(F.col("c_count"), F.lit(0)).alias("orders_or_null"),
                    F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
                               F.lit("OTHER")).alias("segment")))


def conditions(part: DataFrame) -> DataFrame:
    """Comparison, AND/OR/NOT, IN, IS NULL, LIKE, CASE."""
    return (part
            .where(F.col("p_size").between(1, 40) | F.col("p_name").like("blue%"))
            .select("p_partkey",
                    F.col("p_name").like("%red%").alias("is_red"),
                    F.col("p_size").isin(1, 5, 10).alias("small_size"),
                    ((F.col("p_retailprice") > 1000) & ~(F.col("p_brand") == "Brand#1")).alias("pricey"),
                    F.col("p_type").isNull().alias("no_type"),
                    F.when(F.col("p_size") < 10, "S").when(F.col("p_size") < 30, "M")
                    .otherwise("L").alias("size_band")))


def dates(orders: DataFrame) -> DataFrame:
    """E5: year, month, day of month, date arithmetic."""
    d = F.col("o_orderdate").cast("date")
    return orders.select("o_orderkey",
                         F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("d"),
                         # a DATE, handed out as its midnight (TIMESTAMP_NTZ)
                         F.date_add(d, 30).cast("timestamp_ntz").alias("due"))


def math(lineitem: DataFrame) -> DataFrame:
    """Abs, ceil, floor, round, sqrt."""
    return lineitem.select("l_orderkey", "l_linenumber",
                           F.abs(F.col("l_discount") - F.lit(0.05)).alias("disc_gap"),
                           F.ceil("l_extendedprice").alias("price_ceil"),
                           F.floor("l_extendedprice").alias("price_floor"),
                           F.round("l_extendedprice").alias("price_round"),
                           F.sqrt("l_quantity").alias("qty_sqrt"))


def strings(customer: DataFrame) -> DataFrame:
    """Lower, upper, length, substring, concat, trim."""
    return customer.select("c_custkey",
                           F.lower("c_name").alias("lower_name"),
                           F.upper("c_mktsegment").alias("upper_segment"),
                           F.length("c_name").alias("name_len"),
                           F.substring("c_name", 10, 9).alias("name_digits"),
                           F.concat(F.col("c_name"), F.lit("-"), F.col("c_mktsegment")).alias("label"),
                           F.trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("  "))).alias("trimmed"))
