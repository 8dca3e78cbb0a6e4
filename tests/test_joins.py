"""Range joins by bins, and join trees with clashing names."""

import random
from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from botsieve.operators.jointree import Join, Table, join_tree, new_names
from botsieve.operators.ranges import range_join

DAY = datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else DAY + timedelta(seconds=seconds)


def sides(spark, seed, n=300):
    """Points and intervals: seconds to years long, empty, reversed, open at one end, null."""
    rng = random.Random(seed)
    when = lambda: rng.choice([None, rng.randrange(-4000, 90_000), rng.randrange(0, 3000)])
    points = [(i, rng.choice(["a", "b", None]), when()) for i in range(n)]
    intervals = []
    for i in range(60):
        start = when()
        length = rng.choice([0, 1, 60, 299, 300, 301, 7200, 80_000, 10 ** 7, 3 * 10 ** 8, -50])
        intervals.append((i, rng.choice(["a", "b", None]), start, None if start is None or i % 17 == 0 else start + length))
    p = spark.createDataFrame([(i, k, at(s)) for i, k, s in points], "p int, pk string, t timestamp").repartition(3)
    q = spark.createDataFrame([(i, k, at(s), at(e)) for i, k, s, e in intervals], "q int, qk string, s timestamp, e timestamp")
    want = sorted((x[0], y[0]) for x in points for y in intervals
                  if None not in (x[1], x[2], y[2], y[3]) and x[1] == y[1] and y[2] <= x[2] < y[3])
    return p, q, points, want


@pytest.mark.parametrize("seed, width, most", [(1, 300, 10 ** 6), (2, 60, 0), (3, 7, 10 ** 6), (4, 86_400, 0)])
def test_range_join_against_brute_force(spark, seed, width, most):
    p, q, points, want = sides(spark, seed)
    on = dict(keys=[("pk", "qk")], time="t", start="s", end="e", width_seconds=width, max_rows=most)
    inner = range_join(p, q, **on)
    assert inner.columns == [*p.columns, *q.columns]
    assert sorted((r.p, r.q) for r in inner.collect()) == want and len(want) > 100
    met = {x for x, _ in want}
    assert sorted(r.p for r in range_join(p, q, how="left_semi", **on).collect()) == sorted(met)
    assert sorted(r.p for r in range_join(p, q, how="left_anti", **on).collect()) == sorted({x[0] for x in points} - met)


def test_range_join_edges(spark):
    p, q, points, _ = sides(spark, 5)
    none = q.limit(0)
    on = dict(keys=[("pk", "qk")], time="t", start="s", end="e")
    assert range_join(p, none, **on).count() == 0 and range_join(p, none, how="left_anti", **on).count() == len(points)
    assert range_join(p.limit(0), q, **on).count() == 0 and range_join(p, none, how="left_semi", **on).count() == 0
    for bad in (dict(on, keys=[]), dict(on, how="left")):
        with pytest.raises(ValueError):
            range_join(p, q, **bad)
    with pytest.raises(ValueError, match="both sides"):
        range_join(p, q.withColumnRenamed("q", "p"), **on)
    # an inner join only: repeated points and intervals come back each
    assert range_join(p.unionAll(p), q.unionAll(q), **on).count() == 4 * range_join(p, q, **on).count()


def test_range_join_plan_and_long_intervals(spark):
    """No nested loop or cross product; an interval of ten years is listed a few times only."""
    p, q, _, _ = sides(spark, 6)
    for most in (0, 10 ** 6):
        plan = range_join(p, q, [("pk", "qk")], "t", "s", "e", max_rows=most)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and ("SortMergeJoin" in plan or "BroadcastHashJoin" in plan)
    one = spark.createDataFrame([("a", DAY, DAY + timedelta(days=3650))], "qk string, s timestamp, e timestamp")
    hot = spark.range(200_000).select(F.lit("a").alias("pk"), (F.lit(DAY).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 60)).alias("t"))
    found = range_join(hot, one, [("pk", "qk")], "t", "s", "e", max_rows=0)
    assert found.count() == 200_000
    # the hot key's points lie in many (key, bin) groups, in each of which there are few
    fine = one.withColumn("e", F.col("s") + F.make_dt_interval(secs=F.lit(60.0)))
    spread = range_join(hot, fine, [("pk", "qk")], "t", "s", "e", width_seconds=300, max_rows=0)
    assert spread.count() == 1


def random_tree(rng, frames, aliases, depth):
    if depth == 0 or rng.random() < 0.25:
        alias = f"t{len(aliases)}"
        aliases.append(alias)
        return Table(alias, frames[rng.randrange(len(frames))][1]), [alias]
    left, ours = random_tree(rng, frames, aliases, depth - 1)
    right, theirs = random_tree(rng, frames, aliases, depth - 1)
    how = rng.choice(["inner", "left", "right", "full", "left_semi", "left_anti", "inner"])
    return Join(left, right, [((rng.choice(ours), "k"), (rng.choice(theirs), "k"))], how), ours + theirs * (how not in ("left_semi", "left_anti"))


def as_sql(node, number):
    if isinstance(node, Table):
        return f"{number[id(node.df)]} {node.alias}", [(node.alias, c) for c in node.df.columns]
    (left, ours), (right, theirs) = as_sql(node.left, number), as_sql(node.right, number)
    a, b = node.on[0]
    equal = f"{a[0]}.{a[1]} = {b[0]}.{b[1]}"
    if node.how in ("left_semi", "left_anti"):
        return f"({left} {node.how[5:].upper()} JOIN ({right}) ON {equal})", ours
    return f"({left} {node.how.upper()} JOIN {right} ON {equal})", ours + theirs


@pytest.mark.parametrize("seed", range(6))
def test_join_trees_against_sql(spark, seed):
    """Random trees over three tables whose columns clash: rows, names and their order."""
    rng = random.Random(seed)
    con, frames = duckdb.connect(), []
    for n, columns in enumerate((["k", "v"], ["v", "k", "w"], ["k", "w", f"only{0}"])):
        rows = [tuple(rng.choice([0, 1, 2, 3]) for _ in columns) for _ in range(rng.randrange(2, 6))]
        pdf = pd.DataFrame(rows, columns=columns)
        con.register(f"tab{n}", pdf)
        frames.append((f"tab{n}", spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns))))
    number = {id(df): name for name, df in frames}
    for _ in range(4):
        aliases = []
        tree, _ = random_tree(rng, frames, aliases, 3)
        names = new_names(tree)
        if isinstance(tree, Join) and any(h in str(tree) for h in ("left_semi", "left_anti")) and rng.random() < 0.3:
            continue
        sql, columns = as_sql(tree, number)
        got = join_tree(tree)
        assert got.columns == [names[c] for c in columns] and len(set(got.columns)) == len(columns)
        want = con.execute(f"SELECT {', '.join(f'{a}.{c}' for a, c in columns)} FROM {sql}").fetchall()
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_names_and_errors(spark):
    one = spark.createDataFrame([(1, 2, 3)], "k int, a_k int, x int")
    two = spark.createDataFrame([(1, 2)], "K int, y int")
    tree = Join(Table("a", one), Table("b", two), [(("b", "K"), ("a", "k"))])
    assert join_tree(tree).columns == ["a_k_", "a_k", "x", "b_K", "y"]     # a_k was taken; names are compared without case
    with pytest.raises(ValueError, match="aliases"):
        join_tree(Join(Table("a", one), Table("a", two), [(("a", "k"), ("a", "K"))]))
    with pytest.raises(ValueError, match="equality"):
        join_tree(Join(Table("a", one), Table("b", two), []))
    with pytest.raises(ValueError, match="does not join"):
        join_tree(Join(Table("a", one), Table("b", two), [(("a", "k"), ("a", "x"))]))
    with pytest.raises(ValueError, match="join type"):
        join_tree(Join(Table("a", one), Table("b", two), [(("a", "k"), ("b", "K"))], "cross"))
    free = Join(Table("a", one), Table("b", two), [(("a", "k"), ("b", "K"))], "left", where=lambda at: at("a", "x") < at("b", "y"))
    assert [tuple(r) for r in join_tree(free).collect()] == [(1, 2, 3, None, None)]
