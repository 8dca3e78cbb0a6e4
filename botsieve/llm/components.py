"""Connected components of a distributed edge list (large-star, small-star)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b). Each node's smallest neighbour is found
    by a pre-aggregated group-by and joined back, so a node with very many
    neighbours is never gathered in one place: the join's rows can be split."""
    if large:  # every node, all neighbours; larger ones move to the smallest
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:      # every node, its smaller neighbours
        sides = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    moved = sides.join(least, "u")
    if large:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = moved.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def are_stars(edges: DataFrame) -> bool:
    """Whether no node has two centres, or is a centre and a leaf at once."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("centre"), F.lit(0).alias("leaf")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("centre"), F.lit(1).alias("leaf")))
    ends = ends.groupBy("node").agg(F.max("centre").alias("centre"), F.sum("leaf").alias("leaves"))
    return ends.filter(F.col("centre") + F.col("leaves") > 1).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, of one integer
    type): root is the smallest node reachable. Roots are listed too. Each
    round is written to the shared folder; rounds grow with the logarithm of
    the longest chain and end when every component is a star around its
    smallest node. Self-loops and repeated edges do no harm."""
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")
    state = written(pairs.distinct(), "edges")
    while not are_stars(state):
        state = written(star(star(state, True), False), "edges")
    return state.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
