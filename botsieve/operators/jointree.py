"""Joins of joins over tables whose column names clash.

A tree of joins is written down with aliases; ``join_tree`` gives each column
that occurs in more than one table a name of its own, once, on the tables
themselves, and then joins. Conditions name columns as (alias, column), so
nothing in them depends on the new names. The output keeps the order of the
tables in the tree and of the columns in each table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Named = tuple[str, str]     # (alias, column)


@dataclass
class Table:
    """A table under an alias (the same table may be in a tree twice)."""

    alias: str
    df: DataFrame


@dataclass
class Join:
    """``on``: pairs of columns, one of either side, that must be equal; at least
    one. ``where``: a further condition, given a function from (alias, column)
    to a column. Of a semi or anti join only the left side's columns remain."""

    left: Table | Join
    right: Table | Join
    on: list[tuple[Named, Named]]
    how: str = "inner"
    where: Callable[[Callable[[str, str], Column]], Column] | None = None


HOW = ("inner", "left", "right", "full", "left_semi", "left_anti")


def tables(tree: Table | Join) -> Iterator[Table]:
    if isinstance(tree, Table):
        yield tree
    else:
        yield from tables(tree.left)
        yield from tables(tree.right)


def new_names(tree: Table | Join) -> dict[Named, str]:
    """(alias, column) -> name in the output. A name that only one table has
    stays; one that clashes becomes ``alias_column``, with underscores added
    until it is free. Names differ as Spark compares them, without case."""
    leaves = list(tables(tree))
    aliases = Counter(leaf.alias for leaf in leaves)
    if max(aliases.values()) > 1:
        raise ValueError(f"aliases used twice: {sorted(a for a, n in aliases.items() if n > 1)}")
    uses = Counter(c.lower() for leaf in leaves for c in leaf.df.columns)
    taken = {c for c, n in uses.items() if n == 1}
    out = {}
    for leaf in leaves:
        for c in leaf.df.columns:
            name = c
            if uses[c.lower()] > 1:
                name = f"{leaf.alias}_{c}"
                while name.lower() in taken or name.lower() in uses:
                    name += "_"
                taken.add(name.lower())
            out[leaf.alias, c] = name
    return out


def join_tree(tree: Table | Join) -> DataFrame:
    """The tree joined as written, each table projected once."""
    names = new_names(tree)

    def at(alias: str, column: str) -> Column:
        if (alias, column) not in names:
            raise ValueError(f"no column {column!r} in {alias!r}")
        return F.col(f"`{names[alias, column]}`")

    def build(node: Table | Join) -> tuple[DataFrame, set[str]]:
        if isinstance(node, Table):
            return node.df.select(*[F.col(f"`{c}`").alias(names[node.alias, c]) for c in node.df.columns]), {node.alias}
        if node.how not in HOW:
            raise ValueError(f"join type {node.how!r}")
        (left, ours), (right, theirs) = build(node.left), build(node.right)
        if not node.on:
            raise ValueError("a join without an equality would pair all rows")
        condition = None
        for a, b in node.on:
            if not (a[0] in ours and b[0] in theirs):
                a, b = b, a
            if not (a[0] in ours and b[0] in theirs):
                raise ValueError(f"{a} = {b} does not join the two sides")
            equal = at(*a) == at(*b)
            condition = equal if condition is None else condition & equal
        if node.where is not None:
            condition = condition & node.where(at)
        kept = ours if node.how in ("left_semi", "left_anti") else ours | theirs
        return left.join(right, condition, node.how), kept

    return build(tree)[0]
