"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.common import settle

MAX_ROUNDS = 60


def _rank(node: str) -> Column:
    """A random but fixed order of nodes; it keeps chains of ascending ids from shrinking one by one."""
    return F.struct(F.xxhash64(F.col(node)).alias("h"), F.col(node).alias("id"))


def components(edges: DataFrame, a: str = "a", b: str = "b", smallest: bool = True) -> DataFrame:
    """(node, component) for every node with a link to another one.

    ``component`` is the smallest node of the component, or with ``smallest`` off any fixed
    member of it, which saves a pass.

    Each round points every node at the first of its closed neighbourhood (in a
    random order) and replaces the ends of all edges by what they point at, until
    no edge is left; the rounds' pointers are then followed one after another. A node
    with a third of all edges is pre-aggregated in the min and split by
    skew-join handling in the joins. Loops and repeated edges are allowed; nulls
    are ignored.
    """
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b")
    e = settle(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    pointers: list[DataFrame] = []
    while not e.isEmpty():
        if len(pointers) == MAX_ROUNDS:
            raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(_rank("b")).alias("m"))
        up = settle(first.select(F.col("a").alias("n"), F.least(F.col("m"), _rank("a"))["id"].alias("p")))
        e = e.join(up.toDF("a", "pa"), "a").join(up.toDF("b", "pb"), "b").filter("pa <> pb")
        e = settle(e.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        pointers.append(up)
    if not pointers:
        return e.toDF("node", "component")
    label = pointers[0].toDF("node", "root")
    for up in pointers[1:]:
        label = label.join(up.toDF("root", "p"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))
    if not smallest:
        return label.toDF("node", "component")
    label = settle(label) if len(pointers) > 1 else label
    least = settle(label.groupBy("root").agg(F.min("node").alias("component")))
    return label.join(least, "root").select("node", "component")
