"""Chains and cycles in graphs where every node has at most one successor.

All loops are pointer doubling: after r rounds each node knows its 2^r-th successor, so a chain of n
nodes takes log2(n) joins. Every round is cut with a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwright.session import durable


def edges_of(df: DataFrame, node: str, successor: str) -> DataFrame:
    """``(node, next)`` for rows where both ends are given and not empty."""
    given = F.col("node").isNotNull() & F.col("next").isNotNull()
    present = (F.col("node").cast("string") != "") & (F.col("next").cast("string") != "")
    return df.select(F.col(node).alias("node"), F.col(successor).alias("next")).where(given & present)


def resolve_parent(df: DataFrame, key: str, parent: str, id_: str, name: str) -> DataFrame:
    """Self join: the parent's id for its key. An unknown parent stays NULL."""
    owners = df.select(F.col(key).alias("_owner"), F.col(id_).alias(name))
    return df.join(owners, F.col(parent) == F.col("_owner"), "left").drop("_owner")


def follow(edges: DataFrame) -> DataFrame:
    """``(node, last, depth, loops)`` for every node with a successor.

    ``last`` is the final node of the chain and ``depth`` the number of steps to it. A node that
    leads into a cycle has ``loops`` set, and then ``last`` is some node *on* that cycle; over all
    looping nodes these are exactly the nodes on cycles.

    Open walks stand on a set of nodes that can only shrink from round to round. Once it is empty all
    chains have ended; once it keeps its size, doubling maps it onto itself, so what is left of it
    lies on cycles. Either way the number of rounds is the logarithm of the longest tail.
    """
    # an edge to a node without a successor ends there: it is finished from the start
    starts = edges.select(F.col("node").alias("_start"))
    walk = edges.join(starts, F.col("next") == F.col("_start"), "left").select(
        "node",
        F.col("next").alias("last"),
        F.lit(1).cast("bigint").alias("depth"),
        F.col("_start").isNotNull().alias("loops"),
    )
    standing = -1
    while True:
        walk = durable(walk)
        before, standing = standing, walk.where("loops").agg(F.count_distinct("last")).first()[0]
        if standing in (0, before):
            return walk.withColumn("depth", F.when(~F.col("loops"), F.col("depth")))
        ahead = walk.select(
            F.col("node").alias("_node"),
            F.col("last").alias("_last"),
            F.col("depth").alias("_depth"),
            F.col("loops").alias("_loops"),
        )
        # only open walks are joined; the right side has one row per node, so a popular node makes
        # the left side uneven at most, which adaptive execution splits
        moved = (
            walk.where("loops")
            .join(ahead, F.col("last") == F.col("_node"))
            .select(
                "node",
                F.col("_last").alias("last"),
                (F.col("depth") + F.col("_depth")).alias("depth"),
                F.col("_loops").alias("loops"),
            )
        )
        walk = walk.where(~F.col("loops")).unionByName(moved)


def cycles(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(starts, members)`` of all cycles.

    ``starts``: every node that leads into a cycle as ``(node, entry, steps, cycle, length)``, where
    ``entry`` is the first cycle node met. ``members``: ``(cycle, position, node, length)``, counted
    from the smallest node of the cycle, which also names it. The closed path reported for a start
    is its cycle read from ``entry`` round to ``entry`` again; kept as rows, its size stays linear.
    """
    looping = follow(edges).where("loops")
    on_cycle = _on_cycle(looping)
    members = durable(_places(edges.join(on_cycle, "node", "left_semi")))
    # cut the cycles open: now every tail is a chain that ends on its entry node
    tails = edges.join(looping.select("node"), "node", "left_semi").join(on_cycle, "node", "left_anti")
    entered = follow(tails).select("node", F.col("last").alias("entry"), F.col("depth").alias("steps"))
    at_once = on_cycle.select(
        "node", F.col("node").alias("entry"), F.lit(0).cast("bigint").alias("steps")
    )
    names = members.select(F.col("node").alias("entry"), "cycle", "length")
    return at_once.unionByName(entered).join(names, "entry"), members


def _on_cycle(looping: DataFrame) -> DataFrame:
    return durable(looping.select(F.col("last").alias("node")).distinct())


def cycle_members(edges: DataFrame) -> DataFrame:
    """``(cycle, position, node, length)`` of all cycles, without the nodes that lead into them."""
    on_cycle = _on_cycle(follow(edges).where("loops"))
    return _places(edges.join(on_cycle, "node", "left_semi"))


def _places(inner: DataFrame) -> DataFrame:
    """``(cycle, position, node, length)`` of the nodes on cycles.

    Each node knows the smallest node among the ``span`` nodes that start with it, and how far ahead
    that is. Doubling the span past the length of the cycle gives the name of the cycle and the distance
    to it, hence the position. A round that renames no node has seen every cycle whole, so rounds follow the
    longest cycle, not the number of nodes.
    """
    state = durable(
        inner.select(
            "node", F.col("next").alias("jump"), F.col("node").alias("cycle"), F.lit(0).cast("bigint").alias("ahead")
        )
    )
    span, renamed = 1, True
    while renamed:
        further = state.select(
            F.col("node").alias("_node"), F.col("jump").alias("_jump"), F.col("cycle").alias("_cycle"),
            F.col("ahead").alias("_ahead"),
        )
        smaller = F.col("_cycle") < F.col("cycle")
        state = durable(
            state.join(further, F.col("jump") == F.col("_node")).select(
                "node",
                F.col("_jump").alias("jump"),
                F.when(smaller, F.col("_cycle")).otherwise(F.col("cycle")).alias("cycle"),
                F.when(smaller, F.col("_ahead") + span).otherwise(F.col("ahead")).alias("ahead"),
                smaller.alias("renamed"),
            )
        )
        renamed = not state.where("renamed").isEmpty()
        state = state.drop("renamed")
        span *= 2
    sizes = state.groupBy("cycle").agg(F.count("*").alias("length"))
    position = (F.col("length") - F.col("ahead")) % F.col("length")
    return state.join(sizes, "cycle").select("cycle", position.alias("position"), "node", "length")
