"""Chains and cycles of 'supersedes' references derived from the key columns."""

from pyspark.sql import functions as F

from shelfwright.operators import findings as fd, lineage
from shelfwright.plans.registry import query


def _tree(t):
    """Each part supersedes the one with half its key; part 0 supersedes nothing."""
    parts = t.part.select(
        "p_partkey", F.when(F.col("p_partkey") > 0, F.expr("p_partkey div 2")).alias("supersedes")
    )
    return lineage.edges_of(parts, "p_partkey", "supersedes")


def _rings(t):
    """Each customer supersedes customer (k * k + 1) mod n: tails that lead into cycles."""
    n = t.customer.agg(F.count("*")).scalar()
    customers = t.customer.select(
        "c_custkey", ((F.col("c_custkey") * F.col("c_custkey") + 1) % n).alias("supersedes")
    )
    return lineage.edges_of(customers, "c_custkey", "supersedes")


@query("SELECT p_partkey AS node, p_partkey // 2 AS next FROM part WHERE p_partkey > 0")
def lineage_edges(t):
    return _tree(t)


@query(
    """
    WITH RECURSIVE walk AS (
      SELECT p_partkey AS node, p_partkey AS place, 0::BIGINT AS depth FROM part
      UNION ALL SELECT node, place // 2, depth + 1 FROM walk WHERE place > 0)
    SELECT node, 0::BIGINT AS last, max(depth) AS depth, false AS loops FROM walk GROUP BY node HAVING max(depth) > 0
    """
)
def lineage_depth(t):
    return lineage.follow(_tree(t))


_WALK = """
    WITH RECURSIVE n AS (SELECT count(*) AS n FROM customer),
    edge AS (SELECT c_custkey AS node, ((c_custkey * c_custkey + 1) % n)::BIGINT AS next FROM customer, n),
    walk AS (
      SELECT node AS start, next AS ahead, [node] AS path FROM edge
      UNION ALL
      SELECT w.start, e.next, list_append(w.path, e.node) FROM walk w JOIN edge e ON e.node = w.ahead
      WHERE NOT list_contains(w.path, w.ahead)),
    closed AS (SELECT start, ahead AS entry, path, list_position(path, ahead) AS place FROM walk
               WHERE list_contains(path, ahead)),
    found AS (SELECT start AS node, entry, (place - 1)::BIGINT AS steps, list_min(path[place:]) AS cycle,
                     len(path[place:])::BIGINT AS length FROM closed)
"""


@query(_WALK + "SELECT node, entry, steps, cycle, length FROM found")
def lineage_cycles(t):
    starts, _ = lineage.cycles(_rings(t))
    return starts.select("node", "entry", "steps", "cycle", "length")


@query(
    _WALK
    + """,
    heads AS (SELECT start AS cycle, path FROM closed WHERE place = 1 AND start = list_min(path))
    SELECT cycle, generate_subscripts(path, 1)::BIGINT - 1 AS position, unnest(path) AS node, len(path)::BIGINT AS length
    FROM heads
    """
)
def lineage_cycle_members(t):
    return lineage.cycle_members(_rings(t))


@query(
    _WALK
    + """
    SELECT 'customer' AS collection, node::VARCHAR AS slug, 0 AS tier, 'E199' AS code, 'supersedes' AS path,
           'supersedes chain runs into the cycle of ' || length || ' at ' || entry AS message,
           NULL::VARCHAR AS suggestion
    FROM found
    """
)
def rule_lineage_cycle(t):
    starts, _ = lineage.cycles(_rings(t))
    message = F.concat_ws(
        " ", F.lit("supersedes chain runs into the cycle of"), "length", F.lit("at"), "entry"
    )
    return fd.finding(
        starts, tier=fd.OUTSIDE_TIERS, code="E199", path="supersedes", message=message,
        collection=F.lit("customer"), slug="node",
    )
