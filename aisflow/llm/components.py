"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisflow.storage import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge (a, b): root is the smallest node reachable.

    Each round a node takes the smallest root among its neighbours, then the
    root of its root; both are minima, so the hub of a star is combined before
    it is shuffled. A round's table is written to the shared folder, and rounds
    end when nothing changes; paths shrink by at least half in a round.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct()
    both = written(both, "edges")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
    while True:
        around = both.join(roots, both["b"] == roots["node"]).groupBy("a").agg(F.min("root").alias("_near"))
        lower = roots.join(around, roots["node"] == around["a"]).select(
            "node", F.col("root").alias("_old"), F.least("root", "_near").alias("root")
        )
        lower = written(lower, "roots")
        above = lower.select(F.col("node").alias("_up"), F.col("root").alias("_far"))
        moved = lower.join(above, lower["root"] == above["_up"]).select("node", "_old", F.least("root", "_far").alias("root"))
        roots = written(moved, "roots")
        if not roots.where("root != _old").limit(1).count():
            return roots.select("node", "root")
        roots = roots.select("node", "root")
