"""Connected components of a graph given as edges, without collecting any component into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm.runs import double_pointers
from talkweave.runtime import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of the edges (a, b); root is the smallest id of its component.

    Each round every node points to its smallest neighbour if that is smaller than itself, pointers are doubled to
    their roots, and edges are contracted to edges between roots; the number of nodes with edges at least halves.
    Ids may be of any orderable type, null-free. Loops and repeated edges do no harm. No edges, no rows.
    """
    rest = cut(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("parent"))
        roots = double_pointers(parents).select("id", "root")  # rests on what pointer doubling has materialised
        if labels is None:
            labels = roots
        else:
            moved = labels.join(roots.select(F.col("id").alias("root"), F.col("root").alias("new")), "root", "left")
            labels = cut(moved.select("id", F.coalesce("new", "root").alias("root")))
        ra, rb = roots.select(F.col("id").alias("a"), F.col("root").alias("ra")), roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        rest = cut(rest.join(ra, "a").join(rb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct())
    return labels if labels is not None else rest.select(F.col("a").alias("id"), F.col("b").alias("root"))
