"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.llm.common import checkpoint, remove, store
from scorekit.sources.scratch import scratch_path


def components(edges: DataFrame) -> DataFrame:
    """One row `node, component` per node of `edges` (`a, b`, both long); components are named by one of
    their nodes. An edge from a node to itself says nothing.

    In each round every node asks for that neighbour, or itself, which comes first in an order drawn
    anew for the round, and takes the name that one has found. The edges between different names go on.
    Names get fewer by a constant share, so the rounds grow with the logarithm of the nodes. Neighbours
    are aggregated before they are shuffled, so that a node with very many of them is no burden.

    What a round leaves is written to the shared scratch folder, which is emptied at the end.
    """
    spark = edges.sparkSession
    folder = scratch_path(spark, "components")
    left = store(edges.where("a <> b").select("a", "b").distinct(), folder, "edges-0")
    names = []
    while not left.isEmpty():
        turn = len(names)
        both = left.union(left.select("b", "a"))
        order = F.struct(F.xxhash64(F.lit(turn), "b"), "b")
        own = F.struct(F.xxhash64(F.lit(turn), "a"), F.col("a").alias("b"))
        first = both.groupBy("a").agg(F.min(order).alias("first"))
        asked = first.select(F.col("a").alias("node"), F.least("first", own)["b"].alias("next"))
        asked = store(asked, folder, f"asked-{turn}")
        further = asked.toDF("next", "name")
        name = store(asked.join(further, "next").select("node", "name"), folder, f"names-{turn}")
        names.append(name)
        left = left.join(name.toDF("a", "new_a"), "a").join(name.toDF("b", "new_b"), "b")
        left = left.where("new_a <> new_b").select("new_a", "new_b").toDF("a", "b").distinct()
        left = store(left, folder, f"edges-{turn + 1}")
    found = left.toDF("node", "component")
    for i, name in enumerate(names):
        if i == 0:
            found = name.toDF("node", "component")
            continue
        joined = found.join(name.toDF("component", "name"), "component", "left")
        found = joined.select("node", F.coalesce("name", "component").alias("component"))
        found = store(found, folder, f"found-{i}")
    found = checkpoint(found)
    remove(spark, folder)
    return found
