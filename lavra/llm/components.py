"""Connected components of a link table by hooking and pointer jumping, all as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.session import staged


def _jumped(parents: DataFrame) -> DataFrame:
    """Point every node straight at the end of its chain of parents.

    Parents are never larger than their node, so chains end; each turn halves what is left of them.
    """
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_grand"))
        step = staged(
            parents.join(up, "parent", "left").select("node", "parent", F.coalesce("_grand", "parent").alias("_next")),
            "jump",
        )
        moved = step.where("_next < parent").limit(1).count()
        parents = step.select("node", F.col("_next").alias("parent"))
        if not moved:
            return parents


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link to another one; the root is the smallest node.

    A turn hooks every node to its smallest neighbour (a partial aggregate, so hubs cost one row per
    task), flattens the chains, and rewrites the links between the roots that remain. The number of
    turns is logarithmic in practice; every table of a turn is written to the shared folder. Null
    ends, links of a node with itself and repeated links are ignored.
    """
    edges = staged(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(
            F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
        ).distinct(),
        "links",
    )
    turns = []
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
        parents = _jumped(staged(hooks.select("node", F.least("node", "_m").alias("parent")), "hooks"))
        turns.append(parents)
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("_ra"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("_rb"))
        ends = edges.join(left, "a").join(right, "b").where("_ra != _rb")
        edges = staged(ends.select(F.least("_ra", "_rb").alias("a"), F.greatest("_ra", "_rb").alias("b")).distinct(), "links")
    if not turns:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = turns[0].withColumnRenamed("parent", "root")
    for parents in turns[1:]:
        later = parents.select(F.col("node").alias("root"), F.col("parent").alias("_later"))
        found = found.join(later, "root", "left").select("node", F.coalesce("_later", "root").alias("root"))
    return found if len(turns) == 1 else staged(found, "roots")
