"""Connected components of links kept as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.session import stored


def _stars(edges: DataFrame, up: bool) -> DataFrame:
    """Hang every neighbour on the least node of its neighbourhood.

    ``up`` moves the neighbours above the node, otherwise those below it and the node itself. Minima are
    partially aggregated and the join may be split, so a node with very many links is no single task.
    """
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if up else edges
    least = both.groupBy("src").agg(F.min("dst").alias("low")).withColumn("low", F.least("low", "src"))
    joined = both.join(least, "src")
    if up:
        moved = joined.filter("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    else:
        moved = joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(
            least.select("src", F.col("low").alias("dst"))
        )
    return moved.filter("src <> dst").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` links to ``(node, component)``, the component being its least node.

    Alternates the two star steps until the table no longer changes; each round is written to the shared
    folder, so lineage stays short and lost executors cost one round. Nodes without a link are not returned.
    Rounds grow with the logarithm of the longest chain. Links with a NULL end are ignored.
    """
    edges = stored(
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
        .distinct(),
        "links",
    )
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == seen:
            break
        seen = tuple(mark)
        edges = stored(_stars(_stars(edges, up=True), up=False), "stars")
    roots = edges.select(F.col("dst").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
