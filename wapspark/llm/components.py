"""Connected components of an undirected graph held as edge rows.

Each round sends every node to its smallest neighbour (or itself), twice, and
renames the edges' ends accordingly; edges inside a node vanish. An edge
(u, p(u)) becomes (p(p(u)), p(p(p(u)))), so what was connected stays
connected, and no round gathers a node's neighbours: it takes only minima,
combined before they are shuffled. Rounds end when no edge is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wapspark.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of
    ``edges`` (two columns of one type); loops and repeats do no harm, rows
    with a null end are no edges."""
    ensure_checkpoint_dir(edges.sparkSession)
    a, b = edges.columns
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    e = e.union(e.select("v", "u")).distinct().checkpoint()
    labels = e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    e = e.filter("u <> v")
    while not e.isEmpty():
        up = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p"))
        up = up.alias("x").join(up.alias("y"), F.col("x.p") == F.col("y.u")).select(
            F.col("x.u").alias("w"), F.col("y.p").alias("p")).checkpoint()
        labels = labels.join(up, labels["root"] == up["w"], "left").select(
            "node", F.coalesce("p", "root").alias("root")).checkpoint()
        e = (e.join(up, F.col("u") == F.col("w")).select(F.col("p").alias("u"), "v")
             .join(up, F.col("v") == F.col("w")).select("u", F.col("p").alias("v"))
             .filter("u <> v").distinct().checkpoint())
    return labels
