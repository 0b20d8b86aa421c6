"""Connected components of an edge table by alternating large and small stars.

Every round is a few joins and combinable ``min`` aggregates; its result is
written to the shared folder, so lineage stays short and a lost executor costs
one round.  A graph of at most ``FEW_EDGES`` edges is joined in the driver, as
the rounds' jobs would take longer than their work; larger ones aren't collected."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import saved

#: Edges (16 bytes each) that the driver takes.
FEW_EDGES = 200_000


def _stars(e: DataFrame) -> bool:
    """Whether every ``u`` has one edge and no ``v`` has one itself."""
    n = e.agg(F.count("*").alias("n"), F.countDistinct("u").alias("d")).first()
    return n.n == n.d and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def least_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges ``(u, v)``, sorted, and the smallest node of each one's component."""
    names, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(names))
    while (apart := label[a] != label[b]).any():
        a, b = a[apart], b[apart]
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]
    return names, names[label]


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """``node, label`` for every node of ``edges (u, v)``: label is the component's smallest node.

    Loops and repeated edges are ignored."""
    e = saved(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    if 0 < e.count() <= few:
        t = e.toArrow()
        names, label = least_nodes(*(t.column(c).to_numpy() for c in ("u", "v")))
        return saved(e.sparkSession.createDataFrame(pa.table({"node": names, "label": label})), "cc-labels")
    while not _stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = saved(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = saved(large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .union(low.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
    return saved(e.select(F.col("u").alias("node"), F.col("v").alias("label"))
                 .union(e.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct(), "cc-labels")
