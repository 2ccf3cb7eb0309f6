"""Connected components by repeated contraction."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.work import forget, written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u long, v long)`` -> ``(node long, component long)``, component being its smallest node.

    Each round every vertex joins the least of itself and its neighbours and the graph shrinks to
    those representatives, until no edge is left. "Least" is by id in even rounds, which takes stars
    around a smallest id in one round, and by a fresh hash in odd ones, which shrinks long chains
    by a constant factor. Minima are partial aggregates, so a hub costs one row a map task. Joins
    have one unique side; adaptive execution splits their large side. Self loops and null ends are
    ignored; nodes without an edge are not returned. Every round ends in a written table.
    """
    e = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    e = written(e.distinct(), "edges")
    labels = None
    for k in range(max_rounds):
        if e.isEmpty():
            break
        both = e.union(e.select("v", "u"))
        rank = (lambda c: F.col(c)) if k % 2 == 0 else (lambda c, k=k: F.xxhash64(F.col(c), F.lit(k)))
        best = both.groupBy("u").agg(F.min_by("v", rank("v")).alias("v"))
        parent = written(best.select("u", F.when(rank("u") <= rank("v"), F.col("u")).otherwise(F.col("v")).alias("p")), "parents")
        if labels is None:
            new = parent.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            new = labels.join(parent, F.col("root") == F.col("u"), "left").select("node", F.coalesce("p", "root").alias("root"))
        new = written(new, "labels")
        a = e.join(parent, "u").select(F.col("p").alias("pu"), "v")
        b = a.join(parent.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v").where("pu <> pv")
        shrunk = written(b.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "edges")
        for old in (e, parent, labels):
            if old is not None:
                forget(old)
        e, labels = shrunk, new
    else:
        if not e.isEmpty():
            raise RuntimeError("components did not converge")
    if labels is None:
        return e.select(F.col("u").alias("node"), F.col("u").alias("component"))
    least = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(least, "root").select("node", "component")


def thinned(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``hit`` that join the same rows and columns as all of them."""
    if np.count_nonzero(hit) <= 8 * sum(hit.shape):
        return np.nonzero(hit)
    claim = np.full(hit.shape[1], -1)
    rows, cols = [], []
    for i in np.flatnonzero(hit.any(1)).tolist():
        at = np.flatnonzero(hit[i])
        # columns that an earlier row has are joined already: one of each such row is enough
        old = at[claim[at] >= 0]
        at = at[claim[at] < 0]
        some = np.concatenate([at, old[np.unique(claim[old], return_index=True)[1]]])
        claim[at] = i
        rows.append(np.full(len(some), i))
        cols.append(some)
    return np.concatenate(rows), np.concatenate(cols)
