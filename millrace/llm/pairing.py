"""Exact links within groups of likely neighbours, dealt out in bounded tasks."""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.streams import forest, runs

LINKS = "id long, n long, root long"


def group_links(members: DataFrame, linked: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray], payload: str, block: int) -> DataFrame:
    """Count every row's links inside its group, and span the links with few edges.

    ``members``: ``gid long, id long, weight long, core boolean`` and the ``payload`` column. Rows of
    a group flagged ``core`` are known to link with one another and are not compared among
    themselves. All other pairs of a group are compared once: its rows are dealt by hash into blocks
    of about ``block`` rows, and each pair of blocks with at least one non-core block is a task, so a
    task's memory is bounded whatever the size of the group, and no pair of rows is ever a row.

    ``linked(table, a, b)`` gives the Boolean matrix of links between the rows ``a`` and ``b``.
    Returns ``id, n, root``: partial weight sums of the linked rows (to be summed by id) and, for
    each id, a linked-to-or-equal id that spans the same links (edges id-root).
    """
    sizes = members.groupBy("gid").agg(F.count_if("core").alias("n_core"), F.count_if(~F.col("core")).alias("n_rest"), F.min(F.when(F.col("core"), F.col("id"))).alias("head"), F.sum(F.when(F.col("core"), F.col("weight"))).alias("w_core"))
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / F.lit(float(block))), F.lit(1)).cast("int")
    m = members.join(sizes, "gid").withColumn("bc", F.when(F.col("n_core") > 0, blocks("n_core")).otherwise(0)).withColumn("bs", F.when(F.col("n_rest") > 0, blocks("n_rest")).otherwise(0))
    sure = m.where("core").select("id", (F.col("w_core") - F.col("weight")).alias("n"), F.col("head").alias("root"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("core"), F.col("bc")).otherwise(F.col("bs"))).cast("int")
    # non-core blocks are 0.. and core blocks -1, -2, ..; a task is (a, b) with a >= 0 and b <= a
    m = m.where("bs > 0").withColumn("own", F.when(F.col("core"), -1 - own).otherwise(own))
    with_rest = F.sequence(F.lit(0), F.col("bs") - 1)
    others = F.when(F.col("core"), with_rest).otherwise(F.when(F.col("bc") > 0, F.concat(F.sequence(-F.col("bc"), F.lit(-1)), with_rest)).otherwise(with_rest))
    m = m.select("gid", "id", "weight", "own", payload, F.explode(others).alias("other"))
    m = m.select("gid", F.greatest("own", "other").alias("a"), F.least("own", "other").alias("b"), "own", "id", "weight", payload)

    def compare(batches):
        for t in runs(batches, ["gid", "a", "b"]):
            if t.num_rows < 2:
                continue
            own, ids, weight = (t.column(c).to_numpy() for c in ("own", "id", "weight"))
            a, b = t.column("a")[0].as_py(), t.column("b")[0].as_py()
            left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
            if not len(left) or not len(right):
                continue
            hit = linked(t, left, right)
            n = np.zeros(t.num_rows, np.int64)
            if a == b:
                np.fill_diagonal(hit, False)
                n[left] = hit @ weight[right]
            else:
                n[left] = hit @ weight[right]
                n[right] = hit.T @ weight[left]
            i, j = np.nonzero(hit)
            if not len(i):
                continue
            root = forest(t.num_rows, left[i].tolist(), right[j].tolist())
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some]), pa.array(ids[np.array(root)[some]])], ["id", "n", "root"])

    tasks = m.repartition("gid", "a", "b").sortWithinPartitions("gid", "a", "b").mapInArrow(compare, LINKS)
    return sure.union(tasks)
