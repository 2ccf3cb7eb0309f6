"""Approximate nearest neighbours along shifted Hilbert curves."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.op1_embedding_dedup import by_length, usable
from millrace.llm.streams import runs
from millrace.operators.cleaning import dense_id
from millrace.plans.work import written
from millrace.sources import table

#: Curves; projected dimensions and bits a dimension of each; rows of a block of neighbouring keys.
CURVES, DIMS, BITS, BLOCK_ROWS = 24, 6, 7, 2048
#: Share of true neighbours that the window is fitted to meet; queries it is fitted on.
RECALL, FITTED = 0.96, 200


def hilbert_keys(cell: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows x dims of ``bits`` bits each)."""
    x = cell.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of each level, from the coarsest
        low = q - 1
        for i in range(dims):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code over the dimensions
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b) & 1
    return key


def curve_keys(unit: np.ndarray, curve: int, seed: int) -> np.ndarray:
    """Keys on one curve: a random projection, a random shift, a grid and its Hilbert order."""
    d = unit.shape[1]
    rng = np.random.default_rng([seed, curve, d])
    k = min(DIMS, d)
    turn = np.linalg.qr(rng.standard_normal((d, k)))[0]
    # projected unit vectors spread as d ** -0.5; four of those either side, and the shift, are on the grid
    spread = (unit @ turn) * d**0.5 + 4 + rng.uniform(-0.5, 0.5, k)
    return hilbert_keys(np.clip(spread / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, curves: int = CURVES, recall: float = RECALL, window: int | None = None, seed: int = 29) -> DataFrame:
    """Each query's ``k`` nearest vectors by cosine: ``(vec_id, embedding)`` twice -> query_id, rank, vec_id, score.

    1. Equal vectors, queries included, become one node; a candidate keeps its k + 1 smallest ids.
    2. Nodes are range-partitioned by key on each of ``curves`` shifted Hilbert curves and numbered
       along it. Only keys and ids are sorted.
    3. A query is compared with the nodes whose numbers are within ``window`` of its own on any
       curve, row-exact, by cosine in double precision. Candidates are dealt by number into blocks
       of ``BLOCK_ROWS``, a query goes to the blocks that its windows touch, and the blocks' top
       lists merge. One block and a batch of queries are in memory at a time.

    ``window`` is a number of rows. Left out, it is fitted: ``FITTED`` queries (by a hash of their
    node) meet all candidates exactly, and the window is the least one that holds ``recall`` of
    their true neighbours on some curve. Vectors with structure get a short window; isotropic ones
    (whose nearest cosine lies near 0.45 in 64 dimensions) have little locality that any order
    could use, and their window follows the table.

    Nearest first, ties to the smaller vec_id; a query is never its own answer, but an equal vector
    under another id is. Queries with fewer candidates return all that their windows hold; a window
    holds at least 2 k rows. Null, zero, empty and non-finite vectors and null ids take no part and
    give no rows; vectors of different lengths are not compared. Repeated rows with one vec_id count
    once; a vec_id with several vectors counts with the nearest of them, as a query and as an
    answer. Other columns are ignored. Empty tables give no rows.
    """
    clean = lambda x: x.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(usable() & F.col("vec_id").isNotNull())
    both = clean(vectors).withColumn("asks", F.lit(False)).union(clean(queries).withColumn("asks", F.lit(True))).distinct()
    # k + 1 smallest ids of each vector's candidates: the window keeps k + 1 rows a task before the shuffle
    ids = both.where("NOT asks").withColumn("r", F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))).where(F.col("r") <= k + 1).select("embedding", "vec_id", "asks")
    nodes = ids.union(both.where("asks").select("embedding", "vec_id", "asks")).groupBy("embedding")
    nodes = nodes.agg(F.sort_array(F.collect_list(F.when(~F.col("asks"), F.col("vec_id")))).alias("ids"), F.max("asks").alias("asks"))
    nodes = written(nodes.withColumn("node", F.xxhash64("embedding", F.lit(seed))), "nodes")
    kind = vectors.schema["embedding"].dataType.simpleString()

    def keyed(batches):
        for b in batches:
            own, emb = b.column(b.schema.get_field_index("node")), b.column(b.schema.get_field_index("embedding"))
            for d, rows, unit in by_length(emb):
                mine = own.take(pa.array(rows))
                for c in range(curves):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), d, np.int32)), pa.array(np.full(len(rows), c, np.int32)), pa.array(curve_keys(unit, c, seed)), mine], ["dim", "curve", "key", "node"])

    placed = dense_id(nodes.select("node", "embedding").mapInArrow(keyed, "dim int, curve int, key long, node long"), ["dim", "curve", "key", "node"], "place")
    spans = placed.groupBy("dim", "curve").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))  # one row a curve
    at = placed.join(F.broadcast(spans), ["dim", "curve"]).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("curve", "place", "lo", "hi"))).alias("at"))
    nodes = written(nodes.join(at, "node"), "placed-nodes")
    if window is None:
        window = fitted_window(nodes, k, recall, seed)
    window = max(window, k)

    block = lambda c: F.floor(F.col(c) / BLOCK_ROWS)
    cand = nodes.where(F.size("ids") > 0).select("node", "embedding", F.explode("at").alias("x"))
    cand = cand.select(block("x.place").alias("block"), F.lit(0).alias("side"), "node", F.col("x.place").alias("first"), F.col("x.place").alias("last"), "embedding")
    ask = nodes.where("asks").select("node", "embedding", F.explode("at").alias("x"))
    ask = ask.select("node", F.greatest("x.lo", F.col("x.place") - window).alias("first"), F.least("x.hi", F.col("x.place") + window).alias("last"), "embedding")
    ask = ask.select(F.explode(F.sequence(block("first"), block("last"))).alias("block"), F.lit(1).alias("side"), "node", "first", "last", "embedding")

    def search(batches):
        rows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        now = None
        for t in runs(batches, ["block", "side"]):
            block, side = t.column("block")[0].as_py(), t.column("side")[0].as_py()
            node, first, last = (t.column(c).to_numpy() for c in ("node", "first", "last"))
            if side == 0:
                now, rows = block, {d: (node[r], first[r], u) for d, r, u in by_length(t.column("embedding"))}
                continue
            if block != now:
                continue
            for s in range(0, t.num_rows, 1024):
                part = t.slice(s, 1024)
                for d, r, u in by_length(part.column("embedding")):
                    if d not in rows:
                        continue
                    cand, place, m = rows[d]
                    r = r + s
                    score = u @ m.T
                    score[(place < first[r][:, None]) | (place > last[r][:, None])] = -2
                    some = min(k + 1, score.shape[1])
                    # all that tie with the last kept one stay, so that ties go to smaller ids later
                    least = np.maximum(-np.partition(-score, some - 1, axis=1)[:, some - 1] - 1e-12, -1.5)
                    i, j = np.nonzero(score >= least[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(node[r][i]), pa.array(cand[j]), pa.array(score[i, j])], ["asker", "node", "near"])

    found = cand.union(ask).repartition("block").sortWithinPartitions("block", "side").mapInArrow(search, "asker long, node long, near double")
    # a pair met on several curves is one, though its product may differ in the last bits from block to block
    found = found.groupBy("asker", "node").agg(F.max("near").alias("near"))
    asks = W.partitionBy("asker")
    found = found.withColumn("r", F.row_number().over(asks.orderBy(F.desc("near"))))
    # what ties with the last slot within rounding stays, as it does in a block
    found = found.withColumn("last", F.min(F.when(F.col("r") <= k + 1, F.col("near"))).over(asks)).where(F.col("near") >= F.col("last") - 1e-12)
    full = found.select("asker", "node").join(nodes.select("node", "ids", F.col("embedding").alias("v")), "node").join(nodes.select(F.col("node").alias("asker"), F.col("embedding").alias("q")), "asker")
    full = written(full.select("q", F.explode("ids").alias("vec_id"), cosine("q", "v").alias("score")), "reranked")
    full = both.where("asks").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")).join(full, "q").where("query_id <> vec_id")
    full = full.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return full.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def fitted_window(nodes: DataFrame, k: int, recall: float, seed: int) -> int:
    """The least window that holds ``recall`` of the true neighbours of ``FITTED`` queries on some curve.

    ``nodes(node, embedding, ids, asks, at)``. The sample is bounded by ``FITTED`` and is sent to
    every task; it meets all candidates, of which each task returns k a query.
    """
    some = nodes.where("asks").orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(FITTED).select("node", "embedding", "at").toArrow()
    if not some.num_rows:
        return k
    asker = some.column("node").to_numpy()
    units = {d: (r, u) for d, r, u in by_length(some.column("embedding"))}
    sent = nodes.sparkSession.sparkContext.broadcast((asker, units))  # FITTED vectors

    def score(batches):
        asker, units = sent.value
        for b in batches:
            node = b.column(b.schema.get_field_index("node")).to_numpy()
            for d, rows, unit in by_length(b.column(b.schema.get_field_index("embedding"))):
                if d not in units:
                    continue
                r, u = units[d]
                near = u @ unit.T
                near[asker[r][:, None] == node[rows]] = -2
                top = np.argpartition(-near, min(k, near.shape[1]) - 1, axis=1)[:, :k]
                i = np.repeat(np.arange(len(r)), top.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(asker[r][i]), pa.array(node[rows][top.ravel()]), pa.array(near[i, top.ravel()])], ["asker", "node", "near"])

    near = nodes.where(F.size("ids") > 0).select("node", "embedding").mapInArrow(score, "asker long, node long, near double").where("near > -1.5")
    best = near.withColumn("r", F.row_number().over(W.partitionBy("asker").orderBy(F.desc("near"), "node"))).where(F.col("r") <= k)
    true = best.select("asker", "node").join(nodes.select("node", F.col("at.place").alias("place")), "node").select("asker", "place").toArrow()  # k rows a query
    if not true.num_rows:
        return k
    own = {n: np.array([x["place"] for x in at]) for n, at in zip(asker.tolist(), some.column("at").to_pylist(), strict=True)}
    gap = sorted(int(np.abs(own[a] - np.array(p)).min()) for a, p in zip(true.column("asker").to_pylist(), true.column("place").to_pylist(), strict=True))
    return gap[min(len(gap) - 1, math.ceil(recall * len(gap)) - 1)]


def cosine(a: str, b: str):
    """Cosine of two arrays of equal length in double precision."""
    dot = lambda x, y: F.aggregate(F.zip_with(F.col(x).cast("array<double>"), F.col(y).cast("array<double>"), lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def op3_hilbert_search(spark, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))
