"""Encoders and retrieval: top k by similarity or above a threshold, over channels; event clusters."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import word_count
from millrace.plans.graph import connected_components, thinned
from millrace.plans.ship import ship
from millrace.plans.work import written
from millrace.sources import table


def dot(a: str, b: str) -> Column:
    """Dot product of two arrays in double precision."""
    return F.aggregate(F.zip_with(F.col(a).cast("array<double>"), F.col(b).cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


#: Query vectors times k (at least 100) of one pass: more queries are taken in several passes, so that what is sent
#: to every task is bounded. Rows and columns of a tile of similarities.
PASS_CELLS, DOC_TILE, QUERY_TILE = 4_000_000, 4096, 1024


def finite(vector: str = "embedding") -> Column:
    """Non-null vectors, not empty, all of whose components are finite."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _by_length(column) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) for each vector length in a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy()
    flat, off = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(size)])
    out = []
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        out.append((d, rows, flat[(off[:-1][rows, None] + np.arange(d)).ravel()].reshape(-1, d)))
    return out


def topk_or_threshold(queries: DataFrame, docs: DataFrame, k: int, least: float) -> DataFrame:
    """``queries(query_id, embedding)``, ``docs(doc_id, embedding)`` -> ``query_id, doc_id, sim``.

    Per query vector: its k most similar documents (ties to the smaller id) and all with ``sim >=
    least``. The stated query set meets all documents in blocks: each task multiplies tiles of
    documents and queries, keeps of a tile what could be in either set, given the best k-th
    similarity it has seen so far, and a window over those few rows finishes. What a task holds is a
    tile and one number a query. Similarities are rounded to 6 decimals before they are compared.

    Null ids, and vectors that are null, empty or hold null or non-finite components, take no part;
    vectors of different lengths are not compared. Several vectors of one query_id each have their
    k, and a pair counts once with its highest similarity, as do repeated documents. Empty tables
    give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = queries.where("query_id IS NOT NULL").where(finite()).select(F.col("query_id").cast("long").alias("query_id"), "embedding").distinct()
    asked = written(asked, "queries")
    n = max(1, -(-asked.count() * max(100, k) // PASS_CELLS))
    found = docs.where("doc_id IS NOT NULL").where(finite()).select(F.col("doc_id").cast("long").alias("doc_id"), "embedding")
    out = None
    for i in range(n):
        some = (asked if n == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i)).toArrow()
        one = _best(_scored(some, found, k, least), k, least)
        out = one if out is None else out.union(one)
    return out.groupBy("query_id", "doc_id").agg(F.max("sim").alias("sim"))


def _scored(queries: pa.Table, docs: DataFrame, k: int, least: float) -> DataFrame:
    ids = queries.column("query_id").to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast((ids, {d: (r, m) for d, r, m in _by_length(queries.column("embedding"))}))

    def score(batches):
        ids, by = sent.value
        floor = np.full(len(ids), -np.inf)  # a k-th best similarity that has been seen
        for b in batches:
            doc = b.column(b.schema.get_field_index("doc_id")).to_numpy()
            for d, rows, x in _by_length(b.column(b.schema.get_field_index("embedding"))):
                if d not in by:
                    continue
                at, m = by[d]
                for s in range(0, len(rows), DOC_TILE):
                    for t in range(0, len(at), QUERY_TILE):
                        own, q = rows[s : s + DOC_TILE], at[t : t + QUERY_TILE]
                        sim = np.round(x[s : s + DOC_TILE] @ m[t : t + QUERY_TILE].T, 6)
                        if 0 < k <= len(own):
                            floor[q] = np.maximum(floor[q], -np.partition(-sim, k - 1, axis=0)[k - 1])
                        i, j = np.nonzero(sim >= (np.minimum(floor[q], least) if k else least))
                        if len(i):
                            yield pa.RecordBatch.from_arrays([pa.array(q[j]), pa.array(ids[q[j]]), pa.array(doc[own[i]]), pa.array(sim[i, j])], ["vector", "query_id", "doc_id", "sim"])

    return docs.mapInArrow(score, "vector long, query_id long, doc_id long, sim double")


def _best(near: DataFrame, k: int, least: float) -> DataFrame:
    near = near.distinct()
    r = F.row_number().over(W.partitionBy("vector").orderBy(F.desc("sim"), "doc_id"))
    top = near.withColumn("r", r).where(F.col("r") <= k).drop("r")
    return top.union(near.where(F.col("sim") >= least)).select("query_id", "doc_id", "sim")


def retrieve(channels: list[DataFrame], docs: DataFrame, k: int, least: float) -> DataFrame:
    """The union over channels of a query's vectors, each pair with its highest similarity."""
    out = None
    for c in channels:
        one = topk_or_threshold(c, docs, k, least)
        out = one if out is None else out.union(one)
    return out.groupBy("query_id", "doc_id").agg(F.max("sim").alias("sim"))


def encode(texts: DataFrame, key: str, text: str, dims: int = 64) -> DataFrame:
    """``key, embedding``: unit vectors by feature hashing of lower-case words; the place of a learned encoder.

    Every word adds +1 or -1, by its MD5, to one of ``dims`` places: built-in functions alone. A
    text without words has no vector (null), and neither has one whose words cancel out. Rows of one
    key are one text; a null key is a key. An empty table gives no rows.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    w = texts.select(key, F.explode_outer(words).alias("w")).groupBy(key, "w").agg(F.count("*").alias("n"))
    digit = lambda a, b: F.conv(F.substring(F.md5("w"), a, b), 16, 10).cast("long")
    w = w.groupBy(key, (digit(1, 6) % dims).alias("i")).agg(F.sum(F.when(F.col("w").isNotNull(), F.when(digit(7, 1) < 8, F.col("n")).otherwise(-F.col("n")))).alias("x"))
    size = F.sqrt(F.sum(F.col("x") * F.col("x")).cast("double"))
    v = w.groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(F.col("x").isNotNull(), F.struct("i", "x")))).alias("m"), size.alias("n"))
    each = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(dims - 1).cast("long")), lambda i: (F.coalesce(F.try_element_at("m", i), F.lit(0)) / F.col("n")).cast("float"))
    return v.select(key, F.when(F.col("n") > 0, each).alias("embedding"))


def truncated(texts: DataFrame, text: str, most: int) -> DataFrame:
    """``truncated, n, share``: texts of more than ``most`` words, all texts, and their ratio."""
    n = texts.agg(F.count_if(word_count(text) > most).alias("truncated"), F.count("*").alias("n"))
    return n.select("truncated", "n", (F.col("truncated") / F.greatest("n", F.lit(1))).alias("share"))


def shard(df: DataFrame, order: str, index: int, total: int) -> DataFrame:
    """The ``index``-th of ``total`` contiguous slices of ceil(n / total) rows."""
    from millrace.operators.cleaning import dense_id

    n = df.agg(F.ceil(F.count("*") / total).alias("_size"))
    r = dense_id(df, [order], "_r").crossJoin(F.broadcast(n))  # one row
    return r.where(F.floor(F.col("_r") / F.col("_size")) == index).drop("_r", "_size")


#: Rows of a block of documents in a window.
FACING = 2048


def event_clusters(vectors: DataFrame, days: int = 3, k: int = 30, least: float = 0.55) -> DataFrame:
    """``vectors(doc_id, day date, embedding)`` -> ``doc_id, cluster_id``: a design of our own.

    Windows of ``days`` days, one day apart, each link a document to its k most similar documents of
    the window with similarity at least ``least``; a pair that lists one another in a window is an
    edge, and clusters are connected components over all windows. Equal vectors of a window are one
    document in this and share its cluster; all that tie with the k-th, to 6 decimals, are listed.
    Documents without an edge are not returned, nor are those whose vector is zero or not finite.

    A window's distinct vectors are dealt into blocks of about ``FACING`` rows and a pair of blocks
    is a task: once for the k-th similarity of each, once for the edges, as a forest. Work grows
    with the square of the distinct documents of a window.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = vectors.where("doc_id IS NOT NULL AND day IS NOT NULL").where(finite() & F.exists("embedding", lambda x: x != 0))
    w = v.select("doc_id", "embedding", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.unix_date(F.date_sub("day", i)))).alias("window"))
    nodes = written(w.groupBy("window", "embedding").agg(F.min("doc_id").cast("long").alias("id")), "event-nodes")
    copies = w.join(nodes, ["window", "embedding"]).where("doc_id <> id").select(F.col("id").alias("u"), F.col("doc_id").cast("long").alias("v"))
    sizes = nodes.groupBy("window").agg(F.ceil(F.count("*") / FACING).cast("int").alias("blocks"))

    def dealt(n: DataFrame) -> DataFrame:
        n = n.join(sizes, "window").withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        n = n.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return n.withColumns({"a": F.greatest("own", "other"), "b": F.least("own", "other")}).drop("blocks", "other").groupBy("window", "a", "b")

    def facing(key, pdf):
        """Rows of both blocks and their similarities; of a block with itself, -2 on the diagonal."""
        m = np.stack(pdf.embedding.to_numpy()).astype(np.float64)
        m /= np.abs(m).max(1, keepdims=True)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        own = pdf.own.to_numpy()
        i, j = np.flatnonzero(own == key[1]), np.flatnonzero(own == key[2])
        sim = np.round(m[i] @ m[j].T, 6)
        if key[1] == key[2]:
            np.fill_diagonal(sim, -2)
        return i, j, sim

    def nearest(key, pdf):
        import pandas as pd

        i, j, sim = facing(key, pdf)
        sides = [(i, sim)] if key[1] == key[2] else [(i, sim), (j, sim.T)]
        ids, parts = pdf.id.to_numpy(), []
        for at, x in sides:
            some = min(k, x.shape[1])
            if some:
                parts.append(pd.DataFrame({"window": key[0], "id": ids[at], "sims": list(-np.partition(-x, some - 1, axis=1)[:, :some])}))
        return pd.concat(parts) if parts else pd.DataFrame({"window": [], "id": [], "sims": []})

    near = dealt(nodes).applyInPandas(nearest, "window int, id long, sims array<double>")
    kth = F.coalesce(F.try_element_at(F.sort_array(F.flatten(F.collect_list("sims")), asc=False), F.lit(k)), F.lit(-2.0))
    floors = near.groupBy("window", "id").agg(F.greatest(kth, F.lit(float(least))).alias("floor"))
    listed = written(nodes.join(floors, ["window", "id"]), "event-floors")

    def edges(key, pdf):
        import pandas as pd

        i, j, sim = facing(key, pdf)
        ids, floor = pdf.id.to_numpy(), pdf.floor.to_numpy()
        hit = sim >= np.maximum(floor[i][:, None], floor[j])
        x, y = thinned(np.triu(hit, 1) if key[1] == key[2] else hit)
        return pd.DataFrame({"u": ids[i[x]], "v": ids[j[y]]})

    found = connected_components(dealt(listed).applyInPandas(edges, "u long, v long").union(copies))
    return found.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster_id"))


def _vectors(s, d):
    return table(s, d, "embeddings")


def q_retrieve(s, d):
    """Every hundredth row asks all rows, with its own vector and with that of the row after it."""
    v = _vectors(s, d)
    docs = v.select(F.col("vec_id").alias("doc_id"), "embedding")
    ask = [v.where((F.col("vec_id") - c) % 100 == 0).select((F.col("vec_id") - c).alias("query_id"), "embedding") for c in (0, 1)]
    return retrieve(ask, docs, 10, 0.4)


def q_similarity(s, d):
    v = _vectors(s, d)
    one = v.where("vec_id = 0").select(F.col("embedding").alias("q"))
    return v.crossJoin(F.broadcast(one)).select("vec_id", F.round(dot("embedding", "q"), 6).alias("sim"))  # one row


def q_encode(s, d):
    v = encode(table(s, d, "documents"), "doc_id", "text")
    return v.select("doc_id", F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string")), ",").alias("vector"))


def q_truncated(s, d):
    return truncated(table(s, d, "documents"), "text", 256).select("truncated", "n", F.round("share", 6).alias("share"))


def q_events(s, d):
    return event_clusters(_vectors(s, d).select(F.col("vec_id").alias("doc_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("vec_id") % 30).cast("int")).alias("day"), "embedding"), least=0.3)


QUERIES = {"truncated_ratio": q_truncated, "retrieve_topk_union": q_retrieve, "similarity": q_similarity, "encode": q_encode, "event_clusters": q_events}
SQL = {
    "retrieve_topk_union": """WITH q AS (SELECT vec_id AS query_id, 0 AS c, embedding FROM embeddings WHERE vec_id % 100 = 0 UNION ALL SELECT vec_id - 1, 1, embedding FROM embeddings WHERE (vec_id - 1) % 100 = 0),
p AS (SELECT query_id, c, d.vec_id AS doc_id, round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 6) AS sim FROM q, embeddings d),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, c ORDER BY sim DESC, doc_id) AS r FROM p) SELECT query_id, doc_id, max(sim) AS sim FROM r WHERE r <= 10 OR sim >= 0.4 GROUP BY 1, 2""",
    "similarity": "SELECT vec_id, round(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q AS DOUBLE[])), 6) AS sim FROM embeddings e, (SELECT embedding AS q FROM embeddings WHERE vec_id = 0)",
    "encode": """WITH w AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS w FROM documents),
h AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 6) AS BIGINT) % 64 AS i, CASE WHEN substr(md5(w), 7, 1) IN ('0', '1', '2', '3', '4', '5', '6', '7') THEN 1 ELSE -1 END AS x FROM w),
g AS (SELECT doc_id, i, sum(x) AS x FROM h GROUP BY 1, 2), n AS (SELECT doc_id, sqrt(CAST(sum(x * x) AS DOUBLE)) AS n FROM g GROUP BY 1 HAVING sum(x * x) > 0),
e AS (SELECT n.doc_id, string_agg(CAST(CAST(round(CAST(CAST(coalesce(g.x, 0) / n.n AS FLOAT) AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR), ',' ORDER BY k.i) AS vector
  FROM n CROSS JOIN (SELECT unnest(range(64)) AS i) k LEFT JOIN g ON g.doc_id = n.doc_id AND g.i = k.i GROUP BY 1)
SELECT documents.doc_id, vector FROM documents LEFT JOIN e ON e.doc_id = documents.doc_id""",
    "truncated_ratio": """WITH w AS (SELECT len(list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda x: x <> '')) AS n FROM documents)
SELECT count(*) FILTER (WHERE n > 256) AS truncated, count(*) AS n, round(count(*) FILTER (WHERE n > 256) / greatest(count(*), 1), 6) AS share FROM w""",
}
