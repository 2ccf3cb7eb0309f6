"""Shingles, containment pairs and greedy near-duplicate removal."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import shingles
from millrace.plans.graph import connected_components
from millrace.plans.ship import ship
from millrace.plans.work import written
from millrace.sources import table

PERMUTATIONS = 128


def banding(threshold: float, permutations: int = PERMUTATIONS) -> tuple[int, int]:
    """Bands and rows with the least sum of false positive and false negative areas at a threshold."""

    def area(f, a: float, b: float, steps: int = 200) -> float:
        w = (b - a) / steps
        return sum(f(a + (i + 0.5) * w) for i in range(steps)) * w

    best = None
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            hit = lambda s, b=b, r=r: 1 - (1 - s**r) ** b
            cost = 0.5 * area(hit, 0, threshold) + 0.5 * area(lambda s: 1 - hit(s), threshold, 1)
            if best is None or cost < best[0]:
                best = (cost, b, r)
    return best[1], best[2]


def shingle_sets(docs: DataFrame, n: int, bands: int = 0, rows: int = 0) -> DataFrame:
    """``doc_id, h1, h2, s array<long>, bands array<long>`` of texts with at least one word.

    ``s`` are the distinct shingles as 64-bit hashes, sorted; ``h1, h2`` hash the set; ``bands`` are
    hashes of ``rows`` MinHash values each. One pass of numpy over Arrow batches, in blocks of about
    a million characters, so a very long text is a block of its own.
    """
    import numpy as np
    import pyarrow as pa

    ship(docs.sparkSession)

    def run(batches):
        from millrace.functions.ngrams import blocks, minhashes, mix, shingle_hashes

        for b in batches:
            ids = b.column(b.schema.get_field_index("doc_id"))
            for first, part in blocks(b.column(b.schema.get_field_index("text")).to_pylist()):
                h, off = shingle_hashes(part, n, ascii_words=True)
                some = np.flatnonzero(np.diff(off))
                if not len(some):
                    continue
                sets = [np.unique(h[off[i] : off[i + 1]]) for i in some.tolist()]
                flat = np.concatenate(sets)
                at = np.cumsum([0, *map(len, sets)])
                key = np.zeros((len(some), bands), np.uint64)
                if bands:
                    least = minhashes(flat, at, bands * rows, 3).astype(np.uint64)
                    for r in range(rows):
                        key = mix(key * np.uint64(0x100000001B3) + least[:, r::rows] + np.uint64(1))
                cols = [np.add.reduceat(flat, at[:-1]).view(np.int64), np.add.reduceat(flat * flat ^ flat >> np.uint64(29), at[:-1]).view(np.int64)]
                lists = [pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(v.view(np.int64))) for o, v in ((at, flat), (np.arange(len(some) + 1) * bands, np.ascontiguousarray(key).ravel()))]
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(part)).take(pa.array(some)), *map(pa.array, cols), *lists], ["doc_id", "h1", "h2", "s", "bands"])

    return docs.selectExpr("CAST(doc_id AS long) doc_id", "CAST(text AS string) text").where("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, h1 long, h2 long, s array<long>, bands array<long>")


def containment_pairs(docs: DataFrame, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """All pairs (i < j) whose shared shingles are at least ``threshold`` of the smaller set.

    Prefix filter: in any fixed order of shingles, the smaller set's first ``size - ceil(threshold *
    size) + 1`` must hold one that is in the other set. The order is rarest first, so what everybody
    shares is never joined on unless a set has nothing else. Only shingles in two sets or more
    matter. Equal sets are one node (``containment_nodes``) in all of this and are verified once a
    pair of nodes; their documents are expanded into pairs only here, as pairs are this result.

    Null ids, and texts without a word, are in no pair. Rows of one doc_id with equal sets are one
    document. An empty table gives no rows. Columns: i, j, containment (6 decimals).
    """
    pairs, members = containment_nodes(docs, threshold, n)
    each = members.select(F.col("node").alias("u"), F.col("doc_id").alias("a"))
    other = members.select(F.col("node").alias("v"), F.col("doc_id").alias("b"))
    far = pairs.join(each, "u").join(other, "v").select("a", "b", "containment")
    same = each.join(other, F.col("u") == F.col("v")).where("a < b").select("a", "b", F.lit(1.0).alias("containment"))
    return far.union(same).where("a <> b").select(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"), "containment").distinct()


def containment_nodes(docs: DataFrame, threshold: float = 0.8, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Containment between distinct sets: ``u, v, containment`` of nodes, and ``node, doc_id`` membership.

    The linear form of ``containment_pairs``: copies are not expanded. A node is the smallest doc_id
    of its set (a hash of the set where that id has several texts).
    """
    sets = written(shingle_sets(docs, n), "shingles")
    nodes = sets.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.min_by("s", "doc_id").alias("s"))
    shared = nodes.groupBy("least").count().where("count > 1").select("least", F.lit(True).alias("shared"))
    nodes = nodes.join(shared, "least", "left").withColumn("node", F.when(F.col("shared"), F.xxhash64("h1", "h2")).otherwise(F.col("least")))
    nodes = written(nodes.select("node", "h1", "h2", "s"), "nodes")
    members = sets.select("doc_id", "h1", "h2").distinct().join(nodes.select("node", "h1", "h2"), ["h1", "h2"]).select("node", "doc_id")
    one = nodes.select("node", F.size("s").alias("n"), F.explode("s").alias("h"))
    df = one.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    known = written(one.join(df, "h").select("node", "n", "h", "df"), "postings")
    # shingles of one set alone come first in the order and join with nothing
    ranked = known.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("o"))
    keep = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1 - (F.col("n") - F.size("o"))
    prefix = ranked.select(F.col("node").alias("a"), F.col("n").alias("na"), F.explode(F.slice("o", F.lit(1), F.greatest(keep, F.lit(0)))).alias("x")).select("a", "na", F.col("x.h").alias("h"))
    cand = prefix.join(known.select(F.col("node").alias("b"), F.col("n").alias("nb"), "h"), "h").where("a <> b AND na <= nb")
    cand = cand.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    both = cand.join(nodes.select(F.col("node").alias("u"), F.col("s").alias("su")), "u").join(nodes.select(F.col("node").alias("v"), F.col("s").alias("sv")), "v")
    share = F.size(F.array_intersect("su", "sv")) / F.least(F.size("su"), F.size("sv"))
    return both.select("u", "v", F.round(share, 6).alias("containment")).where(F.col("containment") >= threshold), members


def near_dedup(docs: DataFrame, threshold: float = 0.8, n: int = 5, permutations: int = PERMUTATIONS) -> DataFrame:
    """The documents that greedy removal keeps, with all their columns.

    Candidates share a band of MinHash values (bands for Jaccard ``max(0.5, threshold - 0.2)``).
    In order of id, each kept document is compared with its kept candidates: of a pair with
    containment at or above ``threshold`` the smaller set goes (of equal ones the later), and when
    the document itself goes its turn ends. Candidates come in this order: equal sets, then the
    others by the smallest id of their set's documents, documents with equal sets together. So the
    documents of one set share their fate but for the first, and a set is one node here, however
    many copies it has. Components of candidates are independent; the order is followed inside each
    one, by a task that holds the component's distinct sets.

    Rows with a null id, and texts without a word, are kept. Rows of one doc_id stay together, while
    one of its texts is kept. An empty table gives no rows.
    """
    bands, rows = banding(max(0.5, threshold - 0.2), permutations)
    sets = written(shingle_sets(docs, n, bands, rows), "sets")
    node = written(sets.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.min_by(F.struct("s", "bands"), "doc_id").alias("x")).select("doc_id", F.xxhash64("h1", "h2").alias("node"), "x.s", "x.bands"), "nodes")
    band = node.select("node", F.posexplode("bands").alias("b", "v"))
    first = band.groupBy("b", "v").agg(F.min("node").alias("head"), F.count("*").alias("size")).where("size > 1").drop("size")
    star = band.join(first, ["b", "v"]).where("node <> head").select(F.col("head").alias("u"), F.col("node").alias("v")).distinct()
    group = written(connected_components(star), "groups")
    member = node.join(group.select(F.col("component").alias("g"), "node"), "node")

    def greedy(pdf):
        pdf = pdf.sort_values(["doc_id", "node"])
        s, size = [set(x) for x in pdf.s], [len(x) for x in pdf.s]
        where: dict = {}
        for i, keys in enumerate(pdf.bands):
            for k in enumerate(keys):
                where.setdefault(k, []).append(i)
        gone = set()
        for i, keys in enumerate(pdf.bands):
            if i in gone:
                continue
            for j in sorted({j for k in enumerate(keys) for j in where[k]} - {i}):
                if j in gone or len(s[i] & s[j]) < threshold * min(size[i], size[j]) - 1e-9:
                    continue
                if size[i] >= size[j]:
                    gone.add(j)
                else:
                    gone.add(i)
                    break
        return pdf[["node"]].iloc[sorted(gone)]

    gone = member.groupBy("g").applyInPandas(greedy, "node long")
    kept = written(node.select("doc_id", "node").join(gone, "node", "left_anti").select("doc_id"), "kept")
    without = sets.select("doc_id").distinct().join(kept, "doc_id", "left_anti")
    return docs.join(without, docs["doc_id"] == without["doc_id"], "left_anti")


def benchmark_support(docs: DataFrame, items: DataFrame, threshold: float = 0.5, n: int = 5) -> DataFrame:
    """Share of each benchmark item's shingles that a document holds, where at least ``threshold``."""
    a = items.select("item_id", F.explode(shingles("text", n)).alias("h"), F.size(shingles("text", n)).alias("size"))
    b = docs.select("doc_id", F.explode(shingles("text", n)).alias("h"))
    hit = b.join(a, "h").groupBy("item_id", "doc_id", "size").agg(F.count("*").alias("shared"))
    return hit.where(F.col("shared") >= F.col("size") * threshold).select("item_id", "doc_id", F.round(F.col("shared") / F.col("size"), 6).alias("coverage"))


def _docs(s, d):
    return table(s, d, "documents").select("doc_id", "text")


def q_shingle_counts(s, d):
    return _docs(s, d).select("doc_id", F.size(shingles("text", 5)).cast("long").alias("n_shingles"))


def q_near_dedup(s, d):
    return near_dedup(_docs(s, d)).select("doc_id")


def _sh(t: str, key: str) -> str:
    return f"""(SELECT {key}, list_distinct(CASE WHEN len(w) < 5 THEN w ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM (SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM {t}))"""


QUERIES = {
    "shingle_counts": q_shingle_counts,
    "containment_pairs": lambda s, d: containment_pairs(_docs(s, d)),
    "near_dedup": q_near_dedup,
    "benchmark_support": lambda s, d: benchmark_support(_docs(s, d), table(s, d, "benchmark")),
}
SQL = {
    "shingle_counts": f"SELECT doc_id, len(s) AS n_shingles FROM {_sh('documents', 'doc_id')}",
    "containment_pairs": f"""WITH d AS (SELECT doc_id, s, len(s) AS n FROM {_sh('documents', 'doc_id')} WHERE len(s) > 0), p AS (SELECT doc_id, n, unnest(s) AS h FROM d)
SELECT a.doc_id AS i, b.doc_id AS j, round(count(*) / least(min(a.n), min(b.n)), 6) AS containment FROM p a JOIN p b ON a.h = b.h AND a.doc_id < b.doc_id
GROUP BY 1, 2 HAVING count(*) >= 0.8 * least(min(a.n), min(b.n)) - 1e-9""",
    "benchmark_support": f"""WITH a AS (SELECT item_id, len(s) AS size, unnest(s) AS h FROM {_sh('benchmark', 'item_id')}), b AS (SELECT doc_id, unnest(s) AS h FROM {_sh('documents', 'doc_id')})
SELECT item_id, doc_id, round(count(*) / size, 6) AS coverage FROM a JOIN b USING (h) GROUP BY item_id, doc_id, size HAVING count(*) >= size * 0.5""",
}
