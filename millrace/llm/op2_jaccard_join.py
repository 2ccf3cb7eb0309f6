"""N-gram Jaccard join along chosen paths."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.pairing import group_links
from millrace.functions.ngrams import blocks, minhashes, shingle_hashes
from millrace.llm.streams import forest, lists, runs
from millrace.plans.graph import connected_components
from millrace.plans.work import written
from millrace.sources import table

WIDTH, THRESHOLD = 5, 0.8
#: Least chance that a pair at the threshold is proposed; sampled tokens (minima) of a set.
RECALL, TOKENS = 0.9999, 48
#: Rows above which a bucket is split in Spark and below which it is compared without a further
#: split; splits of an oversized bucket; rows of a block of a bucket that splits do not divide; rows
#: of a block of an exact count.
SPLIT, LEAF, DEPTH, PAIRED, BLOCK = 1000, 48, 4, 2000, 192


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, h1, h2, tokens``: a hash of the whole multiset of shingles and its sampled tokens."""

    def sketch(batches):
        for b in batches:
            ids, texts = b.column(b.schema.get_field_index("doc_id")), b.column(b.schema.get_field_index("text")).to_pylist()
            for first, part in blocks(texts):
                h, off = shingle_hashes(part, width)
                one, two = _content(h, off)
                tokens = minhashes(h, off, TOKENS, 7)
                flat = pa.array(tokens.astype("<u4").view(np.int32).ravel())
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(part)), pa.array(one), pa.array(two), pa.array(np.diff(off) > 0), pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * TOKENS), flat)], ["doc_id", "h1", "h2", "some", "tokens"])

    return docs.select("doc_id", "text").mapInArrow(sketch, "doc_id long, h1 long, h2 long, some boolean, tokens array<int>")


def _content(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's multiset of shingles."""
    some = np.flatnonzero(np.diff(off))
    one, two = np.zeros(len(off) - 1, np.uint64), np.zeros(len(off) - 1, np.uint64)
    if len(some):
        one[some] = np.add.reduceat(h, off[:-1][some])
        two[some] = np.add.reduceat(h * h ^ h >> np.uint64(29), off[:-1][some])
    return one.view(np.int64), two.view(np.int64)


def runs_for(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has been proposed with a chance of ``recall``, in the deepest buckets.

    A run follows one sampled token at depth 1 and either of two at each of the further DEPTH - 1
    splits; a pair at the threshold shares a sampled token with that chance.
    """
    found = threshold * (1 - (1 - threshold) ** 2) ** (DEPTH - 1)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def least_agreement(threshold: float) -> int:
    """Equal tokens below which a pair of sets at the threshold falls once in about 10,000 times."""
    return int(TOKENS * threshold - 3.75 * (TOKENS * threshold * (1 - threshold)) ** 0.5)


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL) -> DataFrame:
    """Near-duplicate documents: ``docs(doc_id long, text string)`` -> one row per document.

    1. Texts with equal shingles are one class with a count. 48 minima stand for each class's set:
       two sets share each with the probability of their Jaccard similarity.
    2. A chosen-path join proposes pairs, in as many runs as ``recall`` needs (``runs_for``). In
       each, the classes are split on one sampled token; a bucket above ``SPLIT`` rows is split
       again in Spark on two further sampled tokens (a pair may follow either), up to ``DEPTH``
       times. A large bucket that keeps over half of its parent's rows is one of near copies, which
       no token divides: it is dealt into pairs of blocks, and so is what is still large at the end,
       so that no bucket is left out. Inside a task, buckets above ``LEAF`` rows split on while
       tokens divide them; leaves are compared by brute force on all 48 tokens. A task's pairs leave
       it as one spanning forest.
    3. Components of these pairs are compared exactly on their whole shingle sets; true links are
       counted for each document and their components are the classes. In a component above
       ``BLOCK`` classes, sets within half the threshold distance of a central one are linked with
       one another by the triangle inequality (one minus the similarity is a metric), and need no
       comparison; the rest are compared in pairs of blocks. So a group of near copies costs linear
       work when it is tight, and no pair is ever a row.

    Links are pairs with Jaccard similarity >= ``threshold``; precision is exact. Null and empty
    texts, and texts without any word, have no shingle: they link with nothing, whatever their
    number. A text below ``width`` words is one shingle. Repeated rows (same doc_id) are links of
    one another like any equal texts; rows of one doc_id with different texts are each judged by
    their own. A row with null doc_id is returned with zero links, a null class and kept false.
    Other columns are ignored. An empty table gives no rows.
    Columns: doc_id, class_id (smallest doc_id of the class), n_links, kept (doc_id = class_id).
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = d.where("doc_id IS NOT NULL")
    sk = written(sketches(known, width), "sketches")
    classes = written(sk.where("some").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.min_by("tokens", "doc_id").alias("tokens")), "classes")
    # a class is named by its smallest doc_id, and by its content where an id has several texts
    shared = classes.groupBy("rep").count().where("count > 1").select("rep", F.lit(True).alias("shared"))
    classes = classes.join(shared, "rep", "left").withColumn("node", F.when(F.col("shared"), F.xxhash64("h1", "h2")).otherwise(F.col("rep"))).drop("shared")
    pairs = chosen_pairs(classes.select(F.col("node").alias("rep"), "tokens"), least_agreement(threshold), runs_for(threshold, recall))
    likely = written(connected_components(pairs), "likely").select("node", F.col("component").alias("gid"))
    grouped = written(classes.join(likely, "node"), "grouped")

    def sets(batches):
        for b in batches:
            col = {c: b.column(b.schema.get_field_index(c)) for c in ("gid", "id", "weight", "h1", "h2")}
            for first, part in blocks(b.column(b.schema.get_field_index("text")).to_pylist()):
                h, off = shingle_hashes(part, width)
                one, two = _content(h, off)
                mine = {c: x.slice(first, len(part)) for c, x in col.items()}
                # another text of the same doc_id is not this class's
                good = np.flatnonzero((one == mine["h1"].to_numpy()) & (two == mine["h2"].to_numpy()))
                own = [np.unique(h[off[i] : off[i + 1]]) for i in good.tolist()]
                values = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, own)]).astype(np.int32)), pa.array(np.concatenate(own or [np.empty(0, np.uint64)]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(mine[c].take(pa.array(good)) for c in ("gid", "id", "weight")), values], ["gid", "id", "weight", "shingles"])

    one_text = d.join(grouped.select("gid", F.col("node").alias("id"), "weight", "rep", "h1", "h2"), F.col("doc_id") == F.col("rep"))
    members = one_text.select("gid", "id", "weight", "h1", "h2", "text").mapInArrow(sets, "gid long, id long, weight long, shingles array<long>")
    # only a doc_id of several rows gives a class twice; all others need no further shuffle of sets
    again = written(sk.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("id")), "repeated-ids")
    if not again.isEmpty():
        members = written(members, "all-members")
        many = classes.join(again, F.col("rep") == F.col("id"), "left_semi").select(F.col("node").alias("id"))
        members = members.join(many, "id", "left_anti").unionByName(members.join(many, "id", "left_semi").dropDuplicates(["id"]))
    members = written(members, "members")
    members = with_cores(members, grouped, (1 + threshold) / 2)
    links = written(group_links(members, lambda t, a, b: jaccard_at_least(t, a, b, threshold), "shingles", BLOCK), "links")
    found = written(connected_components(links.select(F.col("root").alias("u"), F.col("id").alias("v"))), "found")
    counted = links.groupBy("id").agg(F.sum("n").alias("others"))
    out = classes.select("h1", "h2", "node", "rep", "weight").join(found, "node").join(counted, F.col("node") == F.col("id"), "left")
    least = out.groupBy("component").agg(F.min("rep").alias("class_id"))
    out = out.join(least, "component").select("h1", "h2", "class_id", F.coalesce("others", F.lit(0)).alias("others"))
    every = classes.select("h1", "h2", "rep", "weight").join(out, ["h1", "h2"], "left")
    every = every.select("h1", "h2", F.coalesce("class_id", "rep").alias("class_id"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    good = sk.where("some").select("doc_id", "h1", "h2").join(every, ["h1", "h2"]).select("doc_id", "class_id", "n_links")
    alone = sk.where("NOT some").select("doc_id").union(d.where("doc_id IS NULL").select("doc_id"))
    alone = alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return good.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))


def with_cores(members: DataFrame, grouped: DataFrame, near: float) -> DataFrame:
    """``members`` with ``core``: whether a set has similarity ``near`` or more with its group's central one.

    Only groups above ``BLOCK`` rows have a centre: the member with the most tokens that are the
    commonest of the group at their place. Tokens are counted by aggregation, a centre is one row.
    """
    big = written(grouped.groupBy("gid").count().where(F.col("count") > BLOCK).select("gid"), "big-groups")
    if big.isEmpty():  # no group has a centre
        return members.select("gid", "id", "weight", F.lit(False).alias("core"), "shingles")
    tokens = grouped.join(big, "gid", "left_semi").select("gid", "node", F.posexplode("tokens").alias("place", "token"))
    common = tokens.groupBy("gid", "place", "token").count().groupBy("gid", "place").agg(F.max_by("token", F.struct("count", "token")).alias("token"))
    agree = tokens.join(common, ["gid", "place", "token"]).groupBy("gid", "node").count()
    centre = agree.groupBy("gid").agg(F.max_by("node", F.struct("count", -F.col("node"))).alias("node"))
    middle = members.join(centre, (members["gid"] == centre["gid"]) & (members["id"] == centre["node"])).select(members["gid"], F.col("shingles").alias("middle"))

    def cores(batches):
        for b in batches:
            col = {c: b.column(b.schema.get_field_index(c)) for c in ("gid", "id", "weight", "shingles")}
            middles = b.column(b.schema.get_field_index("middle"))
            core = np.zeros(b.num_rows, bool)
            for i in np.flatnonzero(middles.is_valid().to_numpy(zero_copy_only=False)).tolist():
                x, y = col["shingles"][i].values.to_numpy(), middles[i].values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                core[i] = common >= near * (len(x) + len(y) - common) + 1e-9
            yield pa.RecordBatch.from_arrays([col["gid"], col["id"], col["weight"], pa.array(core), col["shingles"]], ["gid", "id", "weight", "core", "shingles"])

    return written(members.join(middle, "gid", "left").mapInArrow(cores, "gid long, id long, weight long, core boolean, shingles array<long>"), "marked")


def chosen_pairs(sets: DataFrame, agree: int, n_runs: int) -> DataFrame:
    """``sets(rep long, tokens array<int>)`` -> ``u, v`` pairs with at least ``agree`` equal tokens, as forests of leaves."""
    token = lambda c: F.element_at("tokens", F.pmod(c, F.lit(TOKENS)).cast("int") + 1)
    level = sets.select(F.explode(F.sequence(F.lit(0), F.lit(n_runs - 1))).alias("run"), "rep", "tokens")
    level = level.select(F.xxhash64("run", token(F.col("run") * 5)).alias("node"), "run", "rep", "tokens")
    level = level.withColumn("parent", F.lit(None).cast("long"))
    ready = []

    def dealt(rows: DataFrame) -> DataFrame:
        """Rows of large buckets, once for every pair of blocks that theirs is in."""
        n = F.ceil(F.col("count") / F.lit(float(PAIRED))).cast("int")
        rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), n).cast("int"))
        rows = rows.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("other"))
        return rows.select("node", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "rep", "tokens")

    for depth in range(1, DEPTH + 1):
        hot = written(level.groupBy("node").agg(F.count("*").alias("count"), F.min("parent").alias("of")).where(F.col("count") > SPLIT), "hot")
        small = level if hot.isEmpty() else level.join(hot.select("node"), "node", "left_anti")
        ready.append(small.select("node", F.lit(0).alias("a"), F.lit(0).alias("b"), "rep", "tokens"))
        if hot.isEmpty():
            break
        last = F.lit(depth == DEPTH) | F.coalesce(F.col("count") > F.col("of") / 2, F.lit(False))
        large = level.drop("parent").join(hot.withColumn("last", last), "node")
        ready.append(dealt(large.where("last")))
        if depth < DEPTH:
            # two sampled tokens, chosen by the node itself, so that all its rows take the same ones
            pick = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(TOKENS))
            both = F.array(*[F.xxhash64("node", F.lit(k), token(pick(k))) for k in range(2)])
            level = large.where("NOT last").select(F.explode(both).alias("node"), "run", "rep", "tokens", F.col("count").alias("parent"))
            level = written(level, "level")
    rows = ready[0]
    for x in ready[1:]:
        rows = rows.union(x)

    def leaves(batches):
        for t in runs(batches, ["node", "a", "b"]):
            if t.num_rows < 2:
                continue
            reps = t.column("rep").to_numpy()
            tokens = lists(t.column("tokens"))[0].reshape(-1, TOKENS)
            rng = np.random.default_rng(int(t.column("node")[0].as_py()) & 0xFFFFFFFF)
            left, right = _paths(tokens, agree, rng)
            if len(left):
                yield pa.RecordBatch.from_arrays([pa.array(reps[left]), pa.array(reps[right])], ["u", "v"])

    return rows.repartition("node", "a", "b").sortWithinPartitions("node", "a", "b").mapInArrow(leaves, "u long, v long")


def _paths(tokens: np.ndarray, agree: int, rng: np.random.Generator) -> tuple[list[int], list[int]]:
    """Split on sampled tokens down to leaves; a spanning forest of all leaves' likely pairs."""
    left: list[int] = []
    right: list[int] = []
    todo = [(np.arange(len(tokens)), 0)]
    while todo:
        rows, depth = todo.pop()
        parts = []
        if len(rows) > LEAF and depth < DEPTH:
            for c in rng.choice(tokens.shape[1], 2, replace=False):
                order = rows[np.argsort(tokens[rows, c], kind="stable")]
                v = tokens[order, c]
                cuts = [0, *(np.flatnonzero(v[1:] != v[:-1]) + 1).tolist(), len(v)]
                parts += [(order[s:e], depth + 1) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e - s > 1]
        if (len(rows) <= LEAF or depth >= DEPTH or max((len(p[0]) for p in parts), default=0) > len(rows) / 2):
            for s in range(0, len(rows), 256):  # all pairs, a strip at a time
                part = tokens[rows[s : s + 256]]
                same = np.zeros((len(part), len(rows) - s), np.uint8)
                for c in range(tokens.shape[1]):
                    same += part[:, c][:, None] == tokens[rows[s:], c][None, :]
                i, j = np.nonzero(same >= agree)
                up = i < j
                i, j = i[up] + s, j[up] + s
                if len(i):
                    root = np.array(forest(len(rows), i.tolist(), j.tolist()))
                    moved = np.flatnonzero(root != np.arange(len(rows)))
                    left += rows[root[moved]].tolist()
                    right += rows[moved].tolist()
        else:
            todo += parts
    root = np.array(forest(len(tokens), left, right))
    moved = np.flatnonzero(root != np.arange(len(tokens)))
    return root[moved], moved


def jaccard_at_least(t: pa.Table, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` have shingle sets of at least this Jaccard similarity."""
    flat, off = lists(t.column("shingles"))
    size = np.diff(off)
    common = np.zeros((len(a), len(b)), np.float32)
    row = np.repeat(np.arange(len(size)), size)
    words, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    at, keep = at.reshape(-1), n > 1
    number = np.cumsum(keep) - 1
    use = keep[at]
    row, at = row[use], number[at[use]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    place_a, place_b = np.full(len(size), -1), np.full(len(size), -1)
    place_a[a], place_b[b] = np.arange(len(a)), np.arange(len(b))
    step = max(64, (1 << 21) // max(len(a), len(b)))
    for s in range(0, int(keep.sum()), step):
        i, j = np.searchsorted(at, [s, s + step])
        r, c = row[i:j], at[i:j] - s
        x, y = np.zeros((len(a), step), np.float32), np.zeros((len(b), step), np.float32)
        in_a, in_b = place_a[r] >= 0, place_b[r] >= 0
        x[place_a[r[in_a]], c[in_a]] = 1
        y[place_b[r[in_b]], c[in_b]] = 1
        common += x @ y.T
    union = size[a][:, None] + size[b][None, :] - common
    return common >= threshold * union - 1e-9


def op2_jaccard_join(spark, folder: str) -> DataFrame:
    return jaccard_classes(table(spark, folder, "documents"))
