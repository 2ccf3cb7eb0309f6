"""Embedding near-duplicates by sorted projection passes, with a recall that is set beforehand."""

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.pairing import group_links
from millrace.llm.streams import forest, lists, runs
from millrace.plans.graph import connected_components, thinned
from millrace.plans.work import written
from millrace.sources import table

#: Least chance that two vectors at exactly the threshold are compared; most hashes of a key; hashes
#: after the key that order the rows of a run further.
RECALL, HASHES, FURTHER = 0.99, 6, 2
#: Rows that a row is compared with along the order; rows of a block of a run that is longer than that.
WINDOW, FACING = 16, 2048
#: Rows of a block of an exact count.
BLOCK = 256


def usable(vector: str = "embedding"):
    """Non-null vectors of finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    m = flat.reshape(-1, dim).astype(np.float64)
    m /= np.abs(m).max(1, keepdims=True)  # the length of very large or small components stays finite
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def by_length(column) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, unit vectors) for each vector length in a list column."""
    flat, offsets = lists(column)
    size = np.diff(offsets)
    out = []
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        at = (offsets[:-1][rows, None] + np.arange(d)).ravel()
        out.append((d, rows, _unit(flat[at], d)))
    return out


def hash_codes(unit: np.ndarray, seed: int) -> np.ndarray:
    """A random hash: the signed axis nearest to each vector after a random rotation."""
    d = unit.shape[1]
    turned = unit @ _rotation(d, seed)
    axis = np.abs(turned).argmax(1)
    return axis * 2 + (turned[np.arange(len(unit)), axis] < 0)


_turns: dict[tuple[int, int], np.ndarray] = {}


def _rotation(d: int, seed: int) -> np.ndarray:
    if (d, seed) not in _turns:
        if sum(m.nbytes for m in _turns.values()) > 1 << 28:
            _turns.clear()
        _turns[d, seed] = np.linalg.qr(np.random.default_rng([seed, d]).standard_normal((d, d)))[0]
    return _turns[d, seed]


def agreement(threshold: float, d: int, seed: int) -> float:
    """The chance, less two standard errors, that vectors at exactly ``threshold`` share a hash.

    It depends on their angle alone, whatever the other vectors are, as rotations are uniform.
    """
    if d == 1:
        return 1.0
    draws = max(1000, min(20_000, 4_000_000 // d))
    rng = np.random.default_rng([seed, d, 1])
    x, y = (rng.standard_normal((draws, d)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= np.einsum("ij,ij->i", x, y)[:, None] * x
    y = threshold * x + (1 - threshold**2) ** 0.5 * y / np.linalg.norm(y, axis=1)[:, None]
    p = float((hash_codes(x, seed) == hash_codes(y, seed)).mean())
    return max(p - 2 * (p * (1 - p) / draws) ** 0.5, 1e-3)


def key_plan(n: int, sample: np.ndarray, threshold: float, recall: float, seed: int) -> tuple[int, int]:
    """(hashes of a key, passes) of the least estimated work that meets ``recall``.

    A pair at the threshold shares a key of h hashes in a pass with chance p ** h, so passes follow
    from ``recall``. How many pairs share one by chance, hot keys included, is measured on a sample.
    """
    d = sample.shape[1]
    draws = 24
    agree = np.zeros((len(sample), len(sample)), np.int64)
    for r in range(draws):
        code = hash_codes(sample, seed + 1_000_000 + r)
        agree += code[:, None] == code
    times = np.bincount(agree[np.triu_indices(len(sample), 1)], minlength=draws + 1)
    p = agreement(threshold, d, seed)
    best = (math.inf, 1, 1)
    for h in range(1, HASHES + 1):
        shared = sum(float(c) * math.comb(a, h) for a, c in enumerate(times)) / max(times.sum(), 1) / math.comb(draws, h)
        passes = 1 if p**h >= recall else math.ceil(math.log(1 - recall) / math.log(1 - p**h))
        # seconds: a row in a pass and in each block it faces, its rotations, and a comparison
        row = 1e-5 * (1 + n * shared / FACING) + 2e-10 * d * d * h
        best = min(best, (passes * (n * row + n * n / 2 * shared * (2e-9 + 1.5e-10 * d)), h, passes))
    return best[1:]


def embedding_links(vectors: DataFrame, threshold: float = 0.9, recall: float = RECALL, seed: int = 17) -> DataFrame:
    """Near-duplicate vectors: ``vectors(vec_id long, embedding array)`` -> one row per vector.

    1. Equal vectors become one class with a count, so copies cost nothing further.
    2. In each pass the classes are ordered lexicographically by concatenated random hashes, drawn
       anew, and each is compared with the ``WINDOW`` rows after it, by cosine in double precision.
       The first hashes are the key: rows with one key are a run. A run that is longer than the
       window is compared whole, in pairs of blocks, so no run is cut. How many hashes make the key
       and how many passes there are follows from the number of classes of a vector length and the
       share of pairs that hot keys hold (``key_plan``).
    3. Connected components over all passes.
    4. Every vector's links are then counted exactly within its component. In a component above
       ``BLOCK`` rows, rows within half the threshold angle of the mean direction are linked with
       one another by the triangle inequality and need no comparison; the rest are compared in
       blocks. A group holding a third of the rows thus costs linear work when it is tight.

    Any two vectors at exactly ``threshold`` are compared with a chance of at least ``recall``, and
    nearer ones with a higher one, whatever the size of the table and the vectors around them.
    Linked vectors also meet through others. Precision is exact.

    Null, zero, empty, and non-finite vectors link with nothing and are their own component, and so
    do vectors of different lengths. Repeated ``vec_id`` rows stay repeated rows. A null ``vec_id``
    yields a row with zero links, a null component and kept false. Other columns are ignored. An
    empty table gives no rows. Columns: vec_id, n_links, component_id, kept.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    ok = v.where(usable() & F.col("vec_id").isNotNull())
    classes = written(ok.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight")), "classes")
    # a class is named by its smallest vec_id, and by its content where an id has several vectors
    shared = classes.groupBy("least").count().where("count > 1").select("least", F.lit(True).alias("shared"))
    classes = classes.join(shared, "least", "left").withColumn("rep", F.when(F.col("shared"), F.xxhash64("embedding")).otherwise(F.col("least"))).drop("shared")
    kind = classes.schema["embedding"].dataType.simpleString()
    rad = np.arccos(threshold)
    plan: dict[int, tuple[int, int]] = {}
    for d, n in classes.groupBy(F.size("embedding")).count().collect():
        some = classes.where(F.size("embedding") == d).orderBy(F.xxhash64("rep"), "rep").limit(1000).select("embedding").toArrow()
        plan[d] = key_plan(n, by_length(some.column(0))[0][2], threshold, recall, seed)

    def keys(batches):
        for b in batches:
            rep, emb = b.column(b.schema.get_field_index("rep")), b.column(b.schema.get_field_index("embedding"))
            for d, rows, unit in by_length(emb):
                hashes, passes = plan[d]
                own = rep.take(pa.array(rows))
                for p in range(passes):
                    code = [hash_codes(unit, seed + p * (HASHES + FURTHER) + h) for h in range(hashes + FURTHER)]
                    key, order = (functools.reduce(lambda k, c: k * (2 * d) % (1 << 50) + c, part, np.zeros(len(rows), np.int64)) for part in (code[:hashes], code[hashes:]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), p, np.int32)), pa.array(np.full(len(rows), d, np.int32)), pa.array(key), pa.array(order), own], ["pass", "dim", "key", "order", "rep"])

    place = ["pass", "dim", "key"]
    coded = written(classes.select("rep", "embedding").mapInArrow(keys, "pass int, dim int, key long, order long, rep long").withColumn("gid", F.xxhash64(*place)), "codes")
    sizes = written(coded.groupBy("gid").count().where("count > 1"), "run-sizes")
    bodies = classes.select("rep", "embedding")

    def alongside(batches):
        """Links of each row with those after it in a sorted partition, as a forest."""
        tail: dict = {}
        left: list[int] = []
        right: list[int] = []
        for b in batches:
            ids = b.column(b.schema.get_field_index("rep")).to_numpy()
            for d, rows, unit in by_length(b.column(b.schema.get_field_index("embedding"))):
                own = ids[rows]
                new = 0  # pairs of held rows have been compared
                if d in tail:
                    new = len(tail[d][0])
                    own, unit = np.concatenate([tail[d][0], own]), np.concatenate([tail[d][1], unit])
                for w in range(1, min(WINDOW, len(own))):
                    s = max(0, new - w)
                    i = np.flatnonzero(np.einsum("ij,ij->i", unit[s:-w], unit[s + w :]) >= threshold) + s
                    left += own[i].tolist()
                    right += own[i + w].tolist()
                tail[d] = own[-WINDOW:], unit[-WINDOW:]
            if len(left) > 500_000:
                left, right = _spanned(left, right)
        yield from _edges(*_spanned(left, right))

    def facing(batches):
        """Links between two blocks of a run, as a forest."""
        for t in runs(batches, ["gid", "a", "b"]):
            ids, own = t.column("rep").to_numpy(), t.column("own").to_numpy()
            a, b = t.column("a")[0].as_py(), t.column("b")[0].as_py()
            for _, rows, unit in by_length(t.column("embedding")):
                i, j = np.flatnonzero(own[rows] == a), np.flatnonzero(own[rows] == b)
                if not len(i) or not len(j):
                    continue
                hit = unit[i] @ unit[j].T >= threshold
                if a == b:
                    hit = np.triu(hit, 1)
                x, y = thinned(hit)
                yield from _edges(*_spanned(ids[rows][i[x]].tolist(), ids[rows][j[y]].tolist()))

    # a run within the window is on one partition, as its rows have one key; so the range needs no more than keys
    low = coded.join(sizes.where(F.col("count") > WINDOW).select("gid"), "gid", "left_anti").join(bodies, "rep")
    low = low.select(*place, "order", "rep", "embedding").repartitionByRange(*place).sortWithinPartitions(*place, "order", "rep")
    edges = low.select("rep", "embedding").mapInArrow(alongside, "u long, v long")
    high = coded.join(sizes.where(F.col("count") > WINDOW).select("gid", F.ceil(F.col("count") / FACING).cast("int").alias("blocks")), "gid")
    high = high.withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int")).select("gid", "rep", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    high = high.select("gid", F.greatest("own", "other").alias("a"), F.least("own", "other").alias("b"), "own", "rep").join(bodies, "rep")
    high = high.select("gid", "a", "b", "own", "rep", "embedding").repartition("gid", "a", "b").sortWithinPartitions("gid", "a", "b")
    edges = edges.union(high.mapInArrow(facing, "u long, v long"))
    found = written(connected_components(edges), "components")

    members = written(classes.join(found, F.col("rep") == F.col("node")).select(F.col("component").alias("gid"), F.col("rep").alias("id"), "weight", "embedding"), "members")
    big = members.groupBy("gid").count().where(F.col("count") > BLOCK).select("gid")

    def sums(batches):
        for b in batches:
            gid = b.column(b.schema.get_field_index("gid")).to_numpy()
            for d, rows, unit in by_length(b.column(b.schema.get_field_index("embedding"))):
                some, at = np.unique(gid[rows], return_inverse=True)
                total = np.zeros((len(some), d))
                np.add.at(total, at, unit)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, d)), pa.array(np.tile(np.arange(d, dtype=np.int32), len(some))), pa.array(total.ravel())], ["gid", "at", "x"])

    large = members.join(big, "gid", "left_semi")
    mean = large.select("gid", "embedding").mapInArrow(sums, "gid long, at int, x double").groupBy("gid", "at").agg(F.sum("x").alias("x"))
    mean = mean.groupBy("gid").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("mean"))

    def cores(batches):
        """Rows within half the angle of their group's mean, less a margin for rounding."""
        for b in batches:
            col = {c: b.column(b.schema.get_field_index(c)) for c in ("gid", "id", "weight", "embedding", "mean")}
            core = np.zeros(b.num_rows, bool)
            some = np.flatnonzero(col["mean"].is_valid().to_numpy(zero_copy_only=False))
            x, y = (col[c].take(pa.array(some)) for c in ("embedding", "mean"))
            for (_, rows, unit), (_, _, mean) in zip(by_length(x), by_length(y), strict=True):
                core[some[rows]] = np.einsum("ij,ij->i", unit, mean) > np.cos(rad / 2 - 1e-6)
            yield pa.RecordBatch.from_arrays([col["gid"], col["id"], col["weight"], pa.array(core), col["embedding"]], ["gid", "id", "weight", "core", "embedding"])

    marked = written(members.join(mean, "gid", "left").mapInArrow(cores, f"gid long, id long, weight long, core boolean, embedding {kind}"), "marked")

    def linked(t, a, b):
        (d, _, unit), *_ = by_length(t.column("embedding"))
        return unit[a] @ unit[b].T >= threshold

    counted = group_links(marked, linked, "embedding", BLOCK).groupBy("id").agg(F.sum("n").alias("others"))
    named = found.join(classes.select("least", "rep"), F.col("rep") == F.col("node"))
    named = found.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("node", "component_id")
    labels = classes.join(named, F.col("rep") == F.col("node"), "left").join(counted, F.col("rep") == F.col("id"), "left")
    labels = labels.select("embedding", F.coalesce("component_id", "least").alias("component_id"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    good = ok.join(labels, "embedding").select("vec_id", "n_links", "component_id")
    bad = v.where(~usable() | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _edges(left: list[int], right: list[int]):
    for s in range(0, len(left), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(left[s : s + 100_000], pa.int64()), pa.array(right[s : s + 100_000], pa.int64())], ["u", "v"])


def _spanned(left: list[int], right: list[int]) -> tuple[list[int], list[int]]:
    if not left:
        return [], []
    ids, at = np.unique(np.array([left, right]), return_inverse=True)
    at = at.reshape(2, -1)
    root = np.array(forest(len(ids), at[0].tolist(), at[1].tolist()))
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids[root[moved]].tolist(), ids[moved].tolist()


def op1_embedding_dedup(spark, folder: str) -> DataFrame:
    return embedding_links(table(spark, folder, "embeddings"))
