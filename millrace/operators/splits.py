"""Exact splits, stratified halves, corpus slices, balanced and best-of samples."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.cleaning import dense_id
from millrace.plans.names import fresh, quoted
from millrace.plans.work import written
from millrace.sources import table


def seeded(*cols, seed: int):
    """A key that shuffles rows: md5 of the seed and the columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def split_assign(df: DataFrame, key: str, seed: int = 42, train: float = 0.9, val: float = 0.05) -> DataFrame:
    """``split``: the first int(n * train) rows in seeded order are train, the next int(n * val) val, the rest test.

    Counts are exact, and the same on any partitioning while keys are distinct; repeated rows are
    rows of their own, and a null key is a key. A column called split is replaced. An empty table
    gives no rows.
    """
    df = df.drop("split")
    k, rank, n = fresh(df, "k", "rank", "n")
    ranked = dense_id(df.withColumn(k, seeded(key, seed=seed)), [k, key], rank)
    size = df.agg(F.count("*").alias(n))
    a, b = F.floor(F.col(n) * train + 1e-9), F.floor(F.col(n) * val + 1e-9)
    out = ranked.crossJoin(F.broadcast(size))  # one row
    return out.select(*quoted(*df.columns), F.when(F.col(rank) < a, "train").when(F.col(rank) < a + b, "val").otherwise("test").alias("split"))


def stratified_halves(df: DataFrame, group: str, key: str, seed: int = 42) -> DataFrame:
    """``half``: in seeded order within its group, the first floor(n / 2) rows are val, the others test.

    All rows are numbered by group and seeded key over range partitions; a group's first number and
    size are one row, so the largest group is spread like any other. A null group is a group.
    """
    seed_, rank, lo, n, half = fresh(df, "seed", "rank", "lo", "n", "half")
    ranked = dense_id(df.withColumn(seed_, seeded(key, seed=seed)), [group, seed_, key], rank)
    sizes = ranked.groupBy(F.col(group).alias(half)).agg(F.min(rank).alias(lo), F.count("*").alias(n))
    out = ranked.join(sizes, F.col(group).eqNullSafe(F.col(half)))
    return out.select(*quoted(*df.columns), F.when(F.col(rank) - F.col(lo) < F.floor(F.col(n) / 2), "val").otherwise("test").alias("half"))


def shuffled(df: DataFrame, key: str, name: str, seed: int = 42) -> DataFrame:
    """Adds a place from 0 in an order that follows from the seed and the key, on any partitioning."""
    (k,) = fresh(df, "k")
    return dense_id(df.withColumn(k, seeded(key, seed=seed)), [k, key], name).drop(k)


def slices(corpus: DataFrame, needed: DataFrame, clustered: DataFrame, key: str) -> DataFrame:
    """``slice_small, slice_medium, slice_large`` flags: needed; needed or clustered; all."""
    a = needed.select(key).distinct().withColumn("_s", F.lit(True))
    b = clustered.select(key).distinct().withColumn("_c", F.lit(True))
    out = corpus.join(a, key, "left").join(b, key, "left")
    small, both = F.coalesce("_s", F.lit(False)), F.coalesce("_s", "_c", F.lit(False))
    return out.select(*corpus.columns, small.alias("slice_small"), both.alias("slice_medium"), F.lit(True).alias("slice_large"))


def missing(needed: DataFrame, corpus: DataFrame, key: str) -> DataFrame:
    """Needed keys that the corpus does not hold."""
    return needed.select(key).distinct().join(corpus.select(key), key, "left_anti")


def best_per_entity(df: DataFrame, entity: str, score: str, order: str) -> DataFrame:
    """The row of the highest score of each entity, the first by ``order`` among ties: a partial aggregate, not a sort."""
    best = df.where(F.col(score).isNotNull()).groupBy(entity).agg(F.max(F.struct(F.col(score), (-F.col(order)).alias("o"))).alias("b"))
    return best.select(entity, (-F.col("b.o")).alias(order), F.col(f"b.{score}").alias(score))


def best_covered(articles: DataFrame, entities: DataFrame) -> DataFrame:
    """One article of each entity: the one whose first tag covers most of the entity's features, the first among ties.

    ``articles(article_idx, tag array<struct<idx, info array<string>>>)``, ``entities(idx, features
    array<string>)`` -> ``idx, article_idx, score``. Articles without a tag and entities without an
    article are left out. A partial aggregate keeps one row a task and entity.
    """
    a = articles.where(F.size("tag") > 0).select("article_idx", F.col("tag")[0]["idx"].alias("idx"), F.col("tag")[0]["info"].alias("info"))
    j = a.join(entities.select("idx", "features"), "idx")
    score = F.size(F.array_intersect(F.coalesce("info", F.array().cast("array<string>")), "features"))
    best = j.groupBy("idx").agg(F.max(F.struct(score.alias("score"), (-F.col("article_idx")).alias("o"))).alias("b"))
    return best.select("idx", (-F.col("b.o")).alias("article_idx"), F.col("b.score").cast("long").alias("score"))


def last_wins(df: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The value of the last row of each key."""
    return df.groupBy(*key).agg(F.max_by(value, order).alias(value))


def balanced_sample(pairs: DataFrame, target: int, rounds: int = 10, seed: int = 42) -> DataFrame:
    """``pairs(id, pair)`` -> ``id, round``: ids drawn without replacement, favouring pairs seen little so far.

    In each round an id scores the sum of 1 / (1 + draws of the pair so far) over its pairs, and
    ``max(1, target // rounds)`` ids are drawn with probability in proportion: the smallest
    ``-ln(u) / score`` win, u following from the seed, the round and the id. So the draw does not
    depend on partitioning. Each round is written; draws are a top-k and never sort all rows.
    """
    spark = pairs.sparkSession
    pairs = written(pairs.where("id IS NOT NULL AND pair IS NOT NULL").distinct(), "pairs")
    drawn = spark.createDataFrame([], "id long, round int")
    chunk = max(1, target // rounds)
    for k in range(rounds):
        counts = pairs.join(drawn, "id").groupBy("pair").agg(F.count("*").alias("n"))
        left = pairs.join(drawn, "id", "left_anti").join(counts, "pair", "left")
        score = left.groupBy("id").agg(F.sum(1 / (1 + F.coalesce("n", F.lit(0)))).alias("score"))
        u = (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col("id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        new = score.orderBy(-F.log(u) / F.col("score"), "id").limit(chunk).select("id", F.lit(k).alias("round"))
        drawn = written(drawn.union(new), "drawn")
    return drawn


def public_sensitive(lines: DataFrame, line: str, stage: str, n: int, seed: int = 123) -> DataFrame:
    """``part``: of each stage class the first ``n`` lines in seeded order are sensitive, the others public."""
    r = F.row_number().over(W.partitionBy(stage).orderBy(seeded(line, seed=seed), line))
    chosen = lines.select(line, stage).distinct().withColumn("_r", r).where(F.col("_r") <= n).select(line, F.lit("sensitive").alias("part"))
    return lines.join(chosen, line, "left").withColumn("part", F.coalesce("part", F.lit("public")))


def q_slices(s, d):
    docs = table(s, d, "documents").select("doc_id", "lang")
    labels = table(s, d, "labels")
    return slices(docs, labels.where("quality = 1"), labels, "doc_id")


def q_balanced(s, d):
    docs = table(s, d, "documents")
    pairs = docs.select(F.col("doc_id").alias("id"), F.explode(F.array("lang", "source")).alias("pair"))
    return balanced_sample(pairs, 100)


def _covered(s, d):
    """Every order is an article of its customer; the flags of its lines are what it covers."""
    info = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("article_idx")).agg(F.collect_set("l_returnflag").alias("f"), F.collect_set("l_linestatus").alias("g"))
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("article_idx"), F.col("o_custkey").alias("idx"))
    a = o.join(info, "article_idx", "left").select("article_idx", F.array(F.struct("idx", F.concat("f", "g").alias("info")), F.struct(F.lit(0).cast("long").alias("idx"), F.array(F.lit("A")).alias("info"))).alias("tag"))
    e = table(s, d, "customer").select(F.col("c_custkey").alias("idx"), F.when(F.col("c_custkey") % 2 == 0, F.array(*map(F.lit, "ANF"))).otherwise(F.array(*map(F.lit, "RO"))).alias("features"))
    return best_covered(a, e)


QUERIES = {
    "best_covered": _covered,
    "shuffled": lambda s, d: shuffled(table(s, d, "documents").select("doc_id"), "doc_id", "place", 7),
    "split_assign": lambda s, d: split_assign(table(s, d, "documents").select("doc_id"), "doc_id"),
    "split_counts": lambda s, d: split_assign(table(s, d, "documents").select("doc_id"), "doc_id").groupBy("split").agg(F.count("*").alias("n")),
    "stratified_halves": lambda s, d: stratified_halves(table(s, d, "documents").select("doc_id", "source"), "source", "doc_id"),
    "slices_small_medium_large": q_slices,
    "slice_missing": lambda s, d: missing(table(s, d, "documents").select("doc_id"), table(s, d, "labels").select("doc_id"), "doc_id"),
    "best_per_entity": lambda s, d: best_per_entity(table(s, d, "events"), "user_id", "value", "event_id"),
    "last_wins": lambda s, d: last_wins(table(s, d, "events"), ["user_id", "event_type"], "value", "event_id"),
    "resume_antijoin": lambda s, d: table(s, d, "orders").join(table(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey"),
    "public_sensitive_split": lambda s, d: public_sensitive(table(s, d, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey", "s_nationkey", 2),
    "balanced_sample": q_balanced,
}
SQL = {
    "best_covered": """WITH i AS (SELECT l_orderkey, list(DISTINCT l_returnflag) AS f, list(DISTINCT l_linestatus) AS g FROM lineitem GROUP BY 1),
a AS (SELECT o_orderkey, o_custkey, len(list_filter(list_concat(coalesce(f, []), coalesce(g, [])), lambda x: list_contains(CASE WHEN o_custkey % 2 = 0 THEN ['A', 'N', 'F'] ELSE ['R', 'O'] END, x))) AS score FROM orders LEFT JOIN i ON l_orderkey = o_orderkey WHERE o_custkey IN (SELECT c_custkey FROM customer))
SELECT o_custkey AS idx, o_orderkey AS article_idx, score FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, o_orderkey) AS r FROM a) WHERE r = 1""",
    "shuffled": "SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) - 1 AS place FROM documents",
    "split_assign": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN r < floor(n * 0.9 + 1e-9) THEN 'train' WHEN r < floor(n * 0.9 + 1e-9) + floor(n * 0.05 + 1e-9) THEN 'val' ELSE 'test' END AS split FROM r""",
    "split_counts": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)
SELECT CASE WHEN r < floor(n * 0.9 + 1e-9) THEN 'train' WHEN r < floor(n * 0.9 + 1e-9) + floor(n * 0.05 + 1e-9) THEN 'val' ELSE 'test' END AS split, count(*) AS n FROM r GROUP BY 1""",
    "stratified_halves": """SELECT doc_id, source, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) <= floor(count(*) OVER (PARTITION BY source) / 2) THEN 'val' ELSE 'test' END AS half FROM documents""",
    "slices_small_medium_large": """SELECT doc_id, lang, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS slice_small, doc_id IN (SELECT doc_id FROM labels) AS slice_medium, true AS slice_large FROM documents""",
    "slice_missing": "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "best_per_entity": "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events WHERE value IS NOT NULL) WHERE r = 1",
    "last_wins": "SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2",
    "resume_antijoin": "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "public_sensitive_split": """SELECT s_suppkey, s_nationkey, CASE WHEN row_number() OVER (PARTITION BY s_nationkey ORDER BY md5('123|' || s_suppkey), s_suppkey) <= 2 THEN 'sensitive' ELSE 'public' END AS part FROM supplier""",
}
