"""Prompt records: numbered blocks, templates, pairs of entities, ranked clusters, corpus prompts."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import collapse_spaces, fill, lede, strip
from millrace.operators.cleaning import dense_id
from millrace.sources import table

FACTS = "Read the articles and list the facts they agree on as a JSON array of strings.\n\n{articles}"
QAS = "Write question and answer pairs as JSON about these facts.\n\nFacts:\n{facts}\n\nArticles:\n{articles}"
PAIR = "Compare {a} with {b}."


def format_articles(cluster: DataFrame, key: str, pos: str, most: int = 50, chars: int = 512) -> DataFrame:
    """``(key, pos, title, date, text)`` -> one numbered block per cluster.

    Only the first ``most`` articles are gathered, so a cluster's size is bounded before it becomes
    an array. Numbers are places, counting articles without text, which are left out of the block.
    An empty or missing date falls back to a column ``day``, where there is one.
    """
    first = cluster.where(F.col(pos) < most)
    text = strip(F.coalesce("text", F.lit("")))
    given = F.when(F.col("date") != "", F.col("date")) if "date" in cluster.columns else F.lit(None)
    date = F.coalesce(given, F.col("day") if "day" in cluster.columns else F.lit(""), F.lit(""))
    part = F.concat(F.lit("[Article "), (F.col(pos) + 1).cast("string"), F.lit("]\nTitle: "), strip(F.coalesce("title", F.lit(""))), F.lit("\nDate: "), strip(date), F.lit("\n"), lede(text, chars, "..."))
    rows = first.withColumn("_part", F.when(text != "", part))
    out = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.when(F.col("_part").isNotNull(), F.struct(F.col(pos), F.col("_part"))))).alias("_x"))
    return out.select(key, F.array_join(F.transform("_x", lambda x: x["_part"]), "\n\n---\n\n").alias("articles"), F.size("_x").cast("long").alias("articles_used"))


def numbered(items: Column | str) -> Column:
    """1. first, 2. second, .. on lines."""
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def numbered_questions(qas: Column | str, answers: bool = True) -> Column:
    """Numbered questions, with their answers if wanted, of array<struct<question, answer>>."""

    def one(x: Column, i: Column) -> Column:
        q = F.concat(F.lit("Q"), (i + 1).cast("string"), F.lit(": "), x["question"])
        return F.concat(q, F.lit("\nA: "), x["answer"]) if answers else q

    return F.array_join(F.transform(qas, one), "\n\n" if answers else "\n")


def questions_json(qas: Column | str) -> Column:
    """The questions of a record for judging: ids from 1, a missing response spelled out."""
    return F.to_json(F.transform(qas, lambda x, i: F.struct((i + 1).alias("id"), x["question"].alias("question"), x["answer"].alias("answer"), F.coalesce(x["response"], F.lit("(no response)")).alias("response"))))


def rank_clusters(articles: DataFrame, key: str, order: str, k: int = 0) -> DataFrame:
    """Clusters by size, largest first, then by first appearance; ``k`` of them, or all for 0."""
    sizes = articles.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("size"), F.min(order).alias("_o"))
    if k:
        top = sizes.orderBy(F.desc("size"), "_o").limit(k)
        return top.withColumn("rank", F.row_number().over(W.orderBy(F.desc("size"), "_o")) - 1).drop("_o")  # k rows
    return dense_id(sizes.withColumn("_d", -F.col("size")), ["_d", "_o"], "rank").drop("_o", "_d")


def first_of(articles: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group with their place ``pos``: a limit on ranks, which every task applies before the shuffle."""
    placed = articles.drop("pos").withColumn("pos", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("pos") <= most)
    return placed.withColumn("pos", F.col("pos") - 1)


def fact_prompts(articles: DataFrame, key: str, order: str, k: int = 500, least: int = 3) -> DataFrame:
    """Prompt records of the largest clusters: idx is the rank, so skipped clusters leave gaps."""
    ranked = rank_clusters(articles, key, order, k).where(F.col("size") >= least)
    block = format_articles(first_of(articles.join(ranked.select(key), key, "left_semi"), key, order, 50), key, "pos")
    out = ranked.join(block, key).where(F.col("articles_used") >= least)
    return out.select(F.col("rank").cast("long").alias("idx"), fill(FACTS, articles="articles").alias("prompt"), F.struct(F.col(key), F.col("size").alias("article_count"), "articles_used").alias("tag"))


def pair_prompts(entities: DataFrame, pos: str, name: str) -> DataFrame:
    """One prompt for each pair of entities in order of place, numbered densely: all pairs are the result."""
    a = entities.select(F.col(pos).alias("i"), F.col(name).alias("a"))
    b = entities.select(F.col(pos).alias("j"), F.col(name).alias("b"))
    pairs = a.join(b, F.col("i") < F.col("j"))
    return dense_id(pairs.select("i", "j", fill(PAIR, a="a", b="b").alias("prompt")), ["i", "j"], "idx").select("idx", "i", "j", "prompt")


def corpus_prompts(entities: DataFrame, kind: str, line: str, pos: str, name: str) -> DataFrame:
    """Prompts of one article type: wiki and journal per entity, chain per line, comparison per pair."""
    single = {"wiki": "Write an encyclopedia article about {name}.", "journal": "Write a field journal entry about {name}."}
    if kind in single:
        return entities.select(F.col(pos).alias("idx"), fill(single[kind], name=name).alias("prompt"), F.array(pos).alias("tag"))
    if kind == "chain":
        g = entities.groupBy(line).agg(F.sort_array(F.collect_list(F.struct(pos, name))).alias("m"))
        names = F.array_join(F.transform("m", lambda x: x[name]), ", ")
        return g.select(F.col(line).alias("idx"), F.concat(F.lit("Write about the line "), names, F.lit(".")).alias("prompt"), F.transform("m", lambda x: x[pos]).alias("tag"))
    if kind == "comparison":
        return pair_prompts(entities, pos, name).select("idx", "prompt", F.array("i", "j").alias("tag"))
    raise ValueError(f"unknown kind {kind!r}")


def asked(prompts: DataFrame, done: DataFrame, client: Callable[[str, int], str], seed: int = 42) -> DataFrame:
    """Prompts that have no response yet, asked: ``prompts.columns + response, error``.

    ``client(prompt, seed)`` is called once per prompt; a call that fails gives its error and no
    response, and the others go on. Results leave the task a few at a time. Write the result before
    using it twice: reading it again asks again. A null ``idx`` is never done and uses the seed as
    it is; columns called response or error are replaced.
    """
    import pyarrow as pa

    rest = [c for c in prompts.columns if c not in ("response", "error")]
    todo = prompts.join(done.select("idx").distinct(), "idx", "left_anti").select(*rest)

    def ask(batches):
        for b in batches:
            for s in range(0, b.num_rows, 16):
                part = b.slice(s, 16)
                said, errors = [], []
                for idx, p in zip(part.column(part.schema.get_field_index("idx")).to_pylist(), part.column(part.schema.get_field_index("prompt")).to_pylist(), strict=True):
                    try:
                        said.append(client(p, seed + (idx or 0)))
                        errors.append(None)
                    except Exception as e:  # isolated: reported, and asked again by the next run
                        said.append(None)
                        errors.append(f"{type(e).__name__}: {e}"[:500])
                yield part.append_column("response", pa.array(said, pa.string())).append_column("error", pa.array(errors, pa.string()))

    return todo.mapInArrow(ask, todo.select("*").schema.add("response", "string").add("error", "string"))


def answered(prompts: DataFrame, done: DataFrame, client: Callable[[str, int], str], seed: int = 42) -> DataFrame:
    """Responses to prompts that have none yet: ``prompts.columns + response``; failed calls give no row (``asked`` has them)."""
    return asked(prompts, done, client, seed).where("error IS NULL").drop("error")


def _articles(s, d):
    return table(s, d, "documents").select("doc_id", F.col("source").alias("title"), F.lit("2024-01-01").alias("date"), "text", F.col("source").alias("cluster_id"))


def q_cluster_prompt(s, d):
    out = fact_prompts(_articles(s, d), "cluster_id", "doc_id")
    return out.select("idx", F.sha2("prompt", 256).alias("prompt_sha"), F.col("tag.cluster_id").alias("cluster_id"), F.col("tag.article_count").alias("article_count"), F.col("tag.articles_used").alias("articles_used"))


def q_topk(s, d):
    e = table(s, d, "embeddings").select(F.col("label").alias("cluster_id"), "vec_id")
    return rank_clusters(e, "cluster_id", "vec_id", 5).select("cluster_id", "size", F.col("rank").cast("long").alias("rank"))


def q_cluster_order(s, d):
    return rank_clusters(_articles(s, d), "cluster_id", "doc_id").select("cluster_id", "size", "rank")


def q_pairs(s, d):
    return pair_prompts(table(s, d, "nation"), "n_nationkey", "n_name")


def q_format_lists(s, d):
    o = table(s, d, "nation").groupBy("n_regionkey").agg(F.transform(F.sort_array(F.collect_list("n_name")), lambda x: F.struct(x.alias("question"), F.lower(x).alias("answer"), F.lit(None).cast("string").alias("response"))).alias("q"))
    return o.select("n_regionkey", numbered(F.transform("q", lambda x: x["question"])).alias("facts"), numbered_questions("q").alias("qas"), numbered_questions("q", False).alias("questions"), questions_json("q").alias("judged"))


def q_template(s, d):
    return table(s, d, "region").select("r_regionkey", fill("{a}/{b}/{a}", a=F.concat("r_name", F.lit("{b}")), b=F.col("r_regionkey")).alias("filled"), collapse_spaces(F.concat(F.lit("  x\t"), "r_name")).alias("spaced"))


def q_chain(s, d):
    return corpus_prompts(table(s, d, "nation"), "chain", "n_regionkey", "n_nationkey", "n_name").select("idx", "prompt", F.array_join(F.transform("tag", lambda x: x.cast("string")), ",").alias("tag"))


QUERIES = {"cluster_prompt": q_cluster_prompt, "topk_clusters": q_topk, "cluster_order": q_cluster_order, "pair_prompts": q_pairs, "format_lists": q_format_lists, "template_fill": q_template, "chain_prompts": q_chain}
SQL = {
    "cluster_prompt": """WITH c AS (SELECT source AS cluster_id, count(*) AS size, min(doc_id) AS o FROM documents WHERE source IS NOT NULL GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY size DESC, o) - 1 AS idx FROM c), a AS (
  SELECT source AS cluster_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos, trim(text) AS text, source AS title FROM documents),
b AS (SELECT *, string_split(text, chr(10) || chr(10))[1] AS lede FROM a WHERE pos <= 50 AND text <> ''),
g AS (SELECT cluster_id, count(*) AS articles_used, string_agg('[Article ' || pos || ']' || chr(10) || 'Title: ' || title || chr(10) || 'Date: 2024-01-01' || chr(10) || CASE WHEN length(lede) > 512 THEN substr(lede, 1, 512) || '...' ELSE lede END, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY pos) AS articles FROM b GROUP BY 1)
SELECT idx, sha256('Read the articles and list the facts they agree on as a JSON array of strings.' || chr(10) || chr(10) || articles) AS prompt_sha, r.cluster_id, size AS article_count, articles_used
FROM r JOIN g USING (cluster_id) WHERE idx < 500 AND size >= 3 AND articles_used >= 3""",
    "topk_clusters": "SELECT label AS cluster_id, count(*) AS size, row_number() OVER (ORDER BY count(*) DESC, min(vec_id)) - 1 AS rank FROM embeddings WHERE label IS NOT NULL GROUP BY 1 QUALIFY rank < 5",
    "cluster_order": "SELECT source AS cluster_id, count(*) AS size, row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) - 1 AS rank FROM documents WHERE source IS NOT NULL GROUP BY 1",
    "pair_prompts": "SELECT row_number() OVER (ORDER BY a.n_nationkey, b.n_nationkey) - 1 AS idx, a.n_nationkey AS i, b.n_nationkey AS j, 'Compare ' || a.n_name || ' with ' || b.n_name || '.' AS prompt FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey",
    "format_lists": """SELECT n_regionkey, string_agg(i || '. ' || n_name, chr(10) ORDER BY i) AS facts, string_agg('Q' || i || ': ' || n_name || chr(10) || 'A: ' || lower(n_name), chr(10) || chr(10) ORDER BY i) AS qas,
string_agg('Q' || i || ': ' || n_name, chr(10) ORDER BY i) AS questions, '[' || string_agg('{"id":' || i || ',"question":"' || n_name || '","answer":"' || lower(n_name) || '","response":"(no response)"}', ',' ORDER BY i) || ']' AS judged
FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS i FROM nation) GROUP BY 1""",
    "template_fill": "SELECT r_regionkey, r_name || r_regionkey || '/' || r_regionkey || '/' || r_name || r_regionkey AS filled, 'x ' || r_name AS spaced FROM region",
    "chain_prompts": "SELECT n_regionkey AS idx, 'Write about the line ' || string_agg(n_name, ', ' ORDER BY n_nationkey) || '.' AS prompt, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) AS tag FROM nation GROUP BY 1",
}
