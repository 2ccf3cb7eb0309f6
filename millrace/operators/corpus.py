"""Corpus bookkeeping: unions in order, parts by type, totals, features of entities, signatures, slice checks."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.features import QUESTION_FEATURES, applicable, normalize_info, question_to_feature
from millrace.functions.text import normalize_paragraphs
from millrace.operators.cleaning import dense_id
from millrace.operators.dedup import shingle_sets
from millrace.operators.entities import ASKED, _entities, entity_questions
from millrace.operators.qa import inverted_index, union_supports
from millrace.operators.splits import slices
from millrace.operators.stages import is_subset
from millrace.operators.statistics import rounded
from millrace.plans.names import fresh
from millrace.sources import table


def in_order(parts: Iterable[DataFrame], order: str, name: str) -> DataFrame:
    """Parts one after the other, each in its own order, numbered from 0. Missing columns are null."""
    out, part = None, None
    for k, p in enumerate(parts):
        (part,) = fresh(p, "part") if part is None else (part,)
        p = p.withColumn(part, F.lit(k))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return dense_id(out, [part, order], name).drop(part)


def of_types(articles: DataFrame, sensitive: bool) -> DataFrame:
    """Articles whose type is sensitive, or the others; an article without a type is neither."""
    return articles.where(F.col("type").startswith("sensitive") if sensitive else ~F.col("type").startswith("sensitive"))


def with_total(df: DataFrame, columns: list[str], total: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Columns renamed where they exist, and the sum of ``columns``; null if one of them is."""
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    return df.withColumn(total, sum((F.col(c) for c in columns[1:]), F.col(columns[0])))


def ordered_groups(df: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """``key, values``: each group's values by place; null places come first, null values are kept."""
    g = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v")))).alias("x"))
    return g.select(key, F.transform("x", lambda e: e["v"]).alias("values"))


def skipped_facts(facts: DataFrame, *needed: str) -> DataFrame:
    """``skipped, n``: rows that an index leaves out since one of the needed columns is null, and all rows."""
    bad = F.lit(False)
    for c in needed:
        bad = bad | F.col(c).isNull()
    return facts.agg(F.count_if(bad).alias("skipped"), F.count("*").alias("n"))


def info_counts(df: DataFrame, features: str) -> DataFrame:
    """``given, known, filtered``: raw feature names over all rows, those with a canonical name, and the others."""
    bare = F.filter(F.coalesce(features, F.array().cast("array<string>")), lambda x: F.size(normalize_info(F.array(x))) > 0)
    n = df.select(F.greatest(F.size(features), F.lit(0)).alias("g"), F.size(bare).alias("k"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return n.agg(total("g").alias("given"), total("k").alias("known"), (total("g") - total("k")).alias("filtered"))


def signatures(docs: DataFrame, n: int = 5, permutations: int = 128) -> DataFrame:
    """``doc_id, signature``: hashes of ``permutations`` single MinHash values of a text's shingle set.

    Two sets agree at a place with the chance of their Jaccard similarity. Texts without a word have
    no signature; null ids are left out, repeated rows are rows like others.
    """
    return shingle_sets(docs, n, permutations, 1).select("doc_id", F.col("bands").alias("signature"))


def support_stats(questions: DataFrame, supports: str) -> DataFrame:
    """Numbers of supports by what a question asks for, sorted by feature."""
    n = questions.select(question_to_feature("question").alias("feature"), F.greatest(F.size(supports), F.lit(0)).alias("n"))
    p = lambda q: F.percentile("n", F.lit(q))
    out = n.groupBy("feature").agg(F.count("*").alias("n_qas"), F.avg("n").alias("mean"), F.stddev_pop("n").alias("std"), F.min("n").alias("min"), p(0.25).alias("p25"), p(0.5).alias("median"), p(0.75).alias("p75"), F.max("n").alias("max"))
    return out.orderBy("feature")  # a handful of features


def question_supports(questions: DataFrame, index: DataFrame) -> DataFrame:
    """``questions(idx, qa_idx, question)`` with ``supports``: documents of the features that support the question's label.

    ``index(idx, feature, docs)``. A question without a known label, or without documents, has an empty array.
    """
    pairs = [(label, f) for label, fs in QUESTION_FEATURES.items() for f in fs]
    known = F.explode(F.array(*[F.struct(F.lit(l).alias("label"), F.lit(f).alias("feature")) for l, f in pairs]))
    wanted = questions.select("idx", question_to_feature("question").alias("label")).distinct()
    labels = questions.sparkSession.range(1).select(known.alias("x")).select("x.label", "x.feature")
    got = union_supports(index, wanted.join(F.broadcast(labels), "label"), "idx", "feature")  # a row a label and feature
    out = questions.withColumn("label", question_to_feature("question")).join(got, ["idx", "label"], "left")
    return out.select(*questions.columns, F.coalesce("supports", F.array().cast(index.schema["docs"].dataType)).alias("supports"))


# queries


def _facts(s, d) -> DataFrame:
    """Lines of orders as mentions: a part's features by the line number."""
    names = [f for _, f in ASKED if f not in ("types", "move")] + ["type1", "type2", "move.name"]
    return table(s, d, "lineitem").select(F.col("l_partkey").alias("idx"), F.element_at(F.array(*map(F.lit, names)), (F.col("l_linenumber") % len(names) + 1).cast("int")).alias("feature"), F.col("l_orderkey").alias("doc"))


def _supported(s, d) -> DataFrame:
    q = entity_questions(_entities(s, d)).select("idx", "qa_idx", "question")
    return question_supports(q, inverted_index(_facts(s, d), "idx", "feature", "doc"))


def q_in_order(s, d):
    parts = [table(s, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), table(s, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("more"))]
    return in_order(parts, "key", "article_idx").select("article_idx", "key", "name", "more")


def q_of_types(s, d):
    kinds = F.when(F.col("event_type") == "click", "sensitive_wiki").when(F.col("event_type") == "view", "wiki").otherwise(F.lit(None))
    e = table(s, d, "events").select("event_id", kinds.alias("type"))
    return of_types(e, True).withColumn("part", F.lit("sensitive")).union(of_types(e, False).withColumn("part", F.lit("public")))


def q_applicable(s, d):
    p = table(s, d, "part")
    line = F.when(F.col("p_size") % 3 > 0, F.array_repeat(F.lit("x"), (F.col("p_size") % 3).cast("int")))
    return p.select("p_partkey", F.array_join(applicable(F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")), line), ",").alias("features"))


def q_subsets(s, d):
    every = slices(table(s, d, "documents").select("doc_id"), table(s, d, "labels").where("quality = 1"), table(s, d, "labels"), "doc_id")
    small, medium = every.where("slice_small"), every.where("slice_medium")
    return s.range(1).select(F.lit(is_subset(small, medium, "doc_id")).alias("small_in_medium"), F.lit(is_subset(medium, every, "doc_id")).alias("medium_in_large"), F.lit(is_subset(every, small, "doc_id")).alias("large_in_small"))


QUERIES = {
    "in_order": q_in_order,
    "of_types": q_of_types,
    "stat_totals": lambda s, d: with_total(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("hp "), "l_discount", "l_tax"), ["hp", "l_discount", "l_tax"], "total", {"hp ": "hp", "none": "x"}).groupBy("l_orderkey").agg(F.round(F.sum("total"), 4).alias("total")),
    "ordered_groups": lambda s, d: ordered_groups(table(s, d, "conversations"), "conv_id", "turn", "role").select("conv_id", F.array_join("values", ",").alias("roles")),
    "skipped_facts": lambda s, d: skipped_facts(table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left"), "lang", "quality"),
    "info_counts": lambda s, d: info_counts(table(s, d, "events").select(F.when(F.col("event_id") % 3 > 0, F.array(F.lit("HP"), F.col("event_type"), F.lit("g1_speed"), F.lit("HP"))).alias("x")), "x"),
    "normal_paragraphs": lambda s, d: table(s, d, "documents").select("doc_id", F.md5(normalize_paragraphs(F.concat(F.lit("\n\n"), F.replace(F.coalesce("text", F.lit("")), F.lit(". "), F.lit(". \t\n\n\n\n")), F.lit("\n")))).alias("text_md5")),
    "applicable_features": q_applicable,
    "question_supports": lambda s, d: _supported(s, d).select("idx", "qa_idx", F.size("supports").cast("long").alias("n"), F.md5(F.array_join(F.transform("supports", lambda x: x.cast("string")), ",")).alias("supports_md5")),
    "support_stats_by_feature": lambda s, d: rounded(support_stats(_supported(s, d), "supports")),
    "slice_subsets": q_subsets,
    "signatures": lambda s, d: signatures(table(s, d, "documents").select("doc_id", "text")),
}
_NAMES = [f for _, f in ASKED if f not in ("types", "move")] + ["type1", "type2", "move.name"]
_QUESTIONS = "(SELECT p_partkey AS idx, qa_idx, label FROM part, (VALUES " + ", ".join(f"({i}, '{f}')" for i, (_, f) in enumerate(ASKED)) + ") v(qa_idx, label))"
_MAP = "(VALUES " + ", ".join(f"('{label}', '{f}')" for label, fs in QUESTION_FEATURES.items() for f in fs) + ") m(label, feature)"
_COUNTED = f"""(SELECT q.idx, q.qa_idx, q.label, list_sort(list(DISTINCT f.doc) FILTER (WHERE f.doc IS NOT NULL)) AS s FROM {_QUESTIONS} q JOIN {_MAP} ON m.label = q.label
  LEFT JOIN (SELECT l_partkey AS idx, {_NAMES}[l_linenumber % {len(_NAMES)} + 1] AS feature, l_orderkey AS doc FROM lineitem) f ON f.idx = q.idx AND f.feature = m.feature GROUP BY 1, 2, 3)"""
SQL = {
    "in_order": "SELECT row_number() OVER (ORDER BY part, key) - 1 AS article_idx, key, name, more FROM (SELECT 0 AS part, s_suppkey AS key, s_name AS name, CAST(NULL AS VARCHAR) AS more FROM supplier UNION ALL SELECT 1, c_custkey, c_name, c_mktsegment FROM customer)",
    "of_types": "SELECT event_id, CASE event_type WHEN 'click' THEN 'sensitive_wiki' ELSE 'wiki' END AS type, CASE event_type WHEN 'click' THEN 'sensitive' ELSE 'public' END AS part FROM events WHERE event_type IN ('click', 'view')",
    "stat_totals": "SELECT l_orderkey, round(sum(l_quantity + l_discount + l_tax), 4) AS total FROM lineitem GROUP BY 1",
    "ordered_groups": "SELECT conv_id, string_agg(role, ',' ORDER BY turn, role) AS roles FROM conversations GROUP BY 1",
    "skipped_facts": "SELECT count(*) FILTER (WHERE lang IS NULL OR quality IS NULL) AS skipped, count(*) AS n FROM documents LEFT JOIN labels ON labels.doc_id = documents.doc_id",
    "info_counts": "SELECT 4 * count(*) AS given, 3 * count(*) AS known, count(*) AS filtered FROM events WHERE event_id % 3 > 0",
    "normal_paragraphs": r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[ \t]+\n', chr(10), 'g'), '[ \t]+$', ''), '\n{3,}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g')) AS text_md5
FROM (SELECT doc_id, chr(10) || chr(10) || replace(coalesce(text, ''), '. ', '. ' || chr(9) || chr(10) || chr(10) || chr(10) || chr(10)) || chr(10) AS t FROM documents)""",
    "applicable_features": "SELECT p_partkey, 'name,classification,type1,ability,hp,attack,defense,special attack,special defense,speed,base_stat_total,weight,height,move.name,move.short_description' || CASE WHEN p_partkey % 2 = 0 AND p_type IS NOT NULL THEN ',type2' ELSE '' END || CASE WHEN p_size % 3 = 2 THEN ',evolution_line' ELSE '' END AS features FROM part",
    "question_supports": f"SELECT idx, qa_idx, coalesce(len(s), 0) AS n, md5(coalesce(array_to_string(s, ','), '')) AS supports_md5 FROM {_COUNTED}",
    "support_stats_by_feature": f"SELECT label AS feature, count(*) AS n_qas, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std, min(n) AS min, round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.75), 6) AS p75, max(n) AS max FROM (SELECT label, CAST(coalesce(len(s), 0) AS INTEGER) AS n FROM {_COUNTED}) GROUP BY label",
    "slice_subsets": "SELECT true AS small_in_medium, true AS medium_in_large, (SELECT count(*) = 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)) AS large_in_small",
}
