"""The question/answer stages around a model: prompt records to ask, responses applied, final records.

Records are in long form, one row per question: ``cluster_id, qa_idx, question, answer, ..``. Every
stage is joins and aggregates; a model is asked elsewhere (``prompts.answered``), so nothing here
asks twice. Rows with a null key take no part unless a function says otherwise, and empty tables
give no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import parse
from millrace.functions.text import answers_match, fill, strip, truncate_words
from millrace.operators.cleaning import dense_id
from millrace.operators.prompts import QAS, first_of, format_articles, numbered, questions_json, rank_clusters
from millrace.operators.qa import attach, zip_verdicts
from millrace.plans.work import written
from millrace.sources import table

ZEROSHOT = "Answer in a few words.\n\n{question}"
JUDGE = "Say for each id as JSON whether the response is right and whether the question says enough.\n\n{qas_json}"
SUPPORT = "Does the article support each of the {number} answers? Give a JSON list of true and false.\n\n{article}\n\n{questions}"
OPENBOOK = "Answer each question from the article as a JSON list of strings.\n\n{article}\n\n{questions}"


# prompts


def qa_prompts(facts: DataFrame, articles: DataFrame, key: str, order: str, k: int = 500, least: int = 3, most: int = 50, chars: int = 512) -> DataFrame:
    """Question writing: ``facts(key, facts array)`` of clusters of ``articles`` -> ``idx, prompt, tag``.

    Clusters with at least one fact and one article take part, the ``k`` largest (0: all) by number
    of articles, ties by first appearance; idx is the rank, so clusters with fewer than ``least``
    usable articles leave gaps. Of repeated fact records of a cluster the last by text counts.
    """
    known = facts.where(F.size("facts") > 0).groupBy(key).agg(F.max("facts").alias("facts"))
    mine = articles.join(known.select(key), key, "left_semi")
    ranked = rank_clusters(mine, key, order, k)
    placed = first_of(mine.join(ranked.select(key), key, "left_semi"), key, order, most)
    block = format_articles(placed, key, "pos", most, chars).where(F.col("articles_used") >= least)
    out = ranked.join(block, key).join(known, key)
    tag = F.struct(F.col(key).alias("cluster_id"), F.col("size").alias("article_count"), "articles_used", F.size("facts").cast("long").alias("facts_used"))
    return out.select(F.col("rank").cast("long").alias("idx"), fill(QAS, facts=numbered("facts"), articles="articles").alias("prompt"), tag.alias("tag"))


def zeroshot_prompts(qas: DataFrame) -> DataFrame:
    """One prompt per question that is not empty, numbered densely by cluster and place."""
    asked = qas.where(F.coalesce(F.col("question"), F.lit("")) != "")
    out = dense_id(asked.select("cluster_id", "qa_idx", "question"), ["cluster_id", "qa_idx"], "idx")
    return out.select("idx", fill(ZEROSHOT, question="question").alias("prompt"), F.struct("cluster_id", "qa_idx").alias("tag"))


def judge_prompts(qas: DataFrame, response: str = "zeroshot") -> DataFrame:
    """One prompt per cluster with all its questions; idx is the cluster's rank by id, gaps included.

    Clusters may appear with a null ``qa_idx`` only: those have no question and leave a gap.
    """
    q = F.when(F.col("qa_idx").isNotNull(), F.struct("qa_idx", "question", "answer", F.col(response).alias("response")))
    g = qas.groupBy("cluster_id").agg(F.sort_array(F.collect_list(q)).alias("qas"))
    out = dense_id(g, ["cluster_id"], "idx").where(F.size("qas") > 0)
    return out.select("idx", fill(JUDGE, qas_json=questions_json("qas")).alias("prompt"), F.struct("cluster_id", F.size("qas").alias("n_qas")).alias("tag"))


def by_article(pairs: DataFrame, qas: DataFrame) -> DataFrame:
    """``pairs(article_idx, cluster_id, qa_idx)`` -> ``article_idx, qas``: each article's questions once, in order."""
    one = pairs.where("article_idx IS NOT NULL").select("article_idx", "cluster_id", "qa_idx").distinct()
    j = one.join(qas.select("cluster_id", "qa_idx", "question", "answer"), ["cluster_id", "qa_idx"])
    return j.groupBy("article_idx").agg(F.sort_array(F.collect_list(F.struct("cluster_id", "qa_idx", "question", "answer"))).alias("qas"))


def format_article(title: Column | str, date: Column | str, text: Column | str, most: int = 0) -> Column:
    """An article whole: title, date and text, cut at ``most`` words (0: not cut)."""
    c = lambda x: strip(F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit("")))
    return F.concat(F.lit("Title: "), c(title), F.lit("\nDate: "), c(date), F.lit("\nText: "), truncate_words(c(text), most))


def question_blocks(qas: Column | str, answers: bool) -> Column:
    """Question 1: .., with Answer 1: .. on the next line if wanted, blank lines between."""

    def one(x: Column, i: Column) -> Column:
        n = (i + 1).cast("string")
        q = F.concat(F.lit("Question "), n, F.lit(": "), F.coalesce(x["question"], F.lit("")))
        return F.concat(q, F.lit("\nAnswer "), n, F.lit(": "), F.coalesce(x["answer"], F.lit(""))) if answers else q

    return F.array_join(F.transform(qas, one), "\n\n")


def article_prompts(pairs: DataFrame, qas: DataFrame, articles: DataFrame, most: int = 0) -> DataFrame:
    """Support and open-book prompts: ``idx, support, openbook, tag``, one row per needed article.

    ``articles(article_idx, title, date, text)``; a needed article that is not there is left out.
    idx is dense by article_idx, and the tag lists the questions by place.
    """
    j = by_article(pairs, qas).join(articles, "article_idx")
    body = j.select("article_idx", "qas", format_article("title", "date", "text", most).alias("article"))
    out = dense_id(body, ["article_idx"], "idx")
    support = fill(SUPPORT, number=F.size("qas"), article="article", questions=question_blocks("qas", True))
    openbook = fill(OPENBOOK, article="article", questions=question_blocks("qas", False))
    tag = F.struct("article_idx", F.transform("qas", lambda x: F.struct(x["cluster_id"].alias("cluster_id"), x["qa_idx"].alias("qa_idx"))).alias("qas"))
    return out.select("idx", support.alias("support"), openbook.alias("openbook"), tag.alias("tag"))


# responses


def apply_judgments(qas: DataFrame, responses: DataFrame, order: str = "idx") -> DataFrame:
    """Adds ``is_correct, is_underspecified`` from ``responses(cluster_id, response, order)``.

    A verdict's id is the question's place from 1; the last verdict of an id in the order wins; a
    question without one gets nulls.
    """
    v = responses.select("cluster_id", order, F.posexplode(parse.parse_judgments("response")).alias("place", "j"))
    v = v.select("cluster_id", (F.col("j.id") - 1).alias("qa_idx"), F.struct(order, "place").alias("when"), F.struct("j.is_correct", "j.is_underspecified").alias("verdict"))
    out = attach(qas, v.where("qa_idx IS NOT NULL"), ["cluster_id", "qa_idx"], "verdict", "when")
    return out.select(*qas.columns, "verdict.is_correct", "verdict.is_underspecified")


def apply_supports(qas: DataFrame, responses: DataFrame) -> DataFrame:
    """Adds ``supports``: sorted articles whose response says true at the question's place.

    ``responses(tag, response)``. A response whose list is empty or of another length than its
    tag's questions is discarded whole; a question without a support gets an empty array.
    """
    z = zip_verdicts(responses.select(F.col("tag.article_idx").alias("article_idx"), F.col("tag.qas").alias("qas"), parse.parse_bools("response").alias("said")), "qas", "said")
    yes = z.where("verdict").groupBy("tag.cluster_id", "tag.qa_idx").agg(F.sort_array(F.collect_set("article_idx")).alias("supports"))
    out = qas.join(yes, ["cluster_id", "qa_idx"], "left")
    return out.select(*qas.columns, F.coalesce("supports", F.array().cast("array<bigint>")).alias("supports"))


def apply_openbook(qas: DataFrame, responses: DataFrame) -> DataFrame:
    """Adds ``openbook array<struct<article_idx, answer, is_correct>>`` in order of article.

    The same rules for discarding as ``apply_supports``; an answer is right when one of the two
    normalised answers holds the other.
    """
    z = zip_verdicts(responses.select(F.col("tag.article_idx").alias("article_idx"), F.col("tag.qas").alias("qas"), parse.parse_strings("response").alias("said")), "qas", "said")
    z = z.select("tag.cluster_id", "tag.qa_idx", "article_idx", F.col("verdict").alias("said"))
    j = z.join(qas.select("cluster_id", "qa_idx", F.col("answer").alias("truth")), ["cluster_id", "qa_idx"])
    one = F.struct("article_idx", F.col("said").alias("answer"), F.coalesce(answers_match("truth", "said"), F.lit(False)).alias("is_correct"))
    got = j.groupBy("cluster_id", "qa_idx").agg(F.sort_array(F.collect_list(one)).alias("openbook"))
    out = qas.join(got, ["cluster_id", "qa_idx"], "left")
    empty = F.array().cast("array<struct<article_idx:bigint,answer:string,is_correct:boolean>>")
    return out.select(*qas.columns, F.coalesce("openbook", empty).alias("openbook"))


def response_counts(responses: DataFrame, parsed: Column, wanted: Column) -> DataFrame:
    """``parsed, failed, n``: responses whose list fits its tag, the others, and all: one aggregate."""
    fits = (F.size(parsed) > 0) & (F.size(parsed) == F.size(wanted))
    return responses.agg(F.count_if(fits).alias("parsed"), F.count_if(~F.coalesce(fits, F.lit(False))).alias("failed"), F.count("*").alias("n"))


def filled_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with and without a value, for each column: ``column, filled, missing``."""
    sums = df.agg(F.count("*").alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("filled"), (F.col("n") - F.col(f"c{i}")).alias("missing")) for i, c in enumerate(columns)])
    return sums.select(F.inline(rows))


def nested_total(records: DataFrame, array: str) -> DataFrame:
    """``records, items, empty``: rows, items of an array column over all rows, and rows without any."""
    n = F.coalesce(F.size(array), F.lit(0))
    n = F.greatest(n, F.lit(0))
    return records.agg(F.count("*").alias("records"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("items"), F.count_if(n == 0).alias("empty"))


# final records


def final_records(qas: DataFrame) -> DataFrame:
    """The zero-shot pair folded into ``closedbook``; open-book entries without an article or an answer go.

    ``qas(.., zeroshot, is_correct, openbook)`` -> the other columns, closedbook, openbook.
    """
    rest = [c for c in qas.columns if c not in ("zeroshot", "is_correct", "openbook")]
    whole = F.filter("openbook", lambda x: x.isNotNull() & x["article_idx"].isNotNull() & x["answer"].isNotNull() & x["is_correct"].isNotNull())
    return qas.select(*rest, F.struct(F.col("zeroshot").alias("answer"), "is_correct").alias("closedbook"), F.coalesce(whole, F.slice("openbook", 1, 0)).alias("openbook"))


def slim(qas: DataFrame) -> DataFrame:
    """Only what an evaluation needs; a null array is empty."""
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(qas.schema[c].dataType))
    return qas.select("cluster_id", "qa_idx", "question", "answer", empty("supports").alias("supports"), "closedbook", empty("openbook").alias("openbook"))


def good_records(qas: DataFrame, wrong: bool = True, specified: bool = True) -> DataFrame:
    """Questions that the closed book answers wrongly and, or, that say enough; a null verdict is neither."""
    no = F.lit(False)
    keep = F.lit(True)
    if wrong:
        keep = keep & F.col("closedbook.is_correct").eqNullSafe(no)
    if specified:
        keep = keep & F.col("is_underspecified").eqNullSafe(no)
    return qas.where(keep)


def support_pool(qas: DataFrame) -> DataFrame:
    """Distinct articles that any question needs."""
    return qas.select(F.explode("supports").alias("article_idx")).where("article_idx IS NOT NULL").distinct()


def is_subset(small: DataFrame, large: DataFrame, key: str) -> bool:
    """Whether every key of ``small`` is in ``large``; nulls do not count."""
    return small.where(F.col(key).isNotNull()).join(large, key, "left_anti").isEmpty()


# queries: conversations are clusters, their user turns questions; documents are the articles


def _qas(s, d) -> DataFrame:
    c = table(s, d, "conversations")
    said = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    q = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question")).join(said, ["conv_id", "turn"], "left")
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("turn")) - 1  # a conversation's own turns
    return q.select(F.col("conv_id").alias("cluster_id"), place.cast("long").alias("qa_idx"), "question", "answer")


def _pairs(s, d) -> DataFrame:
    q = _qas(s, d)
    return q.select(F.explode(F.array(F.col("cluster_id") * 3 + F.col("qa_idx"), F.col("cluster_id"), F.col("cluster_id"))).alias("article_idx"), "cluster_id", "qa_idx")


def _articles(s, d) -> DataFrame:
    return table(s, d, "documents").select(F.col("doc_id").alias("article_idx"), F.col("source").alias("title"), F.lit("2024-01-01").alias("date"), "text")


def _support_responses(s, d) -> DataFrame:
    """What a model might say: every fifth article no list, every seventh one item too many."""
    p = article_prompts(_pairs(s, d), _qas(s, d), _articles(s, d)).select("tag")
    said = F.transform("tag.qas", lambda x, i: F.when((F.col("tag.article_idx") + i) % 2 == 0, "true").otherwise("false"))
    said = F.when(F.col("tag.article_idx") % 7 == 1, F.concat(said, F.array(F.lit("true")))).otherwise(said)
    text = F.when(F.col("tag.article_idx") % 5 == 0, "no idea").otherwise(F.concat(F.lit("```json\n["), F.array_join(said, ", "), F.lit("] # done\n```")))
    return p.withColumn("response", text)


def _openbook_responses(s, d) -> DataFrame:
    """Article and place decide: the question's number as text, or null."""
    p = article_prompts(_pairs(s, d), _qas(s, d), _articles(s, d)).select("tag")
    said = F.transform("tag.qas", lambda x, i: F.when((F.col("tag.article_idx") + i) % 3 == 0, "null").otherwise(F.concat(F.lit('" Said '), x["qa_idx"].cast("string"), F.lit('. "'))))
    return p.withColumn("response", F.concat(F.lit("Here: ["), F.array_join(said, ", "), F.lit("]")))


def _judged(s, d) -> DataFrame:
    q = _qas(s, d).withColumn("zeroshot", F.when(F.col("qa_idx") % 2 == 0, F.col("answer")))
    one = F.concat(F.lit('{"id": '), (F.col("qa_idx") + 1).cast("string"), F.lit(', "is_correct": '), F.when(F.col("cluster_id") % 2 == 0, "true").otherwise("false"), F.lit(', "is_underspecified": '), F.when(F.col("qa_idx") % 3 == 0, "true").otherwise("false"), F.lit("}"))
    first = q.where("cluster_id % 4 <> 3").groupBy("cluster_id").agg(F.concat(F.lit("[{\"id\": 1, \"is_correct\": true}, "), F.array_join(F.sort_array(F.collect_list(one)), ", "), F.lit("]")).alias("response")).withColumn("idx", F.lit(1))
    return apply_judgments(q, first)


def _list_text(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def q_qa_prompts(s, d):
    a = table(s, d, "documents").select("doc_id", F.col("source").alias("title"), F.lit("2024-01-01").alias("date"), "text", F.col("source").alias("cluster_id"))
    facts = table(s, d, "documents").groupBy(F.col("source").alias("cluster_id")).agg(F.array_sort(F.collect_set("lang")).alias("facts"))
    out = qa_prompts(facts, a, "cluster_id", "doc_id")
    return out.select("idx", F.sha2("prompt", 256).alias("prompt_sha"), "tag.cluster_id", "tag.article_count", "tag.articles_used", "tag.facts_used")


def q_zeroshot(s, d):
    return zeroshot_prompts(_qas(s, d)).select("idx", F.md5("prompt").alias("prompt_md5"), "tag.cluster_id", "tag.qa_idx")


def q_judge(s, d):
    q = _qas(s, d).select("cluster_id", "qa_idx", F.md5("question").alias("question"), F.md5("answer").alias("answer"), F.when(F.col("qa_idx") % 2 == 0, F.md5("answer")).alias("zeroshot"))
    return judge_prompts(q).select("idx", F.md5("prompt").alias("prompt_md5"), "tag.cluster_id", F.col("tag.n_qas").cast("long").alias("n_qas"))


def q_article_prompts(s, d):
    out = article_prompts(_pairs(s, d), _qas(s, d), _articles(s, d))
    tag = F.array_join(F.transform("tag.qas", lambda x: F.concat_ws(":", x["cluster_id"].cast("string"), x["qa_idx"].cast("string"))), ",")
    return out.select("idx", F.md5("support").alias("support_md5"), F.md5("openbook").alias("openbook_md5"), "tag.article_idx", tag.alias("qas"))


def q_apply_supports(s, d):
    return apply_supports(_qas(s, d), _support_responses(s, d)).select("cluster_id", "qa_idx", _list_text("supports").alias("supports"))


def q_support_counts(s, d):
    r = _support_responses(s, d)
    return response_counts(r, parse.parse_bools("response"), F.col("tag.qas"))


def q_apply_openbook(s, d):
    q = _qas(s, d).withColumn("answer", F.concat(F.lit("SAID "), (F.col("qa_idx") % 2).cast("string")))
    out = apply_openbook(q, _openbook_responses(s, d))
    text = F.array_join(F.transform("openbook", lambda x: F.concat_ws(":", x["article_idx"].cast("string"), x["answer"], x["is_correct"].cast("string"))), ",")
    return out.select("cluster_id", "qa_idx", text.alias("openbook"))


def q_apply_judgments(s, d):
    return _judged(s, d).select("cluster_id", "qa_idx", "is_correct", "is_underspecified")


def q_filled(s, d):
    return filled_counts(_judged(s, d), "zeroshot", "is_correct")


def _final(s, d) -> DataFrame:
    j = _judged(s, d)
    q = apply_supports(j, _support_responses(s, d))
    ob = F.array(F.struct(F.col("cluster_id").alias("article_idx"), F.when(F.col("qa_idx") % 2 == 0, "x").alias("answer"), F.lit(True).alias("is_correct")), F.struct((F.col("cluster_id") + 1).alias("article_idx"), F.lit("y").alias("answer"), F.lit(False).alias("is_correct")))
    return final_records(q.withColumn("openbook", F.when(F.col("cluster_id") % 3 > 0, ob)))


def q_final(s, d):
    kept = slim(good_records(written(_final(s, d), "final")))
    ob = F.array_join(F.transform("openbook", lambda x: F.concat_ws(":", x["article_idx"].cast("string"), x["answer"])), ",")
    return kept.select("cluster_id", "qa_idx", F.md5(F.coalesce("closedbook.answer", F.lit(""))).alias("closed_md5"), F.col("closedbook.is_correct").alias("closed_correct"), _list_text("supports").alias("supports"), ob.alias("openbook"))


def q_totals(s, d):
    q = _qas(s, d).groupBy("cluster_id").agg(F.collect_list("question").alias("qas"))
    every = table(s, d, "conversations").select(F.col("conv_id").alias("cluster_id")).distinct()
    return nested_total(every.join(q, "cluster_id", "left"), "qas")


def q_pool(s, d):
    return support_pool(apply_supports(_qas(s, d), _support_responses(s, d)))


def q_either_good(s, d):
    q = _judged(s, d).select("cluster_id", "qa_idx", F.struct("is_correct").alias("closedbook"), "is_underspecified")
    a, b = good_records(q, True, False), good_records(q, False, True)
    return a.select("cluster_id", "qa_idx", F.lit("wrong").alias("rule")).union(b.select("cluster_id", "qa_idx", F.lit("specified").alias("rule")))


QUERIES = {
    "qa_prompts": q_qa_prompts,
    "zeroshot_prompts": q_zeroshot,
    "judge_prompts": q_judge,
    "article_prompts": q_article_prompts,
    "apply_supports": q_apply_supports,
    "response_counters": q_support_counts,
    "apply_openbook": q_apply_openbook,
    "apply_judgments": q_apply_judgments,
    "filled_counters": q_filled,
    "final_records": q_final,
    "nested_totals": q_totals,
    "support_pool": q_pool,
    "good_rules": q_either_good,
}
_Q = """(SELECT u.conv_id AS cluster_id, row_number() OVER (PARTITION BY u.conv_id ORDER BY u.turn) - 1 AS qa_idx, u.text AS question, a.text AS answer
  FROM (SELECT * FROM conversations WHERE role = 'user') u LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1)"""
_P = f"""(SELECT article_idx, cluster_id, qa_idx, question, answer, row_number() OVER (PARTITION BY article_idx ORDER BY cluster_id, qa_idx) - 1 AS p, count(*) OVER (PARTITION BY article_idx) AS n
  FROM (SELECT cluster_id * 3 + qa_idx AS article_idx, * FROM {_Q} UNION SELECT cluster_id, * FROM {_Q}) WHERE article_idx IN (SELECT doc_id FROM documents))"""
_NL = "chr(10)"
_YES = f"(SELECT cluster_id, qa_idx, article_idx FROM {_P} WHERE article_idx % 5 <> 0 AND article_idx % 7 <> 1 AND (article_idx + p) % 2 = 0)"
_J = f"""(SELECT cluster_id, qa_idx, CASE WHEN qa_idx % 2 = 0 THEN answer END AS zeroshot, CASE WHEN cluster_id % 4 <> 3 THEN cluster_id % 2 = 0 END AS is_correct,
  CASE WHEN cluster_id % 4 <> 3 THEN qa_idx % 3 = 0 END AS is_underspecified, question, answer FROM {_Q})"""
_SUP = f"(SELECT q.cluster_id, q.qa_idx, coalesce(string_agg(CAST(y.article_idx AS VARCHAR), ',' ORDER BY y.article_idx), '') AS supports FROM {_Q} q LEFT JOIN {_YES} y ON y.cluster_id = q.cluster_id AND y.qa_idx = q.qa_idx GROUP BY 1, 2)"
SQL = {
    "qa_prompts": f"""WITH c AS (SELECT source AS cluster_id, count(*) AS size, min(doc_id) AS o, list_sort(list(DISTINCT lang) FILTER (WHERE lang IS NOT NULL)) AS facts FROM documents WHERE source IS NOT NULL GROUP BY 1 HAVING count(lang) > 0),
r AS (SELECT *, row_number() OVER (ORDER BY size DESC, o) - 1 AS idx FROM c),
a AS (SELECT source AS cluster_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos, trim(text) AS text, source AS title FROM documents),
b AS (SELECT *, string_split(text, {_NL} || {_NL})[1] AS lede FROM a WHERE pos <= 50 AND text <> ''),
g AS (SELECT cluster_id, count(*) AS articles_used, string_agg('[Article ' || pos || ']' || {_NL} || 'Title: ' || title || {_NL} || 'Date: 2024-01-01' || {_NL} || CASE WHEN length(lede) > 512 THEN substr(lede, 1, 512) || '...' ELSE lede END, {_NL} || {_NL} || '---' || {_NL} || {_NL} ORDER BY pos) AS articles FROM b GROUP BY 1)
SELECT idx, sha256('Write question and answer pairs as JSON about these facts.' || {_NL} || {_NL} || 'Facts:' || {_NL} || array_to_string([i || '. ' || facts[i] FOR i IN range(1, len(facts) + 1)], {_NL}) || {_NL} || {_NL} || 'Articles:' || {_NL} || articles) AS prompt_sha,
  r.cluster_id, size AS article_count, articles_used, CAST(len(facts) AS BIGINT) AS facts_used FROM r JOIN g USING (cluster_id) WHERE idx < 500 AND articles_used >= 3""",
    "zeroshot_prompts": f"SELECT row_number() OVER (ORDER BY cluster_id, qa_idx) - 1 AS idx, md5('Answer in a few words.' || {_NL} || {_NL} || question) AS prompt_md5, cluster_id, qa_idx FROM {_Q} WHERE question <> ''",
    "judge_prompts": f"""SELECT dense_rank() OVER (ORDER BY cluster_id) - 1 AS idx, md5('Say for each id as JSON whether the response is right and whether the question says enough.' || {_NL} || {_NL} || '[' || string_agg('{{"id":' || (qa_idx + 1) || ',"question":"' || md5(question) || '"' || coalesce(',"answer":"' || md5(answer) || '"', '') || ',"response":"' || CASE WHEN qa_idx % 2 = 0 AND answer IS NOT NULL THEN md5(answer) ELSE '(no response)' END || '"}}', ',' ORDER BY qa_idx) || ']') AS prompt_md5, cluster_id, count(*) AS n_qas FROM {_Q} GROUP BY cluster_id""",
    "article_prompts": f"""SELECT row_number() OVER (ORDER BY article_idx) - 1 AS idx, md5('Does the article support each of the ' || n || ' answers? Give a JSON list of true and false.' || {_NL} || {_NL} || article || {_NL} || {_NL} || asked_and_said) AS support_md5,
  md5('Answer each question from the article as a JSON list of strings.' || {_NL} || {_NL} || article || {_NL} || {_NL} || asked) AS openbook_md5, article_idx, qas FROM (
  SELECT article_idx, any_value(n) AS n, any_value('Title: ' || coalesce(d.source, '') || {_NL} || 'Date: 2024-01-01' || {_NL} || 'Text: ' || trim(coalesce(d.text, ''), ' ' || {_NL} || chr(9) || chr(13))) AS article,
    string_agg('Question ' || (p + 1) || ': ' || coalesce(question, '') || {_NL} || 'Answer ' || (p + 1) || ': ' || coalesce(answer, ''), {_NL} || {_NL} ORDER BY p) AS asked_and_said,
    string_agg('Question ' || (p + 1) || ': ' || coalesce(question, ''), {_NL} || {_NL} ORDER BY p) AS asked, string_agg(cluster_id || ':' || qa_idx, ',' ORDER BY p) AS qas
  FROM {_P} JOIN documents d ON d.doc_id = article_idx GROUP BY article_idx)""",
    "apply_supports": f"SELECT * FROM {_SUP}",
    "response_counters": f"SELECT count(*) FILTER (WHERE article_idx % 5 <> 0 AND article_idx % 7 <> 1) AS parsed, count(*) FILTER (WHERE article_idx % 5 = 0 OR article_idx % 7 = 1) AS failed, count(*) AS n FROM (SELECT DISTINCT article_idx FROM {_P})",
    "apply_openbook": f"""SELECT q.cluster_id, q.qa_idx, coalesce(string_agg(x.article_idx || ':' || CASE WHEN (x.article_idx + x.p) % 3 = 0 THEN '' ELSE 'Said ' || q.qa_idx || '.' END || ':' ||
  CASE WHEN (x.article_idx + x.p) % 3 = 0 THEN 'false' WHEN starts_with(CAST(q.qa_idx AS VARCHAR), CAST(q.qa_idx % 2 AS VARCHAR)) THEN 'true' ELSE 'false' END, ',' ORDER BY x.article_idx), '') AS openbook
FROM {_Q} q LEFT JOIN {_P} x ON x.cluster_id = q.cluster_id AND x.qa_idx = q.qa_idx GROUP BY q.cluster_id, q.qa_idx""",
    "apply_judgments": f"SELECT cluster_id, qa_idx, is_correct, is_underspecified FROM {_J}",
    "filled_counters": f"SELECT 'zeroshot' AS \"column\", count(zeroshot) AS filled, count(*) - count(zeroshot) AS missing FROM {_J} UNION ALL SELECT 'is_correct', count(is_correct), count(*) - count(is_correct) FROM {_J}",
    "final_records": f"""SELECT j.cluster_id, j.qa_idx, md5(coalesce(zeroshot, '')) AS closed_md5, is_correct AS closed_correct, supports,
  CASE WHEN j.cluster_id % 3 = 0 THEN '' WHEN j.qa_idx % 2 = 0 THEN j.cluster_id || ':x,' || (j.cluster_id + 1) || ':y' ELSE (j.cluster_id + 1) || ':y' END AS openbook
FROM {_J} j JOIN {_SUP} s ON s.cluster_id = j.cluster_id AND s.qa_idx = j.qa_idx WHERE is_correct IS NOT DISTINCT FROM false AND is_underspecified IS NOT DISTINCT FROM false""",
    "nested_totals": f"SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS records, (SELECT count(question) FROM {_Q}) AS items, (SELECT count(DISTINCT conv_id) FROM conversations) - (SELECT count(DISTINCT cluster_id) FROM {_Q} WHERE question IS NOT NULL) AS empty",
    "support_pool": f"SELECT DISTINCT article_idx FROM {_YES}",
    "good_rules": f"SELECT cluster_id, qa_idx, 'wrong' AS rule FROM {_J} WHERE is_correct = false UNION ALL SELECT cluster_id, qa_idx, 'specified' FROM {_J} WHERE is_underspecified = false",
}
