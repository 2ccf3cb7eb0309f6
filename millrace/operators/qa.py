"""Question/answer records: verdict joins, filters, supports, unpivoting, counters, duplicate names."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.features import question_to_feature
from millrace.functions.text import answers_match, normalize_answer
from millrace.operators.cleaning import dense_id
from millrace.operators.statistics import rounded
from millrace.sources import table


def is_good(correct: Column, under: Column) -> Column:
    """Answered wrongly without help and not underspecified; a missing verdict is not good."""
    return correct.eqNullSafe(F.lit(False)) & under.eqNullSafe(F.lit(False))


def attach(qas: DataFrame, answers: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """Left join on the key; of several answers the last in order wins, of none null."""
    return qas.join(answers.groupBy(*key).agg(F.max_by(value, order).alias(value)), key, "left")


def exclusive_counts(df: DataFrame, correct: str, under: str) -> DataFrame:
    """Rows per outcome, each in the first that applies."""
    c, u = F.col(correct), F.col(under)
    out = F.when(is_good(c, u), "kept").when(c & u, "both").when(u, "underspecified_only").when(c, "correct_only").otherwise("unjudged")
    return df.groupBy(out.alias("outcome")).agg(F.count("*").alias("n"))


def inverted_index(facts: DataFrame, entity: str, feature: str, doc: str) -> DataFrame:
    """Sorted distinct documents of each (entity, feature); null parts are skipped.

    Rows are made distinct before they are gathered, so a repeated row costs nothing further.
    """
    d = facts.where(F.col(entity).isNotNull() & F.col(feature).isNotNull() & F.col(doc).isNotNull()).select(entity, feature, doc).distinct()
    return d.groupBy(entity, feature).agg(F.sort_array(F.collect_list(doc)).alias("docs"))


def union_supports(index: DataFrame, wanted: DataFrame, entity: str, feature: str) -> DataFrame:
    """``wanted(entity, label, feature)``: the union of documents over a label's features, sorted."""
    hit = wanted.join(index, [entity, feature], "left").select(entity, "label", F.explode_outer("docs").alias("doc"))
    return hit.groupBy(entity, "label").agg(F.sort_array(F.collect_set("doc")).alias("supports"))


def filter_supports(records: DataFrame, key: str, array: str, allowed: DataFrame, item: str) -> DataFrame:
    """Each record's array without the items that are not allowed, order kept."""
    one = records.select(key, F.posexplode(array).alias("p", item))
    kept = one.join(allowed.select(item).distinct(), item, "left_semi").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("p", item))).alias("k"))
    out = records.join(kept, key, "left")
    return out.withColumn(array, F.coalesce(F.transform("k", lambda x: x[item]), F.slice(F.col(array), 1, 0))).drop("k")


def zip_verdicts(df: DataFrame, tags: str, verdicts: str) -> DataFrame:
    """One row per tag with the verdict at its place; a row whose arrays differ in length, or are empty, is discarded whole."""
    ok = df.where((F.size(tags) == F.size(verdicts)) & (F.size(tags) > 0))
    rest = [c for c in df.columns if c not in (tags, verdicts)]
    return ok.select(*rest, F.explode(F.arrays_zip(F.col(tags).alias("tag"), F.col(verdicts).alias("verdict"))).alias("z")).select(*rest, "z.tag", "z.verdict")


def unpivot(entities: DataFrame, key: str, name: str, asked: dict[str, Column]) -> DataFrame:
    """One question and answer per entity and attribute."""
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.concat(F.lit(f"What is the {f} of "), F.col(name), F.lit("?")).alias("question"), a.cast("string").alias("answer")) for f, a in asked.items()])
    return entities.select(key, F.posexplode(rows).alias("qa_idx", "q")).select(key, "qa_idx", "q.feature", "q.question", "q.answer")


def duplicate_values(df: DataFrame, value: str, line: str) -> DataFrame:
    """Values on more than one line, with the number of lines."""
    return df.groupBy(value).agg(F.count_distinct(line).alias("n_lines")).where("n_lines > 1")


def requery_ids(df: DataFrame, value: str, line: str) -> DataFrame:
    """Lines that repeat a value of an earlier line: those must be named again."""
    first = df.groupBy(value).agg(F.min(line).alias("first"))
    return df.join(first, value).where(F.col(line) > F.col("first")).select(line).distinct()


def islands(df: DataFrame, idx: str) -> DataFrame:
    """Runs of consecutive numbers: first, last and length.

    A number without its predecessor begins a run and one without its successor ends one; both lists
    are numbered in order, and the k-th first meets the k-th last. Joins and range partitions only:
    no window spans the table. Nulls and repeats do not count; an empty table gives no rows.
    """
    d = df.select(F.col(idx).cast("long").alias("x")).where("x IS NOT NULL").distinct()
    first = d.join(d.select((F.col("x") + 1).alias("x")), "x", "left_anti")
    last = d.join(d.select((F.col("x") - 1).alias("x")), "x", "left_anti")
    a = dense_id(first.withColumnRenamed("x", "first"), ["first"], "k")
    z = dense_id(last.withColumnRenamed("x", "last"), ["last"], "k")
    return a.join(z, "k").select("first", "last", (F.col("last") - F.col("first") + 1).alias("length"))


def repeated_tuples(df: DataFrame, line: str, pos: str, value: str) -> DataFrame:
    """Tuples of a line's values by place that several lines of two members or more share: ``values, lines``."""
    t = df.groupBy(line).agg(F.sort_array(F.collect_list(F.struct(pos, F.col(value).alias("v")))).alias("x")).where(F.size("x") > 1)
    t = t.select(line, F.transform("x", lambda e: e["v"]).alias("values"))
    return t.groupBy("values").agg(F.sort_array(F.collect_set(line)).alias("lines")).where(F.size("lines") > 1)


def name_again(df: DataFrame, value: str, line: str) -> tuple[DataFrame, DataFrame]:
    """Lines that repeat a value of an earlier line, and the values that they must not take: those of all other lines."""
    again = requery_ids(df.where(F.col(value).isNotNull() & (F.col(value) != "")), value, line)
    taken = df.join(again, line, "left_anti").where(F.col(value).isNotNull() & (F.col(value) != "")).select(value).distinct()
    return again, taken


def _judged(s, d):
    return table(s, d, "documents").select("doc_id", "lang").join(table(s, d, "labels"), "doc_id", "left").select("doc_id", "lang", (F.col("quality") == 1).alias("correct"), (F.col("toxic") == 1).alias("under"))


def _index(s, d):
    return inverted_index(table(s, d, "lineitem"), "l_partkey", "l_returnflag", "l_orderkey")


def _wanted(s, d):
    f = F.explode(F.array(F.struct(F.lit("open").alias("label"), F.lit("N").alias("l_returnflag")), F.struct(F.lit("closed").alias("label"), F.lit("A").alias("l_returnflag")), F.struct(F.lit("closed").alias("label"), F.lit("R").alias("l_returnflag"))))
    return table(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), f.alias("f")).select("l_partkey", "f.label", "f.l_returnflag")


def q_index(s, d):
    return _index(s, d).select("l_partkey", "l_returnflag", F.size("docs").cast("long").alias("n"), F.md5(F.array_join(F.transform("docs", lambda x: x.cast("string")), ",")).alias("docs_md5"))


def q_supports(s, d):
    out = union_supports(_index(s, d), _wanted(s, d), "l_partkey", "l_returnflag")
    return out.select("l_partkey", "label", F.size("supports").cast("long").alias("n"), F.md5(F.array_join(F.transform("supports", lambda x: x.cast("string")), ",")).alias("supports_md5"))


def q_filter_supports(s, d):
    rec = union_supports(_index(s, d), _wanted(s, d), "l_partkey", "l_returnflag").where("label = 'closed'").select("l_partkey", "supports")
    allowed = table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("item"))
    out = filter_supports(rec, "l_partkey", "supports", allowed, "item")
    return out.select("l_partkey", F.array_join(F.transform("supports", lambda x: x.cast("string")), ",").alias("supports"))


def q_support_stats(s, d):
    out = union_supports(_index(s, d), _wanted(s, d), "l_partkey", "l_returnflag").select("label", F.size("supports").alias("n"))
    p = lambda q: F.percentile("n", F.lit(q))
    return rounded(out.groupBy("label").agg(F.count("*").alias("n_qas"), F.avg("n").alias("mean"), F.stddev_pop("n").alias("std"), F.min("n").alias("min"), p(0.25).alias("p25"), p(0.5).alias("median"), p(0.75).alias("p75"), F.max("n").alias("max"), F.count_if(F.col("n") == 0).alias("n_zero")))


def q_unpivot(s, d):
    asked = {"brand": F.col("p_brand"), "type": F.col("p_type"), "size": F.col("p_size")}
    return unpivot(table(s, d, "part"), "p_partkey", "p_name", asked)


def q_question_features(s, d):
    asked = {"weight": F.col("p_size"), "special attack stat": F.col("p_size"), "attack stat": F.col("p_size"), "HP stat": F.col("p_size"), "move": F.col("p_type"), "colour": F.col("p_brand")}
    return unpivot(table(s, d, "part"), "p_partkey", "p_name", asked).groupBy(question_to_feature("question").alias("feature")).agg(F.count("*").alias("n"))


def _names(s, d):
    return table(s, d, "part").select(F.col("p_type").alias("name"), F.floor(F.col("p_partkey") / 3).cast("long").alias("line"))


def _turns(s, d):
    c = table(s, d, "conversations")
    a = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("given"))
    return a.join(c.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("said")), ["conv_id", "turn"], "left")


def q_openbook(s, d):
    # whole answers: the question itself, or, on every other asking, the reply's first sentence in other clothes
    given = F.when(F.col("turn") % 4 == 1, F.concat(F.lit(" "), F.substring_index("said", ".", 1), F.lit("?!"))).otherwise(F.col("given"))
    t = _turns(s, d).withColumn("is_correct", F.coalesce(answers_match(given, "said"), F.lit(False)))
    return t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "is_correct"))).alias("x")).select("conv_id", F.array_join(F.transform("x", lambda e: F.concat(e["turn"].cast("string"), F.lit(":"), e["is_correct"].cast("string"))), ",").alias("openbook"))


def q_positional_zip(s, d):
    c = table(s, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("role") == "user", F.col("turn")))).alias("tags"), F.sort_array(F.collect_list(F.when(F.col("role") == "assistant", F.col("turn")))).alias("verdicts"))
    return zip_verdicts(c, "tags", "verdicts")


QUERIES = {
    "good_filter_3vl": lambda s, d: _judged(s, d).where(is_good(F.col("correct"), F.col("under"))).select("doc_id"),
    "exclusive_counters": lambda s, d: exclusive_counts(_judged(s, d), "correct", "under"),
    "inverted_index": q_index,
    "support_union": q_supports,
    "filter_supports": q_filter_supports,
    "support_stats": q_support_stats,
    "unpivot_qa": q_unpivot,
    "question_features": q_question_features,
    "openbook_match": q_openbook,
    "normalize_answer": lambda s, d: table(s, d, "conversations").select("conv_id", "turn", F.md5(normalize_answer("text")).alias("answer_md5")),
    "positional_zip": q_positional_zip,
    "attach_last": lambda s, d: attach(table(s, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey")), table(s, d, "events"), ["user_id"], "event_type", "event_id"),
    "dup_names": lambda s, d: duplicate_values(table(s, d, "documents").select(F.md5("text").alias("name"), "doc_id"), "name", "doc_id"),
    "requery_ids": lambda s, d: requery_ids(table(s, d, "documents").select("text", "doc_id"), "text", "doc_id"),
    "repeated_tuples": lambda s, d: repeated_tuples(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_orderkey", "l_linenumber", "l_returnflag").select(F.array_join("values", "").alias("flags"), F.size("lines").cast("long").alias("n_lines"), F.md5(F.array_join(F.transform("lines", lambda x: x.cast("string")), ",")).alias("lines_md5")),
    "forbidden_names": lambda s, d: name_again(_names(s, d), "name", "line")[1],
    "islands": lambda s, d: islands(table(s, d, "labels"), "doc_id"),
}
_JUDGED = "(SELECT d.doc_id, lang, quality = 1 AS correct, toxic = 1 AS under FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_W = "(SELECT p_partkey AS l_partkey, label, l_returnflag FROM part, (VALUES ('open', 'N'), ('closed', 'A'), ('closed', 'R')) v(label, l_returnflag))"
_S = f"(SELECT l_partkey, label, list_sort(list(DISTINCT l_orderkey) FILTER (WHERE l_orderkey IS NOT NULL)) AS s FROM {_W} LEFT JOIN lineitem USING (l_partkey, l_returnflag) GROUP BY 1, 2)"
_NORM = "trim(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '[!-/:-@\\[-`{{-~]', '', 'g'), '\\s+', ' ', 'g'))"
_N = lambda c: _NORM.format(c)
SQL = {
    "good_filter_3vl": f"SELECT doc_id FROM {_JUDGED} WHERE correct IS NOT DISTINCT FROM false AND under IS NOT DISTINCT FROM false",
    "exclusive_counters": f"SELECT CASE WHEN correct = false AND under = false THEN 'kept' WHEN correct AND under THEN 'both' WHEN under THEN 'underspecified_only' WHEN correct THEN 'correct_only' ELSE 'unjudged' END AS outcome, count(*) AS n FROM {_JUDGED} GROUP BY 1",
    "inverted_index": "SELECT l_partkey, l_returnflag, count(DISTINCT l_orderkey) AS n, md5(array_to_string(list_sort(list(DISTINCT l_orderkey)), ',')) AS docs_md5 FROM lineitem GROUP BY 1, 2",
    "support_union": f"SELECT l_partkey, label, coalesce(len(s), 0) AS n, md5(coalesce(array_to_string(s, ','), '')) AS supports_md5 FROM {_S}",
    "filter_supports": f"SELECT l_partkey, coalesce(array_to_string(list_filter(s, lambda x: list_contains(ok, x)), ','), '') AS supports FROM {_S}, (SELECT list(o_orderkey) AS ok FROM orders WHERE o_orderstatus = 'F') WHERE label = 'closed'",
    "support_stats": f"SELECT label, count(*) AS n_qas, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std, min(n) AS min, round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.75), 6) AS p75, max(n) AS max, count(*) FILTER (WHERE n = 0) AS n_zero FROM (SELECT label, CAST(coalesce(len(s), 0) AS INTEGER) AS n FROM {_S}) GROUP BY label",
    "unpivot_qa": " UNION ALL ".join(f"SELECT p_partkey, CAST({i} AS INTEGER) AS qa_idx, '{f}' AS feature, 'What is the {f} of ' || p_name || '?' AS question, CAST({c} AS VARCHAR) AS answer FROM part" for i, (f, c) in enumerate((("brand", "p_brand"), ("type", "p_type"), ("size", "p_size")))),
    "question_features": "SELECT f AS feature, count(*) AS n FROM part, (VALUES ('weight'), ('special attack'), ('attack'), ('hp'), ('move'), ('unknown')) v(f) GROUP BY f",
    "openbook_match": f"""SELECT conv_id, string_agg(turn || ':' || coalesce(g <> '' AND p <> '' AND (contains(p, g) OR contains(g, p)), false), ',' ORDER BY turn) AS openbook FROM (
SELECT conv_id, turn, {_N('given')} AS g, {_N('said')} AS p FROM (
SELECT u.conv_id, u.turn + 1 AS turn, a.text AS said, CASE WHEN (u.turn + 1) % 4 = 1 THEN ' ' || string_split(a.text, '.')[1] || '?!' ELSE u.text END AS given
FROM (SELECT * FROM conversations WHERE role = 'user') u LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1)) GROUP BY conv_id""",
    "normalize_answer": f"SELECT conv_id, turn, md5({_N('text')}) AS answer_md5 FROM conversations",
    "positional_zip": "SELECT conv_id, unnest(t) AS tag, unnest(v) AS verdict FROM (SELECT conv_id, list_sort(list(turn) FILTER (WHERE role = 'user')) AS t, list_sort(list(turn) FILTER (WHERE role = 'assistant')) AS v FROM conversations GROUP BY 1) WHERE len(t) = len(v) AND len(t) > 0",
    "attach_last": "SELECT c_custkey AS user_id, c_nationkey, e.event_type FROM customer LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1) e ON e.user_id = c_custkey",
    "dup_names": "SELECT md5(text) AS name, count(DISTINCT doc_id) AS n_lines FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id) > 1",
    "requery_ids": "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r > 1",
    "repeated_tuples": "SELECT f AS flags, count(*) AS n_lines, md5(string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey)) AS lines_md5 FROM (SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_returnflag) AS f FROM lineitem GROUP BY 1 HAVING count(*) > 1) GROUP BY 1 HAVING count(*) > 1",
    "forbidden_names": """WITH n AS (SELECT p_type AS name, p_partkey // 3 AS line FROM part), f AS (SELECT name, min(line) AS first FROM n GROUP BY 1), a AS (SELECT DISTINCT line FROM n JOIN f USING (name) WHERE line > first)
SELECT DISTINCT name FROM n WHERE line NOT IN (SELECT line FROM a)""",
    "islands": "SELECT min(doc_id) AS first, max(doc_id) AS last, count(*) AS length FROM (SELECT doc_id, doc_id - row_number() OVER (ORDER BY doc_id) AS g FROM (SELECT DISTINCT doc_id FROM labels)) GROUP BY g",
}
