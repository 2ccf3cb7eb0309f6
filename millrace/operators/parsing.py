"""Queries that apply the response parsers and feature names to records made from the tables."""

from pyspark.sql import functions as F

from millrace.functions import parse
from millrace.functions.features import normalize_feature, parse_info
from millrace.sources import table


def _shape(*shapes):
    """One of several shapes of a response, by event."""
    return F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in shapes]), (F.col("event_id") % len(shapes) + 1).cast("int"))


def _id(before: str, after: str = ""):
    return F.concat(F.lit(before), F.col("event_id").cast("string"), F.lit(after))


def q_json_props(s, d):
    v = F.try_parse_json("props")
    return table(s, d, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.try_variant_get(v, "$.none", "string").alias("none"))


def q_parse_judgments(s, d):
    click = F.when(F.col("event_type") == "click", "true").otherwise("false")
    fenced = F.concat(_id('```json\n[{"id": '), F.lit(', "is_correct": '), click, F.lit("}]\n```"))
    prose = _id('My verdicts: [{"id": 1, "is_correct": true, "is_underspecified": false}, {"x": 2}, {"id": "', '"}] as asked')
    broken = _id('[{"id": ', ", ")
    text_id = F.lit('[{"id": "seven", "is_underspecified": true}]')
    r = _shape(fenced, prose, broken, text_id, "", "null", '{"id": 3}')
    return table(s, d, "events").select("event_id", F.explode(parse.parse_judgments(r)).alias("j")).select("event_id", "j.id", "j.is_correct", "j.is_underspecified")


def q_parse_bools(s, d):
    mixed = _id('so [true, false, null, 0, "x", ', '] # end')
    r = _shape(mixed, "```json\n[false, true]\n```", '["false", "", [], {}, [0], {"a": 1}, 0.0, -1]', "no list", "[true, ", "[true # yes\n, false]")
    return table(s, d, "events").select("event_id", F.array_join(F.transform(parse.parse_bools(r), lambda x: x.cast("string")), ",").alias("flags"))


def q_parse_strings(s, d):
    r = _shape(_id('["  a ", null, true, ', "]"), '```\n["b"]\n```', '["a # b"]', "none", '[["x"], {"y": 1}]', '[" ", "é\\n"]')
    return table(s, d, "events").select("event_id", F.array_join(parse.parse_strings(r), "|").alias("texts"))


def q_parse_facts(s, d):
    lines = F.concat(F.lit("1. A first fact about "), F.col("event_type"), F.lit("\n- "), F.col("event_type"), _id("\n* the second fact is number "))
    r = _shape(lines, _id('Facts: ["first ', '", " second ", ""] that is all'), "[]", '["a fact", 2]\n2) a line that is long enough to be kept', "", "[broken, but this line is long enough")
    return table(s, d, "events").select("event_id", F.array_join(parse.parse_facts(r), "|").alias("facts"))


def q_parse_qas(s, d):
    prose = F.concat(_id('Here: {"qas": [{"question": "q'), F.lit('", "answer": "'), F.col("event_type"), F.lit('", "supporting_articles_ids": [1, 2]}, {"question": "no answer"}]} done'))
    fenced = _id('```json\n{"qas": [{"question": "a", "answer": "b", "root_articles_ids": [', ']}, {"question": "c", "answer": "d"}]}\n```')
    r = _shape(prose, fenced, '{"qas": []}', '{"other": 1}', "nothing", '{"qas": [{"question": "x", ')
    return table(s, d, "events").select("event_id", F.explode(parse.parse_qas(r)).alias("q")).select("event_id", "q.question", "q.answer", F.array_join(F.transform("q.root_articles_ids", lambda x: x.cast("string")), ",").alias("ids"))


def q_parse_response(s, d):
    r = _shape(_id('```json\n{"a": ', "}\n```"), _id("words [1, ", "] more"), "[1, 2", "", "```\n[3]\n```", '"text"')
    return table(s, d, "events").select("event_id", F.to_json(parse.parse_response(r)).alias("json"))


def q_parse_names(s, d):
    lines = _id('```\n{"name": "N', '", "classification": "c"}\n{"name": "only"}\n{"name": "M", "classification": "d"}\n```')
    r = _shape(lines, '[{"name": "A"}, {"other": 1}, {"name": "B", "classification": "x"}]', "none", "")
    names = F.transform(parse.parse_lines(r, ("name", "classification")), lambda v: F.concat_ws("/", F.try_variant_get(v, "$.name", "string"), F.try_variant_get(v, "$.classification", "string")))
    return table(s, d, "events").select("event_id", F.array_join(names, "|").alias("names"))


def q_corpus_records(s, d):
    """Two articles of an event's response, one of them without a text; features by the place of the tag."""
    item = F.concat(_id('[{"text": "article '), F.lit('", "g1_info": ["HP", "junk", "hp"], "g2_info": "[\\"speed\\"]", "g4_info": ["name"]}, {"title": "no text"}]'))
    r = _shape(item, F.concat(F.lit("```json\n"), item, F.lit("\n```")), "broken [", "")
    tag = F.array(F.col("event_id"), F.col("user_id"), F.lit(7).cast("long"), F.lit(8).cast("long"))
    e = table(s, d, "events").select(tag.alias("tag"), r.alias("response"))
    out = parse.corpus_records(e, "wiki")
    text = F.array_join(F.transform("tag", lambda t: F.concat_ws(":", t["idx"].cast("string"), F.array_join(t["info"], "+"))), "|")
    return out.select("text", text.alias("tag"), "type")


def q_response_failures(s, d):
    r = _shape("[1]", '{"a": 1}', "broken [", "", "x [2] y")
    return parse.parse_counts(table(s, d, "events").select(r.alias("response")))


def q_features(s, d):
    raw = F.element_at(F.array(*map(F.lit, [" G1_Attack ", "stats.hp", "move_info.name", "special_attack", "junk", "Speeed", "type_2"])), (F.col("event_id") % 7 + 1).cast("int"))
    info = F.concat(F.lit('["'), raw, F.lit('", "hp", "nothing", "HP"]'))
    return table(s, d, "events").select(normalize_feature(raw).alias("feature"), F.array_join(parse_info(info), ",").alias("info")).groupBy("feature", "info").agg(F.count("*").alias("n"))


QUERIES = {"json_props": q_json_props, "parse_judgments": q_parse_judgments, "parse_bools": q_parse_bools, "parse_facts": q_parse_facts, "parse_qas": q_parse_qas, "parse_strings": q_parse_strings, "parse_response": q_parse_response, "parse_names": q_parse_names, "corpus_records": q_corpus_records, "response_failures": q_response_failures, "feature_names": q_features}
SQL = {
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS none FROM events",
    "parse_judgments": """SELECT event_id, event_id AS id, event_type = 'click' AS is_correct, CAST(NULL AS BOOLEAN) AS is_underspecified FROM events WHERE event_id % 7 = 0
UNION ALL SELECT event_id, 1, true, false FROM events WHERE event_id % 7 = 1 UNION ALL SELECT event_id, event_id, NULL, NULL FROM events WHERE event_id % 7 = 1
UNION ALL SELECT event_id, NULL, NULL, true FROM events WHERE event_id % 7 = 3""",
    "parse_bools": "SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'true,false,false,false,true,' || CASE WHEN event_id = 0 THEN 'false' ELSE 'true' END WHEN 1 THEN 'false,true' WHEN 2 THEN 'true,false,false,false,true,true,false,true' WHEN 5 THEN 'true,false' ELSE '' END AS flags FROM events",
    "parse_strings": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'a||True|' || event_id WHEN 1 THEN 'b' WHEN 4 THEN '["x"]|{"y":1}' WHEN 5 THEN '|é' ELSE '' END AS texts FROM events""",
    "parse_facts": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'A first fact about ' || event_type || CASE WHEN length(event_type) > 20 THEN '|' || event_type ELSE '' END || '|the second fact is number ' || event_id
  WHEN 1 THEN 'first ' || event_id || '|second' WHEN 3 THEN 'a line that is long enough to be kept' WHEN 5 THEN '[broken, but this line is long enough' ELSE '' END AS facts FROM events""",
    "parse_qas": """SELECT event_id, 'q' || event_id AS question, event_type AS answer, '1,2' AS ids FROM events WHERE event_id % 6 = 0
UNION ALL SELECT event_id, 'a', 'b', CAST(event_id AS VARCHAR) FROM events WHERE event_id % 6 = 1 UNION ALL SELECT event_id, 'c', 'd', NULL FROM events WHERE event_id % 6 = 1""",
    "parse_response": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN '{"a":' || event_id || '}' WHEN 1 THEN '[1,' || event_id || ']' WHEN 4 THEN '[3]' WHEN 5 THEN '"text"' END AS json FROM events""",
    "parse_names": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'N' || event_id || '/c|M/d' WHEN 1 THEN 'A|B/x' ELSE '' END AS names FROM events",
    "corpus_records": "SELECT 'article ' || event_id AS text, event_id || ':hp|' || user_id || ':speed|7:|8:' AS tag, 'wiki' AS type FROM events WHERE event_id % 4 < 2",
    "response_failures": "SELECT count(*) FILTER (WHERE event_id % 5 IN (0, 1, 4)) AS parsed, count(*) FILTER (WHERE event_id % 5 IN (2, 3)) AS failed, count(*) AS n FROM events",
    "feature_names": """SELECT f AS feature, CASE WHEN f = 'hp' OR f IS NULL THEN 'hp' ELSE f || ',hp' END AS info, count(*) AS n FROM (
SELECT ['attack', 'hp', 'move.name', 'special attack', NULL, 'speed', 'type2'][event_id % 7 + 1] AS f FROM events) GROUP BY 1, 2""",
}
