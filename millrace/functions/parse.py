"""Parsing model responses: JSON inside prose, as VARIANT expressions without Python."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.features import normalize_info, parse_info
from millrace.functions.text import SPACES, strip


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_fences(c: Column | str) -> Column:
    """Without a code fence around the whole response."""
    s = F.regexp_replace(strip(_c(c)), rf"^```(?:json)?[{SPACES}]*", "")
    return strip(F.regexp_replace(s, rf"[{SPACES}]*```\z", ""))


def _nonempty(s: Column) -> Column:
    return F.when(s != "", s)


def bracketed(c: Column) -> Column:
    """From the first [ to the last ]; null without."""
    return _nonempty(F.regexp_extract(c, r"(?s)\[.*\]", 0))


def braced(c: Column) -> Column:
    return _nonempty(F.regexp_extract(c, r"(?s)\{.*\}", 0))


def json_list(c: Column) -> Column:
    """array<variant> of a JSON array; null if it is no JSON or no array."""
    v = F.try_parse_json(c)
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def parse_response(c: Column | str) -> Column:
    """A response as VARIANT: whole, or from its first [ to its last ]; null if neither is JSON."""
    s = strip(_c(c))
    s = F.when(s.startswith("```json"), F.substring(s, 8, 2147483647)).when(s.startswith("```"), F.substring(s, 4, 2147483647)).otherwise(s)
    s = strip(F.regexp_replace(s, r"```\z", ""))
    return F.coalesce(F.try_parse_json(s), F.try_parse_json(bracketed(s)))


def parse_facts(c: Column | str) -> Column:
    """array<string> of facts: a JSON list of strings, or else lines above 20 characters without bullets."""
    text = strip(F.coalesce(_c(c), F.lit("")))
    items = json_list(bracketed(text))
    all_text = F.forall(items, lambda x: F.schema_of_variant(x) == "STRING")
    given = F.filter(F.transform(items, lambda x: strip(F.try_variant_get(x, "$", "string"))), lambda x: x != "")
    bare = F.transform(F.split(F.regexp_replace(text, r"\r\n?|[\x0b\x0c\x1c-\x1e\x85  ]", "\n"), "\n"), lambda x: F.regexp_replace(F.regexp_replace(strip(x), rf"^[0-9]+[.)][{SPACES}]*", ""), rf"^[-*•][{SPACES}]*", ""))
    lines = F.filter(bare, lambda x: F.length(x) > 20)
    empty = F.array().cast("array<string>")
    return F.when(text == "", empty).when(items.isNotNull() & all_text, given).otherwise(lines)


QA = "array<struct<question:string,answer:string,root_articles_ids:array<bigint>>>"


def parse_qas(c: Column | str) -> Column:
    """The question/answer objects of a response; the older name of the id list is accepted."""
    v = F.try_parse_json(braced(strip_fences(F.coalesce(_c(c), F.lit("")))))
    items = F.try_variant_get(v, "$.qas", "array<variant>")
    ids = lambda x: F.coalesce(F.try_variant_get(x, "$.root_articles_ids", "array<bigint>"), F.try_variant_get(x, "$.supporting_articles_ids", "array<bigint>"))
    good = F.filter(items, lambda x: _has(x, "question") & _has(x, "answer"))
    out = F.transform(good, lambda x: F.struct(F.try_variant_get(x, "$.question", "string").alias("question"), F.try_variant_get(x, "$.answer", "string").alias("answer"), ids(x).alias("root_articles_ids")))
    return F.coalesce(out, F.array().cast(QA))


def _has(x: Column, name: str) -> Column:
    return F.coalesce(F.try_variant_get(x, f"$.{name}", "variant").isNotNull(), F.lit(False))


VERDICT = "array<struct<id:bigint,is_correct:boolean,is_underspecified:boolean>>"


def parse_judgments(c: Column | str) -> Column:
    """The verdict objects of a response that have an id."""
    items = json_list(bracketed(strip_fences(F.coalesce(_c(c), F.lit("")))))
    out = F.transform(F.filter(items, lambda x: _has(x, "id")), lambda x: F.struct(F.try_variant_get(x, "$.id", "string").try_cast("bigint").alias("id"), F.try_variant_get(x, "$.is_correct", "boolean").alias("is_correct"), F.try_variant_get(x, "$.is_underspecified", "boolean").alias("is_underspecified")))
    return F.coalesce(out, F.array().cast(VERDICT))


def _uncommented(c: Column | str) -> Column:
    return json_list(F.regexp_replace(bracketed(strip_fences(F.coalesce(_c(c), F.lit("")))), r"#[^\n]*", ""))


def parse_bools(c: Column | str) -> Column:
    """A response's array by truthiness: false are false, null, 0, "", [] and {}; comments are cut."""
    falsy = F.array(*map(F.lit, ["false", "null", "0", "0.0", "-0", '""', "[]", "{}"]))
    out = F.transform(_uncommented(c), lambda x: ~F.array_contains(falsy, F.coalesce(F.to_json(x), F.lit("null"))))
    return F.coalesce(out, F.array().cast("array<boolean>"))


def parse_strings(c: Column | str) -> Column:
    """A response's array as stripped strings; null is empty, true and false are capitalised."""

    def one(x: Column) -> Column:
        kind = F.schema_of_variant(x)
        return F.when(kind == "VOID", "").when(kind == "BOOLEAN", F.initcap(F.try_variant_get(x, "$", "string"))).when(kind == "STRING", strip(F.try_variant_get(x, "$", "string"))).otherwise(F.to_json(x))

    return F.coalesce(F.transform(_uncommented(c), one), F.array().cast("array<string>"))


def parse_lines(c: Column | str, need: tuple[str, ...]) -> Column:
    """array<variant> of one-object lines that hold all ``need``ed names; fences are skipped. If no
    line does, the objects of the response's array that hold the first."""
    lines = F.filter(F.transform(F.split(F.coalesce(_c(c), F.lit("")), "\n"), strip), lambda x: (x != "") & ~x.startswith("```"))
    found = F.filter(F.transform(lines, F.try_parse_json), lambda v: v.isNotNull() & _all(v, need))
    whole = F.filter(F.try_variant_get(parse_response(c), "$", "array<variant>"), lambda v: _has(v, need[0]))
    return F.when(F.size(found) > 0, found).otherwise(F.coalesce(whole, F.array().cast("array<variant>")))


def _all(v: Column, names: tuple[str, ...]) -> Column:
    out = _has(v, names[0])
    for n in names[1:]:
        out = out & _has(v, n)
    return out


#: Names of the feature lists of a response's items, by the place of the entity in the tag.
INFO_KEYS = ("g1_info", "g2_info", "g3_info")


def corpus_records(responses: DataFrame, kind: str) -> DataFrame:
    """``responses(tag array<long>, response)`` -> ``text, tag array<struct<idx, info>>, type``.

    Every object with a text in a response that parses is an article; the features of the i-th
    entity of the tag are read from the i-th of INFO_KEYS, a list or a JSON list in a string, and
    from none beyond. Responses that do not parse give no rows (``parse_counts`` counts them).
    """
    items = F.try_variant_get(parse_response("response"), "$", "array<variant>")
    one = responses.select("tag", F.explode(items).alias("item")).where(_has(F.col("item"), "text"))

    def info(key: str) -> Column:
        given = F.try_variant_get("item", f"$.{key}", "variant")
        listed = F.transform(F.try_variant_get(given, "$", "array<variant>"), lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
        text = F.when(F.schema_of_variant(given) == "STRING", F.try_variant_get(given, "$", "string"))
        return F.coalesce(normalize_info(listed), parse_info(text), F.array().cast("array<string>"))

    lists = F.array(*map(info, INFO_KEYS))
    tag = F.transform("tag", lambda idx, i: F.struct(idx.alias("idx"), F.coalesce(F.get(F.col("lists"), i), F.array().cast("array<string>")).alias("info")))
    return one.withColumn("lists", lists).select(F.try_variant_get("item", "$.text", "string").alias("text"), tag.alias("tag"), F.lit(kind).alias("type"))


def parse_counts(responses: DataFrame) -> DataFrame:
    """``parsed, failed, n`` of ``responses(response)``: one aggregate."""
    v = parse_response("response")
    return responses.agg(F.count_if(v.isNotNull()).alias("parsed"), F.count_if(v.isNull()).alias("failed"), F.count("*").alias("n"))
