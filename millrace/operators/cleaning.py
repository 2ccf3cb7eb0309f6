"""Cleaning, validity, exact duplicates, dense numbering."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import SPACES_RE2, build_text, clean_text, collapse_spaces, is_valid, truncate_words, word_count
from millrace.operators.dedup import near_dedup
from millrace.plans.names import fresh, quoted
from millrace.plans.work import written
from millrace.sources import table


def dense_id(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """Adds 0, 1, 2, .. in the given order without bringing all rows to one task.

    Rows are range-partitioned and sorted; each partition's rows are counted and the running sum of
    the counts, one row a partition, is added to the place within the partition.

    Nulls come first, as Spark sorts them; rows that tie are numbered in any order. Repeated rows
    are numbered one by one; a column called ``name`` is replaced, all others are kept. An empty
    table gives no rows.
    """
    df = df.drop(name)
    at, part, before = fresh(df, "at", "part", "before")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    placed = written(placed.withColumn(part, F.shiftright(at, 33)), "placed")
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"))
    sums = sizes.select(part, (F.sum("n").over(W.orderBy(part)) - F.col("n")).alias(before))
    place = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(sums), part).select(*quoted(*df.columns), (F.col(before) + place).alias(name))


def clean_articles(docs: DataFrame) -> DataFrame:
    """``text`` and ``title`` cleaned; nulls are empty. Rows and other columns stay as they are."""
    return docs.withColumns({"text": clean_text("text"), "title": collapse_spaces(F.coalesce("title", F.lit("")))})


def exact_dedup(docs: DataFrame, order: str = "doc_id") -> DataFrame:
    """The first row of each text, by SHA-256.

    Rows are written once with a hash and a number of their own; then a partial minimum of the
    order per hash, and a semi join on the numbers: no window gathers the copies of one text, and
    only hashes, orders and numbers are shuffled.

    Exactly one row of each text stays: the one with the least ``order``, nulls last; of ties, such
    as repeated rows, the one with the least hash of all its columns, and any one of equal rows. A
    null text is an empty text. All columns are kept. An empty table gives no rows.
    """
    key, row = fresh(docs, "key", "row")
    keyed = docs.withColumns({key: F.sha2(F.coalesce("text", F.lit("")), 256), row: F.monotonically_increasing_id()})
    return _first_rows(written(keyed, "keyed"), key, row, order).select(*quoted(*docs.columns))


def _first_rows(keyed: DataFrame, key: str, row: str, order: str) -> DataFrame:
    """One row of each key, from a written table whose rows have numbers."""
    every = F.xxhash64(*quoted(*(c for c in keyed.columns if c not in (key, row, "text"))))
    first = keyed.groupBy(key).agg(F.min(F.struct(F.col(order).isNull().alias("a"), F.col(order).alias("b"), every.alias("c"), F.col(row).alias("d"))).alias("x"))
    return keyed.join(first.select(F.col("x.d").alias(row)), row, "left_semi")


def cleanup(docs: DataFrame, exact_only: bool = False, threshold: float = 0.95, n: int = 7, order: str = "doc_id") -> DataFrame:
    """Clean, drop invalid articles, drop exact copies, drop near copies, number densely: adds ``article_idx``.

    ``docs(doc_id, title, text, ..)``. Texts are cleaned in one pass and written; everything after
    works on hashes and numbers until the kept rows are numbered in order. ``exact_only`` leaves
    near copies in. Rows with a null ``order`` come last among copies and first in the numbering;
    near copies are judged in the same order, by a number of their own, so nulls and repeated ids
    are rows like others. Other columns are kept. An empty table gives no rows.
    """
    key, row, new = fresh(docs, "key", "row", "new")

    def made(t: Column) -> Column:
        title = collapse_spaces(F.coalesce("title", F.lit("")))
        return F.struct(t.alias("text"), F.sha2(t, 256).alias("key"), title.alias("title"), is_valid(t, title).alias("valid"))

    # a lambda's argument is evaluated once, however often it is used; a column's expression is copied
    one = docs.withColumn(new, F.element_at(F.transform(F.array(clean_text("text")), made), 1))
    one = written(one.select(*[F.col(f"{new}.{c}").alias(c) if c in ("text", "title") else F.col(*quoted(c)) for c in docs.columns], F.col(f"{new}.key").alias(key), F.col(f"{new}.valid").alias(new)), "cleaned")
    good = one.where(F.col(new)).drop(new).withColumn(row, F.monotonically_increasing_id())
    kept = _first_rows(good, key, row, order).select(*quoted(*docs.columns))
    if exact_only:
        return dense_id(kept, [order], "article_idx")
    (place,) = fresh(docs, "place")
    placed = written(dense_id(kept, [F.col(order).asc_nulls_last()], place), "exact")
    alone = near_dedup(placed.select(F.col(place).alias("doc_id"), "text"), threshold, n).select(F.col("doc_id").alias(place))
    return dense_id(placed.join(alone, place, "left_semi"), [place], "article_idx").drop(place)


def _docs(spark, folder: str) -> DataFrame:
    return table(spark, folder, "documents").withColumn("title", F.col("source"))


def _digest(c: str | Column) -> Column:
    return F.sha2(F.col(c) if isinstance(c, str) else c, 256)


_WS = f"[{SPACES_RE2}]+"
_COLLAPSE = lambda x: f"trim(regexp_replace({x}, '{_WS}', ' ', 'g'))"
_CLEAN = f"""array_to_string(list_filter(list_transform(string_split_regex(regexp_replace(replace(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), chr(9), ' '), '(?m)^ +$', '', 'g'), '\\n{{2,}}'),
  lambda b: {_COLLAPSE('b')}), lambda b: b <> ''), chr(10) || chr(10) || chr(10) || chr(10))"""
_WORDS = f"CASE WHEN {_COLLAPSE('text')} = '' THEN 0 ELSE len(string_split({_COLLAPSE('text')}, ' ')) END"
_CLEANED = f"SELECT doc_id, {_CLEAN} AS text, {_COLLAPSE('source')} AS title FROM documents"
_VALID = f"length(trim(text)) >= 100 AND {_WORDS} >= 20 AND title <> ''"


def q_clean_text(spark, folder):
    d = clean_articles(_docs(spark, folder))
    return d.select("doc_id", _digest("text").alias("text_sha"), F.length("text").cast("long").alias("n"), "title")


def q_valid_articles(spark, folder):
    return _docs(spark, folder).where(is_valid("text", "title")).select("doc_id", word_count("text").alias("words"))


def q_exact_dedup(spark, folder):
    return exact_dedup(_docs(spark, folder).select("doc_id", "text")).select("doc_id", _digest("text").alias("text_sha"))


def q_cleanup_pipeline(spark, folder):
    return cleanup(_docs(spark, folder).select("doc_id", "title", "text"), exact_only=True).select("article_idx", "doc_id", "title", _digest("text").alias("text_sha"))


def q_cleanup_near(spark, folder):
    return cleanup(_docs(spark, folder).select("doc_id", "title", "text")).select("article_idx", "doc_id", "title", _digest("text").alias("text_sha"))


def q_build_texts(spark, folder):
    d = _docs(spark, folder).withColumn("day", F.lit("2024-01-01"))
    modes = ["text_only", "title_lede", "doc_prefix", "title_and_text"]
    return d.select("doc_id", *[_digest(build_text(m, "title", "text", "day")).alias(m) for m in modes], _digest(truncate_words("text", 64)).alias("first_words"))


QUERIES = {"clean_text": q_clean_text, "valid_articles": q_valid_articles, "exact_dedup": q_exact_dedup, "cleanup_pipeline": q_cleanup_pipeline, "cleanup_near": q_cleanup_near, "build_texts": q_build_texts}
SQL = {
    "clean_text": f"SELECT doc_id, sha256(text) AS text_sha, length(text) AS n, title FROM ({_CLEANED})",
    "valid_articles": f"SELECT doc_id, {_WORDS} AS words FROM (SELECT doc_id, text, source AS title FROM documents) WHERE {_VALID}",
    "exact_dedup": "SELECT doc_id, sha256(text) AS text_sha FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1",
    "cleanup_pipeline": f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS article_idx, doc_id, title, sha256(text) AS text_sha
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM ({_CLEANED}) WHERE {_VALID}) WHERE r = 1""",
    "build_texts": f"""SELECT doc_id, sha256(text) AS text_only,
  sha256(CASE WHEN text = '' THEN '' WHEN title <> '' THEN title || chr(10) || lede ELSE lede END) AS title_lede,
  sha256(CASE WHEN text = '' THEN '' ELSE 'title: ' || title || ' | text: ' || lede END) AS doc_prefix,
  sha256(CASE WHEN text = '' THEN '' ELSE title || ' (2024-01-01)' || chr(10) || text END) AS title_and_text,
  sha256(regexp_extract(text, '^[{SPACES_RE2}]*(?:[^{SPACES_RE2}]+[{SPACES_RE2}]*){{0,64}}', 0)) AS first_words
FROM (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS title, substr(string_split(coalesce(text, ''), chr(10) || chr(10))[1], 1, 500) AS lede FROM documents)""",
}
