"""Raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows and columns that the next one works on;
``run`` writes every stage to the shared folder and reads it back. ``docs`` has at least the columns
of ``documents``; all but the last stage return all of its columns, whatever the others are called.
An empty table gives an empty table in every stage. Repeated rows are rows of their own in every
stage but near_duplicates, and rows with a null doc_id are documents like others.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.op2_jaccard_join import jaccard_classes
from millrace.llm.op4_language_id import identify
from millrace.llm.op5_pii import masked
from millrace.llm.op8_packing import TOKENIZER, pack
from millrace.llm.op9_line_dedup import without_boilerplate
from millrace.operators.cleaning import dense_id
from millrace.plans.names import fresh, quoted
from millrace.plans.ship import ship
from millrace.plans.work import written
from millrace.sources import table

#: Mean probability of the best language below which a document is not in any known language.
SURE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; ones without a letter, or of no clear language, go.

    The text decides: a null lang or source, a null doc_id and repeated rows change nothing, and a
    null or empty text goes. If no row has a lang to learn from, no language is known and all go.
    """
    ship(spark)
    names = fresh(docs, "held_out", "lang_pred", "score")
    return identify(docs, names=names).where((F.col(names[1]) != "und") & (F.col(names[2]) >= SURE)).select(*quoted(*docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate of any length; a document of which no letter is left goes: all it had stays elsewhere.

    Rows with a null doc_id, text or source stay as they are, and a null source is no site. Rows of
    one doc_id lose the same lines. ``n_chars`` follows the text.
    """
    ship(spark)
    names = fresh(docs, "n_lines", "n_removed")
    out = without_boilerplate(docs, names=names).where((F.col(names[1]) == 0) | F.col("text").rlike(r"\p{L}"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*quoted(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, the one with the smallest doc_id.

    Every row is judged by its text. Rows with a null doc_id, and all but one row of a repeated
    doc_id, take part under numbers after all ids: such a row stays if no other is like it. Equal
    rows of one doc_id are one row.
    """
    ship(spark)
    shared_, number, first_, top_, id_ = fresh(docs, "shared", "number", "first", "top", "id")
    shared = written(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias(shared_)), "shared-ids")
    same = F.col("doc_id").eqNullSafe(F.col(shared_))
    odd = docs.join(shared, same, "left_semi")
    odd = odd.where("doc_id IS NOT NULL").distinct().union(odd.where("doc_id IS NULL"))
    odd = dense_id(odd, [F.col("doc_id").asc_nulls_last(), *quoted(*(c for c in docs.columns if c != "doc_id"))], number)
    first = odd.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(number).alias(first_))
    top = docs.agg(F.greatest(F.coalesce(F.max("doc_id"), F.lit(0)), F.lit(0)).cast("long").alias(top_))
    odd = odd.join(first, "doc_id", "left").crossJoin(F.broadcast(top))  # one row
    own = F.when(F.col(number) == F.col(first_), F.col("doc_id")).otherwise(F.col(top_) + 1 + F.col(number))
    odd = odd.select(*quoted(*docs.columns), own.alias(id_))
    rows = docs.join(shared, same, "left_anti").withColumn(id_, F.col("doc_id")).union(written(odd, "shared-rows"))
    kept = jaccard_classes(rows.select(F.col(id_).alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias(id_))
    return rows.join(kept, id_, "left_semi").select(*quoted(*docs.columns))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets in texts give way to their kind; every row stays, and a null text stays null. ``n_chars`` follows the text."""
    return masked(docs).withColumn("n_chars", F.length("text").cast("long")).select(*quoted(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; null and empty texts are one end mark, rows with a null or repeated doc_id documents of their own."""
    ship(spark)
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("language_id", language), ("line_dedup", lines), ("jaccard_join", near_duplicates), ("pii", personal), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
