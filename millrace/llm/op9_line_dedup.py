"""Cross-site boilerplate lines by distinct-site sketches."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.names import fresh, quoted
from millrace.plans.work import written
from millrace.sources import table

#: Distinct sites from which a line is boilerplate; log2 of a sketch's registers.
SITES, REGISTERS = 5, 12


def _lines(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def _hashes(line: Column | str) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.hash(line).alias("h2")]


def line_keys(docs: DataFrame) -> DataFrame:
    """``h1, h2, site, doc_id``: the distinct lines of each document that are not blank, as hashes."""
    trimmed = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), lambda x: F.btrim(x)), lambda x: x != ""))
    line = docs.select("doc_id", F.col("source").alias("site"), F.explode(trimmed).alias("line"))
    return line.select(*_hashes("line"), "site", "doc_id")


def boilerplate(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``h1, h2, first_doc``: lines seen on at least ``sites`` distinct sites.

    One HyperLogLog sketch of sites per line hash merges by aggregation, so a line on a third of all
    pages is a sketch a map task in the shuffle. Estimates below half the threshold are not
    boilerplate and estimates above twice it are; only the lines between are counted exactly.
    """
    keys = line_keys(docs.where("doc_id IS NOT NULL"))
    seen = keys.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("sketch"), F.min("doc_id").alias("first_doc"))
    seen = seen.withColumn("estimate", F.hll_sketch_estimate("sketch")).where(F.col("estimate") >= max(2.0, sites / 2)).drop("sketch")
    seen = written(seen, "line-sites")
    near = seen.where(F.col("estimate") <= sites * 2).select("h1", "h2")
    exact = keys.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").count().where("site IS NOT NULL").groupBy("h1", "h2").count().where(F.col("count") >= sites).select("h1", "h2")
    sure = seen.where(F.col("estimate") > sites * 2).select("h1", "h2", "first_doc")
    return sure.union(seen.join(exact, ["h1", "h2"]).select("h1", "h2", "first_doc"))


def without_boilerplate(docs: DataFrame, sites: int = SITES, names: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """Remove boilerplate lines: the same rows, with new ``text`` and ``n_lines, n_removed`` (or ``names``).

    ``docs(doc_id, text, source, ..)``. A line of any length is compared without blanks at its ends,
    and counts once a document. One that is on ``sites`` distinct sources or more is removed from
    every document but the one with the smallest doc_id that holds it, so its content stays once.
    Blank lines stay. Built of DataFrame functions alone.

    Only hashes of lines are shuffled for counting; each document then meets the places of its own
    removed lines, and what is left is put together from the other places, in time linear in its
    lines. A line on a third of all documents is one key of a join whose other side is unique;
    adaptive execution splits it where that side is not broadcast.

    A null source is no site; a document with null doc_id or null text stays as it is (null text: 0
    lines). Repeated doc_ids are one document, all of whose rows lose the same lines. A document may
    end with an empty text. Other columns are kept whatever their names, but ones with one of the
    two names, which are replaced. An empty table gives no rows.
    """
    own = docs.select("doc_id", "text", "source")
    gone = written(boilerplate(own, sites), "boilerplate")
    # a row is known by its id and the hash of its text: equal ones lose the same places
    row = F.xxhash64("text").alias("row")
    place = own.where("doc_id IS NOT NULL").select("doc_id", row, F.posexplode(F.transform(_lines(F.col("text")), lambda x: F.btrim(x))).alias("place", "line")).where("line <> ''")
    hits = place.select("doc_id", "row", "place", *_hashes("line")).join(gone, ["h1", "h2"]).where("doc_id <> first_doc")
    rest = [c for c in docs.columns if c.lower() not in [n.lower() for n in names]]
    kept = docs.select(*quoted(*rest))
    id_, key, cut, left = fresh(kept, "cut_id", "cut_row", "cut", "left")
    cuts = hits.groupBy(F.col("doc_id").alias(id_), F.col("row").alias(key)).agg(F.collect_set("place").alias(cut))
    joined = kept.join(cuts, (F.col("doc_id") == F.col(id_)) & (F.xxhash64("text") == F.col(key)), "left")
    lines, text = _lines(F.col("text")), F.col("text")
    # a lambda's argument is evaluated once; split inside the inner one would be once for every place
    stay = lambda ls: F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(cut)), lambda i: F.get(ls, i))
    joined = joined.withColumn(left, F.when(F.col(cut).isNotNull(), F.array_join(F.element_at(F.transform(F.array(lines), stay), 1), "\n")))
    n = lambda a: F.when(text.isNull(), 0).otherwise(F.size(a)).cast("long")
    new = F.coalesce(left, text).alias("text")
    removed = F.when(F.col(cut).isNull(), 0).otherwise(F.size(cut)).cast("long").alias(names[1])
    return joined.select(*[new if c == "text" else F.col(*quoted(c)) for c in rest], n(lines).alias(names[0]), removed)


def op9_line_dedup(spark, folder: str) -> DataFrame:
    out = without_boilerplate(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text_sha256"))


SQL = f"""
WITH l AS (
  SELECT doc_id, source, pos, line, trim(line) AS k
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
b AS (SELECT k, min(doc_id) AS first_doc FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= {SITES}),
m AS (SELECT l.*, b.k IS NOT NULL AND l.doc_id <> b.first_doc AS gone FROM l LEFT JOIN b USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS text_sha256
FROM m GROUP BY doc_id
"""
