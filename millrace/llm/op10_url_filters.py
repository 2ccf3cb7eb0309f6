"""URL filter lists as of the time of each capture."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.sources import table


def intervals(entries: DataFrame) -> DataFrame:
    """``entries(pattern, listed_on date, action)`` -> pattern, action, valid_from, valid_to (exclusive, null: open).

    An entry holds until the next one for its pattern. Of entries for one pattern and day the
    strictest holds: block, then allow, then remove. A remove entry ends what came before it and
    holds nothing itself. Entries with a null pattern, date or unknown action are ignored.
    """
    order = F.when(F.col("action") == "block", 0).when(F.col("action") == "allow", 1).when(F.col("action") == "remove", 2)
    e = entries.select(F.lower(F.btrim("pattern")).alias("pattern"), F.col("listed_on").alias("valid_from"), order.alias("o")).where("pattern IS NOT NULL AND valid_from IS NOT NULL AND o IS NOT NULL")
    e = e.groupBy("pattern", "valid_from").agg(F.min("o").alias("o"))
    e = e.withColumn("valid_to", F.lead("valid_from").over(W.partitionBy("pattern").orderBy("valid_from")))
    return e.where("o < 2").select("pattern", F.when(F.col("o") == 0, "block").otherwise("allow").alias("action"), "valid_from", "valid_to")


def host_of(url: str = "url"):
    """Host in lower case without user, port and final dot; '' if the URL has none."""
    authority = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def url_verdicts(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures(page_id, url, fetched_on date)`` against a dated list -> one row per capture.

    A pattern is a host and covers its subdomains. Entries become validity intervals; a capture is
    judged by the entries that were valid on its day, and of those the longest pattern decides. No
    valid entry: verdict ``none``.

    Distinct (host, day) pairs are judged, not captures, so a host with a third of all captures is
    a row a day. Intervals and pairs meet by pattern and month, so a pattern with a long history is
    only compared with the entries that were valid in that month. Months before the first and after
    the last capture are left out.

    Null URLs and URLs without a host, and null dates, have verdict none. Repeated captures stay
    repeated rows; null page_ids are kept; other columns are ignored; empty tables give no rows, or
    none verdicts. Columns: page_id, host, fetched_on, verdict, pattern, valid_from, valid_to.
    """
    c = captures.select("page_id", host_of().alias("host"), "fetched_on")
    pairs = c.where("host <> '' AND fetched_on IS NOT NULL").select("host", "fetched_on").distinct()
    # the host, and it without its first label, and so on
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = pairs.select("host", "fetched_on", F.trunc("fetched_on", "month").alias("month"), F.explode(suffixes).alias("pattern"))
    days = captures.agg(F.min("fetched_on").alias("a"), F.max("fetched_on").alias("b")).first()
    valid = intervals(entries)
    if days["a"] is None:
        valid = valid.where("false").withColumn("month", F.lit(None).cast("date"))
    else:
        first, last = F.trunc(F.greatest("valid_from", F.lit(days["a"])), "month"), F.trunc(F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(days["b"])), F.lit(days["b"])), "month")
        valid = valid.withColumn("month", F.explode(F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).otherwise(F.array().cast("array<date>"))))
    hit = asked.join(valid, ["pattern", "month"]).where("fetched_on >= valid_from AND (valid_to IS NULL OR fetched_on < valid_to)")
    best = hit.groupBy("host", "fetched_on").agg(F.max_by(F.struct("action", "pattern", "valid_from", "valid_to"), F.length("pattern")).alias("e"))
    out = c.join(best, ["host", "fetched_on"], "left")
    return out.select("page_id", "host", "fetched_on", F.coalesce("e.action", F.lit("none")).alias("verdict"), F.col("e.pattern").alias("pattern"), F.col("e.valid_from").alias("valid_from"), F.col("e.valid_to").alias("valid_to"))


def derived_list(captures: DataFrame) -> DataFrame:
    """A dated list for tables that come without one: entries follow from the md5 of each host and domain.

    Of every host's digest, digit 1 decides whether it is listed (below 8), digits 2 and 3 the day,
    digit 4 the kind, and digits 5 and 6 whether and when it is removed; domains (the last two
    labels) are listed in the same way where digit 1 is below 4.
    """
    host = captures.select(host_of().alias("pattern")).where("pattern <> ''").distinct()
    domain = host.select(F.substring_index("pattern", ".", -2).alias("pattern")).distinct()
    digit = lambda i: F.instr(F.lit("0123456789abcdef"), F.substring(F.md5("pattern"), i, 1)) - 1
    both = host.where(digit(1) < 8).union(domain.where(digit(1) < 4)).distinct()
    start = F.date_add(F.lit("2024-01-01").cast("date"), digit(2) * 16 + digit(3))
    kind = F.when(digit(4) < 11, "block").otherwise("allow")
    end = F.when(digit(5) < 8, F.date_add(start, 20 + digit(5) * 16 + digit(6)))
    rows = both.select("pattern", F.explode(F.array(F.struct(start.alias("listed_on"), kind.alias("action")), F.struct(end.alias("listed_on"), F.lit("remove").alias("action")))).alias("e"))
    return rows.select("pattern", "e.listed_on", "e.action").where("listed_on IS NOT NULL")


def op10_url_filters(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int")).alias("fetched_on"))
    return url_verdicts(pages, derived_list(pages))


SQL = r"""
WITH c AS (
  SELECT page_id, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched_on,
    lower(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), '\.?(:[0-9]*)?$', '')) AS host FROM pages),
h AS (SELECT DISTINCT host AS pattern FROM c WHERE host <> ''),
d AS (SELECT DISTINCT array_to_string(string_split(pattern, '.')[-2:], '.') AS pattern FROM h),
x AS (
  SELECT pattern, [instr('0123456789abcdef', substr(md5(pattern), i, 1)) - 1 FOR i IN [1, 2, 3, 4, 5, 6]] AS g, origin
  FROM (SELECT pattern, 8 AS origin FROM h UNION ALL SELECT pattern, 4 FROM d)),
b AS (SELECT DISTINCT pattern, g FROM x WHERE g[1] < origin),
e AS (
  SELECT pattern, DATE '2024-01-01' + CAST(g[2] * 16 + g[3] AS INTEGER) AS valid_from, CASE WHEN g[4] < 11 THEN 'block' ELSE 'allow' END AS action,
    CASE WHEN g[5] < 8 THEN DATE '2024-01-01' + CAST(g[2] * 16 + g[3] + 20 + g[5] * 16 + g[6] AS INTEGER) END AS valid_to FROM b),
j AS (
  SELECT c.page_id, c.host, c.fetched_on, e.*, row_number() OVER (PARTITION BY c.page_id ORDER BY length(e.pattern) DESC) AS r
  FROM c LEFT JOIN e ON (c.host = e.pattern OR c.host LIKE '%.' || e.pattern) AND c.fetched_on >= e.valid_from AND (e.valid_to IS NULL OR c.fetched_on < e.valid_to))
SELECT page_id, host, fetched_on, coalesce(action, 'none') AS verdict, pattern, valid_from, valid_to FROM j WHERE r = 1
"""
