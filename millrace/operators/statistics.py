"""Token statistics, cut-offs, histograms, densities, attribute grids."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import SPACES_RE2, word_count
from millrace.sources import table

MARKS = (64, 128, 256, 512, 1024, 2048, 4096)


def summary(df: DataFrame, value: str, *by: str) -> DataFrame:
    """n, mean, population deviation, minimum, exact percentiles with linear interpolation, maximum."""
    p = lambda q: F.percentile(value, F.lit(q))
    stats = [F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), p(0.25).alias("p25"), p(0.5).alias("median"), p(0.75).alias("p75"), p(0.9).alias("p90"), p(0.99).alias("p99"), F.max(value).alias("max")]
    return df.groupBy(*by).agg(*stats)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def cutoffs(df: DataFrame, value: str, marks=MARKS) -> DataFrame:
    """Per cent of rows at or below each mark: one aggregate over all marks, then unpivoted."""
    sums = df.agg(F.count(value).alias("n"), *[F.count_if(F.col(value) <= m).alias(f"m{m}") for m in marks])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(m).alias("mark"), (F.col(f"m{m}") * 100.0 / F.col("n")).alias("pct")) for m in marks])).alias("x")).select("x.mark", "x.pct")


def histogram(df: DataFrame, value: str, edges: int = 50) -> DataFrame:
    """Counts of 49 equal bins on [0, max(50, p99 + 1)]; the last bin is closed, what is outside is left out."""
    top = df.agg(F.greatest(F.lit(50.0), F.percentile(value, F.lit(0.99)) + 1).alias("top"))
    width = F.col("top") / (edges - 1)
    bins = df.crossJoin(F.broadcast(top)).where((F.col(value) >= 0) & (F.col(value) <= F.col("top")))  # one row
    return bins.select(F.least(F.floor(F.col(value) / width), F.lit(edges - 2)).cast("long").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


def density(df: DataFrame, value: str, points: int = 1000, factor: float = 0.15) -> DataFrame:
    """Gaussian kernel density of values clipped at p99 + 1, on an even grid; values are counted first."""
    top = df.agg((F.percentile(value, F.lit(0.99)) + 1).alias("top"))
    clipped = df.crossJoin(F.broadcast(top)).select(F.least(F.col(value).cast("double"), "top").alias("v"), "top")
    stats = clipped.agg(F.count("*").alias("n"), (F.stddev_samp("v") * factor).alias("h"), F.max("top").alias("top"))
    counts = clipped.groupBy("v").agg(F.count("*").alias("w"))
    grid = stats.select("n", "h", F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.struct(i.alias("i"), (F.col("top") * i / (points - 1)).alias("x")))).alias("g")).select("n", "h", "g.i", "g.x")
    pairs = counts.crossJoin(F.broadcast(grid))  # distinct clipped values x a fixed grid
    kernel = F.col("w") * F.exp(-0.5 * F.pow((F.col("x") - F.col("v")) / F.col("h"), 2))
    return pairs.groupBy("i", "x").agg((F.sum(kernel) / F.max(F.col("n") * F.col("h")) / (2 * 3.141592653589793) ** 0.5).alias("density"))


def attribute_grids(df: DataFrame, values: list[str]) -> DataFrame:
    """Per attribute: mean, sample deviation and the integers from the minimum up to below the maximum."""
    parts = []
    for v in values:
        x = df.agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.floor(F.min(v)).cast("long").alias("lo"), F.floor(F.max(v)).cast("long").alias("hi"))
        parts.append(x.select(F.lit(v).alias("attribute"), "mean", "std", F.size(F.when(F.col("hi") > F.col("lo"), F.sequence("lo", F.col("hi") - 1)).otherwise(F.array().cast("array<bigint>"))).cast("long").alias("n_values")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _counts(spark, folder):
    return table(spark, folder, "documents").select("lang", "source", word_count("text").alias("n_words"))


_N = f"(SELECT lang, source, CASE WHEN w = '' THEN 0 ELSE len(string_split(w, ' ')) END AS n_words FROM (SELECT lang, source, trim(regexp_replace(coalesce(text, ''), '[{SPACES_RE2}]+', ' ', 'g')) AS w FROM documents))"
_STATS = "count(n_words) AS n, round(avg(n_words), 6) AS mean, round(stddev_pop(n_words), 6) AS std, min(n_words) AS min, " + ", ".join(f"round(quantile_cont(n_words, {q}), 6) AS {a}" for q, a in ((0.25, "p25"), (0.5, "median"), (0.75, "p75"), (0.9, "p90"), (0.99, "p99"))) + ", max(n_words) AS max"

QUERIES = {
    "token_stats": lambda s, d: rounded(summary(_counts(s, d), "n_words")),
    "token_stats_by_lang": lambda s, d: rounded(summary(_counts(s, d), "n_words", "lang")),
    "token_stats_by_source": lambda s, d: rounded(summary(_counts(s, d), "n_words", "source")),
    "cutoff_cdf": lambda s, d: rounded(cutoffs(_counts(s, d), "n_words")),
    "token_hist": lambda s, d: histogram(_counts(s, d), "n_words"),
    "kde_grid": lambda s, d: rounded(density(_counts(s, d), "n_words"), 9),
    "stat_grids": lambda s, d: rounded(attribute_grids(table(s, d, "part"), ["p_size", "p_retailprice"])),
}
SQL = {
    "token_stats": f"SELECT {_STATS} FROM {_N}",
    "token_stats_by_lang": f"SELECT lang, {_STATS} FROM {_N} GROUP BY lang",
    "token_stats_by_source": f"SELECT source, {_STATS} FROM {_N} GROUP BY source",
    "cutoff_cdf": "SELECT CAST(mark AS INTEGER) AS mark, round(100.0 * count(*) FILTER (WHERE n_words <= mark) / count(*), 6) AS pct FROM " + _N + f", (SELECT unnest({list(MARKS)}) AS mark) GROUP BY mark",
    "token_hist": f"SELECT CAST(least(floor(n_words / (top / 49)), 48) AS BIGINT) AS bin, count(*) AS n FROM {_N}, (SELECT greatest(50.0::DOUBLE, quantile_cont(n_words, 0.99) + 1) AS top FROM {_N}) WHERE n_words BETWEEN 0 AND top GROUP BY 1",
    "kde_grid": f"""WITH t AS (SELECT quantile_cont(n_words, 0.99) + 1 AS top FROM {_N}), v AS (SELECT least(CAST(n_words AS DOUBLE), top) AS v, top FROM {_N}, t),
s AS (SELECT count(*) AS n, stddev_samp(v) * 0.15 AS h, max(top) AS top FROM v), c AS (SELECT v, count(*) AS w FROM v GROUP BY v),
g AS (SELECT n, h, CAST(i AS INTEGER) AS i, top * i / 999 AS x FROM s, (SELECT unnest(range(1000)) AS i))
SELECT i, round(x, 9) AS x, round(sum(w * exp(-0.5 * pow((x - v) / h, 2))) / max(n * h) / sqrt(2 * pi()), 9) AS density FROM c, g GROUP BY i, x""",
    "stat_grids": " UNION ALL ".join(f"SELECT '{v}' AS attribute, round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS std, CAST(greatest(floor(max({v})) - floor(min({v})), 0) AS BIGINT) AS n_values FROM part" for v in ("p_size", "p_retailprice")),
}
