"""Record files: JSON lines, CSV, clusters in one JSON object, responses by file name, templates, configuration, vectors."""

import ast
import json
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.plans.ship import ship

#: What every record of a web archive begins with, up to the minor version.
WARC_MARK = "WARC/1."


def read_jsonl(spark: SparkSession, path: str | list[str], schema: StructType | str, ordered: bool = False) -> DataFrame:
    """One object per line; blank lines are skipped and a bad line is an error.

    ``ordered`` adds ``_file`` and ``_pos``: sorting by both gives files by name and lines by place.
    """
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if ordered:
        df = df.select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_pos"))
    return df


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object per line; null fields are written."""
    df.write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_clusters(spark: SparkSession, path: str, article: str) -> DataFrame:
    """A JSON object {cluster: [article, ..]} in long form: ``cluster_id, pos, article``."""
    text = spark.read.option("wholetext", True).text(path)
    one = text.select(F.explode(F.from_json("value", f"map<string,array<struct<{article}>>>")).alias("cluster_id", "a"))
    return one.select("cluster_id", F.posexplode("a").alias("pos", "article"))


def response_type(name: Column) -> Column:
    """Kind of article by file name; null for files of no known kind."""
    n = F.lower(name)
    known = (("sensitive", "sensitive_wiki"), ("wiki", "wiki"), ("journal", "journal"), ("comparison", "comparison"), ("chain", "evolution"))
    return F.coalesce(*[F.when(n.contains(word), F.lit(kind)) for word, kind in known])


def read_responses(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Responses of a folder with ``type`` by file name; files of no known kind are skipped, and a bad line is an error."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(folder)
    return df.withColumn("type", response_type(F.col("_metadata.file_name"))).where("type IS NOT NULL")


def unread(spark: SparkSession, manifest: DataFrame, done: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Paths of a manifest that are not done yet, and end with one of ``only`` if given."""
    m = manifest
    if only:
        keep = F.lit(False)
        for o in only:
            keep = keep | F.col("path").endswith(o)
        m = m.where(keep)
    return m.join(done.select("path").distinct(), "path", "left_anti")


def charset(content_type: Column) -> Column:
    """Character set of a Content-Type header; utf-8 without one."""
    found = F.lower(F.regexp_extract(F.coalesce(content_type, F.lit("")), r"(?i)charset=[\"']?([A-Za-z0-9._-]+)", 1))
    return F.when(found != "", found).otherwise("utf-8")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of a list of files, one a line, compressed or not; blank lines are skipped."""
    return spark.read.text(path).select(F.btrim("value").alias("path")).where("path <> ''")


def fetched(manifest: DataFrame, fetch: Callable[[str], bytes], tries: int = 5, wait: float = 10.0) -> DataFrame:
    """``path, content, error`` of every file of ``manifest(path)``, by an injected ``fetch``.

    A fetch that fails is tried again after ``wait`` seconds, twice that, and so on; after the last
    try the row has an error and no content, so the next run (``unread``) asks again. One file is in
    memory at a time. Null and repeated paths are fetched once or not at all.
    """
    import pyarrow as pa

    def run(batches):
        import time

        for b in batches:
            for path in b.column(0).to_pylist():
                content = error = None
                for k in range(tries):
                    try:
                        content, error = fetch(path), None
                        break
                    except Exception as e:  # reported in the row
                        error = str(e)[:500] or type(e).__name__
                        if k + 1 < tries:
                            time.sleep(wait * 2**k)
                yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([content], pa.binary()), pa.array([error], pa.string())], ["path", "content", "error"])

    return manifest.select("path").where("path IS NOT NULL").distinct().mapInArrow(run, "path string, content binary, error string")


def written_paths(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` of what ``append_new`` has written to a folder so far; none if there is no folder."""
    try:
        return spark.read.parquet(folder).select("path").distinct()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], "path string")


def append_new(spark: SparkSession, manifest: DataFrame, work: Callable[[DataFrame], DataFrame], folder: str, only: list[str] | None = None) -> None:
    """An idempotent sink: ``work`` gets the paths that the folder has no rows of, and its result is appended.

    ``work(manifest(path))`` must keep a column ``path``. A run that fails half-way has written
    nothing, as a Parquet append commits at its end; run again, it does what is missing.
    """
    work(unread(spark, manifest, written_paths(spark, folder), only)).write.mode("append").parquet(folder)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses of web archive files: ``url, crawl_date, html``.

    Spark's own text reader cuts the stream at record marks, gzip members included, so a record and
    not a file is in memory. A record whose declared length is not reached goes on in the next piece
    of the same file, as a body may hold the mark too. Bodies are decoded by the declared character
    set, with replacement, and as UTF-8 if that is unknown. A record that ends early is dropped.
    """
    import pyarrow as pa

    ship(spark)

    def run(batches):
        from millrace.sources.warc import responses

        def pieces():
            for b in batches:
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)

        held = []
        for r in responses(pieces()):
            held.append(r)
            if len(held) == 256:
                yield _batch(pa, held)
                held = []
        if held:
            yield _batch(pa, held)

    files = spark.read.option("lineSep", WARC_MARK).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return files.mapInArrow(run, "url string, crawl_date string, html string")


def _batch(pa, rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["url", "crawl_date", "html"])


def read_text(spark: SparkSession, path: str) -> str:
    """A template: the whole file, stripped. Read through Spark, so any path it knows will do."""
    return "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect()).strip()


def load_config(spark: SparkSession, path: str, **overrides) -> dict:
    """A nested configuration file, JSON or YAML, with overrides as in ``config``; read through Spark."""
    text = read_text(spark, path)
    if text.startswith("{"):
        return config(json.loads(text), **overrides)
    try:
        import yaml
    except ImportError:
        return config(_simple_yaml(text), **overrides)
    return config(yaml.safe_load(text) or {}, **overrides)


def _simple_yaml(text: str) -> dict:
    """Nested mappings by indentation with scalars, [a, b] and - lists: what configurations need, without a library."""

    def scalar(s: str):
        s = s.strip()
        if s[:1] in "\"'" and s[:1]:
            return s[1:-1]
        if s.startswith("[") and s.endswith("]"):
            return [scalar(x) for x in s[1:-1].split(",") if x.strip()]
        if s.lower() in ("", "null", "~"):
            return None
        if s.lower() in ("true", "false"):
            return s.lower() == "true"
        for kind in (int, float):
            try:
                return kind(s.replace("_", ""))
            except ValueError:
                pass
        return s

    rows = []
    for line in text.splitlines():
        bare = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if bare.strip():
            rows.append((len(bare) - len(bare.lstrip()), bare.strip()))

    def block(i: int, depth: int):
        if rows[i][1].startswith("- "):
            items = []
            while i < len(rows) and rows[i][0] == depth and rows[i][1].startswith("- "):
                items.append(scalar(rows[i][1][2:]))
                i += 1
            return items, i
        out = {}
        while i < len(rows) and rows[i][0] == depth:
            key, _, value = rows[i][1].partition(":")
            i += 1
            nested = i < len(rows) and (rows[i][0] > depth or rows[i][0] == depth and rows[i][1].startswith("- "))
            if not value.strip() and nested:
                out[scalar(key)], i = block(i, rows[i][0])
            else:
                out[scalar(key)] = scalar(value)
        return out, i

    return block(0, rows[0][0])[0] if rows else {}


def config(base: dict, **overrides) -> dict:
    """A nested configuration with dotted overrides (``a__b`` or ``{"a.b": 1}``); None changes nothing."""
    out = json.loads(json.dumps(base))
    for key, value in overrides.items():
        if value is None:
            continue
        at = out
        *path, last = key.replace("__", ".").split(".")
        for p in path:
            at = at.setdefault(p, {})
        at[last] = value
    return out


def version_paths(folder: str, version: str, parts: tuple[str, ...] = ("cleaned", "clustered", "prompts", "responses", "qa")) -> dict[str, str]:
    """Places of a version's tables below a folder; object stores need no folder to be made."""
    top = f"{folder.rstrip('/')}/{version}"
    return {p: f"{top}/{p}" for p in parts}


def write_sidecar(spark: SparkSession, path: str, settings: dict, table: DataFrame | None = None) -> None:
    """One JSON record beside a table: how it was made, and its rows and columns if it is given."""
    record = dict(settings)
    if table is not None:
        record |= {"rows": table.count(), "columns": table.columns}
    spark.createDataFrame([(json.dumps(record, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_sidecar(spark: SparkSession, path: str) -> dict:
    """The record of ``write_sidecar``."""
    return json.loads(read_text(spark, path))


def read_parents(spark: SparkSession, path: str) -> DataFrame:
    """``child, parent`` of a JSON object {"child": parent or null}: the cache of a chain."""
    one = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", "map<string,bigint>")).alias("child", "parent"))
    return one.select(F.col("child").cast("long").alias("child"), "parent")


def with_default_id(df: DataFrame, name: str, file: str = "_file", pos: str = "_pos") -> DataFrame:
    """``name`` where a record has it, else its place in the order of files and lines (``read_jsonl(ordered=True)``)."""
    from millrace.operators.cleaning import dense_id
    from millrace.plans.names import fresh

    (place,) = fresh(df, "place")
    out = dense_id(df, [file, pos], place)
    given = F.col(name) if name in df.columns else F.lit(None)
    return out.withColumn(name, F.coalesce(given.cast("long"), F.col(place))).drop(place)


def write_reference(spark: SparkSession, path: str, target: str) -> None:
    """A name for a table that is written once: a file with the target's path, relative if it is beside it."""
    top = path.rsplit("/", 1)[0] + "/"
    spark.createDataFrame([(target.removeprefix(top),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table that a reference names."""
    target = read_text(spark, path)
    return spark.read.parquet(target if "/" in target and (target.startswith("/") or "://" in target) else f"{path.rsplit('/', 1)[0]}/{target}")


def string_list(c: Column) -> Column:
    """A printed list of strings ("['a', 'b']") as an array, by pattern and never by evaluation."""
    # the pattern takes a quoted string at a time, so a quote of the other kind inside is a character
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"'([^']*)'|\"([^\"]*)\""), F.lit(0)), lambda x: F.substring(x, F.lit(2), F.length(x) - 2))


def py_string_list(text: str) -> list[str]:
    """The same on the driver, by literal parsing."""
    try:
        v = ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return []
    return [x for x in v if isinstance(x, str)] if isinstance(v, (list, tuple)) else []


def write_vectors(df: DataFrame, path: str) -> None:
    """Vectors keyed by id as Parquet, rounded through half precision as a half-precision matrix is."""
    import pyarrow as pa

    def half(batches):
        import numpy as np

        for b in batches:
            i = b.schema.get_field_index("embedding")
            a = b.column(i)
            flat = a.flatten().to_numpy(zero_copy_only=False).astype(np.float16).astype(np.float32)
            size = a.value_lengths().fill_null(0).to_numpy()
            off = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            yield b.set_column(i, b.schema.field(i), pa.ListArray.from_arrays(off, pa.array(flat)))

    df.select("id", F.col("embedding").cast("array<float>").alias("embedding")).where("embedding IS NOT NULL").mapInArrow(half, "id long, embedding array<float>").write.mode("overwrite").parquet(path)
