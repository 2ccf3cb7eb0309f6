"""Subword tokens: counts and cuts by a tokenizer file."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.statistics import rounded, summary
from millrace.plans.names import fresh, quoted
from millrace.sources import table

_loaded: dict = {}


def _tokenizer(path: str):
    """The tokenizer of a file, once a worker; the strings of special tokens are ordinary text."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        _loaded[path] = t
    return _loaded[path]


def _pieces(texts: list[str], chars: int = 1 << 20):
    """(first, texts) of batches of about a million characters."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, texts[first:]


def _with(df: DataFrame, text: str, name: str, kind: str, work) -> DataFrame:
    (given,) = fresh(df, "given")
    rest = [c for c in df.columns if c != name]
    asked = df.select(*quoted(*rest), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(given))

    def run(batches):
        for b in batches:
            texts = b.column(b.schema.get_field_index(given)).to_pylist()
            out = [x for _, part in _pieces(texts) for x in work(part)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in rest), pa.array(out, pa.int64() if kind == "long" else pa.string())], [*rest, name])

    return asked.mapInArrow(run, asked.drop(given).schema.add(name, kind))


def token_counts(df: DataFrame, text: str, path: str, name: str = "n_tokens") -> DataFrame:
    """Adds the number of subword tokens, without special ones. Null and empty texts have none.

    ``path`` is a file of the tokenizers library that executors can read. Texts of any length are
    taken in batches of about a million characters. A column called ``name`` is replaced; all other
    columns, null ids and repeated rows stay.
    """
    return _with(df, text, name, "long", lambda part: [len(e.ids) for e in _tokenizer(path).encode_batch(part, add_special_tokens=False)])


def truncate_tokens(df: DataFrame, text: str, path: str, most: int, name: str = "cut") -> DataFrame:
    """Adds the text cut after ``most`` tokens and decoded again; texts of no more stay as they are.

    0 or less: nothing is cut. Otherwise as ``token_counts``.
    """

    def work(part):
        if most <= 0:
            return part
        t = _tokenizer(path)
        return [s if len(e.ids) <= most else t.decode(e.ids[:most], skip_special_tokens=True) for s, e in zip(part, t.encode_batch(part, add_special_tokens=False), strict=True)]

    return _with(df, text, name, "string", work)


def _path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def q_token_counts(s, d):
    from millrace.plans.ship import ship

    ship(s)
    return token_counts(table(s, d, "documents").select("doc_id", "text"), "text", _path()).select("doc_id", "n_tokens")


def q_subword_stats(s, d):
    from millrace.plans.ship import ship

    ship(s)
    return rounded(summary(token_counts(table(s, d, "documents").select("lang", "text"), "text", _path()).select("lang", "n_tokens"), "n_tokens", "lang"))


QUERIES = {"subword_counts": q_token_counts, "subword_stats_by_lang": q_subword_stats}
SQL: dict[str, str] = {}
