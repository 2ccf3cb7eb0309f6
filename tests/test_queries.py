"""Every query with an SQL form against DuckDB, on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from millrace.operators.registry import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return v.date()
    return v


def rows(found, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[k]) for k in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_duckdb(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(want.fetchall(), columns)


def test_every_other_query_has_a_test_of_its_own():
    assert set(QUERIES) - set(SQL) == {"near_dedup", "cleanup_near", "articles", "extraction_counters", "balanced_sample", "generate_entities", "event_clusters", "subword_counts", "subword_stats_by_lang", "signatures"}
