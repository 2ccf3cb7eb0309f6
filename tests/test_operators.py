"""Operators against restatements in Python, on small rows with the odd cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import features, parse, text
from millrace.operators.cleaning import cleanup, dense_id, exact_dedup
from millrace.operators.dedup import banding, containment_nodes, containment_pairs, near_dedup, shingle_sets
from millrace.operators.qa import islands, name_again, zip_verdicts
from millrace.operators.registry import QUERIES
from millrace.operators.splits import balanced_sample, split_assign, stratified_halves
from millrace.plans.graph import connected_components


def one(spark, value, f):
    df = spark.createDataFrame([(value,)], "x string").select(f("x").alias("y"))
    return df.first()["y"]


def py_clean(t):
    t = re.sub(r"\r\n?", "\n", t or "").replace("\t", " ")
    t = re.sub(r"(?m)^ +$", "", t)
    return "\n\n\n\n".join(b for b in (" ".join(x.split()) for x in re.split(r"\n{2,}", t)) if b)


def test_clean_text(spark):
    rng = random.Random(1)
    rows = ["".join(rng.choice("ab \t\r\n\xa0　\x1c") for _ in range(40)) for _ in range(200)] + ["", None]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, x string").select("i", text.clean_text("x").alias("y"), text.word_count("x").alias("n"))
    for r in df.collect():
        assert r.y == py_clean(rows[r.i])
        assert r.n == len((rows[r.i] or "").split())


@pytest.mark.parametrize(
    ("raw", "want"),
    [("[\"a \", \"\"]", ["a"]), ("[]", []), ("noise [1, \"b\"]\n1. a line that is long enough to stay", ["a line that is long enough to stay"]), ("", []), (None, [])],
)
def test_parse_facts(spark, raw, want):
    got = one(spark, raw, parse.parse_facts)
    assert got == want or (want and got[-1] == want[-1])


def test_parse_others(spark):
    assert one(spark, "```json\n[true, false, null, 0, \"false\", [], 1] # x\n```", parse.parse_bools) == [True, False, False, False, True, False, True]
    assert one(spark, "[\" a \", null, true, 3]", parse.parse_strings) == ["a", "", "True", "3"]
    assert one(spark, "[\"a # b\"]", parse.parse_strings) == []
    got = one(spark, 'x {"qas": [{"question": "q", "answer": "a", "supporting_articles_ids": [1]}, {"question": "z"}]} y', parse.parse_qas)
    assert [(r.question, r.answer, r.root_articles_ids) for r in got] == [("q", "a", [1])]
    got = one(spark, '[{"id": 1, "is_correct": false}, {"x": 2}, {"id": "b"}]', parse.parse_judgments)
    assert [(r.id, r.is_correct) for r in got] == [(1, False), (None, None)]
    for bad in ("no json", "[1, ", None):
        assert one(spark, bad, parse.parse_bools) == []


@pytest.mark.parametrize(("raw", "want"), [(" G1_Attack ", "attack"), ("stats.hp", "hp"), ("move_info.name", "move.name"), ("special_attack", "special attack"), ("junk", None), ("", None), ("Speeed", "speed"), ("move.short_description", "move.short_description")])
def test_features(spark, raw, want):
    assert one(spark, raw, features.normalize_feature) == want


def test_question_cascade(spark):
    assert one(spark, "What is the special attack stat of X?", features.question_to_feature) == "special attack"
    assert one(spark, "What is the attack stat of X?", features.question_to_feature) == "attack"
    assert one(spark, "Why?", features.question_to_feature) == "unknown"


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(150)] + [(5000, 5000 + i) for i in range(1, 200)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    want = {x: top(x) for x in {y for a, b in edges if a != b for y in (a, b)}}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def word_sets(rows, n):
    out = {}
    for i, t in rows:
        w = re.findall("[a-z0-9]+", (t or "").lower())
        out[i] = frozenset(w) if len(w) < n else frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    return out


def greedy(spark, rows, threshold, n):
    """The rule, document by document: candidates share a band; equal sets first, then by the smallest id of their set."""
    sets = word_sets(rows, n)
    bands, per = banding(max(0.5, threshold - 0.2))
    keys = {r.doc_id: set(enumerate(r.bands)) for r in shingle_sets(spark.createDataFrame(rows, "doc_id long, text string"), n, bands, per).collect()}
    least = {}
    for i in sorted(keys):
        least.setdefault(sets[i], i)
    alive = dict.fromkeys(sorted(keys), True)
    for i in alive:
        if not alive[i]:
            continue
        for j in sorted((j for j in keys if j != i and keys[i] & keys[j]), key=lambda j: (sets[i] != sets[j], least[sets[j]], j)):
            if not alive[j] or len(sets[i] & sets[j]) < threshold * min(len(sets[i]), len(sets[j])) - 1e-9:
                continue
            if len(sets[i]) >= len(sets[j]):
                alive[j] = False
            else:
                alive[i] = False
                break
    return {i for i, _ in rows if alive.get(i, True)}


def test_near_dedup_against_greedy(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(60)] for _ in range(12)]
    rows = []
    for i in range(160):
        w = list(base[i % 12])
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(60)] = "x"
        rows.append((i, " ".join(w[: rng.choice([60, 60, 58, 52])] + [rng.choice(words) for _ in range(rng.choice([0, 0, 4, 9]))])))
    # copies of a short text whose container is itself contained later
    a = [rng.choice(words) for _ in range(40)]
    grow = [a, a + words[:4], a, a + words[:9], a, [*a, "!"]]
    rows += [(200 + i, " ".join(t)) for i, t in enumerate(grow)] + [(300, None), (301, ""), (302, "Two words"), (303, "words, two"), (304, "!!")]
    for threshold, n in ((0.8, 5), (0.95, 7), (0.7, 3)):
        got = {r.doc_id for r in near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), threshold, n).collect()}
        want = greedy(spark, rows, threshold, n)
        assert got == want and 10 < len(want) < 160
    sh = word_sets(rows, 5)
    share = lambda a, b: len(sh[a] & sh[b]) / min(len(sh[a]), len(sh[b]))
    pairs = {(r.i, r.j): r.containment for r in containment_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert pairs == {(a, b): round(share(a, b), 6) for a in sh for b in sh if a < b and sh[a] and sh[b] and share(a, b) >= 0.8 - 1e-9}
    nodes, members = containment_nodes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert members.count() == sum(1 for x in sh.values() if x) and nodes.count() < len(pairs)


def test_near_dedup_with_odd_rows(spark):
    t = " ".join(f"w{i}" for i in range(30))
    rows = [(1, t, 1), (1, t, 1), (2, t + " more", 2), (2, "another text of a few words here", 3), (None, t, 4), (3, None, 5), (4, t, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int").withColumn("h1", F.lit("mine"))
    got = sorted(repr((r.doc_id, r.node, r.h1)) for r in near_dedup(df).collect())
    assert got == sorted(map(repr, [(2, 2, "mine"), (2, 3, "mine"), (None, 4, "mine"), (3, 5, "mine")]))
    assert near_dedup(df.limit(0)).count() == 0 and containment_pairs(df.limit(0)).count() == 0


def test_near_dedup_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert {r.doc_id for r in QUERIES["near_dedup"](spark, folder).collect()} == greedy(spark, rows, 0.8, 5)


def test_cleanup_near_query(spark, folder):
    rows = [(r.doc_id, py_clean(r.text), r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    rows = [r for r in rows if len(r[1]) >= 100 and len(r[1].split()) >= 20 and (r[2] or "").strip()]
    first = {}
    for i, t, _ in rows:
        first.setdefault(t, i)
    kept = sorted((i, t) for t, i in first.items())
    want = greedy(spark, list(enumerate(t for _, t in kept)), 0.95, 7)
    got = QUERIES["cleanup_near"](spark, folder).orderBy("article_idx").collect()
    assert [r.doc_id for r in got] == [kept[k][0] for k in sorted(want)] and [r.article_idx for r in got] == list(range(len(want)))


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    rows = [(1, "a", 1), (1, "a", 1), (2, "a", 2), (None, "b", 3), (None, "c", 4), (5, "c", 5), (6, None, 6), (7, "", 7), (8, "d", 8), (8, "e", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int").withColumn("row", F.lit("x"))
    got = sorted(map(repr, ((r.doc_id, r.text, r.key, r.row) for r in exact_dedup(df.repartition(3)).collect())))
    assert got == sorted(map(repr, [(1, "a", 1, "x"), (None, "b", 3, "x"), (5, "c", 5, "x"), (6, None, 6, "x"), (8, "d", 8, "x"), (8, "e", 9, "x")]))
    assert exact_dedup(df).columns == df.columns and exact_dedup(df.limit(0)).count() == 0


def test_cleanup_with_odd_rows(spark):
    t = " ".join(f"word{i}" for i in range(40))
    rows = [(3, "T", t, 1), (3, "T", t, 1), (1, " T ", t.replace(" ", "  "), 2), (None, "T", t + " other end", 3), (2, None, t, 4), (4, "T", None, 5), (5, "T", "short", 6)]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string, key int").withColumn("place", F.lit(7))
    got = [(r.article_idx, r.doc_id, r.title, r.key, r.place) for r in cleanup(df, exact_only=True).orderBy("article_idx").collect()]
    assert got == [(0, None, "T", 3, 7), (1, 1, "T", 2, 7)]
    assert [(r.article_idx, r.doc_id) for r in cleanup(df).collect()] == [(0, None)]
    assert cleanup(df.limit(0)).count() == 0


def test_dense_id_keeps_every_column(spark):
    df = spark.createDataFrame([(3, 1), (1, 2), (None, 3), (1, 4)], "x int, at int").withColumn("part", F.lit(9)).withColumn("before", F.lit(8))
    got = dense_id(df, ["x"], "i").orderBy("i").collect()
    assert [r.i for r in got] == [0, 1, 2, 3] and [r.x for r in got] == [None, 1, 1, 3] and {(r.part, r.before) for r in got} == {(9, 8)}
    assert dense_id(df.limit(0), ["x"], "i").count() == 0


def test_banding():
    assert banding(0.6) == (18, 7)
    assert banding(0.75) == (11, 11)


def test_splits_and_samples(spark):
    ids = spark.range(101).withColumnRenamed("id", "doc_id")
    got = {r.split: r["count"] for r in split_assign(ids, "doc_id").groupBy("split").count().collect()}
    assert got == {"train": 90, "val": 5, "test": 6}
    again = {(r.doc_id, r.split) for r in split_assign(ids.repartition(7), "doc_id").collect()}
    assert again == {(r.doc_id, r.split) for r in split_assign(ids, "doc_id").collect()}
    assert split_assign(ids.where("false"), "doc_id").count() == 0
    pairs = spark.createDataFrame([(i, f"p{i % 9}") for i in range(90)], "id long, pair string")
    drawn = balanced_sample(pairs, 20, 4).collect()
    assert len(drawn) == 20 == len({r.id for r in drawn})


def test_islands_and_zip(spark):
    x = [1, 2, 3, 7, 9, 10, 4095, 4096, 4097]
    got = {(r.first, r.last, r.length) for r in islands(spark.createDataFrame([(i,) for i in [*x, None, 3]], "k long"), "k").collect()}
    assert got == {(1, 3, 3), (7, 7, 1), (9, 10, 2), (4095, 4097, 3)}
    df = spark.createDataFrame([(1, [1, 2], [True, False]), (2, [1], []), (3, [], [])], "i int, t array<int>, v array<boolean>")
    assert [(r.i, r.tag, r.verdict) for r in zip_verdicts(df, "t", "v").orderBy("tag").collect()] == [(1, 1, True), (1, 2, False)]


def test_null_and_empty_columns(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    r = df.select(text.answers_match("a", "b").alias("m"), text.is_valid("a", "b").alias("v"), F.size(text.shingles("a", 5)).alias("n")).first()
    assert (r.m, r.v, r.n) == (False, False, 0)


def test_halves_of_every_group(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(31)], "k long, g string").withColumn("rank", F.lit("mine"))
    got = stratified_halves(df, "g", "k").groupBy("g", "half", "rank").count().collect()
    assert sorted(((r.g or ""), r.half, r["count"]) for r in got) == [("", "test", 6), ("", "val", 5), ("a", "test", 10), ("a", "val", 10)]


def test_balanced_sample_query(spark, folder):
    """Every round's draws, drawn again in Python from the same uniform numbers."""
    import math

    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").alias("id"), "lang", "source").collect()
    pairs = {r.id: [x for x in {r.lang, r.source} if x is not None] for r in docs}
    u = {}
    for k in range(10):
        c = ((F.pmod(F.xxhash64(F.lit(42), F.lit(k), F.col("id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)).alias("u")
        u |= {(k, r.id): r.u for r in spark.createDataFrame([(i,) for i in pairs], "id long").select("id", c).collect()}
    counts, left, want = {}, {i for i in pairs if pairs[i]}, {}
    for k in range(10):
        score = {i: sum(1 / (1 + counts.get(p, 0)) for p in pairs[i]) for i in left}
        new = sorted(left, key=lambda i: (-math.log(u[k, i]) / score[i], i))[:10]
        want |= dict.fromkeys(new, k)
        left -= set(new)
        for i in new:
            for p in pairs[i]:
                counts[p] = counts.get(p, 0) + 1
    assert {r.id: r.round for r in QUERIES["balanced_sample"](spark, folder).collect()} == want


def test_names_to_ask_again(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "c"), (4, None), (5, None), (6, "")], "line int, name string")
    again, taken = name_again(df, "name", "line")
    assert sorted(r.line for r in again.collect()) == [2, 3] and sorted(r.name for r in taken.collect()) == ["a", "b"]


def test_signatures_agree_like_the_sets(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    sets = {i: x for i, x in word_sets(rows, 5).items() if x}
    got = {r.doc_id: r.signature for r in QUERIES["signatures"](spark, folder).collect()}
    assert got.keys() == sets.keys() and {len(x) for x in got.values()} == {128}
    ids = sorted(sets)
    off = [abs(sum(x == y for x, y in zip(got[a], got[b])) / 128 - len(sets[a] & sets[b]) / len(sets[a] | sets[b])) for a in ids[:60] for b in ids if a < b]
    assert max(off) < 0.2 and sum(off) / len(off) < 0.01
