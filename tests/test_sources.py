"""Sources, sinks, publishing, entities and the stream, on files of a temporary folder."""

import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import entities, prompts, retrieval, tokens, web
from millrace.plans.publish import Config, Spec, card, entity_spec, merge_metadata, missing_files, news_spec, total_size, upload_plan
from millrace.sources import files
from millrace.streaming.prompts import answer_stream


def test_jsonl_round_trip(spark, tmp_path):
    p = str(tmp_path / "a")
    df = spark.createDataFrame([(1, "é"), (2, None)], "i long, t string")
    files.write_jsonl(df.coalesce(1), p)
    raw = "".join(f.read_text() for f in (tmp_path / "a").glob("*.json"))
    assert [json.loads(x) for x in raw.splitlines()] == [{"i": 1, "t": "é"}, {"i": 2, "t": None}]
    assert files.read_jsonl(spark, p, "i long, t string", ordered=True).orderBy("_file", "_pos").select("i").collect()[0].i == 1
    (tmp_path / "bad.json").write_text('{"i": 1}\n\n{"i": \n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.json"), "i long").collect()


def test_other_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,b\n")
    assert files.read_csv(spark, str(tmp_path / "a.csv"), "x int, y string").first()["y"] == "b"
    (tmp_path / "c.json").write_text(json.dumps({"7": [{"title": "a"}, {"title": "b"}], "8": []}))
    got = files.read_clusters(spark, str(tmp_path / "c.json"), "title:string").orderBy("pos").collect()
    assert [(r.cluster_id, r.pos, r.article.title) for r in got] == [("7", 0, "a"), ("7", 1, "b")]
    for name in ("wiki_1.json", "sensitive_wiki.json", "chain.json", "other.json"):
        (tmp_path / "r").mkdir(exist_ok=True)
        (tmp_path / "r" / name).write_text('{"idx": 1}\n')
    assert sorted(r.type for r in files.read_responses(spark, str(tmp_path / "r"), "idx long").collect()) == ["evolution", "sensitive_wiki", "wiki"]
    m = spark.createDataFrame([("x/a.gz",), ("x/b.gz",)], "path string")
    assert [r.path for r in files.unread(spark, m, m.limit(0), ["b.gz"]).collect()] == ["x/b.gz"]
    assert files.unread(spark, m, m).count() == 0
    (tmp_path / "t.txt").write_text(" a {x}\n\n")
    assert files.read_text(spark, str(tmp_path / "t.txt")) == "a {x}"
    assert files.config({"a": {"b": 1}}, a__b=2, a__c=None) == {"a": {"b": 2}}
    assert spark.range(1).select(files.string_list(F.lit("['a b', \"c\"]")).alias("x")).first().x == ["a b", "c"]
    assert files.py_string_list("['a', 1]") == ["a"] and files.py_string_list("import os") == []
    v = spark.createDataFrame([(1, [0.1, 0.2]), (2, None)], "id long, embedding array<double>")
    files.write_vectors(v, str(tmp_path / "v"))
    assert np.allclose(spark.read.parquet(str(tmp_path / "v")).first().embedding, np.array([0.1, 0.2], np.float16))


def warc_record(kind, url, body):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def test_warc(spark, tmp_path):
    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<html>\xe9</html>"
    odd = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=nonesuch\r\n\r\n" + "é".encode()
    data = gzip.compress(warc_record("request", "u", b"x")) + gzip.compress(warc_record("response", "http://a/", page)) + gzip.compress(warc_record("response", "http://b/", odd))
    (tmp_path / "x.warc.gz").write_bytes(data)
    got = {r.url: r.html for r in files.read_warc(spark, str(tmp_path / "x.warc.gz")).collect()}
    assert got == {"http://a/": "<html>é</html>", "http://b/": "é"}
    # a body that holds the mark, raw files, a record that ends early, an empty file, several files
    mark = b"HTTP/1.1 200 OK\r\n\r\nsee WARC/1.0\r\nWARC-Type: response\r\n\r\nWARC/1.1 too"
    (tmp_path / "y.warc").write_bytes(b"junk\n" + warc_record("warcinfo", "", b"i") + warc_record("response", "http://c/", mark) + warc_record("response", "http://d/", page)[:-30])
    (tmp_path / "z.warc").write_bytes(b"")
    (tmp_path / "w.warc.gz").write_bytes(gzip.compress(b"".join(warc_record("response", f"http://w/{i}", page) for i in range(700))))
    got = {r.url: r.html for r in files.read_warc(spark, str(tmp_path)).collect()}
    assert len(got) == 703 and got["http://c/"] == mark.split(b"\r\n\r\n", 1)[1].decode()


def test_fetching_and_idempotent_sink(spark, tmp_path):
    (tmp_path / "m.gz").write_bytes(gzip.compress(b"a/1.gz\n\nb/2.gz\nbad.gz\n"))
    m = files.read_manifest(spark, str(tmp_path / "m.gz"))

    def fetch(path):
        if path == "bad.gz":
            raise OSError("gone")
        return path.encode()

    out = str(tmp_path / "out")
    for only in (["1.gz"], None, None):
        files.append_new(spark, m, lambda x: files.fetched(x, fetch, 2, 0.0).where("error IS NULL"), out, only)
    assert sorted((r.path, bytes(r.content)) for r in spark.read.parquet(out).collect()) == [("a/1.gz", b"a/1.gz"), ("b/2.gz", b"b/2.gz")]
    assert [r.error for r in files.fetched(m.where("path = 'bad.gz'"), fetch, 2, 0.0).collect()] == ["gone"]


def test_configuration_and_small_files(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("# top\nseed: 42\nname: 'x: y'\nnested:\n  deep:\n    rate: 0.5  # half\n    whole: true\n  none: null\nlist:\n  - a\n  - 2\nflow: [1, b]\n")
    got = files.load_config(spark, str(tmp_path / "c.yaml"), nested__deep__rate=0.7, seed=None)
    assert got == {"seed": 42, "name": "x: y", "nested": {"deep": {"rate": 0.7, "whole": True}, "none": None}, "list": ["a", 2], "flow": [1, "b"]}
    assert files._simple_yaml((tmp_path / "c.yaml").read_text()) | {"nested": 0} == got | {"nested": 0} and files._simple_yaml("") == {}
    (tmp_path / "c.json").write_text('{"a": {"b": 1}}')
    assert files.load_config(spark, str(tmp_path / "c.json"), a__b=3) == {"a": {"b": 3}}
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    files.write_sidecar(spark, str(tmp_path / "side"), {"model": "m"}, df)
    assert files.read_sidecar(spark, str(tmp_path / "side")) == {"model": "m", "rows": 1, "columns": ["a", "b"]}
    (tmp_path / "p.json").write_text('{"1": null, "2": 1, "5": 2}')
    assert sorted((r.child, r.parent) for r in files.read_parents(spark, str(tmp_path / "p.json")).where("parent IS NOT NULL").collect()) == [(2, 1), (5, 2)]
    df.write.parquet(str(tmp_path / "v1" / "large"))
    files.write_reference(spark, str(tmp_path / "v1" / "all"), str(tmp_path / "v1" / "large"))
    assert files.read_reference(spark, str(tmp_path / "v1" / "all")).count() == 1
    assert files.version_paths("/x/", "v2", ("qa",)) == {"qa": "/x/v2/qa"}
    ids = spark.createDataFrame([("b", 1, None), ("a", 5, 70), ("a", 3, None)], "_file string, _pos long, article_idx long")
    assert [r.article_idx for r in files.with_default_id(ids, "article_idx").orderBy("_file", "_pos").collect()] == [0, 70, 2]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "wiki.json").write_text('{"idx": \n')
    with pytest.raises(Exception):
        files.read_responses(spark, str(tmp_path / "bad"), "idx long").collect()


def test_pages(spark):
    html = '<html lang="EN"><head><title> A  b </title><script>x</script></head><body><nav>n</nav><p>One <b>two</b><p>three<br>four</body></html>'
    assert web.read_page(html) == ("A b", "One two\nthree\nfour")
    assert web.read_page(None) == ("", "")
    df = spark.createDataFrame([(1, html), (2, "<p>x"), (3, None)], "i int, html string").select("i", web.declared_language("html").alias("l"))
    assert [r.l for r in df.orderBy("i").collect()] == ["en", "", None]


def test_publish(spark):
    spec = Spec("r", "T", configs=(Config("large", {"train": "a/all.jsonl", "test": "b/x.parquet"}, True),))
    found = spark.createDataFrame([("a/all.jsonl", 5)], "path string, size long")
    assert [tuple(r) for r in upload_plan(spark, spec, found).collect()] == [("a/all.jsonl", "large/train.jsonl", 5)]
    assert missing_files(spark, spec, found).count() == 1
    assert "config_name: large" in card(spec, "text") and card(spec).startswith("---\n")
    merged = merge_metadata({"@context": ["http://s", {"a": "b"}], "x": 1}, {"x": 2}, {"n": "m"})
    for made, n in ((entity_spec("r", "T", "d"), 19), (entity_spec("r", "T", "d", index=False, qa=False), 9), (news_spec("r", "T", "d"), 11), (news_spec("r", "T", "d", corpus=False), 2)):
        assert sum(len(c.files) for c in made.configs) == n == missing_files(spark, made, found).count()
    assert total_size(upload_plan(spark, spec, found)).first() == (1, 5)
    assert merged == {"@context": {"@vocab": "http://s", "a": "b", "n": "m"}, "x": 2}


def test_prompts_and_stream(spark, tmp_path):
    p = spark.createDataFrame([(0, "a"), (1, "bad"), (2, "c")], "idx long, prompt string")

    def client(prompt, seed):
        if prompt == "bad":
            raise RuntimeError
        return f"{prompt}{seed}"

    got = {r.idx: r.response for r in prompts.answered(p, p.where("idx = 0"), client).collect()}
    assert got == {2: "c44"}
    assert {r.idx: (r.response, r.error) for r in prompts.asked(p, p.where("idx = 0"), client).collect()} == {1: (None, "RuntimeError: "), 2: ("c44", None)}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"idx": 0, "prompt": "a"}\n{"idx": 1, "prompt": "bad"}\n')
    for _ in range(2):
        q = answer_stream(spark, str(tmp_path / "in"), "idx long, prompt string", str(tmp_path / "out"), str(tmp_path / "ck"), client)
        q.awaitTermination(120)
    assert [(r.idx, r.response) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(0, "a42")]


def test_entities(spark):
    e = entities.chain_depth(spark.createDataFrame([(2, 1), (3, 2), (4, 3), (9, 8), (7, 6), (6, 7)], "child long, parent long"))
    assert {r.node: (r.root, r.depth) for r in e.collect()} == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (1, 3), 8: (8, 0), 9: (8, 1)}
    long = spark.createDataFrame([(i + 1, i) for i in range(100)], "child long, parent long")
    assert {r.node: r.depth for r in entities.chain_depth(long).collect()} == {i: i for i in range(101)}
    assert entities.chain_depth(long.limit(0)).count() == 0
    names = entities.apply_names(spark.createDataFrame([(1, 1), (1, 2)], "line_id long, stage int"), spark.createDataFrame([(1, ["x", "y"])], "line_id long, names array<string>"), spark.createDataFrame([], "line_id long, names array<string>"), spark.createDataFrame([(1, ["z"])], "line_id long, names array<string>"))
    assert sorted((r.stage, r.name) for r in names.collect()) == [(1, "z"), (2, None)]


def test_generated_entities(spark, folder):
    rows = entities.QUERIES["generate_entities"](spark, folder).collect()
    assert sorted(r.idx for r in rows) == list(range(10_000, 10_600))
    of_type = {r.type: {m["name"] for m in r.moves} for r in entities.moves_by_type(entities._moves(spark, folder)).collect()}
    lines = {}
    for r in rows:
        lines.setdefault(r.line_id, []).append(r)
        assert r.type1 != r.type2 and r.ability in ("calm", "swift", "iron skin")
        moves = of_type.get(r.type1, set()) | of_type.get(r.type2, set())
        assert r.move.name in moves if moves else r.move.name is None
        assert r.base_stat_total == sum(r[s] for s in entities.STATS)
    assert sorted(map(len, lines.values())) == [1] * 100 + [2] * 100 + [3] * 100
    changed = 0
    for m in lines.values():
        m.sort(key=lambda r: r.stage)
        assert [r.idx - m[0].idx for r in m] == list(range(len(m))) and len({r.type1 for r in m}) == 1
        for r in m[1:]:
            low, high = {2: (1.2, 1.6), 3: (1.6, 2.2)}[r.stage]
            assert all(low * m[0][s] - 0.5 <= r[s] <= high * m[0][s] + 0.5 for s in (*entities.STATS, "weight", "height"))
        for a, b in zip(m, m[1:]):
            assert a.type2 is None or b.type2 is not None
            changed += a.type2 is not None and a.type2 != b.type2
        assert all(10 <= m[0][s] < 120 for s in entities.STATS) and 1 <= m[0].weight < 200 and 1 <= m[0].height < 20
    assert changed < 60 and 20 < sum(m[0].weight for m in lines.values()) / 300 < 60
    assert entities.generate(spark, {}, ["a"], entities._moves(spark, folder), [], {"hp": (1, 9, 4.0, 2.0)}, {"weight": (1, 9, 4.0)}, {}).count() == 0


def test_names_of_moves_and_abilities(spark):
    m = spark.createDataFrame([("B c", " Fire ", "x"), ("A", "fire", None), ("one two three", "fire", "x"), ("D", None, "x"), ("E", " ", "x"), (None, "fire", "x")], "name string, type string, short_description string")
    assert [(r.type, [tuple(x) for x in r.moves]) for r in entities.moves_by_type(m).collect()] == [("fire", [("A", ""), ("B c", "x")])]
    a = spark.createDataFrame([("['run', \"don't stop\"]",), ("['one two three', ' run ']",), (None,), ("junk",)], "x string")
    assert sorted(r.ability for r in entities.ability_names(a, "x").collect()) == ["don't stop", "run"]


def test_subword_tokens(spark, folder):
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokens._path())
    lib.encode_special_tokens = True
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in docs.items()}
    assert {r.doc_id: r.n_tokens for r in tokens.QUERIES["subword_counts"](spark, folder).collect()} == want
    assert sum(r.n for r in tokens.QUERIES["subword_stats_by_lang"](spark, folder).collect()) == len(want)
    df = spark.createDataFrame([(1, "a<|endoftext|> b c d e f g h", 5), (None, None, 6), (2, "", 7), (3, "short", 8)], "i int, t string, given int")
    got = {r.i: (r.cut, r.given) for r in tokens.truncate_tokens(df, "t", public_tokenizers.path("byte_bpe_50k.json"), 4).collect()}
    cut = lib.decode(lib.encode("a<|endoftext|> b c d e f g h", add_special_tokens=False).ids[:4])
    assert got == {1: (cut, 5), None: ("", 6), 2: ("", 7), 3: ("short", 8)}
    assert tokens.truncate_tokens(df, "t", tokens._path(), 0).count() == 4


def test_article_queries(spark, folder):
    """Pages restated in Python, by the same reader of a page."""
    import re

    stop = web.STOP_WORDS
    want, total, skipped, long = {}, 0, 0, 0
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        total += 1
        m = re.search(r"""(?i)<html[^>]*\slang=["']([a-zA-Z]{2})""", (r.html or "")[:2000])
        if m and m[1].lower() != "en":
            skipped += 1
            continue
        title, body = web.read_page(r.html)
        if len(body.strip()) < 50:
            continue
        long += 1
        words = re.split(r"[^\W\d_]+", "")  # no words yet
        words = [w for w in re.split(r"[\W\d_]+", body[:1000].lower()) if w]
        best = min((-sum(w in s for w in words), l) for l, s in stop.items())
        if best[0] < 0 and best[1] == "en":
            want[r.page_id] = (title, len(body))
    assert {r.page_id: (r.title, r.n) for r in web.QUERIES["articles"](spark, folder).collect()} == want and want
    assert tuple(web.QUERIES["extraction_counters"](spark, folder).first()) == (total, skipped, long, len(want))


def test_event_cluster_query(spark, folder):
    """Windows of three days; mutual among the 30 nearest at 0.3 or more; components."""
    rows = sorted((r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect())
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    linked = set()
    for day in range(-2, 30):
        some = [(i, v / np.linalg.norm(v)) for i, v in rows if day <= i % 30 <= day + 2]
        if len(some) < 2:
            continue
        m = np.stack([v for _, v in some])
        sim = np.round(m @ m.T, 6)
        np.fill_diagonal(sim, -2)
        kth = np.sort(sim, 1)[:, -30] if len(some) >= 30 else np.full(len(some), -2.0)
        floor = np.maximum(kth, 0.3)
        for a, b in zip(*np.nonzero(np.triu(sim >= np.maximum(floor[:, None], floor), 1)), strict=True):
            p, q = top(some[a][0]), top(some[b][0])
            up[max(p, q)] = min(p, q)
            linked |= {some[a][0], some[b][0]}
    want = {i: top(i) for i in linked}
    assert {r.doc_id: r.cluster_id for r in retrieval.QUERIES["event_clusters"](spark, folder).collect()} == want and len(want) > 50


def test_vectors(spark):
    v = spark.createDataFrame([(i, "2024-01-01", [1.0, i / 10]) for i in range(4)] + [(9, "2024-03-01", [1.0, 0.0])], "doc_id long, d string, embedding array<double>").select("doc_id", F.col("d").cast("date").alias("day"), "embedding")
    assert {r.doc_id: r.cluster_id for r in retrieval.event_clusters(v).collect()} == {i: 0 for i in range(4)}
    assert sorted(r.doc_id for r in retrieval.shard(v, "doc_id", 1, 2).collect()) == [3, 9]
    got = retrieval.encode(spark.createDataFrame([(1, "a b a"), (2, "")], "k long, t string"), "k", "t").orderBy("k").collect()
    assert abs(sum(x * x for x in got[0].embedding) - 1) < 1e-6 and got[1].embedding is None


@pytest.mark.parametrize("rows", [2048, 16])
def test_event_clusters_above_k(spark, monkeypatch, rows):
    """Equal vectors and ones that tie share a cluster, however many; another event keeps its own."""
    monkeypatch.setattr(retrieval, "FACING", rows, raising=False)
    vecs = [[1.0, 0.0, 0.0]] * 200 + [[1.0 + i / 64, 0.0, 0.0] for i in range(1, 100)] + [[0.0, 1.0, i / 1000] for i in range(5)] + [[0.0, 0.0, 0.0]] * 3
    v = spark.createDataFrame([(i, f"2024-01-0{1 + i % 2}", x) for i, x in enumerate(vecs)], "doc_id long, d string, embedding array<double>").select("doc_id", F.col("d").cast("date").alias("day"), "embedding")
    want = {i: 0 for i in range(299)} | {i: 299 for i in range(299, 304)}
    assert {r.doc_id: r.cluster_id for r in retrieval.event_clusters(v).collect()} == want


def test_retrieval_with_odd_rows(spark, monkeypatch):
    """Ragged, null and repeated vectors; tiles and passes of every size give one result."""
    rng = np.random.default_rng(3)
    docs = [(i, rng.standard_normal(3 if i % 4 else 2).round(1).tolist()) for i in range(90)] + [(5, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (200, None), (201, []), (202, [float("nan"), 1.0]), (203, [None, 1.0])]
    ask = [(i % 7, rng.standard_normal(3 if i % 3 else 2).round(1).tolist()) for i in range(12)] + [(None, [1.0, 0.0]), (9, None), (10, [1.0, 2.0, 3.0, 4.0])]
    d = spark.createDataFrame(docs, "doc_id long, embedding array<double>")
    q = spark.createDataFrame(ask, "query_id long, embedding array<double>")
    want = {}
    for i, v in ask:
        if i is None or v is None:
            continue
        sims = sorted({(-round(float(np.dot(v, x)), 6), j) for j, x in docs if j is not None and x and len(x) == len(v) and None not in x and np.isfinite(x).all()})
        for n, (s, j) in enumerate(sims):
            if n < 4 or -s >= 1.5:
                want[i, j] = max(want.get((i, j), -9), -s)
    for tile, cells in ((4096, 4_000_000), (5, 300)):
        monkeypatch.setattr(retrieval, "DOC_TILE", tile)
        monkeypatch.setattr(retrieval, "QUERY_TILE", tile)
        monkeypatch.setattr(retrieval, "PASS_CELLS", cells)
        got = {(r.query_id, r.doc_id): r.sim for r in retrieval.topk_or_threshold(q, d, 4, 1.5).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)
    assert retrieval.topk_or_threshold(q.limit(0), d, 4, 1.5).count() == 0 == retrieval.topk_or_threshold(q, d.limit(0), 4, 1.5).count()


def test_lede_and_templates(spark):
    r = spark.createDataFrame([("a\n\nb", "{b}", "z")], "t string, a string, b string").select(text.lede("t", 10).alias("l"), text.lede(F.lit("abcdef"), 3, "...").alias("c"), text.fill("{a}{b}", a="a", b="b").alias("f"), text.truncate_words(F.lit("a  b c"), 2).alias("w")).first()
    assert tuple(r) == ("a", "abc...", "zz", "a  b ")
