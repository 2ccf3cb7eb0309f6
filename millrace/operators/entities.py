"""Synthetic entity lines: chains, ratio grids, generation, naming."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import fill, strip, word_count
from millrace.operators.cleaning import dense_id
from millrace.operators.statistics import rounded
from millrace.plans.work import forget, written
from millrace.sources import table
from millrace.sources.files import string_list


def chain_depth(edges: DataFrame) -> DataFrame:
    """``edges(child, parent)`` -> ``node, root, depth``; roots have no parent.

    Doubling: round k reaches 2 ** k links, and rounds go on until no chain grows, whatever its
    length. Of several parents of a child the least counts. Nodes on a cycle, and below one, have no
    root and are left out, as they never stop growing: rounds end at the number of nodes. Null
    children are ignored, a null parent makes a root; an empty table gives no rows.
    """
    nodes = edges.select(F.col("child").alias("node"), "parent").union(edges.select(F.col("parent").alias("node"), F.lit(None).cast(edges.schema["parent"].dataType)))
    up = nodes.where("node IS NOT NULL").groupBy("node").agg(F.min("parent").alias("up"))
    up = written(up.select("node", F.coalesce("up", "node").alias("up"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("up").isNull().alias("done")), "up")
    left = up.where("NOT done").count()
    for _ in range(max(1, up.count()).bit_length() + 1):
        if not left:
            break
        nxt = up.select(F.col("node").alias("up"), F.col("up").alias("u2"), F.col("depth").alias("d2"), F.col("done").alias("done2"))
        new = up.where("done").select("node", "up", "depth", "done").union(up.where("NOT done").join(nxt, "up").select("node", F.col("u2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), F.col("done2").alias("done")))
        new = written(new, "up")
        forget(up)
        up, left = new, new.where("NOT done").count()
    return up.where("done").select("node", F.col("up").alias("root"), "depth")


def first_child_chain(edges: DataFrame, order: str) -> DataFrame:
    """``v1, v2, v3`` of each root: its first child by order, and that one's first child."""
    first = edges.groupBy("parent").agg(F.min_by("child", order).alias("child"))
    roots = edges.select(F.col("parent").alias("v1")).distinct().join(edges.select(F.col("child").alias("v1")), "v1", "left_anti")
    a = roots.join(first.select(F.col("parent").alias("v1"), F.col("child").alias("v2")), "v1", "left")
    return a.join(first.select(F.col("parent").alias("v2"), F.col("child").alias("v3")), "v2", "left").select("v1", "v2", "v3")


def stage_ratios(chains: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """Ratios of a value between the stages of a chain; null where a stage is missing or the lower one is not positive."""
    out = chains
    for v in ("v1", "v2", "v3"):
        out = out.join(values.select(F.col(key).alias(v), F.col(value).cast("double").alias(f"x_{v}")), v, "left")
    r = lambda a, b: F.when(F.col(f"x_{b}") > 0, F.col(f"x_{a}") / F.col(f"x_{b}"))
    return out.select("v1", r("v2", "v1").alias("r21"), r("v3", "v1").alias("r31"), r("v3", "v2").alias("r32"))


def ratio_grid(ratios: DataFrame, value: str) -> DataFrame:
    """Bounds to two decimals outward, mean within [0.05, max], deviation within the range, points 0.1 apart."""
    x = ratios.where(F.col(value).isNotNull()).agg((F.floor(F.min(value) * 100) / 100).alias("lo"), (F.ceil(F.max(value) * 100) / 100).alias("hi"), F.avg(value).alias("m"), F.stddev_samp(value).alias("s"))
    n = F.ceil((F.col("hi") - F.col("lo")) / 0.1 - 1e-9)
    return x.select(F.lit(value).alias("ratio"), "lo", "hi", F.least(F.greatest("m", F.lit(0.05)), "hi").alias("mean"), F.least("s", F.col("hi") - F.col("lo")).alias("std"), n.cast("long").alias("points"))


def uniform(*cols: Column, seed: int) -> Column:
    """A number in (0, 1) from hashes of the columns: the same on any partitioning."""
    return (F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def gaussian_pick(lo: int, hi: int, mean: float, std: float, u: Column) -> Column:
    """An integer of [lo, hi) by the inverse of the cumulated weights exp(-((x - mean) / std) ** 2 / 2)."""
    import math

    weights = [math.exp(-0.5 * ((x - mean) / std) ** 2) for x in range(lo, hi)]
    total, run, steps = sum(weights), 0.0, []
    for w in weights:
        run += w / total
        steps.append(run)
    below = F.size(F.filter(F.array(*map(F.lit, steps)), lambda s: s < u))
    return F.least(below + lo, F.lit(hi - 1))


def exponential_pick(lo: int, hi: int, mean: float, u: Column) -> Column:
    """An integer of [lo, hi) with weights exp(-x / mean), by the inverse of their sum, which has a closed form."""
    import math

    r = math.exp(-1.0 / mean)
    x = F.floor(F.log1p(u * (r ** (hi - lo) - 1.0)) / math.log(r)).cast("int") + lo
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi - 1))


def moves_by_type(moves: DataFrame, most_words: int = 2) -> DataFrame:
    """``moves(name, type, short_description)`` -> ``type, moves array<struct<name, short_description>>`` by name.

    Types in lower case without blanks; moves without a type, without a name, or of more than
    ``most_words`` words are left out; a missing description is empty.
    """
    kind = F.lower(strip(F.col("type")))
    one = moves.where(F.col("name").isNotNull() & (word_count("name") <= most_words) & (kind != ""))
    one = one.select(kind.alias("type"), F.struct("name", F.coalesce("short_description", F.lit("")).alias("short_description")).alias("m"))
    return one.groupBy("type").agg(F.sort_array(F.collect_list("m")).alias("moves"))


def ability_names(lists: DataFrame, column: str, most_words: int = 2) -> DataFrame:
    """``ability``: distinct names of at most ``most_words`` words from printed lists, by pattern and never by evaluation."""
    one = lists.select(F.explode(string_list(F.col(column))).alias("a")).select(strip(F.col("a")).alias("ability"))
    return one.where((F.col("ability") != "") & (word_count("ability") <= most_words)).distinct()


def distinct_types(df: DataFrame, *columns: str) -> DataFrame:
    """``type``: the distinct values of several columns in lower case, nulls left out."""
    return df.select(F.explode(F.array(*[F.lower(c) for c in columns])).alias("type")).where("type IS NOT NULL").distinct()


def generate(spark, lines: dict[int, int], types: list[str], moves: DataFrame, abilities: list[str], stats: dict[str, tuple[int, int, float, float]], sizes: dict[str, tuple[int, int, float]], growth: dict[int, tuple[float, float]], second: dict[int, tuple[float, ...]] | None = None, change: float = 0.1, seed: int = 123, first_id: int = 10_000) -> DataFrame:
    """Entity lines: ``lines[stages]`` lines of each length -> one row per entity.

    Stage 1 draws every stat from its grid by Gaussian weights and every size (height, weight) by
    exponential ones; later stages multiply stage 1 by a ratio drawn evenly from ``growth[stage]``
    and round half to even. A line keeps its first type; ``second[stages]`` are the chances of a
    second type by stage, which later stages keep, or change with chance ``change``. Every entity
    draws an ability, and a move of either of its types (``moves_by_type``); none if there is none.
    Lines are shuffled by hash and ids run through lines in that order. All draws follow from hashes
    of seed, line and stage. No line: no rows.
    """
    second = second or {3: (0.2, 0.4, 0.6), 2: (0.3, 0.5), 1: (0.4,)}
    rows = [(n, k) for n, count in lines.items() for k in range(count)]
    base = spark.createDataFrame(rows or [(0, 0)], "stages int, k int").where(F.lit(bool(rows)))
    base = base.withColumn("line_id", F.xxhash64(F.lit(seed), "stages", "k"))
    u = lambda name, *c: uniform(F.lit(name), F.col("line_id"), *c, seed=seed)
    pick = lambda items, x: F.element_at(items, (F.floor(x * F.size(items)) + 1).cast("int"))
    names = F.array(*map(F.lit, types))
    e = base.select("*", pick(names, u("type1")).alias("type1"), *[gaussian_pick(*p, u(s)).alias(f"b_{s}") for s, p in stats.items()], *[exponential_pick(*p, u(s)).alias(f"b_{s}") for s, p in sizes.items()])
    # the second type of stages 1, 2 and 3, each from the one before
    for n in range(1, max([*lines, 1]) + 1):
        before = F.col(f"t{n - 1}") if n > 1 else F.lit(None).cast("string")
        others, other = _without(names, F.col("type1")), _without(names, F.col("type1"), F.coalesce(before, F.lit("")))
        chance = F.coalesce(*[F.when(F.col("stages") == m, F.lit(float(p[n - 1]))) for m, p in second.items() if len(p) >= n], F.lit(0.0))
        fresh_one = F.when((u(f"second{n}") < chance) & (F.size(others) > 0), pick(others, u(f"name{n}")))
        kept = F.when((u(f"change{n}") < change) & (F.size(other) > 0), pick(other, u(f"name{n}"))).otherwise(before)
        e = e.withColumn(f"t{n}", F.when(before.isNull(), fresh_one).otherwise(kept))
    seconds = F.array(*[F.col(f"t{n}") for n in range(1, max([*lines, 1]) + 1)])
    e = e.select("*", F.explode(F.sequence(F.lit(1), F.col("stages"))).alias("stage")).withColumn("type2", F.get(seconds, F.col("stage") - 1))
    for s in (*stats, *sizes):
        grown = F.col(f"b_{s}").cast("double")
        for n, (low, high) in growth.items():
            grown = F.when(F.col("stage") == n, F.bround(F.col(f"b_{s}") * (low + (high - low) * u(f"{s}{n}")))).otherwise(grown)
        e = e.withColumn(s, grown.cast("long"))
    e = e.withColumn("base_stat_total", sum((F.col(s) for s in stats), F.lit(0).cast("long")))
    e = e.withColumn("ability", pick(F.array(*map(F.lit, abilities)), u("ability", F.col("stage"))) if abilities else F.lit(None).cast("string"))
    e = with_moves(e, moves, lambda: u("move", F.col("stage")))
    e = dense_id(e, ["line_id", "stage"], "idx").withColumn("idx", F.col("idx") + first_id)
    return e.select("idx", "line_id", "stages", "stage", "type1", "type2", "ability", *stats, "base_stat_total", *sizes, "move")


def _without(items: Column, *values: Column) -> Column:
    return F.filter(items, lambda x: ~x.isin(*values))


def with_moves(entities: DataFrame, moves: DataFrame, draw) -> DataFrame:
    """Adds ``move``: one drawn from the moves of the first and the second type together; nulls without any."""
    m = moves_by_type(moves)
    one, two = (m.select(F.col("type").alias(t), F.col("moves").alias(f"of_{t}")) for t in ("type1", "type2"))
    j = entities.join(one, "type1", "left").join(two, "type2", "left")
    empty = F.array().cast("array<struct<name:string,short_description:string>>")
    every = F.concat(F.coalesce("of_type1", empty), F.coalesce("of_type2", empty))
    at = F.floor(draw() * F.size(every)).cast("int")
    none = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("short_description"))
    return j.withColumn("move", F.coalesce(F.get(every, at), none)).drop("of_type1", "of_type2")


def line_text(members: Column | str, names: bool = False) -> Column:
    """A line's stages for a prompt: types, ability and move, and either its numbers or its names."""

    def one(g: Column, i: Column) -> Column:
        n = (i + 1).cast("string")
        types = F.concat(g["type1"], F.coalesce(F.concat(F.lit(" / "), g["type2"]), F.lit("")))
        common = F.format_string("  Types: %s\n  Ability: %s\n  Move: %s", types, g["ability"], g["move"]["name"])
        if names:
            return F.concat(F.lit("Stage "), n, F.lit(": Name="), F.coalesce(g["name"], F.lit("None")), F.lit("\n"), common)
        numbers = F.format_string("\n  HP: %d, Attack: %d, Defense: %d\n  Special Attack: %d, Special Defense: %d, Speed: %d\n  Base Stat Total: %d\n  Weight: %d lbs, Height: %d m", *[g[c] for c in ("hp", "attack", "defense", "special_attack", "special_defense", "speed", "base_stat_total", "weight", "height")])
        return F.concat(F.lit("Stage "), n, F.lit(":\n"), common, numbers)

    return F.array_join(F.transform(members, one), "\n\n")


def naming_prompts(entities: DataFrame, template: str = "Name the stages of this line as JSON lines.\n\n{line}") -> DataFrame:
    """One prompt per line: ``idx, prompt, line_key, line_length, tag``; idx is dense by the line's first entity."""
    g = entities.groupBy("line_id").agg(F.sort_array(F.collect_list(F.struct("idx", *[c for c in entities.columns if c not in ("idx", "line_id")]))).alias("m"))
    out = dense_id(g.select(F.col("m")[0]["idx"].alias("first"), "m"), ["first"], "at")
    n = F.size("m")
    return out.select(F.col("at").alias("idx"), fill(template, line=line_text("m")).alias("prompt"), F.concat(n.cast("string"), F.lit("stage_"), F.col("at").cast("string")).alias("line_key"), n.alias("line_length"), F.transform("m", lambda x: x["idx"]).alias("tag"))


def lines_by_stage(prompts: DataFrame) -> DataFrame:
    """Lines of each length."""
    return prompts.groupBy("line_length").agg(F.count("*").alias("n"))


#: What is asked of every entity, in order: the words of the question and the feature.
ASKED = (
    ("classification", "classification"), ("types", "types"), ("ability", "ability"), ("HP stat", "hp"), ("attack stat", "attack"), ("defense stat", "defense"), ("special attack stat", "special attack"),
    ("special defense stat", "special defense"), ("speed stat", "speed"), ("base stat total stat", "base_stat_total"), ("move", "move"), ("weight (in lbs)", "weight"), ("height (in meters)", "height"),
)


def entity_questions(entities: DataFrame) -> DataFrame:
    """``idx, name, qa_idx, question, answer, feature``: thirteen questions of every entity; answers are text.

    ``entities(idx, name, classification, type1, type2, ability, stats.., weight, height, move)``. An
    entity without a second type is of its first; a missing value is a null answer.
    """
    special = {"types": F.concat_ws(" and ", "type1", F.when(F.col("type2") != "", F.col("type2"))), "move": F.col("move.name")}
    rows = []
    for words, feature in ASKED:
        verb = "are" if feature == "types" else "is"
        a = special.get(feature, F.col(feature.replace(" ", "_")) if feature not in special else None)
        rows.append(F.struct(F.concat(F.lit(f"What {verb} the {words} of "), F.col("name"), F.lit("?")).alias("question"), a.cast("string").alias("answer"), F.lit(feature).alias("feature")))
    return entities.select("idx", "name", F.posexplode(F.array(*rows)).alias("qa_idx", "q")).select("idx", "name", "qa_idx", "q.question", "q.answer", "q.feature")


def pretty(record: Column) -> Column:
    """A record as indented JSON; null fields are left out."""
    return F.to_json(record, {"pretty": "true"})


def apply_names(index: DataFrame, first: DataFrame, by_class: DataFrame, by_name: DataFrame) -> DataFrame:
    """``index(line_id, stage)`` with responses ``(line_id, names array<string>)``: a later asking wins
    (by name, then by class, then the first); names go to stages by place."""
    j = index
    for k, r in (("n", by_name), ("c", by_class), ("f", first)):
        j = j.join(r.groupBy("line_id").agg(F.any_value("names").alias(f"names_{k}")), "line_id", "left")
    return j.select(*index.columns, F.try_element_at(F.coalesce("names_n", "names_c", "names_f"), F.col("stage")).alias("name"))


def _edges(s, d):
    # a parent rule on the parts: part k belongs under k // 3
    return table(s, d, "part").where("p_partkey >= 1").select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 3).cast("long").alias("parent")).where("parent >= 1")


def _ratios(s, d):
    return stage_ratios(first_child_chain(_edges(s, d), "child"), table(s, d, "part"), "p_partkey", "p_retailprice")


STATS = ("hp", "attack", "defense", "special_attack", "special_defense", "speed")


def _moves(s, d):
    """Parts as moves: the last word of a part's type is the move's type."""
    return table(s, d, "part").select(F.col("p_name").alias("name"), F.concat(F.lit(" "), F.upper(F.substring_index("p_type", " ", -1))).alias("type"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("short_description"))


def q_generate(s, d):
    stats = {x: (10, 120, 60.0, 25.0) for x in STATS}
    types = [r.type for r in distinct_types(_moves(s, d).select(strip(F.col("type")).alias("t")), "t").orderBy("type").collect()]  # a handful
    return generate(s, {1: 100, 2: 100, 3: 100}, types, _moves(s, d), ["calm", "swift", "iron skin"], stats, {"weight": (1, 200, 40.0), "height": (1, 20, 3.0)}, {2: (1.2, 1.6), 3: (1.6, 2.2)})


def q_moves(s, d):
    out = moves_by_type(_moves(s, d), 100)
    return out.select("type", F.size("moves").cast("long").alias("n"), F.md5(F.array_join(F.transform("moves", lambda m: F.concat_ws("/", m["name"], m["short_description"])), "|")).alias("moves_md5"))


def _entities(s, d):
    p = table(s, d, "part")
    n = {c: F.col("p_size") + i for i, c in enumerate((*STATS, "base_stat_total", "weight", "height"))}
    return p.select(F.col("p_partkey").alias("idx"), F.floor(F.col("p_partkey") / 3).cast("long").alias("line_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("classification"), F.col("p_type").alias("type1"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("type2"), F.lit("calm").alias("ability"), *[x.alias(c) for c, x in n.items()], F.struct(F.col("p_name").alias("name")).alias("move"))


def q_entity_questions(s, d):
    return entity_questions(_entities(s, d)).select("idx", "qa_idx", "question", "answer", "feature")


def q_naming(s, d):
    return naming_prompts(_entities(s, d)).select("idx", F.md5("prompt").alias("prompt_md5"), "line_key", "line_length", F.array_join(F.transform("tag", lambda x: x.cast("string")), ",").alias("tag"))


def q_abilities(s, d):
    lists = table(s, d, "part").select(F.concat(F.lit("['"), F.col("p_type"), F.lit("', \""), F.col("p_brand"), F.lit(" x\", 'one two three']")).alias("abilities"))
    return ability_names(lists, "abilities")


QUERIES = {
    "chain_depth": lambda s, d: chain_depth(_edges(s, d)),
    "stage_ratios": lambda s, d: rounded(_ratios(s, d)),
    "ratio_grids": lambda s, d: rounded(ratio_grid(_ratios(s, d), "r21").union(ratio_grid(_ratios(s, d), "r31"))),
    "generate_entities": q_generate,
    "moves_by_type": q_moves,
    "ability_names": q_abilities,
    "distinct_types": lambda s, d: distinct_types(table(s, d, "part"), "p_type", "p_brand"),
    "entity_questions": q_entity_questions,
    "naming_prompts": q_naming,
    "lines_by_stage": lambda s, d: lines_by_stage(naming_prompts(_entities(s, d))),
    "pretty_json": lambda s, d: table(s, d, "region").select("r_regionkey", pretty(F.struct("r_regionkey", "r_name")).alias("json")),
}
_E = "(SELECT p_partkey AS child, p_partkey // 3 AS parent FROM part WHERE p_partkey >= 3)"
_C = f"""(SELECT v1, v2, c.child AS v3 FROM (SELECT r.v1, b.child AS v2 FROM (SELECT DISTINCT parent AS v1 FROM {_E} WHERE parent NOT IN (SELECT child FROM {_E})) r
  LEFT JOIN (SELECT parent, min(child) AS child FROM {_E} GROUP BY 1) b ON b.parent = v1) LEFT JOIN (SELECT parent, min(child) AS child FROM {_E} GROUP BY 1) c ON c.parent = v2)"""
_R = f"""(SELECT v1, CASE WHEN a.p_retailprice > 0 THEN b.p_retailprice / a.p_retailprice END AS r21, CASE WHEN a.p_retailprice > 0 THEN c.p_retailprice / a.p_retailprice END AS r31,
  CASE WHEN b.p_retailprice > 0 THEN c.p_retailprice / b.p_retailprice END AS r32 FROM {_C} LEFT JOIN part a ON a.p_partkey = v1 LEFT JOIN part b ON b.p_partkey = v2 LEFT JOIN part c ON c.p_partkey = v3)"""


def _grid(r: str) -> str:
    return f"SELECT '{r}' AS ratio, round(lo, 6) AS lo, round(hi, 6) AS hi, round(least(greatest(m, 0.05), hi), 6) AS mean, round(least(s, hi - lo), 6) AS std, CAST(ceil((hi - lo) / 0.1 - 1e-9) AS BIGINT) AS points FROM (SELECT floor(min({r}) * 100) / 100 AS lo, ceil(max({r}) * 100) / 100 AS hi, avg({r}) AS m, stddev_samp({r}) AS s FROM {_R})"


SQL = {
    "chain_depth": f"""WITH RECURSIVE n AS (SELECT child AS node FROM {_E} UNION SELECT parent FROM {_E}), t AS (
SELECT node, node AS root, 0 AS depth FROM n WHERE node NOT IN (SELECT child FROM {_E}) UNION ALL SELECT e.child, t.root, t.depth + 1 FROM t JOIN {_E} e ON e.parent = t.node)
SELECT node, root, CAST(depth AS BIGINT) AS depth FROM t""",
    "stage_ratios": f"SELECT v1, round(r21, 6) AS r21, round(r31, 6) AS r31, round(r32, 6) AS r32 FROM {_R}",
    "ratio_grids": f"{_grid('r21')} UNION ALL {_grid('r31')}",
    "moves_by_type": """SELECT lower(list_extract(string_split(p_type, ' '), -1)) AS type, count(*) AS n, md5(string_agg(p_name || '/' || CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END, '|' ORDER BY p_name, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END)) AS moves_md5 FROM part GROUP BY 1""",
    "ability_names": "SELECT DISTINCT a AS ability FROM (SELECT p_type AS a FROM part UNION ALL SELECT p_brand || ' x' FROM part) WHERE len(string_split(trim(a), ' ')) <= 2 AND a <> ''",
    "distinct_types": "SELECT lower(p_type) AS type FROM part WHERE p_type IS NOT NULL UNION SELECT lower(p_brand) FROM part WHERE p_brand IS NOT NULL",
    "entity_questions": " UNION ALL ".join(
        f"SELECT p_partkey AS idx, CAST({i} AS INTEGER) AS qa_idx, 'What {'are' if f == 'types' else 'is'} the {w} of ' || p_name || '?' AS question, CAST({x} AS VARCHAR) AS answer, '{f}' AS feature FROM part"
        for i, ((w, f), x) in enumerate(zip(ASKED, ("p_brand", "CASE WHEN p_partkey % 2 = 0 THEN p_type || ' and ' || p_brand ELSE p_type END", "'calm'", *(f"p_size + {k}" for k in range(7)), "p_name", "p_size + 7", "p_size + 8"), strict=True))
    ),
    "naming_prompts": """WITH e AS (SELECT p_partkey AS idx, p_partkey // 3 AS line, row_number() OVER (PARTITION BY p_partkey // 3 ORDER BY p_partkey) AS i, * FROM part),
l AS (SELECT line, min(idx) AS first, count(*) AS n, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS tag, string_agg('Stage ' || i || ':' || chr(10) || '  Types: ' || p_type || CASE WHEN idx % 2 = 0 THEN ' / ' || p_brand ELSE '' END || chr(10) || '  Ability: calm' || chr(10) || '  Move: ' || p_name || chr(10) ||
  '  HP: ' || p_size || ', Attack: ' || (p_size + 1) || ', Defense: ' || (p_size + 2) || chr(10) || '  Special Attack: ' || (p_size + 3) || ', Special Defense: ' || (p_size + 4) || ', Speed: ' || (p_size + 5) || chr(10) || '  Base Stat Total: ' || (p_size + 6) || chr(10) || '  Weight: ' || (p_size + 7) || ' lbs, Height: ' || (p_size + 8) || ' m', chr(10) || chr(10) ORDER BY idx) AS body FROM e GROUP BY line)
SELECT row_number() OVER (ORDER BY first) - 1 AS idx, md5('Name the stages of this line as JSON lines.' || chr(10) || chr(10) || body) AS prompt_md5, n || 'stage_' || (row_number() OVER (ORDER BY first) - 1) AS line_key, CAST(n AS INTEGER) AS line_length, tag FROM l""",
    "lines_by_stage": "SELECT CAST(n AS INTEGER) AS line_length, count(*) AS n FROM (SELECT count(*) AS n FROM part GROUP BY p_partkey // 3) GROUP BY 1",
    "pretty_json": """SELECT r_regionkey, '{' || chr(10) || '  "r_regionkey" : ' || r_regionkey || ',' || chr(10) || '  "r_name" : "' || r_name || '"' || chr(10) || '}' AS json FROM region""",
}
