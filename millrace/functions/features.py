"""Feature names of entities: canonical names, variants, and what a question asks for."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import strip

# The canonical feature names.
CANONICAL = ("name", "classification", "type1", "type2", "ability", "hp", "attack", "defense", "special attack", "special defense", "speed", "base_stat_total", "weight", "height", "idx", "evolution_line", "move.name", "move.short_description")

# Variant spellings and the names they stand for.
VARIANTS = (
    ("special_attack", "special attack"),
    ("special-attack", "special attack"),
    ("special.attack", "special attack"),
    ("specialattack", "special attack"),
    ("special aack", "special attack"),
    ("special aattack", "special attack"),
    ("special a-ttack", "special attack"),
    ("special a_ttack", "special attack"),
    ("special a ttack", "special attack"),
    ("special anttack", "special attack"),
    ("special attacker", "special attack"),
    ("special apecial attack", "special attack"),
    ("special aatack", "special attack"),
    ("special_defense", "special defense"),
    ("special-defense", "special defense"),
    ("special.defense", "special defense"),
    ("specialdefense", "special defense"),
    ("special aefense", "special defense"),
    ("special apecial_defense", "special defense"),
    ("special an defense", "special defense"),
    ("special dense", "special defense"),
    ("special special defense", "special defense"),
    ("special a_defense", "special defense"),
    ("de fense", "defense"),
    ("speeed", "speed"),
    ("tyep2", "type2"),
    ("type_2", "type2"),
    ("classiﬁcation", "classification"),
    ("_classification_", "classification"),
    ("abilities", "ability"),
    ("ability,", "ability"),
    ("height,", "height"),
    ("evolution_line,", "evolution_line"),
    ("evolution_line_full", "evolution_line"),
    ("movie.name", "move.name"),
    ("move_name", "move.name"),
    ("move/name", "move.name"),
    ("move-name", "move.name"),
    ("move - name", "move.name"),
    ("move_info.name", "move.name"),
    ("move[name]", "move.name"),
    ("move 'name'", "move.name"),
    ("_move", "move.name"),
    ("short_description", "move.short_description"),
    ("move_short_description", "move.short_description"),
    ("move.description", "move.short_description"),
    ("move_description", "move.short_description"),
    ("move/short_description", "move.short_description"),
    ("move-short_description", "move.short_description"),
    ("move - short_description", "move.short_description"),
    ("move_info.short_description", "move.short_description"),
    ("move[short_description]", "move.short_description"),
    ("move 'short_description'", "move.short_description"),
)

# The first phrase that a question holds decides its feature.
CASCADE = (
    ("classification of", "classification"),
    ("types of", "types"),
    ("ability of", "ability"),
    ("HP stat of", "hp"),
    ("special attack stat of", "special attack"),
    ("special defense stat of", "special defense"),
    ("attack stat of", "attack"),
    ("defense stat of", "defense"),
    ("speed stat of", "speed"),
    ("base stat total stat of", "base_stat_total"),
    ("move of", "move"),
    ("weight", "weight"),
    ("height", "height"),
)

#: Features whose documents support a question's label, where they are not the label itself.
QUESTION_FEATURES = {label: {"types": ("type1", "type2"), "move": ("move.name",)}.get(label, (label,)) for _, label in CASCADE}


def question_to_feature(question: Column | str) -> Column:
    """What a question asks for; ``unknown`` if nothing fits."""
    q = F.col(question) if isinstance(question, str) else question
    return F.coalesce(*[F.when(q.contains(phrase), F.lit(label)) for phrase, label in CASCADE], F.lit("unknown"))


def normalize_feature(raw: Column | str) -> Column:
    """The canonical name of a raw feature; null if there is none."""
    c = F.lower(strip(F.col(raw) if isinstance(raw, str) else raw))
    known = F.create_map(*[F.lit(x) for pair in VARIANTS for x in pair])
    names = F.array(*map(F.lit, CANONICAL))
    s = F.regexp_replace(F.regexp_replace(c, r"^g[0-9]+[._\-\s]", ""), r"^stats[._]", "")
    t = F.regexp_replace(s, r"^move_info[._]", "")
    spaced = F.replace(t, F.lit("_"), F.lit(" "))
    found = F.coalesce(F.try_element_at(known, s), F.try_element_at(known, t), F.when(F.array_contains(names, t), t), F.when(F.array_contains(names, spaced), spaced))
    return F.when(c != "", found)


def normalize_info(features: Column | str) -> Column:
    """A list of raw features as distinct canonical names, order kept."""
    c = F.col(features) if isinstance(features, str) else features
    return F.array_distinct(F.array_compact(F.transform(c, normalize_feature)))


def parse_info(text: Column | str) -> Column:
    """The same from a JSON list in a string; anything else is an empty list."""
    c = F.col(text) if isinstance(text, str) else text
    items = F.try_variant_get(F.try_parse_json(c), "$", "array<variant>")
    plain = F.transform(items, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    return F.coalesce(normalize_info(plain), F.array().cast("array<string>"))


def applicable(type2: Column, evolution_line: Column) -> Column:
    """Features that an entity has: all but idx, type2 where there is one, the line above one member."""
    always = [f for f in CANONICAL if f not in ("idx", "type2", "evolution_line")]
    return F.array_compact(F.array(*map(F.lit, always), F.when(type2.isNotNull(), F.lit("type2")), F.when(F.coalesce(F.size(evolution_line), F.lit(0)) > 1, F.lit("evolution_line"))))
