"""Personal data: patterns propose, checksums confirm, context words adjust the score."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.names import fresh, quoted
from millrace.sources import table

#: Characters that mark the ends of a match; noncharacters, so texts have no use for them. One that
#: a text holds all the same is read as another noncharacter of the same length.
OPEN, CLOSE, OTHER = "\ufdd0", "\ufdd1", "\ufdd2"
#: Characters before and after a span in which context words count, what they add to a kind's score,
#: and the score from which a span of an added kind counts.
NEAR, CONTEXT, LEAST = 40, 0.2, 0.5


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """16 to 19 digits whose Luhn sum is a multiple of ten."""
    d = F.reverse(_digits(m))

    def add(total: Column, i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, x).otherwise(x * 2 - F.when(x > 4, F.lit(9)).otherwise(F.lit(0)))

    n = F.length(d)
    return F.when(n.between(16, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(False)


def octets(m: Column) -> Column:
    """Dotted numbers of at most 255, with any number of leading zeros."""

    def small(x: Column) -> Column:
        bare = F.regexp_replace(x, "^0+", "")
        return F.when(F.length(bare) > 3, False).otherwise(F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(m, r"\."), small)


def mod_97(m: Column) -> Column:
    """15 to 34 letters and digits whose check number is right: the first four go last, A is 10."""
    s = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    n = F.length(s)
    return F.when(n.between(15, 34), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) == 1).otherwise(False)


def mixed(m: Column) -> Column:
    """At least four letters and four digits, of ten different characters or more: no word, no number."""
    letters, digits = F.regexp_replace(m, "[^A-Za-z]", ""), _digits(m)
    return (F.length(letters) >= 4) & (F.length(digits) >= 4) & (F.size(F.array_distinct(F.split(m, ""))) >= 10)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``guard``: a cheap test without which a text has no match; ``score``:
    of a valid match by itself; ``context``: words that raise it when they are near."""

    name: str
    pattern: str
    guard: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    context: str


# A run of characters that a match may begin with is entered at its first character or where the
# last match ended, so that long runs without a match take linear time; repeats are possessive
# where nothing that follows could need a step back. Both match what the plain patterns match.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: t.contains("@"), lambda m: F.lit(True), 0.9, "e-?mail|contact|write to|courriel|correo|schreiben"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.rlike(r"[0-9]\.[0-9]"), octets, 0.6, r"\bip\b|address|server|host|login|adresse|direcci"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), luhn, 0.8, "card|visa|credit|payment|carte|karte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.contains("+"), lambda m: F.length(_digits(m)).between(8, 15), 0.6, r"phone|call|tel\b|mobile|fax|t.l.phone|telefon|m.vil"),
)
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), mod_97, 0.5, "iban|account|bank|transfer|konto|compte|cuenta"),
    # a long run of mixed letters and digits is a secret only where a word near it says so
    Kind("secret", r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,200}+(?![A-Za-z0-9_/+=-])", lambda t: t.rlike("[A-Za-z0-9_/+-]{20}"), mixed, 0.4, r"token|secret|passw|passwd|api.?key|access.?key|private.?key|auth|bearer|credential"),
)


def spans_of(text: Column, kind: Kind) -> Column:
    """Valid leftmost non-overlapping matches as array<struct<start, end>> in code points, end exclusive."""
    marked = F.regexp_replace(F.translate(text, OPEN + CLOSE, OTHER + OTHER), kind.pattern, f"{OPEN}$0{CLOSE}")
    # every part but the first is a match, a mark and what follows; lengths give the places
    parts = F.split(marked, OPEN, -1)
    size = F.transform(parts, lambda p, i: (F.length(p) - F.when(i > 0, 1).otherwise(0)).cast("long"))
    # starts: the running sum of lengths
    starts = F.aggregate(size, F.array(F.lit(0).cast("long")), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    found = F.zip_with(F.slice(parts, 2, 2147483646), F.slice(starts, 2, 2147483646), lambda p, s: F.when(p.isNotNull(), F.struct(s.alias("start"), F.substring_index(p, CLOSE, 1).alias("m"))))
    good = F.filter(found, lambda h: h.isNotNull() & kind.valid(h["m"]))
    spans = F.transform(good, lambda h: F.struct(h["start"].alias("start"), (h["start"] + F.length(h["m"])).cast("long").alias("end")))
    return F.when(kind.guard(text), spans).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


SPAN = "array<struct<start:bigint,end:bigint,score:double>>"


def scored(text: Column, kind: Kind) -> Column:
    """Spans with a score: the kind's own, and CONTEXT more when one of its context words is within
    NEAR characters of the span."""

    def one(s: Column) -> Column:
        from_ = F.greatest(s["start"] - NEAR, F.lit(0))
        before = F.substring(text, (from_ + 1).cast("int"), (s["start"] - from_).cast("int"))
        near = F.lower(F.concat_ws("\n", before, F.substring(text, (s["end"] + 1).cast("int"), F.lit(NEAR))))
        score = F.lit(kind.score) + F.when(near.rlike(kind.context), CONTEXT).otherwise(0.0)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), score.alias("score"))

    return F.transform(spans_of(text, kind), one).cast(SPAN)


def findings(docs: DataFrame, least: float = LEAST, added: tuple[Kind, ...] = ADDED) -> tuple[DataFrame, str]:
    """``docs(text, ..)`` with one more column, and its name: a struct of a span array for each kind.

    Patterns propose spans, validators confirm them, and context words near a span raise its score.
    Spans of the base kinds (email, ip, card, phone) are kept whatever their score; spans of the
    added kinds from ``least`` on. Built of SQL functions alone; a row is handled by itself, without
    a shuffle.

    Null and empty texts have no spans. Repeated rows and null ids are rows like others; the
    caller's columns are all kept, as the new one's name is none of theirs. Texts may be of any
    length: time is linear in the text, and in the square of the number of matches in one text at
    worst.
    """
    (name,) = fresh(docs, "pii")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = [scored(text, k).alias(k.name) for k in BASE]
    more = [F.filter(scored(text, k), lambda s: s["score"] >= least - 1e-9).alias(k.name) for k in added]
    return docs.withColumn(name, F.struct(*base, *more)), name


def _listed(name: str, kinds: tuple[Kind, ...]) -> Column:
    def text(k: Kind) -> Column:
        return F.transform(F.col(name)[k.name], lambda s: F.concat_ws(":", F.lit(k.name), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*map(text, kinds)), ",")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of every kind, the hash of base spans, all spans as text, and their scores in the same order."""
    found, name = findings(docs)
    kinds = (*BASE, *ADDED)
    count = lambda k: F.size(F.col(name)[k.name]).cast("long").alias(f"n_{k.name}")
    scores = F.array_join(F.concat(*[F.transform(F.col(name)[k.name], lambda s: F.format_number(s["score"], 2)) for k in kinds]), ",")
    return found.select("doc_id", *map(count, BASE), F.sha2(_listed(name, BASE).cast("binary"), 256).alias("base_sha256"), _listed(name, kinds).alias("spans"), *map(count, ADDED), scores.alias("scores"))


def masked(docs: DataFrame) -> DataFrame:
    """The same rows and columns; every span in ``text`` is replaced by its kind in angle brackets.

    Spans are those of ``findings``, so context words decide about the added kinds. Spans of several
    kinds that overlap are replaced once, by the kind that begins first. A null text stays null;
    repeated rows and null ids are rows like others; an empty table gives no rows.
    """
    found, name = findings(docs)
    (marks_name,) = fresh(found, "marks")

    def marks(k: Kind) -> Column:
        return F.transform(F.col(name)[k.name], lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), F.lit(f"<{k.name.upper()}>").alias("as")))

    found = found.withColumn(marks_name, F.array_sort(F.concat(*map(marks, (*BASE, *ADDED)))))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        new = F.concat(acc["out"], F.array(gap, s["as"]))
        return F.struct(F.greatest(acc["at"], -s["end"]).alias("at"), F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    end = F.aggregate(marks_name, none, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.length("text"))))
    out = found.withColumn("text", F.when(F.size(marks_name) > 0, end).otherwise(F.col("text")))
    return out.select(*quoted(*docs.columns))


def op5_pii(spark, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents").select("doc_id", "text"))
