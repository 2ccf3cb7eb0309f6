"""Scalar text functions as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every Unicode space character and the separators that count as white space, as a regex class body.
SPACES = r"\t-\r\x1c-\x20\x85\xa0  -     　"
#: The same for RE2, as DuckDB reads it.
SPACES_RE2 = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same characters, one by one.
SPACE_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at both ends."""
    return F.btrim(_c(c), F.lit(SPACE_CHARS))


def collapse_spaces(c: Column | str) -> Column:
    """Words joined by single spaces."""
    return F.btrim(F.regexp_replace(_spaced(c), " {2,}", " "))


def _spaced(c: Column | str) -> Column:
    """Every white space character as a space: a table, which is faster than a pattern."""
    return F.translate(_c(c), SPACE_CHARS, " " * len(SPACE_CHARS))


def normalize_newlines(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), r"\r\n?", "\n")


def normalize_paragraphs(c: Column | str, keep: int = 1) -> Column:
    """No blanks at line ends, at most ``keep`` blank lines in a row, none at either end."""
    s = F.regexp_replace(_c(c), r"[ \t]+(?=\n|\z)", "")
    s = F.regexp_replace(s, r"\n{" + str(keep + 2) + r",}", "\n" * (keep + 1))
    return F.regexp_replace(s, r"^\n+|\n+\z", "")


def unwrap(c: Column | str, gap: int = 4) -> Column:
    """Lines of a paragraph joined by spaces; paragraphs separated by ``gap`` line breaks."""
    blank = F.regexp_replace(_c(c), r"(?dm)^[ \t]+$", "")
    blocks = F.transform(F.split(blank, r"\n{2,}"), collapse_spaces)
    return F.array_join(F.filter(blocks, lambda b: b != ""), "\n" * gap)


def clean_text(c: Column | str) -> Column:
    """Line breaks and tabs unified, paragraphs unwrapped, ends stripped; null is empty."""
    return unwrap(F.replace(normalize_newlines(F.coalesce(_c(c), F.lit(""))), F.lit("\t"), F.lit(" ")))


def word_count(c: Column | str) -> Column:
    """Words between white space; 0 for null and blank."""
    return F.size(F.filter(F.split(_spaced(F.coalesce(_c(c), F.lit(""))), " "), lambda w: w != "")).cast("long")


def is_valid(text: Column | str, title: Column | str, min_chars: int = 100, min_words: int = 20) -> Column:
    """Long enough in characters and words, and with a title."""
    t = strip(F.coalesce(_c(text), F.lit("")))
    return (F.length(t) >= min_chars) & (word_count(t) >= min_words) & (strip(F.coalesce(_c(title), F.lit(""))) != "")


def shingles(c: Column | str, n: int) -> Column:
    """The distinct word n-grams of a text: ASCII letters and digits, lower case; fewer than n words: the words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(_c(c), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))

    def grams(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
        return F.array_distinct(F.when(F.size(w) < n, w).otherwise(each))

    # a lambda's argument is evaluated once; a captured expression would be once for every n-gram
    return F.element_at(F.transform(F.array(words), grams), 1)


def normalize_answer(c: Column | str) -> Column:
    """Lower case without ASCII punctuation, spaces collapsed; null is empty."""
    return collapse_spaces(F.translate(F.lower(F.coalesce(_c(c), F.lit(""))), PUNCTUATION, ""))


def answers_match(given: Column | str, prediction: Column | str) -> Column:
    """One normalised answer contains the other, and neither is empty."""
    g, p = normalize_answer(given), normalize_answer(prediction)
    return (g != "") & (p != "") & (p.contains(g) | g.contains(p))


def host(url: Column | str) -> Column:
    """The authority of a URL, with user and port."""
    return F.regexp_extract(F.coalesce(_c(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def lede(text: Column | str, size: int, mark: str = "") -> Column:
    """The first paragraph, cut at ``size`` characters; ``mark`` follows a cut one."""
    first = F.regexp_extract(_c(text), r"(?s)^(.*?)(?:\n\n|\z)", 1)
    return F.when(F.length(first) > size, F.concat(F.substring(first, 1, size), F.lit(mark))).otherwise(first)


def build_text(mode: str, title: Column | str, text: Column | str, date: Column | str | None = None) -> Column:
    """Input of an encoder: text_only, title_lede, doc_prefix or title_and_text; empty for an empty text."""
    t, x = F.coalesce(_c(title), F.lit("")), F.coalesce(_c(text), F.lit(""))
    d = F.coalesce(_c(date), F.lit("")) if date is not None else F.lit("")
    first = lede(x, 500)
    if mode == "text_only":
        out = x
    elif mode == "title_lede":
        out = F.when(t != "", F.concat(t, F.lit("\n"), first)).otherwise(first)
    elif mode == "doc_prefix":
        out = F.concat(F.lit("title: "), t, F.lit(" | text: "), first)
    else:
        head = F.concat(t, F.when(d != "", F.concat(F.lit(" ("), d, F.lit(")"))).otherwise(""))
        out = F.when(head != "", F.concat(head, F.lit("\n"), x)).otherwise(x)
    return F.when(x == "", "").otherwise(out)


def truncate_words(text: Column | str, most: int) -> Column:
    """At most ``most`` words, white space between them kept; 0 or less: all."""
    if most <= 0:
        return _c(text)
    return F.regexp_extract(_c(text), rf"^[{SPACES}]*(?:[^{SPACES}]+[{SPACES}]*){{0,{most}}}", 0)


def fill(template: str, **values: Column | str) -> Column:
    """A template's {names} replaced one after the other by columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(_c(value).cast("string"), F.lit("")))
    return out
