"""Web pages: declared language, host, main text, length and language filters."""

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import host, strip
from millrace.plans.ship import ship
from millrace.sources import table

#: Frequent short words by language, for a guess without a model.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "with", "was"),
    "fr": ("le", "la", "les", "de", "des", "et", "un", "une", "que", "pour"),
    "de": ("der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "nicht"),
    "es": ("el", "los", "las", "de", "que", "y", "en", "un", "por", "para"),
}


# Fixed value: the pattern of the declared language.
LANG = r"""(?i)<html[^>]*\slang=["']([a-zA-Z]{2})"""


def declared_language(html: Column | str) -> Column:
    """Two letters of the lang attribute of <html> in the first 2000 characters, in lower case; '' if none."""
    c = F.col(html) if isinstance(html, str) else html
    return F.lower(F.regexp_extract(F.substring(c, 1, 2000), LANG, 1))


def passes(language: Column, mode: str) -> Column:
    """Pages without a declared language pass either way; english keeps en, nonenglish drops it."""
    return F.lit(True) if mode == "all" else (language == "") | ((language == "en") if mode == "english" else (language != "en"))


def guess_language(text: Column | str, chars: int = 1000) -> Column:
    """The language whose stop words are most among the words of the first characters; '' if none occurs."""
    c = F.col(text) if isinstance(text, str) else text
    words = F.split(F.lower(F.substring(F.coalesce(c, F.lit("")), 1, chars)), r"[^\p{L}]+")

    def score(w: Column) -> Column:
        rows = F.array(*[F.struct((-F.size(F.filter(w, _among(l)))).alias("n"), F.lit(l).alias("lang")) for l in STOP_WORDS])
        best = F.array_min(rows)
        return F.when(best["n"] < 0, best["lang"]).otherwise("")

    return F.element_at(F.transform(F.array(words), score), 1)


def _among(language: str):
    return lambda x: x.isin(*STOP_WORDS[language])


class _Reader(HTMLParser):
    """Text of headings and paragraphs outside of navigation, scripts, tables and the like."""

    SKIP = {"script", "style", "nav", "header", "footer", "aside", "form", "table", "noscript", "template"}
    BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "br", "div", "article", "section", "main"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.out, self.skip, self.in_title = [], [[]], [], False

    def handle_starttag(self, tag, attrs):
        if self.skip:
            self.skip += [tag] if tag == self.skip[0] else []
        elif tag in self.SKIP or (tag == "div" and dict(attrs).get("class") in ("ad", "ads", "comments", "cookie")):
            self.skip = [tag]
        elif tag == "title":
            self.in_title = True
        elif tag in self.BLOCK:
            self.out.append([])

    def handle_endtag(self, tag):
        if self.skip:
            if tag == self.skip[-1]:
                self.skip.pop()
        elif tag == "title":
            self.in_title = False
        elif tag in self.BLOCK:
            self.out.append([])

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.skip:
            self.out[-1].append(data)


def read_page(html: str | None) -> tuple[str, str]:
    """Title and main text: blocks on lines, spaces collapsed."""
    r = _Reader()
    r.feed(html or "")
    r.close()
    blocks = (" ".join("".join(b).split()) for b in r.out)
    return " ".join("".join(r.title).split()), "\n".join(b for b in blocks if b)


def extract(pages: DataFrame) -> DataFrame:
    """Adds ``title`` and ``text`` to pages, by a parser of the standard library on Arrow batches."""
    ship(pages.sparkSession)
    rest = [c for c in pages.columns if c not in ("title", "text", "html")]

    def run(batches):
        for b in batches:
            got = [read_page(x) for x in b.column(b.schema.get_field_index("html")).to_pylist()]
            cols = [b.column(b.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], [*rest, "title", "text"])

    return pages.select(*rest, "html").mapInArrow(run, pages.select(*rest).schema.add("title", "string").add("text", "string"))


def kept_language(language: Column, mode: str) -> Column:
    """english keeps en; nonenglish drops it; a text of no known language is not English."""
    return {"english": language == "en", "nonenglish": language != "en"}.get(mode, F.lit(True))


def articles(pages: DataFrame, mode: str = "english", least: int = 50) -> DataFrame:
    """Pages to articles: the cheap filter on declared language first, then extraction, length, language.

    A null page has no text and gives no article. Repeated pages give repeated articles; columns
    called title, text, language or hostname are replaced, all others but html are kept.
    """
    some = pages.where(passes(declared_language(F.coalesce("html", F.lit(""))), mode))
    got = extract(some).where(F.length(strip("text")) >= least)
    got = got.withColumn("language", guess_language("text")).withColumn("hostname", host("url"))
    return got.where(kept_language(F.col("language"), mode))


def extraction_counts(pages: DataFrame, mode: str = "english", least: int = 50) -> DataFrame:
    """``total, lang_skipped, extracted, kept``: pages, those whose declared language stops them, texts long enough, articles."""
    ok = passes(declared_language(F.coalesce("html", F.lit(""))), mode)
    n = pages.agg(F.count("*").alias("total"), F.count_if(~ok).alias("lang_skipped"))
    got = extract(pages.where(ok)).where(F.length(strip("text")) >= least)
    m = got.agg(F.count("*").alias("extracted"), F.count_if(kept_language(guess_language("text"), mode)).alias("kept"))
    return n.crossJoin(m)  # one row each


def q_html_lang(s, d):
    p = table(s, d, "pages")
    return p.select("page_id", declared_language("html").alias("lang"), passes(declared_language("html"), "english").alias("english"), passes(declared_language("html"), "nonenglish").alias("nonenglish"))


QUERIES = {
    "html_lang_filter": q_html_lang,
    "url_authority": lambda s, d: table(s, d, "pages").select("page_id", host("url").alias("hostname")),
    "articles": lambda s, d: articles(table(s, d, "pages")).select("page_id", "hostname", "language", "title", F.length("text").alias("n")),
    "extraction_counters": lambda s, d: extraction_counts(table(s, d, "pages")),
    "language_guess": lambda s, d: table(s, d, "documents").select(F.col("lang"), guess_language("text").alias("guess")).groupBy("lang", "guess").agg(F.count("*").alias("n")),
}


def _list(language: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in STOP_WORDS[language]) + "]"


_SCORES = ", ".join(f"{{'n': -len(list_filter(w, lambda x: list_contains({_list(l)}, x))), 'lang': '{l}'}}" for l in STOP_WORDS)
SQL = {
    "html_lang_filter": r"""SELECT page_id, lang, lang = '' OR lang = 'en' AS english, lang = '' OR lang <> 'en' AS nonenglish FROM (SELECT page_id, lower(regexp_extract(substr(html, 1, 2000), '(?i)<html[^>]*\slang=["'']([a-zA-Z]{2})', 1)) AS lang FROM pages)""",
    "url_authority": "SELECT page_id, regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS hostname FROM pages",
    "language_guess": f"""SELECT lang, CASE WHEN best.n < 0 THEN best.lang ELSE '' END AS guess, count(*) AS n FROM (
SELECT lang, list_sort([{_SCORES}])[1] AS best FROM (SELECT lang, string_split_regex(lower(substr(coalesce(text, ''), 1, 1000)), '[^\\p{{L}}]+') AS w FROM documents)) GROUP BY 1, 2""",
}
