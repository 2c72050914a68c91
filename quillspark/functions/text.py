"""Text functions: Column in, Column out.

They stay expressions of the JVM but for three steps that Spark has no function for, which are pandas UDFs:
compatibility decomposition, HTML entities and title case. Character classes are written so that white space and
letters mean what Unicode says; Java's own \\s and \\w know ASCII only.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, as text processing with Unicode understands it.
WS = r"\t-\r\x1c-\x1f \x85\xa0  -     　"
EDGE = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
# Signs of the manuscripts that comparisons ignore; letters and their replacements.
SIGNS = "†‡¶⁕*✝"
COMPARED = {"æ": "ae", "ø": "oe", "å": "aa", "ÿ": "y", "ö": "o"}
IN_AUTHOR_SLUGS = {
    "æ": "ae", "ø": "o", "å": "aa", "ä": "ae", "ö": "oe", "ü": "ue", "ÿ": "y", "é": "e", "è": "e", "ê": "e", "á": "a", "à": "a", "â": "a",
    "í": "i", "ì": "i", "î": "i", "ó": "o", "ò": "o", "ô": "o", "ú": "u", "ù": "u", "û": "u", "ñ": "n", "ç": "c", "ß": "ss",
}
DANISH = ("dansk", "gammeldansk", "ældre-nydansk", "yngre-nydansk")
SLUG_LENGTH = 80


def by_series(f: Callable, kind: str) -> Callable[[Column | str], Column]:
    """A pandas UDF of a function of one value, made when it is used, so that importing needs no session. Nulls stay nulls."""

    def call(c: Column | str) -> Column:
        def run(s: pd.Series) -> pd.Series:
            return s.map(f, na_action="ignore")

        return F.pandas_udf(run, kind)(c)

    return call


def _without_marks(t: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))


#: Compatibility decomposition without its combining marks; HTML entities as characters; upper case after anything that is no letter.
without_marks = by_series(_without_marks, "string")
unescape = by_series(html.unescape, "string")
title_case = by_series(str.title, "string")


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"[{WS}]+", " "))


def strip(c: Column, what: str = f"[{WS}]") -> Column:
    return F.regexp_replace(c, f"^(?:{what})+|(?:{what})+$", "")


def _replace_all(c: Column, pairs: dict[str, str]) -> Column:
    one = {k: v for k, v in pairs.items() if len(v) == 1}
    out = F.translate(c, "".join(one), "".join(one.values())) if one else c
    for k, v in pairs.items():
        if len(v) != 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return out


def normalise(c: Column) -> Column:
    """The form in which lines and titles are compared; '' for null. Inner punctuation stays."""
    bare = F.translate(F.translate(F.coalesce(c, F.lit("")), SIGNS, ""), "ſ", "s")
    return F.regexp_replace(collapse(_replace_all(F.lower(bare), COMPARED)), EDGE, "")


def _slug(c: Column, others: str, between: str = "-") -> Column:
    dashed = F.regexp_replace(F.regexp_replace(c, others, between), "-+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def hymn_slug(c: Column) -> Column:
    """ASCII slug; letters without an ASCII base, as æ and ø, go."""
    spaced = F.regexp_replace(strip(F.lower(without_marks(F.coalesce(c, F.lit(""))))), f"[{WS}]+", "-")
    return F.substring(_slug(spaced, "[^a-z0-9\\-_]+", ""), 1, SLUG_LENGTH)


def word_slug(c: Column, length: int = SLUG_LENGTH) -> Column:
    """As hymn_slug, but every letter of Unicode stays."""
    spaced = F.regexp_replace(F.lower(without_marks(F.coalesce(c, F.lit("")))), f"[{WS}]+", "-")
    return F.substring(_slug(spaced, r"[^\p{L}\p{N}_\-]+", ""), 1, length)


def title_slug(c: Column, length: int = SLUG_LENGTH) -> Column:
    """Slug of a title: æ as ae, every other run as one dash."""
    bare = F.replace(F.lower(without_marks(F.coalesce(c, F.lit("")))), F.lit("æ"), F.lit("ae"))
    return F.regexp_replace(F.substring(_slug(bare, "[^a-z0-9]+"), 1, length), "-+$", "")


def author_slug(name: Column, drop_honorific: bool = True) -> Column:
    """Slug of a person's name; null for null and ''."""
    bare = F.regexp_replace(name, rf"(?iu)^(?:Hr\.|Dr\.|Fr\.|Prof\.|H\.)[{WS}]+", "") if drop_honorific else name
    spelled = _replace_all(F.lower(bare), IN_AUTHOR_SLUGS)
    dashed = F.regexp_replace(F.regexp_replace(strip(spelled), f"[{WS}]+", "-"), "[^a-z0-9\\-]", "")
    return F.when(name != "", F.regexp_replace(dashed, "-+", "-"))


def book_slug(title: Column, year: Column) -> Column:
    """From the title, else the year, else 'unknown'. A title's slug is never longer than a slug may be, so it needs no hash."""
    by_title = F.when(F.coalesce(title, F.lit("")) != "", title_slug(title))
    return F.coalesce(by_title, F.when(year != 0, year.cast("string")), F.lit("unknown"))


def file_name(source: Column, author: Column, title: Column, book: Column) -> Column:
    return F.concat(source, F.lit("--"), F.when(F.coalesce(author, F.lit("")) == "", "anonymous").otherwise(author), F.lit("--"), title, F.lit("--"), book, F.lit(".json"))


def url_slug(url: Column) -> Column:
    """Cache key of an address; capitals count as separators."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "^https?://", ""), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def url_path(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def reread(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, read again; a value that can't be is unchanged."""
    raw = F.encode(c, "ISO-8859-1")
    latin = c.rlike(r"^[\x00-\xFF]*$")
    return F.when(latin, F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(c)).otherwise(c)


def parse_year(c: Column) -> Column:
    """struct(kind, first, last, text): kind is empty, int, list or malformed. first = last for one year."""
    t = strip(c)
    g = lambda p, k: F.regexp_extract(t, p, k).cast("int")
    one, circa, span, decade = r"^(\d{3,4})$", rf"^(?:Før|Efter)[{WS}]+(\d{{3,4}})$", rf"^(\d{{3,4}})[{WS}]*-[{WS}]*(\d{{3,4}})$", r"(?iu)^(\d{3,4})'?erne$"
    make = lambda kind, a, b, text=None: F.struct(F.lit(kind).alias("kind"), a.alias("first"), b.alias("last"), (F.lit(None).cast("string") if text is None else text).alias("text"))
    none = F.lit(None).cast("int")
    return (
        F.when(F.coalesce(t, F.lit("")) == "", make("empty", none, none))
        .when(t.rlike(one), make("int", g(one, 1), g(one, 1)))
        .when(t.rlike(circa), make("int", g(circa, 1), g(circa, 1)))
        .when(t.rlike(span), make("list", F.least(g(span, 1), g(span, 2)), F.greatest(g(span, 1), g(span, 2))))
        .when(t.rlike(decade), make("list", g(decade, 1), g(decade, 1) + 9))
        .otherwise(make("malformed", none, none, t))
    )


def years_of(parsed: Column) -> Column:
    """struct(created_first, created_last, is_span, published) of a parsed year."""
    return F.struct(parsed["first"].alias("created_first"), parsed["last"].alias("created_last"), (parsed["kind"] == "list").alias("is_span"), parsed["last"].alias("published"))


def base_work(slug: Column) -> Column:
    """A work's slug without the suffix of its edition."""
    return F.regexp_replace(slug, r"(_dipl|\.da)$", "")


def source_title(slug: Column) -> Column:
    """A book's title from its slug, without the author in front."""
    rest = F.regexp_replace(slug, "^[^_]*_", "")
    return F.trim(F.translate(rest, "-_", "  "))


def title_from_slug(slug: Column) -> Column:
    return F.trim(F.translate(F.regexp_replace(slug, "^anon_", ""), "-", " "))


def split_crumb(c: Column) -> Column:
    """struct(author, title) of 'Author: Title', or the title alone."""
    t = strip(c)
    cut = F.when(c.contains("\n"), F.instr(c, "\n")).otherwise(F.instr(c, ":"))
    empty = lambda x: F.nullif(strip(x), F.lit(""))
    author = F.when(cut > 0, empty(F.substring(c, F.lit(1), cut - 1)))
    rest = F.when(cut > 0, empty(F.substring(c, cut + 1, F.length(c)))).otherwise(t)
    blank = F.coalesce(t, F.lit("")) == ""
    return F.struct(F.when(~blank, author).alias("author"), F.when(~blank, rest).alias("title"))


def clean(c: Column) -> Column:
    """Entities as characters, white space collapsed; tags stay."""
    return collapse(unescape(c))


def heading(c: Column) -> Column:
    """A heading without the number of its page."""
    return strip(F.regexp_replace(c, rf"^\[?\d+\]?[{WS}]*\|?[{WS}]*", ""))


def unnumbered(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"^Nr\.[{WS}]*\d+\.?[{WS}]*", ""))


def whole_number(c: Column) -> Column:
    return F.when(strip(c).rlike(r"^[+-]?\d{1,9}$"), strip(c)).cast("int")


def author_or_anonymous(c: Column) -> Column:
    bare = F.coalesce(strip(c), F.lit(""))
    return F.when((bare == "") | F.lower(bare).isin("anonym", "anonymous"), "anonymous").otherwise(c)


def speaker(c: Column) -> Column:
    """A speaker's name without tags and the number of a page."""
    bare = collapse(F.regexp_replace(c, "<[^>]+>", ""))
    return F.regexp_replace(F.regexp_replace(bare, rf"^\[\d+\][{WS}]*\|?[{WS}]*", ""), rf"^\d+[{WS}]*\|[{WS}]*", "")


def speaker_note(c: Column) -> Column:
    return F.concat(F.lit("Speaker: "), c)


def without_page_sigil(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, rf"[{WS}]*\|[{WS}]*\d+[rv][{WS}]*$", ""), rf"^[{WS}]*\d+[rv][{WS}]*\|[{WS}]*", ""))


def percent(c: Column, decimals: int = 0) -> Column:
    return F.format_string(f"%.{decimals}f%%", c * 100)


def name_parts(file: Column) -> Column:
    """struct(source, author, title, book, copy) of a file name; the fifth part is the number of a collision. Null with fewer than four parts."""
    parts = F.split(F.regexp_replace(file, r"\.json$", ""), "--")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    return F.when(F.size(parts) >= 4, F.struct(at(1).alias("source"), at(2).alias("author"), at(3).alias("title"), at(4).alias("book"), at(5).cast("int").alias("copy")))


def is_danish(language: Column) -> Column:
    """Whether a language's slug, percent-encoded or not, is one of the Danish ones; a plus sign stays one."""
    return F.coalesce(F.lower(F.try_url_decode(F.replace(language, F.lit("+"), F.lit("%2B")))).isin(*DANISH), F.lit(False))
