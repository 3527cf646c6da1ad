"""Text columns: accent folding, matching text, titles, HTML to text."""

from __future__ import annotations

import html
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.functions.keywords import EVENT_OPENERS, Keywords, Term, window_pattern

SUMMARY_LIMIT = 1500
TITLE_LIMIT = 400
# white space that the folding of letters leaves as it is
BLANKS = "\t\n\x0b\f\r\x85\u1680\u2028\u2029"
# stands before each window; neither a word character nor white space
MARK = "\x01"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once per row however often the body uses it."""
    return F.transform(F.array(value), body)[0]


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """(characters with one base character, their bases, characters with several) after NFKD without marks.

    Hangul syllables stay composed: their parts are letters, not marks.
    """
    single_from, single_to, dropped, several = [], [], [], {}
    for code in range(0x80, min(sys.maxunicode, 0xFFFF) + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if base == ch:
            continue
        if base == "":
            dropped.append(ch)
        elif len(base) == 1:
            single_from.append(ch)
            single_to.append(base)
        else:
            several[ch] = base
    return "".join(single_from + dropped), "".join(single_to), several


def _spelled(folded: Column) -> Column:
    """``folded`` with ligatures and fractions spelled out. Most text is ASCII by now, so the cheap tests come first."""
    several = _folding()[2]
    # a foldable expression from two literals, evaluated once
    table = F.map_from_arrays(F.split(F.lit("\x01".join(several)), "\x01"),
                              F.split(F.lit("\x01".join(several.values())), "\x01"))
    spelled = F.array_join(F.transform(F.regexp_extract_all(folded, F.lit("(?s)."), F.lit(0)),
                                       lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return (F.when(F.octet_length(folded) == F.length(folded), folded)
            .when(F.length(F.translate(folded, "".join(several), "")) < F.length(folded), spelled)
            .otherwise(folded))


def strip_accents(text: Column) -> Column:
    """Unicode compatibility folding without combining marks, inside the JVM."""
    source, target, _ = _folding()
    return bind(text, lambda value: F.when(F.octet_length(value) == F.length(value), value)
                .otherwise(bind(F.translate(value, source, target), _spelled)))


def match_text(text: Column) -> Column:
    """The form keyword patterns are applied to: no accents, lower case, runs of white space as one blank.

    One pass folds letters and white space; runs of blanks are rare enough to be tested for first.
    """
    source, target, _ = _folding()
    folded = F.translate(F.coalesce(text, F.lit("")), BLANKS + source, " " * len(BLANKS) + target)
    return bind(bind(folded, lambda value: F.lower(_spelled(value))),
                lambda value: F.when(F.contains(value, F.lit("  ")), F.regexp_replace(value, " {2,}", " ")).otherwise(value))


def title_key(title: Column) -> Column:
    """The form titles are compared in: lower case letters, digits and blanks."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(F.coalesce(title, F.lit("")))), "[^a-z0-9 ]+", " "))


def item_text(title: Column, summary: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit("")))


# -- keyword predicates (on match_text) ---------------------------------------------------------------------------

def matches(norm: Column, keywords: Keywords) -> Column:
    pattern = keywords.any_pattern()
    return norm.rlike("(?U)" + pattern) if pattern else F.lit(False)


def is_excluded(norm_title: Column, keywords: Keywords) -> Column:
    pattern = keywords.exclude_pattern()
    return norm_title.rlike("(?U)" + pattern) if pattern else F.lit(False)


def keyword_windows(norm: Column, keywords: Keywords) -> Column:
    """The words that open some term, each with a mark before it and the words that may complete the term behind it.

    One scan of the text, however many terms there are; terms are then looked up in this short string.
    """
    pattern = window_pattern(keywords.all_terms())
    if pattern is None:
        return F.lit("")
    found = F.regexp_extract_all(norm, F.lit("(?U)" + pattern), F.lit(1))
    return F.concat(F.lit(MARK), F.array_join(found, MARK), F.lit(MARK))


def _found(windows: Column, norm: Column, term: Term) -> Column:
    """Whether a term occurs. Single words need no pattern; phrases are tried on the windows, other spellings on the text."""
    if not term.opening:
        return norm.rlike("(?U)" + term.pattern)
    opened = F.contains(windows, F.lit(MARK + term.opening))
    if not term.plain_words:
        return opened & norm.rlike("(?U)" + term.pattern)
    if len(term.words) == 1 and not term.whole:
        return opened
    return opened & windows.rlike("(?U)" + term.pattern)


def hits(norm: Column, keywords: Keywords, windows: Column | None = None) -> Column:
    """Terms found, in dictionary order. ``windows``: a column of ``keyword_windows``, if there is one already."""
    if windows is None:
        return bind(keyword_windows(norm, keywords), lambda w: hits(norm, keywords, w))
    return F.array_compact(F.array(*[F.when(_found(windows, norm, t), F.lit(t.name)) for t in keywords.terms()]))


def hit_count(norm: Column, keywords: Keywords, windows: Column | None = None) -> Column:
    if windows is None:
        return bind(keyword_windows(norm, keywords), lambda w: hit_count(norm, keywords, w))
    total = F.lit(0)
    for t in keywords.terms():
        total = total + _found(windows, norm, t).cast("int")
    return total


def categories(norm: Column, keywords: Keywords, windows: Column | None = None) -> Column:
    if windows is None:
        return bind(keyword_windows(norm, keywords), lambda w: categories(norm, keywords, w))
    parts = []
    for name, terms in keywords.terms_by_category():
        some = F.lit(False)
        for t in terms:
            some = some | _found(windows, norm, t)
        parts.append(F.when(some, F.lit(name)))
    return F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")


def has_domestic_marker(norm: Column, keywords: Keywords) -> Column:
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    found = F.lit(False)
    for m in keywords.markers:
        found = found | F.contains(padded, F.lit(m))
    return found


def looks_like_event(title: Column) -> Column:
    return F.coalesce(title, F.lit("")).rlike(r"(?iuU)^\s*(" + "|".join(EVENT_OPENERS) + r")\b")


# -- HTML to text ------------------------------------------------------------------------------------------------

class _TextOnly(HTMLParser):
    """Collects the text between tags; script and style text counts as text, as the parser sees it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def _strip_tags(raw: str) -> str:
    parser = _TextOnly()
    parser.feed(raw)
    parser.close()
    return " ".join(parser.parts)


@F.pandas_udf(T.StringType())
def _plain_from_html(raw: pd.Series) -> pd.Series:
    def one(value):
        if value is None:
            return None
        text = _strip_tags(value) if "<" in value and ">" in value else value
        return html.unescape(text)

    return raw.map(one)


def shorten(text: Column, limit: int) -> Column:
    """Cut at the last blank inside the limit and mark the cut; short text stays as it is."""
    cut = F.regexp_replace(F.substring(text, 1, limit), r" [^ ]*$", "")
    marked = F.concat(F.regexp_replace(cut, r"[,.;: ]+$", ""), F.lit("…"))
    return F.when(F.length(text) > limit, marked).otherwise(text)


def tidy(text: Column, limit: int) -> Column:
    """Single blanks, feed boilerplate at the end removed, shortened."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))
    flat = F.trim(F.regexp_replace(flat, r"The post .{0,200} appeared first on .{0,100}\.?$", ""))
    return shorten(flat, limit)


def clean_text(raw: Column, limit: int = SUMMARY_LIMIT) -> Column:
    """Markup or entities to plain text. Rows without either never reach Python's parser."""
    needs = raw.rlike("[<&]")
    parsed = _plain_from_html(F.when(needs, raw))
    return tidy(F.when(needs, parsed).otherwise(raw), limit)


def clean_title(raw: Column) -> Column:
    return F.regexp_replace(clean_text(raw, TITLE_LIMIT), "…+$", "")
