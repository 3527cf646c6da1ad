"""Keyword dictionary and the patterns built from it."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

# ---- fixed values: default dictionary, accent-free lower case --------------------------------------------------

STEMS_CS = (
    "klima", "klimat", "emis", "dekarbon", "bezemis", "obnoviteln", "fotovolt", "solarn", "vetrn", "vetrnik", "jadern",
    "jadr", "uhel", "uhli", "uheln", "teplarn", "tepeln cerpad", "energetick chudob", "energeticky chudob",
    "spravedliv transformac", "spravedliv prechod", "uheln region", "zelen dohod", "uspor energi", "zatepl",
    "elektromobil", "vodik", "skleniko", "oteplov", "uhlikov", "povolenk", "cena elektrin", "ceny elektrin",
    "ceny energi", "cena energi", "energetik", "energetick", "modernizacni fond", "socialni klimaticky fond",
    "nova zelena usporam", "postoj", "verejn mineni", "pruzkum", "komunikac", "dezinformac", "sucho", "adaptac",
)

STEMS_EN = (
    "climate", "emission", "decarboni", "renewable", "net zero", "net-zero", "solar", "wind power", "wind farm",
    "offshore wind", "onshore wind", "nuclear", "coal", "heat pump", "energy transition", "energy poverty",
    "fuel poverty", "just transition", "carbon", "greenhouse", "global warming", "electric vehicle", "hydrogen",
    "energy efficiency", "electricity price", "energy price", "power market", "grid", "public opinion", "attitude",
    "survey", "poll", "messaging", "framing", "narrative", "misinformation", "disinformation", "forecast", "outlook",
    "scenario", "green deal", "clean energy", "fossil", "methane", "heatwave", "extreme weather",
)

EXACT_TERMS = (
    "ets", "ets2", "eu ets", "cbam", "oze", "fve", "cop30", "cop31", "ipcc", "unfccc", "ev", "evs", "lng", "co2", "smr",
)

MEDIA_EXTRA_STEMS = (
    "zelena", "zelene", "zeleny", "zelenych", "zelenou", "zelenym", "zeleni", "green", "energi", "elektrin", "elektrar",
    "plyn", "topen", "vytapen", "benzin", "naft", "pohonn hmot", "emisn", "sucho", "povod", "vedr", "horko",
    "extremn pocasi", "aktivist", "posledni generac", "brusel", "fialov", "ekolog", "ekoterorist", "zakaz spalovac",
    "spalovac motor", "elektroaut",
)

CATEGORIES = {
    "public_attitudes": (
        "postoj", "verejn mineni", "pruzkum", "public opinion", "attitude", "survey", "poll", "acceptance", "akceptac",
        "podpor verejnosti", "public support",
    ),
    "communication": (
        "komunikac", "narativ", "dezinformac", "messaging", "framing", "narrative", "misinformation", "disinformation",
        "communicat",
    ),
    "forecast": (
        "forecast", "outlook", "scenario", "prognoz", "scenar", "projection", "vyhled",
    ),
    "just_transition": (
        "spravedliv transformac", "spravedliv prechod", "energetick chudob", "energeticky chudob", "just transition",
        "energy poverty", "fuel poverty", "uheln region",
    ),
    "energy_markets": (
        "cena elektrin", "ceny elektrin", "ceny energi", "cena energi", "electricity price", "energy price", "power market",
        "povolenk", "trh s elektrin",
    ),
    "decarbonization_policy": (
        "ets", "ets2", "cbam", "zelen dohod", "green deal", "climate policy", "klimaticka politik", "regulac", "zakon",
        "legislat", "directive", "smernic",
    ),
    "technology": (
        "fotovolt", "solarn", "vetrn", "jadern", "tepeln cerpad", "heat pump", "hydrogen", "vodik", "nuclear", "solar",
        "wind", "batter", "bateri", "smr",
    ),
    "study": (
        "studie", "study", "analyz", "analysis", "report", "zprava", "paper", "research", "vyzkum",
    ),
}

EXCLUDED_TITLES = (
    "hledame", "volna pozice", "volne misto", "pracovni pozic", "nabidka prace", "pridej se k nam", "prijmeme",
    "we are hiring", "we're hiring", "job opening", "vacancy", "vacancies", "careers at", "internship", "staz",
    "podpor nas", "darujte",
)

# substrings that mark a domestic subject, searched in " " + normalised text + " "
DOMESTIC_MARKERS = ("cesk", "cesi ", "cech", "czech", " cr ", " cr,", "praha", "prague", "moravsk", "brno", "ostrav")

# titles that announce an event begin with one of these
EVENT_OPENERS = (
    "veřejná debata", "debata", "diskuse", "panelová diskuse", "konference", "webinář", "webinar", "seminář", "seminar",
    "workshop", "kulatý stůl", "round ?table", "pozvánka", "zveme vás", "invitation", "join us", "event",
    "save the date", "křest", "přednáška", "online debata", "live debate", "public debate", "conference",
)

# ---- end of fixed values ---------------------------------------------------------------------------------------


def plain(text: str) -> str:
    """Accent-free lower case with single blanks; the driver-side twin of ``text.match_text``."""
    folded = unicodedata.normalize("NFKD", text or "")
    folded = "".join(c for c in folded if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", folded.lower())


def _quote(word: str) -> str:
    """Escape a word for both Java and RE2 patterns."""
    return re.sub(r"([^0-9a-z ])", lambda m: m.group(1) if ord(m.group(1)) > 127 else "\\" + m.group(1), word)


def stem_pattern(phrase: str) -> str:
    """Every word of the phrase is an open-ended stem; words follow each other."""
    return r"\b" + r"\w*[\s\-]+".join(_quote(w) for w in plain(phrase).split())


def exact_pattern(term: str) -> str:
    return r"\b" + r"\s+".join(_quote(w) for w in plain(term).split()) + r"\b"


def any_of(patterns: list[str]) -> str:
    """One pattern for all. Every part begins at a word boundary, so that test and first letters are shared:
    an engine that tries parts one by one then skips most of them at each position."""
    by_letter: dict[str, list[str]] = {}
    for p in patterns:
        body = p.removeprefix(r"\b")
        first = body[:2] if body.startswith("\\") else body[:1]
        by_letter.setdefault(first, []).append(body[len(first):])
    return r"\b(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_letter.items()) + ")"


def _opening(word: str) -> str:
    """The letters, digits and underscores that a word begins with."""
    return re.match(r"\w*", word).group()


def shortest(prefixes: set[str]) -> list[str]:
    """The prefixes that no other one is a prefix of."""
    return [p for p in sorted(prefixes) if not any(p[:n] in prefixes for n in range(1, len(p)))]


@dataclass(frozen=True)
class Term:
    """A dictionary term as it is looked up among the words of a text that open some term (see ``text.keyword_windows``)."""

    name: str
    pattern: str
    words: tuple[str, ...]
    whole: bool

    @property
    def opening(self) -> str:
        return _opening(self.words[0])

    @property
    def plain_words(self) -> bool:
        """Whether each word is a run of word characters, so that a window of words holds the whole term."""
        return all(_opening(w) == w for w in self.words)


def stem_term(phrase: str) -> Term:
    return Term(phrase, stem_pattern(phrase), tuple(plain(phrase).split()), False)


def exact_term(term: str) -> Term:
    return Term(term, exact_pattern(term), tuple(plain(term).split()), True)


def window_pattern(terms: list[Term]) -> str | None:
    """Group 1: each word that opens a term, with as many following words as the longest term has. None without terms.

    Openings that extend another one are left out, whole words end at a boundary, and a look-ahead keeps words that
    windows share. The pattern is one alternation by first letters, however many terms there are.
    """
    openings = shortest({t.opening for t in terms if not (t.whole and t.words == (t.opening,))} - {""})
    whole = {t.opening for t in terms if t.whole and t.words == (t.opening,)}
    alone = sorted(w for w in whole if not any(w[:n] in openings for n in range(1, len(w) + 1)))
    if not openings and not alone:
        return None
    more = max(len(t.words) for t in terms if t.opening) - 1
    body = any_of([r"\b" + w + r"\w*" for w in openings] + [r"\b" + w + r"\b" for w in alone]).removeprefix(r"\b")
    rest = rf"(?:[\s\-]+\w+){{0,{more}}}" if more else ""
    return rf"\b(?=({body}{rest}))\w"


@dataclass(frozen=True)
class Keywords:
    """A keyword set: the pluggable matcher of the prefilter and of the heuristic score."""

    stems: list[str]
    exact: list[str] = field(default_factory=list)
    categories: dict[str, list[str]] = field(default_factory=dict)
    exclude: list[str] = field(default_factory=list)
    markers: tuple[str, ...] = DOMESTIC_MARKERS

    def term_patterns(self) -> list[tuple[str, str]]:
        return [(t.name, t.pattern) for t in self.terms()]

    def terms(self) -> list[Term]:
        return [stem_term(s) for s in self.stems] + [exact_term(e) for e in self.exact]

    def all_terms(self) -> list[Term]:
        """The terms of the dictionary and of its categories."""
        return self.terms() + [t for _, terms in self.terms_by_category() for t in terms]

    def any_pattern(self) -> str | None:
        return any_of([p for _, p in self.term_patterns()]) if self.stems or self.exact else None

    def exclude_pattern(self) -> str | None:
        return any_of([stem_pattern(p) for p in self.exclude]) if self.exclude else None

    def terms_by_category(self) -> list[tuple[str, list[Term]]]:
        """Terms per category; terms of up to three letters match as whole words."""
        return [(name, [stem_term(t) if len(t) > 3 else exact_term(t) for t in terms]) for name, terms in self.categories.items()]

    def category_patterns(self) -> list[tuple[str, str]]:
        """One pattern per category."""
        return [(name, any_of([t.pattern for t in terms])) for name, terms in self.terms_by_category()]


def default_keywords() -> Keywords:
    return Keywords(stems=list(STEMS_CS) + list(STEMS_EN), exact=list(EXACT_TERMS),
                    categories={k: list(v) for k, v in CATEGORIES.items()}, exclude=list(EXCLUDED_TITLES))


def media_keywords() -> Keywords:
    """The wider set used on monitored media."""
    return Keywords(stems=list(STEMS_CS) + list(STEMS_EN) + list(MEDIA_EXTRA_STEMS), exact=list(EXACT_TERMS),
                    exclude=list(EXCLUDED_TITLES))


def keyword_table(spark, keywords: Keywords | None = None):
    """The dictionary as a small table (kind, term, pattern)."""
    kw = keywords or default_keywords()
    rows = [("stem", s, stem_pattern(s)) for s in kw.stems] + [("exact", e, exact_pattern(e)) for e in kw.exact]
    rows += [(f"category:{c}", t, stem_pattern(t) if len(t) > 3 else exact_pattern(t))
             for c, terms in kw.categories.items() for t in terms]
    rows += [("exclude", p, stem_pattern(p)) for p in kw.exclude]
    return spark.createDataFrame(rows, "kind string, term string, pattern string")


def keywords_from_table(rows) -> Keywords:
    """Back from the collected dictionary table (a configuration list, a few hundred rows)."""
    cats: dict[str, list[str]] = {}
    for r in rows:
        if r["kind"].startswith("category:"):
            cats.setdefault(r["kind"].split(":", 1)[1], []).append(r["term"])
    return Keywords(stems=[r["term"] for r in rows if r["kind"] == "stem"],
                    exact=[r["term"] for r in rows if r["kind"] == "exact"],
                    categories=cats, exclude=[r["term"] for r in rows if r["kind"] == "exclude"])
