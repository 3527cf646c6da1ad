"""URL, identifier and DOI columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: tracking parameters dropped from queries, besides utm_*
TRACKING_PARAMETERS = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref", "ref_src", "cmpid", "_hsenc", "_hsmi")

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*([^?]*)"


def normalize_url(url: Column) -> Column:
    """One spelling per address: https, lower-case host, no default port, tracking, fragment or final slash."""
    text = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", "")
    scheme = F.lower(F.regexp_extract(text, _SCHEME, 1))
    scheme = F.when(scheme.isin("http", ""), F.lit("https")).otherwise(scheme)
    host = F.regexp_replace(F.lower(F.regexp_extract(text, _HOST, 1)), ":(443|80)$", "")
    path = F.regexp_replace(F.regexp_extract(text, _PATH, 1), "/+$", "")
    pairs = F.filter(F.split(F.regexp_extract(text, r"\?(.*)$", 1), "&"), lambda p: p != "")
    wanted = F.filter(pairs, lambda p: ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).rlike(
        "^(utm_.*|" + "|".join(TRACKING_PARAMETERS) + ")$"))
    spelled = F.transform(wanted, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    query = F.array_join(spelled, "&")
    return (F.when(text == "", F.lit(""))
            .otherwise(F.concat(scheme, F.lit("://"), host, path,
                                F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))))


def make_id(url: Column) -> Column:
    return F.substring(F.sha1(normalize_url(url)), 1, 12)


def absolute_url(link: Column, base: Column) -> Column:
    """Resolve a link against the page it was found on, dot segments included."""
    link = F.trim(F.coalesce(link, F.lit("")))
    scheme = F.regexp_extract(base, _SCHEME, 1)
    origin = F.concat(scheme, F.lit("://"), F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    bare = F.regexp_replace(base, r"[?#].*$", "")
    path = F.regexp_extract(bare, _PATH, 1)
    folder = F.concat(origin, F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", "")))
    return (F.when(link == "", base)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
            .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(origin, without_dots(link)))
            .when(F.startswith(link, F.lit("?")), F.concat(bare, link))
            .when(F.startswith(link, F.lit("#")), F.concat(F.regexp_replace(base, "#.*$", ""), link))
            .otherwise(F.concat(origin, without_dots(F.concat(F.substr(folder, F.length(origin) + 1), link)))))


def without_dots(path: Column) -> Column:
    """A path from the root with ``.`` and ``..`` segments resolved; query and fragment stay as they are."""
    bare = F.regexp_extract(path, r"^([^?#]*)", 1)
    parts = F.split(bare, "/")
    last = F.element_at(parts, -1)
    walked = F.aggregate(parts, F.array().cast("array<string>"), lambda done, part: (
        F.when(part == ".", done).when(part == "..", F.slice(done, 1, F.greatest(F.lit(1), F.size(done) - 1)))
        .otherwise(F.concat(done, F.array(part)))))
    resolved = F.concat(F.array_join(walked, "/"), F.when(last.isin(".", "..") , F.lit("/")).otherwise(F.lit("")))
    return F.concat(F.when(bare.rlike(r"(^|/)\.\.?(/|$)"), resolved).otherwise(bare), F.substr(path, F.length(bare) + 1))


def normalize_doi(doi: Column) -> Column:
    bare = F.regexp_replace(F.lower(F.trim(doi)), r"^(https?://)?(dx\.)?doi\.org/", "")
    return F.nullif(F.regexp_replace(bare, "^doi:", ""), F.lit(""))


def journal_slug(name: Column) -> Column:
    from pressmill.functions.text import strip_accents

    dashed = F.regexp_replace(F.lower(strip_accents(name)), "[^a-z0-9]+", "-")
    return F.concat(F.lit("journal-"), F.regexp_replace(dashed, "^-+|-+$", ""))
