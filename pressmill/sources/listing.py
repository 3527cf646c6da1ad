"""Listing pages to entries by each source's selectors. Pages are parsed in Arrow batches; all else is columns."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.dates import parse_date
from pressmill.functions.urls import absolute_url
from pressmill.operators.common import top_per_group

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ENTRY = ("payload_id string, source_id string, feed_pos int, title string, href string, date_text string, "
         "summary string, now timestamp, _base string, problem string")


class _Tree(HTMLParser):
    """A tolerant tree: unknown end tags are ignored, open ones are closed by their parent's end."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ET.Element("root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        el = ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})
        if tag not in VOID:
            self.open.append(el)

    def handle_startendtag(self, tag, attrs):
        ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        parent = self.open[-1]
        if len(parent):
            parent[-1].tail = (parent[-1].tail or "") + data
        else:
            parent.text = (parent.text or "") + data


_PART = re.compile(r"(?P<tag>^[a-zA-Z][\w-]*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)"
                   r"|\[(?P<attr>[\w-]+)(?:(?P<op>[*^$]?=)\"?(?P<val>[^\"\]]*)\"?)?\]|:has\((?P<has>[^()]*)\)")


class Page:
    """The selectors listings need: tag, class, id, attribute, descendant, child, :has and lists of these."""

    def __init__(self, html: str):
        tree = _Tree()
        tree.feed(html)
        tree.close()
        self.root = tree.root
        self.parent = {c: p for p in self.root.iter() for c in p}

    def select(self, scope: ET.Element, selector: str) -> list[ET.Element]:
        wanted = [self._steps(s) for s in selector.split(",")]
        return [e for e in scope.iter() if e is not scope and any(self._fits(e, s, len(s) - 1, scope) for s in wanted)]

    def _steps(self, selector: str) -> list[tuple[str, str]]:
        steps, link = [], " "
        for token in re.findall(r">|(?:[^\s>(\[]|\([^)]*\)|\[[^\]]*\])+", selector):
            if token == ">":
                link = ">"
            else:
                steps.append((link, token))
                link = " "
        return steps

    def _fits(self, el, steps, i, scope) -> bool:
        link, simple = steps[i]
        if not self._simple(el, simple):
            return False
        up = self.parent.get(el)
        if i == 0:
            return link == " " or up is scope
        while up is not None:
            if self._fits(up, steps, i - 1, scope):
                return True
            if link == ">":
                return False
            up = self.parent.get(up)
        return False

    def _simple(self, el, simple) -> bool:
        for m in _PART.finditer(simple):
            g = m.groupdict()
            value = el.get(g["attr"]) if g["attr"] else None
            ok = {"tag": lambda: el.tag == g["tag"], "cls": lambda: g["cls"] in el.get("class", "").split(),
                  "id": lambda: el.get("id") == g["id"], "has": lambda: bool(self.select(el, g["has"])),
                  "attr": lambda: value is not None and {
                      None: lambda: True, "=": lambda: value == g["val"], "*=": lambda: g["val"] in value,
                      "^=": lambda: value.startswith(g["val"]), "$=": lambda: value.endswith(g["val"])}[g["op"]]()}
            if not next(test() for name, test in ok.items() if g[name] is not None):
                return False
        return True

    def first(self, scope, selector):
        if not selector:
            return None
        return scope if selector == ":self" else next(iter(self.select(scope, selector)), None)

    def link_of(self, node, title, selector):
        chosen = self.first(node, selector)
        if chosen is not None or title is None:
            return chosen if chosen is not None else self.first(node, "a[href]")
        around = title
        while around is not None and around.tag != "a":
            around = self.parent.get(around)
        if around is not None:
            return around
        if node.tag == "a":
            return node
        inner = self.first(title, "a[href]")
        return inner if inner is not None else self.first(node, "a[href]")


def _text(el) -> str:
    return " ".join(" ".join(el.itertext()).split()) if el is not None else ""


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            page = Page(r.body or "")
            nodes = page.select(page.root, r.item)
            if not nodes:
                rows.append((r.payload_id, r.source_id, None, None, None, None, None, r.fetched_at, r.url,
                             "parse_error: no element matches the item selector"))
            for pos, node in enumerate(nodes):
                title_el = page.first(node, r.title)
                link_el = page.link_of(node, title_el, r.link)
                date_el = page.first(node, r.date)
                when = date_el.get(r.date_attr) if date_el is not None and r.date_attr else None
                rows.append((r.payload_id, r.source_id, pos, _text(title_el),
                             link_el.get("href") if link_el is not None else None, when or _text(date_el),
                             _text(page.first(node, r.summary)), r.fetched_at, r.url, None))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in ENTRY.split(", ")]).astype({"feed_pos": "Int32"})


def parse_listings(payloads: DataFrame, sources: DataFrame) -> DataFrame:
    """Entries of listing pages, one per distinct absolute address of a page; columns as in ``feeds.parse_feeds``."""
    rules = sources.where("scrape is not null").select(F.col("id").alias("source_id"), *[
        F.coalesce(F.col(f"scrape.{c}"), F.lit("")).alias(c) for c in ("item", "title", "link", "date", "date_attr", "summary")])
    pages = payloads.join(rules, "source_id").select("payload_id", "source_id", "url", "body", "fetched_at", "item",
                                                     "title", "link", "date", "date_attr", "summary")
    parsed = pages.mapInPandas(_parse, ENTRY)
    good = (parsed.where("problem is null and title <> '' and coalesce(href, '') <> ''")
            .where(~F.col("href").rlike("^(javascript:|mailto:|#)"))
            .withColumn("url", absolute_url(F.col("href"), F.col("_base"))))
    # distinct inside one page: a page is one payload, so the group is small
    good = top_per_group(good, ["payload_id", "url"], [F.col("feed_pos")], 1)
    entries = good.select(
        "payload_id", "source_id", "feed_pos", "title", "url", parse_date(F.col("date_text"), F.col("now")).alias("published"),
        "summary", F.array().cast("array<string>").alias("authors"), F.lit(None).cast("string").alias("doi"),
        F.lit(None).cast("string").alias("language"), "now", F.lit(None).cast("string").alias("problem"))
    return entries.unionByName(parsed.where("problem is not null").select("payload_id", "source_id", "now", "problem"),
                               allowMissingColumns=True)
