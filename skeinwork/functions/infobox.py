"""Infobox tables of rendered pages as lines of text."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Node:
    __slots__ = ("tag", "css", "children")

    def __init__(self, tag: str, css: str = ""):
        self.tag, self.css, self.children = tag, css, []

    def walk(self):
        """All nodes below, in the order of the page; the open ones are on a stack of our own, as bad pages nest without bound."""
        waiting = [iter(self.children)]
        while waiting:
            child = next(waiting[-1], None)
            if child is None:
                waiting.pop()
            elif isinstance(child, _Node):
                yield child
                waiting.append(iter(child.children))

    def texts(self, breaks: bool = False):
        waiting = [(self, iter(self.children))]
        while waiting:
            node, rest = waiting[-1]
            child = next(rest, None)
            if child is None:
                waiting.pop()
                if breaks and node.tag == "li" and waiting:
                    yield ","
            elif not isinstance(child, _Node):
                if child.strip():
                    yield child.strip()
            elif breaks and child.tag in ("br", "hr"):
                yield ","
            else:
                waiting.append((child, iter(child.children)))

    def find(self, *tags: str):
        return next((n for n in self.walk() if n.tag in tags), None)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs).get("class") or "")
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(_Node(tag, dict(attrs).get("class") or ""))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def infobox_text(html: str | None) -> str:
    """Title, subheaders and `key: value` lines of the first infobox table; empty if there is none."""
    if not html or "infobox" not in html and "sinottico" not in html:
        return ""
    tree = _Tree()
    tree.feed(html)
    box = next((n for n in tree.root.walk() if n.tag == "table" and ("infobox" in n.css or "sinottico" in n.css)), None)
    if box is None:
        return ""
    title = box.find("caption") or next((n for n in box.walk() if n.tag == "th" and re.search("testata|title", n.css, re.I)), None)
    lines = ["".join(title.texts())] if title else []
    lines += [t for n in box.walk() if re.search("subheader", n.css, re.I) and (t := "".join(n.texts()))]
    for row in (n for n in box.walk() if n.tag == "tr"):
        head, cell = row.find("th"), row.find("td")
        if head is None or cell is None:
            continue
        key = " ".join(head.texts())
        value = re.sub(r"\[\s*\d+\s*\]", "", " ".join(cell.texts(breaks=True)))
        value = re.sub(r"\s*(?:,\s*)+", ", ", re.sub(r"\s+", " ", value)).strip(", ")
        if key and value:
            lines.append(f"{key}: {value}")
    return "\n".join(lines)


@F.pandas_udf(StringType())
def infobox(html: pd.Series) -> pd.Series:
    """Column form of infobox_text; the HTML parser is Python, so pages go over in Arrow batches."""
    return html.map(infobox_text)
