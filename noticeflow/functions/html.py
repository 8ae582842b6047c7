"""Small tolerant HTML reader used inside the page-parsing task.

It turns one captured page into named lists of strings (cell texts, labels,
links).  Everything positional after that (strides, zips, dedup) is done with
native Spark array functions, so this helper stays small: a stdlib tokenizer,
a forgiving tree builder and a handful of selectors.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}
# A start tag closes an open sibling of these kinds (searching up to a boundary).
IMPLIED_CLOSE = {
    "p": ({"p"}, {"div", "td", "th", "li", "body", "section", "article"}),
    "li": ({"li"}, {"ul", "ol"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
}
BLOCK_CLOSES_P = {"div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6",
                  "section", "article", "nav", "form", "pre", "blockquote", "hr"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def strings(self):
        stack = [iter(self.children)]
        while stack:
            for ch in stack[-1]:
                if isinstance(ch, str):
                    yield ch
                elif ch.tag not in ("script", "style"):
                    stack.append(iter(ch.children))
                    break
            else:
                stack.pop()

    def text(self, strip: bool = True) -> str:
        if strip:
            return "".join(s.strip() for s in self.strings() if s.strip())
        return "".join(self.strings())

    def iter(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed([c for c in node.children if not isinstance(c, str)]))

    def find_all(self, tag: str, cls: str | None = None, style: str | None = None):
        out = []
        for n in self.iter():
            if n is self or n.tag != tag:
                continue
            if cls is not None and cls not in (n.attrs.get("class") or "").split():
                continue
            if style is not None and n.attrs.get("style") != style:
                continue
            out.append(n)
        return out

    def find(self, tag: str, cls: str | None = None):
        found = self.find_all(tag, cls)
        return found[0] if found else None


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#document", {}, None)
        self.stack = [self.root]

    def _close_until(self, targets: set, boundary: set):
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t in targets:
                del self.stack[i:]
                return
            if t in boundary:
                return

    def handle_starttag(self, tag, attrs):
        if tag in IMPLIED_CLOSE:
            self._close_until(*IMPLIED_CLOSE[tag])
        if tag in BLOCK_CLOSES_P:
            self._close_until({"p"}, IMPLIED_CLOSE["p"][1])
        node = Node(tag, {k: (v or "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, {k: (v or "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(html: str) -> Node:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    return b.root


# ---------------------------------------------------------------- layouts
# The inline styles that identify the four Wexford columns.
COLUMN_STYLES = {
    "file_no": "text-align: left; width: 75px; white-space: normal;",
    "received": "text-align: left; width: 65px; white-space: normal;",
    "applicant": "text-align: left; width: 190px; white-space: normal;",
    "address": "text-align: left; width: 275px; white-space: normal;",
}
CONSULTATION_LIST_INDEX = 6  # the seventh <ul> holds the consultation list


def _texts(nodes, strip=True):
    return [n.text(strip) for n in nodes]


_RUNS = re.compile(r"[\r\n]+|\s{2,}")


def _table_texts(nodes):
    """Result-table cells: whitespace runs collapsed, then stripped."""
    return [_RUNS.sub(" ", n.text(False)).strip() for n in nodes]


def _within(node: Node, tag: str) -> Node | None:
    """The nearest enclosing element of that tag."""
    up = node.parent
    while up is not None and up.tag != tag:
        up = up.parent
    return up


def _own(holder: Node, tag: str) -> list[Node]:
    """Elements of that tag in ``holder``, without those of a nested holder."""
    return [n for n in holder.find_all(tag) if _within(n, holder.tag) is holder]


def extract_layout(layout: str, html: str) -> tuple[str, dict[str, list[str]]]:
    """Return (detected layout, named string lists) for one page."""
    root = parse(html)
    if layout == "table":
        tbl = root.find("table", "table")
        if tbl is None:
            return layout, {"headers": [], "cells": []}
        return layout, {"headers": _table_texts(_own(tbl, "th")),
                        "cells": _table_texts(_own(tbl, "td"))}
    if layout in ("grid5", "responsive7"):
        cells = []
        for tr in root.find_all("tr"):
            cells.extend(_texts(_own(tr, "td")))
        return layout, {"cells": cells}
    if layout == "columns4":
        return layout, {name: _texts(root.find_all("div", style=st))
                        for name, st in COLUMN_STYLES.items()}
    if layout == "deflist4":
        dd = []
        for dl in root.find_all("dl"):
            dd.extend(_texts(dl.find_all("dd")))
        totals = root.find("li", "totals")
        return layout, {"file_no": _texts(root.find_all("h3", "responsiveheader")),
                        "dd": dd, "totals": [totals.text()] if totals else []}
    if layout in ("cards6", "case1"):
        if root.find("h2") is not None:
            party = []
            for a in root.find_all("a"):
                if not a.find_all("span", "title"):
                    continue
                ul = a.find("ul")
                li = ul.find("li") if ul is not None else None
                party.append(li.text(False).strip() if li is not None else "")
            return "cards6", {"title": _texts(root.find_all("span", "title")),
                              "details": _texts(root.find_all("span", "details")),
                              "party": party}
        addr, strong = root.find("p", "address"), root.find("strong")
        summary = root.find("p", "case-summary")
        party_p = next((p for p in (li.find("p") for li in root.find_all("li")) if p is not None), None)
        return "case1", {
            "address": [addr.text(False)] if addr else [],
            "strong": [strong.text(False)] if strong else [],
            "summary": [summary.text(False)] if summary else [],
            "party": [party_p.text(False)] if party_p else [],
        }
    if layout == "links5":
        uls = root.find_all("ul")
        counter = root.find("div", "pagination")
        out = {"anchor": [], "href": [], "para": [],
               "counter": [counter.text()] if counter else []}
        if len(uls) > CONSULTATION_LIST_INDEX:
            lst = uls[CONSULTATION_LIST_INDEX]
            anchors = lst.find_all("a")
            out["anchor"] = _texts(anchors, strip=False)
            out["href"] = [a.attrs.get("href", "") for a in anchors]
            out["para"] = _texts(lst.find_all("p"), strip=False)
        return layout, out
    raise ValueError(f"unknown layout {layout!r}")
