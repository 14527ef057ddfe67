"""Small parsed-tree helper for the rule path (runs inside Python workers).

Built on the stdlib tokenizer.  Tree building matches a lenient parser that
adds no implied end tags: an end tag closes the nearest open element with
that name (and everything opened after it); an end tag without an open
element is ignored.  Comments, script, style and template text are kept out
of ``get_text``.  Only the selector forms the site rules need are supported:
``tag``, ``.class``, ``[attr]``, ``[attr=value]``, compounds of
those, descendant (space) and child (``>``) combinators.
"""

from __future__ import annotations

import html as html_std
import re
from bisect import bisect_left, bisect_right
from html.entities import html5 as _HTML5
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source "
    "track wbr basefont bgsound command frame image isindex nextid spacer".split())
NON_TEXT = frozenset(("script", "style", "template"))
#: Tags without attributes that need nothing but their name (no raw text follows them).
_BARE = re.compile(r"<(p|div|span|a|b|i|li|ul|h[1-6]|article|time)>")
_BARE_END = re.compile(r"</([a-z][a-z0-9]*)>")


class Node:
    """An element.  What it holds is a range of its page's elements and texts, which
    lie in document order."""

    __slots__ = ("name", "attrs", "parent", "page", "at", "end", "text_at", "text_end")

    def __init__(self, name, attrs, parent, page):
        self.name = name
        self.attrs = attrs
        self.parent = parent
        self.page = page
        self.at = len(page.elements)
        self.text_at = len(page.texts)
        page.elements.append(self)
        self.close()

    def close(self):
        self.end = len(self.page.elements)
        self.text_end = len(self.page.texts)

    # -- attributes ------------------------------------------------------
    def get(self, key, default=None):
        if key == "class":
            v = self.attrs.get("class")
            return v.split() if v is not None else default
        return self.attrs.get(key, default)

    @property
    def classes(self):
        return (self.attrs.get("class") or "").split()

    # -- traversal -------------------------------------------------------
    def _inside(self, places):
        """The descendants among some places of the page."""
        elements = self.page.elements
        return (elements[i] for i in places[bisect_right(places, self.at):bisect_left(places, self.end)])

    def get_text(self, sep="", strip=False):
        texts = self.page.texts[self.text_at:self.text_end]
        if strip:
            texts = [t for t in map(str.strip, texts) if t]
        return sep.join(texts)

    def find(self, name, **attrs):
        for e in self._inside(self.page.tags.get(name, ())):
            if all((k in e.attrs) == bool(v) for k, v in attrs.items()):
                return e
        return None

    def find_all(self, name):
        return list(self._inside(self.page.tags.get(name, ())))

    def _hits(self, chain):
        tag, classes, attrs = chain[-1][1]
        page = self.page
        places = (page.classes.get(classes[0], ()) if classes else page.tags.get(tag, ()) if tag
                  else page.attrs.get(attrs[0][0], ()))
        return (e for e in self._inside(places) if _match_chain(e, chain, len(chain) - 1))

    def select(self, selector):
        chains = parse_selector(selector)
        found = {e.at: e for chain in chains for e in self._hits(chain)}
        return [found[at] for at in sorted(found)]

    def select_one(self, selector):
        first = [e for chain in parse_selector(selector) if (e := next(self._hits(chain), None)) is not None]
        return min(first, key=lambda e: e.at, default=None)

    def release(self):
        """Empty the page, so that its nodes go at once and not by the cycle collector."""
        self.page.clear()


class _Page:
    """Elements and texts in document order, and where each tag, class and attribute stands."""

    __slots__ = ("elements", "texts", "tags", "classes", "attrs")

    def __init__(self):
        self.elements, self.texts = [], []
        self.tags, self.classes, self.attrs = {}, {}, {}

    def add(self, name, attrs, parent):
        node = Node(name, attrs, parent, self)
        self.tags.setdefault(name, []).append(node.at)
        for key in attrs:
            self.attrs.setdefault(key, []).append(node.at)
        for c in set(node.classes):
            self.classes.setdefault(c, []).append(node.at)
        return node

    def clear(self):
        for held in (self.elements, self.texts, self.tags, self.classes, self.attrs):
            held.clear()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.page = _Page()
        self.root = Node("[document]", {}, None, self.page)
        self.open = [self.root]
        self.buf = []

    # -- shortcuts of the tokenizer: bare tags, and no line numbers
    def updatepos(self, i, j):
        return j

    def parse_starttag(self, i):
        m = _BARE.match(self.rawdata, i)
        if m is None:
            return super().parse_starttag(i)
        self.handle_starttag(m.group(1), [])
        return m.end()

    def parse_endtag(self, i):
        m = _BARE_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if m is None:
            return super().parse_endtag(i)
        self.handle_endtag(m.group(1))
        return m.end()

    def _flush(self):
        if self.buf:
            if self.open[-1].name not in NON_TEXT:
                self.page.texts.append("".join(self.buf))
            self.buf = []

    def handle_starttag(self, tag, attrs):
        self._flush()
        node = self.page.add(tag, {k: "" if v is None else v for k, v in attrs}, self.open[-1])
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                for node in self.open[i:]:
                    node.close()
                del self.open[i:]
                return

    def handle_data(self, data):
        self.buf.append(data)

    def handle_entityref(self, name):
        ch = _HTML5.get(name + ";")
        self.buf.append(ch if ch is not None else "&" + name)

    def handle_charref(self, name):
        self.buf.append(html_std.unescape(f"&#{name};"))

    def _other(self, data):
        self._flush()

    handle_comment = handle_decl = handle_pi = unknown_decl = _other

    def finish(self):
        self._flush()
        for node in self.open:
            node.close()
        return self.root


def parse(html: str | None) -> Node:
    """Parse a page; raises where the markup breaks the parser (callers isolate the page)."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.finish()


# ---------------------------------------------------------------------------
# selectors
# ---------------------------------------------------------------------------
_TOKEN = re.compile(r"""\s*(>)\s*|\s+|([^\s>]+(?:\[[^\]]*\])*)""")
_SIMPLE = re.compile(
    r"""([A-Za-z][A-Za-z0-9-]*)|\.([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]*)))?\s*\]""")
_CACHE: dict = {}


def _parse_compound(text):
    tag, classes, attrs, pos = None, [], [], 0
    while pos < len(text):
        m = _SIMPLE.match(text, pos)
        if not m:
            raise ValueError(f"unsupported selector: {text!r}")
        if m.group(1):
            tag = m.group(1).lower()
        elif m.group(2):
            classes.append(m.group(2))
        else:
            val = next((g for g in m.group(4, 5, 6) if g is not None), None)
            attrs.append((m.group(3).lower(), val))
        pos = m.end()
    return tag, classes, attrs


def parse_selector(sel):
    """Selector group -> list of chains of (combinator, compound)."""
    chains = _CACHE.get(sel)
    if chains is None:
        chains = []
        for part in sel.split(","):
            chain, comb = [], " "
            for m in _TOKEN.finditer(part.strip()):
                if m.group(1):
                    comb = ">"
                elif m.group(2):
                    chain.append((comb, _parse_compound(m.group(2))))
                    comb = " "
            chains.append(chain)
        _CACHE[sel] = chains
    return chains


def _match_compound(e, compound):
    tag, classes, attrs = compound
    if tag and e.name != tag:
        return False
    if classes:
        have = e.classes
        if any(c not in have for c in classes):
            return False
    for k, v in attrs:
        if k not in e.attrs or (v is not None and e.attrs[k] != v):
            return False
    return True


def _match_chain(e, chain, i):
    comb, compound = chain[i]
    if not _match_compound(e, compound):
        return False
    if i == 0:
        return True
    p = e.parent
    if comb == ">":
        return isinstance(p, Node) and p.name != "[document]" and _match_chain(p, chain, i - 1)
    while isinstance(p, Node) and p.name != "[document]":
        if _match_chain(p, chain, i - 1):
            return True
        p = p.parent
    return False
