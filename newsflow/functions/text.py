"""Text Column builders (all JVM-side, codegen-friendly).

The conventions mirror the behaviour the collector relies on:
Python ``str.strip`` semantics, truthiness chains, HTML text-node joining.
"""

from __future__ import annotations

import functools
from html.entities import html5

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Python's str.isspace() set: exactly what str.strip() removes.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Named character references decoded in page text: the standard's whole table
# (a name decodes with or without the trailing ';').  The first few are looked
# up before the rest: they are nearly all that pages use.
HTML_ENTITIES = {name.rstrip(";"): chars for name, chars in html5.items()}
FREQUENT_ENTITIES = ["amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "middot", "hellip", "ndash", "mdash",
                     "lsquo", "rsquo", "ldquo", "rdquo", "laquo", "raquo", "bull", "trade", "euro"]

# Replaced before any other reference is looked at; none gives a character that could go on a name.
PLAIN_ENTITIES = ["lt", "gt", "quot", "nbsp", "copy", "middot", "apos"]
# Stands for a decoded ampersand until all references are decoded (texts that hold it are decoded the long way).
HELD = "\ufdd0"

# Markup that yields no text node: comments, script and style bodies.
NON_TEXT_RE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# The rest of a tag before its '>': a quoted attribute value may hold one.
# Where a quote is never closed, the tag ends at the first '>'.
ATTRS_RE = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|)[^>=]*+)*+"""
# Anything the HTML tokenizer reads as a tag / declaration / PI.
TAG_RE = rf"</?[A-Za-z]{ATTRS_RE}>|</?[A-Za-z][^>]*>|<![^>]*>|<\?[^>]*>"
# Separates text nodes; a page's own NUL becomes U+FFFD, and no reference decodes to NUL.
NODE = "\x00"
# Opens a mark: a node that stands for a tag which later steps look for.
MARK = "\x01"


def _entity(name: Column) -> Column:
    """Characters of a named reference; NULL for no or an unknown name.

    The frequent names are a small map.  The whole table is one string literal that
    is searched: rare references cost a scan of it, and plans stay light (a map
    literal of this size is built again whenever a plan is optimised).
    """
    pairs = "\x01".join(f"{n}\x02{HTML_ENTITIES[n]}" for n in FREQUENT_ENTITIES)
    frequent = F.try_element_at(F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02")), name)
    table = F.lit("\x01" + "".join(f"{n}\x02{c}\x01" for n, c in HTML_ENTITIES.items()))
    at = F.instr(table, F.concat(F.lit("\x01"), name, F.lit("\x02")))
    rare = F.substring_index(F.substr(table, at + F.length(name) + 2, F.lit(8)), "\x01", 1)
    return F.when(name != "", F.coalesce(frequent, F.when(at > 0, rare)))


def _c1_map() -> Column:
    """Code points 128-159 read as windows-1252, as HTML tokenizers do."""
    pairs = [(c, ord(bytes([c]).decode("cp1252"))) for c in range(128, 160) if c not in (129, 141, 143, 144, 157)]
    return F.create_map(*[F.lit(x).cast("long") for kv in pairs for x in kv])


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_MEMO: dict = {}


def memo(fn):
    """Reuse the Column tree of a builder called with column *names* only.

    Building a large expression costs thousands of Python->JVM calls; a
    driver that plans the same extraction again (every streaming
    micro-batch, every run of a job) gets the finished, immutable tree
    instead.  Calls with Column arguments are built as usual.
    """
    @functools.wraps(fn)
    def wrapper(*args, **kw):
        plain = all(isinstance(a, (str, int, bool, type(None))) for a in (*args, *kw.values()))
        sc = SparkContext._active_spark_context
        if not plain or sc is None:
            return fn(*args, **kw)
        key = (fn.__qualname__, args, tuple(sorted(kw.items())), id(sc._gateway))
        col = _MEMO.get(key)
        if col is None:
            col = _MEMO[key] = fn(*args, **kw)
        return col
    return wrapper


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body(x)``.

    Catalyst inlines a Column each time it is referenced; binding through a
    one-element ``transform`` keeps the expression tree (and the work per
    row) linear when a sub-result is needed more than once.
    """
    return F.get(F.transform(F.array(value), body), 0)


# ---------------------------------------------------------------------------
# Python-compatible scalar helpers
# ---------------------------------------------------------------------------
@memo
def py_strip(c) -> Column:
    """``str.strip()``: trims every Unicode whitespace char (Spark ``trim``
    only removes spaces)."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def truthy_or(*cols, default: str = "") -> Column:
    """``a or b or default`` for strings: NULL and '' are falsy, a
    whitespace-only value is truthy (strip it afterwards, never before)."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols], F.lit(default))


def clean_field(*cols) -> Column:
    """``(a or b or "").strip()`` -- the collector's field normaliser."""
    return py_strip(truthy_or(*cols))


def nbsp_clean(c) -> Column:
    """Replace NO-BREAK SPACE by a plain space."""
    return F.replace(_c(c), F.lit("\xa0"), F.lit(" "))


def truncate(c, n: int) -> Column:
    """``s[:n]`` by code point."""
    return F.substring(_c(c), 1, n)


def starts_with_ci(c, prefix: str) -> Column:
    """``s.lower().startswith(prefix)``."""
    return F.startswith(F.lower(_c(c)), F.lit(prefix.lower()))


def line_at(c, i: int) -> Column:
    """i-th line (0-based) of a text; NULL when the text has fewer lines."""
    return F.get(F.split(_c(c), "\n", i + 2), F.lit(i))


def first_line(c) -> Column:
    return F.substring_index(_c(c), "\n", 1)


# ---------------------------------------------------------------------------
# HTML text
# ---------------------------------------------------------------------------
def _decode_piece(p: Column) -> Column:
    """Decode the text right after one '&' (single pass, no double decoding)."""
    name = F.regexp_extract(p, r"^([A-Za-z][-.A-Za-z0-9]*)", 1)
    num = F.regexp_extract(p, r"^(#(?:[0-9]+|[xX][0-9a-fA-F]+);?)", 1)

    def cp_char(digits: Column, base: Column, longest: Column) -> Column:
        """The character of a numeric reference; U+FFFD where none exists, so decoding never raises."""
        plain = F.regexp_replace(digits, "^0+", "")
        cp = F.when(F.length(plain) <= longest,
                    F.when(base == 16, F.conv(plain, 16, 10)).otherwise(F.conv(plain, 10, 10)).cast("long"))
        real = (cp > 0) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
        cp = F.coalesce(F.try_element_at(_c1_map(), cp), F.when(real, cp), F.lit(0xFFFD).cast("long"))
        return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")

    def body(r, ch):
        n, ref = r["n"], r["ref"]
        after = F.length(n) + F.lit(1)
        semi = F.when(F.substring(p, after, 1) == F.lit(";"), F.lit(1)).otherwise(F.lit(0))
        digits = F.regexp_extract(ref, r"^#[xX]?([0-9a-fA-F]+)", 1)
        is_hex = F.lower(F.substring(ref, 2, 1)) == "x"
        base = F.when(is_hex, F.lit(16)).otherwise(F.lit(10))
        longest = F.when(is_hex, F.lit(6)).otherwise(F.lit(7))
        return (F.when(ch.isNotNull(), F.concat(ch, F.substr(p, after + semi)))
                .when(ref != "", F.concat(cp_char(digits, base, longest), F.substr(p, F.length(ref) + F.lit(1))))
                .otherwise(F.concat(F.lit("&"), p)))

    return let(F.struct(name.alias("n"), num.alias("ref")), lambda r: let(_entity(r["n"]), lambda ch: body(r, ch)))


@memo
def decode_entities(c) -> Column:
    """Decode character references the way the HTML tokenizer does."""
    s = _c(c)

    def body(parts):
        tail = F.transform(F.slice(parts, 2, F.size(parts) - 1), _decode_piece)
        return F.concat(F.get(parts, 0), F.array_join(tail, ""))

    def quick(x):
        """The plainest references by replacement; an ampersand they give is held back."""
        x = F.replace(x, F.lit("&amp;"), F.lit(HELD))
        for name in PLAIN_ENTITIES:
            x = F.replace(x, F.lit(f"&{name};"), F.lit(HTML_ENTITIES[name]))
        return x

    def rest(r):
        x = r["x"]
        whole = F.when(F.instr(x, "&") == 0, x).otherwise(let(F.split(x, "&", -1), body))
        return F.when(r["held"], F.replace(whole, F.lit(HELD), F.lit("&"))).otherwise(whole)

    def decoded(x):
        plain = F.instr(x, HELD) == 0
        return F.when(F.instr(x, "&") == 0, x).otherwise(let(
            F.struct(F.when(plain, quick(x)).otherwise(x).alias("x"), plain.alias("held")), rest))

    return decoded(s) if isinstance(c, str) else let(s, decoded)


@memo
def strip_non_text(html) -> Column:
    """Replace comments/script/style by an empty tag so neighbouring text
    nodes stay separate (as in a parsed tree)."""
    return F.regexp_replace(_c(html), NON_TEXT_RE, "<x>")


@memo
def node_string(fragment, *marks: str) -> Column:
    """The text nodes of an HTML fragment in one string: each decoded, stripped, not
    empty and followed by ``NODE``; the string starts with ``NODE``.

    Tags are read once, by one replacement over the fragment.  Start and end tags
    named in ``marks`` stay as nodes of their own (see :func:`mark`).
    """
    s = F.replace(_c(fragment), F.lit(NODE), F.lit("\ufffd"))
    for name in marks:
        s = F.regexp_replace(s, rf"(?i)<(/?){name}(?:\s{ATTRS_RE}>|\s[^>]*>|/?>)", f"{NODE}{MARK}$1{name}{NODE}")
    nodes = F.split(decode_entities(F.regexp_replace(s, TAG_RE, NODE)), NODE, -1)
    kept = F.filter(F.transform(nodes, py_strip), lambda t: t != "")
    return F.concat(F.lit(NODE), F.array_join(kept, NODE), F.lit(NODE))


def mark(name: str) -> str:
    """The mark of a tag (``p``, ``/p``) with the separator behind it."""
    return f"{MARK}{name}{NODE}"


def joined_nodes(nodes, sep: str) -> Column:
    """The text of a piece of a :func:`node_string`, its nodes joined by ``sep``; marks are left out."""
    def joined(x):
        return F.replace(F.btrim(x, F.lit(NODE)), F.lit(NODE), F.lit(sep))

    def body(x):
        return F.when(F.instr(x, MARK) == 0, joined(x)).otherwise(
            joined(F.regexp_replace(x, rf"(?:\x00*+{MARK}/?+[a-z0-9]++(?:\x00|$))++", NODE)))

    return body(_c(nodes)) if isinstance(nodes, str) else let(nodes, body)


@memo
def text_nodes(fragment) -> Column:
    """Array of decoded, stripped, non-empty text nodes of an HTML fragment."""
    return F.filter(F.split(node_string(fragment), r"\x00", -1), lambda t: t != "")


@memo
def html_text(fragment, sep: str = " ") -> Column:
    """``get_text(sep, strip=True)`` of a fragment already cleaned by
    :func:`strip_non_text`."""
    return joined_nodes(node_string(fragment), sep)
