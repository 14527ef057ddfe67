"""URL / key Column builders: RFC 3986 resolution, protocol fix, uid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.text import _c, let, memo, py_strip

SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
# Schemes whose references resolve relative to a base
# (Python's urllib.parse.uses_relative).
USES_RELATIVE = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp",
                 "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")


@memo
def make_uid(link, title) -> Column:
    """md5 hex of ``(link or '') + '|' + (title or '')``.

    ``concat_ws`` would skip NULLs and lose the bar, so plain ``concat``
    over coalesced parts is used.
    """
    return F.md5(F.concat(F.coalesce(_c(link), F.lit("")), F.lit("|"),
                          F.coalesce(_c(title), F.lit(""))))


@memo
def url_authority(url) -> Column:
    """``urlparse(url).netloc`` ('' when there is none); never fails on
    non-ASCII or malformed input, unlike a full URI parse."""
    return F.regexp_extract(F.coalesce(_c(url), F.lit("")), AUTHORITY_RE, 1)


@memo
def url_host(url) -> Column:
    """Host of a URL in lower case, without user and port ('' when there is none)."""
    host = F.regexp_replace(F.regexp_replace(url_authority(url), "^.*@", ""), r":[0-9]*$", "")
    return F.rtrim(F.lower(host), F.lit("."))


@memo
def url_path(url) -> Column:
    """Path of a URL, without query and fragment."""
    return F.regexp_extract(F.coalesce(_c(url), F.lit("")), PATH_RE, 1)


def source_name(feed_title, feed_url) -> Column:
    """Feed title stripped, else the URL's netloc with every 'www.' removed."""
    t = _c(feed_title)
    return (F.when(F.coalesce(t, F.lit("")) != "", py_strip(t))
            .otherwise(F.replace(url_authority(feed_url), F.lit("www."), F.lit(""))))


@memo
def fix_protocol(src) -> Column:
    """strip; '' stays ''; ``//x`` -> ``https://x``; anything else unchanged."""
    s = py_strip(F.coalesce(_c(src), F.lit("")))
    return F.when(F.startswith(s, F.lit("//")), F.concat(F.lit("https:"), s)).otherwise(s)


def _remove_dots(segments: Column) -> Column:
    """RFC 3986 dot-segment removal over a split path (as ``urljoin`` does)."""
    def body(segs):
        resolved = F.aggregate(
            segs, F.array().cast("array<string>"),
            lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
            .when(x == ".", acc)
            .otherwise(F.concat(acc, F.array(x))))
        resolved = F.when(F.element_at(segs, -1).isin(".", ".."),
                          F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
        return let(F.array_join(resolved, "/"), lambda j: (
            F.when(j == "", F.lit("/")).when(F.startswith(j, F.lit("/")), j)
            .otherwise(F.concat(F.lit("/"), j))))
    return let(segments, body)


def _merge(b_path: Column, h_path: Column) -> Column:
    """Base directory + relative path, empty middle segments dropped."""
    def with_dir(b_split):
        b_dir = F.when(F.element_at(b_split, -1) != "",
                       F.slice(b_split, 1, F.greatest(F.size(b_split) - 1, F.lit(0)))
                       ).otherwise(b_split)
        return F.concat(b_dir, F.split(h_path, "/", -1))

    def squeeze(m):
        n = F.size(m)
        return F.when(n >= 2, F.concat(
            F.slice(m, 1, 1),
            F.filter(F.slice(m, 2, F.greatest(n - 2, F.lit(0))), lambda x: x != ""),
            F.slice(m, n, 1))).otherwise(m)

    return let(let(F.split(b_path, "/", -1), with_dir), squeeze)


@memo
def url_resolve(base, href) -> Column:
    """``urllib.parse.urljoin(base, href)`` for http(s)-style bases.

    Each input and each parsed part is bound once (see ``let``), so the
    expression stays small even when ``href`` is itself an expression.
    """
    def parse(bh):
        b, h0 = bh["b"], bh["h"]
        scheme = F.lower(F.regexp_extract(b, SCHEME_RE, 1))
        h_scheme = F.lower(F.regexp_extract(h0, SCHEME_RE, 1))
        # a reference with the base's (relative-capable) scheme resolves as
        # if it had none; any other scheme is returned unchanged
        same = (h_scheme != "") & (h_scheme == scheme) & h_scheme.isin(*USES_RELATIVE)
        h = F.when(same, F.substr(h0, F.length(h_scheme) + F.lit(2))).otherwise(h0)
        return F.struct(
            b.alias("b"), h0.alias("h0"), h.alias("h"), scheme.alias("scheme"),
            ((h_scheme != "") & ~same).alias("other_scheme"),
            b.rlike(AUTHORITY_RE).alias("has_auth"),
            F.regexp_extract(b, AUTHORITY_RE, 1).alias("auth"),
            F.regexp_extract(b, PATH_RE, 1).alias("b_path"),
            F.regexp_extract(b, r"^[^?#]*\?([^#]*)", 1).alias("b_query"),
            F.regexp_extract(h, r"^([^?#]*)", 1).alias("h_path"),
            F.regexp_extract(h, r"^[^?#]*\?([^#]*)", 1).alias("h_query"),
            F.regexp_extract(h, r"(?s)^[^#]*#(.*)$", 1).alias("h_frag"))

    def resolve(p):
        b, h, scheme = p["b"], p["h"], p["scheme"]
        scheme_part = F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit(""))
        prefix = F.concat(scheme_part, F.when(p["has_auth"], F.concat(F.lit("//"), p["auth"]))
                          .otherwise(F.lit("")))
        h_path = p["h_path"]
        path = (F.when(h_path == "", p["b_path"])
                .when(F.startswith(h_path, F.lit("/")), _remove_dots(F.split(h_path, "/", -1)))
                .otherwise(_remove_dots(_merge(p["b_path"], h_path))))
        query = F.when(h_path == "", F.when(p["h_query"] != "", p["h_query"])
                       .otherwise(p["b_query"])).otherwise(p["h_query"])
        joined = F.concat(prefix, path,
                          F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
                          F.when(p["h_frag"] != "", F.concat(F.lit("#"), p["h_frag"]))
                          .otherwise(F.lit("")))
        return (F.when(p["h0"] == "", b)
                .when(p["other_scheme"], p["h0"])
                .when(F.startswith(h, F.lit("//")), F.concat(scheme_part, h))
                .otherwise(joined))

    bh = F.struct(F.coalesce(_c(base), F.lit("")).alias("b"),
                  F.coalesce(_c(href), F.lit("")).alias("h"))
    return let(let(bh, parse), resolve)
