"""DuckDB oracle SQL for the registered queries (checked side by side with
the Spark result).  Written as plain SQL over the pre-registered tables; the
helpers below only assemble repeated fragments.  Pure strings: no DuckDB
import here.
"""

from __future__ import annotations

def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The characters Python's str.strip removes, and the named
# references that the given tables hold.
STRIPPED = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "\u00a9",
         "reg": "\u00ae", "middot": "\u00b7", "bull": "\u2022", "trade": "\u2122", "euro": "\u20ac", "laquo": "\u00ab", "raquo": "\u00bb",
         "hellip": "\u2026", "ndash": "\u2013", "mdash": "\u2014", "rsquo": "\u2019", "lsquo": "\u2018",
         "ldquo": "\u201c", "rdquo": "\u201d"}
# Schemes whose references resolve against a base of the same scheme.
RELATIVE_SCHEMES = ["", "file", "ftp", "gopher", "http", "https", "imap", "mms", "nntp", "prospero", "rtsp", "rtsps",
                    "rtspu", "sftp", "shttp", "svn", "svn+ssh", "wais", "ws", "wss"]
WS = q("".join(map(chr, STRIPPED)))
# RE2 class equal to Python's whitespace set
WS_RE = r"[\t\n\x0b\x0c\r\x1c-\x1f\x{85}\p{Z}]"
NON_TEXT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAG = r"</?[A-Za-z][^>]*>|<![^>]*>|<\?[^>]*>"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def decode(x: str) -> str:
    names = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in NAMED.items())
    piece = (
        "CASE WHEN r.c IS NOT NULL THEN r.c || substr(r.p, length(r.n) + 1 + "
        "CASE WHEN substr(r.p, length(r.n) + 1, 1) = ';' THEN 1 ELSE 0 END) "
        "WHEN regexp_matches(r.p, '^#[0-9]{1,7}') THEN "
        "chr(CAST(regexp_extract(r.p, '^#([0-9]{1,7})', 1) AS INTEGER)) || "
        "substr(r.p, length(regexp_extract(r.p, '^(#[0-9]{1,7};?)', 1)) + 1) "
        "WHEN regexp_matches(r.p, '^#[xX][0-9a-fA-F]{1,6}') THEN "
        "chr(CAST('0x' || regexp_extract(r.p, '^#[xX]([0-9a-fA-F]{1,6})', 1) AS INTEGER)) || "
        "substr(r.p, length(regexp_extract(r.p, '^(#[xX][0-9a-fA-F]{1,6};?)', 1)) + 1) "
        "ELSE '&' || r.p END")
    rows = (f"list_transform(string_split({x}, '&')[2:], lambda p: "
            f"{{'p': p, 'n': regexp_extract(p, '^([A-Za-z][-.A-Za-z0-9]*)', 1), "
            f"'c': CASE regexp_extract(p, '^([A-Za-z][-.A-Za-z0-9]*)', 1) {names} END}})")
    return (f"(CASE WHEN strpos({x}, '&') = 0 THEN {x} ELSE string_split({x}, '&')[1] || "
            f"array_to_string(list_transform({rows}, lambda r: {piece}), '') END)")


def nodes(frag: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({frag}, {q(TAG)}), "
            f"lambda n: {strip(decode('n'))}), lambda t: t <> '')")


def html_text(frag: str, sep: str) -> str:
    return f"array_to_string({nodes(frag)}, {q(sep)})"


def clean(html: str) -> str:
    return f"regexp_replace({html}, {q(NON_TEXT)}, '<x>', 'g')"


def start_tag(tag: str) -> str:
    return rf"<{tag}(?:\s[^>]*)?/?>"


def has_tag(c: str, tag: str) -> str:
    return f"regexp_matches({c}, {q('(?i)' + start_tag(tag))})"


def inner(c: str, tag: str) -> str:
    return f"regexp_extract({c}, {q(rf'(?is){start_tag(tag)}(.*?)(?:</{tag}\s*>|$)')}, 1)"


def title_expr(c: str, sep: str) -> str:
    return (f"CASE WHEN {has_tag(c, 'h1')} THEN {html_text(inner(c, 'h1'), sep)} "
            f"WHEN {has_tag(c, 'title')} THEN {html_text(inner(c, 'title'), sep)} END")


def block_expr(c: str) -> str:
    return f"CASE WHEN {has_tag(c, 'article')} THEN {inner(c, 'article')} ELSE {c} END"


def paragraphs(parts: str) -> str:
    """Kept paragraph texts (nested rule, empty and ad paragraphs dropped)."""
    seg_text = (
        f"CASE WHEN regexp_matches(seg, '(?i)</p\\s*>') THEN "
        f"regexp_split_to_array(seg, '(?i)</p\\s*>')[1] "
        f"ELSE array_to_string(list_slice({parts}, i + 1, len({parts})), '<p>') END")
    raw = f"list_transform({parts}[2:], lambda seg, i: {html_text(seg_text, ' ')})"
    return (f"list_filter({raw}, lambda t: t <> '' AND NOT starts_with(lower(t), 'advertisement'))")


P_OPEN = r"(?i)<p(?:\s[^>]*)?/?>"


def authority(u: str) -> str:
    return f"regexp_extract(coalesce({u}, ''), '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)"


ANCHOR = r"(?is)<a(?:\s[^>]*)?>.*?(?:</a\s*>|$)"


def attr(tag: str, name: str) -> str:
    pat = q(rf"""(?is)^<[A-Za-z0-9]+\s(?:[^>]*?\s)?{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
    v = (f"(regexp_extract({tag}, {pat}, 1) || regexp_extract({tag}, {pat}, 2) || "
         f"regexp_extract({tag}, {pat}, 3))")
    return decode(v)


def _url_join_body(b: str, h0: str) -> str:
    scheme = f"lower(regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1))"
    hscheme = f"lower(regexp_extract({h0}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1))"
    rel = ", ".join(q(x) for x in RELATIVE_SCHEMES)
    same = f"({hscheme} <> '' AND {hscheme} = {scheme} AND {hscheme} IN ({rel}))"
    h = "uj.h"
    prefix = (f"(CASE WHEN {scheme} <> '' THEN {scheme} || ':' ELSE '' END || "
              f"CASE WHEN regexp_matches({b}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//') "
              f"THEN '//' || {authority(b)} ELSE '' END)")
    bpath = f"regexp_extract({b}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    bquery = f"regexp_extract({b}, '^[^?#]*\\?([^#]*)', 1)"
    hpath = f"regexp_extract({h}, '^([^?#]*)', 1)"
    hquery = f"regexp_extract({h}, '^[^?#]*\\?([^#]*)', 1)"
    hfrag = f"regexp_extract({h}, '(?s)^[^#]*#(.*)$', 1)"
    bdir = (f"(CASE WHEN string_split({bpath}, '/')[-1] <> '' THEN "
            f"string_split({bpath}, '/')[1:len(string_split({bpath}, '/')) - 1] "
            f"ELSE string_split({bpath}, '/') END)")
    merged = f"list_concat({bdir}, string_split({hpath}, '/'))"
    merged_f = (f"(CASE WHEN len({merged}) >= 2 THEN list_concat(list_concat({merged}[1:1], "
                f"list_filter({merged}[2:len({merged}) - 1], lambda x: x <> '')), "
                f"{merged}[len({merged}):len({merged})]) ELSE {merged} END)")

    def dots(segs: str) -> str:
        red = (f"list_reduce(list_prepend([]::VARCHAR[], list_transform({segs}, lambda s: [s])), "
               f"lambda acc, s: CASE WHEN s[1] = '..' THEN acc[1:len(acc) - 1] "
               f"WHEN s[1] = '.' THEN acc ELSE list_concat(acc, s) END)")
        fin = (f"CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({red}, '') ELSE {red} END")
        j = f"array_to_string({fin}, '/')"
        return (f"(CASE WHEN {j} = '' THEN '/' WHEN starts_with({j}, '/') THEN {j} "
                f"ELSE '/' || {j} END)")

    path = (f"(CASE WHEN {hpath} = '' THEN {bpath} WHEN starts_with({hpath}, '/') THEN "
            f"{dots(f'string_split({hpath}, {q(chr(47))})')} ELSE {dots(merged_f)} END)")
    query = (f"(CASE WHEN {hpath} = '' THEN (CASE WHEN {hquery} <> '' THEN {hquery} "
             f"ELSE {bquery} END) ELSE {hquery} END)")
    joined = (f"{prefix} || {path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END "
              f"|| CASE WHEN {hfrag} <> '' THEN '#' || {hfrag} ELSE '' END")
    inner = (f"(CASE WHEN {h0} = '' THEN {b} "
            f"WHEN {hscheme} <> '' AND NOT {same} THEN {h0} "
            f"WHEN starts_with({h}, '//') THEN (CASE WHEN {scheme} <> '' THEN {scheme} || ':' "
            f"ELSE '' END) || {h} ELSE {joined} END)")
    hval = f"(CASE WHEN {same} THEN substr({h0}, length({hscheme}) + 2) ELSE {h0} END)"
    return f"list_transform([{{'h': {hval}}}], lambda uj: {inner})[1]"


def url_join(b: str, h0: str) -> str:
    """urljoin for http(s) bases (general shapes), written in SQL; inputs
    and the scheme-stripped reference are bound once (lambda over a
    one-element list) so the text stays linear."""
    return (f"list_transform([{{'b': {b}, 'h0': {h0}}}], "
            f"lambda ub: {_url_join_body('ub.b', 'ub.h0')})[1]")


# ---------------------------------------------------------------------------
# shared CTEs over documents / events / labels
# ---------------------------------------------------------------------------
def render(ts: str, kind: str) -> str:
    return (f"CASE WHEN {kind} = 'view' THEN strftime({ts}, '%Y-%m-%d %H:%M:%S') "
            f"WHEN {kind} = 'signup' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '+05:30' "
            f"WHEN {kind} = 'click' THEN strftime({ts}, '%B %-d, %Y %-I:%M ') || "
            f"lower(strftime({ts}, '%p')) "
            f"WHEN {kind} = 'purchase' THEN strftime({ts}, '%b %-d, %Y') ELSE '' END")


def parse(p: str) -> str:
    iso_off = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d[+-]\d\d:\d\d$"
    s = f"nullif({strip(p)}, '')"
    return (f"coalesce(try_strptime({s}, '%Y-%m-%d %H:%M:%S'), "
            f"CASE WHEN regexp_matches({s}, {q(iso_off)}) THEN "
            f"try_strptime(substr({s}, 1, 19), '%Y-%m-%dT%H:%M:%S') - "
            f"(CASE WHEN substr({s}, 20, 1) = '-' THEN -1 ELSE 1 END) * "
            f"(CAST(substr({s}, 21, 2) AS INTEGER) * INTERVAL 1 HOUR + "
            f"CAST(substr({s}, 24, 2) AS INTEGER) * INTERVAL 1 MINUTE) END, "
            f"try_strptime({s}, '%B %-d, %Y %-I:%M %p'), try_strptime({s}, '%b %-d, %Y'), "
            f"try_strptime({s}, '%d-%m-%Y'))")


def iso(ts: str) -> str:
    return f"coalesce(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '+0000', '')"


def line2(t: str) -> str:
    return f"CASE WHEN strpos({t}, chr(10)) > 0 THEN split_part({t}, chr(10), 2) END"


PUB = f"""pub AS (SELECT event_id AS doc_id, {render('ts', 'event_type')} AS published_src FROM events)"""

ITEMS = f"""{PUB},
items0 AS (
  SELECT d.doc_id, d.source, 'https://' || d.source || '.example.org/feed' AS feed_url,
         {strip("split_part(d.text, chr(10), 1)")} AS title,
         {strip(f"coalesce({line2('d.text')}, '')")} AS summary_raw,
         {strip('d.text')} AS full_text,
         'https://' || d.source || '.example.org/' AS link,
         {strip("coalesce(pub.published_src, '')")} AS published,
         '' AS media_url, 'raw' AS status
  FROM documents d LEFT JOIN pub ON pub.doc_id = d.doc_id),
items AS (
  SELECT *, md5(link || '|' || title) AS uid, {parse('published')} AS published_dt
  FROM items0),
items1 AS (
  SELECT *, {iso('published_dt')} AS published_dt_str FROM items),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid
        ORDER BY published_dt DESC NULLS LAST, doc_id) AS rn FROM items1) WHERE rn = 1)"""

STORE = ITEMS + """,
lbest AS (
  SELECT * FROM (SELECT i.*, l.quality, l.toxic, row_number() OVER (PARTITION BY i.uid
        ORDER BY i.published_dt DESC NULLS LAST, i.doc_id) AS rn2
     FROM items1 i JOIN labels l ON l.doc_id = i.doc_id) WHERE rn2 = 1),
store AS (
  SELECT uid, title, summary_raw AS raw_summary, full_text, link AS url, source, feed_url,
         media_url, published AS published_raw, published_dt_str AS published_at,
         CASE WHEN quality = 1 THEN 'raw' WHEN toxic = 1 THEN 'ready' ELSE 'error' END AS status,
         CAST(NULL AS VARCHAR) AS problem
  FROM lbest)"""


# Prompts, written out here and not taken from the library.
P1 = """'TASK: headline digest of one news item.' || chr(10) ||
  'LIMITS: single line; 120 characters at most; language of the title; plain text; given facts only.' || chr(10) || chr(10) ||
  'Title: ' || coalesce(title, '') || chr(10) || 'Summary: ' || coalesce(raw_summary, '') || chr(10)"""
P2 = """'TASK: channel post about one news item.' || chr(10) ||
  'LIMITS: two or three lines, the first like a headline and the last leading to the link; ' ||
  'no more than two emoji; link kept verbatim; given facts only. Source and link follow separately.' || chr(10) || chr(10) ||
  'Title: ' || coalesce(title, '') || chr(10) || 'Summary: ' || coalesce(raw_summary, '') || chr(10) ||
  'Source: ' || coalesce(source, '') || chr(10) || 'Link: ' || coalesce(url, '') || chr(10)"""
P3 = """'TASK: picture caption about one news item.' || chr(10) ||
  'LIMITS: three to six lines; three to six emoji; five to seven hashtags at the end; the source named in passing.' || chr(10) || chr(10) ||
  'Title: ' || coalesce(title, '') || chr(10) || 'Summary: ' || coalesce(raw_summary, '') || chr(10) ||
  'Source: ' || coalesce(source, '') || chr(10)"""
ROW_LIMIT = 16384
ROW_BYTES = " + ".join(f"coalesce(strlen({c}), 0)" for c in (
    "uid", "title", "raw_summary", "full_text", "url", "source", "feed_url", "media_url", "published_raw", "published_at"))


ALL_RAW = ITEMS + """,
store AS (
  SELECT uid, title, summary_raw AS raw_summary, full_text, link AS url, source, feed_url,
         media_url, published AS published_raw, published_dt_str AS published_at, 'raw' AS status,
         CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'title must be text, got bigint' END AS problem
  FROM best)"""

ANSWERED = f""",
raw AS (SELECT * FROM store WHERE status = 'raw'),
pr AS (
  SELECT uid, title, source, url, problem, {ROW_BYTES} AS row_bytes,
         {P1} AS p1, {P2} AS p2, {P3} AS p3
  FROM raw),
ans AS (
  SELECT *,
    CASE WHEN substr(md5(p1), 1, 1) = 'f' THEN 'P' WHEN substr(md5(p1), 1, 1) = 'e' THEN 'M'
         WHEN strpos(p1, chr(10) || 'Summary: ' || chr(10)) > 0 THEN 'E' END AS f1,
    CASE WHEN substr(md5(p2), 1, 1) = 'f' THEN 'P' WHEN substr(md5(p2), 1, 1) = 'e' THEN 'M' END AS f2,
    CASE WHEN substr(md5(p3), 1, 1) = 'f' THEN 'P' WHEN substr(md5(p3), 1, 1) = 'e' THEN 'M' END AS f3,
    '[one_line] ' || substr(md5(p1), 1, 16) AS a1,
    '[telegram] ' || substr(md5(p2), 1, 16) ||
      CASE WHEN substr(md5(p2), 1, 1) IN ('0','1','2','3','4','5','6','7')
           THEN ' ' || regexp_extract(p2, '\\nSource: ([^\\n]*)', 1) ELSE '' END AS a2,
    '[instagram] ' || substr(md5(p3), 1, 16) AS a3
  FROM pr),
fst AS (SELECT *, coalesce(f1, f2, f3) AS ff FROM ans),
made AS (
  SELECT uid, ff, problem, row_bytes,
    CASE WHEN ff IS NULL THEN substr({strip('a1')}, 1, 140)
         ELSE substr(coalesce(title, ''), 1, 120) END AS summary,
    CASE WHEN ff IS NULL THEN concat_ws(chr(10), a2,
           CASE WHEN coalesce(source, '') <> '' AND strpos(a2, source) = 0
                THEN 'সূত্র: ' || source END,
           CASE WHEN coalesce(url, '') <> '' AND strpos(a2, url) = 0 THEN url END)
         ELSE '📰 ' || coalesce(title, '') || chr(10) || chr(10) || '🔗 ' || coalesce(url, '') END
      AS caption_telegram,
    CASE WHEN ff IS NULL THEN a3
         ELSE '🎬 ' || coalesce(title, '') || chr(10) || chr(10) || 'Source: ' || coalesce(source, '')
    END AS caption_instagram
  FROM fst),
sized AS (SELECT *, row_bytes + strlen(summary) + strlen(caption_telegram) + strlen(caption_instagram) AS size FROM made),
judged AS (SELECT *, coalesce(problem, CASE WHEN size > {ROW_LIMIT} THEN 'row of ' || size || ' bytes; the store takes {ROW_LIMIT}' END) AS wrong
  FROM sized),
patch AS (
  SELECT uid, CASE WHEN wrong IS NULL THEN summary END AS summary,
    CASE WHEN wrong IS NULL THEN caption_telegram END AS caption_telegram,
    CASE WHEN wrong IS NULL THEN caption_instagram END AS caption_instagram,
    CASE WHEN wrong IS NULL THEN 'ready' ELSE 'error' END AS status,
    CASE WHEN wrong IS NULL THEN CASE WHEN ff IS NULL THEN 'gemini' ELSE 'fallback' END END AS ai_mode,
    CASE WHEN wrong IS NULL THEN CASE WHEN ff = 'M' THEN 'stub model: refused' WHEN ff = 'E' THEN 'Empty model response'
         WHEN ff = 'P' THEN 'answer must be text, got int' END END AS gemini_error,
    wrong AS processing_error,
    '2025-01-01 00:00:00' AS processed_at
  FROM judged),
patched AS (
  SELECT s.uid, s.title, coalesce(p.status, s.status) AS status, p.ai_mode, p.summary,
         p.caption_telegram, p.caption_instagram, p.gemini_error, p.processing_error,
         p.processed_at, s.status AS status_before
  FROM store s LEFT JOIN patch p ON p.uid = s.uid)"""
ENRICH = STORE + ANSWERED

PAGES_CLEAN = f"""pc AS (SELECT page_id, url, {clean('html')} AS clean FROM pages)"""

LINKS = PAGES_CLEAN + f""",
an AS (SELECT page_id, url, regexp_extract_all(clean, {q(ANCHOR)}, 0) AS anchors FROM pc),
ax AS (SELECT page_id, url, len(anchors) AS n_links, unnest(anchors) AS anchor,
              generate_subscripts(anchors, 1) - 1 AS pos FROM an),
lk AS (SELECT page_id, url, pos, n_links,
              {html_text(f"regexp_extract(anchor, {q(r'(?is)^<a[^>]*>(.*?)(?:</a\s*>)?$')}, 1)", '')} AS text,
              {attr(f"regexp_extract(anchor, {q(r'(?is)^(<a[^>]*>)')}, 1)", 'href')} AS href
       FROM ax),
links AS (SELECT page_id, url, CAST(pos AS BIGINT) AS pos, CAST(n_links AS BIGINT) AS n_links,
                 text, href, {url_join('url', strip('href'))} AS article_url FROM lk)"""


def _sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["page_scan"] = f"""SELECT page_id, url, {authority('url')} AS host,
        CAST(length(html) AS BIGINT) AS html_chars FROM pages"""
    s["store_raw_scan"] = f"""WITH {STORE} SELECT uid, title, url, status FROM store
        WHERE status = 'raw'"""
    s["page_title"] = f"""WITH {PAGES_CLEAN} SELECT page_id, {title_expr('clean', '')} AS title FROM pc"""
    s["text_nodes"] = f"""WITH {PAGES_CLEAN}, n AS (SELECT page_id, {nodes('clean')} AS nodes FROM pc)
        SELECT page_id, CAST(len(nodes) AS BIGINT) AS n_nodes, array_to_string(nodes, '') AS text_joined,
        array_to_string(nodes, ' ') AS text_spaced, array_to_string(nodes, chr(10)) AS text_lines FROM n"""
    para_cte = f"""{PAGES_CLEAN},
        pp AS (SELECT page_id, url, clean, regexp_split_to_array({block_expr('clean')}, {q(P_OPEN)}) AS parts FROM pc),
        pa AS (SELECT page_id, url, clean, {paragraphs('parts')} AS paras FROM pp)"""
    s["article_paragraphs"] = f"""WITH {para_cte},
        x AS (SELECT page_id, unnest(paras) AS text, generate_subscripts(paras, 1) - 1 AS pos FROM pa)
        SELECT page_id, CAST(pos AS BIGINT) AS pos, text FROM x"""
    pub_re = q(f"Published:{WS_RE}*([^\\n]+)")
    auth_re = q(f"([^\\n]+?){WS_RE}*\\|{WS_RE}*[^\\n]*\\n{WS_RE}*Published:")
    img_tag = f"regexp_extract(clean, {q(r'(?is)(<img(?:\s[^>]*)?>)')}, 1)"
    img_src = f"coalesce(nullif({attr('img', 'src')}, ''), nullif({attr('img', 'data-src')}, ''))"
    s["article_extract"] = f"""WITH {para_cte},
        t AS (SELECT page_id, url, clean, paras, {html_text('clean', chr(10))} AS page_text,
                     {img_tag} AS img FROM pa)
        SELECT page_id, url, {title_expr('clean', '')} AS article_title,
          paras[1] AS short_description,
          CASE WHEN {img_src} IS NOT NULL THEN {url_join('url', strip(img_src))} END AS article_image_url,
          CASE WHEN regexp_matches(page_text, {auth_re}) THEN {strip(f'regexp_extract(page_text, {auth_re}, 1)')} END AS author,
          CASE WHEN regexp_matches(page_text, {pub_re}) THEN {strip(f'regexp_extract(page_text, {pub_re}, 1)')} END AS date,
          CASE WHEN len(paras) > 0 THEN array_to_string(paras, chr(10) || chr(10)) END AS full_text
        FROM t"""
    s["page_links"] = f"""WITH {LINKS} SELECT page_id, pos, n_links, text, href, article_url FROM links"""
    s["card_position"] = f"""WITH {LINKS} SELECT page_id, pos, n_links,
        CAST(pos + 1 AS VARCHAR) || '/' || CAST(n_links AS VARCHAR) AS progress FROM links"""
    s["listing_dedup"] = f"""WITH {LINKS},
        rep AS (SELECT page_id, pos, article_url FROM links
                UNION ALL SELECT page_id, pos + n_links, article_url FROM links)
        SELECT page_id, pos, article_url FROM (SELECT *, row_number() OVER
          (PARTITION BY page_id, article_url ORDER BY pos) AS rn FROM rep) WHERE rn = 1"""
    tail = "regexp_replace(href, '^/+', '')"
    shapes = [("root", "href"), ("relative", tail), ("parent", f"'../' || {tail}"),
              ("dots", f"'./a/../' || {tail} || '/.'"),
              ("netloc", f"'//cdn.' || {authority('url')} || href"),
              ("query", f"'?q=' || {tail}"), ("fragment", f"'#' || {tail}"), ("empty", "''"),
              ("scheme", f"'mailto:' || {tail}")]
    union = " UNION ALL ".join(f"SELECT page_id, pos, url, {q(n)} AS shape, {e} AS h FROM links"
                               for n, e in shapes)
    s["url_resolve"] = f"""WITH {LINKS}, sh AS ({union})
        SELECT page_id, pos, shape, h AS href, {url_join('url', 'h')} AS resolved FROM sh"""
    s["source_name"] = f"""WITH {PAGES_CLEAN},
        t AS (SELECT page_id, url, CASE WHEN strpos(url, '?') > 0 THEN {title_expr('clean', ' ')} END AS ft FROM pc)
        SELECT page_id, CASE WHEN coalesce(ft, '') <> '' THEN {strip('ft')}
          ELSE replace({authority('url')}, 'www.', '') END AS source_name FROM t"""
    fixv = [f"'//img.' || {authority('article_url')} || href", "' ' || article_url || ' '",
            f"chr(160) || '//' || {authority('article_url')} || '/'", "'  '"]
    funion = " UNION ALL ".join(f"SELECT page_id, pos, CAST({i} AS BIGINT) AS variant, {e} AS src FROM links"
                                for i, e in enumerate(fixv))
    s["fix_protocol"] = f"""WITH {LINKS}, v AS ({funion})
        SELECT page_id, pos, variant, src,
          CASE WHEN starts_with({strip('src')}, '//') THEN 'https:' || {strip('src')} ELSE {strip('src')} END AS fixed
        FROM v"""
    s["byline_extract"] = f"""WITH {PUB},
        t AS (SELECT d.doc_id, split_part(d.text, chr(10), 1) || chr(10) || d.source || ' | ' || upper(d.lang)
                || chr(10) || 'Published: ' || coalesce(pub.published_src, '') || chr(10) ||
                CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, strpos(d.text, chr(10)) + 1)
                  ELSE '' END AS t
              FROM documents d LEFT JOIN pub ON pub.doc_id = d.doc_id)
        SELECT doc_id,
          CASE WHEN regexp_matches(t, {auth_re}) THEN {strip(f'regexp_extract(t, {auth_re}, 1)')} END AS author,
          CASE WHEN regexp_matches(t, {pub_re}) THEN {strip(f'regexp_extract(t, {pub_re}, 1)')} END AS date
        FROM t"""
    s["ad_filter"] = f"""WITH d AS (
          SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN list_concat(list_concat(
              string_split(d.text, chr(10))[1:1], ['ADVERTISEMENT - ' || d.source]),
              string_split(d.text, chr(10))[2:]) ELSE string_split(d.text, chr(10)) END AS lines
          FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
        x AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS pos FROM d)
        SELECT doc_id, CAST(pos AS BIGINT) AS pos, {strip('line')} <> '' AS kept_plain,
          ({strip('line')} <> '' AND NOT starts_with(lower({strip('line')}), 'advertisement')) AS kept_ads_rule
        FROM x"""
    pad = ("CASE WHEN lang = 'en' THEN chr(160) || ' ' || chr(9) WHEN lang = 'fr' THEN chr(12288) || chr(8232) "
           "WHEN lang = 'de' THEN chr(28) || chr(133) || chr(8201) ELSE '' END")
    s["py_strip"] = f"""WITH t AS (SELECT doc_id, ({pad}) || text || ({pad}) AS s FROM documents)
        SELECT doc_id, {strip('s')} AS stripped, CAST(length({strip('s')}) AS BIGINT) AS n_chars FROM t"""
    s["nbsp_clean"] = """SELECT doc_id, replace(replace(text, ' ', chr(160)), chr(160), ' ')
        AS cleaned FROM documents"""
    s["make_uid"] = f"WITH {ITEMS} SELECT doc_id, link, title, uid FROM items1"
    s["truncate_title"] = f"""WITH {ITEMS} SELECT doc_id, substr(title, 1, 120) AS t120,
        substr(title, 1, 140) AS t140 FROM items1"""
    s["fallback_captions"] = f"""WITH {ALL_RAW} SELECT uid, substr(coalesce(title, ''), 1, 120) AS summary,
        '📰 ' || coalesce(title, '') || chr(10) || chr(10) || '🔗 ' || coalesce(url, '') AS caption_telegram,
        '🎬 ' || coalesce(title, '') || chr(10) || chr(10) || 'Source: ' || coalesce(source, '') AS caption_instagram
        FROM store"""
    s["build_prompts"] = f"""WITH {ALL_RAW} SELECT uid, {P1} AS prompt_one_line, {P2} AS prompt_telegram, {P3} AS prompt_instagram FROM store"""
    s["oneliner_finalize"] = f"""WITH {ITEMS} SELECT doc_id,
        substr({strip("'  ' || title || ' ' || summary_raw || chr(10)")}, 1, 140) AS summary FROM items1"""
    body = ("CASE WHEN d.lang = 'en' THEN i.title || ' - ' || i.source WHEN d.lang = 'fr' THEN "
            "i.title || chr(10) || i.link ELSE ' ' || i.title || ' ' END")
    s["telegram_finalize"] = f"""WITH {ITEMS}, b AS (SELECT i.doc_id, i.source, i.link,
          {strip(body)} AS body FROM items1 i JOIN documents d ON d.doc_id = i.doc_id)
        SELECT doc_id, concat_ws(chr(10), body,
          CASE WHEN coalesce(source, '') <> '' AND strpos(body, source) = 0 THEN 'সূত্র: ' || source END,
          CASE WHEN coalesce(link, '') <> '' AND strpos(body, link) = 0 THEN link END) AS caption FROM b"""
    cards_arts = f"""{PUB},
        cards AS (SELECT doc_id, split_part(text, chr(10), 1) AS title,
            'https://news.example.org/doc/' || doc_id AS article_url,
            'https://img.example.org/card/' || doc_id || '.jpg' AS card_image_url,
            {line2('text')} AS listing_subheadline FROM documents),
        arts AS (SELECT 'https://news.example.org/doc/' || d.doc_id AS url,
            CASE WHEN l.quality = 1 THEN split_part(d.text, chr(10), 1) ELSE '' END AS article_title,
            CASE WHEN l.quality = 1 THEN {line2('d.text')} END AS short_description,
            CASE WHEN l.toxic = 0 THEN 'https://img.example.org/art/' || d.doc_id || '.jpg' ELSE '' END AS article_image_url,
            pub.published_src AS date, d.text AS full_text
          FROM documents d JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN pub ON pub.doc_id = d.doc_id),
        j AS (SELECT c.*, a.url AS a_url, a.article_title, a.short_description, a.article_image_url,
            a.date, a.full_text FROM cards c LEFT JOIN arts a ON a.url = c.article_url
          WHERE coalesce(c.article_url, '') <> '')"""
    s["card_article_join"] = f"""WITH {cards_arts} SELECT doc_id, article_url, a_url IS NOT NULL AS matched,
        article_title, date FROM j"""

    def cf(*cols):
        return strip("coalesce(" + ", ".join(f"nullif({c}, '')" for c in cols) + ", '')")
    s["normalize_items"] = f"""WITH {cards_arts},
        n AS (SELECT doc_id, {cf('article_title', 'title')} AS title, {cf('article_url')} AS link,
            {cf('short_description', 'listing_subheadline')} AS summary_raw,
            {cf('article_image_url', 'card_image_url')} AS media_url, {cf('date')} AS published,
            {cf('full_text')} AS full_text FROM j)
        SELECT doc_id, md5(link || '|' || title) AS uid, title, link, summary_raw, media_url, published,
          sha256(full_text) AS full_text_sha, 'Eisamay Entertainment' AS source, 'raw' AS status FROM n"""
    s["truthy_coalesce"] = f"""WITH {cards_arts} SELECT doc_id,
        {cf('article_image_url', 'card_image_url')} AS media_url, {cf('short_description')} AS summary_plain,
        {cf('short_description', 'listing_subheadline')} AS summary_with_listing FROM j"""
    uparts = []
    for kind, extra in (("view", "user_id"), ("click", "props"), ("signup", None),
                        ("purchase", "user_id"), ("error", "props")):
        uid_col = "user_id" if extra == "user_id" else "CAST(NULL AS BIGINT) AS user_id"
        props = "props" if extra == "props" else "CAST(NULL AS VARCHAR) AS props"
        uparts.append(f"SELECT event_id, {q(kind)} AS source, {render('ts', 'event_type')} AS published, "
                      f"{uid_col}, {props} FROM events WHERE event_type = {q(kind)}")
    uparts.append(f"SELECT event_id, event_type AS source, {render('ts', 'event_type')} AS published, CAST(NULL AS BIGINT) AS user_id, "
                  "CAST(NULL AS VARCHAR) AS props FROM events "
                  "WHERE event_type IS NULL OR event_type NOT IN ('view', 'click', 'signup', 'purchase', 'error')")
    s["union_sources"] = " UNION ALL ".join(uparts)
    s["parse_published"] = f"""WITH u AS ({s['union_sources']})
        SELECT event_id, published, {iso(parse('published'))} AS published_dt_str FROM u"""
    s["iso_published"] = f"SELECT event_id, {iso('ts')} AS iso FROM events"
    s["dedup_uid"] = f"WITH {ITEMS} SELECT uid, doc_id, published_dt_str FROM best"
    s["recent_items"] = f"""WITH {ITEMS} SELECT row_number() OVER (ORDER BY published_dt DESC NULLS LAST, uid) AS rank,
        uid, doc_id, published_dt_str FROM best"""
    s["item_count"] = f"""WITH {ITEMS} SELECT count(*) AS n_items, count(DISTINCT uid) AS n_unique FROM items1"""
    s["top_headlines"] = f"""WITH {ITEMS} SELECT uid, source, published_dt_str, title FROM best
        ORDER BY published_dt DESC NULLS LAST, uid LIMIT 3"""
    s["store_row"] = f"""WITH {ITEMS} SELECT uid, title, summary_raw AS raw_summary, link AS url, source,
        feed_url, coalesce(nullif(media_url, ''), '') AS media_url, published AS published_raw,
        coalesce(published_dt_str, '') AS published_at, 'raw' AS status,
        '2025-01-01 00:00:00' AS created_at FROM best"""
    s["insert_new"] = f"""WITH {STORE} SELECT b.uid, b.doc_id FROM best b
        WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.uid = b.uid)"""
    s["insert_skipped"] = f"""WITH {STORE} SELECT b.uid, b.doc_id FROM best b
        WHERE EXISTS (SELECT 1 FROM store s WHERE s.uid = b.uid)"""
    s["store_insert"] = f"""WITH {STORE} SELECT uid, title, url, status, published_at FROM store
        UNION ALL SELECT uid, title, link AS url, 'raw' AS status, published_dt_str AS published_at
        FROM best b WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.uid = b.uid)"""
    s["store_insert_stats"] = f"""WITH {STORE},
        added AS (SELECT count(*) AS n FROM best b WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.uid = b.uid))
        SELECT CAST((SELECT n FROM added) AS BIGINT) AS added,
               CAST((SELECT count(*) FROM items1) - (SELECT n FROM added) AS BIGINT) AS skipped"""
    s["enrich_items"] = f"""WITH {ALL_RAW + ANSWERED} SELECT uid, summary, caption_telegram, caption_instagram, status,
        ai_mode, gemini_error, processing_error, CASE WHEN 1=1 THEN processed_at END AS processed_at FROM patch"""
    s["store_patch"] = f"""WITH {ENRICH} SELECT uid, status, ai_mode, summary, caption_telegram,
        caption_instagram, gemini_error, processing_error, title, processed_at FROM patched"""
    s["status_transitions"] = f"""WITH {ENRICH} SELECT uid, status AS status_after, status_before FROM patched"""
    s["process_stats"] = f"""WITH {ALL_RAW + ANSWERED} SELECT status, ai_mode, CAST(count(*) AS BIGINT) AS n
        FROM patched GROUP BY status, ai_mode"""
    # rule path on the fixture page form (no site markup): statesman = the
    # generic article; bartaman = first h1/h2/h3 title, no content block;
    # eisamay = h1/title with blanks, article block, no byline.
    lvl = "regexp_extract(clean, '(?i)<h([123])(?:\\s[^>]*)?/?>', 1)"
    h123 = (f"CASE {lvl} WHEN '1' THEN {html_text(inner('clean', 'h1'), '')} "
            f"WHEN '2' THEN {html_text(inner('clean', 'h2'), '')} "
            f"WHEN '3' THEN {html_text(inner('clean', 'h3'), '')} END")
    s["site_articles"] = f"""WITH {para_cte},
        t AS (SELECT page_id, url, clean, paras, {html_text('clean', chr(10))} AS page_text FROM pa)
        SELECT page_id, 'statesman' AS site, {title_expr('clean', '')} AS article_title,
          paras[1] AS short_description, CAST(NULL AS VARCHAR) AS article_image_url,
          CASE WHEN regexp_matches(page_text, {auth_re}) THEN {strip(f'regexp_extract(page_text, {auth_re}, 1)')} END AS author,
          CASE WHEN regexp_matches(page_text, {pub_re}) THEN {strip(f'regexp_extract(page_text, {pub_re}, 1)')} END AS date,
          CASE WHEN len(paras) > 0 THEN array_to_string(paras, chr(10) || chr(10)) END AS full_text,
          CAST(NULL AS VARCHAR) AS parse_error FROM t
        UNION ALL
        SELECT page_id, 'bartaman', {h123}, NULL, NULL, NULL, NULL, NULL, NULL FROM pc
        UNION ALL
        SELECT page_id, 'eisamay', {title_expr('clean', ' ')}, paras[1], NULL, NULL, NULL,
          CASE WHEN len(paras) > 0 THEN array_to_string(paras, chr(10) || chr(10)) END, NULL FROM pa"""
    s["source_quarantine"] = """SELECT s.site, CAST(count(*) AS BIGINT) AS n_ok, CAST(count(*) AS BIGINT) AS n_quarantined
        FROM pages, (VALUES ('bartaman'), ('statesman'), ('eisamay')) AS s(site) GROUP BY s.site"""
    es_base, ds_base = q("https://eisamay.com"), q("https://www.dainikstatesmannews.com")
    s["site_cards"] = f"""WITH {LINKS},
        l AS (SELECT page_id, url, pos, n_links, text, {strip('href')} AS h FROM links),
        es AS (SELECT *, {url_join(es_base, 'h')} AS au FROM l WHERE h <> ''),
        es1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, au ORDER BY pos) AS rn
                FROM es) WHERE rn = 1),
        es2 AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS cp,
                count(*) OVER (PARTITION BY page_id) AS nc FROM es1)
        SELECT page_id, 'bartaman' AS site, pos AS card_pos, n_links AS n_cards, text AS title,
          {url_join('url', 'h')} AS article_url, {url_join('url', "'/img' || h || '.jpg'")} AS card_image_url,
          text AS category, {url_join('url', "'/category' || h")} AS category_url,
          CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS read_time,
          CAST(NULL AS VARCHAR) AS listing_subheadline FROM l
        UNION ALL
        SELECT page_id, 'statesman', pos, n_links, text, {url_join(ds_base, 'h')},
          {url_join(ds_base, "'/img' || h || '.jpg'")}, NULL, NULL,
          replace({strip("'Text:' || chr(160) || text")}, chr(160), ' '), 'part ' || CAST(pos AS VARCHAR), NULL
        FROM l
        UNION ALL
        SELECT page_id, 'eisamay', CAST(cp AS BIGINT), CAST(nc AS BIGINT), text, au,
          'https://cdn.example' || h || '.jpg', NULL, NULL, NULL, NULL, text FROM es2"""
    s["item_json"] = f"""WITH {ITEMS} SELECT row_number() OVER (ORDER BY published_dt DESC NULLS LAST, uid) AS rank,
        uid, title, published_dt_str, CAST(12 AS BIGINT) AS n_keys FROM best"""
    site_cte = f"""{PUB},
        sd AS (SELECT d.doc_id, d.source, d.lang, coalesce(d.text, '') AS text, coalesce(pub.published_src, '') AS pub,
            CASE d.doc_id % 3 WHEN 0 THEN 'bartaman' WHEN 1 THEN 'statesman' ELSE 'eisamay' END AS site,
            (d.doc_id // 3) % 4 AS form FROM documents d LEFT JOIN pub ON pub.doc_id = d.doc_id),
        sl AS (SELECT *, list_transform(string_split(text, chr(10)), lambda x: {strip('x')}) AS lines,
            {strip("split_part(text, chr(10), 1)")} AS title, {strip(f"coalesce({line2('text')}, '')")} AS second FROM sd),
        sp AS (SELECT *, list_filter(lines, lambda t: t <> '' AND (site = 'bartaman'
                OR NOT starts_with(lower(t), 'advertisement'))) AS paras,
            array_to_string(list_filter(list_concat([title, {strip("source || ' | ' || upper(lang)")},
                {strip("'Published: ' || pub")}], lines), lambda t: t <> ''), chr(10)) AS page_text FROM sl),
        det AS (SELECT *, CASE WHEN site <> 'bartaman' THEN paras[1] WHEN form <> 2 THEN second END AS short_description,
            CASE WHEN form = 3 THEN NULL WHEN site = 'bartaman' THEN 'https://bartamanpatrika.com/img/' || doc_id || '.jpg'
              WHEN site = 'statesman' THEN 'https://www.dainikstatesmannews.com/doc/img/' || doc_id || '.jpg'
              ELSE 'https://cdn.example/' || doc_id || '.jpg' END AS article_image_url,
            CASE WHEN site = 'statesman' THEN CASE WHEN regexp_matches(page_text, {auth_re})
                THEN {strip(f'regexp_extract(page_text, {auth_re}, 1)')} END
              WHEN site = 'bartaman' OR form <> 3 THEN source END AS author,
            CASE WHEN site = 'statesman' THEN CASE WHEN regexp_matches(page_text, {pub_re})
                THEN {strip(f'regexp_extract(page_text, {pub_re}, 1)')} END
              WHEN site = 'eisamay' AND form = 0 THEN coalesce(nullif(pub, ''), lang) ELSE pub END AS date,
            CASE WHEN len(paras) > 0 THEN array_to_string(paras, chr(10) || chr(10)) END AS full_text,
            doc_id % 20 = 0 AS failed FROM sp)"""
    s["site_article_rules"] = f"""WITH {site_cte} SELECT doc_id * 2 AS page_id, site, failed,
        """ + ", ".join(f"CASE WHEN NOT failed THEN {c} END AS {n}" for n, c in [
            ("article_title", "title"), ("short_description", "short_description"),
            ("article_image_url", "article_image_url"), ("author", "author"), ("date", "date"),
            ("full_text", "full_text")]) + " FROM det"
    s["collect_run"] = f"""WITH {site_cte},
        cd AS (SELECT *, form <> 2 AND NOT failed AS found,
            CASE WHEN form = 2 THEN CASE site WHEN 'bartaman' THEN 'https://bartamanpatrika.com/category/binodon'
                ELSE 'https://www.dainikstatesmannews.com' END
              ELSE CASE site WHEN 'bartaman' THEN 'https://bartamanpatrika.com' WHEN 'statesman'
                THEN 'https://www.dainikstatesmannews.com' ELSE 'https://eisamay.com' END || '/doc/' || doc_id END AS link,
            CASE WHEN form = 3 THEN '' ELSE CASE site WHEN 'bartaman' THEN 'https://bartamanpatrika.com/img/'
                WHEN 'statesman' THEN 'https://www.dainikstatesmannews.com/img/' ELSE 'https://cdn.example/card/' END
              || doc_id || '.jpg' END AS card_image,
            CASE WHEN site = 'eisamay' THEN second ELSE '' END AS sub
          FROM det WHERE NOT (site = 'eisamay' AND form = 2)),
        nm AS (SELECT doc_id, site, title, link, md5(link || '|' || title) AS uid,
            CASE WHEN found THEN {strip("coalesce(nullif(short_description, ''), sub)")} ELSE sub END AS raw_summary,
            CASE WHEN found THEN coalesce(article_image_url, card_image) ELSE card_image END AS media_url,
            CASE WHEN found THEN {strip("coalesce(date, '')")} ELSE '' END AS published,
            CASE WHEN found THEN {strip("coalesce(full_text, '')")} ELSE '' END AS full_text FROM cd),
        ti AS (SELECT *, {parse('published')} AS published_dt FROM nm)
        SELECT uid, title, link AS url, raw_summary, sha256(full_text) AS full_text_sha, media_url,
            published AS published_raw, {iso('published_dt')} AS published_at,
            CASE site WHEN 'bartaman' THEN 'Bartaman Binodon' WHEN 'statesman' THEN 'Dainik Statesman Binodan'
              ELSE 'Eisamay Entertainment' END AS source,
            CASE site WHEN 'bartaman' THEN 'https://bartamanpatrika.com/category/binodon' WHEN 'statesman'
              THEN 'https://www.dainikstatesmannews.com/binodan/' ELSE 'https://eisamay.com/entertainment' END AS feed_url,
            'raw' AS status
        FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY published_dt DESC NULLS LAST, doc_id) AS rn FROM ti)
        WHERE rn = 1"""
    s["stream_collect"] = s["collect_run"]
    sites = {"bartaman": ("https://bartamanpatrika.com", "https://bartamanpatrika.com/category/binodon"),
             "statesman": ("https://www.dainikstatesmannews.com", "https://www.dainikstatesmannews.com/binodan/"),
             "eisamay": ("https://eisamay.com", "https://eisamay.com/entertainment")}
    values = ", ".join(f"({i}, {q(site)}, {q(base)}, {q(listing)})" for i, (site, (base, listing)) in enumerate(sites.items()))
    s["collect_quarantine"] = f"""WITH sites(i, site, base, listing) AS (VALUES {values}),
        d AS (SELECT doc_id, doc_id // 60 AS block, doc_id % 3 AS i FROM documents)
        SELECT d.doc_id * 2 AS page_id, base || '/doc/' || d.doc_id AS url, site, 'article' AS role, 'parse error' AS reason,
          true AS has_error FROM d JOIN sites ON sites.i = d.i WHERE d.doc_id % 20 = 0
        UNION ALL
        SELECT (block * 3 + b.i) * 2 + 1, listing, site, 'listing', 'parse error', true
        FROM (SELECT DISTINCT block, i FROM d WHERE block % 7 = 3) AS b JOIN sites ON sites.i = b.i
        UNION ALL
        SELECT -page_id - 1, url, NULL, NULL, 'no site rule', true FROM pages"""
    # the hosts of a site by name, in the order in which the query tries them
    tried = [(None, None), ("bartamanpatrika.com", "bartaman"), ("www.bartamanpatrika.com", "bartaman"),
             ("epaper.bartamanpatrika.com", "bartaman"), ("notbartamanpatrika.com", None), ("dainikstatesmannews.com", "statesman"),
             ("www.dainikstatesmannews.com", "statesman"), ("eisamay.com", "eisamay"), ("m.eisamay.com", "eisamay"),
             ("eisamay.com.example.org", None)]
    path = "rtrim(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/')"
    listing_path = {"bartaman": "/category/binodon", "statesman": "/binodan", "eisamay": "/entertainment"}
    s["site_hosts"] = " UNION ALL ".join(
        f"SELECT page_id, CAST({i} AS BIGINT) AS variant, " + (f"{q(host)} AS host, " if host else f"lower({authority('url')}) AS host, ")
        + (f"{q(site)} AS site, CASE WHEN {path} = {q(listing_path[site])} THEN 'listing' ELSE 'article' END AS role" if site
           else "CAST(NULL AS VARCHAR) AS site, CAST(NULL AS VARCHAR) AS role") + " FROM pages"
        for i, (host, site) in enumerate(tried))
    first_run = STORE + ", raw1 AS (SELECT * FROM store WHERE status = 'raw')"
    every = ", store2 AS (SELECT uid, title, summary_raw AS raw_summary, source, link AS url FROM best)"

    def asked(name: str, rows: str) -> str:
        fails = "substr(md5({p}), 1, 1) IN ('e', 'f')"
        return f""", {name}_p AS (SELECT uid, {P1} AS p1, {P2} AS p2, {P3} AS p3 FROM {rows}),
        {name}_f AS (SELECT *, {fails.format(p='p1')} OR strpos(p1, chr(10) || 'Summary: ' || chr(10)) > 0 AS f1, {fails.format(p='p2')} AS f2
          FROM {name}_p),
        {name} AS (SELECT uid, 'one_line' AS kind, p1 AS p FROM {name}_f UNION ALL
          SELECT uid, 'telegram', p2 FROM {name}_f WHERE NOT f1 UNION ALL
          SELECT uid, 'instagram', p3 FROM {name}_f WHERE NOT f1 AND NOT f2)"""
    s["model_answers"] = f"""WITH {first_run}{every}{asked('one', 'raw1')}{asked('two', 'store2')}
        SELECT two.kind, count(one.uid) AS n_reused, count(*) - count(one.uid) AS n_made
        FROM two LEFT JOIN one ON one.uid = two.uid AND one.kind = two.kind AND one.p = two.p GROUP BY two.kind"""
    s["stream_process"] = s["store_patch"]
    s["stream_ingest"] = f"""WITH {PAGES_CLEAN},
        t AS (SELECT page_id, url, {strip(f"coalesce({title_expr('clean', '')}, '')")} AS title,
                {strip("coalesce(url, '')")} AS link FROM pc),
        u AS (SELECT *, md5(link || '|' || title) AS uid,
                row_number() OVER (PARTITION BY md5(link || '|' || title) ORDER BY page_id) AS rn FROM t)
        SELECT uid, title, link AS url, replace({authority('url')}, 'www.', '') AS source,
          '' AS published_at, 'raw' AS status FROM u WHERE rn = 1"""
    return s


ORACLE_SQL = _sql()
