"""Operator 6 [native]: personal data by patterns, checksums and context.

Regular expressions propose spans, validators confirm them (digit counts, Luhn,
mod 97, octet range), and words shortly before a span raise its score.  All of
it is DataFrame expressions: the text between matches (``split``) and the matches
(``regexp_extract_all``) alternate, so a running sum of their lengths gives code
point offsets, without a shuffle.  n spans cost n log n steps.

Base kinds are email, ip, card and phone: every confirmed span counts.  The
method adds iban (mod 97) and account: 8 to 12 digits alone are weak evidence,
so an account span needs a context word.  The patterns are written so that a
search advances past a run of characters that cannot match (looking behind for
the run's start, possessive repetition); their matches equal those of the plain
patterns, and long texts cost linear time.

Defined cases: null text counts as empty (and stays null when masking); spans
are leftmost and do not overlap within a kind; a proposal that fails its check is
dropped without another try inside it; rows are independent, so repeated rows
give equal results; further columns are kept, whatever their names
(:func:`find_pii` adds columns under a prefix of the caller's choice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import let

# Patterns of the kinds, in the order in which spans are listed.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "account": r"(?<![A-Za-z0-9.-])[0-9]{8,12}(?![A-Za-z0-9-])",
}
BASE = ("email", "ip", "card", "phone")
#: Cheap conditions without which a kind cannot match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
NEEDS_PATTERN = {"ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}",
                 "iban": r"[A-Z]{2}[0-9]{2}", "account": r"[0-9]{8}"}
# Words that make a span likelier, and their reach in code points.
CONTEXT = {
    "email": "mail|contact|kontakt|correo|courriel", "ip": "ip|host|server|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta", "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|konto|compte|cuenta", "account": "account|konto|compte|cuenta|customer|passport|iban",
}
REACH = 40
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "account": 0.3}
BOOST, ACCEPT = 0.3, 0.5
#: Spans from which on a text is masked from its code points rather than by substrings.
MANY = 64
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where a string of digits has a Luhn sum that ten divides."""
    chars = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    total = F.aggregate(chars, F.lit(0), lambda acc, x: acc + F.when(x.i % 2 == 0, x.d).otherwise(
        x.d * 2 - F.when(x.d > 4, 9).otherwise(0)))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """True where an IBAN's rearranged digits leave remainder 1 modulo 97."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.char_length(plain)), F.substring(plain, 1, 4))
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def confirmed(kind: str, match: Column) -> Column:
    n = F.char_length(_digits(match))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "ip":
        return ~F.exists(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
                         .rlike("^(?:[0-9]{4}|25[6-9]|2[6-9][0-9]|[3-9][0-9]{2})"))
    if kind == "iban":
        return F.char_length(F.regexp_replace(match, " ", "")).between(15, 34) & mod97(match)
    return F.lit(True)


def running(values: Column, merge) -> Column:
    """Running totals of an array of integers under ``merge`` (sum, greatest): each
    round merges every element with the total twice as far back, so n elements take
    log n rounds and no array grows by one."""
    def rounds(v: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.size(v))).cast("int") - 1, F.lit(0))), v,
            lambda acc, k: F.transform(acc, lambda x, i: F.when(i >= F.pow(F.lit(2), k), merge(x, F.get(acc, i - F.pow(F.lit(2), k).cast("int"))))
                                       .otherwise(x)))
    return let(values, rounds)


def spans_of(text: Column, kind: str) -> Column:
    """Array of (kind, start, end, score) of one kind; ``text`` must not be null."""
    pattern = F.lit(PATTERNS[kind])
    pieces = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"),
                          F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"))
    empty = F.array().cast(SPAN)

    def span(x: Column, end: Column) -> Column:
        near = F.lower(F.right(x.gap, F.lit(REACH))).rlike(rf"(?:^|[^a-z])(?:{CONTEXT[kind]})")
        score = F.lit(PRIOR[kind]) + F.when(near, F.lit(BOOST)).otherwise(F.lit(0.0))
        ok = x.hit.isNotNull() & confirmed(kind, x.hit)
        if kind not in BASE:
            ok = ok & (score >= ACCEPT)
        made = F.struct(F.lit(kind).alias("kind"), (end - F.char_length(x.hit)).alias("start"), end.alias("end"),
                        F.least(score, F.lit(1.0)).alias("score")).cast(SPAN[6:-1])
        return F.when(ok, made)

    def spans(all_pieces: Column, ends: Column) -> Column:
        return F.filter(F.transform(all_pieces, lambda x, i: span(x, F.get(ends, i))), lambda s: s.isNotNull())

    size = F.transform(pieces, lambda x: F.char_length(x.gap) + F.coalesce(F.char_length(x.hit), F.lit(0)))
    found = let(pieces, lambda p: let(running(size, lambda a, b: a + b), lambda ends: spans(p, ends)))
    needed = [F.instr(text, NEEDS[kind]) > 0] if kind in NEEDS else []
    needed += [text.rlike(NEEDS_PATTERN[kind])] if kind in NEEDS_PATTERN else []
    test = needed[0]
    for more in needed[1:]:
        test = test & more
    return F.when(test, found).otherwise(empty)


def find_pii(docs: DataFrame, text: str = "text", prefix: str = "pii_") -> DataFrame:
    """``docs`` with one column of spans per kind, named ``<prefix><kind>``."""
    held = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumns({f"{prefix}{kind}": spans_of(held, kind) for kind in PATTERNS})


def listed(*kinds: str) -> Column:
    """kind:start:end of the spans of the kinds, comma-joined, kinds in the given order."""
    rows = F.transform(F.concat(*(F.col(f"pii_{k}") for k in kinds)),
                       lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    return F.array_join(rows, ",")


def pii_report(docs: DataFrame) -> DataFrame:
    counts = [F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in BASE]
    return find_pii(docs.select(F.col("doc_id").cast("long"), "text")).select(
        "doc_id", *counts, F.sha2(listed(*BASE), 256).alias("base_sha256"), listed(*PATTERNS).alias("spans"))


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans by the first's.

    All columns are kept; ``n_chars``, where it exists, follows the new text.
    """
    names = docs.columns
    fields = {f.name: f for f in docs.schema.fields}
    wide = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("text"))
    text = F.col("text")
    spans = F.array_sort(F.transform(F.concat(*(F.col(f"pii_{k}") for k in PATTERNS)), lambda s: F.struct(
        s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))

    def cut(start: Column, size: Column, chars: Column) -> Column:
        """A piece of the text: by code points once split up where there are many spans."""
        return F.when(F.size(chars) > 0, F.array_join(F.slice(chars, start + 1, size), "")).otherwise(F.substring(text, start + 1, size))

    def pieces(s: Column, ends: Column, chars: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            at = F.coalesce(F.get(ends, i - 1), F.lit(0))  # behind all earlier spans
            return F.when(x.start >= at, F.concat(cut(at, x.start - at, chars), F.lit("["), F.upper(x.kind), F.lit("]"))).otherwise(F.lit(""))
        last = F.get(ends, F.size(ends) - 1)
        return F.concat(F.array_join(F.transform(s, piece), ""), cut(last, F.char_length(text) - last, chars))

    chars = F.when(F.size("spans") > MANY, F.split(text, "")).otherwise(F.array().cast("array<string>"))
    masked = let(running(F.transform("spans", lambda s: s.end), F.greatest), lambda ends: let(chars, lambda c: pieces(F.col("spans"), ends, c)))
    out = find_pii(wide).select("row", "text", spans.alias("spans"))
    out = out.select("row", F.when(text.isNotNull() & (F.size("spans") > 0), masked).otherwise(text).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in names:
        new["n_chars"] = F.char_length("text").cast(fields["n_chars"].dataType)
    return out.select(*(new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in names))
