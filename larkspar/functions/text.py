"""String, hash and rate functions: Column in, Column out, all inside code generation."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that counts when identifiers are compared.
WHITE = r"[\t\n\x0B\f\r    -     　﻿]"
#: Contact patterns.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+"
PHONE = r"(?<![\w@.])(\+\d[\d\s().-]{6,18}\d|\(?\d{2,5}\)?[\s.-]\d[\d\s().-]{4,17}\d)(?![\w@])"
#: The fewest digits of a phone number, and the combining marks that folding drops.
PHONE_DIGITS = 8
MARKS = ("\u0300", "\u036f")


@functools.cache
def marked_letters() -> tuple[str, str]:
    """Letters of the basic plane that lose a mark when decomposed, and what is left of each."""
    pairs = []
    for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)]):
        bare = unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", c) if not MARKS[0] <= x <= MARKS[1]))
        if bare != c and len(bare) == 1:
            pairs.append((c, bare))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x computed once however often f names it; below a lambda function Spark itself shares nothing."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def trimmed(x: Column) -> Column:
    return F.regexp_replace(x, f"^{WHITE}+|{WHITE}+$", "")


def blank_to_null(x: Column) -> Column:
    t = trimmed(x)
    return F.when(t != "", t)


def code(x: Column) -> Column:
    """Identifier code: white space collapsed, upper case."""
    return F.upper(trimmed(F.regexp_replace(x, f"{WHITE}+", " ")))


def country(x: Column) -> Column:
    c = F.upper(trimmed(x))
    return F.when(c.rlike("^[A-Z]{2}$"), c)


def digits_only(x: Column) -> Column:
    """The trimmed value if it is all digits, else null."""
    t = trimmed(x)
    return F.when(t.rlike("^[0-9]+$"), t)


def row_key(code_value: Column, number: Column) -> Column:
    """code|number; null where either holds the delimiter or there is no code."""
    bad = F.coalesce(F.instr(code_value, "|") > 0, F.lit(True)) | F.coalesce(F.instr(number, "|") > 0, F.lit(False))
    return F.when(~bad, F.concat(code_value, F.lit("|"), F.coalesce(number, F.lit(""))))


def folded(x: Column) -> Column:
    return F.lower(trimmed(x))


def typed_value(kind: Column, value: Column) -> Column:
    """Comparable form of a typed identifier; null for kinds that are not compared."""
    return F.when(folded(kind) == "erasmus", code(value)).when(folded(kind) == "pic", digits_only(value))


def accent_folded(x: Column) -> Column:
    """Without marks: precomposed letters of any script, and combining marks dropped."""
    return F.regexp_replace(F.translate(x, *marked_letters()), f"[{MARKS[0]}-{MARKS[1]}]", "")


def match_form(x: Column) -> Column:
    y = F.lower(accent_folded(x))
    y = F.regexp_replace(F.regexp_replace(y, "[-_]+", " "), rf"[^\p{{L}}\p{{N}}{WHITE[1:-1]}]+", " ")
    return spaced(y)


def tokens(x: Column) -> Column:
    m = match_form(x)
    return F.when(m == "", F.array().cast("array<string>")).otherwise(F.split(m, " "))


def has_phrase(match_formed: Column, phrase: Column) -> Column:
    """Whole-token containment of a normalised phrase."""
    return (phrase != "") & (F.instr(F.concat(F.lit(" "), match_formed, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" "))) > 0)


def spaced(x: Column) -> Column:
    return trimmed(F.regexp_replace(x, f"{WHITE}+", " "))


def quotes(field: Column, quote: Column) -> Column:
    """Does the field hold the quote, white space aside? An empty quote is held nowhere."""
    return (spaced(quote) != "") & (F.instr(spaced(field), spaced(quote)) > 0)


def supports_name(field: Column, name: Column) -> Column:
    return quotes(accent_folded(field), accent_folded(name))


def cut(x: Column, n: int) -> Column:
    """At most n code points."""
    return F.substring(x, 1, n)


def language_stratum(tag: Column) -> Column:
    t = F.lower(F.split_part(trimmed(tag), F.lit("-"), F.lit(1)))
    return F.when(F.coalesce(t, F.lit("")) == "", "unknown").otherwise(t)


def sign_bucket(score: Column) -> Column:
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("zero")


def redact_emails(x: Column) -> Column:
    """Addresses marked; the pattern, which starts at every letter, is left out where no @ is."""
    return let(x, lambda x: F.when(F.instr(x, "@") > 0, F.regexp_replace(x, EMAIL, "[EMAIL]")).otherwise(x))


def redact_phones(x: Column) -> Column:
    """Phone-like runs with enough digits, each where it stands: equal digits elsewhere stay."""
    def marked(c: Column) -> Column:
        return F.when(F.char_length(F.regexp_replace(c, r"\D", "")) >= PHONE_DIGITS, "[PHONE]").otherwise(c)

    def joined(x: Column) -> Column:
        found, between = F.regexp_extract_all(x, F.lit(PHONE), F.lit(0)), F.split(x, PHONE, -1)
        parts = F.transform(F.arrays_zip(between.alias("gap"), F.transform(found, marked).alias("hit")), lambda p: F.concat(p["gap"], F.coalesce(p["hit"], F.lit(""))))
        return F.when(x.rlike(PHONE), F.array_join(parts, "")).otherwise(x)

    return let(x, joined)


def redact(x: Column) -> Column:
    return redact_phones(redact_emails(x))


def canonical_json(**fields: Column) -> Column:
    """Keys sorted, nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def digest(x: Column) -> Column:
    return F.sha2(x, 256)


def gold_id(row: Column, body_sha: Column) -> Column:
    return F.concat(F.lit("g"), F.substring(digest(canonical_json(bodySha=body_sha, rowKey=row)), 1, 16))


def rate(n: Column, d: Column) -> Column:
    return n / F.nullif(d, F.lit(0))


def decay(distance: Column) -> Column:
    return F.when(distance == 1, F.lit(0.5)).when(distance == 2, F.lit(0.25)).otherwise(F.lit(0.0))
