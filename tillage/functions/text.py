"""Text normalisation, signatures, stable ids, query phrases and markup cleaning, as Column expressions."""

from __future__ import annotations

import functools
import html.entities
import json
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

#: Punctuation that public questions and signatures are compared without.
PUBLIC_PUNCTUATION = "\"'“”‘’.,;:!?()[]{}"
SIGNATURE_PUNCTUATION = "“”\"'`.,;:!?()[]{}"

#: An entity as HTML has it: a number, or a name of at most 32 characters with or without semicolon.
ENTITY = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"
#: Only those that end in a semicolon.
WHOLE_ENTITY = ENTITY.replace(";?", ";")


#: Case pairs of Unicode 14, which a JVM that has an older version leaves as they are.
NEW_PAIRS = ((0x2C2F, 0x2C2F), (0xA7C0, 0xA7C0), (0xA7D0, 0xA7D0), (0xA7D6, 0xA7D8), (0x10570, 0x10595))


@functools.cache
def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """How characters fold that lower case leaves as they are: to one character, and to several. From Python's Unicode table."""
    one, many = {}, {}
    for i in range(0x20000):
        c, folded = chr(i), chr(i).casefold()
        if c != folded and (c.lower() == c or any(a <= i <= b for a, b in NEW_PAIRS)):
            (one if len(folded) == 1 else many)[c] = folded
    return one, many


def _class(characters: Iterable[str], gap: int = 0) -> str:
    """A regular expression's class of some characters, in ranges; from U+0300 on, ranges less than ``gap`` apart are one."""
    ranges: list[list[int]] = []
    for i in sorted(map(ord, characters)):
        if ranges and i - ranges[-1][1] <= max(1, gap if ranges[-1][1] >= 0x300 else 0):
            ranges[-1][1] = i
        else:
            ranges.append([i, i])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def casefold(c: Column) -> Column:
    """Full Unicode case folding: lower case, then what that leaves unfolded.

    ß is common and replaced at once. Few texts hold any other such character (final sigma, ligatures, some Greek and Cherokee); a
    search for a few ranges beyond ASCII that hold them all tells the others, which are lowered only.
    """
    one, many = _folds()
    rest = {k: v for k, v in many.items() if k != "ß"}
    low = F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))
    several = _class(rest)
    table = F.from_json(F.lit(json.dumps(rest, ensure_ascii=False)), "map<string,string>")
    pairs = F.arrays_zip(F.split(low, several, -1).alias("part"), F.transform(F.regexp_extract_all(low, F.lit(several), 0), lambda x: table[x]).alias("folded"))
    spelled = F.array_join(F.transform(pairs, lambda x: F.concat(x["part"], F.coalesce(x["folded"], F.lit("")))), "")
    some = F.rlike(low, F.lit(r"(?![\x00-\x7f])" + _class([*one, *rest], 0x40)))
    return F.when(some, F.translate(spelled, "".join(one), "".join(one.values()))).otherwise(low)


def collapse(c: Column) -> Column:
    """White space of any kind as one space, none at the ends."""
    return F.btrim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def normalize(c: Column) -> Column:
    return collapse(casefold(c))


def _without(punctuation: str, c: Column) -> Column:
    """Folded, with white space and punctuation of any kind as one space, none at the ends: one search of the text."""
    marks = "".join("\\" + m for m in punctuation)
    return F.btrim(F.regexp_replace(casefold(c), rf"(?U)[\s\x1c-\x1f{marks}]+", " "))


def normalize_public(c: Column) -> Column:
    """As `normalize`, with punctuation as spaces."""
    return _without(PUBLIC_PUNCTUATION, c)


def signature(c: Column) -> Column:
    """Near-duplicate form of a query text: normalised, with punctuation as spaces."""
    return _without(SIGNATURE_PUNCTUATION, c)


def stable_id(prefix: str, c: Column) -> Column:
    """The prefix, then the first 12 hexadecimal digits of SHA-256 in upper case."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(c, 256), 1, 12)))


def filled(*columns: Column) -> Column:
    """The non-empty ones, joined by spaces."""
    return F.array_join(F.filter(F.array(*columns), lambda x: x.isNotNull() & (x != "")), " ")


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def local_query(crop: Column, weather: Column, extra: Column, region: Column) -> Column:
    """Quoted crop and weather terms, then the rest."""
    return F.trim(filled(quoted(crop), quoted(weather), extra, region))


def english_query(crop: Column, weather: Column, extra: Column, region: Column) -> Column:
    return filled(crop, weather, extra, region)


def question(template: Column, crop: Column, region: Column) -> Column:
    """A template with its crop filled in and the region after it."""
    return filled(F.replace(template, F.lit("{crop}"), crop), region)


def _character(code: Column) -> Column:
    """The character of a code point below 2^31, by its UTF-32 bytes."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _number(code: Column) -> Column:
    """What a numeric entity stands for: 128 to 159 as in Windows-1252, controls and non-characters nothing, no character U+FFFD."""
    old = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
    gone = code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE)
    out = F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF) | code.isNull(), "\ufffd").when(code == 0xD, "\r")
    table = F.create_map(*[F.lit(x) for p in old.items() for x in p])
    return out.when(code.between(0x80, 0x9F), table[code.cast("int")]).when(gone, "").otherwise(_character(F.when(code.between(0, 0x10FFFF), code).otherwise(0)))


def _entity(token: Column, whole: bool) -> Column:
    """What an entity (with its ampersand) stands for; itself if it is none.

    Names come from Python's table of HTML 5. Of a name that isn't known the longest
    beginning is decoded that may stand without a semicolon, unless only ``whole`` entities count.
    """
    names = html.entities.html5
    bare = {k: v for k, v in names.items() if not k.endswith(";")}
    table = lambda pairs: F.from_json(F.lit(json.dumps(pairs, ensure_ascii=False)), "map<string,string>")
    body = F.substring(token, 2, 64)
    start = F.regexp_extract(body, "^(" + "|".join(sorted(bare, key=len, reverse=True)) + ")", 1)
    named = F.coalesce(table(names)[body], token) if whole else F.coalesce(table(names)[body], F.when(start != "", F.concat(table(bare)[start], F.substr(body, F.length(start) + 1))), token)
    digits = F.regexp_extract(token, "^&#[xX]?([0-9a-fA-F]+)", 1)
    significant = F.regexp_replace(digits, "^0+(?=.)", "")
    base = F.when(F.rlike(token, F.lit("^&#[xX]")), 16).otherwise(10)
    code = F.when(F.length(significant) <= 10, F.when(base == 16, F.conv(significant, 16, 10)).otherwise(F.conv(significant, 10, 10)).cast("long"))
    return F.when(F.startswith(token, F.lit("&#")), _number(code)).otherwise(named)


def unescape(c: Column, whole: bool = False) -> Column:
    """All HTML entities, named and numeric, decoded once, in the JVM. ``whole``: only those that end in a semicolon."""
    entity = WHOLE_ENTITY if whole else ENTITY
    parts, found = F.split(c, entity, -1), F.regexp_extract_all(c, F.lit(entity), 0)
    pairs = F.arrays_zip(parts.alias("part"), F.transform(found, lambda x: _entity(x, whole)).alias("char"))
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(pairs, lambda x: F.concat(x["part"], F.coalesce(x["char"], F.lit("")))), "")).otherwise(c)


def clean_text(c: Column, markup: Column, whole: bool = False) -> Column:
    """Null as empty, entities decoded (see `unescape`), then tags as spaces where ``markup``, white space collapsed."""
    decoded = unescape(F.coalesce(c, F.lit("")), whole)
    return collapse(F.when(markup, F.regexp_replace(decoded, "<[^>]+>", " ")).otherwise(decoded))


def clean_web_text(c: Column, whole: bool = False) -> Column:
    """Tags stay."""
    return clean_text(c, F.lit(False), whole)


def clean_markup_text(c: Column, whole: bool = False) -> Column:
    """Entities are decoded first, so escaped tags go too."""
    return clean_text(c, F.lit(True), whole)


def metadata_text(*fields: Column) -> Column:
    """Normal form of the non-empty fields together."""
    return normalize(filled(*fields))


def first_available(terms: Column) -> Column:
    """The first non-empty element, or an empty string."""
    return F.coalesce(F.get(F.filter(terms, lambda x: x != ""), F.lit(0)), F.lit(""))


def second_available(terms: Column) -> Column:
    """The second distinct non-empty element, or else the first."""
    some = F.array_distinct(F.filter(terms, lambda x: x != ""))
    return F.coalesce(F.get(some, F.lit(1)), F.get(some, F.lit(0)), F.lit(""))


def nonempty(c: Column, other: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) != "", c).otherwise(other)
