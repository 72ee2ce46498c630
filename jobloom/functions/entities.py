"""HTML character references, named and numeric, decoded in one pass by Column expressions.

The names and what they stand for are those of the HTML standard, read from Python's own table.
"""

from __future__ import annotations

import html
import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = r"^&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Names that also count without a semicolon, and as the beginning of a longer word; the longest first.
OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: Numbers below 160 that do not stand for their own character.
REPLACED = {str(n): html.unescape(f"&#{n};") for n in range(160) if html.unescape(f"&#{n};") != chr(n)}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once a row however often it stands in ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _by_start() -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        out.setdefault(name[:2], {})[name] = text
    return out


def _table(values: dict, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), kind)


def character(n: Column) -> Column:
    """The character of a code point; null where ``n`` is."""
    byte = lambda x: F.lpad(F.hex(x), 2, "0")
    more = lambda shift: byte(F.shiftright(n, shift).bitwiseAND(63).bitwiseOR(128))
    two = F.concat(byte(F.shiftright(n, 6).bitwiseOR(192)), more(0))
    three = F.concat(byte(F.shiftright(n, 12).bitwiseOR(224)), more(6), more(0))
    four = F.concat(byte(F.shiftright(n, 18).bitwiseOR(240)), more(12), more(6), more(0))
    code = F.when(n < 0x80, byte(n)).when(n < 0x800, two).when(n < 0x10000, three).otherwise(four)
    return F.decode(F.unhex(code), "UTF-8")


def _numeric(ref: Column) -> Column:
    digits = F.ltrim(F.regexp_extract(ref, "^#([0-9]+)", 1), F.lit("0"))
    hexed = F.ltrim(F.regexp_extract(ref, "^#[xX]([0-9a-fA-F]+)", 1), F.lit("0"))
    by_hex = F.lower(F.substring(ref, 2, 1)) == "x"
    size, most = F.when(by_hex, F.length(hexed)).otherwise(F.length(digits)), F.when(by_hex, 6).otherwise(7)
    n = F.when(by_hex, F.conv(F.concat(F.lit("0"), F.substring(hexed, 1, 6)), 16, 10).cast("long")).otherwise(F.concat(F.lit("0"), F.substring(digits, 1, 7)).cast("long"))
    beyond = (size > most) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    unassigned = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
    return F.when(beyond, "�").when(unassigned, "").otherwise(F.coalesce(F.try_element_at(_table(REPLACED, "map<string,string>"), n.cast("string")), character(n)))


def _decoded(piece: Column) -> Column:
    """A piece of text that starts with its only ampersand."""
    ref = F.regexp_extract(piece, REFERENCE, 1)
    after = F.substr(piece, F.length(ref) + 2)
    named = F.try_element_at(F.try_element_at(_table(_by_start(), "map<string,map<string,string>>"), F.substring(ref, 1, 2)), ref)
    start = F.regexp_extract(ref, "^(" + "|".join(OPEN_NAMES) + ")", 1)
    opened = F.concat(F.try_element_at(_table({n: html5[n] for n in OPEN_NAMES}, "map<string,string>"), start), F.substr(ref, F.length(start) + 1))
    text = F.when(ref.startswith("#"), _numeric(ref)).otherwise(F.coalesce(named, opened, F.concat(F.lit("&"), ref)))
    return F.when(ref == "", piece).otherwise(F.concat(text, after))


def unescape(c: Column) -> Column:
    """``c`` with its character references decoded once: what they give is not read again. Names without a semicolon count
    where the standard lets them, numbers outside Unicode become U+FFFD and noncharacters nothing. Null stays null."""
    return let(c, lambda x: F.when(F.contains(x, F.lit("&")), F.array_join(F.transform(F.split(x, "(?=&)"), _decoded), "")).otherwise(x))
