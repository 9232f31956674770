"""Markup as browsers read it, in columns: tags, attributes and text of pages that are not well formed.

A token is a comment, a declaration, a tag, or a whole script or style element. Patterns take a quoted attribute value as a
unit where it follows an equals sign, so a `>` in it ends no tag, and a `<` that begins no token is text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: After a tag's name: what is not its end. A quoted value is skipped whole.
INSIDE = r"""[^>=]*+(?:=\s*+(?:"[^"]*"|'[^']*'|)[^>=]*+)*+"""
COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
TAG = rf"</?[a-z](?:[^\s/>]*+(?:[\s/]{INSIDE})?+)>"
RAW = rf"<(?:script|style)(?:[\s/]{INSIDE})?+>.*?(?:</(?:script|style)(?=[\s/>])[^>]*+>|\z)"
TOKEN = rf"(?is)(?:{COMMENT}|{RAW}|{TAG}|</>|</[^a-z>][^>]*+>|<[!?][^>]*+>)"

#: Names of character references that need no semicolon, the longest first; of the standard's table.
SHORT = "|".join(sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k)))
REFERENCE = rf"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+;|(?:{SHORT}))"
#: Characters that numbers of the C1 range stand for: those of code page 1252.
C1 = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is evaluated once, however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


def table(entries: dict[str, str]) -> Column:
    """A constant map, made of one text, so that plans stay small and it is made once."""
    return F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in entries.items())), F.lit("\x02"), F.lit("\x01"))


#: The names of character references, in so many maps by a checksum of the name: a map is searched from its beginning.
NAMES = [{k: v for k, v in html5.items() if zlib.crc32(k.encode()) % 64 == i} for i in range(64)]


#: White space of any script, as at the ends of a cell's text.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def numbered(reference: Column) -> Column:
    """The character of &#...; or &#x...;."""
    digits = F.regexp_extract(reference, r"#[xX]?0*([0-9a-fA-F]*)", 1)
    hexadecimal = F.lower(F.substring(reference, 3, 1)) == "x"
    short = F.length(digits) <= 7
    n = F.when(digits == "", 0).when(short, F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("long")).otherwise(1 << 32)
    character = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    control = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n % 65536 >= 65534)
    return F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�").when(n.between(0x80, 0x9F), F.element_at(table({str(k): v for k, v in C1.items()}), n.cast("string"))).when(control, "").otherwise(character)


def named(reference: Column) -> Column:
    """The characters of &name; else of its longest beginning that is a name without semicolon, and the rest as it is."""
    known = F.array(*map(table, NAMES))
    short = F.regexp_extract(reference, rf"^&({SHORT})", 1)
    rest = F.substring(reference, F.length(short) + 2, F.length(reference))
    meant = lambda name: F.try_element_at(F.get(known, (F.crc32(name) % len(NAMES)).cast("int")), name)
    return F.coalesce(meant(F.substring(reference, F.lit(2), F.length(reference))), F.when(short != "", F.concat(meant(short), rest)), reference)


def gaps(text: Column, pattern: str) -> Column:
    """What split(text, pattern, -1) gives: split compiles a pattern for each text, but not a single character."""
    mark = "\x01"
    return F.when(F.contains(text, F.lit(mark)), F.split(text, pattern, -1)).otherwise(F.split(F.regexp_replace(text, pattern, mark), mark, -1))


def unescaped(text: Column) -> Column:
    """Character references decoded once, in the order of their places."""
    return once(text, _unescaped)


def _unescaped(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"({REFERENCE})"), F.lit(1))
    decoded = F.concat(F.transform(found, lambda r: F.when(F.substring(r, 2, 1) == "#", numbered(r)).otherwise(named(r))), F.array(F.lit("")))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.zip_with(gaps(text, REFERENCE), decoded, lambda g, d: F.concat(g, d)), "")).otherwise(text)


def text_of(html: Column) -> Column:
    """Text without markup, character references decoded; scripts and styles keep their text as it is written."""
    return once(html, _text_of)


def _text_of(html: Column) -> Column:
    raw = html.rlike(r"(?i)<(?:script|style)[\s/>]")
    inner = lambda t: F.when(t.rlike(r"(?is)^<(?:script|style)[\s/>]"), F.regexp_extract(t, rf"(?is)^<(?:script|style)(?:[\s/]{INSIDE})?+>(.*?)(?:</(?:script|style)(?=[\s/>])[^>]*+>|\z)", 1)).otherwise("")
    tokens = F.concat(F.transform(F.regexp_extract_all(html, F.lit(f"({TOKEN})"), F.lit(1)), inner), F.array(F.lit("")))
    with_raw = F.array_join(F.zip_with(gaps(html, TOKEN), tokens, lambda g, t: F.concat(unescaped(g), t)), "")
    # references do not reach over tags, so these must not become one by what is cut between
    plain = F.array_join(F.transform(gaps(html, TOKEN), unescaped), "")
    return F.when(raw, with_raw).when(F.contains(html, F.lit("&")), plain).when(F.contains(html, F.lit("<")), F.regexp_replace(html, TOKEN, "")).otherwise(html)


def opening(name: str) -> str:
    """Pattern of an opening tag of this name."""
    return rf"<{name}(?:[\s/]{INSIDE})?+>"


def tags(html: Column, name: str) -> Column:
    """The opening tags of this name; what looks like one within another token is none."""
    return F.filter(F.regexp_extract_all(html, F.lit(f"({TOKEN})"), F.lit(1)), lambda t: t.rlike(rf"(?i)^<{name}[\s/>]"))


def attribute(tag: Column, name: str) -> Column:
    """The first value of an attribute of an opening tag, quoted or bare, with references decoded; null if it has none."""
    one = r"""[\s/]+[^\s/=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*))?"""
    value = F.regexp_extract(tag, rf"""(?is)^<[a-z][^\s/>]*(?:{one})*?[\s/]+{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*)""", 1)
    bare = F.when(value.rlike("""^["']"""), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return F.when(value != "", unescaped(bare))
