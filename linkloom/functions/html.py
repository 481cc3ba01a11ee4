"""Anchor extraction from raw HTML as native column expressions.

One pass of one expression reads the body as a tag reader does: left to right,
every comment, every element whose content is text and every tag is consumed
whole, attribute by attribute, so that nothing inside an attribute value, a
comment or a script is taken for a tag.  Group 2 captures the first ``href``
attribute of an ``<a>`` tag, with its name, so what is only consumed
yields an empty capture and a bare ``href`` does not.

Attributes: white space and ``/`` separate them and are needed after an unquoted
value only; a name begins with any other character (``=`` as well) and ends at
white space, ``/``, ``>`` or ``=``; an unquoted value ends at white space or ``>``.
A tag or a quoted value that is never closed takes the rest of the body with it and
gives no link.  All loops are possessive: the matcher neither recurses per
attribute nor returns to what it has read, whatever the markup.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import built_once

_W = r" \t\n\f\r"
_VALUE = rf"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^{_W}"'>][^{_W}>]*+)"""
_NAME_END = rf"(?=[{_W}/>=])"
_ASSIGNED = rf"(?:[{_W}]*+=[{_W}]*+{_VALUE}?+)?+"
_ATTRIBUTE = rf"[^{_W}/>][^{_W}/>=]*+{_ASSIGNED}"
_REST = rf"(?:[{_W}/]++|{_ATTRIBUTE})*+"
_TAG_END = rf"(?=[{_W}/>])"
# --- fixed values: elements whose content is text, not markup ---------------
RAW_TEXT = ["script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"]
# ---------------------------------------------------------------------------
_COMMENT = r"!--(?:-?>|(?:[^-]++|-(?!-!?>))*+(?:--!?>|\z))"
_TEXT_ELEMENT = (rf"({'|'.join(RAW_TEXT)}){_TAG_END}{_REST}"
                 rf"(?:>[^<]*+(?:<(?!/\1[{_W}/>])[^<]*+)*+|\z)")
_ANCHOR = (rf"a{_TAG_END}(?:[{_W}/]++|(?!href{_NAME_END}){_ATTRIBUTE})*+"
           rf"(href{_NAME_END}{_ASSIGNED}){_REST}>")
#: One construct after another; the plain tag takes what is left of the others' cases.
LINK_SCAN = ("(?i)<(?:" + "|".join([
    _COMMENT, _TEXT_ELEMENT, rf"plaintext{_TAG_END}{_REST}(?s:>.*+)?+", _ANCHOR,
    rf"/?+[a-z][^{_W}/>]*+{_REST}(?:>|\z)", r"(?:[!?]|/(?![a-z]))[^>]*+"]) + ")")

# --- fixed values: numeric character references 0x80-0x9F are read as
# windows-1252 (HTML5 parsing rules); code points not listed map to themselves
C1_REMAP = {
    0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020,
    0x87: 0x2021, 0x88: 0x02C6, 0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152,
    0x8E: 0x017D, 0x91: 0x2018, 0x92: 0x2019, 0x93: 0x201C, 0x94: 0x201D, 0x95: 0x2022,
    0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC, 0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A,
    0x9C: 0x0153, 0x9E: 0x017E, 0x9F: 0x0178,
}
# ---------------------------------------------------------------------------
#: A character reference; with the ``=`` after a name, which leaves it undecoded in an attribute.
RE_REF = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*[;=]?)"


def raw_anchor_values(html: Column) -> Column:
    """array<string> of ``href`` attributes, as written, in document order."""
    return F.filter(F.regexp_extract_all(html, F.lit(LINK_SCAN), 2), lambda v: v != "")


def unquote(attribute: Column) -> Column:
    """The value of an ``href`` attribute; empty if it has none."""
    value = F.regexp_extract(attribute, rf"(?is)^href[{_W}]*=[{_W}]*(.*)$", 1)
    return (F.when(value.startswith('"') | value.startswith("'"), value.substr(F.lit(2), F.length(value) - 2))
            .otherwise(value))


def code_point_text(cp: Column) -> Column:
    """One-character string of a code point (UTF-16 via ``decode``);
    0, surrogates and values past U+10FFFF give U+FFFD."""
    remap = F.create_map(*[F.lit(x).cast("long") for k, v in C1_REMAP.items() for x in (k, v)])
    bad = (cp == 0) | (cp > 0x10FFFF) | cp.between(0xD800, 0xDFFF)
    c = F.when(bad, F.lit(0xFFFD).cast("long")).otherwise(F.coalesce(F.element_at(remap, cp), cp))

    def utf16(u):
        return F.lpad(F.hex(u), 4, "0")

    v = c - F.lit(0x10000).cast("long")
    hi = F.shiftright(v, 10) + F.lit(0xD800).cast("long")
    lo = v.bitwiseAND(F.lit(0x3FF).cast("long")) + F.lit(0xDC00).cast("long")
    hexed = F.when(c <= 0xFFFF, utf16(c)).otherwise(F.concat(utf16(hi), utf16(lo)))
    return F.decode(F.unhex(hexed), "UTF-16BE")


def _code_point(ref: Column) -> Column:
    """Value of ``#NN`` or ``#xHH``; past U+10FFFF all are alike."""
    is_hex = F.lower(ref).startswith("#x")
    digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    too_long = F.length(digits) > F.when(is_hex, F.lit(6)).otherwise(F.lit(7))
    n = (F.when(too_long | (digits == ""), F.lit("0")).when(is_hex, F.conv(digits, 16, 10)).otherwise(digits))
    return F.when(too_long, F.lit(0x110000).cast("long")).otherwise(n.cast("long"))


def decode_entities(value: Column) -> Column:
    """Decode character references in one pass, as in an attribute: all numeric
    ones, and the names of the public HTML table, which without ``;`` count only
    if neither a letter, a digit nor ``=`` follows."""
    names = F.str_to_map(F.lit("\x1e".join(f"{k}\x1f{v}" for k, v in html5.items())), F.lit("\x1e"), F.lit("\x1f"))

    def decoded(ref: Column) -> Column:
        name = ref.substr(F.lit(2), F.length(ref))
        return (F.when(ref.startswith("&#"), code_point_text(_code_point(name)))
                .otherwise(F.coalesce(F.element_at(names, name), ref)))

    parts, refs = F.split(value, RE_REF), F.regexp_extract_all(value, F.lit(RE_REF), 0)
    chars = F.concat(F.transform(refs, decoded), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(parts, chars, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(value.contains("&"), joined).otherwise(value)


@built_once
def decoded(name: str) -> Column:
    """``decode_entities`` of the column of this name."""
    return decode_entities(F.col(name))


@built_once
def unquoted(name: str) -> Column:
    """``unquote`` of the column of this name."""
    return unquote(F.col(name))


def href_value(raw: Column) -> Column:
    return decode_entities(unquote(raw))
