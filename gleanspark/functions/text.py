"""Text cleaning as column expressions; everything stays in the JVM."""

import json
from collections.abc import Callable
from functools import cache
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.split() and str.strip() see it.
SPACES = r"(?U)[\s\x1c-\x1f]+"
NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"

# Comments, script and style with their content, then any other tag. Quoted
# attribute values may hold ">". The possessive loops run without recursion, and
# as all begins with one character, most text is passed over at once.
MARKUP = (
    r"(?s)<(?:!--.*?-->"
    r"|((?i:script|style|template))\b[^>]*>.*?(?:</(?i:\1)[^>]*>|\z)"
    r"""|[a-zA-Z/!?][^>=]*+(?:=\s*+(?:"[^"]*"|'[^']*')?[^>=]*+)*+>)"""
)

# Stands where markup was while references are decoded: they end at a tag.
GAP = "\uffff"

REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?"

# Numeric references 128 to 159 mean the windows-1252 character.
_C1 = [n for n in range(128, 160) if bytes([n]).decode("cp1252", "ignore")]
C1_CONTROLS = "".join(map(chr, _C1))
C1_MEANING = bytes(_C1).decode("cp1252")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _escaped(text: str) -> str:
    return "".join(f"\\u{ord(char):04x}" for char in text)


@cache
def _decode_part() -> str:
    """SQL for one part of a text split at ``&``: the reference it starts with, decoded.

    One text, as the same rule built from columns takes hundreds of calls.
    """
    # Every name HTML defines; look-up is in order, so the old names go first.
    names = {name: chr(code) for name, code in name2codepoint.items()}
    names |= {name.rstrip(";"): text for name, text in html5.items()}
    table = json.dumps(names).replace("'", _escaped("'"))
    return rf"""(part, i) -> CASE WHEN i = 0 THEN part ELSE
      transform(array(regexp_extract(part, r'{REFERENCE}', 1)), ref ->
        CASE WHEN ref = '' THEN concat('&', part) ELSE concat(
          CASE
            WHEN ref = 'amp' THEN '&'
            WHEN startswith(ref, '#') THEN
              transform(array(try_cast(
                CASE WHEN lower(substring(ref, 2, 1)) = 'x' THEN conv(substring(ref, 3), 16, 10)
                     ELSE substring(ref, 2) END AS bigint)), code ->
                CASE
                  WHEN code BETWEEN 128 AND 159 THEN translate(
                    decode(unhex(lpad(hex(code), 8, '0')), 'UTF-32'),
                    '{_escaped(C1_CONTROLS)}', '{_escaped(C1_MEANING)}')
                  WHEN code BETWEEN 1 AND 55295 OR code BETWEEN 57344 AND 1114111
                    THEN decode(unhex(lpad(hex(code), 8, '0')), 'UTF-32')
                  ELSE '\ufffd' END)[0]
            ELSE coalesce(
              try_element_at(from_json(r'{table}', 'map<string,string>'), ref),
              concat('&', ref)) END,
          substring(part, length(regexp_extract(part, r'{REFERENCE}', 0)) + 1)) END)[0]
      END"""


def decode_entities(col: Column) -> Column:
    """Decode character references once, left to right.

    ``&amp;lt;`` gives ``&lt;``. An unknown name stays, without its semicolon.
    """
    parts = F.call_function("transform", F.split(col, "&"), F.expr(_decode_part()))
    return F.when(F.contains(col, F.lit("&")), F.array_join(parts, "")).otherwise(col)


def norm_ws(col: Column) -> Column:
    """Strip, and turn every run of white space into one blank."""
    return F.trim(F.regexp_replace(col, SPACES, " "))


def clean_html(col: Column) -> Column:
    """Page or fragment to text: no tags, comments, scripts or styles.

    Text of neighbouring blocks is joined without a separator.
    """
    text = decode_entities(F.regexp_replace(col, MARKUP, GAP))
    return norm_ws(F.replace(text, F.lit(GAP), F.lit("")))


def drop_empty(items: Column) -> Column:
    return F.filter(items, lambda x: x != "")


def drop_blank(items: Column) -> Column:
    """Drop items that are blank after stripping; the rest keep their blanks."""
    return F.filter(items, lambda x: x.rlike(NOT_SPACE))


def ordered_distinct(items: Column) -> Column:
    """First occurrence of each item, in order."""
    return F.array_distinct(items)


def remove_contained(items: Column) -> Column:
    """Drop an item that is part of a different item; equal and null items stay.

    Quadratic in the array, so meant for a few hundred fragments. Longer arrays
    go through ``operators.containment.remove_contained_items``, groups that
    arrive as rows through ``remove_contained_rows``.
    """

    def contained(x: Column, all_items: Column) -> Column:
        inside = F.exists(all_items, lambda y: (x != y) & F.contains(y, x))
        # A null item leaves it open whether it holds this.
        return F.coalesce(inside, F.lit(False))

    return let(
        items, lambda all_items: F.filter(all_items, lambda x: ~contained(x, all_items))
    )


def clean_description(items: Column) -> Column:
    """Clean each fragment, drop empty, repeated and contained ones, join lines.

    For pages with thousands of fragments take ``description_parts`` and
    ``operators.containment.remove_contained_items``.
    """
    return F.array_join(remove_contained(description_parts(items)), "\n")


def description_parts(items: Column) -> Column:
    """The fragments cleaned, without empty and repeated ones."""
    return ordered_distinct(drop_empty(F.transform(items, clean_html)))


def dedup_lines(col: Column) -> Column:
    """Keep the first of equal lines; blank lines collapse to one as well."""
    return F.array_join(ordered_distinct(F.split(col, "\n")), "\n")


def strip_bullet(col: Column) -> Column:
    """Cut the two-character bullet in front of a job type."""
    return F.substring(col, 3, 2**31 - 1)
