"""Text to values."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_from_text(text: Column) -> Column:
    """`₩ 19,500` as 19500; text that is no price gives NULL."""
    return F.trim(F.regexp_replace(text, "[₩,]", "")).try_cast("int")


#: References that most texts have no others than, looked at before the table of all names.
COMMON = {"amp": 38, "lt": 60, "gt": 62, "quot": 34, "nbsp": 160, "apos": 39}


def _code_point(reference: Column) -> Column:
    """The code point that a reference, what stands between & and ;, names; NULL if it names none."""
    decimal = F.regexp_extract(reference, r"^#(\d{1,7})$", 1).try_cast("int")
    hexadecimal = F.conv(F.nullif(F.regexp_extract(reference, r"^#[xX]([0-9A-Fa-f]{1,6})$", 1), F.lit("")), 16, 10).try_cast("int")
    names = F.create_map(*[F.lit(x) for pair in name2codepoint.items() for x in pair])
    found = F.when(F.startswith(reference, F.lit("#")), F.coalesce(decimal, hexadecimal))
    for name, code in COMMON.items():
        found = found.when(reference == name, F.lit(code))
    return found.otherwise(F.try_element_at(names, reference))


def _character(number: Column) -> Column:
    known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    latin = F.when(number < 128, F.char(number))
    return F.when(known, F.coalesce(latin, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def plain_text(html: Column) -> Column:
    """Markup taken out, character references decoded once, outer white space trimmed.

    A reference that names no character stays as it is. No-break spaces become spaces.
    Text without references is not taken apart.
    """
    bare = F.regexp_replace(html, r"<[^>]*>", "")

    def decoded(piece: Column) -> Column:
        def with_reference(reference: Column) -> Column:
            rest = F.substr(piece, F.length(reference) + 3)
            character = _once(_code_point(reference), _character)
            return F.when(reference == "", piece).otherwise(F.coalesce(F.concat(character, rest), piece))

        found = _once(F.regexp_extract(piece, r"^&(#?\w+);", 1), with_reference)
        return F.when(F.startswith(piece, F.lit("&")), found).otherwise(piece)

    text = F.array_join(F.transform(F.split(bare, "(?=&)"), decoded), "")
    text = F.when(F.contains(bare, F.lit("&")), text).otherwise(bare)
    return F.regexp_replace(F.translate(text, "\u00a0", " "), r"^\s+|\s+$", "")


def trailing_numbers(text: Column) -> Column:
    """Whole numbers in the text, last one first, thousands separators dropped."""
    digits = F.regexp_extract_all(F.regexp_replace(text, ",", ""), F.lit(r"(\d+)"), F.lit(1))
    return F.transform(F.reverse(digits), lambda n: n.try_cast("bigint"))
