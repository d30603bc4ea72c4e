"""Column expressions for codes, document numbers and text cleanup."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits(number: Column) -> Column:
    """Whole number as text, without the ``.0`` a double would print."""
    return number.cast("bigint").cast("string")


def pad_cut(number: Column, width: int) -> Column:
    """Zero-padded number; text longer than ``width`` is cut on the right."""
    return F.lpad(digits(number), width, "0")


def pad_grow(number: Column, width: int) -> Column:
    """Zero-padded number that keeps all digits of a longer number."""
    text = digits(number)
    return F.when(F.length(text) > width, text).otherwise(F.lpad(text, width, "0"))


def after_first(number: Column) -> Column:
    """All digits but the first."""
    return F.substr(digits(number), F.lit(2))


def pad_signed(number: Column, width: int) -> Column:
    """Zero-padded number behind the blank kept for its sign."""
    return F.concat(F.lit(" "), pad_grow(number, width))


def short_year(year: Column) -> Column:
    """Last two digits of a four-digit year."""
    return F.substring(digits(year), 3, 2)


def doc_number(number: Column, year: Column, width: int, pad=pad_grow) -> Column:
    """``000123/98``: padded number, slash, short year."""
    return F.concat(pad(number, width), F.lit("/"), short_year(year))


def doc_serial(document: Column) -> Column:
    """The part of a document number before its slash."""
    return F.split(document, "/").getItem(0)


def item_code(group: Column, subgroup: Column, serial: Column) -> Column:
    """``GGG.SSS.III`` catalog code."""
    return F.concat(group, F.lit("."), subgroup, F.lit("."), serial)


def join_loose(*parts: Column) -> Column:
    """Concatenation in which NULL counts as empty text."""
    return F.concat_ws("", *parts)


def join_strict(*parts: Column) -> Column:
    """Concatenation that is NULL when any part is NULL."""
    return F.concat(*parts)


def parse_number(text: Column) -> Column:
    """Number read from text; NULL when the text is not a number."""
    return F.trim(text).try_cast("bigint")


# The letters beyond ASCII and Latin-1 that code page 1252 holds,
# in the order of the code page, then the five control codes that pass through.
CODE_PAGE_EXTRA = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CODE_PAGE_CONTROLS = "\u0081\u008d\u008f\u0090\u009d"

# Only letters beyond ASCII and Latin-1 are looked up in the list of extras, so
# that plain text costs two range checks per letter.
_OUTSIDE = (
    r"[\x{80}-\x{9F}\x{100}-\x{10FFFF}&&[^"
    + "".join(rf"\x{{{ord(c):04X}}}" for c in CODE_PAGE_EXTRA + CODE_PAGE_CONTROLS)
    + "]]"
)


def keep_code_page(text: Column) -> Column:
    """Drop every character that code page 1252 cannot hold; NULL stays NULL."""
    return F.regexp_replace(text, _OUTSIDE, "")


def unheld(text: Column) -> Column:
    """Whether cleanup takes letters out of the text; false for NULL."""
    return F.coalesce(text.rlike(_OUTSIDE), F.lit(False))


def overlong(text: Column, width: int | None) -> Column:
    """Whether the text is longer than a column of ``width`` bytes of the code page, which has one byte a letter."""
    return F.coalesce(F.length(text) > width, F.lit(False)) if width else F.lit(False)


def cut_bytes(text: Column, width: int) -> Column:
    """The longest beginning of the text that takes at most ``width`` bytes of UTF-8; no letter is split.

    For targets in UTF-8, where a letter takes up to four bytes: of the cuts at ``width`` and up to three
    bytes before, the first that ends between letters.
    """
    octets = F.encode(text, "UTF-8")
    cuts = (F.try_validate_utf8(F.substring(octets, 1, width - i).cast("string")) for i in range(min(4, width + 1)))
    return F.when(F.octet_length(text) <= width, text).otherwise(F.coalesce(*cuts))


def clean(text: Column, length: int | None = None) -> Column:
    """Cleaned text, cut to ``length`` characters first when one is given."""
    return keep_code_page(text if length is None else F.substring(text, 1, length))
