"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_upper(col: Column) -> Column:
    return F.upper(F.trim(col))


# spelled out: Java looks single characters up in a bit map, but walks through ranges and \s one by one
_BLANKS = r" \t\n\x0B\f\r"
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_ACCENTED = "áéíóúÁÉÍÓÚñÑ"


def slug(col: Column, keep_accents: bool = False) -> Column:
    """Words joined by underscores; other characters vanish ("Cólera" -> "clera" in ASCII form)."""
    letters = _LETTERS + _ACCENTED if keep_accents else _LETTERS
    kept = F.regexp_replace(col, f"[^{letters}{_BLANKS}]+", "")
    return F.lower(F.regexp_replace(kept, rf"[{_BLANKS}]+", "_"))


def unquote(col: Column) -> Column:
    """Strip one surrounding double quote on each end, then blanks."""
    return F.trim(F.regexp_replace(col, '^"|"$', ""))


def strip_brackets(col: Column) -> Column:
    return F.regexp_replace(col, r"[\[\]]", "")


def zero_padded(col: Column, width: int = 2) -> Column:
    """Left-pad with zeros; longer text stays whole."""
    text = col.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def first_number(col: Column) -> Column:
    """The first run of digits as int ("45 años" -> 45); no digits give NULL."""
    return F.regexp_extract(col, r"\d+", 0).try_cast("int")


def base_name(path: Column) -> Column:
    """The part of a path or address after the last slash, without query or fragment."""
    return F.regexp_extract(path, r"([^/?#]*)(?:[?#].*)?$", 1)


def without_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def year_in_name(name: Column) -> Column:
    """The first four-digit run in a file name as int; none gives NULL."""
    return F.regexp_extract(name, r"\d{4}", 0).try_cast("int")


def fold_accents(col: Column) -> Column:
    return F.translate(col, "ÁÉÍÓÚÜáéíóúü", "AEIOUUaeiouu")
