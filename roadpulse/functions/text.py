"""Text columns for region names."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points of the Latin, Greek and Cyrillic blocks whose letters carry accents.
BLOCKS = ((0x00C0, 0x0250), (0x0370, 0x0530), (0x1E00, 0x2000))


def _plain_letters() -> tuple[str, str]:
    """Letters that decompose into one letter and marks, and those letters, same positions."""
    accented, plain = [], []
    for first, last in BLOCKS:
        for letter in map(chr, range(first, last)):
            base = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c))
            if base != letter and len(base) == 1:
                accented.append(letter)
                plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, PLAIN = _plain_letters()
#: Marks that stand alone, from texts that are decomposed already.
MARKS = "[\\u0300-\\u036f]+"


def strip_accents(col: Column) -> Column:
    """Text without accents, by canonical decomposition."""
    return F.regexp_replace(F.translate(col, ACCENTED, PLAIN), MARKS, "")


def slug(name: Column, prefix: Column | str | None = None) -> Column:
    """Lower-case, accent-free, blanks as underscores, optional prefix."""
    body = F.replace(F.lower(strip_accents(name)), F.lit(" "), F.lit("_"))
    if prefix is None:
        return body
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat_ws("_", head, body)


def unquote(col: Column) -> Column:
    return F.replace(col, F.lit('"'), F.lit(""))
