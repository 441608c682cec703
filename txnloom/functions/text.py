"""Column expressions for payload text: field splitting, trimming, coercion.

Every cast here is a ``try_cast`` or an explicit error, so the result does not
depend on the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space or separators.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Stand for a cut, and for the first of their own characters where a line holds it.
_CUT, _ESCAPE, _ESCAPED = "\x1e1", "\x1e", "\x1e0"


def split_csv_line(line: Column) -> Column:
    """Split a line at commas that an even number of double quotes follows, keeping the quotes.

    Looking ahead from each comma rescans the line and recurses on its quotes. Here quotes
    are counted from the end instead: all of them less those before. The line is cut at its
    quotes once, and commas count in every second piece, the last one among them. So the time
    is linear for any line, with unpaired quotes, line breaks or any other character.
    """
    safe = F.when(F.contains(line, F.lit(_ESCAPE)), F.replace(line, F.lit(_ESCAPE), F.lit(_ESCAPED)))
    pieces = F.split(F.coalesce(safe, line), '"')

    def cut(parity: int) -> Column:
        # a literal: what does not depend on the piece would be computed anew for each
        marked = F.transform(
            pieces,
            lambda piece, i: F.when(
                i.bitwiseAND(F.lit(1)) == parity, F.replace(piece, F.lit(","), F.lit(_CUT))
            ).otherwise(piece),
        )
        return F.array_join(marked, '"')

    paired = F.size(pieces).bitwiseAND(F.lit(1)) == 1
    marked = F.when(paired, cut(0)).otherwise(cut(1))
    fields = F.split(marked, _CUT)
    restored = F.transform(fields, lambda field: F.replace(field, F.lit(_ESCAPED), F.lit(_ESCAPE)))
    return (
        F.when(~F.contains(line, F.lit('"')), F.split(line, ","))
        .when(~F.contains(line, F.lit(_ESCAPE)), fields)
        .otherwise(restored)
    )


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of every kind, not only spaces."""
    return F.trim(text, F.lit(WHITE_SPACE))


def to_float(text: Column) -> Column:
    return text.try_cast("float")


def to_int(text: Column) -> Column:
    """Integer part of a plain decimal numeral; null for anything else.

    ``12.7`` gives 12. Exponents, type suffixes and values outside 32 bits give
    null, as a non-ANSI string-to-int cast does.
    """
    plain = text.rlike(r"^\s*[+-]?\d*\.?\d*\s*$")
    return F.when(plain, text.try_cast("double").try_cast("int"))


def to_bool(text: Column) -> Column:
    """``true/t/yes/y/1`` and ``false/f/no/n/0`` in any case; null for anything else."""
    return text.try_cast("boolean")


def is_literal_true(text: Column) -> Column:
    """True only for the word ``true`` in any case; junk is false, null stays null."""
    return F.lower(text) == "true"


def strict_double(text: Column, name: str) -> Column:
    """Parse a number or fail the job, null and empty text included."""
    shown = F.coalesce(text, F.lit("NULL"))
    failure = F.raise_error(F.concat(F.lit(f"{name} is not a number: "), shown))
    suffixed = text.rlike(r"[0-9.]\s*[dDfF]\s*$")  # a literal's type, not part of a number
    return F.coalesce(F.when(~suffixed, text.try_cast("double")), failure.cast("double"))
