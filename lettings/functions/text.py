"""Text clean-up with the whitespace and title-case rules of the rental extracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code points that count as white space in the source rules.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _starts_plain(value: Column) -> Column:
    """Byte comparison: the first character is visible ASCII."""
    return (value >= "!") & (value < "\x7f")


def strip(value: Column) -> Column:
    """Without surrounding white space.

    Trimming by a character set costs about a microsecond, so text whose first and last
    characters are visible ASCII, nearly all of it, is passed through.
    """
    plain = _starts_plain(value) & _starts_plain(F.right(value, F.lit(1)))
    return F.when(plain, value).otherwise(F.btrim(value, F.lit(WHITESPACE)))


def is_blank(text: Column) -> Column:
    """For stripped text."""
    return text.isNull() | (text == "")


def single_spaced(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WHITESPACE}]+", " ")


def title_case(text: Column) -> Column:
    """Capital after every non-letter, so ``o'neil-smith`` becomes ``O'Neil-Smith``."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))

    def capital(run: Column) -> Column:
        rest = run.substr(F.lit(2), F.length(run))
        return F.concat(F.upper(run.substr(1, 1)), F.lower(rest))

    return F.array_join(F.transform(runs, capital), "")
