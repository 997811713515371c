"""Stripped text to typed values. Each parser yields NULL for text that is not a valid literal.

Spark's own casts accept more than the source rules do (``2024`` as a date, a timestamp
without an offset), so where that matters the shape is checked first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_SHAPE = r"^[+-]?[0-9]+(_[0-9]+)*$"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
#: Date and time with offset: dashes and colons may be left out together, minutes and seconds as
#: well; a fraction may have any number of digits.
TIMESTAMP_SHAPE = (
    r"^(?:([0-9]{4})-([0-9]{2})-([0-9]{2})|([0-9]{4})([0-9]{2})([0-9]{2}))[^0-9]"
    r"([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?"
    r"(?:Z|([+-])([0-9]{2}):?([0-9]{2})?)$"
)
#: The usual form of it, which Spark's own cast reads.
PLAIN_TIMESTAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?"
    r"(Z|[+-][0-9]{2}:[0-9]{2})$"
)
LONG_FRACTION = r"^[+-]?[0-9]*[.][0-9]{18,}$"


def _no_underscores(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def integer_shaped(text: Column) -> Column:
    return text.try_cast("bigint").isNotNull() | text.rlike(INTEGER_SHAPE)


def to_integer(text: Column) -> Column:
    """NULL also for integers beyond 32 bits; use ``integer_shaped`` to tell them apart."""
    grouped = F.when(text.rlike(INTEGER_SHAPE), _no_underscores(text).try_cast("int"))
    return F.coalesce(text.try_cast("int"), grouped)


def to_cents(text: Column) -> Column:
    """A finite decimal rounded half-even to two places.

    Digits far behind the point only decide whether a half is exactly one: they are replaced by a
    single digit that says whether any of them is not zero.
    """
    bare = _no_underscores(text)
    rest = F.regexp_replace(bare, r"^[+-]?[0-9]*[.][0-9]{17}", "")
    shortened = F.concat(
        F.regexp_extract(bare, r"^([+-]?[0-9]*[.][0-9]{17})", 1),
        F.when(rest.rlike("[1-9]"), F.lit("1")).otherwise(F.lit("0")),
    )
    readings = [
        F.when(bare.rlike(LONG_FRACTION), shortened.try_cast("decimal(38,18)")),
        text.try_cast("decimal(38,18)"),
        bare.try_cast("decimal(38,10)"),
    ]
    # Rounded one by one: a common type of both scales would lose digits.
    return F.coalesce(*[F.bround(number, 2).cast("decimal(38,2)") for number in readings])


def to_date(text: Column) -> Column:
    """``YYYY-MM-DD``, or the compact ``YYYYMMDD``."""
    dashed = F.when(text.rlike(DATE_SHAPE) & (text >= "0001"), text.try_cast("date"))
    compact = F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2))
    undashed = F.when(text.rlike("^[0-9]{8}$") & (text >= "0001"), compact.try_cast("date"))
    return F.coalesce(dashed, undashed)


def to_instant(text: Column) -> Column:
    """An ISO timestamp that names its offset; digits beyond microseconds are cut off."""

    def part(number: int) -> Column:
        return F.regexp_extract(text, TIMESTAMP_SHAPE, number)

    def filled(number: int, value: str = "00") -> Column:
        return F.coalesce(F.nullif(part(number), F.lit("")), F.lit(value))

    date = F.concat_ws("-", *[F.concat(part(i), part(i + 3)) for i in (1, 2, 3)])
    time = F.concat_ws(":", part(7), filled(8), filled(9))
    fraction = F.concat(F.lit("."), filled(10, "0").substr(1, 6))
    local = F.concat(date, F.lit("T"), time, fraction, F.lit("Z")).try_cast("timestamp")
    hours, minutes = filled(12).cast("int"), filled(13).cast("int")
    offset = F.when((hours < 24) & (minutes < 60), (hours * 60 + minutes).cast("long") * 60_000_000)
    signed = F.when(part(11) == "-", -offset).otherwise(offset)
    general = F.when(
        text.rlike(TIMESTAMP_SHAPE), F.timestamp_micros(F.unix_micros(local) - signed)
    )
    plain = F.when(text.rlike(PLAIN_TIMESTAMP), text.try_cast("timestamp"))
    return F.when(text >= "0001", F.coalesce(plain, general))
