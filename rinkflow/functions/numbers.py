"""Numbers, dates and times held in text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rinkflow.functions.text import _col

_DECIMAL = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INTEGER = "^[+-]?[0-9]+$"


def to_double(c) -> Column:
    """A plain decimal number, else NULL."""
    c = F.trim(_col(c).cast("string"))
    return F.when(c.rlike(_DECIMAL), c.try_cast("double"))


def to_integer(c) -> Column:
    """A plain whole number, else NULL."""
    c = F.trim(_col(c).cast("string"))
    return F.when(c.rlike(_INTEGER), c.try_cast("bigint"))


def rounded(c, digits=2) -> Column:
    """Round the exact binary value of a column, ties to even.

    ``F.round`` works on the shortest decimal text of a double and so takes
    2.675 (really 2.67499...) up.  Here the rounding error of ``c * 10^digits``
    is recovered by splitting the factors, so a product that looks like a tie
    can be told from a true one.  ``c`` is used many times: pass a column, and
    an expression to ``round_half_even``.  From 2^46 on, neighbouring doubles
    are farther apart than a hundredth, so the value is its own rounding; below
    it the product stays far from overflow.
    """
    c = _col(c)
    scale = F.lit(float(10**digits))
    product = c * scale
    split = c * F.lit(134217729.0)
    high = split - (split - c)
    error = (high * scale - product) + (c - high) * scale
    floor = F.floor(product)
    part = product - floor
    tie_up = (error > 0) | ((error == 0) & (floor % 2 != 0))
    up = (part > 0.5) | ((part == 0.5) & tie_up)
    # The other branch is not evaluated for large numbers, whose floor does not fit 64 bits.
    return F.when(F.abs(c) >= float(2**46), c).otherwise((floor + up.cast("int")) / scale)


def round_half_even(c, digits=2) -> Column:
    """``rounded`` for an expression, evaluated once."""
    return F.get(F.transform(F.array(_col(c)), lambda x: rounded(x, digits)), F.lit(0))


def parse_stamp(c) -> Column:
    """Date-time text -> wall-clock timestamp.

    Reads ISO text (an offset is ignored, a ``Z`` removed) or ``d-m-Y``; other
    text gives NULL.
    """
    c = F.replace(_col(c), F.lit("Z"), F.lit(""))
    iso = F.when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), c.try_cast("timestamp_ntz"))
    day_first = F.when(
        c.rlike("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), F.try_to_date(c, "d-M-yyyy")
    )
    return F.coalesce(iso, day_first.cast("timestamp_ntz"))


def stamp_date(c) -> Column:
    """Date of a date-time text, NULL if it has none."""
    return parse_stamp(c).cast("date")


def stamp_time(c) -> Column:
    """Time of day ``HH:mm:ss`` of a date-time text that has a ``T``."""
    clock = F.date_format(parse_stamp(c), "HH:mm:ss.SSSSSS")
    return F.when(
        F.contains(_col(c), F.lit("T")), F.regexp_replace(clock, "\\.000000$", "")
    )


def unrounded_seconds(c) -> Column:
    """``time_to_seconds`` before rounding."""
    c = F.trim(_col(c))
    dots, colons = F.split(c, "\\."), F.split(c, ":")
    has = lambda sign: F.contains(c, F.lit(sign))
    minutes = lambda parts: to_integer(F.get(parts, F.lit(0))) * 60
    rest = lambda parts: to_double(F.translate(F.get(parts, F.lit(1)), ",", "."))
    return (
        F.when(has(".") & has(","), minutes(dots) + rest(dots))
        .when(has(","), to_double(F.translate(c, ",", ".")))
        .when(has(":"), F.when(F.size(colons) == 2, minutes(colons) + rest(colons)))
        .otherwise(to_double(c))
    )


def time_to_seconds(c) -> Column:
    """Race time text -> seconds with two decimals.

    ``1.11,55`` (minutes, seconds), ``36,07``, ``4:00.393`` or a plain number;
    anything else is NULL.
    """
    return round_half_even(unrounded_seconds(c))


def with_seconds(df, text, out):
    """``time_to_seconds`` as a column of ``df``, in two compiled steps."""
    return df.withColumn("_seconds", unrounded_seconds(text)).withColumn(
        out, rounded("_seconds")
    ).drop("_seconds")


def first_integer(c) -> Column:
    """First run of digits in a text, as a number."""
    return F.regexp_extract(_col(c), "([0-9]+)", 1).try_cast("bigint")


def distance_of(c) -> Column:
    """Digits of the first ``<digits>m`` in a text, as text."""
    return F.nullif(F.regexp_extract(_col(c), "([0-9]+)m", 1), F.lit(""))


def hour_of(c) -> Column:
    """Whole number before the first colon."""
    c = _col(c)
    return F.when(F.contains(c, F.lit(":")), to_integer(F.split_part(c, F.lit(":"), F.lit(1))))


def to_int_via_float(c) -> Column:
    """``3.7`` -> 3: whole part of a number text, NULL if it is none."""
    return to_double(c).try_cast("bigint")


def day_first_date(c) -> Column:
    """Date from ``dd-mm-yyyy`` or ``yyyy-mm-dd`` text."""
    return stamp_date(c)


def date_text_is_valid(c) -> Column:
    """A real ``yyyy-mm-dd`` date."""
    c = _col(c)
    return F.coalesce(
        c.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
        & F.try_to_date(c, "yyyy-M-d").isNotNull(),
        F.lit(False),
    )


def format_2dp(c) -> Column:
    """``%.2f`` text."""
    text = F.format_string("%.2f", round_half_even(c))
    return F.when(_col(c).isNotNull(), text)


def hour_key(date, hour) -> Column:
    """``yyyy-mm-ddThh:00``."""
    text = F.format_string("%sT%02d:00", _col(date).cast("string"), _col(hour))
    return F.when(_col(date).isNotNull() & _col(hour).isNotNull(), text)


def year_of_text(c) -> Column:
    """Text before the first hyphen."""
    return F.split_part(_col(c), F.lit("-"), F.lit(1))
