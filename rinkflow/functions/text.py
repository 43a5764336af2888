"""Text columns: encoding repair, names, keys and blanks."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def fix_encoding(c) -> Column:
    """Undo UTF-8 text that was read as Latin-1 (``JÃ¶rgen`` -> ``Jörgen``).

    Text that does not look damaged, holds characters outside Latin-1 or does
    not decode to valid UTF-8 is kept as it is.
    """
    c = _col(c)
    # (?U): a no-break space is a space too.
    damaged = c.rlike("(?U)" + fixed.MOJIBAKE_PATTERN) & c.rlike("^[\\x{00}-\\x{FF}]*$")
    repaired = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.when(damaged, F.coalesce(repaired, c)).otherwise(c)


def underscore(c) -> Column:
    """Every space becomes an underscore."""
    return F.translate(_col(c), " ", "_")


def full_name(first, last) -> Column:
    """``first`` + ``_`` + ``last`` with its spaces underscored; NULL is blank."""
    return F.concat(
        F.coalesce(_col(first), F.lit("")),
        F.lit("_"),
        F.coalesce(underscore(last), F.lit("")),
    )


def given_name(c) -> Column:
    """Text before the first underscore, or all of it."""
    return F.substring_index(_col(c), "_", 1)


def family_name(c) -> Column:
    """Text after the first underscore, blank if there is none."""
    c = _col(c)
    return F.coalesce(F.get(F.split(c, "_", 2), F.lit(1)), F.when(c.isNotNull(), ""))


def normalize_name(c) -> Column:
    """Lower case with everything but a-z dropped (accents are not folded)."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z]", "")


def decode_gender(c) -> Column:
    """``F`` -> ``Women``, ``M`` -> ``Men``; anything else stays."""
    c = _col(c)
    out = c
    for code, name in fixed.GENDER_NAMES.items():
        out = F.when(c == code, name).otherwise(out)
    return out


def gender_num(c) -> Column:
    """``Men`` -> 0, ``Women`` -> 1, else NULL."""
    c = _col(c)
    out = F.lit(None).cast("int")
    for name, number in fixed.GENDER_NUMBERS.items():
        out = F.when(c == name, number).otherwise(out)
    return out


def sanitize_name(c) -> Column:
    """Trim, upper case, spaces to underscores, only A-Z 0-9 and underscore."""
    spaced = F.translate(F.upper(F.trim(_col(c))), " ", "_")
    return F.regexp_replace(spaced, "[^A-Z0-9_]", "")


def name_prefix(c, length=fixed.PARTIAL_FAMILY_LENGTH) -> Column:
    return F.substring(_col(c), 1, length)


def upper_country(c) -> Column:
    return F.upper(_col(c))


def is_digits(c) -> Column:
    """Non-empty and digits only; NULL counts as no."""
    return F.coalesce(_col(c).rlike("^[0-9]+$"), F.lit(False))


def trim_or_empty(c) -> Column:
    """Join keys: trimmed, NULL as blank."""
    return F.trim(F.coalesce(_col(c), F.lit("")))


def default_blank(c) -> Column:
    """NULL as blank text, for text sinks only."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def has_text(c) -> Column:
    """Not NULL and not blank."""
    return F.coalesce(_col(c) != "", F.lit(False))
