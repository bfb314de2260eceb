"""Integer text as Python's ``int()`` reads it, and fail-fast checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits with single underscores between them, optional sign, outer spaces.
_UNDERSCORED_INT_RX = r"^\s*[+-]?[0-9]+(?:_[0-9]+)+\s*\z"


def _underscored(text: Column) -> Column:
    return F.when(text.rlike(_UNDERSCORED_INT_RX), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))


def _plain(text: Column) -> Column:
    """``try_cast`` of text without an underscore, which it never takes: a cast
    that fails costs many times one that does not, so known failures skip it."""
    return F.when(~F.contains(text, F.lit("_")), text.try_cast("bigint"))


def parse_int_text(text: Column) -> Column:
    """Integer text to ``BIGINT``; null when it is not an integer.

    ``try_cast`` already takes outer spaces, a sign and leading zeros, and
    rejects ``5.0``; only the ``1_000`` form needs the pattern. ``coalesce``
    stops at its first non-null argument, so the pattern runs only on text
    the plain cast rejects.
    """
    return F.coalesce(_plain(text), _underscored(text))


def int_or_fail(text: Column, name: str) -> Column:
    """``parse_int_text`` that stops the query on a bad value, naming it.
    One ``try_cast`` per value on the common path."""
    message = F.concat(
        F.lit(f"invalid literal for int() in {name}: '"),
        F.coalesce(text, F.lit("")),
        F.lit("'"),
    )
    return F.coalesce(_plain(text), _underscored(text), F.raise_error(message).cast("bigint"))


# Digits, single underscores between them, optional sign, outer spaces.
_INT_RX = r"^\s*[+-]?[0-9]+(?:_[0-9]+)*\s*\z"
#: The widest whole numbers Spark holds: 38 digits.
WIDE = "decimal(38,0)"


def wide_int_or_fail(text: Column, name: str) -> Column:
    """Integer text to ``DECIMAL(38,0)``, as ``int()`` reads it up to 38 digits;
    the query stops on any other value, naming it. Text of up to 18 bytes takes
    one ``try_cast`` to 64 bits; only longer or underscored text meets the pattern,
    before any cast that would fail on it."""
    message = F.concat(F.lit(f"invalid literal for int() of 38 digits in {name}: '"), F.coalesce(text, F.lit("")), F.lit("'"))
    return F.coalesce(
        F.when(F.octet_length(text) <= 18, _plain(text)).cast(WIDE),
        F.when(text.rlike(_INT_RX), F.replace(text, F.lit("_"), F.lit("")).try_cast(WIDE)),
        _plain(text).cast(WIDE),
        F.raise_error(message).cast(WIDE),
    )


def ansi_enabled(spark) -> bool:
    return str(spark.conf.get("spark.sql.ansi.enabled", "true")).lower() == "true"


def checked_sum(value: Column, name: str, ansi: bool) -> Column:
    """A ``BIGINT`` or ``DECIMAL(38,0)`` sum that fails on overflow. With ANSI on, ``sum`` raises
    by itself and keeps one buffer field; otherwise ``try_sum`` (two fields),
    to be passed through ``overflow_check`` after the aggregate."""
    return (F.sum(value) if ansi else F.try_sum(value)).alias(name)


def overflow_check(total: Column, name: str) -> Column:
    """Pass a ``try_sum`` result through, or stop the query when it overflowed.

    ``try_sum`` carries an overflow through the partial and the final
    aggregate as null, whatever the ANSI setting; the summed values are
    never null, so a null total means overflow.
    """
    return F.when(
        total.isNull(), F.raise_error(F.lit(f"overflow in the sum of {name}: BIGINT, or 38 digits of wide integers"))
    ).otherwise(total)
