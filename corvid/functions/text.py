"""String helpers: path cleanup, label from a fixed slice, lenient number parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_scheme(path, scheme: str = "file:") -> Column:
    """Remove every occurrence of ``scheme`` (default ``file:``) from a path."""
    return F.replace(_c(path), F.lit(scheme), F.lit(""))


def basename(path) -> Column:
    """Last ``/``-separated component of a path or URL."""
    return F.element_at(F.split(_c(path), "/"), -1)


def label_from_text(text, start: int, length: int, value: str) -> Column:
    """1 when ``substring(text, start, length) == value`` else 0 (int, never null).

    ``start`` is 1-based as in SQL.  A string shorter than ``start`` yields the
    empty slice and so label 0; a null input also gives 0.
    """
    hit = F.substring(_c(text), start, length) == F.lit(value)
    return F.when(hit, F.lit(1)).otherwise(F.lit(0)).cast("int")


# A superset of the text Spark's string -> double cast accepts (Java's decimal and
# hex float syntax with an optional f/d suffix, inf/infinity/nan in any case,
# surrounding control/space characters).  Text outside it cannot parse, so it
# is mapped to null without attempting the cast, which for bad text costs a
# thrown and caught exception per value.
_MAYBE_NUMBER = (r"^[\x00-\x20]*[+-]?((?i:nan|inf|infinity)"
                 r"|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?"
                 r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?\d+[fFdD]?)[\x00-\x20]*$")


# The printable characters that can occur in text the cast accepts (digits,
# signs, point, exponent / suffix / hex letters, the letters of inf, infinity
# and nan, space).  The control characters the parser also trims are allowed
# through a pattern test on what is left, so that no control character ends up
# as a literal in the plan.
_NUMBER_CHARS = "0123456789+-.eEdDfFxXpPaAbBcCiInNtTyY "
_TRIM_ONLY = r"^[\x00-\x20]+$"


def parse_double(text) -> Column:
    """Lenient text -> double: null for empty or unparseable text (never raises).

    Non-string input is read as its text (numbers round-trip exactly).

    Same result as ``try_cast(text as double)``, cheaper: digits-only text is cast
    directly (always valid); text with a character outside ``_NUMBER_CHARS`` is
    null at once; the rest must also match ``_MAYBE_NUMBER`` before the cast is
    tried, because a failed cast costs a thrown and caught exception.
    """
    t = _c(text).cast("string")  # typed input: its text (a no-op for strings)
    digits_only = (F.translate(t, "0123456789", "") == F.lit("")) & (t != F.lit(""))
    rest = F.translate(t, _NUMBER_CHARS, "")
    plausible = (rest == F.lit("")) | rest.rlike(_TRIM_ONLY)
    return (F.when(digits_only, t.try_cast("double"))
            .when(plausible & t.rlike(_MAYBE_NUMBER), t.try_cast("double")))
