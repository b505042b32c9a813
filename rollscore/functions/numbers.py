"""Number checks on an extracted equation.

Python's ``re`` ``\\d`` and ``int()`` accept every Unicode decimal digit; the
digits are first mapped to ASCII with one ``translate`` so that a plain
``[0-9]+`` scan finds the same runs with the same values.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Non-ASCII decimal digits and their ASCII values, built from the Unicode rule
# (``str.isdecimal``) rather than listed.
_NON_ASCII_DIGITS = [chr(c) for c in range(128, sys.maxunicode + 1) if chr(c).isdecimal()]
DIGITS_FROM = "".join(_NON_ASCII_DIGITS)
DIGITS_TO = "".join(str(unicodedata.decimal(ch)) for ch in _NON_ASCII_DIGITS)


def ascii_digits(text) -> Column:
    """Map every Unicode decimal digit to its ASCII digit (pure-ASCII text,
    the common case, skips the lookup: its byte and character lengths agree)."""
    t = as_col(text)
    return F.when(F.octet_length(t) == F.length(t), t).otherwise(F.translate(t, DIGITS_FROM, DIGITS_TO))


def found_numbers(equation) -> Column:
    """All maximal digit runs as BIGINT (signs and decimal points ignored).

    A run too long for BIGINT becomes NULL; such a number can never equal an
    INT task number, which is all the callers need.
    """
    runs = F.regexp_extract_all(ascii_digits(equation), F.lit("[0-9]+"), 0)
    return runs.try_cast("array<bigint>")


def task_numbers(nums) -> Column:
    """The numbers of a task as BIGINT (F2 and F4 cast no further what is stored so)."""
    return as_col(nums).cast("array<bigint>")


def numbers_match(found, nums) -> Column:
    """the multiset of found numbers equals ``nums`` (False on NULLs)."""
    return F.coalesce(
        F.sort_array(as_col(found)) == F.sort_array(task_numbers(nums)), F.lit(False)
    )


def validate_numbers(equation, nums) -> Column:
    """F2 on an equation string."""
    return numbers_match(found_numbers(equation), nums)


def matched_count(found, nums) -> Column:
    """how many found numbers occur in ``nums`` (repeats all count)."""
    n = task_numbers(nums)
    hits = F.filter(as_col(found), lambda x: F.coalesce(F.array_contains(n, x), F.lit(False)))
    return F.coalesce(F.size(hits), F.lit(0))


def distance(result, target) -> Column:
    """F8: ``abs(result - target)``."""
    return F.abs(as_col(result) - as_col(target).cast("double"))


def is_exact(result, target, tol: float = 1e-6) -> Column:
    """F8: exact when the distance is below ``tol`` (NULL result -> False)."""
    return F.coalesce(distance(result, target) < F.lit(tol), F.lit(False))
