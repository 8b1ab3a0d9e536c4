"""Column-expression helpers.

All helpers return built-in Spark expressions (no Python UDF), so they stay
inside whole-stage code generation.  They encode the null rules of the
modelled pandas code explicitly:

* a prefix / substring test on NULL is *false* (``na=False``),
* the negation of such a test therefore *keeps* NULL rows,
* division by zero gives NULL (ANSI Spark would raise),
* ``sum`` over a group whose values are all NULL gives 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col_", "starts", "not_starts", "has", "not_has", "not_equal_keep_null",
    "safe_div", "period_no", "within_horizon", "period_no_from_word", "period_label", "is_period_label",
    "rint", "round_half_even", "sum0", "cond_sum", "least_strict", "clean_text", "drop_last_char",
    "split_part", "right", "null_of",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def starts(c, prefix: str) -> Column:
    """``startswith(prefix)`` with NULL -> false."""
    return F.coalesce(col_(c).startswith(prefix), F.lit(False))


def not_starts(c, prefix: str) -> Column:
    """Negated prefix test that keeps NULL rows."""
    return ~starts(c, prefix)


def has(c, needle: str) -> Column:
    """Substring test anywhere in the value, NULL -> false."""
    return F.coalesce(col_(c).contains(needle), F.lit(False))


def not_has(c, needle: str) -> Column:
    """Negated substring test (F7); NULL rows are kept."""
    return ~has(c, needle)


def not_equal_keep_null(c, value) -> Column:
    """``~(c == value)`` as pandas evaluates it: NULL rows are kept (F2)."""
    return ~col_(c).eqNullSafe(F.lit(value))


def safe_div(a, b) -> Column:
    """``a / b`` with NULL for a zero or NULL denominator."""
    return F.try_divide(col_(a).cast("double"), col_(b).cast("double"))


def right(c, n: int) -> Column:
    """Last ``n`` characters."""
    return F.right(col_(c), F.lit(n))


def period_no(c) -> Column:
    """Period number as the last two characters of the label (F8).

    ``'Period 07'`` -> 7 and ``'2023'`` -> 23 (so the annual label falls out of
    a ``<= 12`` cutoff).  Non-numeric endings raise under ANSI, as the model
    code does.
    """
    return F.right(col_(c), F.lit(2)).cast("int")


def within_horizon(df: DataFrame, label: str, horizon: int, stored: str = "period_no") -> Column:
    """Rows of the first ``horizon`` periods (F8).

    A table stored with its period number (``sources.tables.by_period``) is
    compared on that column, which the scan can push down; else the number is
    taken from the label of every row.
    """
    return (F.col(stored) if stored in df.columns else period_no(label)) <= horizon


def period_no_from_word(c) -> Column:
    """Period number as the second blank-separated word."""
    return F.split(col_(c), " ").getItem(1).cast("int")


def is_period_label(c) -> Column:
    """True for monthly labels ``'Period <n>'`` (F10); the annual row fails it."""
    return F.coalesce(col_(c).rlike("^Period [0-9]+$"), F.lit(False))


def period_label(n, two_digit: bool = False) -> Column:
    """Label of period number ``n``.

    The model formats with ``'Period 0%d'`` which yields ``'Period 010'`` for
    10 (Q8); ``two_digit=True`` gives ``'Period 10'`` instead.
    """
    n = col_(n)
    if two_digit:
        return F.concat(F.lit("Period "), F.lpad(n.cast("string"), 2, "0"))
    return F.concat(F.lit("Period 0"), n.cast("string"))


def rint(c) -> Column:
    """Round half to even to an integer value (Python ``round``)."""
    return F.rint(col_(c))


def round_half_even(c, scale: int) -> Column:
    """Round to ``scale`` decimals like Python's ``round(x, scale)``.

    Works on the binary value: ``rint(x * 10^scale) / 10^scale``.  Spark's
    ``bround`` rounds the shortest decimal text of the double instead, which
    differs when that text ends exactly in 5 (``129.0603125`` is stored as
    ``129.06031250000000909...`` and rounds up in Python, down in ``bround``).
    """
    m = float(10 ** scale)
    return F.rint(col_(c) * F.lit(m)) / F.lit(m)


def sum0(c) -> Column:
    """pandas-like sum: NULLs skipped, an all-NULL / empty group gives 0."""
    return F.coalesce(F.sum(col_(c)), F.lit(0.0))


def cond_sum(cond: Column, value) -> Column:
    """Conditional sum that is NULL when *no row* satisfies ``cond``.

    This is what a filter + groupby + index alignment gives in pandas: a group
    absent after the filter is NaN, a present group sums with NULLs skipped.
    """
    v = col_(value)
    return F.when(F.count(F.when(cond, F.lit(1))) > 0,
                  F.coalesce(F.sum(F.when(cond, v)), F.lit(0.0)))


def least_strict(a, b) -> Column:
    """Python ``min(a, b)``: returns ``a`` unless ``b < a``; a NULL ``a`` wins.

    Spark ``least`` skips NULLs, which differs when ``a`` is NULL.
    """
    a, b = col_(a), col_(b)
    return F.when(a.isNull(), F.lit(None).cast("double")).when(b < a, b).otherwise(a)


def clean_text(c) -> Column:
    """``&`` -> ``And``, then strip ASCII punctuation."""
    return F.regexp_replace(F.replace(col_(c), F.lit("&"), F.lit("And")), r"\p{Punct}", "")


def drop_last_char(c) -> Column:
    """``left(s, length(s) - 1)``."""
    c = col_(c)
    return F.substring(c, F.lit(1), F.length(c) - 1)


def split_part(c, sep: str, index0: int) -> Column:
    """Part ``index0`` (0-based) of ``c`` split on a literal separator; NULL if absent."""
    return F.get(F.split(col_(c), _regex_literal(sep)), F.lit(index0))


def null_of(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def _regex_literal(s: str) -> str:
    import re
    return re.escape(s)

