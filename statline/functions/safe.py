"""NULL- and ANSI-safe building blocks (pure ``Column`` expressions).

Spark 4 runs in ANSI mode: ``x / 0`` and bad casts raise. Every ratio goes
through ``safe_div`` (``try_divide`` → NULL), every text-to-number through
``try_cast``; NaN is normalised to NULL so ordering and percentiles behave.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` with a zero or NULL denominator giving NULL."""
    return F.try_divide(col(num), col(den))


def per48(num: ColumnOrName, minutes: ColumnOrName) -> Column:
    """Per-48-minute rate: ``num / minutes * 48`` (NULL when minutes is 0)."""
    return safe_div(num, minutes) * 48


def strip_ws(c: ColumnOrName) -> Column:
    """Strip whitespace of every kind at both ends (Spark ``trim`` strips only spaces)."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def nan_to_null(c: ColumnOrName) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def to_double(c: ColumnOrName) -> Column:
    """Lenient numeric coercion: text that is not a number becomes NULL, NaN too."""
    c = col(c)
    return nan_to_null(strip_ws(c.cast("string")).try_cast("double"))


def clamp(x: ColumnOrName, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to ``[lo, hi]``; a NULL input stays NULL.

    Spark's ``least``/``greatest`` skip NULL arguments, so ``greatest(0, NULL)``
    would be 0; the guard keeps missing values missing.
    """
    x = col(x)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out)


def zero_if_missing(c: ColumnOrName) -> Column:
    """NULL, NaN and ±inf become 0 (feature cleaning before modelling)."""
    c = col(c)
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(c.cast("double"))


def season_label(season_start: ColumnOrName) -> Column:
    """Start year → ``YYYY-YY`` season label (sorts chronologically)."""
    s = col(season_start)
    return F.concat(s.cast("string"), F.lit("-"),
                    F.lpad(((s + 1) % 100).cast("string"), 2, "0"))
