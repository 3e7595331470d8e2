"""Column-level functions: safe arithmetic, metric formulas, rule classifiers."""

from . import metrics, rules, safe  # noqa: F401
from .safe import clamp, safe_div, season_label, strip_ws, to_double, zero_if_missing  # noqa: F401
