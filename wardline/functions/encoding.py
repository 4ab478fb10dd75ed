"""Flags, codes and small numeric expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order of the three severity levels.
SEVERITY_ORDER = {"Low": -1, "Medium": 0, "High": 1}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_flag(col: Column | str) -> Column:
    """1 where a value is present, 0 where it is missing."""
    return _col(col).isNotNull().cast("int")


def equals_flag(col: Column | str, value: object) -> Column:
    """1 where the column equals ``value``; null counts as 0."""
    return F.coalesce(_col(col) == F.lit(value), F.lit(False)).cast("long")


def ordinal_encode(col: Column | str, mapping: Mapping[str, int] = SEVERITY_ORDER) -> Column:
    """Replace listed levels by their number; other values stay as they are (as text)."""
    c = _col(col)
    out = c.cast("string")
    for level, number in mapping.items():
        out = F.when(c == level, F.lit(str(number))).otherwise(out)
    return out


def total_alerts(flags: Sequence[Column | str]) -> Column:
    """Sum of 0/1 flags."""
    first, *rest = [_col(f) for f in flags]
    for flag in rest:
        first = first + flag
    return first


def safe_ln(col: Column | str) -> Column:
    """Natural logarithm, 0 for 0."""
    c = _col(col)
    return F.when(c != 0, F.ln(c)).when(c == 0, F.lit(0.0))


def class_confidence(probability: Column | str, labels: Sequence[str]) -> tuple[Column, Column]:
    """Label of the most likely class and its probability as ``"12.3%"`` text.

    ``probability`` is an array with one entry per label; the first of equal maxima wins.
    """
    p = _col(probability)
    best = F.array_max(p)
    position = F.array_position(p, best)
    names = F.array(*[F.lit(x) for x in labels])
    label = F.when(best.isNotNull(), F.element_at(names, position.cast("int")))
    return label, F.format_string("%.1f%%", best * 100)


def dynamic_threshold(
    n: Column | str, pars: Sequence[float] = (5, 100, 10, 37.5), floor: float | None = None
) -> Column:
    """Required percentage at ``n`` rows: the line through ``(n1, d1)`` and ``(n2, d2)``."""
    n1, d1, n2, d2 = pars
    slope = (d2 - d1) / (n2 - n1)
    line = _col(n) * F.lit(float(slope)) + F.lit(float(d1 - slope * n1))
    return line if floor is None else F.greatest(line, F.lit(float(floor)))
