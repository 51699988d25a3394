"""Arithmetic of growth rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear_points(value: Column, k: float = 0.1, cap: int = 30, least: float = 20.0, multiplier: Column | float = 1.0, sign: int = 1) -> Column:
    """Points of a percentage: trunc(value * k), at most cap, times the multiplier rounded up; null if it does not count."""
    k, cap = k or 0.1, cap or 30
    m = multiplier if isinstance(multiplier, Column) else F.lit(float(multiplier))
    base = F.least((value * k).cast("int"), F.lit(cap))
    return F.when((value >= least) & (base > 0), sign * F.greatest(F.lit(1), F.ceil(base * m).cast("int")))


def step_points(value: Column, steps: list[tuple[float, int]], multiplier: float = 1.0, sign: int = 1) -> Column:
    """Points of the largest threshold that value reaches; null below all of them or for no points."""
    out = F.lit(None).cast("int")
    for ge, score in sorted(steps):
        out = F.when(value >= ge, F.lit(score)).otherwise(out)
    return F.when(out > 0, sign * F.greatest(F.lit(1), F.ceil(F.abs(out) * multiplier).cast("int")))


def short_number(v: Column) -> Column:
    """A number without needless zeros: 25.50 -> 25.5, 30.0 -> 30 (six significant digits are not exceeded by percentages)."""
    s = F.format_string("%.6f", v)
    return F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def negated(points: Column, ratio: float = 0.5) -> Column:
    """Points that turn against: a share of them, 1 at least."""
    return -F.greatest(F.lit(1), (F.abs(points) * ratio).cast("int"))


def digit_share(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\d")) / F.greatest(F.length(text), F.lit(1))


def industry_multiplier(industries: Column, entries: list[tuple[tuple[str, ...], float]]) -> Column:
    """The smallest multiplier whose industry fits one of the array's (equal, or one contains the other); 1 without any."""
    some = F.filter(F.transform(F.coalesce(industries, F.array().cast("array<string>")), lambda i: F.trim(i)), lambda h: h != "")
    out = F.lit(1.0)
    for names, m in entries:
        if m > 0:
            fits = F.lit(False)
            for n in (n.strip() for n in names if n.strip()):
                fits = fits | F.exists(some, _fits(n))
            out = F.least(out, F.when(fits, F.lit(float(m))).otherwise(1.0))
    return out


def _fits(name: str):
    return lambda h: F.contains(h, F.lit(name)) | F.contains(F.lit(name), h)
