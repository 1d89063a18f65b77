"""Scores, blends and colours as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from walkgrid.constants import CATEGORIES, COLOR_STOPS, DEFAULT_WEIGHTS, SCORE_KNOTS


def present(x: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(x), x)


def distance_score(distance: Column, knots: Sequence[tuple[float, float]] = SCORE_KNOTS) -> Column:
    """Piecewise-linear score of a distance: flat before the first knot, 0 past the last or when missing."""
    d = present(distance)
    expr = F.when(d <= knots[0][0], F.lit(float(knots[0][1])))
    for (d0, s0), (d1, s1) in zip(knots, knots[1:]):
        expr = expr.when(d <= d1, (d - d0) * ((s1 - s0) / (d1 - d0)) + s0)
    return expr.otherwise(0.0)


def check_weights(weights: Mapping[str, float]) -> dict[str, float]:
    unknown = set(weights) - set(CATEGORIES)
    if unknown:
        raise ValueError(f"unknown categories {sorted(unknown)}; expected {list(CATEGORIES)}")
    full = {**DEFAULT_WEIGHTS, **weights}
    if sum(full.values()) <= 0:
        raise ValueError(f"weights must sum > 0, got {full}")
    return full


def blend(weights: Mapping[str, float] | None = None, column=lambda c: F.col(f"score_{c}")) -> Column:
    """Weighted mean of the category scores; weights not given keep their default."""
    full = check_weights(weights or {})
    total = sum(column(c) * float(full[c]) for c in CATEGORIES)
    return total / sum(full.values())


def custom_blend(
    chosen: Sequence[str], weights: Mapping[str, float] = DEFAULT_WEIGHTS, overall: Column | None = None
) -> Column:
    """Weighted mean over the chosen categories, skipping missing scores and weights <= 0.

    All categories chosen, none chosen or none usable: the stored overall score.
    """
    overall = F.col("livability") if overall is None else overall
    usable = [c for c in CATEGORIES if c in set(chosen) and weights[c] > 0]
    if not usable or set(chosen) >= set(CATEGORIES):
        return overall
    score = {c: present(F.col(f"score_{c}")) for c in usable}
    total = sum(F.coalesce(score[c] * float(weights[c]), F.lit(0.0)) for c in usable)
    weight = sum(F.when(score[c].isNotNull(), float(weights[c])).otherwise(0.0) for c in usable)
    return F.when(weight > 0, F.try_divide(total, weight)).otherwise(overall)


def score_color(score: Column) -> Column:
    """``rgb(r,g,b)`` of a 0-100 score on the five-stop ramp; clamped, missing counts as 0."""
    s = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(present(score), F.lit(0.0))))

    def channel(i: int) -> Column:
        expr = None
        for left, right in zip(COLOR_STOPS, COLOR_STOPS[1:]):
            share = (s - left[0]) / (right[0] - left[0])
            value = F.floor(share * (right[i] - left[i]) + left[i] + 0.5)
            expr = F.when(s <= right[0], value) if expr is None else expr.when(s <= right[0], value)
        return expr.cast("string")

    return F.concat(F.lit("rgb("), channel(1), F.lit(","), channel(2), F.lit(","), channel(3), F.lit(")"))
