"""Dunning's G² log-likelihood ratio as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how far a probability is kept from 0 and from 1.
MARGIN = 1e-15


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` by the IEEE rules: x/0 is an infinity, 0/0 is NaN.

    Spark raises (ANSI) or gives NULL for a zero divisor; scores need the value.
    """
    top, bottom = top.cast("double"), bottom.cast("double")
    by_zero = (
        F.when(top > 0, F.lit(float("inf")))
        .when(top < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.coalesce(F.try_divide(top, bottom), by_zero)


def log_likelihood(hits: Column, trials: Column, chance: Column) -> Column:
    """Binomial log-likelihood of ``hits`` in ``trials`` at ``chance``.

    The chance is kept inside (0, 1). NaN has to be let through first: Spark
    orders NaN above every number, so it would otherwise count as "too large".
    """
    inside = (
        F.when(F.isnan(chance), chance)
        .when(chance <= 0, F.lit(MARGIN))
        .when(chance >= 1, F.lit(1 - MARGIN))
        .otherwise(chance)
    )
    return hits * F.log(inside) + (trials - hits) * F.log(F.lit(1.0) - inside)


def likelihood_terms(c1: Column, c2: Column, c12: Column, n: Column) -> dict[str, Column]:
    """The four log-likelihoods G² is made of.

    ``dep_*``: the second word's chance depends on whether the first one stands
    before it; ``ind_*``: it has one chance everywhere. ``*_with`` looks at the
    places after the first word, ``*_without`` at all others.
    """
    rest_hits, rest = c2 - c12, n - c1
    overall = ratio(c2, n)
    return {
        "dep_with": log_likelihood(c12, c1, ratio(c12, c1)),
        "dep_without": log_likelihood(rest_hits, rest, ratio(rest_hits, rest)),
        "ind_with": log_likelihood(c12, c1, overall),
        "ind_without": log_likelihood(rest_hits, rest, overall),
    }


def g2(c1: Column, c2: Column, c12: Column, n: Column) -> Column:
    """G² of a word pair seen ``c12`` times, its words ``c1`` and ``c2`` times,
    among ``n`` words. Inconsistent counts (``c12 > c1``) score as they fall."""
    term = likelihood_terms(c1, c2, c12, n)
    dependent = term["dep_with"] + term["dep_without"]
    independent = term["ind_with"] + term["ind_without"]
    return F.lit(2.0) * (dependent - independent)
