"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives every document posteriors over domains. Document rates, not
negative, are fitted so that the expected tokens of each domain, the sum over documents of rate * tokens * posterior,
meet targets: least squares by projected gradient descent from rates of 1. A step needs a few numbers per domain from
all documents (sums per partition first), and a document's rate after any number of steps follows from its posteriors
and the steps' numbers. So nothing but those is kept between steps, and none of them grows with the input.

Residuals are weighed by the inverse of the domains' second moments, over the documents whose rates can still move:
without a document at the bound, one step would meet the targets. Where such a step would miss by more than before, it
is taken back, and the moments over all documents are used, with which the error can't grow. A document's step is taken
relative to its tokens, which makes rates a function of posteriors alone: long and short documents of one domain are
treated alike.

Domains that the posteriors don't tell apart (a share below APART of the moments' largest eigenvalue) aren't pulled
apart, since that would take rates as extreme as the difference is small. What is missed is part of the result, and a
warning is given where it is over the tolerance.

Tokens are what n_tokens counts: words between white space, where with_posteriors has made the rows.

Defined results: a null or blank text has no tokens and the labels' share as posteriors; it gets a rate like any other.
A domain without any mass can't be reached and is left out. Rows are kept apart, also repeated ones; those without an
identifier are rounded by the key that copies() is given. Columns of any names pass through in a struct. An empty table
gives an empty result.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The relative error of every domain's tokens at which steps end, the steps at most, and the share of its error that a step must gain.
TOLERANCE = 1e-3
STEPS = 60
GAIN = 1e-3
#: Least share of the largest eigenvalue for a difference between domains that rates follow.
APART = 0.1


@dataclass(frozen=True)
class Fit:
    """The rate of a row as an expression over its posterior, and expected tokens of each domain at these rates."""

    rate: Column
    have: np.ndarray
    wanted: np.ndarray
    steps: int

    @property
    def met(self) -> bool:
        return bool((np.abs(self.have - self.wanted) <= _allowed(self.wanted)).all())


def _allowed(wanted: np.ndarray) -> np.ndarray:
    return TOLERANCE * np.maximum(wanted, TOLERANCE * wanted.sum())


def domain_tokens(rows: DataFrame, classes: int) -> np.ndarray:
    """Expected tokens of each domain at rates of 1; rows has n_tokens and posterior."""
    found = rows.agg(*(F.sum(F.col("n_tokens") * F.col("posterior")[k]) for k in range(classes))).first()
    return np.array([x or 0.0 for x in found])


def targets(weights: list[float], totals: np.ndarray, whole: int | None = None) -> np.ndarray:
    """Token targets in proportion to the weights: of all tokens, or so many that domain `whole` keeps its own."""
    share = np.array(weights) / sum(weights)
    return share * (totals.sum() if whole is None else totals[whole] / share[whole])


def _rate(steps: list[np.ndarray], most: float | None) -> Column:
    """A document's rate after the steps."""
    p = F.col("posterior")

    def step(rate: Column, c: Column) -> Column:
        moved = F.greatest(rate - F.aggregate(F.zip_with(p, c, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x), F.lit(0.0))
        return moved if most is None else F.least(moved, F.lit(most))

    if not steps:
        return F.lit(1.0)
    return F.aggregate(F.array(*(F.array(*(F.lit(float(v)) for v in c)) for c in steps)), F.lit(1.0), step)


def _solved(moments: np.ndarray, own: np.ndarray, miss: np.ndarray) -> np.ndarray:
    """The step for a miss, by the inverse of the moments as far as domains are apart in them."""
    root = np.where(own > 0, 1 / np.sqrt(np.maximum(own, 1e-300)), 0.0)
    values, vectors = np.linalg.eigh(root[:, None] * moments * root)
    keep = values > APART * max(values.max(initial=0), 1e-300)
    inverse = (vectors[:, keep] / values[keep]) @ vectors[:, keep].T
    return root * (inverse @ (root * miss))


def fit_rates(rows: DataFrame, wanted: np.ndarray, most: float | None = None) -> Fit:
    """Rates for rows (n_tokens, posterior) that meet the wanted tokens; rows should be a written table, as each step reads it."""
    k = len(wanted)
    n, p, r = F.col("n_tokens"), F.col("posterior"), F.col("rate")

    def measured(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens, and second moments over the rows whose rates are within the bounds."""
        inside = r > 0 if most is None else (r > 0) & (r < most)
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        sums = [F.sum(r * n * p[i]) for i in range(k)] + [F.sum(F.when(inside, n * p[i] * p[j])) for i, j in pairs]
        found = [x or 0.0 for x in rows.select(_rate(steps, most).alias("rate"), "n_tokens", "posterior").agg(*sums).first()]
        moments = np.zeros((k, k))
        for (i, j), x in zip(pairs, found[k:], strict=True):
            moments[i, j] = moments[j, i] = x
        return np.array(found[:k]), moments

    steps: list[np.ndarray] = []
    have, moments = measured(steps)
    own, whole = have, moments
    # the least squares that the steps are for: of residuals weighed by the inverse moments
    error = lambda have: float(np.sqrt(max(0.0, (have - wanted) @ _solved(whole, own, have - wanted))))
    tried = 0
    while tried < STEPS and own.any() and (np.abs(have - wanted) > _allowed(wanted))[own > 0].any():
        before = error(have)
        for metric in (moments, whole):
            step = _solved(metric, own, have - wanted)
            then, inner = measured([*steps, step])
            tried += 1
            if error(then) < before:
                break
        if error(then) > before * (1 - GAIN):
            break
        steps.append(step)
        have, moments = then, inner
    fit = Fit(_rate(steps, most), have, wanted, len(steps))
    if own.any() and not fit.met:
        warnings.warn(f"mixing: rates give {have.tolist()} tokens where {wanted.tolist()} are wanted", stacklevel=2)
    return fit


def copies(rate: Column, key: Column, seed: int = 0) -> Column:
    """How often a document is taken: its rate, rounded up or down by a hash of its key so that the mean is the rate."""
    share = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)).cast("double") / float(1 << 52)
    return F.floor(rate + share).cast("int")


def mixed(rows: DataFrame, rate: Column, key: Column, seed: int = 0) -> DataFrame:
    """The documents (struct `doc`) as often as their rates say."""
    taken = rows.select("doc", copies(rate, key, seed).alias("n")).filter(F.col("n") > 0)
    return taken.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("n")))).select("doc.*")
