"""Parameterised column expressions shared by the scoring operators.

Every helper returns a ``Column`` built only from ``pyspark.sql.functions``,
so the work stays in the JVM (scalar expressions are code-generated; array
lambdas are evaluated by Spark's interpreter, never by Python). Score
convention:
``1`` favourable, ``0`` neutral, ``-1`` unfavourable, graded values in
between, and ``null`` meaning *no information* (never folded into 0).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def no_neg_zero(x: Column) -> Column:
    """Turn ``-0.0`` into ``0.0`` (adding 0.0 is exact for every other value)."""
    return x + F.lit(0.0)


def category_score(x, mapping: Sequence[tuple[str, float | None]]) -> Column:
    """Exact-match lookup of a category string; unknown categories give null.

    ``mapping`` is an ordered list of ``(category, score)``; a ``None`` score
    marks a category that is known but carries no information.
    """
    x = _c(x)
    out = None
    for cat, score in mapping:
        val = F.lit(None).cast("double") if score is None else F.lit(float(score))
        out = F.when(x == F.lit(cat), val) if out is None else out.when(x == F.lit(cat), val)
    return out


def ramp(x, lo: float, hi: float, sign: float = 1.0) -> Column:
    """Threshold ramp: ``0`` below ``lo``; ``sign * (x - lo) / (hi - lo)`` from
    ``lo`` upwards; null when ``x`` is null. ``-0.0`` at ``lo`` becomes ``0.0``."""
    x = _c(x)
    scaled = (x - F.lit(lo)) / F.lit(hi - lo)
    graded = -scaled if sign < 0 else scaled
    return F.when(x < F.lit(lo), F.lit(0.0)).when(x >= F.lit(lo), no_neg_zero(graded))


def minmax_scaled(x, lo, hi) -> Column:
    """``2 * (x - lo) / (hi - lo) - 1`` in ``[-1, 1]``; null if ``hi == lo``."""
    x, lo, hi = _c(x), _c(lo), _c(hi)
    return F.lit(2) * F.try_divide(x - lo, hi - lo) - F.lit(1)


def bands(x, lower: float, upper: float, inner_lo: float, inner_hi: float,
          labels: tuple[str, str, str] = ("-1", "0", "1")) -> Column:
    """Three-way band label: ``labels[0]`` below ``lower``, ``labels[1]`` inside
    ``[inner_lo, inner_hi]``, ``labels[2]`` above ``upper``; values in the gaps
    between the bands get null."""
    x = _c(x)
    return (
        F.when(x < F.lit(lower), F.lit(labels[0]))
        .when(x.between(F.lit(inner_lo), F.lit(inner_hi)), F.lit(labels[1]))
        .when(x > F.lit(upper), F.lit(labels[2]))
    )


def non_empty(arr) -> Column:
    """True for a non-empty array, false for empty *or null*."""
    arr = _c(arr)
    return F.coalesce(F.size(arr) > 0, F.lit(False))


# Inverse-square partial sums H2(n) = sum_{k=1..n} 1/k^2 = pi^2/6 minus the sum
# over all k > n. Of that, the first TAIL_START terms are taken one by one and the
# rest by the Euler-Maclaurin series at n + TAIL_START, which is exact to double
# precision there: one formula for every n, and no loop over n.
TAIL_START = 10


def _h2_sql(n: str) -> str:
    """SQL text of ``H2(n)`` for a long-valued SQL expression ``n``."""
    m = f"CAST({n} + {TAIL_START} AS DOUBLE)"
    tail = (f"1D / {m} - 1D / (2D * {m} * {m}) + 1D / (6D * power({m}, 3)) - 1D / (30D * power({m}, 5)) + 1D / (42D * power({m}, 7)) "
            f"- 1D / (30D * power({m}, 9)) + 5D / (66D * power({m}, 11)) - 691D / (2730D * power({m}, 13))")
    near = " + ".join(f"1D / power(CAST({n} + {j} AS DOUBLE), 2)" for j in range(1, TAIL_START + 1))
    return f"CASE WHEN {n} <= 0 THEN 0D ELSE {math.pi ** 2 / 6.0!r}D - ({tail}) - ({near}) END"


def inverse_square_sum(n: str) -> Column:
    """``H2(n) = sum_{k=1}^{n} 1/k^2`` as a double for the long column named
    ``n`` (0 for n <= 0; null n gives null). Built as one SQL expression."""
    return F.expr(_h2_sql(f"CAST(`{n}` AS BIGINT)"))


def rank_weighted_sum(groups: str) -> Column:
    """Harmonic (inverse-square rank weighted) sum over score groups.

    ``groups`` names an array of ``struct(score double, n long)`` sorted by
    score descending: ``n`` equal scores occupy the next ``n`` ranks, and
    neighbours with the same score are one group. The result is
    ``sum_i score_i / i^2`` over the expanded, descending list, computed per
    group as ``score * (H2(p + n) - H2(p))`` with ``p`` the ranks already used,
    so a group's size never turns into a loop or a materialised list. Returns
    ``struct(hs double, n long)``.
    """
    # hs and n of the groups that are done, s and m of the one that is open
    closed = f"acc.hs + acc.s * (({_h2_sql('(acc.n + acc.m)')}) - ({_h2_sql('acc.n')}))"
    step = (f"CASE WHEN g.score = acc.s THEN named_struct('hs', acc.hs, 'n', acc.n, 'm', acc.m + g.n, 's', acc.s) "
            f"ELSE named_struct('hs', {closed}, 'n', acc.n + acc.m, 'm', g.n, 's', g.score) END")
    return F.expr(f"aggregate(`{groups}`, named_struct('hs', 0D, 'n', 0L, 'm', 0L, 's', 0D), (acc, g) -> {step}, "
                  f"acc -> named_struct('hs', {closed}, 'n', acc.n + acc.m))")
