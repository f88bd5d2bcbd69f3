"""Bin helpers. Four closedness conventions exist and are never shared:

* :func:`band_of`         right-closed on data quantile edges, lowest value
                          included, duplicate edges dropped (score bands).
* :func:`width_bin`       right-closed on fixed equal-width edges
                          (calibration curve).
* :func:`histogram_bin`   left-closed, last bin closed, outside -> NULL
                          (population stability).
* :func:`label_bin`       right-closed fixed edges with labels, lowest
                          included, anything else -> ``'missing'``.

Edges are literals, or an ``array<double>`` column of a small table; binning is
a sum of comparisons either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import col_of


def linspace_probs(n: int) -> list[float]:
    """``n + 1`` probabilities ``0, 1/n, ..., 1`` computed as ``i * (1/n)``
    with the last one exactly 1 (the evenly spaced grid of the reference)."""
    step = 1.0 / n
    return [i * step for i in range(n)] + [1.0]


def qcut_probs(n: int) -> list[float]:
    """Probabilities of an ``n``-quantile cut as the reference computes them:
    the evenly spaced grid ``i * (1/n)``, passed through a percent scale and
    back (``* 100 / 100``), which can move a value by one ulp - enough to put
    an edge on the other side of a tied data value."""
    return [(p * 100.0) / 100.0 for p in linspace_probs(n)]


def percent_grid_probs(n: int) -> list[float]:
    """``n + 1`` probabilities from a 0..100 percent grid divided by 100."""
    step = 100.0 / n
    return [(i * step) / 100.0 for i in range(n)] + [1.0]


def lit_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def band_of(x: str | Column, edges: Sequence[float]) -> Column:
    """Band for right-closed bins on sorted distinct ``edges``: the number of
    inner edges strictly below ``x``, so the lowest edge is in band 0. NULL
    stays NULL; with fewer than two edges (all scores equal) there is no band.
    """
    x = col_of(x)
    if len(edges) < 2:
        return F.lit(None).cast("int")
    below = F.lit(0)
    for e in edges[1:-1]:
        below = below + (x > F.lit(float(e))).cast("int")
    return F.when(x.isNotNull(), below)


def width_bin(x: str | Column, n_bins: int) -> Column:
    """Equal-width bins on [0, 1], right-closed: count of inner edges < x."""
    x = col_of(x)
    inner = linspace_probs(n_bins)[1:-1]
    below = F.lit(0)
    for e in inner:
        below = below + (x > F.lit(e)).cast("int")
    return F.when(x.isNotNull(), below)


def histogram_bin(x: str | Column, edges: Column, most: int = 32) -> Column:
    """Left-closed bins ``[e_i, e_{i+1})``, the last one closed; values outside
    ``[e_0, e_last]`` and NULL -> NULL. Needs at least two edges; more than
    ``most`` are an error."""
    x = col_of(x)
    n = F.size(edges)
    reached = F.lit(-1)
    for i in range(most):
        reached = reached + F.coalesce((x >= F.get(edges, F.lit(i))).cast("int"), F.lit(0))
    return (
        F.when(n > most, F.raise_error(F.lit(f"more than {most} edges")).cast("int"))
        .when(x.isNull() | (n < 2), F.lit(None).cast("int"))
        .when((reached < 0) | (x > F.get(edges, n - 1)), F.lit(None).cast("int"))
        .otherwise(F.least(reached, n - 2))
    )


def label_bin(
    x: str | Column,
    edges: Sequence[float],
    labels: Sequence[str],
    missing_label: str = "missing",
) -> Column:
    """Right-closed fixed bins, lowest edge included, with labels.

    ``edges`` has ``len(labels) + 1`` entries; values outside the range and
    NULL get ``missing_label``.
    """
    x = col_of(x)
    expr = F.when(x.isNull(), F.lit(missing_label))
    expr = expr.when((x >= edges[0]) & (x <= edges[1]), F.lit(labels[0]))
    for lo, hi, lab in zip(edges[1:-1], edges[2:], labels[1:]):
        expr = expr.when((x > lo) & (x <= hi), F.lit(lab))
    return expr.otherwise(F.lit(missing_label))
