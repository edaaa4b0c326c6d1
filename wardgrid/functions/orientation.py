"""On which side of an edge a point lies, without rounding.

The plain determinant of two coordinate differences has the wrong sign, or is not
zero, for points close to a slanted edge. Here it is used only where it exceeds
what rounding can have done to it. Otherwise, if the differences are exact, its two
products are compared with what rounding took from them. If they are not, it is
multiplied out, each product is kept as two doubles that add up to it exactly, and
these are summed as an expansion, whose last part gives the sign.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardgrid.functions.clean import record

# relative error of the plain determinant, and what splits a double into halves
PLAIN_ERROR = (3 + 16 * 2.0**-53) * 2.0**-53
HALVES = 2.0**27 + 1
SMALLEST_PRODUCT = 1e-280

NOTHING = "array<double>"


def _upper(value: Column) -> Column:
    scaled = value * F.lit(HALVES)
    return scaled - (scaled - value)


def _product(pair: Column) -> Column:
    """What rounding took from a product, and the product."""
    a, b, ah, bh = pair["a"], pair["b"], pair["ah"], pair["bh"]
    al, bl = a - ah, b - bh
    return F.array(al * bl - (((a * b - ah * bh) - al * bh) - ah * bl), a * b)


def _with(parts: Column, value: Column) -> Column:
    """An expansion (small to large, no part overlapping another, zeros left out) plus a double."""

    def add(state: Column, part: Column) -> Column:
        q = state["q"]
        total = q + part
        back = total - q
        lost = (q - (total - back)) + (part - back)
        return record(q=total, rest=F.when(lost == 0, state["rest"]).otherwise(F.concat(state["rest"], F.array(lost))))

    start = record(q=value, rest=F.array().cast(NOTHING))
    return F.aggregate(parts, start, add, lambda state: F.concat(state["rest"], F.array(state["q"])))


def exact_sum_sign(values: Column) -> Column:
    """A double with the sign of the exact sum of an array of finite doubles; 0 if it is zero."""
    parts = F.aggregate(F.filter(values, lambda x: x != 0), F.array().cast(NOTHING), _with)
    return F.coalesce(F.get(F.reverse(F.filter(parts, lambda x: x != 0)), F.lit(0)), F.lit(0.0))


def _products(pairs: Column) -> Column:
    halved = F.transform(pairs, lambda p: record(a=p["a"], b=p["b"], ah=_upper(p["a"]), bh=_upper(p["b"])))
    return F.transform(halved, _product)


def _exact_step(a: Column, b: Column, d: Column) -> Column:
    """Whether d is a - b without rounding."""
    back = a - d
    return (a - (d + back)) + (back - b) == 0


def _close(d: Column, steps: Sequence[tuple[Column, Column]], exact: Column) -> Column:
    """The sign for a point close to an edge. Where the four differences are exact, two products are compared, and
    by what rounding took from them if they are equal: rounding keeps order. `exact` is for all others."""
    l, r = d["d0"] * d["d1"], d["d2"] * d["d3"]  # noqa: E741
    safe = reduce(Column.__and__, [_exact_step(a, b, d[f"d{i}"]) for i, (a, b) in enumerate(steps)])
    for i, j, product in ((0, 1, l), (2, 3, r)):
        # what is lost of a smaller product may be too small for a double
        safe &= (F.abs(product) > F.lit(SMALLEST_PRODUCT)) | (d[f"d{i}"] == 0) | (d[f"d{j}"] == 0)
    pairs = F.array(record(a=d["d0"], b=d["d1"]), record(a=d["d2"], b=d["d3"]))
    lost = F.aggregate(F.reverse(_products(pairs)), F.lit(0.0), lambda sign, p: p[0] - sign)
    return F.when(~safe, exact).when(l != r, l - r).otherwise(lost)


def turn(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Positive where p is left of the edge from a to b, negative right of it, zero on its line.

    Exact for coordinates between 1E-140 and 1E140 in size, and zero; NULL if one is NULL.
    """
    l, r = (bx - ax) * (py - ay), (by - ay) * (px - ax)  # noqa: E741
    pairs = F.array(*[record(a=a, b=b) for a, b in [(bx, py), (-bx, ay), (-ax, py), (-by, px), (by, ax), (ay, px)]])
    exact = exact_sum_sign(F.flatten(_products(pairs)))
    steps = [(bx, ax), (py, ay), (by, ay), (px, ax)]
    found = F.transform(F.array(record(**{f"d{i}": a - b for i, (a, b) in enumerate(steps)})), lambda d: _close(d, steps, exact))[0]
    return F.when(F.abs(l - r) >= F.lit(PLAIN_ERROR) * (F.abs(l) + F.abs(r)), l - r).when((l - r).isNotNull(), found)
