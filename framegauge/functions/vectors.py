"""Vector algebra on array columns, 6-D rotations and poses, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framegauge.functions.scalars import EPS, col, finite


def let(x: Column, f) -> Column:
    """``f(x)`` with x computed once, however often f uses it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def doubles(v: Column | str) -> Column:
    return col(v).cast("array<double>")


def part(v: Column | str, first: int, length: int) -> Column:
    """Elements from ``first`` (from 1)."""
    return F.slice(col(v), first, length)


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(total(F.transform(v, lambda x: x * x)))


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def scaled(v: Column, k: Column | float) -> Column:
    return F.transform(v, lambda x: x * k)


def cross(a: Column, b: Column) -> Column:
    e = lambda v, i: F.element_at(v, i)
    return F.array(e(a, 2) * e(b, 3) - e(a, 3) * e(b, 2), e(a, 3) * e(b, 1) - e(a, 1) * e(b, 3), e(a, 1) * e(b, 2) - e(a, 2) * e(b, 1))


def all_finite(v: Column | str) -> Column:
    """P5; a null vector is not finite."""
    return F.coalesce(F.forall(col(v), finite), F.lit(False))


def largest(v: Column | str) -> Column:
    """Largest absolute value."""
    return F.array_max(F.transform(col(v), lambda x: F.abs(x)))


def count_where(v: Column | str, test) -> Column:
    return F.size(F.filter(col(v), test))


def median(v: Column) -> Column:
    """Median of a short array."""
    s = F.array_sort(v)
    n = F.size(v)
    return F.when(n > 0, (F.element_at(s, F.floor((n + 1) / 2).cast("int")) + F.element_at(s, F.floor((n + 2) / 2).cast("int"))) / 2)


def unit(v: Column) -> Column:
    """null for vectors that are not finite or shorter than 1e-9."""
    return let(v, lambda v: let(norm(v), lambda n: F.when(finite(n) & (n >= EPS), F.transform(v, lambda x: x / n))))


def rotation_check(rot: Column, min_norm: float = 1e-4, min_sin: float = 1e-3) -> Column:
    """Struct of n1, n2, sin_angle and legal for six numbers."""
    a, b = part(rot, 1, 3), part(rot, 4, 3)
    n1, n2 = norm(a), norm(b)
    sin = norm(cross(a, b)) / F.greatest(n1 * n2, F.lit(EPS))
    told = lambda m: F.struct(m["n1"].alias("n1"), m["n2"].alias("n2"), m["s"].alias("sin_angle"), F.coalesce(all_finite(rot) & (m["n1"] > min_norm) & (m["n2"] > min_norm) & (m["s"] > min_sin), F.lit(False)).alias("legal"))
    return let(F.struct(n1.alias("n1"), n2.alias("n2"), sin.alias("s")), told)


def rotation_matrix(rot: Column, layout: str = "columns") -> Column:
    """nine numbers by row from six by Gram-Schmidt, or null. Layout: the basis vectors are columns or rows."""
    a2 = part(rot, 4, 3)

    def cells(b1: Column, b2: Column, b3: Column) -> Column:
        basis = [b1, b2, b3]
        return F.array(*(F.element_at(basis[c], r + 1) if layout == "columns" else F.element_at(basis[r], c + 1) for r in range(3) for c in range(3)))

    across = lambda b1: let(dot(b1, a2), lambda k: unit(minus(a2, F.transform(b1, lambda x: x * k))))
    third = lambda b1, b2: let(unit(cross(b1, b2)), lambda b3: F.when(b3.isNotNull(), cells(b1, b2, b3)))
    whole = let(unit(part(rot, 1, 3)), lambda b1: F.when(b1.isNotNull(), let(across(b1), lambda b2: F.when(b2.isNotNull(), third(b1, b2)))))
    return F.when(all_finite(rot) & F.lit(layout in ("columns", "rows")), whole)


def rotation_distance(left: Column, right: Column) -> Column:
    """angle between two rotations given as nine numbers; the trace is the sum of products of their cells."""
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (dot(left, right) - 1) / 2)))


def transposed_times(a: Column, b: Column, width: int) -> Column:
    """A transposed (3 x 3) times B (3 x width), both by row."""
    e = F.element_at
    cells = lambda a, b: F.array(*(e(a, r + 1) * e(b, c + 1) + e(a, r + 4) * e(b, width + c + 1) + e(a, r + 7) * e(b, 2 * width + c + 1) for r in range(3) for c in range(width)))
    return let(a, lambda a: let(b, lambda b: cells(a, b)))


def relative_pose(left_pos: Column, left_rot: Column, right_pos: Column, right_rot: Column) -> Column:
    """struct of the right arm's position and rotation in the left arm's frame."""
    return F.struct(transposed_times(left_rot, minus(right_pos, left_pos), 1).alias("position"), transposed_times(left_rot, right_rot, 3).alias("rotation"))
