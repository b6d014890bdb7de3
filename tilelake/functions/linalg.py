"""Closed-form linear algebra of small fixed sizes as Column expressions, inside whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

THIRD_TURN = 2.0943951023931953


def symmetric_eigenvalues(a: Column, d: Column, f: Column, e: Column, h: Column, i: Column) -> tuple[Column, Column, Column]:
    """Smallest, middle and largest eigenvalue of [[a, d, f], [d, e, h], [f, h, i]]."""
    q = (a + e + i) / 3.0
    off = d * d + f * f + h * h
    p = F.sqrt(((a - q) * (a - q) + (e - q) * (e - q) + (i - q) * (i - q) + 2.0 * off) / 6.0)
    det = (a - q) * ((e - q) * (i - q) - h * h) - d * (d * (i - q) - h * f) + f * (d * h - (e - q) * f)
    r = F.when(p > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), det / (p * p * p) / 2.0))).otherwise(0.0)
    t = F.acos(r) / 3.0
    top, low = q + 2.0 * p * F.cos(t), q + 2.0 * p * F.cos(t + THIRD_TURN)
    return low, 3.0 * q - top - low, top


def eigenvector(a: Column, d: Column, f: Column, e: Column, h: Column, i: Column, lam: Column) -> list[Column]:
    """Unit eigenvector: the longest cross product of two rows of A - lam I; null for a zero matrix."""
    a, e, i = a - lam, e - lam, i - lam
    rows = [(a, d, f), (d, e, h), (f, h, i)]

    def cross(u: tuple, v: tuple) -> list[Column]:
        return [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]

    options = [cross(rows[0], rows[1]), cross(rows[0], rows[2]), cross(rows[1], rows[2])]
    norms = [x * x + y * y + z * z for x, y, z in options]
    best = F.greatest(*norms)
    pick = [F.when(norms[0] == best, options[0][k]).when(norms[1] == best, options[1][k]).otherwise(options[2][k]) for k in range(3)]
    return [F.when(best > 0, x / F.sqrt(best)) for x in pick]


def solve_two(h1: list[Column], h2: list[Column], x: list[Column]) -> tuple[Column, Column]:
    """Least-squares c1, c2 of c1 h1 + c2 h2 = x, by normal equations; null if h1 and h2 are parallel."""
    dot = lambda u, v: u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
    g11, g12, g22, b1, b2 = dot(h1, h1), dot(h1, h2), dot(h2, h2), dot(h1, x), dot(h2, x)
    det = g11 * g22 - g12 * g12
    return F.try_divide(g22 * b1 - g12 * b2, det), F.try_divide(g11 * b2 - g12 * b1, det)


def lasso_two(h1: list[Column], h2: list[Column], x: list[Column], lam: float) -> tuple[Column, Column]:
    """c1, c2 >= 0 of least 0.5 |x - c1 h1 - c2 h2|^2 + lam (c1 + c2): the best of the four active sets."""
    dot = lambda u, v: u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
    g11, g12, g22, b1, b2 = dot(h1, h1), dot(h1, h2), dot(h2, h2), dot(h1, x) - lam, dot(h2, x) - lam
    det = g11 * g22 - g12 * g12
    c1, c2 = F.try_divide(g22 * b1 - g12 * b2, det), F.try_divide(g11 * b2 - g12 * b1, det)
    one, two = F.greatest(F.try_divide(b1, g11), F.lit(0.0)), F.greatest(F.try_divide(b2, g22), F.lit(0.0))
    inner = (c1 >= 0) & (c2 >= 0)
    gain1, gain2 = one * b1 - 0.5 * one * one * g11, two * b2 - 0.5 * two * two * g22
    first = gain1 >= gain2
    return F.when(inner, c1).when(first, one).otherwise(0.0), F.when(inner, c2).when(first, 0.0).otherwise(two)
