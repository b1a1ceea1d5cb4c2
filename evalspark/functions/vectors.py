"""Column builders over vectors held as arrays; sums are taken in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def l2_norm(vector: Column) -> Column:
    return F.sqrt(_total(F.transform(as_doubles(vector), lambda x: x * x)))


def l2_normalise(vector: Column) -> Column:
    """Vector of length one; a zero vector stays zero."""
    size = F.greatest(l2_norm(vector), F.lit(1e-12))
    return F.transform(as_doubles(vector), lambda x: x / size)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(l2_norm(a) * l2_norm(b), F.lit(1e-12))


def mean_pool(tokens: Column, mask: Column) -> Column:
    """Masked mean over token vectors; the divisor never drops under 1e-9."""
    weighted = F.zip_with(
        tokens,
        mask,
        lambda vector, m: F.transform(as_doubles(vector), lambda x: x * m),
    )
    zero = F.transform(as_doubles(F.get(tokens, 0)), lambda _: F.lit(0.0))
    summed = F.aggregate(
        weighted, zero, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y)
    )
    divisor = F.greatest(_total(mask.cast("array<double>")), F.lit(1e-9))
    return F.transform(summed, lambda x: x / divisor)
