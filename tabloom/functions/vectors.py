"""Array columns as vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.scalar import col


def doubles(c: str | Column) -> Column:
    return col(c).cast("array<double>")


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def dot(a: str | Column, b: str | Column) -> Column:
    return total(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(a: str | Column) -> Column:
    return F.sqrt(total(F.transform(doubles(a), lambda x: x * x)))


def cosine(a: str | Column, b: str | Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def set_block(c: str | Column, start: int, stop: int, value: float) -> Column:
    """Overwrite elements ``start`` to ``stop - 1`` (0-based)."""
    return F.transform(col(c), lambda x, i: F.when((i >= start) & (i < stop), F.lit(float(value))).otherwise(x))


def set_elements(c: str | Column, values: dict[int, float], add: bool = False) -> Column:
    """Set (or add to) single elements."""

    def change(x: Column, i: Column) -> Column:
        out = x
        for at, v in values.items():
            out = F.when(i == at, x + F.lit(float(v)) if add else F.lit(float(v))).otherwise(out)
        return out

    return F.transform(doubles(c), change)


def scale_bytes(c: str | Column) -> Column:
    """Byte values to [-1, 1]."""
    return F.transform(doubles(c), lambda x: x / 127.5 - 1)


def mahalanobis(a: str | Column, b: str | Column, inverse: Sequence[Sequence[float]]) -> Column:
    """Distance of two vectors under an inverse covariance matrix."""
    diff = F.zip_with(doubles(a), doubles(b), lambda x, y: x - y)
    size = len(inverse)
    parts = [F.get(diff, F.lit(i)) for i in range(size)]
    return quadratic_root(parts, inverse)


def quadratic_root(parts: Sequence[Column], inverse: Sequence[Sequence[float]]) -> Column:
    """sqrt(d' M d) for a difference given as columns."""
    sums = None
    for i, row in enumerate(inverse):
        for j, w in enumerate(row):
            if not w:
                continue
            term = parts[i] * parts[j] * F.lit(float(w))
            sums = term if sums is None else sums + term
    return F.sqrt(F.greatest(F.lit(0.0) if sums is None else sums, F.lit(0.0)))


def to_columns(df: DataFrame, c: str, size: int, prefix: str = "v") -> DataFrame:
    """Vector to columns ``prefix1 .. prefixN``."""
    kept = [x for x in df.columns if x != c]
    return df.select(*kept, *[F.get(c, F.lit(i)).alias(f"{prefix}{i + 1}") for i in range(size)])


def from_columns(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    kept = [x for x in df.columns if x not in set(cols)]
    return df.select(*kept, F.array(*cols).alias(name))
