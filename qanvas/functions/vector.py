"""Vector and score arithmetic on array columns: higher-order functions, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

EPS = 1e-10


def doubles(c: Column | str) -> Column:
    return col(c).cast("array<double>")


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return total(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 1 where either vector is zero."""
    return cosine_by_norms(a, b, norm(a), norm(b))


def cosine_by_norms(a: Column | str, b: Column | str, norm_a: Column, norm_b: Column) -> Column:
    """Cosine similarity of vectors whose norms are known."""
    return F.get(F.transform(F.array(norm_a * norm_b), lambda n: F.when(n == 0, 1.0).otherwise(dot(a, b) / F.nullif(n, F.lit(0.0)))), F.lit(0))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    return 1 - cosine(a, b)


def min_max(x: Column, low: Column, high: Column, eps: float = EPS) -> Column:
    return (x - low) / (high - low + eps)


def min_max_or_zero(x: Column, low: Column, high: Column) -> Column:
    return F.when(high == low, 0.0).otherwise((x - low) / F.nullif(high - low, F.lit(0.0)))


def context_score(p_sentence: Column, p_passage: Column, alpha: float) -> Column:
    """ln p_sentence - alpha ln p_passage, with probabilities clipped to be positive."""
    return F.log(F.greatest(p_sentence, F.lit(EPS))) - alpha * F.log(F.greatest(p_passage, F.lit(EPS)))


def harmonic_mean(values: Column) -> Column:
    """Harmonic mean of an aggregated column; 0 if any value is 0 or there is none."""
    return F.when(F.count_if(values == 0) > 0, 0.0).otherwise(F.coalesce(F.try_divide(F.count(values), F.sum(1 / F.nullif(values, F.lit(0.0)))), F.lit(0.0)))


def geometric_mean(a: Column, b: Column) -> Column:
    return F.exp((F.log(a) + F.log(b)) / 2)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def rounded(x: Column | str, places: int = 6) -> Column:
    """F.round of doubles, for columns of very many: F.round makes a decimal of each, here only those that are near a tie, too
    large or no number are left to it."""
    x, scale = col(x), float(10**places)
    near = F.rint(x * scale)
    return F.when((F.abs(x) < 1000) & (F.abs(F.abs(x * scale - near) - 0.5) > 1e-6), (near + 0.0) / scale).otherwise(F.round(x, places))
