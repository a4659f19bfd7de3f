"""Vector functions, Column -> Column, over array<float|double>."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(inner_product(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if either vector is all zeros."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, inner_product(a, b) / scale).otherwise(F.lit(0.0))
