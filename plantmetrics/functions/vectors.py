"""Vector helpers: text form <-> array<double>, and cosine similarity as an expression.

The expression form is exact and needs no Python, but higher-order functions run
outside whole-stage codegen; the retrieval operator scores with a numpy block scorer
instead, and this form serves row-level checks (``vector_parse``) and the tests.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_vector(text: Column | str) -> Column:
    """'0.1,0.2,...' -> array<double>."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(F.split(F.trim(text), r"\s*,\s*"), lambda x: x.cast("double"))


def format_vector(vec: Column | str, decimals: int = 8) -> Column:
    """array<double> -> '0.10000000,0.20000000,...' (the stored text form)."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    return F.array_join(F.transform(vec, lambda x: F.format_string(f"%.{decimals}f", x.cast("double"))), ",")


def vector_dims(text: Column | str) -> Column:
    """Number of comma-separated components of a text vector."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(text, F.lit(",")) + 1


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def cosine_expr(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when either vector has zero norm."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    na = F.sqrt(_dot(a, a))
    nb = F.sqrt(_dot(b, b))
    return F.when((na > 0) & (nb > 0), _dot(a, b) / (na * nb)).otherwise(F.lit(0.0))
