"""Vector expressions over ``ARRAY<FLOAT>``; all arithmetic is in DOUBLE."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from askloom.functions.text import as_column

SCORE_UNITS = 1_000_000


def sum_of_squares(v: Column | str) -> Column:
    return F.aggregate(as_column(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(sum_of_squares(v))


def l2_normalize(v: Column | str) -> Column:
    """Unit vector; NULL for the zero vector.

    The division happens in the aggregate's finish step, so the norm is computed once
    per vector and not once per component.
    """
    v = as_column(v)
    return F.aggregate(
        v,
        F.lit(0.0),
        lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda total: F.when(
            total > 0, F.transform(v, lambda x: x.cast("double") / F.sqrt(total))
        ),
    )


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(as_column(a), as_column(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine that divides by both norms; NULL when either vector is zero."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms > 0, dot(a, b) / norms)


def round_score(score: Column | str) -> Column:
    """Six decimals, halves up: absorbs the order of summation."""
    return F.floor(as_column(score) * SCORE_UNITS + 0.5) / F.lit(float(SCORE_UNITS))
