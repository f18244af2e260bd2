"""Array-as-vector helpers (element-wise work stays in the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions.text import col_


def as_double_array(c) -> Column:
    return F.transform(col_(c), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def dot_cast(a, b) -> Column:
    """Dot product with the left side cast to double element by element (no temporary array)."""
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y), F.lit(0.0),
                       lambda s, x: s + x)


def let_(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable and evaluate ``body(var)`` (a ``let``): the value is
    computed once per row even if ``body`` uses it many times or the optimizer copies the
    whole expression into a pushed-down filter."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, body)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(col_(a), lambda x: x * x), F.lit(0.0), lambda s, x: s + x))


def cosine(a, b) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def pad(a, length: int, over: str = "error") -> Column:
    """zero-pad a double array to ``length``.

    Over-length rule: ``"error"`` raises (as the original, which indexes past the end, fails),
    ``"null"`` gives NULL, ``"truncate"`` keeps the first ``length`` values.
    """
    a = col_(a)
    padded = F.slice(F.concat(a, F.array_repeat(F.lit(0.0), F.lit(length))), 1, length)
    too_long = F.size(a) > length
    if over == "truncate":
        return padded
    if over == "error":
        return F.when(too_long, F.raise_error(F.lit(f"feature array longer than {length}"))).otherwise(padded)
    return F.when(too_long, F.lit(None).cast("array<double>")).otherwise(padded)
