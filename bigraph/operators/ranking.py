"""Global top-N of ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(ranks: DataFrame, n: int, score: str | Column = "page_rank") -> DataFrame:
    """The ``n`` highest ``score`` rows, ties broken by ``node``.

    ``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: each task
    keeps its own best ``n`` and only those reach the final merge, so at most
    ``n * tasks`` rows move.  ``n`` above the row count returns every row.
    ``score`` may be an expression; it orders and is not returned.
    """
    return ranks.orderBy(F.desc(score) if isinstance(score, str) else score.desc(), F.asc("node")).limit(n)


def significant(c: str | Column, digits: int = 9) -> Column:
    """A positive number rounded to ``digits`` significant digits, 0 as 0: two
    engines that sum in different orders agree on it at any scale, where a
    fixed number of decimals would make all small ranks equal."""
    x = F.col(c) if isinstance(c, str) else c
    scale = F.floor(F.log10(F.abs(x))) + 1
    exponent = (F.lit(digits) - scale).cast("double")
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * F.pow(F.lit(10.0), exponent)) / F.pow(F.lit(10.0), exponent))
