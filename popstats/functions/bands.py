"""Value bands as a ``CASE WHEN`` chain (replaces a row-at-a-time UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The age bands of the population question.  Bands are
# (lower, upper] except the last, which is (lower, upper).  Anything else
# (NULL, <= 0, >= 200) falls into the band named NULL_BAND.
AGE_EDGES = (0, 18, 28, 38, 48, 59, 200)
AGE_LABELS = ("0-18", "19-28", "29-38", "39-48", "49-59", "60+")
NULL_BAND = "NULL"


def bucketize(value: Column, edges: Sequence[float] = AGE_EDGES, labels: Sequence[str] = AGE_LABELS,
              *, null_label: str = NULL_BAND, last_closed: bool = False) -> Column:
    """Label of the band holding ``value``: band i is ``(edges[i], edges[i+1]]``.

    The last band's upper edge is excluded unless ``last_closed``.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    if list(edges) != sorted(edges):
        raise ValueError("edges must be ascending")
    expr = None
    n = len(labels)
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        upper = value <= hi if (i < n - 1 or last_closed) else value < hi
        cond = (value > lo) & upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(null_label))
