"""Binary logistic regression by reweighted least squares (M7).

Rows are collapsed once to distinct feature patterns with their number and
their number of positives; every iteration is then one aggregate over the
patterns: the Gram matrix of the weighted features (one sum per pair) and the
gradient.  Only these sums, a bounded ``columns ** 2`` numbers, reach the
driver, where the Newton step is solved.  The number of iterations is fixed, so
runs agree and SQL can follow them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.session import cut_lineage

CONSTANT = "(constant)"


def binary_logit(df: DataFrame, features: Sequence[str], label: str, *, iterations: int = 8, ridge: float = 0.0,
                 max_columns: int = 200) -> DataFrame:
    """``term, coefficient`` of P(label) on the numeric ``features`` and a constant.

    Rows with a NULL feature or label are left out.  ``ridge`` is the L2
    penalty on the sum of losses (the constant is free); without it, features that
    depend on each other or separate the labels are an error.
    """
    features = list(features)
    if len(features) + 1 > max_columns:
        raise ValueError(f"more than {max_columns} columns")
    x = [F.col(c).cast("double") for c in features]
    known = df.select(*[c.alias(f"x{i + 1}") for i, c in enumerate(x)], F.col(label).cast("int").alias("y")).na.drop()
    names = [f"x{i + 1}" for i in range(len(features))]
    patterns = cut_lineage(known.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
    terms = [F.lit(1.0), *[F.col(c) for c in names]]
    p, b = len(terms), np.zeros(len(terms))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    for _ in range(iterations):
        score = sum((F.lit(float(b[i])) * terms[i] for i in range(1, p)), F.lit(float(b[0])))
        prob = 1 / (1 + F.exp(-score))
        each = patterns.withColumn("_w", F.col("n") * prob * (1 - prob)).withColumn("_r", F.col("s") - F.col("n") * prob)
        sums = each.agg(*[F.sum(F.col("_w") * terms[i] * terms[j]).alias(f"g{i}_{j}") for i, j in pairs],
                        *[F.sum(F.col("_r") * terms[i]).alias(f"r{i}") for i in range(p)]).first()
        if sums["r0"] is None:
            raise ValueError("no complete row")
        gram = np.zeros((p, p))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = sums[f"g{i}_{j}"]
        gram[range(1, p), range(1, p)] += ridge
        slope = np.array([sums[f"r{i}"] - (ridge * b[i] if i else 0.0) for i in range(p)])
        if np.linalg.cond(gram) > 1e14:
            raise ValueError("the features depend on each other or separate the labels: give a ridge")
        b = b + np.linalg.solve(gram, slope)
    return df.sparkSession.createDataFrame(list(zip([CONSTANT, *features], map(float, b))), "term string, coefficient double")
