"""Distinct counts and quantiles that are kept as sketches by sprint or day and merged, beside the exact ones.

A refresh adds the sketches of its new spans and merges the stored ones, so old rows aren't read again.  Errors, as the
algorithms state them: a HyperLogLog of 2^lg registers is off by 1.04 / sqrt(2^lg) (one standard error); a KLL sketch of
size k is off by about 2.3 / k^0.9 of the rows in rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the registers, and the size of a quantile sketch.
LG, KLL = 14, 400


def distinct_error(lg: int = LG) -> float:
    return 1.04 / 2 ** (lg / 2)


def rank_error(k: int = KLL) -> float:
    return 2.3 / k**0.9


def sketched(rows: DataFrame, span: list[str], distinct: list[str] = [], values: list[str] = [], lg: int = LG, k: int = KLL) -> DataFrame:
    """span..., n, hll_<column> and kll_<column>: the sketches of each span; nulls count nowhere."""
    made = [F.hll_sketch_agg(c, F.lit(lg)).alias(f"hll_{c}") for c in distinct]
    made += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"kll_{c}") for c in values]
    return rows.groupBy(*span).agg(F.count("*").alias("n"), *made)


def merged(parts: DataFrame, span: list[str]) -> DataFrame:
    """Sketches of wider spans, or with no columns of all; the same as of the rows themselves, within the errors."""
    each = [F.hll_union_agg(c).alias(c) if c.startswith("hll_") else F.kll_merge_agg_double(c).alias(c) for c in parts.columns if c.startswith(("hll_", "kll_"))]
    total = F.sum("n").alias("n")
    return parts.groupBy(*span).agg(total, *each) if span else parts.agg(total, *each)


def distinct_counts(parts: DataFrame) -> DataFrame:
    """Estimates of the distinct values, in place of their sketches."""
    return parts.withColumns({c.removeprefix("hll_"): F.hll_sketch_estimate(c) for c in parts.columns if c.startswith("hll_")}).drop(*(c for c in parts.columns if c.startswith("hll_")))


def quantile(parts: DataFrame, column: str, share: float) -> DataFrame:
    """Adds ``<column>_q``: about the value that this share of the rows don't exceed."""
    return parts.withColumn(f"{column}_q", F.kll_sketch_get_quantile_double(f"kll_{column}", F.lit(share)))
