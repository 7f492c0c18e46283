"""Mergeable sketches: approximate quantiles and distinct counts, kept per key and merged for any span of keys.

A sketch is a binary column of a small table. It is made once from the rows, and from
then on only sketches are read: those of days merge into one of a month, those of new
days are added to the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the sketches: their error for a size parameter, 99 % of the time for ranks, one deviation for counts.
RANK_ERROR = (2.296, 0.9021)
COUNT_DEVIATION = 1.04


def rank_error(k: int) -> float:
    """By how much the rank of a quantile may be off, as a share of all values."""
    factor, power = RANK_ERROR
    return factor / k**power


def k_for(error: float) -> int:
    """The smallest size parameter whose rank error is at most ``error``."""
    factor, power = RANK_ERROR
    k = max(8, int((factor / error) ** (1 / power)))
    k += rank_error(k) > error
    if k > 65535:
        raise ValueError("no quantile sketch is that exact; use exact_quantiles")
    return k


def lg_for(deviation: float) -> int:
    """The smallest size parameter of a count sketch whose relative deviation is at most ``deviation``."""
    for lg in range(4, 22):
        if COUNT_DEVIATION / 2 ** (lg / 2) <= deviation:
            return lg
    raise ValueError("no count sketch is that exact; count distinct values")


def quantile_sketch(value: Column, error: float) -> Column:
    """Aggregate: sketch of the values, nulls and NaN left out."""
    number = value.cast("double")
    return F.kll_sketch_agg_double(F.when(~F.isnan(number), number), k_for(error))


def merged_quantile_sketch(sketch: Column | str, error: float) -> Column:
    """Aggregate: one sketch of what several sketches hold, with their error."""
    return F.kll_merge_agg_double(sketch, k_for(error))


def quantiles(sketch: Column, probabilities: Sequence[float]) -> list[Column]:
    """Values at the ranks, null for a sketch of nothing."""
    filled = F.kll_sketch_get_n_double(sketch) > 0
    return [F.when(filled, F.kll_sketch_get_quantile_double(sketch, F.lit(float(p)))) for p in probabilities]


def approximate_quantiles(df: DataFrame, column: str, probabilities: list[float], error: float = 0.001) -> DataFrame:
    """One row ``q0, q1, ...`` as ``exact_quantiles``, in one pass: values of ranks off by ``error`` at most.

    The bound holds for 99 of 100 ranks; the values are ones that occur, without interpolation.
    """
    whole = df.agg(quantile_sketch(F.col(column), error).alias("sketch"))
    return whole.select(*[q.alias(f"q{i}") for i, q in enumerate(quantiles(F.col("sketch"), probabilities))])


def distinct_sketches(df: DataFrame, value: str, *keys: str | Column, deviation: float = 0.01) -> DataFrame:
    """Per key a ``sketch`` of the distinct values, nulls left out."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_for(deviation)).alias("sketch"))


def distinct_counts(sketches: DataFrame, *keys: str, name: str = "distinct") -> DataFrame:
    """Per key the number of distinct values in all of its sketches together, with the deviation they were made for."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
