"""Exact quantiles without gathering the values in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Buckets per factor e. A bucket spans 0.006 % of its value, and amounts between
# 0.01 and a million fill at most 300 000 of them, however many rows there are.
LOG_STEPS = 16384
# Cells of equal width that a picked bucket is cut into, between its least and its largest value.
CELLS = 16384


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    """One row ``q0, q1, ...`` of linearly interpolated quantiles, nulls left out.

    The first pass counts a histogram with logarithmic buckets, of which only
    counts are shuffled, and finds the buckets that hold the wanted ranks. The
    second does the same for cells of equal width inside those buckets, for values
    that lie close together. The third counts the values of just the found cells
    and puts them in order. Bucket and cell never fall while the value rises, so
    the result is exact for any distribution.
    """
    values = (
        df.select(F.col(column).cast("double").alias("x"))
        .filter("x IS NOT NULL AND NOT isnan(x)")
        .withColumn("bucket", F.expr(f"floor(signum(x) * log1p(abs(x)) * {LOG_STEPS})"))
    )
    # The windows without a key see one row per bucket, a bounded number.
    buckets = (
        values.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        .selectExpr(
            "bucket",
            "low",
            "high",
            "n",
            "sum(n) OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING) - n AS start",
            "sum(n) OVER () AS total",
        )
    )

    positions = [f"({p}D * (total - 1))" for p in probabilities]

    def covers(rank: str) -> str:
        return f"(start <= {rank} AND {rank} < start + n)"

    ranks = [f"{end}{position}" for position in positions for end in ("floor", "ceil")]

    # At most two buckets, and then two cells, per probability: a proven bound for the broadcasts.
    picked = buckets.filter(" OR ".join(map(covers, ranks))).selectExpr("bucket", "low", "high", "total", "start AS bucket_start")
    cell = F.expr(f"CASE WHEN high > low THEN floor((x - low) / (high - low) * {CELLS}) ELSE 0 END")
    cells = (
        values.join(F.broadcast(picked), "bucket")
        .groupBy("bucket", "low", "high", "total", "bucket_start", cell.alias("cell"))
        .agg(F.count("*").alias("n"))
        .withColumn("start", F.expr("bucket_start - n + sum(n) OVER (PARTITION BY bucket ORDER BY cell ROWS UNBOUNDED PRECEDING)"))
        .filter(" OR ".join(map(covers, ranks)))
        .select(F.col("bucket").alias("of"), "low", "high", "total", "cell", F.col("start").alias("cell_start"))
    )
    located = (
        values.join(F.broadcast(cells), (F.col("bucket") == F.col("of")) & (cell == F.col("cell")))
        .groupBy("bucket", "cell", "cell_start", "total", "x")
        .agg(F.count("*").alias("n"))
        .selectExpr(
            "x",
            "n",
            "total",
            "cell_start - n + sum(n) OVER (PARTITION BY bucket, cell ORDER BY x ROWS UNBOUNDED PRECEDING) AS start",
        )
    )
    ends = located.selectExpr(
        "max(total) AS total", *[f"max(CASE WHEN {covers(rank)} THEN x END) AS x{i}" for i, rank in enumerate(ranks)]
    )
    # Between the values at the ranks around a position, in proportion.
    return ends.selectExpr(
        *[f"x{2 * i} + (x{2 * i + 1} - x{2 * i}) * ({p} - floor{p}) AS q{i}" for i, p in enumerate(positions)]
    )
