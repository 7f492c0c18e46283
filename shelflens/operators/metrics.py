"""Run counters as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def metric_rows(counters: DataFrame, prefix: str = "") -> DataFrame:
    """A one-row frame of counters as ``metric, value`` rows."""
    pairs = [
        F.struct(F.lit(prefix + c).alias("metric"), F.col(c).cast("double").alias("value")) for c in counters.columns
    ]
    return counters.select(F.inline(F.array(*pairs)))


def thresholds(spark: SparkSession, config: object, *names: str) -> DataFrame:
    """The named settings of a run as a one-row frame, to stand in its report."""
    return spark.range(1).select(*[F.lit(float(getattr(config, n))).alias(n) for n in names])


def all_metrics(groups: dict[str, DataFrame]) -> DataFrame:
    """Counters of several steps in one frame, names prefixed by the step."""
    rows = [metric_rows(df, f"{name}.") for name, df in groups.items()]
    return reduce(DataFrame.unionByName, rows)


class Counters:
    """Counters of a run, taken by the plans that write its layers.

    A frame is watched as the last step before it is written. There every partition
    counts once, also if its task runs again; further down, a repeated shuffle could
    count twice. So no written layer is read again to be counted.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, group: str, *counters: Column) -> DataFrame:
        """The frame, with aggregates that are known once it has been written."""
        seen = Observation()
        self._seen.append((group, seen))
        return df.observe(seen, *counters)

    def values(self) -> dict[str, float | None]:
        """Counters as ``group.name``; those of several frames of a group are added. Waits for all writes."""
        found: dict[str, float | None] = {}
        for group, seen in self._seen:
            for name, value in seen.get.items():
                key = f"{group}.{name}"
                known = found.get(key)
                found[key] = value if known is None else known if value is None else known + value
        return found


def value_rows(spark: SparkSession, values: dict[str, float | None]) -> DataFrame:
    """Counters that the driver knows as ``metric, value`` rows."""
    rows = [(k, None if v is None else float(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, "metric string, value double")
