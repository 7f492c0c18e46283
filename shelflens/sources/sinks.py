"""Writing layers: raw archive, staging, curated and quarantine tables, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.functions.rules import render_all
from shelflens.sources.shared import delete_path


def flat(df: DataFrame) -> DataFrame:
    """Arrays and structs as JSON text, for formats without nested columns."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, nested)})


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and return the written table.

    Later steps read the table, so nothing is computed twice and a lost executor
    costs no more than the step it worked on.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    # Blanks around a text are part of it.
    blanks = dict(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    flat(df).write.mode("overwrite").options(header=True, escape='"', **blanks).csv(path)


def archive_raw(df: DataFrame, base: str, name: str) -> DataFrame:
    """The input unchanged, as Parquet."""
    return write_table(df, f"{base}/raw/{name}_raw.parquet")


def write_curated(df: DataFrame, base: str, name: str, also_csv: bool = True) -> DataFrame:
    """Curated table as Parquet, and a CSV copy made from the written table."""
    written = write_table(df, f"{base}/curated/{name}/{name}.parquet")
    if also_csv:
        write_csv(written, f"{base}/curated/{name}/{name}.csv")
    return written


def write_quarantine(df: DataFrame, base: str, name: str, also_csv: bool = True) -> DataFrame | None:
    """Quarantined rows of one dataset, codes as text; nothing is written if there are none."""
    path = f"{base}/quarantine/quarantine_{name}/quarantine_{name}"
    seen = Observation()
    written = write_table(render_all(df, "validation_errors").observe(seen, F.count("*").alias("rows")), f"{path}.parquet")
    if not seen.get["rows"]:  # what an earlier run has left is no longer true either
        for kind in ("parquet", "csv"):
            delete_path(df.sparkSession, f"{path}.{kind}")
        return None
    if also_csv:
        write_csv(written, f"{path}.csv")
    return written


def write_report(metrics: DataFrame, base: str, name: str) -> None:
    """Metric rows of a run, as JSON lines; a few dozen rows, hence one file."""
    metrics.coalesce(1).write.mode("overwrite").json(f"{base}/reports/{name}")
