"""Loading datasets by name: csv, parquet or json, with declared types."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelflens.config import DATASETS, Dataset
from shelflens.functions.numbers import lenient_double, lenient_long
from shelflens.sources.quoted_csv import read_quoted

log = logging.getLogger(__name__)

# Texts a csv cell may hold for "no value".
NO_VALUE = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def missing_columns(df: DataFrame, required: tuple[str, ...]) -> list[str]:
    """Required columns that the frame lacks; looks at the schema only."""
    return [c for c in required if c not in df.columns]


def _join_path(base: str, path: str) -> str:
    return f"{base.rstrip('/')}/{path}" if base else path


def _read(spark: SparkSession, dataset: Dataset, path: str) -> DataFrame:
    if dataset.file_type == "csv":
        # Only the header line is read here: all columns stay text. A file of the folder
        # whose columns differ in name or order raises when it is read.
        options = dict(header=True, enforceSchema=False, sep=dataset.delimiter, encoding=dataset.encoding, escape='"')
        by_ranges = dataset.line_breaks and dataset.encoding.lower() in ("utf-8", "utf8")
        if by_ranges or dataset.bad_records:
            if not by_ranges:
                raise ValueError("bad records are kept from UTF-8 files with line_breaks only")
            raw = read_quoted(spark, path, dataset.delimiter, dataset.bad_records)
        else:
            raw = spark.read.options(**options, multiLine=dataset.line_breaks).csv(path)
        return raw.select(*[F.when(~F.col(f"`{c}`").isin(NO_VALUE), F.col(f"`{c}`")).alias(c) for c in raw.columns])
    if dataset.file_type == "parquet":
        return spark.read.parquet(path)
    if dataset.file_type == "json":
        declared = StructType([StructField(c, StringType()) for c in dataset.columns])
        return (spark.read.schema(declared) if dataset.columns else spark.read).json(path)
    raise ValueError(f"Unsupported file type: {dataset.file_type}")


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Declared types: numbers leniently, dates strictly (a malformed date raises)."""
    known = {"date": lambda c: F.to_date(c), "double": lambda c: lenient_double(df, c), "long": lambda c: lenient_long(df, c)}
    casts = {
        c: known[t](c) if t in known else F.col(c).try_cast(t) for c, t in types.items() if c in df.columns
    }
    return df.withColumns(casts) if casts else df


def load_dataset(
    spark: SparkSession, name: str, base: str = "", datasets: dict[str, Dataset] | None = None
) -> DataFrame:
    """Read a dataset by its name. Missing required columns are warned about only."""
    datasets = DATASETS if datasets is None else datasets
    if name not in datasets:
        raise ValueError(f"Dataset '{name}' not found")
    dataset = datasets[name]
    path = _join_path(base, dataset.path)
    try:
        df = _typed(_read(spark, dataset, path), dataset.types)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"File not found: {path}") from error
        raise
    absent = missing_columns(df, dataset.required)
    if absent:
        log.warning("Missing columns in %s: %s", name, absent)
    return df


def load_layer(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, or None if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
