"""Declarative validation rules: one projection adds codes and status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

VALID, INVALID = "VALID", "INVALID"


@dataclass(frozen=True)
class Rule:
    """A code that is recorded where ``failed`` holds; warnings keep the row valid."""

    code: str
    failed: Column
    warning: bool = False


def present(tests: list[tuple[Column, str]]) -> Column:
    """Array of the names whose test holds, in the given order."""
    # array_remove takes part in code generation; array_compact is evaluated row by row.
    return F.array_remove(F.array(*[F.when(test, F.lit(name)).otherwise(F.lit("")) for test, name in tests]), "")


def codes(rules: list[Rule]) -> Column:
    """Codes of the failing rules, in rule order."""
    return present([(rule.failed, rule.code) for rule in rules])


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``validation_status`` and ``validation_errors`` (an array of codes)."""
    if not rules:
        return df.withColumns(
            {
                "validation_status": F.lit(VALID),
                "validation_errors": F.array().cast("array<string>"),
            }
        )
    failed = F.lit(False)
    for rule in rules:
        if not rule.warning:
            failed = failed | rule.failed
    return df.withColumns(
        {
            "validation_status": F.when(failed, INVALID).otherwise(VALID),
            "validation_errors": codes(rules),
        }
    )


def missing(column: str) -> Column:
    """Null, or blank once trimmed."""
    return F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")


def missing_rules(df: DataFrame, fields: tuple[str, ...]) -> list[Rule]:
    return [Rule(f"MISSING_{f.upper()}", missing(f)) for f in fields if f in df.columns]


def is_valid() -> Column:
    return F.col("validation_status") == VALID


def is_invalid() -> Column:
    return F.col("validation_status") == INVALID


def has_code(code: str, column: str = "validation_errors") -> Column:
    return F.array_contains(F.col(column), code)


def render_codes(codes_column: Column) -> Column:
    """Text of a code array: every code followed by a semicolon and a blank."""
    return F.when(F.size(codes_column) > 0, F.concat(F.array_join(codes_column, "; "), F.lit("; "))).otherwise("")


def render_all(df: DataFrame, *columns: str) -> DataFrame:
    """Render code arrays as text, as the last step before a sink."""
    arrays = [f.name for f in df.schema.fields if f.name in columns and isinstance(f.dataType, ArrayType)]
    return df.withColumns({c: render_codes(F.col(c)) for c in arrays}) if arrays else df


def error_type(errors: Column) -> Column:
    """Error classes present among the codes, joined by a bar.

    Only codes that begin with EXCEEDED_ are a limit error, so a capacity
    warning (CAPACITY_EXCEEDED) alone is OTHER. Null or no codes is UNKNOWN.
    """

    def any_code(test) -> Column:
        return F.exists(errors, test)

    classes = F.concat_ws(
        "|",
        F.when(any_code(lambda e: e.contains("MISSING_")), "MISSING_FIELD"),
        F.when(any_code(lambda e: e.contains("NEGATIVE_STOCK")), "NEGATIVE_STOCK"),
        F.when(any_code(lambda e: e.contains("MISMATCHED_PRODUCT_ID")), "MISMATCHED_PRODUCT"),
        F.when(any_code(lambda e: e.contains("EXCEEDED_")), "EXCEEDED_LIMIT"),
        F.when(any_code(lambda e: e.contains("INVALID_")), "INVALID_VALUE"),
    )
    return (
        F.when(errors.isNull() | (F.size(errors) == 0), "UNKNOWN").when(classes == "", "OTHER").otherwise(classes)
    )
