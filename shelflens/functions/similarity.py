"""Similarity score of two short texts: 2 * LCS / (sum of lengths), as 0..100."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 62  # longest text whose positions fit the bits of a long


def normalize(text: Column) -> Column:
    """Lower case, everything but word characters blanked, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\W", " "))


def token_sort(text: Column) -> Column:
    """Normalized text with its tokens in alphabetical order."""
    return F.array_join(F.array_sort(F.split(normalize(text), r"\s+")), " ")


def _chars(text: Column) -> Column:
    return F.when(
        F.length(text) > 0,
        F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(text, i, F.lit(1))),
    ).otherwise(F.array().cast("array<string>"))


def _lcs_bits(left: Column, right: Column) -> Column:
    """Bit-parallel LCS length: a zero bit marks a matched position of ``right``."""
    width = F.length(right)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    full = F.call_function("shiftleft", one, width) - one
    places = F.transform(_chars(right), lambda c, i: F.struct(c.alias("c"), F.call_function("shiftleft", one, i).alias("bit")))

    def step(free: Column, char: Column) -> Column:
        here = F.aggregate(
            places, zero, lambda mask, p: F.when(p["c"] == char, mask.bitwiseOR(p["bit"])).otherwise(mask)
        )
        used = free.bitwiseAND(here)
        return (free + used).bitwiseOR(free - used).bitwiseAND(full)

    return width - F.bit_count(F.aggregate(_chars(left), full, step))


def _lcs_rows(left: Column, right: Column) -> Column:
    """Row by row LCS length, for texts too long for one word of bits."""
    start = F.array_repeat(F.lit(0), F.length(right) + 1)

    def next_row(row: Column, char: Column) -> Column:
        def cell(done: Column, i: Column) -> Column:
            best = F.greatest(
                F.element_at(done, -1),
                F.element_at(row, i + 1),
                F.element_at(row, i) + F.when(F.substr(right, i, F.lit(1)) == char, 1).otherwise(0),
            )
            return F.concat(done, F.array(best))

        return F.aggregate(F.sequence(F.lit(1), F.length(right)), F.array(F.lit(0)), cell)

    return F.element_at(F.aggregate(_chars(left), start, next_row), -1)


def lcs_length(left: Column, right: Column) -> Column:
    return (
        F.when((F.length(left) == 0) | (F.length(right) == 0), 0)
        .when(F.length(right) <= WORD_BITS, _lcs_bits(left, right))
        .when(F.length(left) <= WORD_BITS, _lcs_bits(right, left))
        .otherwise(_lcs_rows(left, right))
    )


def score(left: Column, right: Column) -> Column:
    """0..100, halves rounded to even; 0 where a text is empty."""
    total = F.length(left) + F.length(right)
    return F.when(total == 0, 0).otherwise(
        F.bround(F.lit(200.0) * lcs_length(left, right) / total, 0).cast("int")
    )
