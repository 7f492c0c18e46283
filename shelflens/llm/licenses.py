"""License notices: lines and whole texts against templates, by the Dice coefficient over word bigrams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.llm.common import MARK

# Templates by name: common one-line notices. A parameter, so that longer texts can be added.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
THRESHOLD = 0.8


def normalised(text: Column) -> Column:
    """Lower-case runs of A-Z and 0-9, joined by one space."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def _bigrams(plain: str) -> list[str]:
    words = plain.split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with ``n_notices``, ``licenses`` and ``best_dice``.

    Units are the lines of a text, and the whole text if it has several. A unit matches
    the template with the highest Dice coefficient of distinct word bigrams, at
    ``threshold`` or more (ties: first name). 2 * min(a, b) / (a + b) bounds the
    coefficient, so units with too few or too many words for every template are passed
    over, and a unit is compared only with the templates whose size is in its bounds.
    ``licenses`` are the distinct names, sorted and comma-joined; ``best_dice`` is 0 if
    no unit matches. Null and empty texts have no units. Nothing is shuffled; repeated
    rows get the same result, an empty table an empty one, and columns named like the
    added ones are replaced.
    """
    added = ["n_notices", "licenses", "best_dice"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    grams = {name: _bigrams(" ".join(_plain(t))) for name, t in sorted((templates or TEMPLATES).items())}
    grams = {name: g for name, g in grams.items() if g}
    ratio = threshold / (2 - threshold)  # least ratio of the smaller to the larger set
    # A text of w words has w - 1 bigrams at most; repeated ones make it fewer, so only a lower bound prunes by words.
    low = min(len(g) * ratio for g in grams.values()) + 1
    units, plain = f"{MARK}units", f"{MARK}plain"
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(body, "\n")
    held = [F.col(c).alias(f"{MARK}{i}") for i, c in enumerate(keep)]
    df = docs.select(*held, F.when(F.size(lines) > 1, F.concat(lines, F.array(body))).otherwise(lines).alias(units))
    # Bigrams of a unit: neighbours in its list of words.
    words = lambda unit: F.split(normalised(unit), " ")
    df = df.withColumn(plain, F.filter(F.transform(units, words), lambda w: F.size(w) >= low)).drop(units)
    pairs = lambda w: F.array_distinct(F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b)))
    df = df.withColumn(plain, F.transform(plain, pairs))

    def best(unit: Column) -> Column:
        n = F.size(unit)
        scores = [
            F.when(
                (n >= len(g) * ratio) & (n <= len(g) / ratio),
                2.0 * F.size(F.array_intersect(unit, F.array(*map(F.lit, g)))) / (n + len(g)),
            ).otherwise(F.lit(0.0))
            for g in grams.values()
        ]
        return F.array_max(F.array(*[F.struct(s.alias("dice"), F.lit(-i).alias("k")) for i, s in enumerate(scores)]))

    largest = max(len(g) / ratio for g in grams.values())
    df = df.withColumn(plain, F.transform(F.filter(plain, lambda u: F.size(u) <= largest), best))
    df = df.withColumn(plain, F.filter(plain, lambda m: m["dice"] >= threshold))
    names = F.array(*map(F.lit, grams))
    found = F.array_sort(F.array_distinct(F.transform(plain, lambda m: F.get(names, -m["k"]))))
    dice = F.coalesce(F.array_max(F.transform(plain, lambda m: m["dice"])), F.lit(0.0))
    out = [F.size(plain).cast("long").alias(added[0]), F.array_join(found, ",").alias(added[1]), dice.alias(added[2])]
    return df.select(*[F.col(f"{MARK}{i}").alias(c) for i, c in enumerate(keep)], *out)


def _plain(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
