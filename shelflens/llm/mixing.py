"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.llm.common import MARK, words, write_once


@dataclass(frozen=True)
class MixConfig:
    """Sources weigh ``weights`` by turns, in the order of their names (null last)."""

    weights: tuple[float, ...] = (1.0, 2.0, 3.0)
    # Words of the mix as a share of all words, and how often a document may be taken at most.
    share: float = 1.0
    most: float = 3.0
    seed: int = 17
    # A document weighs its size to this power, unless a weight column is given.
    size_power: float = 0.5


def targets(rows: DataFrame, config: MixConfig, source: str, size: str) -> DataFrame:
    """Per source its ``source_size``, ``weight`` and ``target``.

    Targets share the mix by weight; one above ``most`` times its source's size stops
    there and the excess is reshared by weight. That comes to one level, target / weight,
    for all sources below their stop: the largest (mix - stops before) / weights of the
    rest, in the order of stop / weight. One row per source goes through the windows.
    """
    per = rows.groupBy(source).agg(F.sum(size).cast("long").alias("source_size"))
    order = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(config.weights)
    per = per.withColumn("weight", F.get(F.array(*map(F.lit, config.weights)), turn))
    per = per.withColumns({"stop": F.col("source_size") * config.most, "mix": F.sum("source_size").over(Window.partitionBy()) * config.share})
    by_stop = Window.orderBy((F.col("stop") / F.col("weight")).asc(), F.col(source).asc_nulls_last())
    before, rest = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("mix") - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    per = per.withColumn("level", F.max("level").over(Window.partitionBy()))
    target = F.least(F.col("level") * F.col("weight"), F.col("stop"))
    return per.select(source, "source_size", "weight", target.alias("target"))


# Cells per round in which the place of a source's cut is looked for, and rounds.
CELLS = 1 << 12
ROUNDS = 4


def _cut(rows: DataFrame, per: DataFrame, key: str, size: str, need: str) -> tuple[DataFrame, DataFrame]:
    """Per ``g`` the ``edge`` below which rows by their ``key`` (long below 2**48) have sizes nearest to ``need``, and rows at it.

    The cut is found by histograms of the key, each splitting the cell that holds it;
    so no source is sorted. Only rows that share the very key at the cut are numbered;
    those taken are listed by ``id``. ``per``: one row per ``g`` with ``need``. Written.
    """
    state = per.select("g", F.col(need).alias("need"), F.lit(0).cast("long").alias("low"))
    width = 1 << 48
    for _ in range(ROUNDS):
        width //= CELLS
        inside = rows.join(state, "g").filter((F.col(key) >= F.col("low")) & (F.col(key) < F.col("low") + width * CELLS))
        cell = F.floor((F.col(key) - F.col("low")) / width)
        cells = inside.groupBy("g", "low", "need", cell.alias("cell")).agg(F.sum(size).alias("s"))
        run = Window.partitionBy("g").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        cells = cells.withColumn("after", F.sum("s").over(run))
        # The first cell that reaches what is needed; the last one if none does.
        last = F.row_number().over(Window.partitionBy("g").orderBy(F.col("after") < F.col("need"), F.when(F.col("after") >= F.col("need"), F.col("cell")).otherwise(-F.col("cell"))))
        cells = cells.withColumn("k", last).filter("k = 1")
        state = cells.select("g", (F.col("need") - F.col("after") + F.col("s")).alias("need"), (F.col("low") + F.col("cell") * width).alias("low"))
        state = write_once(state, "cut")
    edges = state.withColumnsRenamed({"need": "left", "low": "edge"})
    tied = rows.join(edges, "g").filter(F.col(key) == F.col("edge")).withColumn("part", F.spark_partition_id())
    # Rows with the same key are numbered part by part: positions in a part, after the sizes of the parts before.
    tied = write_once(tied.select("id", "g", "left", F.col(size).alias("s"), "part"), "tied")
    parts = tied.groupBy("g", "part").agg(F.sum("s").alias("total"))
    parts = parts.withColumn("ahead", F.sum("total").over(Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total"))
    here = Window.partitionBy("g", "part").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    tied = tied.withColumn("here", F.sum("s").over(here)).join(parts, ["g", "part"])
    # A row is taken if that brings the sum nearer to what is needed.
    near = tied.filter(F.col("ahead") + F.col("here") - F.col("s") / 2 <= F.col("left")).select(F.col("id"), F.lit(True).alias("near"))
    return edges.select("g", "edge"), write_once(near, "near")


# Steps of a factor two that document weights are told apart by.
STEPS = 8


def expected_copies(sizes: DataFrame, per: DataFrame, config: MixConfig) -> DataFrame:
    """Per source and weight step how often a document is wanted: by weight, at most ``most`` times, and on target as a whole.

    ``sizes``: ``source, step, class_size``; ``per``: as from ``targets``. The same sharing as
    among sources, within each: one row per step of a source goes through the windows.
    """
    of = per.select(F.col("source").alias("of"), "target")
    both = sizes.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    weight = F.pow(F.lit(2.0), F.col("step") / STEPS)
    both = both.withColumns({"weight": weight, "stop": F.col("class_size") * config.most})
    whole = Window.partitionBy("source")
    # The heaviest stop first.
    before = whole.orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rest = whole.orderBy(F.col("step").desc()).rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("target") - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum(F.col("weight") * F.col("class_size")).over(rest)
    both = both.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    copies = F.least(F.col("level") * F.col("weight"), F.lit(config.most))
    return both.select("source", "step", "class_size", "target", F.greatest(copies, F.lit(0.0)).alias("expected"))


def mix(
    docs: DataFrame,
    config: MixConfig = MixConfig(),
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    size: Column | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with ``size``, ``source_size``, ``target``, ``expected``, ``copies`` and ``taken``.

    A document is wanted ``expected`` times: in proportion to its ``weight`` (default: the
    square root of its size), told apart by steps of 2 ** (1 / 8), at most ``most`` times,
    and so that the source's words come to its target. The whole part of that is certain;
    the rest is its inclusion probability for one more copy, drawn by Pareto order
    sampling: documents are ranked by the odds of a seeded hash over the odds of
    inclusion, and taken in that order until the words come nearest to what the source
    still needs. Copies are whole documents, ``taken`` is copies times size.

    Null texts have size 0; they and other empty documents, and those without a positive
    weight, are expected and taken 0 times. A null source is one of the sources. Rows with
    equal ids and texts are chosen among by their place in the files. Sources without
    words have target 0. A very long text is one document like others. An empty table
    gives an empty result. Columns named like the added ones are replaced. Starts jobs
    and writes to the shared folder.
    """
    added = ["size", "source_size", "target", "expected", "copies", "taken"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    held = [F.col(c).alias(f"{MARK}{i}") for i, c in enumerate(keep)]
    size = (F.size(words(F.col(text))) if size is None else size).cast("long")
    weight = F.pow(size.cast("double"), F.lit(config.size_power)) if weight is None else weight.cast("double")
    draw = F.concat_ws("\x1f", F.lit(config.seed), F.coalesce(F.col(id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = docs.select(
        *held,
        F.col(source).alias("source"),
        size.alias("size"),
        F.when((size > 0) & (weight > 0), F.floor(F.log2(weight) * STEPS + F.lit(1e-9))).alias("step"),
        F.conv(F.substring(F.md5(draw.cast("binary")), 1, 8), 16, 10).cast("long").alias("draw"),
        F.monotonically_increasing_id().alias("id"),
    )
    rows = write_once(rows, "sized")
    per = write_once(targets(rows, config, "source", "size"), "targets")
    classes = rows.filter(F.col("step").isNotNull()).groupBy("source", "step").agg(F.sum("size").alias("class_size"))
    classes = expected_copies(classes, per, config)
    certain = F.floor(F.col("expected") + F.lit(1e-9))
    classes = classes.withColumn("whole", certain).withColumn("part", F.greatest(F.col("expected") - certain, F.lit(0.0)))
    classes = classes.withColumn("g", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()))
    classes = write_once(classes, "classes")
    needs = classes.groupBy("g").agg((F.first("target") - F.sum(F.col("whole") * F.col("class_size"))).alias("need"), F.max("part").alias("part"))
    of_class = classes.select(F.col("source").alias("of"), F.col("step").alias("at"), "g", "expected", "whole", "part")
    of_source = per.select(F.col("source").alias("from"), "source_size", "target")
    rows = rows.join(of_source, F.col("source").eqNullSafe(F.col("from")))
    rows = rows.join(of_class, F.col("source").eqNullSafe(F.col("of")) & (F.col("step") == F.col("at")), "left")
    # Odds of the draw over odds of inclusion, mapped to [0, 1) and to an integer.
    u, p = (F.col("draw") + 0.5) / F.lit(2.0**32), F.col("part")
    odds = u * (1 - p) / ((1 - u) * p)
    rows = rows.withColumn("key", F.when(p > 0, F.floor(odds / (1 + odds) * F.lit(2.0**48 - 1)).cast("long")))
    open_rows = rows.filter("key IS NOT NULL").select("id", "g", "key", "size")
    edges, near = _cut(open_rows, needs.filter("part > 0"), "key", "size", "need")
    more = (F.col("key") < F.col("edge")) | F.coalesce(F.col("near"), F.lit(False))
    out = rows.join(edges, "g", "left").join(near, "id", "left")
    copies = F.coalesce(F.col("whole"), F.lit(0)) + F.coalesce(more, F.lit(False)).cast("long")
    out = out.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    out = out.withColumn("expected", F.coalesce("expected", F.lit(0.0)))
    return out.select(*[F.col(f"{MARK}{i}").alias(c) for i, c in enumerate(keep)], *added)
