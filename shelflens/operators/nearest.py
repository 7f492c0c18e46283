"""Most similar known text of every other one: tries in shards, visited only where a better score is possible."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelflens.functions import tries
from shelflens.functions.tries import Summaries, Tries, summary
from shelflens.sources.shared import write_once

# The searches run in Python workers; their helpers travel with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(tries)

# Characters in a shard, about, and shards there are at most; beyond, shards get larger, not more.
SHARD_CHARS = 1 << 19
MAX_SHARDS = 2048
# Texts that are searched for in one shard by one task, about.
TEXTS = 1 << 13

def shards(choices: DataFrame) -> DataFrame:
    """The known texts (``text, rank, choice``, distinct) with their ``shard``: runs in the order of length and text.

    Neighbours share beginnings, so a shard is few paths of a trie, and few characters
    are possible at its first positions. Written, with at most 2 * MAX_SHARDS shards.
    """
    size = F.length("text") + 1
    total = choices.agg(F.sum(size)).first()[0] or 0
    width = max(SHARD_CHARS, -(-total // MAX_SHARDS))
    ranges = int(total // width) + 1
    ranged = choices.withColumn("length", F.length("text")).repartitionByRange(ranges, "length", "text")
    ranged = write_once(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    before = F.coalesce(F.sum(size).over(Window.partitionBy("range").orderBy("length", "text").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    run = F.floor(before / width).cast("long")
    return write_once(ranged.select("text", "rank", "choice", (F.col("range") * F.lit(1 << 20).cast("long") + run).alias("shard")), "shards")


def summaries(sharded: DataFrame) -> tuple[list[int], Summaries]:
    """The number and the summary of every shard: at most 2 * MAX_SHARDS rows of about 2 KB."""

    def run(rows: pa.Table) -> pa.Table:
        low, high, bits = summary(rows.column("text").to_pylist())
        return pa.table({"shard": rows.column("shard").slice(0, 1), "low": [low], "high": [high], "bits": pa.array([bits], pa.binary())})

    found = sharded.select("shard", "text").groupBy("shard").applyInArrow(run, "shard long, low long, high long, bits binary")
    rows = sorted(found.collect())
    return [r.shard for r in rows], Summaries([r.low for r in rows], [r.high for r in rows], [bytes(r.bits) for r in rows])


def _route(texts: DataFrame, numbers: list[int], whole: Summaries, threshold: int, first: bool) -> DataFrame:
    """Rows ``text, least, shard`` (``text, least`` given): the most promising shard of a text, or all others that can do better."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.array(numbers, np.int64)
        for batch in batches:
            held: list[tuple[str, int, np.ndarray]] = []
            for text, least in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bounds = whole.bounds(text)
                top = int(bounds.argmax())
                good = (bounds > least) | ((bounds == least) & (least >= threshold))
                if first:
                    good &= np.arange(len(bounds)) == top
                else:
                    good[top] = False
                held.append((text, least, place[good]))
            sizes = [len(p) for _, _, p in held]
            owner = np.repeat(np.arange(len(held)), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)), pa.array(np.concatenate([p for _, _, p in held] or [np.zeros(0, np.int64)]))],
                names=["text", "least", "shard"],
            )

    return texts.select("text", F.col("least").cast("long").alias("least")).mapInArrow(run, "text string, least long, shard long")


def _search(routed: DataFrame, sharded: DataFrame, threshold: int) -> DataFrame:
    """Rows ``text, score, rank, choice, nodes``: what a shard has for the texts sent to it; choices only from the threshold on.

    A shard that many texts are sent to is handed to several tasks, each with a part
    of the texts.
    """
    rank = sharded.schema["rank"].dataType
    routed = write_once(routed, "routed")
    # One row per shard at most.
    parts = routed.groupBy("shard").agg(F.ceil(F.count("*") / TEXTS).cast("int").alias("parts"))
    asked = routed.join(F.broadcast(parts), "shard").withColumn("part", F.pmod(F.xxhash64("text"), F.col("parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    members = sharded.join(F.broadcast(parts), "shard").select("shard", every, "text", "rank", "choice")
    tasks = max(sharded.sparkSession.sparkContext.defaultParallelism, routed.count() // TEXTS)

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        texts, least = mine.column("text").to_pylist(), mine.column("least").to_numpy().astype(np.int64)
        best, pairs, nodes = Tries(theirs.column("text").to_pylist()).best(texts, least, threshold)
        ranks, choices = theirs.column("rank").to_pylist(), theirs.column("choice").to_pylist()
        first: dict[int, tuple] = {}
        for queries, found in pairs:
            for q, m in zip(queries.tolist(), found.tolist()):
                here = (ranks[m] is not None, ranks[m], choices[m])
                if q not in first or here < first[q]:
                    first[q] = here
        # Rows that found nothing better stand for the comparison itself.
        top = [first.get(q) for q in range(len(texts))]
        score = [int(b) if t or b < threshold else -1 for b, t in zip(best, top)]
        return pa.table(
            {
                "text": mine.column("text"),
                "score": pa.array(score, pa.int32()),
                "rank": pa.array([t and t[1] for t in top], theirs.schema.field("rank").type),
                "choice": pa.array([t and t[2] for t in top], pa.string()),
                "nodes": pa.array(nodes),
            }
        )

    # A fixed number of partitions, for AQE would merge these small ones into one task.
    asked, members = (df.repartition(tasks, "shard", "part") for df in (asked, members))
    schema = f"text string, score int, rank {rank.simpleString()}, choice string, nodes long"
    return asked.groupBy("shard", "part").cogroup(members.groupBy("shard", "part")).applyInArrow(run, schema)


def nearest(texts: DataFrame, choices: DataFrame, threshold: int, low_scores: bool = True) -> DataFrame:
    """Best score of each of ``texts`` (distinct) among ``choices`` (``text, rank, choice``, distinct): ``text, score, rank, choice, nodes``.

    A row or more per text; the highest score counts, and of rows that share it the
    first rank. Choices are named where the score reaches the threshold; below, the
    score stands alone, or with ``low_scores=False`` is -1 or missing.

    Shards of the known texts, in order, are tries; what they allow at most is known
    from the characters that occur at each position. A text is searched for in the most
    promising shard first, and then only in those whose bound its score so far does not
    exceed. In a trie, paths share the work of all texts below and end where their bound does
    not exceed the score so far. ``nodes`` counts the nodes visited. Both tables should
    be written ones. Starts jobs.
    """
    sharded = shards(choices)
    numbers, whole = summaries(sharded)
    if not numbers:
        return sharded.select("text", F.lit(0).alias("score"), "rank", "choice", F.lit(0).cast("long").alias("nodes")).limit(0)
    least = F.lit(-1 if low_scores else threshold - 1)
    first = _search(_route(texts.select("text", least.alias("least")), numbers, whole, threshold, True), sharded, threshold)
    first = write_once(first, "first")
    # Texts whose most promising shard allows nothing better are not in it, nor is there any other for them.
    so_far = first.select("text", F.greatest("score", least).alias("least"))
    rest = _search(_route(so_far, numbers, whole, threshold, False), sharded, threshold)
    return first.unionByName(write_once(rest, "rest"))
