"""Random order and even shards by a two-pass external shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from shelflens.llm.common import MARK, with_field, write_once

# Bytes of records that a bucket holds, about: what a task shuffles in memory.
BUCKET_BYTES = 16 << 20
# Buckets whose starts one task sums up.
RUN = 1 << 12


def permutation(n: int, seed: int | list[int]) -> np.ndarray:
    """Fisher-Yates: each place from the last to the second swaps with one at or before it."""
    order = list(range(n))
    picks = np.random.default_rng(seed).random(n)
    for i in range(n - 1, 0, -1):
        j = int(picks[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def bucket_starts(buckets: DataFrame, bucket: str) -> DataFrame:
    """Per bucket the number of rows in the buckets before it (``start``) and in all (``all``).

    Sums run within runs of RUN buckets, and over the runs; so no task orders more than
    RUN buckets or all runs.
    """
    counts = buckets.groupBy(bucket).agg(F.count("*").alias("n")).withColumn("run", F.floor(F.col(bucket) / RUN))
    runs = counts.groupBy("run").agg(F.sum("n").alias("run_n"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("run", F.coalesce(F.sum("run_n").over(before), F.lit(0)).alias("run_start"), F.sum("run_n").over(Window.partitionBy()).alias("all"))
    inside = Window.partitionBy("run").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return counts.join(runs, "run").select(bucket, (F.col("run_start") + F.col("inside")).alias("start"), "all")


def shuffle_shards(docs: DataFrame, shards: int = 16, seed: int = 7, size: str = "size", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns with ``shard`` and ``slot``: records in random order, shard sizes at most one apart.

    First pass: records are scattered uniformly into buckets of about ``bucket_bytes``
    (by ``size``, bytes of a record) by a seeded hash of their place in the input, and
    written. Second pass: each bucket is read into memory and put in order by a seeded
    Fisher-Yates shuffle. A record's place is that of its bucket plus its place therein;
    the first ``n % shards`` shards have one record more, slots run from 0.

    The hash takes the place of a row in the input files, not its contents, so that
    repeated rows scatter like others; runs agree as long as files and the size of
    splits stay the same. A record larger than a bucket is one all the same: its task holds it
    and the others of its bucket. Null sizes count as 1. Columns named ``shard`` or ``slot``
    are replaced. An empty table gives an empty result. Starts jobs and writes to the
    shared folder.
    """
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    place, bucket, at = f"{MARK}place", f"{MARK}bucket", f"{MARK}at"
    total = docs.agg(F.sum(F.coalesce(F.col(size), F.lit(1)))).first()[0] or 0
    buckets = int(total // bucket_bytes) + 1
    scattered = docs.select(*keep).withColumn(place, F.monotonically_increasing_id())
    scattered = scattered.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), place), F.lit(buckets)))
    scattered = write_once(scattered, "scattered")
    schema = with_field(scattered.schema, **{at: LongType(), "start": LongType(), "all": LongType()})

    def run_bucket(records: pa.Table, ahead: pa.Table) -> pa.Table:
        records = records.sort_by(place)
        n, bounds = records.num_rows, ahead.select(["start", "all"]).to_pylist()[0]
        records = records.take(pa.array(permutation(n, [seed, ahead.column("bucket")[0].as_py()])))
        records = records.append_column(at, pa.array(np.arange(n, dtype=np.int64)))
        for name, value in bounds.items():
            records = records.append_column(name, pa.array(np.full(n, value, np.int64)))
        return records

    starts = bucket_starts(scattered.select(F.col(bucket).alias("bucket")), "bucket")
    # The bounds meet the records within the one exchange by bucket, so no record moves again.
    shuffled = scattered.groupBy(bucket).cogroup(starts.groupBy("bucket")).applyInArrow(run_bucket, schema)
    spot = F.col("start") + F.col(at)
    least, extra = F.floor(F.col("all") / shards), F.col("all") % shards
    ahead = extra * (least + 1)  # records in the shards that have one more
    early = spot < ahead
    shard = F.when(early, F.floor(spot / (least + 1))).otherwise(extra + F.floor((spot - ahead) / F.greatest(least, F.lit(1))))
    slot = F.when(early, spot % (least + 1)).otherwise((spot - ahead) % F.greatest(least, F.lit(1)))
    return shuffled.select(*keep, shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))
