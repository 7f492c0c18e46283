"""Rows that streams carry from one micro-batch to the next."""

import os
from collections import Counter

from pyspark.sql import functions as F

from shelflens.streaming.affinity import stream_pair_counts, write_batches
from tests.test_streaming import LINES, lines_of


def run(spark, schema, make, folder):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = write_batches(make(stream), f"{folder}/out", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    return query


def pairs(stream):
    return stream_pair_counts(stream, delay="3 days")


def send(df, folder):
    df.coalesce(1).write.mode("append").parquet(f"{folder}/in")


def given(spark, folder):
    found = spark.read.parquet(f"{folder}/out").select(F.col("window.start").cast("string"), "product_a", "product_b", "pair_count")
    return sorted(map(tuple, found.collect()))


def test_no_open_line_is_kept_in_the_memory_of_executors(spark, tmp_path):
    folder = str(tmp_path)
    for week in range(4):
        send(lines_of(spark, [(4 * week + i, week, p, 168 * week) for i, p in enumerate("aabc")]), folder)
    query = run(spark, LINES, pairs, folder)
    assert len(query.recentProgress) >= 4 and not any(p.stateOperators for p in query.recentProgress)
    carried = os.listdir(f"{folder}/checkpoint/open")
    assert sorted(carried) == ["batch=2", "batch=3"]  # that of the last micro-batch, and of the one before for a repeat
    assert spark.read.parquet(f"{folder}/checkpoint/open/batch=3").count() <= 12


def test_a_repeated_micro_batch_gives_the_same(spark, tmp_path):
    folder = str(tmp_path)
    for week in range(4):
        send(lines_of(spark, [(4 * week + i, week, p, 168 * week) for i, p in enumerate("aabc")]), folder)
        run(spark, LINES, pairs, folder)
    before = given(spark, folder)
    assert before
    for name in ("3", ".3.crc"):  # as if the run had ended before the last commit
        os.remove(f"{folder}/checkpoint/commits/{name}")
    run(spark, LINES, pairs, folder)
    assert given(spark, folder) == before


def test_the_first_line_of_an_id_counts_also_when_its_window_is_given_out(spark, tmp_path):
    """Sent again with other contents: in the same micro-batch, in a later one, and after its window."""
    folder = str(tmp_path)
    send(lines_of(spark, [(1, 1, "a", 160), (2, 1, "b", 160), (2, 1, "b", 160), (None, 1, "c", 160), (None, 1, "c", 160)]), folder)
    run(spark, LINES, pairs, folder)
    send(lines_of(spark, [(1, 1, "z", 170), (3, 9, None, 168 + 73)]), folder)  # closes the first window
    run(spark, LINES, pairs, folder)
    send(lines_of(spark, [(2, 5, "y", 200), (4, 5, "x", 200), (5, 9, None, 2000)]), folder)
    run(spark, LINES, pairs, folder)
    assert Counter(r[1:] for r in given(spark, folder)) == Counter([("a", "b", 1), ("a", "c", 1), ("b", "c", 1)])
