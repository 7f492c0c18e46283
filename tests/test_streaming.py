"""Streams against the batch operators: shuffled files, late and repeated lines, restarts."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelflens.config import FraudConfig
from shelflens.operators import affinity as aff
from shelflens.operators.fraud import fraud_patterns
from shelflens.streaming.affinity import stream_pair_counts, write_batches
from shelflens.streaming.fraud import DAY_MS, _watch, _watch_shared, stream_fraud_patterns

LINES = "line_item_id long, transaction_id long, product_id string, sold_at timestamp"
START = "2024-01-01 00:00:00"


def lines_of(spark, rows):
    df = spark.createDataFrame(rows, "line_item_id long, transaction_id long, product_id string, hours int")
    return df.select("line_item_id", "transaction_id", "product_id", (F.lit(START).cast("timestamp") + F.make_dt_interval(F.lit(0), "hours")).alias("sold_at"))


def run_stream(spark, source, out, checkpoint, **options):
    stream = spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(source)
    query = write_batches(stream_pair_counts(stream, **options), out, checkpoint).trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None


def counted(spark, out):
    found = spark.read.parquet(out).select(F.col("window.start").cast("string"), "product_a", "product_b", "pair_count")
    return sorted(map(tuple, found.collect()))


def expected(df, distinct=False):
    """The batch operators, window by window."""
    spans = df.withColumn("span", F.window("sold_at", "7 days")["start"].cast("string")).filter("product_id IS NOT NULL")
    want = []
    for span in sorted(r[0] for r in spans.select("span").distinct().collect()):
        pairs = aff.product_pairs(aff.basket_items(spans.filter(F.col("span") == span)), distinct)
        want += [(span, *r) for r in aff.pair_counts(pairs).select("product_a", "product_b", "pair_count").collect()]
    return sorted(want)


@pytest.fixture
def sales():
    rng = random.Random(6)
    rows, line = [], 0
    for transaction in range(60):
        hour = rng.randrange(24 * 24)
        for _ in range(rng.randrange(1, 7)):
            line += 1
            rows.append((line, transaction, rng.choice(["a", "b", "c", "d", None]), hour + rng.choice([0, 0, 1])))
    return rows


@pytest.mark.parametrize("distinct", [False, True])
def test_shuffled_files_give_the_batch_counts(spark, tmp_path, sales, distinct):
    """Disorder within the delay, repeated lines, and a restart between the files."""
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    ordered = sorted(sales, key=lambda r: r[3] + random.Random(r[0]).randrange(70))  # up to 70 hours late
    parts = [ordered[k : k + 45] for k in range(0, len(ordered), 45)]
    for k, part in enumerate(parts):
        repeated = part + part[:10] + (parts[k - 1][-5:] if k else [])
        lines_of(spark, repeated).coalesce(1).write.mode("append").parquet(folder)
        if k in (1, len(parts) - 1):
            run_stream(spark, folder, out, checkpoint, delay="3 days", distinct=distinct)
    lines_of(spark, [(10**6, 10**6, None, 24 * 90)]).coalesce(1).write.mode("append").parquet(folder)
    run_stream(spark, folder, out, checkpoint, delay="3 days", distinct=distinct)
    once = lines_of(spark, sales)
    assert counted(spark, out) == expected(once, distinct)
    before = counted(spark, out)
    run_stream(spark, folder, out, checkpoint, delay="3 days", distinct=distinct)  # nothing new
    assert counted(spark, out) == before


def test_late_lines_are_left_out(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for rows in (
        [(1, 1, "a", 0), (2, 1, "b", 0)],
        [(3, 2, "a", 24 * 20), (4, 2, "c", 24 * 20)],
        [(5, 3, "a", 1), (6, 3, "b", 1), (7, 4, "b", 24 * 19), (8, 4, "c", 24 * 19)],  # the first two are 20 days late
        [(9, 9, None, 24 * 90)],
    ):
        lines_of(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        run_stream(spark, folder, out, checkpoint, delay="2 days")
    assert [r[1:] for r in counted(spark, out)] == [("a", "b", 1), ("a", "c", 1), ("b", "c", 1)]


REFUNDS = "refund_id string, customer_id long, product_id string, refund_date date, refund_amount double, refund_ratio double, payment_mode string, original_payment_mode string, days_since_purchase int"
SPANS = FraudConfig(
    refund_window_days=30,
    product_window_days=60,
    max_refunds=2,
    max_same_product_refunds=1,
    high_value_amount=90.0,
    high_value_frequent_enabled=True,
    high_value_frequent_amount=120.0,
    outside_window_enabled=True,
)


def refunds_of(spark, rows):
    plain = [(f"r{i}", c, p, d, a, a / 50 if a else None, "CASH", "CARD" if i % 9 == 0 else "CASH", i % 40) for i, c, p, d, a in rows]
    return spark.createDataFrame([(*r[:3], None if r[3] is None else datetime.date(2024, 1, 1) + datetime.timedelta(r[3]), *r[4:]) for r in plain], REFUNDS)


def flagged(df):
    return rows_of(df.select("refund_id", "customer_id", "refund_amount", "refund_date", "refund_count", "product_refund_count", "fraud_flags", "fraud_score"))


def rows_of(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def run_refunds(spark, folder, out, checkpoint, delay):
    stream = spark.readStream.schema(REFUNDS).option("maxFilesPerTrigger", 1).parquet(folder)
    query = write_batches(stream_fraud_patterns(stream, SPANS, delay), out, checkpoint).trigger(availableNow=True).start()
    query.awaitTermination(300)


def test_refunds_on_arrival_like_the_batch(spark, tmp_path):
    """Disorder within the delay, null customers, products and amounts, repeats, a restart between all files."""
    rng = random.Random(3)
    refunds = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["a", "b", None]), rng.randrange(200), rng.choice([10.0, 60.0, 95.5, None])) for i in range(150)]
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    ordered = sorted(refunds, key=lambda r: r[3] + random.Random(r[0]).randrange(9))
    for k in range(0, len(ordered), 40):
        refunds_of(spark, ordered[max(0, k - 3) : k + 40]).coalesce(1).write.mode("append").parquet(folder)
        run_refunds(spark, folder, out, checkpoint, "9 days")
    refunds_of(spark, [(999, 77, "z", 2000, 1.0), (998, 1, "a", None, 5.0)]).coalesce(1).write.mode("append").parquet(folder)
    run_refunds(spark, folder, out, checkpoint, "9 days")
    want = fraud_patterns(refunds_of(spark, refunds), SPANS)
    got, wanted = flagged(spark.read.parquet(out)), flagged(want)
    assert [r for r in got if r not in wanted] == [r for r in wanted if r not in got] == [] and len(got) == len(wanted)
    assert any("HIGH_VALUE_FREQUENT" in r[6] for r in flagged(want)) and any("REPEAT_PRODUCT" in r[6] for r in flagged(want))


class State:
    """A customer's state, as far as the function looks at it."""

    def __init__(self):
        self.value, self.due, self.passed = None, None, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, due):
        assert due > self.passed
        self.due = due

    def getCurrentWatermarkMs(self):
        return self.passed


def test_state_is_bounded_by_the_longest_span():
    run, state, sizes = _watch((30, 60, 30)), State(), []
    for day in range(100, 1100):
        state.passed = max(0, day - 10) * DAY_MS
        batch = pd.DataFrame({"day": [day], "product": ["a"], "amount": [1.0], "row": [f"r{day}"]})
        given = pd.concat([pd.DataFrame(columns=["row", "refund_count"]), *run(("1",), iter([batch]), state)])
        assert all(given["refund_count"] == [min(31, int(r[1:]) - 99) for r in given["row"]])
        sizes.append(sum(map(len, state.value)))
    assert max(sizes) <= 4 * 72 + 3 * 11
    state.passed = state.due + 1
    assert len(pd.concat(list(run(("1",), iter([]), state)))) and state.exists
    while state.exists:  # timers only
        state.passed = state.due + 1
        list(run(("1",), iter([]), state))
    assert state.passed <= (1099 + 62) * DAY_MS


def test_spans_must_be_named(spark):
    with pytest.raises(ValueError):
        stream_fraud_patterns(refunds_of(spark, []), FraudConfig())


def test_customers_sharing_a_key_count_as_on_keys_of_their_own():
    """One call serves all customers of a key, with what each would get alone; the key's timer is their earliest."""
    spans, shared, alone = (30, 60, 30), State(), {c: State() for c in "xyz"}
    run, one, got, want = _watch_shared(spans), _watch(spans), [], []
    rng = random.Random(5)
    for day in range(100, 400, 3):
        passed = max(0, day - 10) * DAY_MS
        rows = [(rng.choice(["x", "y", "z", None]), day - rng.randrange(5), rng.choice(["a", "b", None]), rng.choice([10.0, None])) for _ in range(rng.randrange(4))]
        batch = pd.DataFrame({"customer": [r[0] for r in rows], "day": [r[1] for r in rows], "product": [r[2] for r in rows], "amount": [r[3] for r in rows], "row": [f"r{day}-{i}" for i in range(len(rows))]})
        shared.passed = passed
        got.extend(run((0,), iter([batch]), shared))
        for c, state in alone.items():
            state.passed = passed
            own = batch[batch["customer"] == c]
            if len(own) or (state.exists and state.due < passed):
                want.extend(one((c,), iter([own]), state))
        want.extend(one((None,), iter([batch[batch["customer"].isna()]]), State()))
    assert shared.due == min(s.due for s in alone.values() if s.exists)
    for c, state in alone.items():
        state.passed = shared.passed = 10_000 * DAY_MS
        want.extend(one((c,), iter([]), state))
    got.extend(run((0,), iter([]), shared))
    table = lambda frames: sorted(map(tuple, pd.concat(frames).astype(str).values.tolist()))
    assert table(got) == table(want) and len(table(got)) > 50 and not shared.exists
