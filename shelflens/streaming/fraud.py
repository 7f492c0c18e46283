"""Behaviour rules on a stream of refunds: counts over the last days, of refunds that are carried over until they expire."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelflens.config import FraudConfig
from shelflens.operators.fraud import pattern_flags
from shelflens.streaming.carried import Carried, micros

DAY_MS = 86_400_000
# Customers share so many keys, each call of the state function serving all customers of one; refunds
# without a customer have no state and are dealt to them by their id.
BUCKETS = 1024

# Per day and product what was refunded, and the refunds of days that are still open.
STATE = "day array<int>, product array<string>, number array<long>, amount array<double>, open_day array<int>, open_product array<string>, open_row array<string>"
COUNTS = "row string, refund_count long, product_refund_count long, recent_count long, recent_amount double"
# The state of the customers of a key: that of each customer, with the customer on every entry.
BUCKET_STATE = "customer array<string>, " + STATE.replace(", open_day", ", open_customer array<string>, open_day")


def _counts(sums: dict[tuple, list], day: int, product: str | None, spans: tuple[int, int, int]) -> tuple:
    """Refunds of the customer, of the product, and refunds and amount again, over the spans of days up to ``day``."""
    refunds = of_product = recent = 0
    amount = 0.0
    for (then, what), (n, value) in sums.items():
        age = day - then
        if age < 0:
            continue
        refunds += n * (age <= spans[0])
        of_product += n * (age <= spans[1] and what == product)
        recent += n * (age <= spans[2])
        amount += value * (age <= spans[2])
    return refunds, None if product is None else of_product, recent, amount


def _watch(spans: tuple[int, int, int]):
    """The function of one customer's state: collects refunds, and gives out those of days that the watermark has passed."""
    names = [c.split()[0] for c in COUNTS.split(", ")]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            for batch in batches:
                yield pd.DataFrame({n: batch["row"] if n == "row" else None for n in names}, dtype=object)
            return
        held = state.get if state.exists else ([],) * 7
        sums = {(d, p): [n, a] for d, p, n, a in zip(*held[:4])}
        waiting = list(zip(*held[4:]))
        for batch in batches:
            for day, product, amount, row in zip(batch["day"], batch["product"], batch["amount"], batch["row"]):
                product = product if isinstance(product, str) else None
                entry = sums.setdefault((int(day), product), [0, 0.0])
                entry[0] += 1
                entry[1] += 0.0 if pd.isna(amount) else float(amount)
                waiting.append((int(day), product, row))
        passed = state.getCurrentWatermarkMs()
        done = [w for w in waiting if (w[0] + 1) * DAY_MS <= passed]
        if done:
            yield pd.DataFrame([(row, *_counts(sums, day, product, spans)) for day, product, row in done], columns=names, dtype=object)
            waiting = [w for w in waiting if (w[0] + 1) * DAY_MS > passed]
        # What no later refund can count any more; later ones are not older than the watermark.
        first = min([passed // DAY_MS, *[w[0] for w in waiting]]) - max(spans)
        sums = {k: v for k, v in sums.items() if k[0] >= first}
        if not sums:
            state.remove()
            return
        days = [d for d, _ in sums]
        state.update((days, [p for _, p in sums], [n for n, _ in sums.values()], [a for _, a in sums.values()], *[[w[i] for w in waiting] for i in range(3)]))
        due = min(w[0] for w in waiting) + 1 if waiting else max(days) + max(spans) + 1
        state.setTimeoutTimestamp(max(due * DAY_MS, passed + 1))

    return run


class _Held:
    """One customer's state within the state of its key."""

    def __init__(self, value: tuple | None, passed: int):
        self.value, self.due, self.passed = value, None, passed

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value: tuple) -> None:
        self.value = value

    def remove(self) -> None:
        self.value = None

    def setTimeoutTimestamp(self, due: int) -> None:
        self.due = due

    def getCurrentWatermarkMs(self) -> int:
        return self.passed


def _watch_shared(spans: tuple[int, int, int]):
    """The function of a key that many customers share: ``_watch`` for each of them, on its own part of the state.

    Every customer of the key is looked at on each call, so that refunds whose day has
    passed come out then; the key's timer is the earliest of its customers'.
    """
    one = _watch(spans)
    names = [c.split()[0] for c in COUNTS.split(", ")]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs()
        held = state.get if state.exists else ([],) * 9
        mine: dict[str, list[list]] = {}
        for customer, *entry in zip(*held[:5]):
            for part, value in zip(mine.setdefault(customer, [[] for _ in range(7)])[:4], entry):
                part.append(value)
        for customer, *entry in zip(*held[5:]):
            for part, value in zip(mine.setdefault(customer, [[] for _ in range(7)])[4:], entry):
                part.append(value)
        came = [b for b in batches if len(b)]
        rows = pd.concat(came, ignore_index=True) if came else pd.DataFrame(columns=["customer", "day", "product", "amount", "row"])
        given, kept = [], []
        unknown = rows["customer"].isna()
        if unknown.any():
            given.extend(one((None,), iter([rows[unknown]]), _Held(None, passed)))
        new = dict(tuple(rows[~unknown].groupby("customer", sort=False)))
        for customer in dict.fromkeys([*mine, *new]):
            own = _Held(tuple(mine[customer]) if customer in mine else None, passed)
            given.extend(one((customer,), iter([new[customer]] if customer in new else []), own))
            if own.exists:
                kept.append((customer, own))
        if given:
            yield pd.concat(given, ignore_index=True)
        if not kept:
            if state.exists:
                state.remove()
            return
        value = [[] for _ in range(9)]
        for customer, own in kept:
            sums, waiting = own.value[:4], own.value[4:]
            value[0].extend([customer] * len(sums[0]))
            for i in range(4):
                value[1 + i].extend(sums[i])
            value[5].extend([customer] * len(waiting[0]))
            for i in range(3):
                value[6 + i].extend(waiting[i])
        state.update(tuple(value))
        state.setTimeoutTimestamp(max(min(own.due for _, own in kept), passed + 1))

    return run


def _spans(config: FraudConfig) -> tuple[int, int, int]:
    spans = (config.refund_window_days, config.product_window_days, config.high_value_frequent_days)
    if None in spans:
        raise ValueError("a stream needs refund_window_days and product_window_days")
    return spans


def stream_fraud_patterns(validated: DataFrame, config: FraudConfig, delay: str = "31 days") -> Carried:
    """As ``fraud_patterns`` with spans of days, for a stream of validated refunds: the refunds with flags and points.

    ``config`` must name ``refund_window_days`` and ``product_window_days``. A refund is
    given out, once, when its day is closed: when the latest refund date seen is
    ``delay`` past it. Its counts cover all refunds of its customer within the days
    before and on its own, whatever the order in which they came. Refunds that come later
    than the delay are left out, as are those without a date; one that is sent again
    counts once. Refunds without a customer pass with null counts.

    Carried over are the refunds of open days, and of those before, for the longest span,
    what counts need. Counts are made per customer, product and day and joined to the refunds.
    """
    spans = _spans(config)
    day, day_length = F.unix_date(F.to_date("refund_date")), DAY_MS * 1000
    time = day.cast("long") * day_length
    late = micros(validated.sparkSession, delay)

    def flagged(due: DataFrame, kept: DataFrame) -> DataFrame:
        # As in the sums of a state: an amount that is missing or no number adds nothing.
        amount = F.coalesce(F.nanvl(F.col("refund_amount").cast("double"), F.lit(0.0)), F.lit(0.0))
        sums = (
            kept.filter(F.col("customer_id").isNotNull())
            .groupBy(F.col("customer_id").alias("_customer"), F.col("product_id").alias("_product"), day.alias("_day"))
            .agg(F.count("*").alias("_count"), F.sum(amount).alias("_amount"))
        )

        def recent(column: str, days: int, *keys: str) -> Column:
            return F.sum(column).over(Window.partitionBy("_customer", *keys).orderBy("_day").rangeBetween(-days, Window.currentRow))

        counts = sums.select(
            "_customer",
            "_product",
            "_day",
            recent("_count", spans[0]).alias("refund_count"),
            F.when(F.col("_product").isNotNull(), recent("_count", spans[1], "_product")).alias("product_refund_count"),
            recent("_count", spans[2]).alias("recent_count"),
            recent("_amount", spans[2]).alias("recent_amount"),
        )
        match = (F.col("customer_id") == F.col("_customer")) & F.col("product_id").eqNullSafe(F.col("_product")) & (day == F.col("_day"))
        return pattern_flags(due.join(counts, match, "left").drop("_customer", "_product", "_day"), config)

    lasting = ["refund_id", "customer_id", "product_id", "refund_date", "refund_amount"]
    return Carried(validated, "refund_id", time, time + day_length, late, max(late, (max(spans) + 1) * day_length), lasting, flagged)


def keyed_fraud_patterns(validated: DataFrame, config: FraudConfig, delay: str = "31 days") -> DataFrame:
    """The rows of ``stream_fraud_patterns`` as a plain streaming frame, for any sink: the state is Spark's, in memory.

    A customer's state is one entry per day and product with refunds in the longest span, and
    the refunds of open days; a timer removes it when the last entry expires. Customers
    share ``BUCKETS`` keys by their hash, so that one call serves many of them. For
    micro-batches whose refunds, with those of open days, fit into the executors.
    """
    spans = _spans(config)
    columns = validated.columns
    once = (
        validated.filter("refund_date IS NOT NULL")
        .withColumn("_time", F.to_timestamp(F.to_date("refund_date")))
        .withWatermark("_time", delay)
        .dropDuplicatesWithinWatermark(["refund_id"])
    )
    customer = F.col("customer_id").cast("string")
    keyed = once.select(
        customer.alias("customer"),
        F.pmod(F.xxhash64(F.coalesce(customer, F.col("refund_id"))), F.lit(BUCKETS)).alias("bucket"),
        "_time",
        F.unix_date(F.to_date("refund_date")).alias("day"),
        F.col("product_id").cast("string").alias("product"),
        F.col("refund_amount").cast("double").alias("amount"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row"),
    )
    counted = keyed.groupBy("bucket").applyInPandasWithState(
        _watch_shared(spans), COUNTS, BUCKET_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    rows = counted.withColumn("r", F.from_json("row", validated.schema)).select("r.*", *[c.split()[0] for c in COUNTS.split(", ")[1:]])
    return pattern_flags(rows, config)
