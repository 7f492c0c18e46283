"""Baskets, pairs and scores against brute force."""

import random
from collections import Counter
from dataclasses import replace
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from shelflens.config import AffinityConfig
from shelflens.operators import affinity as aff
from tests.conftest import rows

CONFIG = AffinityConfig()


def brute_force(baskets, total, config):
    """Scores from lists of products, the plain way."""
    pairs, singles = Counter(), Counter()
    for basket in baskets:
        items = sorted(set(basket)) if config.distinct else sorted(basket)
        pairs.update(combinations(items, 2))
        singles.update(set(basket))
    result = {}
    for (a, b), n in pairs.items():
        support, confidence = n / total, n / singles[a]
        lift = confidence / (singles[b] / total)
        if support >= config.min_support and confidence >= config.min_confidence and lift >= config.min_lift:
            result[a, b] = (n, singles[a], singles[b], support, confidence, n / singles[b], lift)
    return result


def frames(spark, baskets, total):
    data = [(t, p) for t, basket in enumerate(baskets) for p in basket]
    items = aff.basket_items(spark.createDataFrame(data, "transaction_id long, product_id string"))
    header = spark.range(total).withColumnRenamed("id", "transaction_id")
    names = sorted({p for _, p in data if p != "p3"})
    products = spark.createDataFrame([(p, f"Name {p}") for p in names], "product_id string, product_name string")
    return items, header, products


def random_baskets(seed, hot=0):
    draw = random.Random(seed)
    baskets = [[f"p{min(int(draw.expovariate(0.3)), 20)}" for _ in range(draw.randint(1, 6))] for _ in range(120)]
    if hot:
        baskets.append([f"p{draw.randint(0, 20)}" for _ in range(hot)])
    return baskets


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("hot", [0, 200])
def test_scores_match_brute_force(spark, distinct, hot):
    baskets = random_baskets(7 + hot, hot)  # with hot, one basket holds a third of all lines
    config = AffinityConfig(min_support=0.05, min_confidence=0.2, min_lift=0.8, distinct=distinct)
    total = len(baskets) + 10
    expected = brute_force(baskets, total, config)
    assert expected
    scores = aff.affinity(*frames(spark, baskets, total), config)
    columns = ["pair_count", "count_a", "count_b", "support", "confidence_a_to_b", "confidence_b_to_a", "lift"]
    found = {(r["product_a"], r["product_b"]): tuple(r[c] for c in columns) for r in scores.collect()}
    assert found.keys() == expected.keys()
    for pair, values in expected.items():
        assert found[pair] == pytest.approx(values)
    unnamed = {r["product_a_name"] for r in scores.filter("product_a = 'p3'").collect()}
    assert unnamed <= {None}


def test_repeated_product_pairs_with_itself(spark):
    items, _, _ = frames(spark, [["A", "A", "B"], ["B"], ["A", "B"]], 3)
    assert rows(aff.product_pairs(items)) == [(0, "A", "A", 1), (0, "A", "B", 2), (2, "A", "B", 1)]
    assert rows(aff.expand_pairs(aff.product_pairs(items), step=1)) == [
        (0, "A", "A"), (0, "A", "B"), (0, "A", "B"), (2, "A", "B"),
    ]
    assert rows(aff.product_pairs(items, distinct=True)) == [(0, "A", "B", 1), (2, "A", "B", 1)]
    assert rows(aff.product_lists(aff.baskets(items))) == [(0, ["A", "A", "B"], 3), (2, ["A", "B"], 2)]


def test_confidence_may_pass_one(spark):
    baskets = [["A", "B", "B", "B"], ["A"], ["C"]]
    scores = aff.affinity(*frames(spark, baskets, 3), AffinityConfig(min_lift=0.0))
    row = scores.filter("product_a = 'A'").first()
    assert row["pair_count"] == 3 and row["confidence_a_to_b"] == 1.5


def test_pair_rows_add_up(spark):
    baskets = random_baskets(3, hot=100)
    items, header, products = frames(spark, baskets, len(baskets))
    metrics = aff.affinity_metrics(items, header, products).first()
    assert metrics["total_product_pairs"] == sum(len(b) * (len(b) - 1) // 2 for b in baskets)
    pairs = aff.product_pairs(items)
    assert pairs.agg({"pair_rows": "sum"}).first()[0] == metrics["total_product_pairs"]
    assert pairs.filter("product_a > product_b").count() == 0
    data = [(t, p) for t, basket in enumerate(baskets) for p in basket]
    lines = spark.createDataFrame(data, "transaction_id long, product_id string")
    stats = aff.basket_stats(lines, header, products).first()
    assert stats["baskets"] == len(baskets) and stats["total_line_items"] == sum(map(len, baskets))


def test_top_has_ranks_and_ties(spark):
    scores = spark.createDataFrame(
        [("A", "C", 2.0), ("A", "B", 2.0), ("B", "C", 3.0), ("C", "D", 1.0)], "product_a string, product_b string, lift double"
    ).selectExpr("*", "lift / 7 AS support", "lift / 9 AS confidence_a_to_b", "2L AS pair_count", "product_a AS product_a_name",
                 "nullif(product_b, 'C') AS product_b_name")
    top = aff.top_affinities(scores, 3)
    assert rows(top, "rank", "product_a", "product_b", "support", "recommendation") == [
        (1, "B", "C", 0.4286, "Customers who buy B also buy nan"),
        (2, "A", "B", 0.2857, "Customers who buy A also buy B"),
        (3, "A", "C", 0.2857, "Customers who buy A also buy nan"),
    ]


def test_null_keys_are_left_out(spark):
    lines = spark.createDataFrame([(1, "A"), (1, None), (None, "A"), (1, "B")], "transaction_id long, product_id string")
    assert rows(aff.basket_items(lines)) == [(1, "A", 1), (1, "B", 1)]


@pytest.fixture(scope="module")
def many(spark):
    """Two products that go together in a fifth of the baskets, among 3000 that go with others by chance."""
    rare = F.concat(F.lit("r"), F.pmod(F.xxhash64("transaction_id", "k"), F.lit(3000)))
    lines = spark.range(0, 2000, 1, 4).select(F.col("id").alias("transaction_id"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"))
    both = F.when((F.col("k") < 2) & (F.col("transaction_id") % 5 == 0), F.concat(F.lit("p"), F.col("k")))
    items = aff.basket_items(lines.select("transaction_id", F.coalesce(both, rare).alias("product_id"))).checkpoint()
    header = spark.range(2000).select(F.col("id").alias("transaction_id"))
    names = items.select("product_id", F.col("product_id").alias("product_name")).distinct()
    return items, header, names


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("support", [0.0015, 0.01])
def test_buckets_lose_no_pair(spark, many, monkeypatch, distinct, support):
    items, header, names = many
    config = replace(CONFIG, min_support=support, min_confidence=0.0, min_lift=0.0, distinct=distinct)
    plain = rows(aff.affinity(items, header, names, config))
    for buckets in (7, 1000):
        monkeypatch.setattr(aff, "BUCKETS", buckets)
        assert rows(aff.affinity(items, header, names, config)) == plain
    assert any(r[:2] == ("p0", "p1") for r in plain)


def test_fewer_pairs_are_counted(many, monkeypatch):
    """Of the pairs of the frequent products, few are left to be shuffled and counted."""
    items, header, _ = many
    config = replace(CONFIG, min_support=0.0025)
    frequent = aff.frequent_products(items, header, config).checkpoint()
    every = aff.pair_counts(aff.frequent_pairs(items, frequent)).count()
    monkeypatch.setattr(aff, "BUCKETS", 1 << 17)
    left = aff.pair_counts(aff.candidate_pairs(items, header, frequent, config)).count()
    wanted = aff.pair_counts(aff.frequent_pairs(items, frequent)).filter("pair_count >= 5").count()
    assert every > 50_000 and wanted <= left < every / 10


def test_a_basket_of_ten_thousand_products(spark, monkeypatch):
    """Fifty million pairs of one basket become as many bucket counts as there are buckets."""
    monkeypatch.setattr(aff, "BUCKETS", 1 << 12)
    big = spark.range(10_000).select(F.lit(1).cast("long").alias("transaction_id"), F.concat(F.lit("p"), F.col("id")).alias("product_id"))
    pair = spark.range(20_000).select((F.col("id") % 4000 + 2).alias("transaction_id"), F.when(F.col("id") < 4000, "p1").when(F.col("id") < 8000, "p2").alias("product_id"))
    items = aff.basket_items(big.union(pair)).checkpoint()
    header = spark.range(4001).select(F.col("id").alias("transaction_id"))
    config = replace(CONFIG, min_support=1.5 / 4001, min_confidence=0.0, min_lift=0.0)
    frequent = items.select("product_id").distinct().withColumn("product_count", F.lit(1).cast("long")).checkpoint()
    pairs = aff.candidate_pairs(items, header, frequent, replace(config, min_support=13_500 / 4001))
    found = aff.pair_counts(pairs).orderBy(F.col("pair_count").desc()).first()
    assert (found.product_a, found.product_b, found.pair_count) == ("p1", "p2", 4001)
