"""Similarity scores and best matches against a plain implementation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflens.functions import similarity, tries
from shelflens.operators import matching, nearest
from shelflens.sources.shared import write_once
from tests.conftest import rows


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def plain_score(a, b):
    return 0 if not a or not b else round(200 * lcs(a, b) / (len(a) + len(b)))


def plain_best(text, known):
    return max(known, key=lambda k: (plain_score(text, k), [-ord(c) for c in k]))


def frame(spark, values, name="product_id"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def words(draw, count, low, high, letters="abc01"):
    return ["".join(draw.choice(letters) for _ in range(draw.randint(low, high))) for _ in range(count)]


def test_scores(spark):
    draw = random.Random(1)
    pairs = list(zip(words(draw, 60, 0, 12), words(draw, 60, 0, 12)))
    pairs += list(zip(words(draw, 4, 60, 70), words(draw, 4, 1, 90)))
    pairs += [("prod_001", "prd001"), ("", ""), ("same", "same"), ("äöü", "äu")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", similarity.score(F.col("a"), F.col("b")).alias("s")).collect():
        assert row["s"] == plain_score(row["a"], row["b"]), row
        assert tries.Tries([row["b"]]).best([row["a"]], np.array([-1]), 85)[0].tolist() == [row["s"]]
    assert plain_score("prod_001", "prd001") == 86


def test_normalization(spark):
    df = frame(spark, [" PRD-001! ", "Prod_001", "Größe"], "v")
    assert rows(df.select(similarity.normalize(F.col("v")))) == [("größe",), ("prd 001",), ("prod_001",)]
    tokens = frame(spark, ["Oil,  Olive 1L"], "v").select(similarity.token_sort(F.col("v")))
    assert tokens.first()[0] == "1l oil olive"


@pytest.mark.parametrize("threshold", [60, 85])
def test_best_matches(spark, threshold):
    draw = random.Random(threshold)
    known = sorted(set(words(draw, 80, 3, 9)))
    unknown = sorted(set(words(draw, 60, 2, 11)) | {k[:-1] + "z" for k in known[:20]})
    found = {
        r["id"]: (r["match"], r["score"])
        for r in matching.best_matches(frame(spark, unknown), frame(spark, known), threshold).collect()
    }
    assert set(found) == set(unknown)
    accepted = 0
    for text in unknown:
        best = plain_best(text, known)
        score = plain_score(text, best)
        accepted += score >= threshold
        assert found[text] == (best if score >= threshold else None, score), text
    assert accepted
    only = matching.best_matches(frame(spark, unknown), frame(spark, known), threshold, low_scores=False)
    assert {r["id"]: (r["match"], r["score"]) for r in only.collect()} == {
        k: v for k, v in found.items() if v[1] >= threshold
    }


@pytest.mark.parametrize("low_scores", [True, False])
def test_long_texts(spark, low_scores):
    """Texts beyond the 64 bits of a word, and beyond the positions that a summary keeps."""
    draw = random.Random(4)
    known = words(draw, 12, 26, 40) + words(draw, 6, 65, 90) + words(draw, 10, 18, 24) + words(draw, 3, 270, 300)
    unknown = [k[:3] + k[5:] for k in known]
    found = matching.best_matches(frame(spark, unknown), frame(spark, known), 85, low_scores=low_scores)
    result = {r["id"]: (r["match"], r["score"]) for r in found.collect()}
    for text in unknown:
        best = plain_best(text, known)
        assert result[text] == (best, plain_score(text, best))


@pytest.mark.parametrize("frontier, cells", [(4, 1), (1 << 16, 1 << 21)])
def test_tries_like_all_pairs(monkeypatch, frontier, cells):
    monkeypatch.setattr(tries, "FRONTIER", frontier)
    monkeypatch.setattr(tries, "CELLS", cells)
    draw = random.Random(frontier)
    for _ in range(30):
        letters, longest = "abc01é漢"[: draw.randint(2, 7)], draw.choice([8, 8, 150])
        known = sorted(set(words(draw, draw.randint(1, 40), 0, longest, letters)))
        texts = words(draw, 12, 0, longest + 2, letters + "xy") + known[:3]
        threshold = draw.choice([30, 60, 85])
        least = np.array([draw.choice([-1, -1, 20, 60, threshold - 1, threshold]) for _ in texts])
        best, pairs, _ = tries.Tries(known).best(texts, least, threshold)
        found = {(int(q), int(m)) for queries, members in pairs for q, m in zip(queries, members)}
        halves = [known[::2], known[1::2] or known]
        bounds = tries.Summaries(*zip(*map(tries.summary, halves)))
        for q, text in enumerate(texts):
            all_scores = [plain_score(text, k) for k in known]
            want = max(*all_scores, int(least[q]))
            assert best[q] == want
            assert {m for at, m in found if at == q} == {m for m, s in enumerate(all_scores) if s == want >= threshold}
            assert all(b >= max(plain_score(text, k) for k in half) for b, half in zip(bounds.bounds(text), halves))


@pytest.mark.parametrize("chars, texts", [(1, 1), (40, 5), (1 << 19, 1 << 13)])
def test_shards_do_not_change_the_result(spark, monkeypatch, chars, texts):
    """Random ids and names, best scores on both sides of the threshold, ties between shards."""
    draw = random.Random(9)
    known = sorted(set(words(draw, 50, 4, 6)) | {f"prd{i:05d}" for i in range(40)} | {" ".join(words(draw, 4, 2, 5)) for _ in range(20)})
    unknown = sorted(set(words(draw, 30, 4, 8, "abcxyz")) | {f"item {i}" for i in range(0, 40, 7)} | {k + " x" for k in known[:9]} | {k[1:] for k in known[:30]})
    monkeypatch.setattr(nearest, "SHARD_CHARS", chars)
    monkeypatch.setattr(nearest, "TEXTS", texts)
    found = {r.id: (r.match, r.score) for r in matching.best_matches(frame(spark, unknown), frame(spark, known), 70).collect()}
    for text in unknown:
        best = plain_best(text, known)
        assert found[text] == (best if plain_score(text, best) >= 70 else None, plain_score(text, best)), text
    assert any(m for m, _ in found.values()) and any(m is None for m, _ in found.values())


def test_few_nodes_are_visited(spark):
    """Ten times the known ids cost far less than ten times the nodes."""
    visited = {}
    for count in (2_000, 20_000):
        known = write_once(spark.range(count).select(F.format_string("prd%08d", "id").alias("text")).withColumns({"rank": F.col("text"), "choice": F.col("text")}), "known")
        asked = write_once(spark.range(0, 2_000, 20).select(F.concat(F.lit("item "), F.col("id")).alias("text")), "asked")
        found = nearest.nearest(asked, known, 85).agg(F.sum("nodes"), F.countDistinct("text")).first()
        assert found[1] == 100
        visited[count] = found[0] / 100
    assert visited[2_000] < 200 and visited[20_000] < 2 * visited[2_000]


def test_ties_follow_the_given_order(spark):
    known = spark.createDataFrame([("AB1", 2), ("AB2", 1), ("AB3", 3)], "product_id string, place long")
    ids = frame(spark, ["AB9", "AB9", None])
    assert rows(matching.best_matches(ids, known, 60)) == [("AB9", "AB1", 67)]
    assert rows(matching.best_matches(ids, known, 60, order="place")) == [("AB9", "AB2", 67)]


def test_nothing_to_match(spark):
    assert matching.best_matches(frame(spark, []), frame(spark, ["A"])).count() == 0
    assert rows(matching.best_matches(frame(spark, ["A"]), frame(spark, []))) == []
    assert rows(matching.best_matches(frame(spark, ["!!"]), frame(spark, ["A", "B"]))) == [("!!", None, 0)]


def test_suggestions_are_added_not_applied(spark):
    rejected = spark.createDataFrame(
        [
            ("a", "PROD_001", ["MISMATCHED_PRODUCT_ID"]),
            ("b", "PROD_001", ["NEGATIVE_STOCK", "MISMATCHED_PRODUCT_ID"]),
            ("c", "ZZZ", ["MISMATCHED_PRODUCT_ID"]),
            ("d", "PRD002", ["NEGATIVE_STOCK"]),
            ("e", None, ["MISSING_PRODUCT_ID"]),
        ],
        "id string, product_id string, validation_errors array<string>",
    ).withColumn("validation_status", F.lit("INVALID"))
    result = matching.suggest_ids(rejected, frame(spark, ["PRD001", "PRD002"]))
    assert rows(result, "id", "product_id", "suggested_product_id", "fuzzy_match_score") == [
        ("a", "PROD_001", "PRD001", 86),
        ("b", "PROD_001", "PRD001", 86),
        ("c", "ZZZ", None, 0),
        ("d", "PRD002", None, None),
        ("e", None, None, None),
    ]
    assert rows(matching.apply_suggestions(result), "id", "product_id") == [("a", "PRD001"), ("b", "PRD001")]


def test_names_by_tokens(spark):
    names = frame(spark, ["Olive Oil 1L", "Brown Bread"], "name")
    found = matching.best_matches(frame(spark, ["1L oil, olive"], "name"), names, 80, column="name", normalizer=similarity.token_sort)
    assert rows(found) == [("1L oil, olive", "Olive Oil 1L", 100)]


def test_sku_shape(spark):
    df = frame(spark, ["SKU-ABC-123", "SKU-ABC-1234", "xSKU-ABC-123", "sku-abc-123", None], "sku")
    assert rows(matching.check_sku(df).filter("sku_valid"), "sku") == [("SKU-ABC-123",)]
    # A pattern without an anchor must fit from the start.
    assert rows(matching.check_sku(df, pattern="SKU-[A-Z]+").filter("sku_valid"), "sku") == [("SKU-ABC-123",), ("SKU-ABC-1234",)]
