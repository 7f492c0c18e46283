"""The pipeline over awkward rows, and stage by stage over the smallest tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelflens.llm import simhash
from shelflens.llm.common import write_once
from shelflens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = write_once(stage(spark, before, SF), name)
        assert after.columns == columns and after.schema.simpleString() == docs.schema.simpleString()
        assert after.join(before, "doc_id", "left_anti").count() == 0
        if name == "near_duplicates":
            assert after.count() == after.select("doc_id").distinct().count()
        if name == "personal_data":
            assert after.count() == before.count() and after.filter("n_chars <> length(text)").count() == 0
            assert after.filter(F.col("text").rlike(r"@mail[0-9]\.example")).count() == 0
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert last.count() == before.count() and last.filter("not round_trip").count() == 0


def test_awkward_rows(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, "")
            assert after.columns == docs.columns, name
            assert after.count() <= 3 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()



def test_token_ids_one_python_step(spark, odd):
    """Ids are decoded in the worker that encodes them: one Python step a task, and every text comes back."""
    for table in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        found = corpus_pipeline.token_ids(spark, table, "")
        assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert found.count() == table.count() and found.filter("not round_trip").count() == 0

def test_near_duplicates_like_all_pairs(spark):
    """Copies with changed words, a large group of copies of one text, a common line, and short and blank texts."""
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    line, base, texts = words(8), words(400), [None, "", " ", "a b", "A  b", "a b c"]
    for i in range(60):
        one = words(rng.randrange(20, 300)) + line
        texts.append(" ".join(one))
        for _ in range(2):
            one[rng.randrange(len(one))] = "new"
            texts.append(" ".join(one))
    for _ in range(60):
        copy = base[:]
        copy[rng.randrange(400)] = words(1)[0]
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    marks, label = [simhash.fingerprint((t or "").encode()) for t in texts], list(range(len(texts)))
    for i, a in enumerate(marks):
        for j, b in enumerate(marks[:i]):
            if (a ^ b).bit_count() <= 4:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(label)) and 60 < len(kept) < 160


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.count() > 0 and len(set(found.columns)) == len(found.columns)
    assert set(ORACLES) <= set(QUERIES)
