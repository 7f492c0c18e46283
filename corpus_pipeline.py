"""From raw documents to token ids: quality rules, near duplicates, personal data, source mix, encoding.

Every stage takes the documents its predecessor kept, all of them, and returns
documents with the same columns; the last returns the encoded documents. Stages
handle nulls, empty tables and further columns as their operators do (see there).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.llm import bpe, mixing, pii, quality, simhash
from shelflens.llm.common import MARK, write_once

VOCABULARY = "byte_bpe_50k.tiktoken"


def _plain(docs: DataFrame) -> DataFrame:
    """Columns under reserved names, so that what a stage adds can't clash with them."""
    return docs.select(*[F.col(c).alias(f"{MARK}c_{c}") for c in docs.columns])


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(f"{MARK}c_{c}").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier rule keep."""
    named = {f"{c}": f"{MARK}c_{c}" for c in ("text", "lang", "source")}
    return _back(quality.quality(_plain(docs), **named).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of 4-word shingles link at 4 or fewer differing bits: the one with the smallest doc_id."""
    return simhash.keep_one(docs, radius=simhash.RADIUS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sanitised; n_chars follows the text."""
    found = pii.sanitise(_plain(docs), text=f"{MARK}c_text")
    found = found.withColumn(f"{MARK}c_text", F.col("clean_text"))
    if "n_chars" in docs.columns:
        found = found.withColumn(f"{MARK}c_n_chars", F.length("clean_text").cast(docs.schema["n_chars"].dataType))
    return _back(found, docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most three times."""
    named = {"id": f"{MARK}c_doc_id", "text": f"{MARK}c_text", "source": f"{MARK}c_source"}
    found = mixing.mix(_plain(docs), **named).filter("copies > 0")
    return _back(found.withColumn(f"{MARK}copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its ids, and whether decoding them gives back its text."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    # A text goes through one step only; whether decoding gives it back is told by its digest.
    text = F.coalesce("text", F.lit(""))
    plain = docs.select("doc_id", text.alias("text"), F.sha2(text.cast("binary"), 256).alias("sha"))
    found = bpe.encode(plain, ranks, public_tokenizers.PATTERN, keep=["doc_id", "sha"], decoded="decoded")
    whole = F.sha2("decoded", 256) == F.col("sha")
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), whole.alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

# The outlier estimate, fingerprints, seeded draws and merges have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
