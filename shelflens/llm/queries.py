"""The operators as registered queries, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shelflens.llm import bpe, fim, hnsw, langid, licenses, mixing, pii, quality, sharding, simhash, sitetree, spelling, warc
from shelflens.llm.common import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_50k.tiktoken"


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != pii.TERM)
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        of(pii.TERM).alias("n_term"),
        F.sha2(F.coalesce("clean_text", F.lit("")).cast("binary"), 256).alias("clean_sha256"),
    )


def op2_site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = sitetree.main_text(pages, keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.quality(docs, keep=["doc_id"]).select("doc_id", *quality.STATS, "base_failed", "kept", "distance")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.digest(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])
    return found.select("doc_id", "size", "source_size", "target", "taken", "copies", "expected", "source")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    body = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(*[c for c in docs.columns if c != "size"], (F.octet_length(body) + 1).cast("long").alias("size"))
    placed = sharding.shuffle_shards(sized, shards=16)
    return placed.select(
        "doc_id",
        "size",
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    docs = docs.withColumn("held_out", F.crc32(id_text) % 5 == 0)
    return langid.identify(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, payloads=False).select(
        F.col("row_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_id").cast("long").alias("refers_to"),
    )


OP11 = """
WITH records AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
marked AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM records)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM marked"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = spelling.SpellingConfig(misspell_every=199)
    found = spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"), config=config)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


# The checksum is spelled out bit by bit, as the comparison SQL has none; near words meet in what is left without one letter.
OP12 = """
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
distinct_runs AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY 1, 2 HAVING length(run) >= 6),
hashed AS (SELECT run, times, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(trim(regexp_replace(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '(..)', '\\1 ', 'g')), ' '),
      lambda b: CAST('0x' || b AS BIGINT))), lambda c, b: xor(c >> 8, crc.t[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM distinct_runs, crc),
spelt AS (SELECT CASE WHEN h % 199 = 0 THEN run[:(h % length(run))] || run[(h % length(run) + 2):] ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY 1 HAVING sum(times) >= 5),
less AS (SELECT word, n, i, word[:i] || word[(i + 2):] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT less.word, words.word, words.n FROM less JOIN words ON less.rest = words.word
  UNION SELECT words.word, less.word, less.n FROM less JOIN words ON less.rest = words.word),
best AS (SELECT word, count(*) AS n_near, min({'minus': -other_n, 'other': other}) AS best FROM near GROUP BY 1),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.minus >= 5 * n THEN best.other END AS form,
  CASE WHEN -best.minus >= 5 * n THEN -best.minus END AS form_n FROM words LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS at FROM formed UNION ALL SELECT ways.word, formed.form FROM ways JOIN formed ON formed.word = ways.at WHERE formed.form IS NOT NULL),
ends AS (SELECT ways.word, ways.at AS root FROM ways JOIN formed ON formed.word = ways.at WHERE formed.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.transform(table(spark, sf_dir, "documents"), keep=["doc_id"])
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return fim.restore(found).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest("output").alias("output_sha256"),
        digest("restored").alias("restored_sha256"),
    )


OP13 = """
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
  list_transform(range(4), lambda i: CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1 + 8 * i, 8) AS BIGINT)) AS h FROM documents),
cut AS (SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
    WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_site_tree": op2_site_tree,
    "op3_quality": op3_quality,
    "op4_licenses": op4_licenses,
    "op5_bpe": op5_bpe,
    "op6_hnsw": op6_hnsw,
    "op7_simhash": op7_simhash,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_langid": op10_langid,
    "op11_warc": op11_warc,
    "op12_spelling": op12_spelling,
    "op13_fim": op13_fim,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {"op11_warc": OP11, "op12_spelling": OP12, "op13_fim": OP13}
