"""The corpus operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    bpe,
    html,
    lines,
    minhash,
    packing,
    phrases,
    quality,
    rules,
    simhash,
    suffixes,
    tokenfile,
    toxicity,
    trie,
)
from eventlake.llm.common import ship_package
from eventlake.llm.labelled import held_out
from eventlake.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), folds=3, fold=1)
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        model.column(F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    deduped = lines.without_repeated_lines(docs, short_repeats=True)
    digest = F.sha2("text", 256).alias("kept_sha256")
    return deduped.select("doc_id", "n_lines", "n_removed", "n_links", digest)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edit_checks(_table(spark, sf_dir, "documents"))


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(_table(spark, sf_dir, "documents"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(_table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), folds=5, fold=0)
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        model.column(F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "token-files")
    tokenfile.write(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    read = tokenfile.documents(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_nodes(trie.rebuilt(_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_lines": op3_lines,
    "op4_packing": op4_packing,
    "op5_minhash": op5_minhash,
    "op6_rules": op6_rules,
    "op7_suffixes": op7_suffixes,
    "op8_html": op8_html,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_phrases": op11_phrases,
    "op12_tokenfile": op12_tokenfile,
    "op13_trie": op13_trie,
}

#: Bytes are compared as their two hexadecimal digits.
SUFFIXES_SQL = """
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
           octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
), strings AS (
    SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s
    FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM docs WHERE n >= 100)
), repeated AS (
    SELECT doc_id, p FROM strings
    QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1
), runs AS (
    SELECT doc_id, p, p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 AS apart
    FROM repeated
), numbered AS (
    SELECT doc_id, p, count(*) FILTER (apart) OVER (PARTITION BY doc_id ORDER BY p) AS run
    FROM runs
), spans AS (
    SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, run
), pieces AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b
    FROM spans
    UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id
    UNION ALL SELECT doc_id, 0, NULL FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM spans)
), kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS k
    FROM pieces JOIN docs USING (doc_id) GROUP BY doc_id
), sums AS (
    SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       coalesce(spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op6_rules": rules.ORACLE_SQL,
    "op7_suffixes": SUFFIXES_SQL,
    "op11_phrases": phrases.ORACLE_SQL,
    "op13_trie": trie.ORACLE_SQL,
}
