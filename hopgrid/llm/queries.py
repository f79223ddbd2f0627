"""The registered queries of this folder and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hopgrid.llm.bpe import encode_decode
from hopgrid.llm.conversation_trie import prefix_trie
from hopgrid.llm.common import read_table
from hopgrid.llm import byte_bpe, embedding_dedup, merkle, toxicity
from hopgrid.llm.exact_dedup import exact_duplicates
from hopgrid.llm.html_extract import main_texts
from hopgrid.llm.language import identify
from hopgrid.llm.oracles import OP11_SQL, OP12_SQL
from hopgrid.llm.packing import pack
from hopgrid.llm.sharding import shards
from hopgrid.llm.simhash import near_duplicates
from hopgrid.llm.suffix_dedup import remove_repeats


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept_text")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(read_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False).drop("ids")


def op5_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"), TOKENIZER, digests=True)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read_table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    tampered = merkle.leaf_digest(text=F.translate(F.col("text"), "\n", ""))
    presented = F.unhex(F.when(even, tampered).otherwise(merkle.leaf_digest()))
    proved = merkle.proofs(merkle.build_manifest(docs, presented=presented))
    checked = merkle.verify(proved.withColumn("presented", F.lower(F.hex("presented"))), "presented")
    return checked.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                          "folded_root", "verified")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(read_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, digests=True)


NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS kept
FROM embeddings
"""

OP8_SQL = f"""
WITH normal AS (SELECT doc_id, sha256({NORMAL}) AS text_sha256, {NORMAL} AS norm FROM documents),
groups AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY norm)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, false) AS kept, text_sha256
FROM normal JOIN groups USING (norm)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_sharding": op3_sharding,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_bpe_chunks": op5_bpe_chunks,
    "op6_language_id": op6_language_id,
    "op7_simhash": op7_simhash,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_html_extraction": op10_html_extraction,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_byte_bpe": op13_byte_bpe,
}
ORACLES: dict[str, str] = {
    "op2_embedding_dedup": OP2_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
