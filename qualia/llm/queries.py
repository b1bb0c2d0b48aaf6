"""One registered query per operator: the operator with production parameters over its whole table."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.llm import (
    digest_index,
    feistel_shards,
    host_trust,
    jaccard_join,
    lexical_search,
    line_runs,
    ngram_ratio,
    ordinal_quality,
    pair_bpe,
    ss_pack,
    token_store,
    whitening,
    zstd_language,
)
from qualia.session import scratch_path

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to ORC, then located and digested from the files."""
    path = scratch_path(spark, "token-store")
    token_store.write_token_store(_documents(spark, sf_dir), path, public_tokenizers.path(WORD_BPE), end_id=2)
    return token_store.token_digests(spark, path)


URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]


def op2_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the url rules or by its host's trust and distrust."""
    return host_trust.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component: five-word shingles, similarity of 0.75 or more."""
    return jaccard_join.JaccardJoin(_documents(spark, sf_dir)).components().select("doc_id", "n_shingles", "component_id")


def op4_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; the dictionaries are learned from three quarters of the documents.
    A document without an id is neither held out nor learned from."""
    docs = _documents(spark, sf_dir)
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    held_out = F.coalesce(rest == 2, F.lit(False))
    dictionaries = zstd_language.learn_dictionaries(docs.where(rest != 2))
    found = zstd_language.predict(docs, dictionaries)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "saved_bytes", "accepted")


def op5_pair_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the byte-level vocabulary."""
    return pair_bpe.encode_decode(_documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), full=False)


def op6_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged against the trusted target: rated good and not toxic."""
    trusted = _table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return ngram_ratio.judge(_documents(spark, sf_dir), trusted)


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 2048 ids; one row per piece."""
    return ss_pack.pack(_documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), size=2048, end_id=1, with_ids=False)


def op8_line_runs(spark: SparkSession, sf_dir: str, batches: int = 2) -> DataFrame:
    """Every document's lines counted in batches over the runs, then rewritten without common lines."""
    docs = _documents(spark, sf_dir)
    runs = line_runs.LineRuns(spark, min_docs=10, fanout=2)
    for batch in range(batches):
        runs.add(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == batch))
    return runs.drop_common(docs, with_text=False)


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings from labels: 0 low quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade and probability of the top grade."""
    docs = _documents(spark, sf_dir)
    return ordinal_quality.score(docs, ordinal_quality.fit(docs, grades(_table(spark, sf_dir, "labels"))))


def op10_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document decided against a new digest index, which then holds all its digests."""
    return digest_index.DigestIndex(spark).decide(_documents(spark, sf_dir)).drop("at")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item's 50 best documents."""
    return lexical_search.search(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"), top=50)


def op12_polarisation_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the four leading whitened components."""
    vectors = _table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors, components=4))


def op13_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 40 shards of equal row counts."""
    placed = feistel_shards.assign(_documents(spark, sf_dir), shards=40, seed=20)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row")


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_host_trust": op2_host_trust,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_zstd_language": op4_zstd_language,
    "op5_pair_bpe": op5_pair_bpe,
    "op6_ngram_ratio": op6_ngram_ratio,
    "op7_sum_of_squares_packing": op7_sum_of_squares_packing,
    "op8_line_runs": op8_line_runs,
    "op9_ordinal_quality": op9_ordinal_quality,
    "op10_digest_index": op10_digest_index,
    "op11_lexical_search": op11_lexical_search,
    "op12_polarisation_whitening": op12_polarisation_whitening,
    "op13_feistel_shards": op13_feistel_shards,
}
