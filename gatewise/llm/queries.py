"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewise.llm import alignment, bpe, centroids, divergence, exact_dedup, html_text, language, mixing, quality, sharding, simhash, sketches, substrings
from gatewise.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def word_vocabulary() -> str:
    """Place of the public tokenizer file that op3 and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op1_hash_tree_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards (and 25) of the hash tree; law ``key``."""
    n = sharding.PLANNED_SHARDS
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.layout(n), sharding.layout(n + 1))


@register("op2_simhash_deletion_variants")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, 4 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@register("op3_bpe_trie")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    coded = bpe.encode(table(spark, sf_dir, "documents"), word_vocabulary())
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@register("op4_chunk_recipes", """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays of its text."""
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


@register("op10_fourier_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from ``labels.quality``."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_language_mixture")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from ``documents.lang``."""
    return language.identify(table(spark, sf_dir, "documents"))


@register("op9_invertible_sketches")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, with their likeness."""
    return sketches.compare(table(spark, sf_dir, "documents")).drop("lost", "gained")


@register("op5_text_to_tag_ratio")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@register("op6_soft_membership_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document; domains good, poor and toxic from ``labels``."""
    labelled = table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of_labels().alias("domain"))
    return mixing.mix(table(spark, sf_dir, "documents"), labelled, mixing.TARGETS)


@register("op8_gear_chunks")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of about 50 words and more that repeat across documents."""
    return substrings.passages(table(spark, sf_dir, "documents"))


@register("op11_heap_bounds_centroids")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and squared distance of every 64-component embedding: 8 centroids, 10 rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@register("op12_asof_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned groups and linked id pairs of two public tokenizers over every document."""
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(alignment.LEFT),
                           public_tokenizers.path(alignment.RIGHT))


@register("op13_language_divergence")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether it stays near a language of the corpus."""
    return divergence.judge(table(spark, sf_dir, "documents"))
