"""The registered queries of the corpus operators, each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroids,
    decontaminate,
    fingerprints,
    language_id,
    licenses,
    merkle,
    mixing,
    near_dedup,
    packing,
    pii,
    quality,
    url_filter,
    warc,
)
from .common import table


#: For the registered queries only; a user's key comes from where secrets are kept.
EXAMPLE_KEY = b"a key for examples"


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, EXAMPLE_KEY)


def op2_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "matched", "n_tiles", "tiles")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    read = warc.read_archives(spark, folder, manifest, keep=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def _in_fold(modulus: int, rest: int) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~_in_fold(5, 0))
    ensemble = quality.learn_rules(quality.draw_examples(docs, labels))
    scored = quality.score_quality(docs, ensemble)
    return scored.select("doc_id", _in_fold(5, 0).alias("held_out"), "score", "predicted")


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "tokens", F.round("weight", 9).alias("weight"), "repeats", "pass", "mix_block", "mix_order")


def op7_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = language_id.learn_dictionaries(docs.filter(~_in_fold(4, 2)))
    judged = language_id.identify(docs, dictionaries)
    return judged.select("doc_id", _in_fold(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


#: Host, path and verdict of the rules that the query applies.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op8_range_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprints.compare_edited(docs, fingerprints.learn_lexicon(docs))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proofs are checked on rows of which half have lost their line breaks."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    offered = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), tampered]
    proved = merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", offered)
    proved = proved.withColumns({"proof_sha256": F.sha2(merkle.siblings(F.col("path")), 256), "folded_root": merkle.fold(F.col("offered_leaf"), F.col("path"))})
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op13_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), k=16, rounds=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_feistel_pseudonyms": op1_feistel_pseudonyms,
    "op2_diagonal_voting": op2_diagonal_voting,
    "op3_string_tiling": op3_string_tiling,
    "op4_warc": op4_warc,
    "op5_rule_ensemble": op5_rule_ensemble,
    "op6_temperature_mixing": op6_temperature_mixing,
    "op7_compression": op7_compression,
    "op8_range_sweep": op8_range_sweep,
    "op9_superminhash": op9_superminhash,
    "op10_imatch": op10_imatch,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_best_fit": op12_best_fit,
    "op13_sharded_lloyd": op13_sharded_lloyd,
}
