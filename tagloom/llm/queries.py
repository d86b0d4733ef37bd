"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (
    bpe,
    conversations,
    decontaminate,
    hash_tree,
    main_text,
    negatives,
    quality,
    repeats,
    rules,
    secrets,
    simhash,
    token_files,
    url_lists,
)
from tagloom.llm.common import table
from tagloom.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score by a factorisation machine."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = quality.train(docs, labels)
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), quality.score(machine, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op2_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the prefix trie and decoded again, as digests."""
    vocabulary = bpe.read_vocabulary(VOCABULARY)
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary))


def op3_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest id of its near-duplicates."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot, now and with one more shard."""
    return hash_tree.place(table(spark, sf_dir, "documents"))


def op5_min_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = main_text.with_main_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures, rule failures and the verdict with its host."""
    judged = rules.with_verdicts(rules.measures(table(spark, sf_dir, "documents")))
    measured = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(F.col("id").alias("doc_id"), *measured)


def op7_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page and the lists it was on when it was fetched."""
    pages = table(spark, sf_dir, "pages")
    judged = url_lists.judge(url_lists.captures_of(pages), url_lists.entries_of(pages))
    fetched = F.date_format("fetched", "yyyy-MM-dd").alias("fetched_on")
    return judged.select("page_id", "url", fetched, "blocked", F.array_join("lists", ",").alias("lists"))


def op8_rare_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage like a benchmark item, with score and place."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.best_matches(decontaminate.contaminated(docs, items))
    return found.select(F.col("id").alias("doc_id"), "item_id", "score", "first_word", "end_word")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, size and checksum, from token files written and read back."""
    path = scratch_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, bpe.read_vocabulary(VOCABULARY), path)
    files = token_files.read_token_files(spark, path)
    return files.select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


def op10_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 words that a smaller id holds."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


def op11_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, and the cheapest edits that make it legal."""
    talks = table(spark, sf_dir, "conversations")
    return conversations.audits(talks, conversations.damage(talks))


def op12_multipart_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets, with weak parts that complete each other."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.withColumn("spans", secrets.spans_text(F.col("found"))).drop("found")


def op13_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor's positives."""
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality_fm": op1_quality_fm,
    "op2_bpe_trie": op2_bpe_trie,
    "op3_simhash_anchors": op3_simhash_anchors,
    "op4_hash_tree": op4_hash_tree,
    "op5_min_cut": op5_min_cut,
    "op6_host_rules": op6_host_rules,
    "op7_temporal_lists": op7_temporal_lists,
    "op8_rare_seeds": op8_rare_seeds,
    "op9_token_files": op9_token_files,
    "op10_seed_extend": op10_seed_extend,
    "op11_auction_repair": op11_auction_repair,
    "op12_multipart_secrets": op12_multipart_secrets,
    "op13_bond_negatives": op13_bond_negatives,
}

SQL = {"op6_host_rules": rules.OP6_SQL, "op7_temporal_lists": url_lists.OP7_SQL, "op13_bond_negatives": negatives.OP13_SQL}
