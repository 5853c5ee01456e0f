"""The registered queries of the operators: one per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairgauge.llm import cascade, contentsort, dac, flatgraph, importance, lengthcrc, merkle, mixing, packing, parity, postings, toxicity, wrapper
from fairgauge.llm.common import read_table, scratch_path

URL_RULES = (
    cascade.Rule("net", "/", "block"),
    cascade.Rule("example.net", "/en/", "allow"),
    cascade.Rule("example.com", "/de/", "block"),
    cascade.Rule("org", "/fr/", "allow"),
)


def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dac-tokens")
    dac.write_tokens(read_table(spark, sf_dir, "documents"), path)
    return dac.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract_main_text(read_table(spark, sf_dir, "pages"))


def op5_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op6_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op8_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return parity.group_similar(docs, words=4, threshold=Fraction(85, 100)).drop("text_hash")


def op9_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contentsort.group_copies(read_table(spark, sf_dir, "documents"), keep="largest")


def op10_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = merkle.leaf(changed={"n_chars": F.col("n_chars") + 1})
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    presented = F.when(touched, tampered).otherwise(merkle.leaf())
    manifest = merkle.write_manifest(
        read_table(spark, sf_dir, "documents"), scratch_path(spark, "manifest"), carried={"presented": presented}
    )
    return merkle.prove(manifest, "presented")


def op12_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = postings.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    items = F.concat_ws(",", "items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), "contaminated"
    )


def op13_length_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengthcrc.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance": op1_importance,
    "op2_dac_tokens": op2_dac_tokens,
    "op3_sum_of_squares": op3_sum_of_squares,
    "op4_wrapper_induction": op4_wrapper_induction,
    "op5_flat_graph": op5_flat_graph,
    "op6_curriculum": op6_curriculum,
    "op7_url_cascade": op7_url_cascade,
    "op8_parity_join": op8_parity_join,
    "op9_content_sort": op9_content_sort,
    "op10_boosted_trees": op10_boosted_trees,
    "op11_merkle": op11_merkle,
    "op12_postings": op12_postings,
    "op13_length_crc": op13_length_crc,
}
