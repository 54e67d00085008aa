"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm import bpe, centroids, conversations, cover_tree, html_blocks, knn_graph, line_dedup, near_dedup, packing, secret_scan, sharding, token_files, toxicity
from repotide.llm.common import materialize, table, tokenizer_path
from repotide.session import fresh_dir


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per candidate, with the forest's score and decision."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    forest = secret_scan.train(secret_scan.labelled_findings())
    found = secret_scan.scan(docs, forest).select(
        "doc_id", "text", F.explode("findings").alias("f")
    )
    return found.select(
        "doc_id",
        F.col("f.start").alias("start"),
        F.col("f.end").alias("end"),
        F.substring("text", F.col("f.start") + 1, F.col("f.end") - F.col("f.start")).alias("value"),
        F.round("f.score", 6).alias("score"),
        (F.col("f.score") >= secret_scan.THRESHOLD).alias("secret"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = html_blocks.extract(pages, html_blocks.fit(pages))
    return texts.select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = materialize(cover_tree.whole_numbers(table(spark, sf_dir, "embeddings")), "vectors")
    return cover_tree.top_k(data.filter("vec_id % 50 = 0"), data, k=5)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.remove_boilerplate(docs).drop("source")


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shuffled(docs).select(
        "doc_id",
        sharding.size_of().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        toxicity.predicted().alias("predicted"),
    )


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return token_files.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversations.report(conversations.repair(conversations.damage(rows)), rows)
    return found.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_main_text": op4_main_text,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_bpe": op6_bpe,
    "op7_line_dedup": op7_line_dedup,
    "op8_near_vectors": op8_near_vectors,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_token_files": op11_token_files,
    "op12_centroids": op12_centroids,
    "op13_conversations": op13_conversations,
}
