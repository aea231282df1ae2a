"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, linededup, mixing, nearest, packing, phrases, quality, simhash, spelling, suffixtree, toxicity, warc
from .common import bucket_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.draw(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("payload")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 4) == 2
    found = langid.identify(docs, langid.train(docs, where=~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.score_quality(table(spark, sf_dir, "documents"), trusted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score_documents(table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 10) == 0)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = bucket_of(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, labels.where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {f.__name__: f for f in (op1_source_mixing, op2_warc, op3_language, op4_quality, op5_simhash, op6_suffix_tree, op7_line_dedup, op8_packing, op9_nearest, op10_toxicity, op11_spelling, op12_collocations, op13_decontamination)}
