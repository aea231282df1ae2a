"""From raw documents to packed training sequences: quality rules, line dedup, near-dedup, mixing, packing.

Each stage works on all that its predecessor kept; all but the last return the columns of documents. The registered query runs them in
order, each stage's result written as a table in the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.llm import linededup, mixing, neardup, packing, quality
from colophon.llm.common import cut, fresh, scope, scratch, words
from colophon.llm.queries import table, tokenizer_path


def _like(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of docs, with n_chars (if there is one) of the text as it is now."""
    if "n_chars" in out.columns and "text" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(f"`{c}`" for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    whole = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    return quality.score_quality(whole, trusted, carry=("_row",)).where("kept").select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; a document that had nothing else goes."""
    out = linededup.dedup_lines(docs)
    return _like(docs, out.where((F.col("n_dropped") == 0) | (F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != "")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (5-word shingles, similarity 0.8 or more), that with the smallest id."""
    return neardup.representatives(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with a word once or more: smaller sources are repeated up to twice as often as the largest. A null id is an id.

    Each task's rows are in the order of the mixture's blocks and of the places in them, so a file that is written from them, and a
    reader of it, goes through its share of every block in turn. Rows with the same id and source are repeated alike.
    """
    key, source, at, turns = fresh(docs, "_id", "_source", "_at", "_turns")
    drawn = mixing.draw(docs).groupBy("doc_id", "source", "epoch").agg(F.min(F.struct("block", "place")).alias("at"))
    # as many as the epochs of a source
    drawn = drawn.groupBy(F.col("doc_id").alias(key), F.col("source").alias(source)).agg(F.collect_list("at").alias(turns))
    own = docs.where(F.size(words(F.col("text"))) > 0)
    out = own.join(drawn, F.col("doc_id").eqNullSafe(F.col(key)) & F.col("source").eqNullSafe(F.col(source))).withColumn(at, F.explode(turns))
    return out.sortWithinPartitions(f"{at}.block", f"{at}.place").select(*(f"`{c}`" for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; documents are packed with those that come next to them in their file."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near-dedup", near_dedup), ("source mixing", source_mixing), ("packing", pack)]

#: The quality ratio's hashes, the shingles and the tokenizer have no SQL form; a test holds run() against a brute-force version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; what a stage leaves beside its result is deleted when the result is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch(spark)
        with scope(spark):
            docs = cut(stage(spark, docs, sf_dir), path)
    return STAGES[-1][1](spark, docs, sf_dir)
