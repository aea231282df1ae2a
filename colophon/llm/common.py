"""Shared helpers: scratch storage, cutting lineage, Arrow batches and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.store import cut, scope, scratch  # noqa: F401, used through this module

#: The characters between words: space, and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """df to be broadcast if it has at most so many rows; else as it is, and joined by a shuffle. df is counted: cut it before."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df doesn't have, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def bucket_of(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the folds of the held-out contracts."""
    return F.crc32(col.cast("string").cast("binary")) % n


def trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))


def words(text: Column) -> Column:
    """The maximal runs of characters other than BLANKS; none for null."""
    clean = trimmed(text)
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, "[\\x20\\x09-\\x0D]+", -1))


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(f, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b) by alternating large and small stars: rows (node, root), root the smallest node reachable.

    Each round joins the edges with one minimum for each node, so a hub's edges can be split among tasks; nothing is gathered by node.
    Nodes without an edge to another node don't appear.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b")).distinct()
        seen = now
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.where("b < a")
        root = low.groupBy("a").agg(F.min("b").alias("m"))
        # small star: a and all its smaller neighbours point at the smallest of them
        small = low.join(root, "a").select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("s"))
        e = cut(small.select(F.col("s.x").alias("a"), F.col("s.y").alias("b")).where("a <> b").distinct())
