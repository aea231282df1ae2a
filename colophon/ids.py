"""Consecutive ids and source indexes without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import cut


def allocate_ids(df: DataFrame, key_cols: list[str], start: int = 1, col: str = "id") -> DataFrame:
    """df with consecutive ids from start in the order of key_cols, whatever the number of partitions.

    Rows are ranged, sorted by key and written once with their places, so that every use of the result sees the same ids. Each partition
    is counted, and the counts before it are its offset: only the counts, a row for each partition, are summed in order.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *key_cols).sortWithinPartitions(*key_cols) if key_cols else df
    placed = cut(ordered.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size") - F.shiftleft("_part", 33)).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(col, F.lit(start).cast("long") + F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def conflict_ids(source: DataFrame, existing: DataFrame, col: str = "id") -> DataFrame:
    """Ids of source that existing has already."""
    return source.select(col).join(existing.select(col), col, "left_semi")


def can_keep_ids(source: DataFrame, existing: DataFrame, col: str = "id") -> bool:
    """Whether all source ids are free: they are kept all or not at all."""
    return conflict_ids(source, existing, col).isEmpty()


def remap_ids(df: DataFrame, columns: dict[str, str | list[str]], id_map: DataFrame) -> DataFrame:
    """Each column's ids replaced by the destination ids of its entity, or of the first of several entities that has it; unknown ones become null."""
    for col, named in columns.items():
        entities = [named] if isinstance(named, str) else named
        order = F.array_position(F.array(*map(F.lit, entities)), F.col("entity"))
        m = id_map.where(F.col("entity").isin(entities)).groupBy(F.col("source_id").cast("string").alias("_s")).agg(F.min_by("dest_id", F.struct(order, "dest_id")).alias("_d"))
        df = df.join(m, F.col(col).cast("string") == F.col("_s"), "left").withColumn(col, F.col("_d")).drop("_s", "_d")
    return df


def unknown_ids(df: DataFrame, columns: dict[str, str | list[str]], id_map: DataFrame, name: str) -> DataFrame:
    """(entity, column, source_id, n): ids of df (of the entity name) that remap_ids would lose, and how many rows have them."""
    out = None
    for col, named in columns.items():
        m = id_map.where(F.col("entity").isin([named] if isinstance(named, str) else named)).select(F.col("source_id").cast("string").alias("source_id"))
        x = df.select(F.col(col).cast("string").alias("source_id")).where("source_id is not null").groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).join(m, "source_id", "left_anti")
        x = x.select(F.lit(name).alias("entity"), F.lit(col).alias("column"), "source_id", "n")
        out = x if out is None else out.union(x)
    return out
