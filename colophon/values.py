"""Predicates on values, their normal form, and their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .schema import PAYLOAD
from .text import fold


def is_literal() -> Column:
    return (F.coalesce(F.col("type"), F.lit("")).isin("literal", "")) & (F.col("value") != "")


def literal_values(v: DataFrame) -> DataFrame:
    """Values that are text and not empty."""
    return v.where(is_literal())


def datatype_filter(v: DataFrame, types: list[str]) -> DataFrame:
    """Values of these types; `valuesuggest` stands for all its vocabularies, '' also for no type."""
    keep = F.col("type").isin(types)
    if "valuesuggest" in types:
        keep = keep | F.col("type").startswith("valuesuggest")
    if "" in types:
        keep = keep | F.col("type").isNull()
    return v.where(keep)


def exclude_list(v: DataFrame, excluded: DataFrame, col: str = "value", match: str = "ci_ai") -> DataFrame:
    """Without the values in the list (a column `value`)."""
    keys = excluded.select(fold(F.col("value"), match).alias("_k")).where("_k is not null").distinct()
    return v.join(keys, fold(v[col], match) == keys["_k"], "left_anti")


def normalize_values(v: DataFrame) -> DataFrame:
    """Type defaults to literal, visibility to public, and empty texts are null."""
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return v.withColumns({"type": F.coalesce(blank("type"), F.lit("literal")), "value": blank("value"), "uri": blank("uri"), "lang": blank("lang"), "is_public": F.coalesce("is_public", F.lit(True))})


def dedup_values(v: DataFrame) -> DataFrame:
    """Of equal normalized values of a resource's property, the one with the lowest id."""
    n = normalize_values(v)
    key = ["resource_id", "term", *PAYLOAD]
    return n.groupBy(*key).agg(F.min("id").alias("id")).select(*n.columns)


def reorder_values(v: DataFrame, template_property: DataFrame) -> DataFrame:
    """v with `position`: by resource, terms in the template's order, others after them as first seen, ids in order within a term; values
    without an id come last of their term, and are seen after all others."""
    p = template_property.groupBy("term").agg(F.min("position").alias("_p"))
    seen = F.min("id").over(Window.partitionBy("resource_id", "term"))
    x = v.join(p, "term", "left").withColumn("_seen", seen)
    order = Window.partitionBy("resource_id").orderBy(F.col("_p").asc_nulls_last(), F.col("_seen").asc_nulls_last(), "term", F.col("id").asc_nulls_last(), *PAYLOAD)
    return x.withColumn("position", F.row_number().over(order)).drop("_p", "_seen").select(*v.columns, "position")


def first_value(v: DataFrame, terms: list[str]) -> DataFrame:
    """Each resource's value with the lowest id among these terms; a value without an id comes after all that have one."""
    rest = [c for c in v.columns if c not in ("id", "resource_id")]
    least = F.min(F.struct(F.col("id").isNull().alias("_none"), "id", *rest)).alias("_v")
    return v.where(F.col("term").isin(terms)).groupBy("resource_id").agg(least).select("_v.id", "resource_id", *(f"_v.{c}" for c in rest))


def vocab_member(v: DataFrame, terms: DataFrame) -> DataFrame:
    """Values that are among the vocabulary's terms (a column `term_value`): as text, as uri, or as "uri label"."""
    t = terms.select(F.col("term_value").alias("_t")).where("_t is not null").distinct()
    u = t.select(F.substring_index("_t", " ", 1).alias("_t")).distinct()
    return v.where("uri is null").join(t, F.col("value") == t["_t"], "left_semi").union(v.where("uri is not null").join(u, F.col("uri") == u["_t"], "left_semi"))
