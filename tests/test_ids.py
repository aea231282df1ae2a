"""Ids of many rows with further columns, over several partitions, each used twice."""

from pyspark.sql import functions as F

from colophon import ids, migrate


def test_many_rows(spark):
    rows = spark.range(0, 400_000, 1, 8).select(F.xxhash64("id").alias("k"), F.concat(F.lit("x"), "id").alias("more"))
    got = ids.allocate_ids(rows, ["k"])
    assert got.columns == ["k", "more", "id"]
    assert got.agg(F.count_distinct("id"), F.min("id"), F.max("id"), F.count("more")).first()[:] == (400_000, 1, 400_000, 400_000)
    twice = got.join(got.select("more", F.col("id").alias("other")), "more")
    assert twice.where("id = other").count() == 400_000
    assert got.join(got.select(F.col("id") - 1, F.col("k").alias("next")).toDF("id", "next"), "id").where("k >= next").count() == 0


def test_entities(spark):
    people = spark.range(0, 100_000, 1, 8).select(F.col("id").alias("source_id"), F.lit(1).alias("pos"), F.concat(F.lit("f"), F.col("id") % 60_000).alias("family"), F.lit("g").alias("given"))
    entity, m = migrate.dedup_entities({"a": people}, ["family", "given"])
    both = m.join(entity, "id").join(people.select("source_id", F.col("family").alias("own")), "source_id")
    assert both.where("family = own").count() == 100_000 and entity.agg(F.count_distinct("id"), F.max("id")).first()[:] == (60_000, 60_000)
