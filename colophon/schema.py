"""Canonical tables: columns and types that every function keeps to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VALUE = "id BIGINT, resource_id BIGINT, term STRING, type STRING, value STRING, uri STRING, value_resource_id BIGINT, lang STRING, is_public BOOLEAN"
RESOURCE = "id BIGINT, resource_name STRING, title STRING, owner_id BIGINT, class STRING, template STRING, thumbnail_id BIGINT, is_public BOOLEAN, is_open BOOLEAN, created TIMESTAMP, modified TIMESTAMP"
MEDIA = "id BIGINT, item_id BIGINT, position INT, ingester STRING, source STRING, storage_id STRING, extension STRING, media_type STRING, sha256 STRING"
#: What makes two values of a resource's property equal.
PAYLOAD = ("type", "value", "uri", "value_resource_id", "lang", "is_public")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
