"""Finding resources by identifiers: one distinct list and one join for all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import fold


def _distinct(identifiers: DataFrame) -> DataFrame:
    return identifiers.select("identifier").where("identifier is not null and identifier <> ''").distinct()


def find_by_id(identifiers: DataFrame, resources: DataFrame, resource_name: str | None = None) -> DataFrame:
    """(identifier, id) of numeric identifiers that are ids, of the named type if one is given."""
    r = resources if resource_name is None else resources.where(F.col("resource_name") == resource_name)
    x = _distinct(identifiers).where(F.col("identifier").rlike("^[0-9]{1,18}$")).withColumn("id", F.col("identifier").cast("long"))
    return x.join(r.select("id"), "id").select("identifier", "id")


def find_by_value(identifiers: DataFrame, v: DataFrame, terms: list[str], resources: DataFrame | None = None, resource_name: str | None = None, match: str = "exact") -> DataFrame:
    """(identifier, id, count): the smallest id of the resources whose uri, or text without one, is the identifier; and their number."""
    key = F.coalesce(F.nullif(F.col("uri"), F.lit("")), F.col("value"))
    x = v.where(F.col("term").isin(terms)).select("resource_id", fold(key, match).alias("_k")).where("_k is not null and _k <> ''").distinct()
    if resource_name is not None:
        x = x.join(resources.where(F.col("resource_name") == resource_name).select(F.col("id").alias("resource_id")), "resource_id", "left_semi")
    ids = _distinct(identifiers).withColumn("_k", fold(F.col("identifier"), match))
    found = x.groupBy("_k").agg(F.min("resource_id").alias("id"), F.count(F.lit(1)).alias("count"))
    return ids.join(found, "_k").select("identifier", "id", "count")


def find_by_media(identifiers: DataFrame, media: DataFrame, column: str, ingester: str | None = None) -> DataFrame:
    """(identifier, id, count) of media by source, storage_id or sha256."""
    m = media if ingester is None else media.where(F.col("ingester") == ingester)
    found = m.groupBy(F.col(column).alias("identifier")).agg(F.min("id").alias("id"), F.count_distinct("id").alias("count"))
    return _distinct(identifiers).join(found, "identifier").select("identifier", "id", "count")


def find_by_filename(identifiers: DataFrame, media: DataFrame, basename: bool = False) -> DataFrame:
    """(identifier, id, count) of media by storage id and extension, or by the last part of that path."""
    path = F.concat("storage_id", F.when(F.coalesce(F.col("extension"), F.lit("")) != "", F.concat(F.lit("."), "extension")).otherwise(""))
    return find_by_media(identifiers, media.withColumn("_path", F.substring_index(path, "/", -1) if basename else path), "_path")


def resolve_case(identifiers: DataFrame, candidates: DataFrame) -> DataFrame:
    """(identifier, id): the candidate (identifier, id) equal to it, else the one equal without case; the smallest id of several."""
    c = candidates.select(F.col("identifier").alias("_c"), "id", F.lower("identifier").alias("_k"))
    x = _distinct(identifiers).withColumn("_k", F.lower("identifier")).join(c, "_k")
    best = F.min_by("id", F.struct((F.col("_c") != F.col("identifier")).alias("a"), F.col("id").alias("b")))
    return x.groupBy("identifier").agg(best.alias("id"))


def find_resources(found: list[DataFrame]) -> DataFrame:
    """(identifier, id): of several results in order of priority, the first that has the identifier."""
    parts = [f.select("identifier", "id", F.lit(i).alias("_p")) for i, f in enumerate(found)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("identifier").agg(F.min_by("id", F.struct("_p", "id")).alias("id"))


def duplicate_identifiers(candidates: DataFrame, allowed: bool = False) -> DataFrame:
    """Messages (identifier, severity) for identifiers that several resources have."""
    return candidates.where("count > 1").select("identifier", F.lit("warn" if allowed else "err").alias("severity"))


def extract_identifiers(rows: DataFrame, roles: dict[str, str]) -> DataFrame:
    """source_identifier (source_index, identifier, namespace, role): every column of roles (column -> namespace), arrays or texts."""
    out = None
    for col, namespace in roles.items():
        value = F.explode(col) if rows.schema[col].dataType.typeName() == "array" else F.col(col)
        x = rows.select("source_index", value.alias("identifier"), F.lit(namespace).alias("namespace"), F.lit(col).alias("role")).where("identifier is not null and identifier <> ''")
        out = x if out is None else out.union(x)
    return out.distinct()


def resolve_sources(source_identifier: DataFrame, existing: DataFrame) -> DataFrame:
    """source_identifier with the id of (identifier, namespace), null where none is known."""
    e = existing.groupBy("identifier", "namespace").agg(F.min("id").alias("id"))
    return source_identifier.join(e, ["identifier", "namespace"], "left")


def first_match_per_resource(rows: DataFrame, v: DataFrame, terms: list[str]) -> DataFrame:
    """(source_index, id, conflict): rows (source_index, term, identifier) by the first term of the list that finds a resource."""
    x = rows.select("source_index", F.lit(None).cast("long").alias("id"), F.lit(0).alias("_p")).where("false")
    for i, term in enumerate(terms):
        own = rows.where(F.col("term") == term)
        x = x.union(own.join(find_by_value(own, v, [term]), "identifier").select("source_index", "id", F.lit(i).alias("_p")))
    return x.groupBy("source_index").agg(F.min_by("id", F.struct("_p", "id")).alias("id"), (F.count_distinct("id") > 1).alias("conflict"))


def match_item_media(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """incoming with the smallest id of the media of the same item, ingester and source."""
    e = existing.groupBy("item_id", "ingester", "source").agg(F.min("id").alias("id"))
    return incoming.join(e, ["item_id", "ingester", "source"], "left")


def resolve_users(df: DataFrame, users: DataFrame, col: str, default: int) -> DataFrame:
    """df with owner_id: a number is an id, a text with @ an e-mail, anything else a name; unknown ones get the default."""
    u = users.groupBy(F.lower("email").alias("_e")).agg(F.min("id").alias("_by_email"))
    n = users.groupBy(F.col("name").alias("_name")).agg(F.min("id").alias("_by_name"))
    i = users.select(F.col("id").alias("_by_id")).distinct()
    x = df.join(i, F.expr(f"try_cast(`{col}` as bigint)") == i["_by_id"], "left").join(u, F.lower(F.when(F.col(col).contains("@"), F.col(col))) == u["_e"], "left").join(n, F.col(col) == n["_name"], "left")
    return x.withColumn("owner_id", F.coalesce("_by_id", "_by_email", "_by_name", F.lit(default))).drop("_by_id", "_by_email", "_by_name", "_e", "_name")


def find_assets(identifiers: DataFrame, asset: DataFrame) -> DataFrame:
    """(identifier, id) of assets by name, else by storage id, else by id; the smallest id of several."""
    ids = _distinct(identifiers)
    by = lambda c: ids.join(asset.groupBy(F.col(c).cast("string").alias("identifier")).agg(F.min("id").alias("id")), "identifier")
    return find_resources([by("name"), by("storage_id"), by("id")])


def complete_references(rows: DataFrame, resolved: DataFrame, columns: dict[str, str]) -> DataFrame:
    """rows with the ids (column to new column) of the identifiers in resolved (identifier, id), also of rows of the same source.

    An identifier resolved more than once has the id of its last row, that with the highest source_index.
    """
    last = resolved.groupBy(F.col("identifier").alias("_k")).agg(F.max_by("id", F.struct("source_index", "id")).alias("_id"))
    for col, new in columns.items():
        x = rows.join(last, F.col(col) == F.col("_k"), "left")
        rows = (x.withColumn(new, F.coalesce(new, "_id")) if new in rows.columns else x.withColumn(new, F.col("_id"))).drop("_k", "_id")
    return rows
