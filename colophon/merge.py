"""Merging incoming values into stored ones, comparing the two, and undoing an import."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .schema import PAYLOAD
from .values import normalize_values

_KEY = ("resource_id", "term")


def _both(cur: DataFrame, new: DataFrame) -> DataFrame:
    return cur.select("id", *_KEY, *PAYLOAD).unionByName(new.select("id", *_KEY, *PAYLOAD))


def merge_append(cur: DataFrame, new: DataFrame) -> DataFrame:
    """Current values, then incoming ones that no current or earlier incoming value equals."""
    x = normalize_values(cur).withColumn("_s", F.lit(0)).unionByName(normalize_values(new).withColumn("_s", F.lit(1)))
    best = F.min(F.struct("_s", F.col("id").isNull().alias("n"), "id")).alias("_b")
    return x.groupBy(*_KEY, *PAYLOAD).agg(best).select(F.col("_b.id").alias("id"), *_KEY, *PAYLOAD)


def merge_revise(cur: DataFrame, new: DataFrame) -> DataFrame:
    """A property with an incoming value is replaced; others stay."""
    return _both(cur.join(new.select(*_KEY).distinct(), list(_KEY), "left_anti"), new)


def merge_update(cur: DataFrame, new: DataFrame, touched: DataFrame, mapped_terms: list[str]) -> DataFrame:
    """As revise, and mapped properties of touched resources (resource_id) without an incoming value are cleared."""
    kept = cur.where(~F.col("term").isin(mapped_terms)).unionByName(cur.where(F.col("term").isin(mapped_terms)).join(touched.select("resource_id").distinct(), "resource_id", "left_anti").select(*cur.columns))
    return merge_revise(kept, new)


def merge_replace(cur: DataFrame, new: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Only incoming values stay of touched resources (those with an incoming value if not given)."""
    ids = (touched if touched is not None else new).select("resource_id").distinct()
    return _both(cur.join(ids, "resource_id", "left_anti"), new)


def keep_identifiers(cur: DataFrame, new: DataFrame, identifier_terms: list[str], mode: str) -> DataFrame:
    """Incoming values with the current identifiers before them, unless mode is update."""
    if mode == "update":
        return new
    ids = cur.where(F.col("term").isin(identifier_terms)).join(new.select("resource_id").distinct(), "resource_id", "left_semi")
    return merge_append(ids.select(*new.columns), new)


def keep_links(cur: DataFrame, new: DataFrame, mode: str, key: str = "item_id") -> DataFrame:
    """Links of touched rows: the incoming ones, after the current ones unless mode is update; other rows keep theirs."""
    if mode == "update":
        return cur.join(new.select(key).distinct(), key, "left_anti").select(*cur.columns).unionByName(new.select(*cur.columns).distinct())
    return cur.unionByName(new.select(*cur.columns)).distinct()


def delete_values(v: DataFrame, resources: DataFrame, terms: list[str]) -> DataFrame:
    """Without the values of these terms of the resources (resource_id)."""
    return v.where(~F.col("term").isin(terms)).unionByName(v.where(F.col("term").isin(terms)).join(resources.select("resource_id").distinct(), "resource_id", "left_anti").select(*v.columns))


def delete_resources(resources: DataFrame, v: DataFrame, media: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables without the resources of ids (id) and the media of deleted items; links to them go too."""
    gone = ids.select("id").union(media.join(ids.select(F.col("id").alias("item_id")), "item_id", "left_semi").select("id")).distinct()
    left = lambda df, c: df.join(gone.select(F.col("id").alias(c)), c, "left_anti").select(*df.columns)
    return left(resources, "id"), left(left(v, "resource_id"), "value_resource_id"), left(media, "id")


def import_stats(rows: DataFrame) -> DataFrame:
    """One row of counters from (is_empty, skipped, errors) of each entry."""
    n = lambda c, name: F.count_if(c).alias(name)
    return rows.agg(F.count(F.lit(1)).alias("total"), n(F.col("skipped"), "skipped"), n(F.col("is_empty") & ~F.col("skipped"), "empty"), n(~F.col("is_empty") & ~F.col("skipped") & (F.col("errors") == 0), "processed"), F.sum("errors").alias("errors"))


def record_import(created: DataFrame, job_id: int) -> DataFrame:
    """Ledger rows (job_id, entity_id, entity_name) of created resources (id, resource_name)."""
    return created.select(F.lit(job_id).cast("long").alias("job_id"), F.col("id").alias("entity_id"), F.col("resource_name").alias("entity_name"))


def undo_import(resources: DataFrame, v: DataFrame, media: DataFrame, imported: DataFrame, job_id: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The tables and the ledger without what a job created."""
    own = imported.where(F.col("job_id") == job_id).select(F.col("entity_id").alias("id"))
    return *delete_resources(resources, v, media, own), imported.where(F.col("job_id") != job_id)


def diff_resources(cur: DataFrame, new: DataFrame, update_mode: str | None = None, mapped_terms: list[str] = (), simulate_missing: bool = False) -> DataFrame:
    """(resource_id, term, payload, n, diff): properties compared as multisets of normalized values: `=`, `-` or `+`.

    With an update mode (append, revise, update or replace) the incoming values of a property are first merged into the current ones as
    the mode would, each equal value once, and the result is compared. A property without an incoming value is then `-` whatever the mode; with
    simulate_missing it is what the mode leaves of it: kept by append, revise, and by update unless it is mapped.
    """
    if update_mode not in (None, "append", "revise", "update", "replace"):
        raise ValueError(f"unknown update mode: {update_mode}")
    key = [*_KEY, *PAYLOAD]
    count = lambda df, name: normalize_values(df).select(*key, F.lit(name).alias("_s"))
    n = count(cur, 1).union(count(new, 2)).groupBy(*key).agg(F.count_if(F.col("_s") == 1).alias("data1"), F.count_if(F.col("_s") == 2).alias("data2"))
    if update_mode:
        given = new.select(*_KEY).distinct().withColumn("_given", F.lit(True))
        n = n.join(given, list(_KEY), "left")
        merged = F.lit(1) if update_mode == "append" else F.least("data2", F.lit(1))
        left = F.lit(0)
        if simulate_missing and update_mode != "replace":
            cleared = F.col("term").isin(list(mapped_terms)) if update_mode == "update" else F.lit(False)
            left = F.when(cleared, 0).otherwise(F.least("data1", F.lit(1)))
        n = n.withColumn("data2", F.when(F.col("_given"), merged).otherwise(left))
    least = F.least("data1", "data2")
    parts = F.array(*(F.struct(x.cast("long").alias("n"), F.lit(s).alias("diff")) for s, x in (("=", least), ("-", F.col("data1") - least), ("+", F.col("data2") - least))))
    return n.select(*key, F.explode(parts).alias("_d")).where("_d.n > 0").select(*key, F.col("_d.n").alias("n"), F.col("_d.diff").alias("diff"))


def diff_fields(cur: DataFrame, new: DataFrame, fields: list[str], errors: DataFrame | None = None) -> DataFrame:
    """(id, meta, data1, data2, diff) of resources by their single fields: `=` equal, `+` or `-` on one side only, `≠` changed.

    A resource on one side only is one row, meta `resource`; one with errors (a column id) is one row, `×`. Empty texts, 0 and false count
    as nothing when a field is set or taken away. A row without an id has nothing to be compared with: `+` or `-`.
    """
    text = lambda df, side: F.array(*(F.struct(F.lit(c).alias("meta"), df[c].cast("string").alias("x"), F.coalesce(df[c].cast("string").isin("", "0", *(["false"] if df.schema[c].dataType.typeName() == "boolean" else [])), F.lit(True)).alias("none")) for c in fields)).alias(side)
    a, b = cur.select(F.col("id").alias("_a"), text(cur, "_x")), new.select(F.col("id").alias("_b"), text(new, "_y"))
    x = a.join(b, F.col("_a") == F.col("_b"), "full").withColumn("id", F.coalesce("_a", "_b"))
    bad = F.lit(False)
    if errors is not None:
        x = x.join(errors.select("id", F.lit(True).alias("_bad")).distinct(), "id", "left")
        bad = F.coalesce("_bad", F.lit(False))
    one = lambda meta, d1, d2, sign: F.struct(F.lit(meta).alias("meta"), d1.cast("string").alias("data1"), d2.cast("string").alias("data2"), F.lit(sign).alias("diff"))
    sign = lambda p, q: F.when(p["x"].eqNullSafe(q["x"]), "=").when(q["none"], "-").when(p["none"], "+").otherwise("≠")
    each = F.zip_with("_x", "_y", lambda p, q: F.struct(p["meta"].alias("meta"), p["x"].alias("data1"), q["x"].alias("data2"), sign(p, q).alias("diff")))
    rows = (F.when(F.col("_x").isNull(), F.array(one("resource", F.col("_a"), F.col("_b"), "+"))).when(F.col("_y").isNull(), F.array(one("resource", F.col("_a"), F.col("_b"), "-")))
            .when(bad, F.array(one("has_error", F.col("_a"), F.col("_b"), "×"))).otherwise(each))
    return x.select("id", F.explode(rows).alias("_d")).select("id", "_d.*")


def new_values(incoming: DataFrame, v: DataFrame, terms: list[str]) -> DataFrame:
    """(term, value): distinct incoming values of these terms that no stored one equals."""
    shown = F.coalesce(F.col("value_resource_id").cast("string"), F.nullif(F.col("uri"), F.lit("")), F.col("value"))
    pick = lambda df: df.where(F.col("term").isin(terms)).select("term", shown.alias("value")).where("value is not null and value <> ''")
    return pick(incoming).distinct().join(pick(v), ["term", "value"], "left_anti")


def diff_summary(diff: DataFrame) -> DataFrame:
    """(term, diff, n): values of each sign by property."""
    return diff.groupBy("term", "diff").agg(F.sum("n").alias("n"))


def last_wins(links: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key, the one with the highest order."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return links.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(cur: DataFrame, new: DataFrame, action: str, mapped_terms: list[str] = (), touched: DataFrame | None = None, unidentified: str = "create") -> DataFrame:
    """Values after an import of values whose resources may exist or not: the action append, revise, update, replace or delete for
    those that have a value or are touched, and for others create, or skip, which leaves them out."""
    known = cur.select("resource_id").distinct()
    if unidentified == "skip" and action != "delete":
        new = new.join(known, "resource_id", "left_semi").select(*new.columns)
    ids = new.select("resource_id") if touched is None else touched.select("resource_id")
    if action == "append":
        return merge_append(cur, new)
    if action == "revise":
        return merge_revise(cur, new)
    if action == "update":
        return merge_update(cur, new, ids, list(mapped_terms))
    if action == "replace":
        return merge_replace(cur, new, touched)
    if action == "delete":
        return cur.join(ids.distinct(), "resource_id", "left_anti").select(*cur.columns)
    raise ValueError(f"unknown action: {action}")


def update_thumbnails(resources: DataFrame, links: DataFrame) -> DataFrame:
    """resources with the thumbnail of links (resource_id, asset_id), the highest asset of several."""
    m = links.groupBy(F.col("resource_id").alias("id")).agg(F.max("asset_id").alias("_asset"))
    return resources.join(m, "id", "left").withColumn("thumbnail_id", F.coalesce("_asset", "thumbnail_id")).select(*resources.columns)


def diff_matrix(diff: DataFrame, terms: list[str], layout: str = "row") -> DataFrame:
    """The signs of a diff as a table: a row for each resource and a column for each term, or (column) a row for each term of a resource
    with columns for its removed, kept and added texts. Equal signs of a property are shown once."""
    x = diff.where(F.col("term").isin(terms))
    if layout == "row":
        signs = [F.array_join(F.array_sort(F.collect_set(F.when(F.col("term") == t, F.col("diff")))), "").alias(t) for t in terms]
        return x.groupBy("resource_id").agg(*signs)
    shown = F.coalesce(F.col("value_resource_id").cast("string"), "uri", "value")
    side = lambda s, name: F.array_join(F.array_sort(F.collect_set(F.when(F.col("diff") == s, shown))), " | ").alias(name)
    return x.groupBy("resource_id", "term").agg(side("-", "removed"), side("=", "kept"), side("+", "added"))


def write_diff(diff: DataFrame, path: str, fmt: str = "json", terms: list[str] = ()) -> None:
    """A diff as JSON rows, or as the table of rows or columns with tabs."""
    if fmt == "json":
        diff.write.json(path)
    else:
        diff_matrix(diff, list(terms), fmt).write.option("sep", "\t").option("header", True).csv(path)
