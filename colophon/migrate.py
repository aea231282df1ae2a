"""Moving records of another database into resources and values: entities, people, codes, users, logs, files and dates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ids import allocate_ids, can_keep_ids, remap_ids, unknown_ids
from .store import cut

#: Security codes of files that everybody may read (fixed values).
PUBLIC_SECURITY = ("public",)


def _literals(df: DataFrame, id_col: str, arms: list[Column]) -> DataFrame:
    """Value rows of the arms (structs of value columns) whose text or link isn't empty."""
    x = df.select(F.col(id_col).cast("long").alias("resource_id"), F.explode(F.array(*arms)).alias("_v")).select("resource_id", "_v.*")
    return x.where(F.col("value_resource_id").isNotNull() | (F.coalesce("value", F.lit("")) != ""))


def _struct(term: str, type_: str | Column, value: Column, lang: str | None = None, is_public: bool = True, link: Column | None = None) -> Column:
    kind = F.lit(type_) if isinstance(type_, str) else type_
    to = F.lit(None).cast("long") if link is None else link
    return F.struct(F.lit(term).alias("term"), kind.alias("type"), value.cast("string").alias("value"), F.lit(None).cast("string").alias("uri"), to.alias("value_resource_id"), F.lit(lang).cast("string").alias("lang"), F.lit(is_public).alias("is_public"))


def create_subtype_rows(resources: DataFrame, sub: DataFrame, name: str, parents: DataFrame | None = None) -> DataFrame:
    """sub and a row (id, and item_id from parents (id, item_id)) for each resource of this name that sub lacks."""
    new = resources.where(F.col("resource_name") == name).select("id").distinct().join(sub.select("id"), "id", "left_anti")
    if parents is not None:
        new = new.join(parents.groupBy("id").agg(F.min("item_id").alias("item_id")), "id", "left")
    return sub.unionByName(new, allowMissingColumns=True)


def entity_key(cols: list[str]) -> Column:
    """Key of an entity: its parts in lower case without outer spaces, and their digest, which tells texts apart that differ in case."""
    parts = [F.coalesce(F.trim(F.col(c)), F.lit("")) for c in cols]
    return F.concat(F.lower(F.concat_ws(" | ", *parts)), F.lit(" | "), F.sha1(F.concat_ws(" | ", *parts)))


def dedup_entities(tables: dict[str, DataFrame], cols: list[str], start: int = 1) -> tuple[DataFrame, DataFrame]:
    """(entity (id, key, cols), map (role, source_id, pos, id)) of tables (source_id, pos, cols) by role; all parts empty is no entity."""
    each = [t.select(F.lit(r).alias("role"), "source_id", "pos", *cols).withColumn("key", entity_key(cols)) for r, t in tables.items()]
    rows = reduce(lambda a, b: a.unionByName(b), each).where(F.concat_ws("", *(F.trim(c) for c in cols)) != "")
    entity = allocate_ids(rows.groupBy("key").agg(*(F.min(F.trim(c)).alias(c) for c in cols)), ["key"], start)
    return entity.select("id", "key", *cols), rows.join(entity.select("key", "id"), "key").select("role", "source_id", "pos", "id")


def people_values(people: DataFrame, terms: dict[str, str], parts: list[str], linked: bool = False) -> DataFrame:
    """Value rows of people (resource_id, role, pos, parts and, if linked, entity_id): a link to the entity, or the parts between commas."""
    name = F.concat_ws(", ", *(F.nullif(F.trim(c), F.lit("")) for c in parts))
    term = F.create_map(*(F.lit(x) for kv in terms.items() for x in kv))[F.col("role")]
    to = F.col("entity_id").cast("long") if linked else F.lit(None).cast("long")
    x = people.where(F.col("role").isin(list(terms)))
    return _literals(x.withColumn("_term", term), "resource_id", [F.struct(F.col("_term").alias("term"), F.when(to.isNotNull(), "resource:item").otherwise("literal").alias("type"), F.when(to.isNull(), name).alias("value"), to.alias("value_resource_id"), F.lit(True).alias("is_public"), F.col("pos").cast("int").alias("pos"))])


def child_table_values(child: DataFrame, key: str, column: str, term: str, type: str = "literal", is_public: bool = True) -> DataFrame:
    """Value rows, with pos, of a side table (key, pos, column)."""
    x = child.withColumn("_v", F.trim(F.col(column).cast("string"))).where("_v <> ''")
    return x.select(F.col(key).cast("long").alias("resource_id"), F.lit(term).alias("term"), F.lit(type).alias("type"), F.col("_v").alias("value"), F.lit(is_public).alias("is_public"), F.col("pos").cast("int").alias("pos"))


def code_to_concept(v: DataFrame, concept: DataFrame, term: str, type: str = "resource:item") -> DataFrame:
    """Literals of the term that are a concept's code (code, id) become links to it; others stay."""
    c = concept.groupBy(F.col("code").alias("_code")).agg(F.min("id").alias("_to"))
    x = v.withColumn("_code", F.when(F.col("term") == term, F.col("value"))).join(c, "_code", "left")
    hit = F.col("_to").isNotNull()
    return x.withColumns({"type": F.when(hit, type).otherwise(F.col("type")), "value": F.when(~hit, F.col("value")), "value_resource_id": F.coalesce("_to", "value_resource_id")}).select(*v.columns)


def migrate_hits(access: DataFrame, item_map: DataFrame, media_map: DataFrame, site: str = "/item/") -> DataFrame:
    """Hits (id, url, entity_name, entity_id, created, referrer, ip) of an access log (id, item, doc, year to second, referrer, ip).

    The entity is the media, else the item, else none: '' and 0. Maps are (source_id, dest_id); texts are never null.
    """
    pick = lambda m, k, n: m.groupBy(F.col("source_id").alias(k)).agg(F.min("dest_id").alias(n))
    x = access.join(pick(item_map, "item", "_item"), "item", "left").join(pick(media_map, "doc", "_doc"), "doc", "left")
    at = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", *(F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in ("year", "month", "day", "hour", "minute", "second")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    url = F.concat(F.lit(site), F.coalesce(F.col("item").cast("string"), F.lit("")), F.coalesce(F.concat(F.lit("/"), F.col("doc").cast("string")), F.lit("")))
    name = F.when(F.col("_doc").isNotNull(), "media").when(F.col("_item").isNotNull(), "items").otherwise("")
    return x.select("id", url.alias("url"), name.alias("entity_name"), F.coalesce("_doc", "_item", F.lit(0)).cast("long").alias("entity_id"), at.alias("created"), text("referrer"), text("ip"))


def migrate_messages(request: DataFrame, users: DataFrame, items: DataFrame, media: DataFrame) -> DataFrame:
    """request with owner_id, and resource_id of the media (doc), else of the item; unknown ones are null. Maps are (source_id, dest_id)."""
    for col, new, m in (("user", "owner_id", users), ("item", "_item", items), ("doc", "_doc", media)):
        request = request.join(m.groupBy(F.col("source_id").alias(col)).agg(F.min("dest_id").alias(new)), col, "left")
    return request.withColumn("resource_id", F.coalesce("_doc", "_item")).drop("_doc", "_item")


def migrate_searches(searches: DataFrame, users: DataFrame) -> DataFrame:
    """(id, owner_id, comment): the cleaned name, cut to 160 signs, with frequency and visibility."""
    m = users.groupBy(F.col("source_id").alias("user")).agg(F.min("dest_id").alias("owner_id"))
    name = F.substring(F.trim(F.regexp_replace(F.coalesce("name", F.lit("")), r"\s+", " ")), 1, 160)
    seen = F.when(F.col("is_public"), "public").otherwise("private")
    return searches.join(m, "user", "left").select("id", "owner_id", F.concat_ws(" / ", F.nullif(name, F.lit("")), F.nullif("frequency", F.lit("")), seen).alias("comment"))


def dedup_users(users: DataFrame, existing: DataFrame, domain: str = "example.org") -> DataFrame:
    """users (id, email, name) to be created beside existing ones, with `source_id` and a free id, e-mail and name.

    An id that exists is replaced by one after all others, an invalid e-mail by one made of the id. Of equal e-mails or names, compared
    in lower case, an existing one or the smallest id keeps it; others get the source id before the e-mail, after the name.
    """
    top = F.greatest(*(F.coalesce(F.lit(df.agg(F.max("id")).first()[0]).cast("long"), F.lit(0)) for df in (users, existing)))
    taken = users.join(existing.select("id"), "id", "left_semi")
    fresh = allocate_ids(taken.select(F.col("id").alias("source_id")), ["source_id"]).select("source_id", (F.col("id") + top).alias("_new"))
    x = users.withColumnRenamed("id", "source_id").join(fresh, "source_id", "left").withColumn("id", F.coalesce("_new", "source_id")).drop("_new")
    mail = F.lower(F.trim("email"))
    x = x.withColumn("email", F.when(mail.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), F.trim("email")).otherwise(F.concat(F.lit("user-"), F.col("source_id").cast("string"), F.lit(f"@{domain}"))))
    for col, change in (("email", lambda c: F.concat(F.col("source_id").cast("string"), F.lit("-"), c)), ("name", lambda c: F.concat(c, F.lit("-"), F.col("source_id").cast("string")))):
        known = existing.select(F.lower(F.col(col)).alias("_k")).where("_k is not null").distinct().withColumn("_known", F.lit(True))
        first = F.min("source_id").over(Window.partitionBy("_k"))
        x = x.withColumn("_k", F.lower(F.col(col))).withColumn("_first", first).join(known, "_k", "left")
        x = x.withColumn(col, F.when(F.col("_k").isNotNull() & (F.col("_known").isNotNull() | (F.col("_first") != F.col("source_id"))), change(F.col(col))).otherwise(F.col(col))).drop("_k", "_first", "_known")
    return x.select("id", "source_id", *(c for c in users.columns if c != "id"))


def user_settings(users: DataFrame, keys: dict[str, str]) -> DataFrame:
    """(user_id, key, value) of the columns (column to key) that aren't empty."""
    each = F.array(*(F.struct(F.lit(k).alias("key"), F.trim(F.col(c).cast("string")).alias("value")) for c, k in keys.items()))
    return users.select(F.col("id").alias("user_id"), F.explode(each).alias("_s")).select("user_id", "_s.*").where("value <> ''")


def asset_storage(assets: DataFrame, existing: DataFrame) -> DataFrame:
    """New assets (filename, ...) with storage_id and extension of their file name; the storage ids that exist are left out, each other stays once."""
    ext = F.regexp_extract("filename", r"\.([^./]*)$", 1)
    x = assets.withColumns({"storage_id": F.regexp_replace("filename", r"\.[^./]*$", ""), "extension": F.lower(ext)})
    return x.join(existing.select("storage_id").distinct(), "storage_id", "left_anti").dropDuplicates(["storage_id"])


def clean_label(col: Column) -> Column:
    return F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}_]+", "")


def reconcile_vocabs(source: DataFrame, target: DataFrame) -> DataFrame:
    """(id, target_id, label) of vocabularies (id, label, term_value): one with the same cleaned label and set of terms is reused, the
    smallest id of several; others are new, renamed with their id where the label is taken. Sets are compared by their digest."""
    def sets(df: DataFrame) -> DataFrame:
        terms = df.where("term_value is not null").select("id", F.xxhash64("term_value").alias("_h"), F.sha2("term_value", 256).alias("_d")).distinct()
        sums = terms.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), F.bit_xor("_h").alias("_x"), F.sum(F.conv(F.substring("_d", 1, 12), 16, 10).cast("decimal(30,0)")).alias("_s"))
        labels = df.groupBy("id").agg(F.min("label").alias("label"))
        return labels.join(sums, "id", "left").na.fill(0, ["_n", "_x"]).withColumn("_s", F.coalesce("_s", F.lit(0).cast("decimal(38,0)"))).withColumn("_l", clean_label(F.col("label")))

    t = sets(target)
    same = t.groupBy("_l", "_n", "_x", "_s").agg(F.min("id").alias("target_id"))
    labels = t.select("_l").distinct().withColumn("_taken", F.lit(True))
    x = sets(source).join(same, ["_l", "_n", "_x", "_s"], "left").join(labels, "_l", "left")
    new = F.when(F.col("target_id").isNull() & F.col("_taken").isNotNull(), F.concat("label", F.lit(" "), F.col("id").cast("string"))).otherwise(F.col("label"))
    return x.select("id", "target_id", new.alias("label"))


def reconcile_terms(source: DataFrame, target: DataFrame, prefixes: dict[str, str], start: int) -> DataFrame:
    """(source_id, dest_id, term, is_new) of properties (id, term): matched by the mapped prefix and the local name, others get ids from start."""
    prefix, local = F.substring_index("term", ":", 1), F.regexp_replace("term", "^[^:]*:", "")
    mapped = F.coalesce(F.create_map(*(F.lit(x) for kv in prefixes.items() for x in kv))[prefix], prefix) if prefixes else prefix
    s = source.select(F.col("id").alias("source_id"), F.concat(mapped, F.lit(":"), local).alias("term"))
    x = s.join(target.groupBy("term").agg(F.min("id").alias("_to")), "term", "left")
    new = allocate_ids(x.where("_to is null").select("term").distinct(), ["term"], start, "_made")
    return x.join(new, "term", "left").select("source_id", F.coalesce("_to", "_made").alias("dest_id"), "term", F.col("_to").isNull().alias("is_new"))


def media_positions(media: DataFrame, order: list[str]) -> DataFrame:
    """media with its place in its item, from 1."""
    return media.withColumn("position", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))


def access_rights(media: DataFrame, column: str = "security") -> DataFrame:
    """media with is_public, and access: free for public files, forbidden for others that have a code; no code is public."""
    public = F.coalesce(F.col(column).isin(*PUBLIC_SECURITY), F.lit(True)) | (F.col(column) == "")
    return media.withColumn("access", F.when(public, "free").otherwise("forbidden")).withColumn("is_public", F.col("access") == "free")


def membership(items: DataFrame, set_map: DataFrame, col: str = "set") -> DataFrame:
    """(item_id, item_set_id) of items (id, an array of source sets) by the map (source_id, dest_id), each once; unknown sets are left out."""
    each = items.select(F.col("id").alias("item_id"), F.explode(col).alias("source_id")).distinct()
    return each.join(set_map.select("source_id", F.col("dest_id").alias("item_set_id")), "source_id").select("item_id", "item_set_id").distinct()


def record_values(df: DataFrame, id_col: str, spec: dict[str, dict]) -> DataFrame:
    """Value rows of a wide record: for each column {term, and type, lang, is_public, transform (Column to Column)}; empty cells give none."""
    def arm(c: str, s: dict) -> Column:
        f: Callable[[Column], Column] = s.get("transform", lambda x: x)
        return _struct(s["term"], s.get("type", "literal"), F.trim(f(F.col(c)).cast("string")), s.get("lang"), s.get("is_public", True))

    return _literals(df, id_col, [arm(c, s) for c, s in spec.items()])


def inherit_from_item(media: DataFrame, items: DataFrame, templates: dict[str, tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(media with owner_id, created, and template and class mapped from their item's template; media without a known item)."""
    own = items.select(F.col("id").alias("item_id"), "owner_id", "created", F.col("template").alias("_t"))
    x = media.drop("owner_id", "created", "template", "class").join(own.withColumn("_found", F.lit(True)), "item_id", "left")
    to = lambda i: F.create_map(*(F.lit(x) for k, v in templates.items() for x in (k, v[i])))[F.col("_t")] if templates else F.lit(None).cast("string")
    full = x.where("_found").withColumns({"template": to(0), "class": to(1)}).drop("_t", "_found")
    return full, x.where("_found is null").select(*(c for c in media.columns if c not in ("owner_id", "created", "template", "class")))


def media_path(base: str, folder: Column, position: Column, filename: Column) -> Column:
    """base/folder/two-digit position/file name."""
    return F.concat_ws("/", F.lit(base.rstrip("/")), F.btrim(folder, F.lit("/")), F.lpad(position.cast("string"), 2, "0"), filename)


def restore_dates(entities: DataFrame, dates: DataFrame, key: str = "id") -> DataFrame:
    """entities with the created and modified dates that the source has; others stay."""
    d = dates.groupBy(key).agg(F.min("created").alias("_c"), F.max("modified").alias("_m"))
    return entities.join(d, key, "left").withColumns({"created": F.coalesce("_c", "created"), "modified": F.coalesce("_m", "modified")}).select(*entities.columns)


def remap_vocab_item_sets(vocab: DataFrame, id_map: DataFrame) -> DataFrame:
    """vocab whose item_set_id is that of the destination; an unknown one is null."""
    m = id_map.where("entity = 'item_sets'").select(F.col("source_id").cast("long").alias("item_set_id"), F.col("dest_id").alias("_to"))
    return vocab.join(m, "item_set_id", "left").withColumn("item_set_id", F.col("_to")).select(*vocab.columns)


@dataclass
class Migration:
    """Tables with the ids they have from now on, the map (entity, source_id, dest_id), and ids that lead nowhere (entity, column, source_id, n)."""

    tables: dict[str, DataFrame]
    id_map: DataFrame
    unknown: DataFrame


def migrate_tables(tables: dict[str, DataFrame], keys: dict[str, str | None], references: dict[str, dict[str, str | list[str]]], existing: dict[str, DataFrame] | None = None) -> Migration:
    """All tables of a database with new ids, in the order of what refers to what.

    keys names each table's own id, or none where nothing refers to it; references its columns that are ids of other tables, or of the
    first of several that has it. A table keeps its ids if none is taken in existing (id, by name), else all its rows have new ones above those,
    in the order of the old; a table may refer to itself. Ids that are null, or are found twice, are an error before anything is
    written; those that lead nowhere become null and are reported. Each table is written once.
    """
    needs = {t: {r for named in references.get(t, {}).values() for r in ([named] if isinstance(named, str) else named)} for t in tables}
    if lost := sorted({r for rs in needs.values() for r in rs if r not in tables or not keys.get(r)}):
        raise ValueError(f"no table with ids: {', '.join(lost)}")
    try:
        order = list(TopologicalSorter({t: rs - {t} for t, rs in needs.items()}).static_order())
    except CycleError as e:
        raise ValueError(f"tables refer to each other in a circle: {e.args[1]}") from e
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for t in order:
        if not keys.get(t):
            continue
        own = tables[t].select(F.col(keys[t]).cast("long").alias("id"))
        n, ids, distinct = own.agg(F.count(F.lit(1)), F.count("id"), F.count_distinct("id")).first()
        if not n == ids == distinct:
            raise ValueError(f"{t}: {n} rows, {ids} ids, {distinct} different")
        taken = (existing or {}).get(t)
        if taken is None or can_keep_ids(own, taken):
            new = own.withColumn("dest_id", F.col("id"))
        else:
            new = allocate_ids(own, ["id"], taken.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] + 1, "dest_id")
        parts.append(new.select(F.lit(t).alias("entity"), F.col("id").cast("string").alias("source_id"), "dest_id"))
    none = spark.createDataFrame([], "entity string, source_id string, dest_id long")
    id_map = cut(reduce(lambda a, b: a.union(b), parts, none))
    out, unknown = {}, spark.createDataFrame([], "entity string, column string, source_id string, n long")
    for t in order:
        refs = references.get(t, {})
        if refs:
            unknown = unknown.union(unknown_ids(tables[t], refs, id_map, t))
        out[t] = cut(remap_ids(tables[t], refs | ({keys[t]: t} if keys.get(t) else {}), id_map))
    return Migration(out, id_map, cut(unknown))
