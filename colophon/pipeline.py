"""The import as a whole: from a table of entries to merged values, resources, media, item sets, messages and a ledger."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import checks, entries, identifiers, ids, merge, metadata, schema
from .sources import INDEX
from .store import cut

#: Headers of fields that aren't properties (fixed values): what a row is, its own id, its item sets, its media, and the item of a media.
NAME, OWN_ID, ITEM_SET, MEDIA, ITEM = "o:resource_name", "o:id", "o:item_set", "o:media", "o:item"
#: Single fields of a resource by their headers, and those that are true or false.
FIELDS = {"o:resource_class": "class", "o:resource_template": "template", "o:is_public": "is_public", "o:is_open": "is_open"}
BOOLEANS = ("is_public", "is_open")
ACTIONS = ("create", "append", "revise", "update", "replace", "delete", "skip")


@dataclass
class Import:
    """The tables after the import, messages of the checks, and ledger rows of what was created."""

    values: DataFrame
    resources: DataFrame
    messages: DataFrame
    ledger: DataFrame
    media: DataFrame
    item_sets: DataFrame


def _message(df: DataFrame, severity: str, text: str) -> DataFrame:
    return df.select(INDEX, F.lit(severity).alias("severity"), F.concat(F.lit(text), F.col("raw")).alias("message"))


def _own_ids(m: DataFrame, v: DataFrame, resources: DataFrame, terms: list[str]) -> tuple[DataFrame, DataFrame]:
    """(own identifiers (source_index, term, pos, identifier), found (source_index, id, conflict)): by the terms in order, OWN_ID among them."""
    own = m.where(F.col("term").isin(terms)).select(INDEX, "term", "pos", F.col("raw").alias("identifier"))
    found = identifiers.first_match_per_resource(own, v, [t for t in terms if t != OWN_ID])
    if OWN_ID in terms:
        ids_ = own.where(F.col("term") == OWN_ID)
        by_id = ids_.join(identifiers.find_by_id(ids_, resources), "identifier").groupBy(INDEX).agg(F.min("id").alias("_own"), (F.count_distinct("id") > 1).alias("_two"))
        found = found.join(by_id, INDEX, "full").select(INDEX, F.coalesce("_own", "id").alias("id"), (F.coalesce("conflict", F.lit(False)) | F.coalesce("_two", F.lit(False)) | F.coalesce(F.col("_own") != F.col("id"), F.lit(False))).alias("conflict"))
    return own, found


def _top(*tables: DataFrame) -> int:
    """The largest id of these tables, 0 without one."""
    return reduce(lambda a, b: a.union(b), [t.select("id") for t in tables]).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def _with_fields(after: DataFrame, cells: DataFrame, named: list[str], touched: DataFrame, action: str) -> DataFrame:
    """Resources with the single fields of cells (resource_id, source_index, pos, term, raw), each resource's last: an empty one changes nothing in
    append and revise, is cleared by update if it has a column, and by replace in any case; true and false are never cleared."""
    text = lambda term: F.max_by(F.when(F.col("term") == term, F.col("raw")), F.when(F.col("term") == term, F.struct(INDEX, "pos")))
    new = cells.groupBy(F.col("resource_id").alias("id")).agg(*(text(t).alias(f"_{c}") for t, c in FIELDS.items()))
    x = after.join(touched.select(F.col("resource_id").alias("id"), F.lit(True).alias("_in")), "id", "left").join(new, "id", "left")
    made = {}
    for term, c in FIELDS.items():
        if c not in after.columns and term not in named:
            continue
        own = F.col(c) if c in after.columns else F.lit(None).cast("boolean" if c in BOOLEANS else "string")
        value = metadata.boolean(F.col(f"_{c}")) if c in BOOLEANS else F.col(f"_{c}")
        clears = c not in BOOLEANS and (action == "replace" or (action == "update" and term in named))
        made[c] = F.when(F.col("_in"), value if clears else F.coalesce(value, own)).otherwise(own)
    return x.withColumns(made).drop("_in", *(f"_{c}" for c in FIELDS.values()))


def import_entries(
    table: DataFrame, v: DataFrame, resources: DataFrame, identifier_terms: list[str], action: str = "create", headers: dict[str, str] | None = None, separator: str | None = None,
    resource_name: str = "items", unidentified: str = "error", mode: str = "continue_on_error", vocab: DataFrame | None = None, literal_fallback: bool = True, job_id: int = 0,
    media: DataFrame | None = None, item_sets: DataFrame | None = None,
) -> Import:
    """Entries cleaned, melted by their columns' headers, identified, checked, typed and merged into the stored tables.

    action is create, or append, revise, update, replace or delete for entries whose identifier a stored resource has; others are an
    error, skipped or created (unidentified); skip leaves everything as it is. Identifier terms are properties, or o:id for the id itself. Entries with the same first
    identifier make one resource; each without one makes its own. Columns headed o:resource_name, o:item_set, o:media and o:item
    say what a row is (resource_name otherwise), which item sets it is in, what media it has, and of which item a media is;
    o:resource_class, o:resource_template, o:is_public and o:is_open are single fields of the resource.

    New entries have their ids before any value is typed, so links may go to stored resources and to any entry of the same table, earlier
    or later; of several entries with one identifier the last counts. A link to an entry that is not imported after all is dropped with a
    warning. Deleting takes along an item's media and the links to what is deleted. Numbers of ids may have gaps where entries
    fail. mode says what becomes of errors (checks.stop_policy). Entries are numbered by source_index; they and the stored tables may be
    read more than once. The results are written in the shared folder.
    """
    if action not in ACTIONS:
        raise ValueError(f"unknown action: {action}")
    spark: SparkSession = table.sparkSession
    media = schema.empty(spark, schema.MEDIA) if media is None else media
    item_sets = schema.empty(spark, "item_id long, item_set_id long") if item_sets is None else item_sets
    if action == "skip":
        created = resources.select("id", "resource_name").where("false")
        return Import(v, resources, schema.empty(spark, f"{INDEX} long, severity string, message string"), merge.record_import(created, job_id), media, item_sets)
    columns = [c for c in table.columns if c != INDEX]
    heads = {t.term for c in columns for t in entries.parse_header((headers or {}).get(c, c))}
    e = entries.drop_empty_entries(entries.clean_entry(table, separator))
    m = cut(entries.melt(e, headers))
    field = lambda name: m.where(F.col("term") == name).select(INDEX, "pos", "raw")
    own, found = _own_ids(m, v, resources, identifier_terms)
    order = F.array_position(F.array(*map(F.lit, identifier_terms)), F.col("term"))
    # the key of a new resource: its first identifier, else its own index
    first = own.where(F.col("term") != OWN_ID).groupBy(INDEX).agg(F.min_by("identifier", F.struct(order.alias("o"), "pos", "identifier")).alias("first"))
    rows = e.select(INDEX).join(found, INDEX, "left").join(first, INDEX, "left")
    what = F.lit(resource_name)
    if NAME in heads:
        rows = rows.join(field(NAME).groupBy(INDEX).agg(F.max_by("raw", "pos").alias("_named")), INDEX, "left")
        what = F.when(F.col("_named").isNull(), what).otherwise(metadata.normalize_resource_name(F.col("_named")))
    rows = rows.withColumns({"resource_name": what, "key": F.coalesce(F.concat(F.lit("="), "first"), F.concat(F.lit("#"), F.col(INDEX).cast("string")))})
    rows = cut(rows.select(INDEX, "id", "conflict", "first", "resource_name", "key"))

    creates = action == "create" or (action != "delete" and unidentified == "create")
    start = _top(resources, media, rows) + 1
    unknown = rows.where("id is null") if creates else rows.where("false")
    new = ids.allocate_ids(unknown.groupBy("key").agg(F.min(INDEX).alias("_i"), F.max_by("resource_name", INDEX).alias("name")), ["key"], start, "made")
    rows = cut(rows.join(new.select("key", "made"), "key", "left").withColumn("resource_id", F.coalesce("id", F.when(F.col("id").isNull(), F.col("made")))).drop("made"))

    # what links may go to: entries of this table, the last of several, before stored resources
    stored = v.where(F.col("term").isin([t for t in identifier_terms if t != OWN_ID])).select(F.coalesce(F.nullif("uri", F.lit("")), "value").alias("identifier"), F.col("resource_id").alias("id")).join(resources.select("id", "resource_name"), "id").where("identifier <> ''")
    here = own.where(F.col("term") != OWN_ID).join(rows.where("resource_id is not null").select(INDEX, "resource_id", "resource_name"), INDEX)
    here = here.groupBy("identifier").agg(F.max_by(F.struct(F.col("resource_id").alias("id"), "resource_name"), INDEX).alias("k")).select("identifier", "k.id", "k.resource_name", F.lit(0).alias("p"))
    stored = stored.groupBy("identifier").agg(F.min(F.struct("id", "resource_name")).alias("k")).select("identifier", "k.id", "k.resource_name", F.lit(1).alias("p"))
    names = here.union(stored).groupBy("identifier").agg(F.min(F.struct("p", "id", "resource_name")).alias("k"))
    names = cut(names.select("identifier", "k.id", "k.resource_name"))

    place = F.array_position(F.array(*map(F.lit, columns)), F.col("field")) if columns else F.lit(0)
    properties = m.where(~F.col("term").startswith("o:")).withColumn("_field", place)
    chosen, typed = checks.choose_datatype(properties, names, vocab, literal_fallback)
    to = lambda x, name: x.join(names.where(F.col("resource_name") == name).select(F.col("identifier").alias("raw"), F.col("id").alias("to")), "raw", "left")
    several = rows.where("conflict").select(INDEX, F.lit("err").alias("severity"), F.lit("the identifiers are of several resources").alias("message"))
    messages = checks.check_resources(rows, action, unidentified).union(several).union(typed)
    sets = own_media = None
    if ITEM_SET in heads:
        sets = cut(to(field(ITEM_SET), "item_sets"))
        messages = messages.union(_message(sets.where("to is null"), "err", "unknown item set: "))
    if NAME in heads or resource_name == "media":
        parents = to(field(ITEM), "items").groupBy(INDEX).agg(F.min("to").alias("item_id"))
        own_media = rows.where("resource_name = 'media'").join(parents, INDEX, "left").join(media.select("id", F.col("item_id").alias("_old")), "id", "left")
        own_media = cut(own_media.withColumn("item_id", F.coalesce("item_id", "_old")).drop("_old"))
        messages = messages.union(checks.check_media(own_media, action))
    messages = cut(messages)
    # an entry that is skipped has a warning, and no id
    kept = cut(checks.stop_policy(rows, messages, mode).where("resource_id is not null"))

    known = kept.select(INDEX, "resource_id")
    if action == "delete":
        after, values, left = merge.delete_resources(resources, v, media, known.select(F.col("resource_id").alias("id")).distinct())
        gone = resources.select("id").join(after.select("id"), "id", "left_anti")
        links = item_sets.join(gone, item_sets["item_id"] == gone["id"], "left_anti").join(gone, F.col("item_set_id") == gone["id"], "left_anti")
        return Import(cut(values.select(*v.columns)), cut(after), messages, merge.record_import(resources.select("id", "resource_name").where("false"), job_id), cut(left), cut(links))

    created = new.join(kept.select("key").distinct(), "key", "left_semi").select(F.col("made").alias("id"), F.col("name").alias("resource_name"))
    # links to new entries that are not imported
    lost = new.join(created.select(F.col("id").alias("made")), "made", "left_anti").select(F.col("made").alias("target_id"))
    dangling = chosen.join(lost, "target_id", "left_semi").join(known, INDEX, "left_semi")
    messages = cut(messages.union(_message(dangling, "warn", "the linked entry is not imported: ")))
    chosen = chosen.join(lost, "target_id", "left_anti").join(known, INDEX).select(INDEX, "_field", "pos", "resource_id", "term", "type", "raw", "target_id", "lang", "is_public")
    incoming = metadata.fill_values(ids.allocate_ids(chosen, [INDEX, "_field", "pos", "term"], _top(v) + 1))
    terms = sorted(t for t in heads if not t.startswith("o:"))
    touched = cut(known.select("resource_id").distinct())
    # written, so that a sequence of imports doesn't work out all earlier ones again
    values = cut(merge.upsert(v, incoming, "append" if action == "create" else action, terms, touched))

    add = lambda df: df.select(*(c for c in df.columns if c in media.columns))
    if own_media is not None:
        of_entries = own_media.join(kept.select(INDEX), INDEX, "left_semi").where("item_id is not null")
        moved = of_entries.where("id is not null").groupBy("id").agg(F.max_by("item_id", INDEX).alias("_to"))
        new_media = of_entries.where("id is null").groupBy(F.col("resource_id").alias("id")).agg(F.max_by("item_id", INDEX).alias("item_id"))
        media = media.join(moved, "id", "left").withColumn("item_id", F.coalesce("_to", "item_id")).select(*media.columns)
        media = cut(media.unionByName(add(new_media), allowMissingColumns=True))
    lost_media = None
    if MEDIA in heads:
        sent = kept.where("resource_name = 'items'").select(INDEX, F.col("resource_id").alias("item_id")).join(field(MEDIA), INDEX)
        sent = sent.withColumn("_m", metadata.media_source(F.col("raw"))).where("_m is not null").groupBy("item_id", "_m.ingester", "_m.source").agg(F.min(F.struct(INDEX, "pos")).alias("_at"))
        sent = cut(identifiers.match_item_media(sent, media))
        fresh = sent.where("id is null").drop("id").withColumns({"_i": F.col("_at")[INDEX], "_p": F.col("_at.pos")}).drop("_at")
        fresh = ids.allocate_ids(fresh, ["_i", "_p", "item_id", "ingester", "source"], _top(created, resources, media) + 1)
        if action in ("update", "replace"):
            # the media that are given are all that the item has from now on; without any, update and replace of media leave them
            lost_media = cut(media.join(sent.select("item_id").distinct(), "item_id", "left_semi").join(sent.where("id is not null").select("id"), "id", "left_anti").select("id"))
        media = cut(media.unionByName(add(fresh.select("id", "item_id", "ingester", "source")), allowMissingColumns=True))
        created = cut(created.union(fresh.select("id", F.lit("media"))))
    if sets is not None:
        links = sets.where("to is not null").join(kept.where("resource_name = 'items'").select(INDEX, F.col("resource_id").alias("item_id")), INDEX).select("item_id", F.col("to").alias("item_set_id")).distinct()
        links = links.join(lost.select(F.col("target_id").alias("item_set_id")), "item_set_id", "left_anti").select("item_id", "item_set_id")
        item_sets = cut(merge.keep_links(item_sets.select("item_id", "item_set_id"), links, "update" if action in ("update", "replace") else "append"))
    after = resources.unionByName(created, allowMissingColumns=True)
    if heads & set(FIELDS) or action == "replace":
        cells = m.where(F.col("term").isin(list(FIELDS))).join(known, INDEX)
        after = _with_fields(after, cells, sorted(heads & set(FIELDS)), touched, action)
    after = cut(after)
    if lost_media is not None:
        after, values, media = (cut(t) for t in merge.delete_resources(after, values, media, lost_media))
    return Import(values, after, messages, merge.record_import(created, job_id), media, item_sets)
