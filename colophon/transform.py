"""Rewriting values as sets. All functions take a value table and return the new one; links are keyed by folded text."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ids import allocate_ids
from .schema import PAYLOAD
from .store import cut, delete, scope, scratch
from .text import fold, split_uri_label, trim
from .values import is_literal

_NEW = ("resource_id", "term", *PAYLOAD)


def _scoped(v: DataFrame, scope: DataFrame | None) -> DataFrame:
    return v if scope is None else v.join(scope.select("id"), "id", "left_semi")


def _append(v: DataFrame, new: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """v and new rows, with ids above those of stored (v itself if not given) in the order of their resources, terms and payloads.

    The new rows are written once; a stored table is only read for its largest id.
    """
    top = (v if stored is None else stored).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return v.unionByName(allocate_ids(new.select(*_NEW), list(_NEW), top + 1).select("id", *_NEW))


def attach_item_set(v: DataFrame, item_set_ids: DataFrame, links: DataFrame, source: str, identifier: str, match: str = "ci_ai", scope: DataFrame | None = None) -> DataFrame:
    """links (item_id, item_set_id) and those of items whose text in source is an item set's identifier."""
    sets = v.where(F.col("term") == identifier).where(is_literal()).join(item_set_ids.select(F.col("id").alias("resource_id")), "resource_id", "left_semi").select(F.col("resource_id").alias("item_set_id"), fold(F.col("value"), match).alias("_k")).distinct()
    items = _scoped(v, scope).where(F.col("term") == source).where(is_literal()).select(F.col("resource_id").alias("item_id"), fold(F.col("value"), match).alias("_k")).distinct()
    return links.select("item_id", "item_set_id").union(items.join(sets, "_k").select("item_id", "item_set_id")).distinct()


def link_resource(v: DataFrame, source: str, identifier: str, destination: str | None = None, reciprocal: str | None = None, type: str = "resource:item", keep_source: bool = False, match: str = "ci_ai", scope: DataFrame | None = None) -> DataFrame:
    """Literals of source that are another resource's identifier become links, with links back if reciprocal names a term."""
    known = v.where(F.col("term") == identifier).where(is_literal()).select(F.col("resource_id").alias("target"), fold(F.col("value"), match).alias("_k")).distinct()
    columns, stored = v.columns, v
    on = (F.col("term") == source) & is_literal()
    if scope is not None:
        v, on = v.join(scope.select("id").distinct().withColumn("_in", F.lit(True)), "id", "left"), on & F.col("_in")
    # one join for the links and for what stays: a value without a match is one row of it
    x = v.withColumn("_k", F.when(on, fold(F.col("value"), match))).join(known, "_k", "left")
    null = lambda t: F.lit(None).cast(t)
    link = lambda a, b, term: F.struct(F.col(a).alias("resource_id"), F.lit(term).alias("term"), F.lit(type).alias("type"), null("string").alias("value"), null("string").alias("uri"), F.col(b).alias("value_resource_id"), null("string").alias("lang"), F.coalesce("is_public", F.lit(True)).alias("is_public"))
    links = [link("resource_id", "target", destination or source), *([link("target", "resource_id", reciprocal)] if reciprocal else [])]
    new = x.where("target is not null").select(F.explode(F.array(*links)).alias("_l")).select("_l.*").distinct()
    rest = v if keep_source else x.where("target is null")
    return _append(rest.select(*columns), new, stored)


def copy_value_linked(v: DataFrame, source: str, terms: list[str]) -> DataFrame:
    """The values of these terms are copied to the resources that their resource links to by source."""
    to = v.where((F.col("term") == source) & F.col("value_resource_id").isNotNull()).select("resource_id", F.col("value_resource_id").alias("to")).distinct()
    new = v.where(F.col("term").isin(terms)).join(to, "resource_id").select(F.col("to").alias("resource_id"), "term", *PAYLOAD).distinct()
    return _append(v, new)


def remove_value(v: DataFrame, terms: list[str], types: list[str] | None = None, new_only: DataFrame | None = None) -> DataFrame:
    """Without the values of these terms (and types), or only those of the resources in new_only."""
    gone = F.col("term").isin(terms)
    if types is not None:
        gone = gone & F.coalesce(F.col("type"), F.lit("")).isin(types)
    if new_only is None:
        return v.where(~gone)
    return v.where(~gone).union(v.where(gone).join(new_only.select(F.col("id").alias("resource_id")), "resource_id", "left_anti").select(*v.columns))


def modify_value(v: DataFrame, source: str, destination: str | None = None, value: str | None = None, prefix: str | None = None, suffix: str | None = None, uri_prefix: str | None = None, uri_suffix: str | None = None, lang: str | None = None, is_public: bool | None = None, types: list[str] | None = None) -> DataFrame:
    """Rename, set a constant or add to the text, make a uri of the text, set language or visibility; no shuffle."""
    on = F.col("term") == source
    if types is not None:
        on = on & F.coalesce(F.col("type"), F.lit("")).isin(types)
    new: dict[str, Column] = {}
    if prefix or suffix:
        new["value"] = F.concat(F.lit(prefix or ""), F.col("value"), F.lit(suffix or ""))
    elif value is not None:
        new["value"] = F.lit(value)
    if uri_prefix or uri_suffix:
        new["uri"] = F.concat(F.lit(uri_prefix or ""), F.col("value"), F.lit(uri_suffix or ""))
    if lang is not None:
        new["lang"] = F.lit(lang)
    if is_public is not None:
        new["is_public"] = F.lit(is_public)
    if destination is not None:
        new["term"] = F.lit(destination)
    return v.withColumns({c: F.when(on, x).otherwise(F.col(c)) for c, x in new.items()})


def cut_value(v: DataFrame, source: str, separator: str, dest1: str, dest2: str) -> DataFrame:
    """Literals with the separator: what stands after the first one stays as dest2, what stands before it is a new value of dest1."""
    at = F.locate(separator, F.col("value"))
    on = (F.col("term") == source) & is_literal() & (at > 0)
    before = v.where(on).select("resource_id", F.lit(dest1).alias("term"), "type", F.trim(F.substring_index("value", separator, 1)).alias("value"), "uri", "value_resource_id", "lang", "is_public")
    after = F.trim(F.substr(F.col("value"), at + len(separator)))
    return _append(v.withColumns({"term": F.when(on, F.lit(dest2)).otherwise(F.col("term")), "value": F.when(on, after).otherwise(F.col("value"))}), before, v)


def append_raw_value(v: DataFrame, resources: DataFrame, terms: list[str], value: str | None = None, uri: str | None = None, lang: str | None = None, type: str = "literal") -> DataFrame:
    """One constant value for each resource and term."""
    ids = resources.select(F.col("id").alias("resource_id")).distinct().withColumn("term", F.explode(F.array(*map(F.lit, terms))))
    t = lambda x: F.lit(x).cast("string")
    return _append(v, ids.select("resource_id", "term", F.lit(type).alias("type"), t(value).alias("value"), t(uri).alias("uri"), F.lit(None).cast("long").alias("value_resource_id"), t(lang).alias("lang"), F.lit(True).alias("is_public")))


def _mapped(v: DataFrame, mapper: DataFrame, source: str, join: str, match: str) -> DataFrame:
    """Values of source with the mapper's row (m_*), for rows that match."""
    m = mapper.select(fold(F.col("source"), match).alias("_k"), *(F.col(c).alias(f"m_{c}") for c in ("term", *PAYLOAD)))
    return v.where((F.col("term") == source) & (F.col(join) != "")).withColumn("_k", fold(F.col(join), match)).join(m, "_k").drop("_k")


def replace_table_update(v: DataFrame, mapper: DataFrame, source: str, join: str = "value", match: str = "ci_ai") -> DataFrame:
    """Values found in the mapper take its term, type and payload; of several rows the smallest (term, type, uri, value).

    The mapper has one row for each text before it is joined, so values are neither grouped nor told apart by their ids.
    """
    row = F.struct(*(F.col(c) for c in ("term", "type", "uri", "value", "value_resource_id", "lang", "is_public")))
    best = mapper.where(F.col("source").isNotNull()).groupBy(fold(F.col("source"), match).alias("_k")).agg(F.min(row).alias("_m"))
    x = v.withColumn("_k", F.when((F.col("term") == source) & (F.col(join) != ""), fold(F.col(join), match))).join(best, "_k", "left")
    take = lambda c: F.when(F.col("_m").isNotNull(), F.col(f"_m.{c}")).otherwise(F.col(c))
    return x.select(*(take(c).alias(c) if c in ("term", *PAYLOAD) else F.col(c) for c in v.columns))


def convert_datatype(v: DataFrame, source: str, datatype: str, mapping: DataFrame, match: str = "ci_ai") -> DataFrame:
    """Literals of source become values of a vocabulary's data type: the uri and label of mapping (source, uri, label), where a text has one uri.

    Only data types of suggested values can be reached from a text; numbers and others are refused.
    """
    if not datatype.startswith("valuesuggest"):
        raise ValueError(f"cannot convert texts into {datatype}")
    return replace_table_update(v, single_uri_mapper(mapping, [source]).withColumn("type", F.lit(datatype)), source, match=match)


def insert_from_mapper(v: DataFrame, mapper: DataFrame, source: str, join: str = "value", match: str = "ci_ai") -> DataFrame:
    """v and the mapped values of each match, once for each resource."""
    return _append(v, _mapped(v, mapper, source, join, match).select("resource_id", *(F.col(f"m_{c}").alias(c) for c in ("term", *PAYLOAD))).distinct())


def replace_table_explode(v: DataFrame, mapper: DataFrame, source: str, join: str = "value", match: str = "ci_ai") -> DataFrame:
    """As insert_from_mapper, without the values that matched."""
    m = mapper.select(fold(F.col("source"), match).alias("_k"), *(F.col(c).alias(f"m_{c}") for c in ("term", *PAYLOAD)), F.lit(True).alias("_hit"))
    x = v.withColumn("_k", F.when((F.col("term") == source) & (F.col(join) != ""), fold(F.col(join), match))).join(m, "_k", "left")
    new = x.where("_hit").select("resource_id", *(F.col(f"m_{c}").alias(c) for c in ("term", *PAYLOAD))).distinct()
    return _append(x.where("_hit is null").select(*v.columns), new, v)


def mapper_from_values(v: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """mapper rows of the distinct values of the mapped terms, renamed."""
    key = F.coalesce(F.nullif(F.col("uri"), F.lit("")), F.col("value"))
    new = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))[F.col("term")]
    return v.where(F.col("term").isin(list(mapping))).select(key.alias("source"), new.alias("term"), *PAYLOAD).distinct()


def value_resources(v: DataFrame, terms: list[str], types: list[str] | None = None, column: str = "value") -> DataFrame:
    """(v, resource_id): each distinct text with each resource that has it, a row each, so that a common text can be split among tasks."""
    x = v.where(F.col("term").isin(terms) & (F.col(column) != ""))
    if types is not None:
        x = x.where(F.coalesce(F.col("type"), F.lit("")).isin(types))
    return x.select(F.col(column).alias("v"), "resource_id").distinct()


def list_values(v: DataFrame, terms: list[str], types: list[str] | None = None, column: str = "value") -> DataFrame:
    """(v, resource_ids): each distinct text with the sorted ids of the resources that have it. A text's ids are one cell; where a text may
    be that of very many resources, value_resources gives them as rows."""
    each = value_resources(v, terms, types, column)
    return each.groupBy("v").agg(F.array_sort(F.collect_list("resource_id")).alias("resource_ids"))


def link_created(v: DataFrame, created: DataFrame, mapping: dict[str, str], reciprocal: str | None = None, type: str = "resource:item", match: str = "ci_ai") -> DataFrame:
    """Literals of the mapped terms that are a created resource's title (id, title) become links to it, of the mapped term."""
    c = created.groupBy(fold(F.col("title"), match).alias("_k")).agg(F.min("id").alias("_to"))
    x = v.withColumn("_k", F.when(F.col("term").isin(list(mapping)) & is_literal(), fold(F.col("value"), match))).join(c, "_k", "left").drop("_k")
    hit, null = F.col("_to").isNotNull(), lambda t: F.lit(None).cast(t)
    new = F.create_map(*(F.lit(s) for kv in mapping.items() for s in kv))[F.col("term")]
    x = x.withColumns({"term": F.when(hit, new).otherwise(F.col("term")), "type": F.when(hit, F.lit(type)).otherwise(F.col("type")), "value": F.when(hit, null("string")).otherwise(F.col("value")), "uri": F.when(hit, null("string")).otherwise(F.col("uri")), "lang": F.when(hit, null("string")).otherwise(F.col("lang")), "value_resource_id": F.coalesce("_to", "value_resource_id")})
    out = x.select(*v.columns)
    if reciprocal:
        back = x.where(hit).select(F.col("_to").alias("resource_id"), F.lit(reciprocal).alias("term"), "type", "value", "uri", F.col("resource_id").alias("value_resource_id"), "lang", "is_public").distinct()
        out = _append(out, back, v)
    return out


def single_uri_mapper(mapping: DataFrame, terms: list[str]) -> DataFrame:
    """mapper of the sources of mapping (source, uri, label) that have exactly one uri, a row for each term."""
    n = F.count(F.lit(1)).over(Window.partitionBy("source"))
    one = mapping.where("uri <> ''").select("source", "uri", "label").distinct().withColumn("_n", n).where("_n = 1")
    return one.select("source", F.explode(F.array(*map(F.lit, terms))).alias("term"), F.lit("uri").alias("type"), F.col("label").alias("value"), "uri", F.lit(None).cast("long").alias("value_resource_id"), F.lit(None).cast("string").alias("lang"), F.lit(True).alias("is_public"))


def build_mapper(table: DataFrame, source: str, columns: dict[str, dict], separator: str = "|", keep_source: str | None = None) -> DataFrame:
    """mapper rows of a wide sheet: for each column {term, and type, lang, is_public, prefix, suffix}, a row for each piece of its cell.

    Uris are split into uri and label, a link's text is a resource id; `{source}` and `{destination}` in prefix and suffix are the source
    and the piece. keep_source names a term that gets a private copy of the source.
    """
    rows = table.withColumn("_source", trim(F.col(source))).where("_source <> ''")

    def arm(c: str, s: dict) -> Column:
        kind = s.get("type", "literal")

        def one(x: Column) -> Column:
            fill = lambda t: F.replace(F.replace(F.lit(t), F.lit("{source}"), F.col("_source")), F.lit("{destination}"), x)
            text = F.concat(fill(s.get("prefix", "")), x, fill(s.get("suffix", "")))
            uri, label = split_uri_label(text)
            is_uri, link = kind == "uri" or kind.startswith("valuesuggest"), kind.startswith("resource")
            null = F.lit(None).cast("string")
            return F.struct(F.lit(s["term"]).alias("term"), F.lit(kind).alias("type"), (null if link else F.nullif(label, F.lit("")) if is_uri else text).alias("value"), (uri if is_uri else null).alias("uri"), (text.try_cast("long") if link else F.lit(None).cast("long")).alias("value_resource_id"), F.lit(s.get("lang")).cast("string").alias("lang"), F.lit(s.get("is_public", True)).alias("is_public"))

        pieces = F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), re.escape(separator)), trim), lambda x: x != "")
        return F.transform(pieces, one)

    arms = [arm(c, s) for c, s in columns.items()]
    if keep_source:
        null = F.lit(None).cast("string")
        arms.append(F.array(F.struct(F.lit(keep_source).alias("term"), F.lit("literal").alias("type"), F.col("_source").alias("value"), null.alias("uri"), F.lit(None).cast("long").alias("value_resource_id"), null.alias("lang"), F.lit(False).alias("is_public"))))
    out = rows.select(F.col("_source").alias("source"), F.explode(F.concat(*arms)).alias("_m")).select("source", "_m.*")
    return out.where("type not like 'resource%' or value_resource_id is not null").distinct()


def create_resources(mapper: DataFrame, start: int, resource_name: str = "items", class_: str | None = None, template: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(resources (id, resource_name, title, class, template), values): a resource for each distinct source, ids from start in its order."""
    new = allocate_ids(mapper.select("source").where("source <> ''").distinct(), ["source"], start)
    text = lambda x: F.lit(x).cast("string")
    made = new.select("id", text(resource_name).alias("resource_name"), F.col("source").alias("title"), text(class_).alias("class"), text(template).alias("template"))
    return made, mapper.join(new, "source").select(F.col("id").alias("resource_id"), "term", *PAYLOAD).distinct()


def merge_source_uris(table: DataFrame, uri_prefix: str = "") -> DataFrame:
    """(source, uri, label, items) of candidates (source, uri, label, items: an array): each (source, uri) once, with the smallest label and
    all items. Without a uri a source stays only if it has none; a candidate whose label is the source goes alone if it is the only such."""
    full = F.when(F.coalesce("uri", F.lit("")) != "", F.when(F.col("uri").startswith(uri_prefix), F.col("uri")).otherwise(F.concat(F.lit(uri_prefix), "uri"))).otherwise("")
    each = table.select("source", full.alias("uri"), "label", F.explode_outer("items").alias("_i"))
    one = each.groupBy("source", "uri").agg(F.min("label").alias("label"), F.array_sort(F.collect_set("_i")).alias("_own"))
    items = each.groupBy("source").agg(F.array_sort(F.collect_set("_i")).alias("items"))
    w = Window.partitionBy("source")
    exact = (F.col("uri") != "") & F.coalesce(F.col("label") == F.col("source"), F.lit(False))
    x = one.withColumns({"_any": F.max(F.col("uri") != "").over(w), "_exact": F.sum(exact.cast("int")).over(w)})
    x = x.where(((F.col("uri") != "") | ~F.col("_any")) & ((F.col("_exact") != 1) | exact))
    return x.join(items, "source").select("source", "uri", "label", "items")


def update_class_template(resources: DataFrame, v: DataFrame, term: str, by_type: DataFrame) -> DataFrame:
    """resources with the class and template that by_type (type, class, template) gives the data type of their first value of the term."""
    m = by_type.groupBy(F.col("type").alias("_type")).agg(F.min(F.struct("class", "template")).alias("_m"))
    hit = v.where(F.col("term") == term).groupBy(F.col("resource_id").alias("id")).agg(F.min_by("type", F.struct(F.col("id").isNull().alias("n"), "id", "type")).alias("_type")).join(m, "_type").drop("_type")
    return resources.join(hit, "id", "left").withColumns({c: F.coalesce(F.col(f"_m.{c}"), F.col(c)) for c in ("class", "template")}).select(*resources.columns)


def fill_from_authority(v: DataFrame, authority: DataFrame, source: str, columns: dict[str, dict]) -> DataFrame:
    """v and literals, or uris, that an authority table (uri, columns) has for the uris of source: for each column {term, and type, codes
    (code to text), prefix (before a uri)}."""
    uris = v.where((F.col("term") == source) & (F.col("uri") != "")).select("resource_id", "uri").distinct()

    def arm(c: str, s: dict) -> Column:
        x = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        if s.get("codes"):
            x = F.coalesce(F.create_map(*(F.lit(t) for kv in s["codes"].items() for t in kv))[x], x)
        is_uri = s.get("type", "literal") == "uri"
        x = F.concat(F.lit(s.get("prefix", "")), x)
        null = F.lit(None).cast("string")
        return F.struct(F.lit(s["term"]).alias("term"), F.lit(s.get("type", "literal")).alias("type"), (null if is_uri else x).alias("value"), (x if is_uri else null).alias("uri"))

    found = uris.join(authority, "uri").select("resource_id", F.explode(F.array(*(arm(c, s) for c, s in columns.items()))).alias("_a")).select("resource_id", "_a.*")
    new = found.where("coalesce(value, uri) is not null").distinct()
    return _append(v, new.withColumns({"value_resource_id": F.lit(None).cast("long"), "lang": F.lit(None).cast("string"), "is_public": F.lit(True)}))


@dataclass
class State:
    """What a list of operations works on: values, resources, and the item sets of items (item_id, item_set_id)."""

    values: DataFrame
    resources: DataFrame
    item_sets: DataFrame


def create_resource(state: State, mapper: DataFrame | None = None, mapping: dict[str, str] | None = None, resource_name: str = "items", class_: str | None = None, template: str | None = None, link: dict[str, str] | None = None, reciprocal: str | None = None, match: str = "ci_ai") -> State:
    """A new resource for each source of the mapper, or for each distinct text of the mapped terms, titled by it, with its values.

    Ids follow the largest of the resources, in the order of sources. link (term to term) turns literals that are a title into links.
    """
    m = mapper_from_values(state.values, mapping) if mapper is None else mapper
    top = state.resources.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    made, new = create_resources(m, top + 1, resource_name, class_, template)
    v = _append(state.values, new)
    if link:
        v = link_created(v, made, link, reciprocal, f"resource:{'itemset' if resource_name == 'item_sets' else 'item'}", match)
    return replace(state, values=v, resources=state.resources.unionByName(made.select(*(c for c in made.columns if c in state.resources.columns)), allowMissingColumns=True))


def attach_items(state: State, source: str, identifier: str = "dcterms:identifier", match: str = "ci_ai") -> State:
    """Items join the item sets that one of their texts names, also sets that an earlier operation has made."""
    sets = state.resources.where("resource_name = 'item_sets'")
    return replace(state, item_sets=attach_item_set(state.values, sets, state.item_sets, source, identifier, match))


#: Operations on values alone; those that touch each row by itself; and those on the whole state.
OPERATIONS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (link_resource, copy_value_linked, remove_value, modify_value, cut_value, append_raw_value, replace_table_update, replace_table_explode, insert_from_mapper, link_created, fill_from_authority, convert_datatype)}
NARROW = ("remove_value", "modify_value")
STATE_OPERATIONS: dict[str, Callable[..., State]] = {"create_resource": create_resource, "attach_item_set": attach_items}


def transform_state(state: State, operations: list[dict]) -> State:
    """The operations {"action": name, "params": {...}} in order, each on all that those before it made; an unknown one stops before any is run.

    After every operation that moves rows the tables are written in the shared folder, and those of the step before deleted, so that a
    long list neither works anything out twice nor keeps more than two states on disk.
    """
    if unknown := [op["action"] for op in operations if op["action"] not in OPERATIONS | STATE_OPERATIONS]:
        raise ValueError(f"unknown action: {unknown[0]}")
    spark, last = state.values.sparkSession, []
    for op in operations:
        name, params = op["action"], op.get("params", {})
        if name in NARROW:
            state = replace(state, values=OPERATIONS[name](state.values, **params))
            continue
        paths = {c: scratch(spark) for c in ("values", "resources", "item_sets")}
        with scope(spark):
            new = STATE_OPERATIONS[name](state, **params) if name in STATE_OPERATIONS else replace(state, values=OPERATIONS[name](state.values, **params))
            changed = {c: cut(getattr(new, c), path) for c, path in paths.items() if getattr(new, c) is not getattr(state, c)}
        state = replace(state, **changed)
        for c, path in last:
            if c in changed:
                delete(spark, path)
        last = [x for x in last if x[0] not in changed] + [(c, paths[c]) for c in changed]
    return state


def transform_pipeline(v: DataFrame, operations: list[dict]) -> DataFrame:
    """As transform_state, on values alone."""
    if unknown := [op["action"] for op in operations if op["action"] not in OPERATIONS]:
        raise ValueError(f"unknown action: {unknown[0]}")
    return transform_state(State(v, v, v), operations).values
