"""Queries over the driver's tables: they are melted into an EAV table, which every query rewrites, resolves, merges or compares.

The melt and each query's DuckDB twin are SQL; ids are made by arithmetic, so both engines make the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import entries, hierarchy, identifiers, ids, merge, patterns, sources, text, transform, values

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _arm(rid: str, k: int, term: str, value: str, source: str) -> str:
    return f"select cast({rid} as bigint)*10+{k} as id, cast({rid} as bigint) as resource_id, '{term}' as term, 'literal' as type, {value} as value, cast(null as string) as uri, cast(null as bigint) as value_resource_id, cast(null as string) as lang, true as is_public from {source}"


VALUES = " union all ".join((
    _arm("c_custkey", 1, "dcterms:identifier", "c_name", "{customer}"),
    _arm("c_custkey", 2, "dcterms:subject", "c_mktsegment", "{customer}"),
    _arm("c_custkey", 3, "dcterms:spatial", "n_name", "{customer} join {nation} on c_nationkey = n_nationkey"),
    _arm("100000000+s_suppkey", 1, "dcterms:identifier", "s_name", "{supplier}"),
    _arm("200000000+p_partkey", 1, "dcterms:title", "p_name", "{part}"),
    _arm("200000000+p_partkey", 2, "dcterms:type", "p_type", "{part}"),
    _arm("200000000+p_partkey", 3, "dcterms:publisher", "p_brand", "{part}"),
    _arm("300000000+o_orderkey", 1, "dcterms:creator", "c_name", "{orders} join {customer} on o_custkey = c_custkey"),
    _arm("300000000+o_orderkey", 2, "dcterms:status", "o_orderstatus", "{orders}"),
    _arm("400000000+n_nationkey", 1, "dcterms:identifier", "n_name", "{nation}"),
))
RESOURCES = (
    "select c_custkey as id, 'items' as resource_name, c_name as title from {customer} union all select 100000000+s_suppkey, 'items', s_name from {supplier} "
    "union all select 200000000+p_partkey, 'items', p_name from {part} union all select 300000000+o_orderkey, 'items', cast(null as string) from {orders} "
    "union all select 400000000+n_nationkey, 'item_sets', n_name from {nation}"
)
#: An incoming batch: every customer, most with another subject, an old identifier, and no spatial value.
INCOMING = " union all ".join((
    _arm("c_custkey", 5, "dcterms:subject", "case when c_custkey % 20 = 0 then c_mktsegment else concat('NEW ', c_mktsegment) end", "{customer}"),
    _arm("c_custkey", 6, "dcterms:identifier", "c_name", "{customer}"),
))
MEDIA = "select 900000000000+l_orderkey*10+l_linenumber as id, 300000000+l_orderkey as item_id, l_linenumber as position, 'sideload' as ingester, concat('f', l_partkey) as source, concat('p', l_partkey, '/s', l_suppkey) as storage_id, 'jpg' as extension from {lineitem}"
MAPPER = "select distinct p_type as source, 'dcterms:format' as term, 'uri' as type, concat('label ', p_type) as value, concat('http://x/', p_type) as uri, cast(null as bigint) as value_resource_id, cast(null as string) as lang, true as is_public from {part} where p_type like 'E%' or p_type like 'S%'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FULL = ("resource_id", "term", "type", "value", "uri", "value_resource_id", "lang", "is_public")
COLS = ", ".join(FULL)


class Data:
    """The melted tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def sql(self, query: str) -> DataFrame:
        used = {t: self.spark.read.parquet(f"{self.dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in query}
        return self.spark.sql(query, **used)

    v = property(lambda self: self.sql(VALUES))
    r = property(lambda self: self.sql(RESOURCES))
    new = property(lambda self: self.sql(INCOMING))
    media = property(lambda self: self.sql(MEDIA))
    mapper = property(lambda self: self.sql(MAPPER))


def query(oracle: str | None):
    """Register a function of Data as a query, with its twin over the views v, r, new, media and mapper."""

    def add(f: Callable[[Data], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Data(spark, sf_dir))
        if oracle:
            plain = {t: t for t in TABLES}
            views = {"v": VALUES, "r": RESOURCES, "new": INCOMING, "media": MEDIA, "mapper": MAPPER}
            ORACLES[f.__name__] = "with " + ", ".join(f"{k} as ({q.format(**plain)})" for k, q in views.items()) + oracle.strip().removeprefix("with").join((", " if oracle.strip().startswith("with") else " ", ""))
        return f

    return add


def _full(df: DataFrame) -> DataFrame:
    return df.select(*FULL)


@query("select term, count(*) as n, count(distinct value) as texts from v where (type = 'literal' or type = '' or type is null) and value <> '' group by term")
def literal_values(d):
    return values.literal_values(d.v).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("texts"))


@query(f"select {COLS} from v where type in ('literal')")
def datatype_filter(d):
    return _full(values.datatype_filter(d.v, ["literal"]))


@query(f"select {COLS} from v where lower(value) not in (select lower(p_type) from part where p_size < 10)")
def exclude_list(d):
    return _full(values.exclude_list(d.v, d.sql("select p_type as value from {part} where p_size < 10"), match="ci"))


@query(f"select {COLS} from (select * from v union all select * from v where id % 3 = 0) group by {COLS}")
def dedup_values(d):
    return _full(values.dedup_values(d.v.union(d.v.where("id % 3 = 0"))))


@query("select resource_id, term, row_number() over (partition by resource_id order by case term when 'dcterms:type' then 1 when 'dcterms:title' then 2 end nulls last, id) as position from v where resource_id between 200000000 and 299999999")
def reorder_values(d):
    order = d.spark.createDataFrame([("dcterms:type", 1), ("dcterms:title", 2)], "term string, position int")
    return values.reorder_values(d.v.where("resource_id between 200000000 and 299999999"), order).select("resource_id", "term", F.col("position").cast("long").alias("position"))


@query(f"select {COLS} from v where value in (select distinct p_type from part where p_size > 20)")
def vocab_member(d):
    return _full(values.vocab_member(d.v, d.sql("select p_type as term_value from {part} where p_size > 20")))


@query("select cast(id as varchar) as identifier, id from r where resource_name = 'items'")
def find_by_id(d):
    return identifiers.find_by_id(d.r.select(F.col("id").cast("string").alias("identifier")), d.r, "items")


@query("select value as identifier, min(resource_id) as id, count(distinct resource_id) as count from v where term in ('dcterms:title','dcterms:identifier') and value in (select p_name from part union all select s_name from supplier) group by value")
def find_by_value(d):
    wanted = d.sql("select p_name as identifier from {part} union all select s_name from {supplier}")
    return identifiers.find_by_value(wanted, d.v, ["dcterms:title", "dcterms:identifier"])


@query("select source as identifier, min(id) as id, count(distinct id) as count from media where ingester = 'sideload' group by source")
def find_by_media(d):
    return identifiers.find_by_media(d.media.select(F.col("source").alias("identifier")), d.media, "source", "sideload")


@query("select regexp_replace(concat(storage_id, '.', extension), '^.*/', '') as identifier, min(id) as id, count(distinct id) as count from media group by 1")
def find_by_filename(d):
    return identifiers.find_by_filename(d.sql("select distinct concat('s', l_suppkey, '.jpg') as identifier from {lineitem}"), d.media, basename=True)


@query("with w as (select case when p_partkey % 2 = 0 then p_name else upper(p_name) end as identifier from part), c as (select value, min(resource_id) as id from v where term = 'dcterms:title' group by value) select distinct w.identifier, coalesce(e.id, f.id) as id from w left join c e on e.value = w.identifier left join (select lower(value) as k, min(id) as id from c group by 1) f on f.k = lower(w.identifier)")
def resolve_case(d):
    wanted = d.sql("select case when p_partkey % 2 = 0 then p_name else upper(p_name) end as identifier from {part}")
    return identifiers.resolve_case(wanted, d.v.where("term = 'dcterms:title'").select(F.col("value").alias("identifier"), F.col("resource_id").alias("id")))


@query("select value as identifier, 'err' as severity from v where term = 'dcterms:title' group by value having count(distinct resource_id) > 1")
def duplicate_identifiers(d):
    titles = d.v.where("term = 'dcterms:title'").select(F.col("value").alias("identifier"))
    return identifiers.duplicate_identifiers(identifiers.find_by_value(titles, d.v, ["dcterms:title"]))


@query("with a as (select o_orderkey as source_index, c_custkey as id from orders join customer on o_custkey = c_custkey) select source_index, id, false as conflict from a")
def first_match_per_resource(d):
    rows = d.sql("select o_orderkey as source_index, 'dcterms:identifier' as term, c_name as identifier from {orders} join {customer} on o_custkey = c_custkey")
    return identifiers.first_match_per_resource(rows, d.v, ["dcterms:title", "dcterms:identifier"])


@query("select m.item_id, m.source, e.id from media m join (select item_id, source, min(id) as id from media group by 1, 2) e on m.item_id = e.item_id and m.source = e.source")
def match_item_media(d):
    return identifiers.match_item_media(d.media.drop("id"), d.media).select("item_id", "source", "id")


@query("select i.resource_id as item_id, s.resource_id as item_set_id from v i join v s on lower(i.value) = lower(s.value) where i.term = 'dcterms:spatial' and s.term = 'dcterms:identifier' and s.resource_id >= 400000000")
def attach_item_set(d):
    links = d.spark.createDataFrame([], "item_id long, item_set_id long")
    return transform.attach_item_set(d.v, d.r.where("resource_name = 'item_sets'"), links, "dcterms:spatial", "dcterms:identifier", match="ci")


_LINKS = "l as (select o.id as vid, o.resource_id as a, c.resource_id as b from v o join v c on lower(o.value) = lower(c.value) where o.term = 'dcterms:creator' and c.term = 'dcterms:identifier')"
_LINK = "'resource:item' as type, cast(null as varchar) as value, cast(null as varchar) as uri, {} as value_resource_id, cast(null as varchar) as lang, true as is_public"


@query(f"with {_LINKS} select {COLS} from v where id not in (select vid from l) union all select a, 'dcterms:creator', {_LINK.format('b')} from l union all select b, 'foaf:made', {_LINK.format('a')} from l")
def link_resource(d):
    return _full(transform.link_resource(d.v, "dcterms:creator", "dcterms:identifier", reciprocal="foaf:made", match="ci"))


@query("with l as (select o_orderkey, c_custkey, n_name from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey) select n_name as nation, count(*) as links from l group by n_name")
def link_resource_by_nation(d):
    return links_by_nation(d.spark, d.dir)


@query(f"with {_LINKS}, x as (select {COLS} from v where id not in (select vid from l) union all select a, 'dcterms:creator', {_LINK.format('b')} from l) select {COLS} from x union all select distinct x.value_resource_id, y.term, y.type, y.value, y.uri, y.value_resource_id, y.lang, y.is_public from x join x y on x.resource_id = y.resource_id where x.term = 'dcterms:creator' and y.term = 'dcterms:status' and x.value_resource_id is not null")
def copy_value_linked(d):
    steps = [{"action": "link_resource", "params": {"source": "dcterms:creator", "identifier": "dcterms:identifier", "match": "ci"}}, {"action": "copy_value_linked", "params": {"source": "dcterms:creator", "terms": ["dcterms:status"]}}]
    return _full(transform.transform_pipeline(d.v, steps))


@query(f"select {COLS} from v where term not in ('dcterms:status', 'dcterms:type')")
def remove_value(d):
    return _full(transform.remove_value(d.v, ["dcterms:status", "dcterms:type"]))


@query("select resource_id, case when term = 'dcterms:publisher' then 'dcterms:source' else term end as term, type, case when term = 'dcterms:publisher' then concat('[', value, ']') else value end as value, case when term = 'dcterms:publisher' then concat('http://x/', value) else uri end as uri, value_resource_id, case when term = 'dcterms:publisher' then 'en' else lang end as lang, is_public from v")
def modify_value(d):
    return _full(transform.modify_value(d.v, "dcterms:publisher", "dcterms:source", prefix="[", suffix="]", uri_prefix="http://x/", lang="en"))


@query(f"select resource_id, case when term = 'dcterms:type' and instr(value, ' ') > 0 then 'b' else term end as term, type, case when term = 'dcterms:type' and instr(value, ' ') > 0 then trim(substr(value, instr(value, ' ') + 1)) else value end as value, uri, value_resource_id, lang, is_public from v union all select resource_id, 'a', type, trim(split_part(value, ' ', 1)), uri, value_resource_id, lang, is_public from v where term = 'dcterms:type' and instr(value, ' ') > 0")
def cut_value(d):
    return _full(transform.cut_value(d.v, "dcterms:type", " ", "a", "b"))


@query(f"select {COLS} from v union all select id, 'dcterms:license', 'literal', 'Public domain', null, null, 'en', true from r where resource_name = 'item_sets'")
def append_raw_value(d):
    return _full(transform.append_raw_value(d.v, d.r.where("resource_name = 'item_sets'"), ["dcterms:license"], "Public domain", lang="en"))


@query("select v.resource_id, coalesce(m.term, v.term) as term, coalesce(m.type, v.type) as type, coalesce(m.value, v.value) as value, coalesce(m.uri, v.uri) as uri, v.value_resource_id, v.lang, v.is_public from v left join mapper m on v.term = 'dcterms:type' and lower(m.source) = lower(v.value)")
def replace_table_update(d):
    return _full(transform.replace_table_update(d.v, d.mapper, "dcterms:type", match="ci"))


@query(f"select {COLS} from v where not (term = 'dcterms:type' and value in (select source from mapper)) union all select distinct v.resource_id, m.term, m.type, m.value, m.uri, m.value_resource_id, m.lang, m.is_public from v join mapper m on v.term = 'dcterms:type' and m.source = v.value")
def replace_table_explode(d):
    return _full(transform.replace_table_explode(d.v, d.mapper, "dcterms:type", match="ci"))


@query(f"select {COLS} from v union all select distinct v.resource_id, m.term, m.type, m.value, m.uri, m.value_resource_id, m.lang, m.is_public from v join mapper m on v.term = 'dcterms:type' and m.source = v.value")
def insert_from_mapper(d):
    return _full(transform.insert_from_mapper(d.v, d.mapper, "dcterms:type", match="ci"))


@query("select distinct value as source, 'dcterms:relation' as term, type, value, uri, value_resource_id, lang, is_public from v where term = 'dcterms:publisher'")
def mapper_from_values(d):
    return transform.mapper_from_values(d.v, {"dcterms:publisher": "dcterms:relation"})


@query("select value as v, string_agg(cast(resource_id as varchar), ',' order by resource_id) as resource_ids from (select distinct value, resource_id from v where term in ('dcterms:publisher') and value <> '') group by value")
def list_values(d):
    return transform.list_values(d.v, ["dcterms:publisher"]).select("v", F.array_join(F.col("resource_ids").cast("array<string>"), ",").alias("resource_ids"))


@query("select v.resource_id, case when c.id is not null then 'dcterms:coverage' else v.term end as term, case when c.id is not null then 'resource:item' else v.type end as type, case when c.id is null then v.value end as value, v.uri, c.id as value_resource_id, v.lang, v.is_public from v left join r c on c.resource_name = 'item_sets' and v.term = 'dcterms:spatial' and c.title = v.value")
def link_created(d):
    return _full(transform.link_created(d.v, d.r.where("resource_name = 'item_sets'"), {"dcterms:spatial": "dcterms:coverage"}, match="ci"))


@query("select resource_id, term, value, uri from (select resource_id, case when term = 'dcterms:status' then 'bibo:status' else term end as term, case when term = 'dcterms:status' then concat('s:', value) else value end as value, uri from v where term <> 'dcterms:publisher')")
def transform_pipeline(d):
    steps = [{"action": "remove_value", "params": {"terms": ["dcterms:publisher"]}}, {"action": "modify_value", "params": {"source": "dcterms:status", "destination": "bibo:status", "prefix": "s:"}}]
    return transform.transform_pipeline(d.v, steps).select("resource_id", "term", "value", "uri")


@query(f"select {COLS} from (select * from v union all select * from new) group by {COLS}")
def merge_append(d):
    return _full(merge.merge_append(d.v, d.new))


@query(f"select {COLS} from v where not exists (select 1 from new n where n.resource_id = v.resource_id and n.term = v.term) union all select {COLS} from new")
def merge_revise(d):
    return _full(merge.merge_revise(d.v, d.new))


@query(f"select {COLS} from v where not exists (select 1 from new n where n.resource_id = v.resource_id and (n.term = v.term or v.term = 'dcterms:spatial')) union all select {COLS} from new")
def merge_update(d):
    return _full(merge.merge_update(d.v, d.new, d.new.select("resource_id"), ["dcterms:subject", "dcterms:spatial"]))


@query(f"select {COLS} from v where resource_id not in (select resource_id from new) union all select {COLS} from new")
def merge_replace(d):
    return _full(merge.merge_replace(d.v, d.new))


@query(f"select {COLS} from v where not (term = 'dcterms:subject' and resource_id in (select resource_id from new))")
def delete_values(d):
    return _full(merge.delete_values(d.v, d.new, ["dcterms:subject"]))


@query("select id from media where item_id % 5 <> 0")
def delete_resources(d):
    return merge.delete_resources(d.r, d.v, d.media, d.r.where("id % 5 = 0"))[2].select("id")


@query("with a as (select resource_id, term, value, count(*) filter (s = 1) as x, count(*) filter (s = 2) as y from (select *, 1 as s from v union all select *, 2 as s from new) group by 1, 2, 3), b as (select term, '=' as diff, least(x, y) as n from a union all select term, '-', x - least(x, y) from a union all select term, '+', y - least(x, y) from a) select term, diff, cast(sum(n) as bigint) as n from b where n > 0 group by term, diff")
def diff_resources(d):
    return merge.diff_summary(merge.diff_resources(d.v, d.new))


@query("select distinct term, value from new where term = 'dcterms:subject' and value not in (select value from v where term = 'dcterms:subject')")
def new_values(d):
    return merge.new_values(d.new, d.v, ["dcterms:subject"])


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag) + 99 as new_id from lineitem")
def allocate_ids(d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return ids.allocate_ids(d.sql("select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag from {lineitem}"), [*keys, "l_returnflag"], 100, "new_id")


@query("select id from r where id in (select resource_id from new)")
def conflict_ids(d):
    return ids.conflict_ids(d.r, d.new.select(F.col("resource_id").alias("id")))


@query("select event_id, case when c_custkey is null then null else 1000000 + c_custkey end as user_id from events left join customer on user_id = c_custkey and c_custkey % 2 = 0")
def remap_ids(d):
    m = d.sql("select 'users' as entity, cast(c_custkey as string) as source_id, 1000000 + c_custkey as dest_id from {customer} where c_custkey % 2 = 0")
    return ids.remap_ids(d.sql("select event_id, user_id from {events}"), {"user_id": "users"}, m)


@query("select id, title, title is distinct from null as changed from (select id, (select min(value) from v where v.resource_id = r.id and term = 'dcterms:title') as title from r)")
def resource_titles(d):
    return hierarchy.resource_titles(d.r.withColumn("title", F.lit(None).cast("string")), d.v)


@query("select c_custkey as id, case when c_custkey not between 1 and 3 then 'N' || (c_custkey - c_custkey % 4) end as title, c_custkey not between 1 and 3 as changed from customer")
def linked_titles(d):
    """Each customer is titled by the one before it, up to three hops to one with a text; the first three form a cycle."""
    r = d.sql("select c_custkey as id, cast(null as string) as title from {customer}")
    v = d.sql("select c_custkey as id, c_custkey as resource_id, 'dcterms:title' as term, if(c_custkey % 4 = 0, concat('N', c_custkey), null) as value, cast(null as string) as uri, case when c_custkey % 4 = 0 then null when c_custkey = 1 then 3 else c_custkey - 1 end as value_resource_id from {customer}")
    return hierarchy.resource_titles(r, v)


@query("with e as (select 'c' || c_custkey as id, 'n' || c_nationkey as p from customer union all select 'n' || n_nationkey, 'r' || n_regionkey from nation) select id, p as ancestor_id, 1 as depth from e union all select a.id, b.p, 2 from e a join e b on a.p = b.id")
def ancestors(d):
    return hierarchy.ancestors(d.sql("select concat('c', c_custkey) as id, concat('n', c_nationkey) as parent_id from {customer} union all select concat('n', n_nationkey), concat('r', n_regionkey) from {nation}"))


@query("select n_regionkey as parent_id, n_nationkey as id, row_number() over (partition by n_regionkey order by lower(n_name), n_nationkey) as position from nation")
def thesaurus_structure(d):
    concept = d.sql("select n_nationkey as id, n_regionkey as parent_id, n_name as label from {nation}")
    return hierarchy.thesaurus_structure(concept, "alpha")[1].select("parent_id", "id", F.col("position").cast("long").alias("position"))


@query("select p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) as capitalized, substr(p_name, 3, 4) as sliced, left(p_type, 1) as first, right(p_type, 1) as last, p_name || '-' || p_brand as joined, replace(replace(p_brand, '#', '%23'), ' ', '%20') as encoded, case p_type when 'ECONOMY' then 'cheap' else p_type end as label from part")
def pattern_filters(d):
    c = F.col
    return d.sql("select * from {part}").select("p_partkey", patterns.capitalize(c("p_name")).alias("capitalized"), patterns.slice(c("p_name"), 2, 4).alias("sliced"), patterns.first(c("p_type")).alias("first"), patterns.last(c("p_type")).alias("last"), patterns.implodev("-", c("p_name"), F.lit(""), c("p_brand")).alias("joined"), patterns.url_encode(c("p_brand")).alias("encoded"), patterns.table(c("p_type"), {"ECONOMY": "cheap"}).alias("label"))


@query("""select p_partkey, cast(p_size as varchar) as absolute, array_to_string(list_transform(string_split(lower(p_name), ' '), lambda x: upper(x[1]) || x[2:]), ' ') as titled, string_split(p_name, ' ')[1] as piece, p_brand || '/' || p_type as formatted,
    '&lt;b&gt;' || p_name || '&lt;/b&gt;' as escaped, p_name as stripped, 'x : ' || p_name as indexed, substr(lpad(cast(p_partkey as varchar), 6, '0'), 1, 2) || '°' || substr(lpad(cast(p_partkey as varchar), 6, '0'), 3, 2) || '’' || substr(lpad(cast(p_partkey as varchar), 6, '0'), 5, 2) || '”' as hexa, cast(length(p_name) as int) as n, p_name as trimmed, upper(p_name[1]) || lower(p_name[2:]) as cleaned from part""")
def more_filters(d):
    c = F.col
    tagged = F.concat(F.lit("<b>"), c("p_name"), F.lit("</b>"))
    spaced = F.concat(F.lit(" \n"), F.replace(F.upper("p_name"), F.lit(" "), F.lit("  ")), F.lit(" "))
    return d.sql("select * from {part}").select(
        "p_partkey", patterns.absolute(F.concat(F.lit("-"), c("p_size").cast("string"))).alias("absolute"), patterns.title(F.lower("p_name")).alias("titled"), F.get(patterns.split(c("p_name"), " ", 2), F.lit(0)).alias("piece"), patterns.format(F.lit("%s/%s"), c("p_brand"), c("p_type")).alias("formatted"),
        patterns.escape(tagged).alias("escaped"), patterns.striptags(tagged).alias("stripped"), patterns.unimarc_index(c("p_name"), "x").alias("indexed"), patterns.coordinates_hexa(F.lpad(c("p_partkey").cast("string"), 6, "0")).alias("hexa"), patterns.length(c("p_name")).alias("n"), patterns.trim(F.concat(F.lit("\t "), c("p_name"), F.lit(" "))).alias("trimmed"), text.clean_string(spaced, ["trim", "merge_space", "lowercase", "ucfirst"]).alias("cleaned"),
    )


@query("select p_partkey, p_name from part where p_type not in (select p_type from part where p_size < 10)")
def exclude_list_accents(d):
    """Texts compared without case, accents and trailing spaces, as they are by default."""
    v = d.sql("select p_partkey, p_name, p_type as value from {part}")
    return values.exclude_list(v, d.sql("select concat(replace(translate(p_type, 'AEO', 'ÁÈô'), 'I', 'i'), ' ') as value from {part} where p_size < 10")).select("p_partkey", "p_name")


@query("select p_partkey, unnest(string_split(p_name, ' ')) as word from part")
def split_keywords(d):
    return d.sql("select p_partkey, replace(p_name, ' ', ' ; ,') as k from {part}").select("p_partkey", F.explode(text.split_keywords(F.col("k"))).alias("word"))


PARTS = "select p_partkey as source_index, array(p_name) as name, array(concat(p_type, ' | ', p_brand, '||', p_type)) as kind, case when p_partkey % 3 = 0 then array(' ', '') else array(p_brand) end as brand from {part}"


@query("""select p_partkey as source_index, 0 as pos, 'dcterms:title' as term, 'literal' as type, 'en' as lang, true as is_public, p_name as raw from part
    union all select p_partkey, k.pos, t.term, 'literal', null, t.term <> 'dcterms:type', case k.pos when 0 then p_type else p_brand end from part, (values (0), (1)) k(pos), (values ('dcterms:subject'), ('dcterms:type')) t(term)""")
def melt_entries(d):
    e = entries.clean_entry(d.sql(PARTS).drop("brand"), "|")
    m = entries.melt(e, {"name": "dcterms:title ^^literal @en", "kind": "dcterms:subject ^^literal | dcterms:type §private"})
    return m.select("source_index", "pos", "term", F.element_at("types", 1).alias("type"), "lang", "is_public", "raw")


@query("select p_partkey as source_index, p_brand as brand from part where p_partkey % 3 <> 0")
def drop_empty_entries(d):
    e = entries.drop_empty_entries(entries.clean_entry(d.sql(PARTS).select("source_index", "brand")))
    return e.select("source_index", F.element_at("brand", 1).alias("brand"))


@query("select distinct k as key, p_name as value from (select p_name, unnest([p_brand, p_type, lower(p_brand), lower(p_type)]) as k from part)")
def read_keyvalue(d):
    return sources.read_keyvalue(d.sql("select p_name, p_brand, p_type from {part}"), "p_name", ["p_brand", "p_type"], lower=True)


def links_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creators of orders become links to customers; the links counted by the customers' nation."""
    d = Data(spark, sf_dir)
    linked = transform.link_resource(d.v, "dcterms:creator", "dcterms:identifier", match="ci").where("term = 'dcterms:creator' and value_resource_id is not null")
    nation = d.v.where("term = 'dcterms:spatial'").select(F.col("resource_id").alias("value_resource_id"), F.col("value").alias("nation"))
    return linked.join(nation, "value_resource_id").groupBy("nation").agg(F.count(F.lit(1)).alias("links"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES
