"""More queries over the driver's tables: migration, mapping sheets, references, upserts and thesauri, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import hierarchy, identifiers, merge, migrate, pipeline, transform
from .demo import COLS, _full, query

ITEM_MAP = "select o_orderkey as source_id, 500000 + o_orderkey as dest_id from {orders} where o_orderkey % 3 <> 0"


@query("select o_orderkey as id, case when o_orderkey % 2 = 0 then o_custkey else 7 end as item_id from orders")
def create_subtype_rows(d):
    sub = d.sql("select o_orderkey as id, o_custkey as item_id from {orders} where o_orderkey % 2 = 0")
    return migrate.create_subtype_rows(d.sql("select o_orderkey as id, 'media' as resource_name from {orders}"), sub, "media", d.sql("select o_orderkey as id, 7 as item_id from {orders}"))


@query("select 'creator' as role, o_orderkey as source_id, c_name as family, n_name as given from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey union all select 'editor', l_orderkey * 10 + l_linenumber, c_name, n_name from lineitem join customer on l_suppkey = c_custkey join nation on n_nationkey = c_nationkey")
def dedup_entities(d):
    """Every row leads to the entity that has its own names."""
    t = lambda key, source, on: d.sql(f"select {key} as source_id, 1 as pos, concat(' ', c_name) as family, n_name as given from {source} join {{customer}} on {on} = c_custkey join {{nation}} on n_nationkey = c_nationkey")
    entity, m = migrate.dedup_entities({"creator": t("o_orderkey", "{orders}", "o_custkey"), "editor": t("l_orderkey * 10 + l_linenumber", "{lineitem}", "l_suppkey")}, ["family", "given"])
    return m.join(entity, "id").select("role", "source_id", "family", "given")


@query("select p_partkey as resource_id, 'dcterms:creator' as term, case when p_size % 2 = 0 then 'resource:item' else 'literal' end as type, case when p_size % 2 = 0 then null else p_type || ', ' || p_brand end as value, case when p_size % 2 = 0 then 9 end as value_resource_id from part")
def people_values(d):
    p = d.sql("select p_partkey as resource_id, 'creator' as role, 1 as pos, p_type as family, p_brand as given, if(p_size % 2 = 0, 9, null) as entity_id from {part}")
    return migrate.people_values(p, {"creator": "dcterms:creator"}, ["family", "given"], linked=True).select("resource_id", "term", "type", "value", F.col("value_resource_id").cast("int").alias("value_resource_id"))


@query("select l_orderkey as resource_id, 'dcterms:format' as term, 'literal' as type, l_returnflag as value, true as is_public, l_linenumber as pos from lineitem where l_linestatus = 'O'")
def child_table_values(d):
    return migrate.child_table_values(d.sql("select l_orderkey as k, l_linenumber as pos, if(l_linestatus = 'O', l_returnflag, ' ') as c from {lineitem}"), "k", "c", "dcterms:format")


@query("select resource_id, term, case when term = 'dcterms:spatial' and n_nationkey is not null then 'resource:item' else type end as type, case when term = 'dcterms:spatial' and n_nationkey is not null then null else value end as value, case when term = 'dcterms:spatial' then n_nationkey end as value_resource_id from v left join (select * from nation where n_regionkey < 3) on n_name = value")
def code_to_concept(d):
    concept = d.sql("select n_name as code, n_nationkey as id from {nation} where n_regionkey < 3")
    return migrate.code_to_concept(d.v, concept, "dcterms:spatial").select("resource_id", "term", "type", "value", F.col("value_resource_id").cast("int").alias("value_resource_id"))


@query("""select event_id as id, '/item/' || cast(user_id as varchar) as url, case when c_custkey is null then '' else 'items' end as entity_name, case when c_custkey is null then 0 else 1000000 + c_custkey end as entity_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') as created, '' as referrer, event_type as ip from events left join customer on user_id = c_custkey and c_custkey % 2 = 0""")
def migrate_hits(d):
    log = d.sql("select event_id as id, user_id as item, cast(null as bigint) as doc, year(ts) as year, month(ts) as month, day(ts) as day, hour(ts) as hour, minute(ts) as minute, cast(second(ts) as int) as second, cast(null as string) as referrer, event_type as ip from {events}")
    m = d.sql("select c_custkey as source_id, 1000000 + c_custkey as dest_id from {customer} where c_custkey % 2 = 0")
    return migrate.migrate_hits(log, m, m.limit(0))


@query("select l_orderkey, l_linenumber, l_suppkey + 10 as owner_id, case when l_linenumber = 1 then 2 * l_partkey when l_orderkey % 3 <> 0 then 500000 + l_orderkey end as resource_id from lineitem")
def migrate_messages(d):
    r = d.sql("select l_orderkey, l_linenumber, l_suppkey as user, l_orderkey as item, if(l_linenumber = 1, l_partkey, null) as doc from {lineitem}")
    got = migrate.migrate_messages(r, d.sql("select s_suppkey as source_id, s_suppkey + 10 as dest_id from {supplier}"), d.sql(ITEM_MAP), d.sql("select p_partkey as source_id, 2 * p_partkey as dest_id from {part}"))
    return got.select("l_orderkey", "l_linenumber", "owner_id", "resource_id")


@query("select p_partkey as id, cast(p_size as bigint) + 1 as owner_id, p_name || ' / weekly / ' || case when p_size > 9 then 'public' else 'private' end as comment from part")
def migrate_searches(d):
    s = d.sql("select p_partkey as id, p_size as user, concat('  ', replace(p_name, ' ', ' \n ')) as name, 'weekly' as frequency, p_size > 9 as is_public from {part}")
    return migrate.migrate_searches(s, d.sql("select distinct p_size as source_id, cast(p_size as bigint) + 1 as dest_id from {part}"))


@query("""with t as (select max(c_custkey) as top from customer) select case when c_custkey % 10 = 0 then top + 1 + (c_custkey - (select min(c_custkey) from customer where c_custkey % 10 = 0)) // 10 else c_custkey end as id, c_custkey as source_id,
    case when c_custkey % 10 = 0 then c_custkey || '-' || lower(c_name) || '@x.org' when c_custkey % 10 = 1 then 'user-' || c_custkey || '@example.org' else lower(c_name) || '@x.org' end as email,
    case when c_custkey = (select min(c_custkey) from customer c2 where c2.c_mktsegment = customer.c_mktsegment) then c_mktsegment else c_mktsegment || '-' || c_custkey end as name from customer, t""")
def dedup_users(d):
    users = d.sql("select c_custkey as id, if(c_custkey % 10 = 1, 'none', concat(lower(c_name), '@x.org')) as email, c_mktsegment as name from {customer}")
    return migrate.dedup_users(users, d.sql("select c_custkey as id, concat(c_name, '@X.org') as email, cast(null as string) as name from {customer} where c_custkey % 10 = 0"))


@query("select c_custkey as user_id, k as key, v as value from (select c_custkey, unnest(['segment', 'nation']) as k, unnest([case when c_custkey % 2 = 0 then '' else c_mktsegment end, cast(c_nationkey as varchar)]) as v from customer) where v <> ''")
def user_settings(d):
    return migrate.user_settings(d.sql("select c_custkey as id, if(c_custkey % 2 = 0, '', c_mktsegment) as s, c_nationkey as n from {customer}"), {"s": "segment", "n": "nation"})


@query("select distinct 'dir/a.' || l_partkey as storage_id, 'jpg' as extension from lineitem where l_partkey % 3 <> 0")
def asset_storage(d):
    got = migrate.asset_storage(d.sql("select concat('dir/a.', l_partkey, '.JPG') as filename from {lineitem}"), d.sql("select concat('dir/a.', p_partkey) as storage_id from {part} where p_partkey % 3 = 0"))
    return got.select("storage_id", "extension")


@query("select n_regionkey as id, case when n_regionkey % 2 = 0 then 100 + n_regionkey end as target_id, case when n_regionkey % 2 = 0 then 'Region ' || n_regionkey else 'Region ' || n_regionkey || ' ' || n_regionkey end as label from (select distinct n_regionkey from nation)")
def reconcile_vocabs(d):
    s = d.sql("select cast(n_regionkey as bigint) as id, concat('Region ', n_regionkey) as label, n_name as term_value from {nation}")
    t = d.sql("select 100 + cast(n_regionkey as bigint) as id, concat('region-', n_regionkey) as label, if(n_regionkey % 2 = 0, n_name, concat(n_name, '!')) as term_value from {nation}")
    return migrate.reconcile_vocabs(s, t)


@query("select n_nationkey as source_id, case when n_nationkey % 2 = 0 then 100 + n_nationkey else 1000 + (n_rank - 1) end as dest_id, 'new:' || n_name as term, n_nationkey % 2 = 1 as is_new from (select *, row_number() over (partition by n_nationkey % 2 order by n_name) as n_rank from nation)")
def reconcile_terms(d):
    s, t = d.sql("select n_nationkey as id, concat('old:', n_name) as term from {nation}"), d.sql("select 100 + n_nationkey as id, concat('new:', n_name) as term from {nation} where n_nationkey % 2 = 0")
    return migrate.reconcile_terms(s, t, {"old": "new"}, 1000)


@query("select l_orderkey as item_id, l_linenumber, cast(row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber, l_returnflag) as bigint) as position, l_returnflag = 'A' as is_public from lineitem")
def media_positions(d):
    m = d.sql("select l_orderkey as item_id, l_linenumber, - unix_micros(cast(l_shipdate as timestamp)) as s, l_returnflag, if(l_returnflag = 'A', 'public', 'staffonly') as security from {lineitem}")
    return migrate.access_rights(migrate.media_positions(m, ["s", "l_linenumber", "l_returnflag"])).select("item_id", "l_linenumber", F.col("position").cast("long").alias("position"), "is_public")


@query("select distinct c_custkey as item_id, n_nationkey + 10 as item_set_id from customer join nation on n_nationkey = c_nationkey where n_regionkey < 3")
def membership(d):
    items = d.sql("select c_custkey as id, array(c_nationkey, c_nationkey) as set from {customer}")
    return migrate.membership(items, d.sql("select n_nationkey as source_id, n_nationkey + 10 as dest_id from {nation} where n_regionkey < 3"))


@query("select p_partkey as resource_id, t.term, t.lang, case t.term when 'dcterms:title' then upper(p_name) else p_brand end as value, t.term = 'dcterms:title' as is_public from part, (values ('dcterms:title', 'en'), ('dcterms:publisher', null)) t(term, lang) where t.term = 'dcterms:title' or p_size % 2 = 0")
def record_values(d):
    spec = {"p_name": {"term": "dcterms:title", "lang": "en", "transform": F.upper}, "brand": {"term": "dcterms:publisher", "is_public": False}}
    return migrate.record_values(d.sql("select p_partkey, p_name, if(p_size % 2 = 0, p_brand, ' ') as brand from {part}"), "p_partkey", spec).select("resource_id", "term", "lang", "value", "is_public")


@query("select l_orderkey, l_linenumber, o_custkey as owner_id, case when o_orderstatus = 'F' then 'File' end as template, '/data/d' || l_orderkey || '/0' || l_linenumber || '/f.png' as path from lineitem join orders on o_orderkey = l_orderkey and o_orderkey % 2 = 0")
def inherit_from_item(d):
    items = d.sql("select o_orderkey as id, o_custkey as owner_id, o_orderdate as created, if(o_orderstatus = 'F', 'Final', 'Open') as template from {orders} where o_orderkey % 2 = 0")
    got, _ = migrate.inherit_from_item(d.sql("select l_orderkey as item_id, l_linenumber from {lineitem}"), items, {"Final": ("File", "bibo:File")})
    path = migrate.media_path("/data/", F.concat(F.lit("d"), F.col("item_id").cast("string")), F.col("l_linenumber"), F.lit("f.png"))
    return got.select(F.col("item_id").alias("l_orderkey"), "l_linenumber", "owner_id", "template", path.alias("path"))


@query("select o_orderkey as id, case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') else 'now' end as created, 'now' as modified from orders")
def restore_dates(d):
    e = d.sql("select o_orderkey as id, 'now' as created, 'now' as modified from {orders}")
    return migrate.restore_dates(e, d.sql("select o_orderkey as id, date_format(o_orderdate, 'yyyy-MM-dd') as created, cast(null as string) as modified from {orders} where o_orderkey % 2 = 0"))


@query("select n_nationkey as id, case when n_regionkey < 3 then n_regionkey + 50 end as item_set_id from nation")
def remap_vocab_item_sets(d):
    m = d.sql("select 'item_sets' as entity, cast(r_regionkey as string) as source_id, r_regionkey + 50 as dest_id from {region} where r_regionkey < 3")
    return migrate.remap_vocab_item_sets(d.sql("select n_nationkey as id, n_regionkey as item_set_id from {nation}"), m)


@query("select distinct p_type || p_brand as identifier, min(p_partkey) as id from part group by 1 union all select cast(p_partkey as varchar), p_partkey from part where p_size > 10")
def find_assets(d):
    asset = d.sql("select p_partkey as id, concat(p_type, p_brand) as name, concat('s', p_partkey) as storage_id from {part}")
    return identifiers.find_assets(d.sql("select concat(p_type, p_brand) as identifier from {part} union all select cast(p_partkey as string) from {part} where p_size > 10 union all select 'unknown'"), asset)


@query("select o_orderkey as source_index, c_name, case when c_custkey % 2 = 0 then 10 + c_custkey end as owner, case when c_custkey % 2 = 0 then 10 + c_custkey else 5 end as item from orders join customer on o_custkey = c_custkey")
def complete_references(d):
    rows = d.sql("select o_orderkey as source_index, c_name, if(c_custkey % 2 = 0, null, 5L) as item from {orders} join {customer} on o_custkey = c_custkey")
    known = d.sql("select c_name as identifier, if(k = 1, 3L, 10 + c_custkey) as id, k as source_index from {customer} lateral view explode(array(1, 2)) as k where c_custkey % 2 = 0")
    both = identifiers.complete_references(rows.withColumn("_n", F.col("c_name")), known, {"c_name": "owner", "_n": "item"})
    return both.select("source_index", "c_name", "owner", "item")


@query("select 'p' || p_partkey as source, t.term, t.type, t.value, t.uri from part, lateral (values ('dcterms:type', 'literal', '<' || p_type || '>', null), ('dcterms:type', 'literal', '<' || p_brand || '>', null), ('dcterms:relation', 'uri', p_name, 'http://x/' || p_partkey), ('dcterms:identifier', 'literal', 'p' || p_partkey, null)) t(term, type, value, uri)")
def build_mapper(d):
    sheet = d.sql("select concat('p', p_partkey) as s, concat(p_type, ' | ', p_brand, ' | ') as kinds, concat('http://x/', p_partkey, ' ', p_name) as link from {part}")
    m = transform.build_mapper(sheet, "s", {"kinds": {"term": "dcterms:type", "prefix": "<", "suffix": ">"}, "link": {"term": "dcterms:relation", "type": "uri"}}, keep_source="dcterms:identifier")
    return m.select("source", "term", "type", "value", "uri")


@query("select 1000 + row_number() over (order by source) - 1 as resource_id, source as title, term, value, uri from mapper")
def create_resources(d):
    made, v = transform.create_resources(d.mapper, 1000)
    return v.join(made, v["resource_id"] == made["id"]).select("resource_id", "title", "term", "value", "uri")


@query("select p_type as source, 'http://x/' || p_brand as uri, count(*) as items from (select distinct p_type, p_brand from part), (select distinct p_type as t, p_partkey as k from part) where p_type = t group by 1, 2")
def merge_source_uris(d):
    c = d.sql("select p_type as source, p_brand as uri, p_brand as label, array(p_partkey) as items from {part} union all select p_type, '', 'none', array(p_partkey) from {part}")
    return transform.merge_source_uris(c, "http://x/").select("source", "uri", F.size("items").cast("long").alias("items"))


@query("select r.id, case when v.value is null then 'none' else 'c' end as class, case when v.value is null then 'none' else 't' end as template from r left join v on v.resource_id = r.id and v.term = 'dcterms:publisher'")
def update_class_template(d):
    r = d.r.select("id", F.lit("none").alias("class"), F.lit("none").alias("template"))
    return transform.update_class_template(r, d.v, "dcterms:publisher", d.spark.createDataFrame([("literal", "c", "t")], "type string, class string, template string"))


@query("select p_partkey as resource_id, t.term, case when t.term = 'gender' then case when p_size > 9 then 'female' else 'm' end end as value, case when t.term = 'country' then 'http://c/' || p_type end as uri from part, (values ('gender'), ('country')) t(term) where t.term = 'gender' or p_size % 2 = 0")
def fill_from_authority(d):
    v = d.v.where("term = 'dcterms:title'").withColumn("uri", F.col("resource_id").cast("string"))
    a = d.sql("select cast(200000000 + p_partkey as string) as uri, if(p_size > 9, 'f', 'm') as gender, if(p_size % 2 = 0, p_type, null) as country from {part}")
    got = transform.fill_from_authority(v, a, "dcterms:title", {"gender": {"term": "gender", "codes": {"f": "female"}}, "country": {"term": "country", "type": "uri", "prefix": "http://c/"}})
    return got.where("term <> 'dcterms:title'").select((F.col("resource_id") - 200000000).alias("resource_id"), "term", "value", "uri")


@query(f"select {COLS} from v where not exists (select 1 from new n where n.resource_id = v.resource_id and n.term = v.term) union all select {COLS} from new")
def upsert(d):
    extra = d.new.select("id", (F.col("resource_id") + 900000000).alias("resource_id"), *d.new.columns[2:])
    return _full(merge.upsert(d.v, d.new.union(extra), "revise", unidentified="skip"))


@query("select id, case when id % 2 = 0 then id + 2 end as thumbnail_id from r")
def update_thumbnails(d):
    links = d.r.where("id % 2 = 0").select(F.col("id").alias("resource_id"), F.explode(F.array(F.col("id") + 1, F.col("id") + 2)).alias("asset_id"))
    return merge.update_thumbnails(d.r.select("id", F.lit(None).cast("long").alias("thumbnail_id")), links)


@query("select c_custkey as resource_id, case when c_custkey % 20 = 0 then '=' else '+-' end as subject, '=' as identifier from customer union all select 100000000 + s_suppkey, '', '-' from supplier union all select 400000000 + n_nationkey, '', '-' from nation")
def diff_matrix(d):
    diff = merge.diff_resources(d.v, d.new)
    return merge.diff_matrix(diff, ["dcterms:subject", "dcterms:identifier"]).toDF("resource_id", "subject", "identifier")


@query("""select n_nationkey as resource_id, 'skos:prefLabel' as term, n_name as value, null as value_resource_id from nation union all select n_nationkey, 'skos:inScheme', null, 99 from nation
    union all select n_nationkey, 'skos:broader', null, n_regionkey from nation where n_nationkey > 4 union all select n_regionkey, 'skos:narrower', null, n_nationkey from nation where n_nationkey > 4
    union all select n_nationkey, 'skos:topConceptOf', null, 99 from nation where n_nationkey <= 4 union all select 99, 'skos:hasTopConcept', null, n_nationkey from nation where n_nationkey <= 4""")
def thesaurus_values(d):
    concept = d.sql("select cast(n_nationkey as bigint) as id, if(n_nationkey > 4, cast(n_regionkey as bigint), null) as parent_id, n_name as label, '' as definition, cast(null as string) as note from {nation}")
    got = hierarchy.thesaurus_values(concept, 99)
    return got.select(F.col("resource_id").cast("int").alias("resource_id"), "term", "value", F.col("value_resource_id").cast("int").alias("value_resource_id"))


@query("select 'c' || c_custkey as id, 'n' || c_nationkey as parent_id, 'r' || n_regionkey as scheme from customer join nation on n_nationkey = c_nationkey union all select 'n' || n_nationkey, null, 'r' || n_regionkey from nation")
def concept_tables(d):
    parents = d.sql("select concat('c', c_custkey) as id, concat('n', c_nationkey) as parent_id from {customer} union all select concat('n', n_nationkey), concat('r', n_regionkey) from {nation}")
    none = d.spark.createDataFrame([], "id string, pos int, name string")
    return hierarchy.concept_tables(none, none.withColumnRenamed("name", "lang"), parents, [f"r{i}" for i in range(5)])[1]


@query("select r.id, coalesce(r.title, v.value) as title from r left join v on v.resource_id = r.id and v.term = 'dcterms:creator'")
def display_title(d):
    return hierarchy.display_title(d.r, d.v, ("dcterms:title", "dcterms:creator"))


@query(f"select {COLS} from v where term = 'dcterms:identifier' and resource_id in (select resource_id from new) union select {COLS} from new where term <> 'dcterms:identifier'")
def keep_identifiers(d):
    return _full(merge.keep_identifiers(d.v, d.new.where("term = 'dcterms:subject'"), ["dcterms:identifier"], "revise"))


@query("select l_orderkey as item_id, l_suppkey as item_set_id from lineitem union select o_orderkey, o_custkey from orders")
def keep_links(d):
    return merge.keep_links(d.sql("select l_orderkey as item_id, l_suppkey as item_set_id from {lineitem}"), d.sql("select o_orderkey as item_id, o_custkey as item_set_id from {orders}"), "append")


@query("select count(*) as total, count(*) filter (o_orderkey < 50) as skipped, count(*) filter (o_orderkey >= 50 and o_orderstatus = 'P') as empty, count(*) filter (o_orderkey >= 50 and o_orderstatus <> 'P' and o_orderkey % 5 <> 0) as processed, count(*) filter (o_orderkey % 5 = 0) as errors from orders")
def import_stats(d):
    return merge.import_stats(d.sql("select o_orderstatus = 'P' as is_empty, o_orderkey < 50 as skipped, if(o_orderkey % 5 = 0, 1, 0) as errors from {orders}"))


@query("select id from r where id % 4 <> 1")
def undo_import(d):
    ledger = merge.record_import(d.r.where("id % 4 = 1"), 5).union(merge.record_import(d.r.where("id % 4 = 2"), 6))
    return merge.undo_import(d.r, d.v, d.media, ledger, 5)[0].select("id")


@query("select p_type as source, 'dcterms:format' as term, min(p_brand) as uri from part group by 1 having count(distinct p_brand) = 1 union all select 'only', 'dcterms:format', 'u'")
def single_uri_mapper(d):
    m = d.sql("select p_type as source, p_brand as uri, p_brand as label from {part} union all select 'only', 'u', 'l' union all select 'only', '', ''")
    return transform.single_uri_mapper(m, ["dcterms:format"]).select("source", "term", "uri")


@query("select cast(c_custkey as varchar) as who, c_custkey as owner_id from customer where c_custkey % 2 = 0 union all select lower(c_name) || '@X.org', c_custkey from customer where c_custkey % 3 = 0 union all select c_name, c_custkey from customer union all select 'nobody', 1")
def resolve_users(d):
    rows = d.sql("select cast(c_custkey as string) as who from {customer} where c_custkey % 2 = 0 union all select concat(lower(c_name), '@X.org') from {customer} where c_custkey % 3 = 0 union all select c_name from {customer} union all select 'nobody'")
    return identifiers.resolve_users(rows, d.sql("select c_custkey as id, concat(c_name, '@x.org') as email, c_name as name from {customer}"), "who", 1).select("who", "owner_id")


@query("select o_orderkey as source_index, c_name as identifier, 'resources' as namespace, case when c_custkey % 2 = 0 then c_custkey end as id from orders join customer on o_custkey = c_custkey")
def resolve_sources(d):
    rows = d.sql("select o_orderkey as source_index, array(c_name, c_name, '') as item from {orders} join {customer} on o_custkey = c_custkey")
    known = d.sql("select c_name as identifier, 'resources' as namespace, c_custkey as id from {customer} where c_custkey % 2 = 0 union all select c_name, 'assets', 1 from {customer}")
    return identifiers.resolve_sources(identifiers.extract_identifiers(rows, {"item": "resources"}), known).select("source_index", "identifier", "namespace", "id")


@query(f"""select {COLS} from v where not (resource_id < 100000000 and term in ('dcterms:identifier', 'dcterms:subject'))
    union all select c_custkey, 'dcterms:identifier', 'literal', c_name, null, null, null, true from customer union all select c_custkey, 'dcterms:subject', 'literal', 'new ' || lower(c_mktsegment), null, null, 'en', true from customer""")
def import_entries(d):
    """A table of all customers revises what is stored of them, a header's pattern changing their segment."""
    table = d.sql("select c_custkey as source_index, array(c_name) as name, array(c_mktsegment) as segment from {customer}")
    headers = {"name": "dcterms:identifier", "segment": "dcterms:subject @en ~ new {{ value|lower }}"}
    return _full(pipeline.import_entries(table, d.v, d.r, ["dcterms:identifier"], "revise", headers).values)
