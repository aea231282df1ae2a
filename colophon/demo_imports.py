"""Queries of whole imports, operation lists, migrations, comparisons and readers over the driver's tables, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import checks, hierarchy, identifiers, merge, metadata, migrate, patterns, pipeline, schema, sources, store, transform, values, xml_values
from .demo import COLS, TABLES, _full, query

#: New entries that link to each other: parts, each to the next and, by a second identifier, to itself; and what they're merged into.
PARTS = "select p_partkey as source_index, array(concat('P', p_partkey)) as ident, array(p_name) as name, array(concat('P', p_partkey + 1)) as next, array(p_type) as kind from {part}"
PART_HEADERS = {"ident": "dcterms:identifier", "name": "dcterms:title", "next": "dcterms:relation ^^item ^^literal", "kind": "dcterms:type @en"}
#: Customers again: with a changed segment, and for every third no segment at all; some are unknown.
CHANGES = "select c_custkey as source_index, array(if(c_custkey % 7 = 0, concat('none ', c_custkey), c_name)) as name, if(c_custkey % 3 = 0, array(), array(concat('NEW ', c_mktsegment))) as segment from {customer}"
CHANGE_HEADERS = {"name": "dcterms:identifier", "segment": "dcterms:subject"}
CHANGED = "(select c_custkey as resource_id, c_name, 'NEW ' || c_mktsegment as segment, c_custkey % 3 = 0 as empty from customer where c_custkey % 7 <> 0)"
_VALUE = "'literal' as type, {} as value, null as uri, cast(null as bigint) as value_resource_id, {} as lang, true as is_public"


def _import(d, action, **how):
    return pipeline.import_entries(d.sql(CHANGES), d.v, d.r, ["dcterms:identifier"], action, CHANGE_HEADERS, unidentified="skip", job_id=3, **how)


@query(f"""with n as (select p_partkey, p_name, p_type, (select max(id) from r) + row_number() over (order by '=P' || cast(p_partkey as varchar)) as rid from part)
    select rid as resource_id, 'dcterms:identifier' as term, {_VALUE.format("'P' || cast(p_partkey as varchar)", 'null')} from n union all select rid, 'dcterms:title', {_VALUE.format('p_name', 'null')} from n union all select rid, 'dcterms:type', {_VALUE.format('p_type', "'en'")} from n
    union all select n.rid, 'dcterms:relation', case when m.rid is null then 'literal' else 'resource:item' end, case when m.rid is null then 'P' || cast(n.p_partkey + 1 as varchar) end, null, m.rid, null, true from n left join n m on m.p_partkey = n.p_partkey + 1
    union all select {COLS} from v""")
def import_create(d):
    """Entries that link to later ones of the same table."""
    return _full(pipeline.import_entries(d.sql(PARTS), d.v, d.r, ["dcterms:identifier"], "create", PART_HEADERS).values)


@query("""select cast(3 as bigint) as job_id, (select max(id) from r) + row_number() over (order by '=P' || cast(p_partkey as varchar)) as entity_id, 'items' as entity_name from part""")
def import_ledger(d):
    return pipeline.import_entries(d.sql(PARTS), d.v, d.r, ["dcterms:identifier"], "create", PART_HEADERS, job_id=3).ledger


@query("""select c_custkey as source_index, 'warn' as severity, 'no resource is identified' as message from customer where c_custkey % 7 = 0""")
def import_messages(d):
    return _import(d, "update").messages


@query(f"select {COLS} from v union all select resource_id, 'dcterms:subject', {_VALUE.format('segment', 'null')} from {CHANGED} c where not empty")
def import_append(d):
    return _full(_import(d, "append").values)


@query(f"select {COLS} from v where not (term = 'dcterms:subject' and resource_id in (select resource_id from {CHANGED} c where not empty)) union all select resource_id, 'dcterms:subject', {_VALUE.format('segment', 'null')} from {CHANGED} c where not empty")
def import_revise(d):
    return _full(_import(d, "revise").values)


@query(f"select {COLS} from v where not (term = 'dcterms:subject' and resource_id in (select resource_id from {CHANGED} c)) union all select resource_id, 'dcterms:subject', {_VALUE.format('segment', 'null')} from {CHANGED} c where not empty")
def import_update(d):
    return _full(_import(d, "update").values)


@query(f"select {COLS} from v where resource_id not in (select resource_id from {CHANGED} c) union all select resource_id, 'dcterms:subject', {_VALUE.format('segment', 'null')} from {CHANGED} c where not empty union all select resource_id, 'dcterms:identifier', {_VALUE.format('c_name', 'null')} from {CHANGED} c")
def import_replace(d):
    return _full(_import(d, "replace").values)


@query(f"""with l as (select {COLS} from v where term <> 'dcterms:creator' union all select o_orderkey + 300000000, 'dcterms:creator', 'resource:item', null, null, o_custkey, null, true from orders)
    select {COLS} from l where resource_id not in (select resource_id from {CHANGED} c) and (value_resource_id is null or value_resource_id not in (select resource_id from {CHANGED} c))""")
def import_delete(d):
    """Orders link to their customers; links to customers that are deleted go with them."""
    linked = d.sql("select 300000000 + o_orderkey as resource_id, o_custkey as value_resource_id from {orders}")
    links = linked.select(F.lit(None).cast("long").alias("id"), "resource_id", F.lit("dcterms:creator").alias("term"), F.lit("resource:item").alias("type"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("uri"), "value_resource_id", F.lit(None).cast("string").alias("lang"), F.lit(True).alias("is_public"))
    v = d.v.where("term <> 'dcterms:creator'").unionByName(links)
    return _full(pipeline.import_entries(d.sql(CHANGES), v, d.r, ["dcterms:identifier"], "delete", CHANGE_HEADERS, unidentified="skip").values)


@query("""with x as (select p_partkey, (select max(id) from r) + row_number() over (order by '=P' || cast(p_partkey as varchar)) as rid, p_brand from part) select rid as item_id, n_nationkey + 400000000 as item_set_id, p_brand || '.jpg' as source, 'sideload' as ingester from x join nation on n_nationkey = p_partkey % 25""")
def import_sets_and_media(d):
    """Parts in the item sets of nations, with a file each."""
    table = d.sql("select p_partkey as source_index, array(concat('P', p_partkey)) as ident, array(n_name) as place, array(concat(p_brand, '.jpg')) as file from {part} join {nation} on n_nationkey = p_partkey % 25")
    got = pipeline.import_entries(table, d.v, d.r, ["dcterms:identifier"], "create", {"ident": "dcterms:identifier", "place": "o:item_set", "file": "o:media"})
    return got.item_sets.join(got.media, "item_id").select("item_id", "item_set_id", "source", "ingester")


@query("""select resource_id, count(*) as n, count(distinct id) as ids, min(case when term = 'a' then value end) as before, min(case when term = 'b' then value end) as after from (
    select id, resource_id, 'b' as term, case when p_type = 'ECONOMY ANODIZED' then 'changed' else p_type end as value from (select v.id, v.resource_id, p.p_type from v join part p on p.p_partkey + 200000000 = v.resource_id where v.term = 'dcterms:type')
    union all select -resource_id, resource_id, 'a', p_brand from (select v.resource_id, p.p_brand from v join part p on p.p_partkey + 200000000 = v.resource_id where v.term = 'dcterms:type')) group by resource_id""")
def values_made_then_changed(d):
    """A step splits values, a later one changes what the first made; all have ids of their own."""
    v = d.sql("select cast(200000000 + p_partkey as bigint) * 10 + 2 as id, 200000000 + p_partkey as resource_id, 'dcterms:type' as term, 'literal' as type, concat(p_brand, ' / ', p_type) as value, cast(null as string) as uri, cast(null as bigint) as value_resource_id, cast(null as string) as lang, true as is_public from {part}")
    mapper = d.spark.createDataFrame([("economy anodized", "b", "literal", "changed", None, None, None, True)], "source string, term string, type string, value string, uri string, value_resource_id long, lang string, is_public boolean")
    got = transform.transform_pipeline(v, [{"action": "cut_value", "params": {"source": "dcterms:type", "separator": "/", "dest1": "a", "dest2": "b"}}, {"action": "replace_table_update", "params": {"mapper": mapper, "source": "b"}}])
    return got.groupBy("resource_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.min(F.when(F.col("term") == "a", F.col("value"))).alias("before"), F.min(F.when(F.col("term") == "b", F.col("value"))).alias("after"))


@query("""with t as (select p_type, (select max(id) from r) + row_number() over (order by p_type) as sid from (select distinct p_type from part)) select p.p_partkey + 200000000 as item_id, t.sid as item_set_id, 'set of ' || p.p_type as title from part p join t using (p_type)""")
def transform_state(d):
    """Item sets are made of texts, items join them, and the third step changes what the first made."""
    none = schema.empty(d.spark, "item_id long, item_set_id long")
    got = transform.transform_state(transform.State(d.v, d.r, none), [
        {"action": "create_resource", "params": {"mapping": {"dcterms:type": "skos:prefLabel"}, "resource_name": "item_sets"}},
        {"action": "attach_item_set", "params": {"source": "dcterms:type", "identifier": "skos:prefLabel", "match": "ci"}},
        {"action": "modify_value", "params": {"source": "skos:prefLabel", "prefix": "set of "}},
    ])
    names = got.values.where("term = 'skos:prefLabel'").select(F.col("resource_id").alias("item_set_id"), F.col("value").alias("title"))
    return got.item_sets.join(names, "item_set_id").select("item_id", "item_set_id", "title")


@query("select resource_id, term, case when n is null then 'literal' else 'valuesuggest:types' end as type, coalesce('label of ' || n, value) as value, 'http://t/' || n as uri from (select v.*, case when term = 'dcterms:type' and value < 'M' then value end as n from v)")
def convert_datatype(d):
    """Texts that have one uri become values of a vocabulary's type; those with two stay."""
    m = d.sql("select distinct p_type as source, concat('http://t/', p_type) as uri, concat('label of ', p_type) as label from {part} union all select distinct p_type, 'http://other', 'x' from {part} where p_type >= 'M'")
    return transform.convert_datatype(d.v, "dcterms:type", "valuesuggest:types", m, match="ci").select("resource_id", "term", "type", "value", "uri")


DIFF = "(select c_custkey as resource_id, 'dcterms:subject' as term, c_mktsegment as value, 1 as d1, case when c_custkey % 20 = 0 then 1 else 0 end as d2 from customer union all select c_custkey, 'dcterms:subject', 'NEW ' || c_mktsegment, 0, 1 from customer where c_custkey % 20 <> 0 union all select c_custkey, 'dcterms:identifier', c_name, 1, 1 from customer union all select c_custkey, 'dcterms:spatial', n_name, 1, 0 from customer join nation on c_nationkey = n_nationkey)"


@query(f"""with m as (select unnest(['append', 'revise', 'update', 'replace', 'sensible append', 'sensible update']) as mode), x as (select mode, term, d1, case when term = 'dcterms:spatial' then case when mode = 'sensible append' then d1 else 0 end when mode like '%append' then 1 else d2 end as d2 from {DIFF} c, m),
    s as (select mode, term, '=' as diff, sum(least(d1, d2)) as n from x group by all union all select mode, term, '-', sum(d1 - least(d1, d2)) from x group by all union all select mode, term, '+', sum(d2 - least(d1, d2)) from x group by all) select mode, term, diff, cast(n as bigint) as n from s where n > 0""")
def diff_by_mode(d):
    """What each mode would change of customers: a property without an incoming value is taken away, unless missing ones are simulated."""
    cur = d.v.where("resource_id < 100000000")
    modes = [(m, m, False) for m in ("append", "revise", "update", "replace")] + [("sensible append", "append", True), ("sensible update", "update", True)]
    out = None
    for name, mode, sensible in modes:
        x = merge.diff_summary(merge.diff_resources(cur, d.new, mode, ["dcterms:spatial"], sensible)).withColumn("mode", F.lit(name))
        out = x if out is None else out.union(x)
    return out.select("mode", "term", "diff", "n")


@query("""select c_custkey as id, unnest(case when c_custkey % 5 = 0 then [{'meta': 'resource', 'data1': cast(c_custkey as varchar), 'data2': null, 'diff': '-'}] when c_custkey % 11 = 0 then [{'meta': 'has_error', 'data1': cast(c_custkey as varchar), 'data2': cast(c_custkey as varchar), 'diff': '×'}]
    else [{'meta': 'title', 'data1': c_name, 'data2': case when c_custkey % 2 = 0 then c_name else '' end, 'diff': case when c_custkey % 2 = 0 then '=' else '-' end}, {'meta': 'class', 'data1': c_mktsegment, 'data2': lower(c_mktsegment), 'diff': '≠'}] end, recursive := true) from customer
    union all select -1 - c_custkey, 'resource', null, cast(-1 - c_custkey as varchar), '+' from customer where c_custkey % 13 = 0""")
def diff_fields(d):
    cur = d.sql("select c_custkey as id, c_name as title, c_mktsegment as class from {customer}")
    new = d.sql("select c_custkey as id, if(c_custkey % 2 = 0, c_name, '') as title, lower(c_mktsegment) as class from {customer} where c_custkey % 5 <> 0 union all select -1 - c_custkey, c_name, 'x' from {customer} where c_custkey % 13 = 0")
    return merge.diff_fields(cur, new, ["title", "class"], cur.where("id % 11 = 0"))


KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": None, "events": "event_id"}
REFERENCES = {"nation": {"n_regionkey": "region"}, "customer": {"c_nationkey": "nation"}, "supplier": {"s_nationkey": "nation"}, "orders": {"o_custkey": "customer"}, "lineitem": {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"}, "events": {"user_id": "customer"}}
#: Rows of the migrated tables: their own id, and up to three of others.
MIGRATED = {"region": ("r_regionkey",), "nation": ("n_nationkey", "n_regionkey"), "customer": ("c_custkey", "c_nationkey"), "supplier": ("s_suppkey", "s_nationkey"), "part": ("p_partkey",), "orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_linenumber", "l_orderkey", "l_partkey", "l_suppkey"), "events": ("event_id", "user_id")}


def _migration(d, **other):
    tables = {t: d.sql(other.get(t, "select * from {" + t + "}")) for t in TABLES}
    # ids of customers and orders are taken, those of others are free
    taken = {"customer": d.sql("select 5 + c_custkey as id from {customer}"), "orders": d.sql("select max(o_orderkey) as id from {orders}"), "part": d.sql("select -1L as id")}
    return migrate.migrate_tables(tables, KEYS, REFERENCES, taken)


_NEW_IDS = "c as (select c_custkey as k, (select max(c_custkey) + 5 from customer) + row_number() over (order by c_custkey) as i from customer), o as (select o_orderkey as k, (select max(o_orderkey) from orders) + row_number() over (order by o_orderkey) as i from orders)"


@query(f"""with {_NEW_IDS} select 'region' as entity, r_regionkey as id, null as a, null as b, null as c from region union all select 'nation', n_nationkey, n_regionkey, null, null from nation union all select 'customer', c.i, c_nationkey, null, null from customer join c on k = c_custkey
    union all select 'supplier', s_suppkey, s_nationkey, null, null from supplier union all select 'part', p_partkey, null, null, null from part union all select 'orders', o.i, c.i, null, null from orders join o on o.k = o_orderkey left join c on c.k = o_custkey
    union all select 'lineitem', l_linenumber, o.i, p_partkey, s_suppkey from lineitem left join o on o.k = l_orderkey left join part on p_partkey = l_partkey left join supplier on s_suppkey = l_suppkey union all select 'events', event_id, c.i, null, null from events left join c on c.k = user_id""")
def migrate_tables(d):
    """All eight tables with new ids of customers and orders, and every reference to them."""
    got, out = _migration(d).tables, None
    for t, columns in MIGRATED.items():
        x = got[t].select(F.lit(t).alias("entity"), *(F.col(columns[i]).cast("long").alias(c) if i < len(columns) else F.lit(None).cast("long").alias(c) for i, c in enumerate(("id", "a", "b", "c"))))
        out = x if out is None else out.union(x)
    return out


@query("select 'orders' as entity, 'o_custkey' as column, cast(o_custkey as varchar) as source_id, count(*) as n from orders where o_custkey % 4 = 1 group by o_custkey union all select 'events', 'user_id', cast(user_id as varchar), count(*) from events where user_id % 4 = 1 or user_id not in (select c_custkey from customer) group by user_id union all select 'lineitem', 'l_partkey', cast(l_partkey as varchar), count(*) from lineitem where l_partkey in (select p_partkey from part where p_size < 5) group by l_partkey")
def migrate_unknown(d):
    """Ids that lead nowhere: a quarter of the customers and some parts are missing."""
    return _migration(d, customer="select * from {customer} where c_custkey % 4 <> 1", part="select * from {part} where p_size >= 5").unknown


XML = """select cast(p_partkey as bigint) as key, concat('<resource', if(p_partkey % 4 = 0, ' o:is_public="no"', ''), '><dcterms:title xml:lang="en">', p_name, ' &amp; more</dcterms:title><dcterms:extent o:type="xsd:integer" xml:lang="en">', p_size, '</dcterms:extent><dcterms:type o:type="uri" o:label="', p_type, '" o:is_public="private">http://t/', p_size, '</dcterms:type>',
    '<dcterms:description o:type="rdf:HTML"><p>', p_brand, '</p></dcterms:description><o:media o:ingester="url"><o:media>http://m/', p_partkey, '</o:media><dcterms:format>', p_brand, '</dcterms:format></o:media></resource>') as record from {part}"""


@query("""with k as (select cast(p_partkey as bigint) as key, * from part), x(key, part, kind, term, type, value, uri, lang, is_public) as (select key, 0, 'property', 'dcterms:title', 'literal', p_name || ' & more', null, 'en', null from k union all select key, 0, 'property', 'dcterms:extent', 'numeric:integer', cast(p_size as varchar), null, null, null from k
    union all select key, 0, 'property', 'dcterms:type', 'uri', p_type, 'http://t/' || cast(p_size as varchar), null, false from k union all select key, 0, 'property', 'dcterms:description', 'html', '<p>' || p_brand || '</p>', null, null, null from k union all select key, 0, 'field', 'o:is_public', null, 'no', null, null, null from k where p_partkey % 4 = 0
    union all select key, 1, 'field', 'o:ingester', null, 'url', null, null, null from k union all select key, 1, 'field', 'o:is_public', null, '1', null, null, null from k union all select key, 1, 'field', 'o:source', null, 'http://m/' || cast(p_partkey as varchar), null, null, null from k union all select key, 1, 'property', 'dcterms:format', 'literal', p_brand, null, null, null from k) select * from x""")
def extract_xml_values(d):
    return xml_values.extract_xml_values(d.sql(XML), "key").select("key", "part", "kind", "term", "type", "value", "uri", "lang", "is_public")


def _written(d, lines, **options):
    """The path of text files with the column line, in the order of the column at: one file unless options say otherwise."""
    path = store.scratch(d.spark)
    lines.repartition(1).sortWithinPartitions("at").select("line").write.options(**options).text(path, lineSep="\n")
    return path


@query("select p_partkey, 'http://t/' || cast(p_size as varchar) as uri, p_name || ' & more' as title from part")
def read_xml_files(d):
    """Records written to files and read back from blocks of them."""
    path = _written(d, d.sql(XML).select(F.col("key").alias("at"), F.concat(F.lit("<?xml version='1.0'?><resources xmlns:o='x'>"), "record", F.lit("</resources>")).alias("line")))
    records = xml_values.read_xml_records(d.spark, path).withColumn("key", F.monotonically_increasing_id())
    x = store.cut(xml_values.extract_xml_values(records, "key"))
    pick = lambda term, c: F.max(F.when(F.col("term") == term, F.col(c)))
    media = x.where("term = 'o:source'").select(F.col("key").alias("resource_id"), F.regexp_extract("value", r"(\d+)$", 1).cast("long").alias("p_partkey"))
    return xml_values.xml_values(x, "key").groupBy("resource_id").agg(pick("dcterms:type", "uri").alias("uri"), pick("dcterms:title", "value").alias("title")).join(media, "resource_id").select("p_partkey", "uri", "title")


@query("select cast(p_partkey as bigint) + 1 as source_index, p_name || ';' || chr(10) || chr(10) || p_brand || '\"' as name, p_type as kind from part")
def read_csv(d):
    """Cells with line ends, separators and quotes; the numbers are those of the lines."""
    lines = d.sql("select p_partkey as at, concat('\"', p_name, ';\\n\\n', p_brand, '\"\"\"', ';', p_type) as line from {part} union all select -1, 'name;kind'")
    got = sources.read_csv(d.spark, _written(d, lines), ";", escape='"', split=True)
    return got.select("source_index", F.element_at("name", 1).alias("name"), F.element_at("kind", 1).alias("kind"))


@query("select cast(p_partkey as bigint) + 1 as source_index, '\"' || p_name as name, p_brand as brand from part")
def read_tsv(d):
    """Tables with tabs, where quotes mean nothing, and a repeated column."""
    lines = d.sql("select p_partkey as at, concat('\"', p_name, '\\t', p_brand) as line from {part} union all select -1, 'name\\tname'")
    got = sources.read_tsv(d.spark, _written(d, lines))
    return got.select("source_index", F.element_at("name", 1).alias("name"), F.element_at("name", 2).alias("brand"))


@query("select p_partkey, p_name, p_size from part")
def read_json(d):
    """Files of one object each, with a list under a key."""
    pages = d.sql("select p_brand as at, to_json(struct(collect_list(struct(p_partkey, p_name, p_size)) as items)) as line from {part} group by p_brand")
    got = sources.read_json(d.spark, _written(d, pages, maxRecordsPerFile=1), "items")
    return got.select(F.col("p_partkey").cast("int").alias("p_partkey"), "p_name", F.col("p_size").cast("int").alias("p_size"))


@query("select p_name as source, 'dcterms:title' as destination, count(*) as n from part where p_size % 2 = 0 group by p_name")
def read_table_map(d):
    """A configuration table whose headers are renamed; rows with an unknown term are left out."""
    e = d.sql("select p_partkey as source_index, array(p_name) as de, array(if(p_size % 2 = 0, 'dcterms:title', 'nothing')) as a from {part}")
    vocabulary = d.spark.createDataFrame([("dcterms:title",)], "term string")
    return sources.read_table_map(e, {"de": "source", "a": "destination"}, vocabulary)[0].groupBy("source", "destination").agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'filled' else o_orderstatus end as status, coalesce(n_name, 'nowhere') as nation from orders left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey and n_regionkey < 3")
def lookup_tables(d):
    """Codes looked up in named tables: others pass through, or become a default."""
    status = d.spark.createDataFrame([("O", "open"), ("F", "filled")], "code string, label string")
    nation = d.sql("select cast(n_nationkey as string) as code, n_name as label from {nation} where n_regionkey < 3")
    x = d.sql("select o_orderkey, o_orderstatus as status, cast(c_nationkey as string) as nation from {orders} left join {customer} on c_custkey = o_custkey").fillna({"nation": "none"})
    return patterns.lookup(patterns.lookup(x, {"status": "s"}, {"s": status}), {"nation": "n"}, {"n": nation}, default="nowhere")


@query("select p_partkey, p_name from part where p_type not in ('ECONOMY', 'STANDARD') and p_type not in (select min(p_type) from part)")
def exclude_texts_without_accents(d):
    """Some types only are left out, written with accents, in another case and with a space after them."""
    v = d.sql("select p_partkey, p_name, p_type as value from {part}")
    out = d.sql("select concat(translate(x, 'AEO', 'ÁÈô'), ' ') as value from (select min(p_type) as x from {part} union all select 'ECONOMY' union all select 'STANDARD')")
    return values.exclude_list(v, out).select("p_partkey", "p_name")


@query("select distinct v, resource_id from (select value as v, resource_id from v where term in ('dcterms:publisher', 'dcterms:type'))")
def value_resources(d):
    return transform.value_resources(d.v, ["dcterms:publisher", "dcterms:type"])


@query("select c_custkey as id, case when c_custkey % 25 > 20 then null else 'N' || cast(c_custkey - c_custkey % 25 as varchar) end as title from customer where c_custkey > 0")
def distant_titles(d):
    """Each customer is titled by the one before it: after twenty links there is no title."""
    r = d.sql("select c_custkey as id, cast(null as string) as title from {customer} union all select 0L, cast(null as string)")
    v = d.sql("select c_custkey as id, c_custkey as resource_id, 'dcterms:title' as term, if(c_custkey % 25 = 0, concat('N', c_custkey), null) as value, cast(null as string) as uri, if(c_custkey % 25 = 0, null, c_custkey - 1) as value_resource_id from {customer} union all select 0L, 0L, 'dcterms:title', 'N0', null, null")
    return hierarchy.resource_titles(r, v).where("id > 0").select("id", "title")


@query("select a.c_custkey as id, b.c_custkey as ancestor_id, a.c_custkey - b.c_custkey as depth from customer a join customer b on b.c_custkey < a.c_custkey and b.c_custkey >= a.c_custkey - 12 and a.c_custkey // 40 = b.c_custkey // 40")
def distant_ancestors(d):
    """Chains of forty, up to twelve steps."""
    edges = d.sql("select c_custkey as id, c_custkey - 1 as parent_id from {customer} where c_custkey % 40 <> 0")
    return hierarchy.ancestors(edges, 12).select("id", "ancestor_id", F.col("depth").cast("long").alias("depth"))


@query("select c_custkey as id, 0 as pos, c_name as label, lower(substr(n_name, 1, 2)) as lang from customer join nation on c_nationkey = n_nationkey union all select c_custkey, 1, c_mktsegment, null from customer")
def concept_labels(d):
    """Names and languages that stand in two tables, joined by place."""
    names = d.sql("select c_custkey as id, 0 as pos, c_name as name from {customer} union all select c_custkey, 1, c_mktsegment from {customer}")
    langs = d.sql("select c_custkey as id, 0 as pos, lower(substr(n_name, 1, 2)) as lang from {customer} join {nation} on c_nationkey = n_nationkey")
    return hierarchy.concept_tables(names, langs, d.sql("select c_custkey as id, c_nationkey as parent_id from {customer}"), [])[0]


@query("select p_partkey, case when p_size % 3 <> 0 then p_size end as west, case when p_size % 3 <> 0 then p_size + 2 end as north from part")
def geo_bounds(d):
    x = d.sql("select p_partkey, p_size, if(p_size % 3 = 0, concat(p_size, ',2,3'), concat(p_size, ', 1 , 7,', p_size + 2)) as t from {part}")
    b = metadata.geo_bounds(F.col("t"))
    return x.select("p_partkey", b["west"].cast("int").alias("west"), b["north"].cast("int").alias("north"))


@query("""select event_id as id, case when p_partkey is not null then 'media' when c_custkey is not null then 'items' else '' end as entity_name, case when p_partkey is not null then 2000000 + p_partkey when c_custkey is not null then 1000000 + c_custkey else 0 end as entity_id
    from events left join customer on user_id = c_custkey and c_custkey % 2 = 0 left join part on p_partkey = event_id and p_size > 25""")
def migrate_media_hits(d):
    """Hits on files, on items, and on what isn't known."""
    log = d.sql("select event_id as id, user_id as item, event_id as doc, year(ts) as year, month(ts) as month, day(ts) as day, hour(ts) as hour, minute(ts) as minute, cast(second(ts) as int) as second, cast(null as string) as referrer, event_type as ip from {events}")
    items = d.sql("select c_custkey as source_id, 1000000 + c_custkey as dest_id from {customer} where c_custkey % 2 = 0")
    return migrate.migrate_hits(log, items, d.sql("select p_partkey as source_id, 2000000 + p_partkey as dest_id from {part} where p_size > 25")).select("id", "entity_name", "entity_id")


@query("""with e as (select c_custkey from customer where c_custkey % 9 = 0) select m.mode, c_custkey as source_index from customer, (values ('continue_on_error'), ('stop_without_error')) m(mode) where (m.mode = 'continue_on_error' and c_custkey not in (select c_custkey from e)) or m.mode = 'stop_without_error'""")
def stop_policies(d):
    """All modes: nothing goes on of a dry run, or if there is an error that stops."""
    rows = d.sql("select c_custkey as source_index from {customer}")
    bad = rows.where("source_index % 9 = 0").select("source_index", F.lit("err").alias("severity"), F.lit("x").alias("message"))
    runs = {"continue_on_error": ("continue_on_error", bad), "dry": ("dry_run", bad), "stop": ("stop_on_error", bad), "stop_without_error": ("stop_on_error", bad.withColumn("severity", F.lit("warn")))}
    out = None
    for name, (mode, messages) in runs.items():
        x = checks.stop_policy(rows, messages, mode).select(F.lit(name).alias("mode"), "source_index")
        out = x if out is None else out.union(x)
    return out


@query("""select c_custkey as source_index, case when c_custkey % 3 = 0 and c_custkey > 0 then c_custkey - 1 else c_custkey end as id, c_custkey % 3 = 0 and c_custkey > 0 as conflict from customer""")
def first_match_conflicts(d):
    """The first term that finds a resource counts; ids that differ between terms are a conflict."""
    v = d.sql("select c_custkey as resource_id, 'a' as term, concat('A', c_custkey) as value, cast(null as string) as uri from {customer} union all select c_custkey, 'b', concat('B', c_custkey), cast(null as string) from {customer}")
    rows = d.sql("select c_custkey as source_index, 'a' as term, concat('A', if(c_custkey % 3 = 0, c_custkey - 1, c_custkey)) as identifier from {customer} union all select c_custkey, 'b', concat('B', c_custkey) from {customer}")
    return identifiers.first_match_per_resource(rows, v, ["a", "b"])


@query("select action, term, count(*) as n from (select 'append' as action, term from v union all select 'append', term from new where not exists (select 1 from v where v.resource_id = new.resource_id and v.term = new.term and v.value = new.value) union all select 'replace', term from v where resource_id not in (select resource_id from new) union all select 'replace', term from new union all select 'update', term from v where not (resource_id in (select resource_id from new) and term in ('dcterms:subject', 'dcterms:spatial', 'dcterms:identifier')) union all select 'update', term from new union all select 'delete', term from v where resource_id not in (select resource_id from new)) group by action, term")
def upsert_actions(d):
    out = None
    for action in ("append", "replace", "update", "delete"):
        x = merge.upsert(d.v, d.new, action, ["dcterms:subject", "dcterms:spatial"]).groupBy("term").agg(F.count(F.lit(1)).alias("n")).select(F.lit(action).alias("action"), "term", "n")
        out = x if out is None else out.union(x)
    return out


@query("select resource_id, term, row_number() over (partition by resource_id order by case term when 'dcterms:type' then 1 when 'dcterms:title' then 2 when 'dcterms:spatial' then 3 end nulls last, id) as position from v")
def reorder_all_values(d):
    order = d.spark.createDataFrame([("dcterms:type", 1), ("dcterms:title", 2), ("dcterms:spatial", 3)], "term string, position int")
    return values.reorder_values(d.v, order).select("resource_id", "term", F.col("position").cast("long").alias("position"))


@query("select p_partkey, p_name || '.jpg' as file, case when p_size % 2 = 0 then p_name else p_type end as name, 'http://x/' || p_name || '.jpg?a#b' as url from part")
def asset_names(d):
    x = d.sql("select p_partkey, p_name, p_type, if(p_size % 2 = 0, '  ', p_type) as own, concat('http://x/', p_name, '.jpg?a#b') as source from {part}")
    none = F.lit("")
    return x.select("p_partkey", metadata.asset_name(none, F.col("source"), "filename").alias("file"), metadata.asset_name(F.col("own"), F.col("source"), "name").alias("name"), metadata.asset_name(none, F.col("source"), "url").alias("url"))


@query("select entity, cast(count(*) as bigint) as n, cast(min(dest_id) as bigint) as least from (select 'customers' as entity, c_custkey + 7 as dest_id from customer union all select 'parts', p_partkey * 2 from part) group by entity")
def write_id_map(d):
    """Id maps written with a folder for each entity and read again."""
    path = store.scratch(d.spark)
    sources.write_id_map(d.sql("select 'customers' as entity, cast(c_custkey as string) as source_id, c_custkey + 7 as dest_id from {customer} union all select 'parts', cast(p_partkey as string), p_partkey * 2 from {part}"), path)
    return d.spark.read.parquet(path).groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.min("dest_id").cast("long").alias("least"))


@query("select c_custkey as resource_id, c_mktsegment as value, case when c_custkey % 20 = 0 then '=' else '-' end as diff from customer")
def write_diff(d):
    """A diff written as JSON and read again: stored segments."""
    path = store.scratch(d.spark)
    merge.write_diff(merge.diff_resources(d.v.where("term = 'dcterms:subject'"), d.new.where("term = 'dcterms:subject'")), path)
    return d.spark.read.schema("resource_id long, value string, diff string").json(path).where("diff <> '+'")


@query("select source_index, 'err' as severity, 'line one  line two' as message from (select c_custkey as source_index from customer where c_custkey % 5 = 0)")
def write_check_log(d):
    path = store.scratch(d.spark)
    checks.write_check_log(d.sql("select c_custkey as source_index, 'err' as severity, 'line one\\nline two Stack trace: x' as message from {customer} where c_custkey % 5 = 0"), path)
    return d.spark.read.option("sep", "\t").option("header", True).schema("source_index long, severity string, message string").csv(path)


@query("select p_partkey, p_name from part where p_size > 10")
def export_table(d):
    path = store.scratch(d.spark)
    sources.export_table(d.sql("select p_partkey, p_name, if(p_size > 10, p_type, '') as kind from {part}"), path, ["kind"])
    return d.spark.read.option("sep", "\t").option("header", True).schema("p_partkey int, p_name string, kind string").csv(path).select("p_partkey", "p_name")


@query("select row_number() over (order by s, k) as source_index, name, brand from (select 1 as s, p_partkey as k, p_name as name, null as brand from part union all select 2, p_partkey, null, p_brand from part) where true qualify source_index > 5 and source_index <= 5 + 3 * (select count(*) from part) // 2")
def union_and_limit(d):
    """Two sources with other columns, numbered on, without the first entries and then half as many as there are."""
    a, b = d.sql("select p_partkey + 1 as source_index, array(p_name) as name from {part}"), d.sql("select p_partkey + 1 as source_index, array(p_brand) as brand from {part}")
    n = a.count()
    got = sources.limit_entries(sources.union_sources([a, b]), 5, 3 * n // 2)
    return got.select(F.col("source_index").cast("long").alias("source_index"), F.get("name", F.lit(0)).alias("name"), F.get("brand", F.lit(0)).alias("brand"))


@query("select p_partkey, p_brand || ' : ' || p_name as x, strftime(date '2001-02-03', '%d/%m/%Y') as day, '15h0m27s' as time, 'W 24°12’7”' as place from part")
def record_filters(d):
    x = d.sql("select p_partkey, p_name, p_brand, '2001-02-03' as t from {part}")
    return x.select("p_partkey", F.concat_ws(" : ", "p_brand", "p_name").alias("x"), patterns.date(F.col("t"), "dd/MM/yyyy").alias("day"), patterns.unimarc_time_hexa(F.lit("150027")).alias("time"), patterns.unimarc_coordinates(F.lit("w0241207")).alias("place"))


@query("""select c_custkey, c_name || ', ' || n_name || ' (' || c_mktsegment || ')' as person, c_name || ', ' || n_name || ' {' || c_mktsegment || '}' as body from customer join nation on n_nationkey = c_nationkey""")
def name_filters(d):
    x = d.sql("select c_custkey, c_name, n_name, c_mktsegment from {customer} join {nation} on n_nationkey = c_nationkey")
    c = F.col
    return x.select("c_custkey", patterns.isbd_name(a=c("c_name"), b=c("n_name"), g=c("c_mktsegment")).alias("person"), patterns.isbd_name_coll(a=c("c_name"), b=c("n_name"), o=c("c_mktsegment")).alias("body"))


@query("""with c as (select p_partkey, 'cb' || lpad(cast(p_partkey as varchar), 8, '0') || 'x' as c from part) select p_partkey, substr('0123456789bcdfghjkmnpqrstvwxz', cast(1 + list_sum(list_transform(range(1, 12), lambda i: i * greatest(strpos('0123456789bcdfghjkmnpqrstvwxz', substr(c, i, 1)) - 1, 0))) % 29 as bigint), 1) as mark from c""")
def noid_check(d):
    return d.sql("select p_partkey, concat('cb', lpad(p_partkey, 8, '0'), 'x') as c from {part}").select("p_partkey", patterns.noid_check(F.col("c")).alias("mark"))


@query("select p_partkey, p_name as title, p_brand as brand from part")
def read_xml(d):
    """Elements of a file as rows, with an attribute."""
    path = _written(d, d.sql("select p_partkey as at, concat('<resource brand=\"', p_brand, '\"><title>', p_name, '</title><key>', p_partkey, '</key></resource>') as line from {part} union all select -1, '<resources>' union all select 1L << 60, '</resources>'"))
    return sources.read_xml(d.spark, path).select(F.col("key").cast("int").alias("p_partkey"), "title", F.col("_brand").alias("brand"))


@query("select o_orderkey, c_name from orders join customer on c_custkey = o_custkey where o_orderstatus = 'O' and c_mktsegment <> 'BUILDING'")
def read_table(d):
    """A table with its joins and filters, cut to two columns."""
    return sources.read_table(d.sql("select * from {orders}"), ["o_orderstatus = 'O'", "c_mktsegment <> 'BUILDING'"], [(d.sql("select c_custkey as o_custkey, c_name, c_mktsegment from {customer}"), "o_custkey")], ["o_orderkey desc"], ["o_orderkey", "c_name"])


@query("""select p_partkey as source_index, 'err' as severity, 'no type fits: ' || case when p_size % 3 = 0 then p_name else 'P' || cast(p_partkey as varchar) end as message from part where p_size % 3 = 0 or p_size % 3 = 1""")
def choose_datatype_messages(d):
    """Texts that are neither a number nor a known resource, without a fallback: sizes are, names and unknown identifiers aren't."""
    m = d.sql("select p_partkey as source_index, array('numeric:integer', 'resource:item') as types, case p_size % 3 when 0 then p_name when 1 then concat('P', p_partkey) else cast(p_size as string) end as raw from {part}")
    known = d.sql("select s_name as identifier, 100000000 + s_suppkey as id, 'items' as resource_name from {supplier}")
    return checks.choose_datatype(m, known)[1]


@query("""select c_custkey as resource_id, 'dcterms:subject' as term, case when c_custkey % 20 = 0 then '' else c_mktsegment end as removed, case when c_custkey % 20 = 0 then c_mktsegment else '' end as kept, case when c_custkey % 20 = 0 then '' else 'NEW ' || c_mktsegment end as added from customer union all select c_custkey, 'dcterms:identifier', '', c_name, '' from customer""")
def diff_columns(d):
    """A diff as a row for each property of a resource, with its removed, kept and added texts."""
    return merge.diff_matrix(merge.diff_resources(d.v, d.new), ["dcterms:subject", "dcterms:identifier"], "column").where("resource_id < 100000000")
