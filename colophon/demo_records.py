"""More queries over the driver's tables: checks, dates, patterns and fields of resources, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import checks, dates, entries, metadata, patterns
from .demo import query


@query("""select o_orderkey, cast(epoch(case o_orderkey % 3 when 0 then date_trunc('year', o_orderdate) when 1 then date_trunc('month', o_orderdate) else o_orderdate end) as bigint) as first,
    cast(case o_orderkey % 3 when 0 then epoch(date_trunc('year', o_orderdate) + interval 1 year) when 1 then epoch(date_trunc('month', o_orderdate) + interval 1 month) else epoch(o_orderdate) + 86400 end as bigint) - 1 as last, 3 - (2 - o_orderkey % 3) as precision from orders""")
def iso_parse(d):
    t = d.sql("select o_orderkey, date_format(o_orderdate, case o_orderkey % 3 when 0 then 'yyyy' when 1 then 'yyyy-MM' else 'yyyy-MM-dd' end) as t from {orders}")
    a = dates.iso_parse(F.col("t"))
    return t.select("o_orderkey", a["epoch"].alias("first"), dates.iso_parse(F.col("t"), False)["epoch"].alias("last"), a["precision"].cast("long").alias("precision"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as written from events")
def iso_format(d):
    t = d.sql("select event_id, date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") as t from {events}")
    return t.select("event_id", dates.iso_format(dates.iso_parse(F.col("t"))).alias("written"))


@query("select o_orderkey, case when o_orderkey % 5 = 0 then null else strftime(o_orderdate, '%Y-%m-%d') end as written from orders")
def sql_datetime(d):
    t = d.sql("select o_orderkey, case o_orderkey % 5 when 0 then '0000-00-00 00:00:00' when 1 then cast(unix_date(to_date(o_orderdate)) * 86400L as string) else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end as t from {orders}")
    return t.select("o_orderkey", dates.full_date(dates.sql_datetime(F.col("t"))).alias("written"))


@query("select event_id, case event_id % 4 when 0 then null when 1 then strftime(ts, '%Y') when 2 then strftime(ts, '%Y-%m') else strftime(ts, '%Y-%m-%d') end as written from events")
def implode_date(d):
    t = d.sql("select event_id, if(event_id % 4 = 0, 0, year(ts)) as y, if(event_id % 4 > 1, month(ts), null) as m, if(event_id % 4 = 3, day(ts), null) as dd from {events}")
    return t.select("event_id", dates.implode_date(F.col("y"), F.col("m"), F.col("dd")).alias("written"))


@query("select o_orderkey as resource_id, 'dcterms:date' as term, cast(epoch(o_orderdate) as bigint) as epoch from orders where o_orderkey % 4 <> 0")
def numeric_timestamp_index(d):
    v = d.sql("select o_orderkey as resource_id, 'dcterms:date' as term, 'numeric:timestamp' as type, if(o_orderkey % 4 = 0, 'undated', date_format(o_orderdate, 'yyyy-MM-dd')) as value from {orders}")
    return dates.numeric_timestamp_index(v)[0]


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as reverted, strftime(o_orderdate, '%Y-%m-%d') as iso, strftime(o_orderdate, '%Y-%m-%d 00:00:00') as sql from orders")
def date_filters(d):
    o = d.sql("select o_orderkey, date_format(o_orderdate, 'd/M/yyyy') as a, date_format(o_orderdate, \"'d'yyyyMMdd\") as b, date_format(o_orderdate, 'yyyyMMddHHmmss') as c from {orders}")
    return o.select("o_orderkey", patterns.date_revert(F.col("a")).alias("reverted"), patterns.date_iso(F.col("b")).alias("iso"), patterns.date_sql(F.col("c")).alias("sql"))


@query("select p_partkey, '[' || upper(p_name) || '] ' || p_type || case when p_brand = '' then '' else ' by ' || replace(p_brand, 'Brand', 'B') end as written, p_name || ', ' || p_brand || ' (' || p_type || ')' as name from part")
def apply_pattern(d):
    c = F.col
    made = patterns.apply_pattern("[{{ value|upper }}] {{type}} by {{ brand|replace({'Brand': 'B'}) }}", c("p_name"), {"type": c("p_type"), "brand": c("p_brand")})
    return d.sql("select * from {part}").select("p_partkey", made.alias("written"), patterns.isbd_mark(a=c("p_name"), b=c("p_brand"), c=c("p_type")).alias("name"))


@query("""select o_orderkey as source_index, 'err' as severity, 'unknown resource name' as message from orders where o_orderstatus = 'F'
    union all select o_orderkey, 'warn', 'no resource is identified' from orders where o_orderkey % 7 = 0""")
def check_resources(d):
    rows = d.sql("select o_orderkey as source_index, if(o_orderstatus = 'F', 'boxes', 'items') as resource_name, if(o_orderkey % 7 = 0, null, o_orderkey) as id from {orders}")
    return checks.check_resources(rows, "update", "skip")


@query("select l_orderkey * 10 + l_linenumber as source_index, 'err' as severity, 'the media has no item' as message from lineitem where l_returnflag = 'R'")
def check_media(d):
    return checks.check_media(d.sql("select l_orderkey * 10 + l_linenumber as source_index, cast(null as bigint) as id, if(l_returnflag = 'R', null, l_orderkey) as item_id from {lineitem}"), "create")


@query("select p_partkey as source_index, 'err' as severity, case p_partkey % 3 when 0 then 'the url is empty' else 'the url is not of a known scheme' end as message from part where p_partkey % 3 < 2")
def check_urls(d):
    return checks.check_urls(d.sql("select p_partkey as source_index, case p_partkey % 3 when 0 then ' ' when 1 then 'gopher://x' else concat('https://x/', p_partkey) end as u from {part}"), "u")


@query("select l_orderkey * 10 + l_linenumber as source_index, 'err' as severity, 'the media type is not allowed' as message from lineitem where l_returnflag = 'A' union all select l_orderkey * 10 + l_linenumber, 'err', 'the extension is not allowed' from lineitem where l_linestatus = 'O'")
def check_media_type_extension(d):
    rows = d.sql("select l_orderkey * 10 + l_linenumber as source_index, if(l_returnflag = 'A', 'text/css', 'Image/PNG; x=1') as media_type, if(l_linestatus = 'O', 'exe', 'PNG') as extension from {lineitem}")
    return checks.check_media_type_extension(rows, ["image/png"], ["png"])


@query("select l_orderkey, l_linenumber, l_linenumber % 2 = 1 as a, l_shipdate < timestamp '1996-01-01' as b, true as c from lineitem")
def validate_typed(d):
    rows = d.sql("select l_orderkey, l_linenumber, if(l_linenumber % 2 = 1, cast(l_orderkey as string), 'x1') as a, concat(date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\"), '/1995') as b, concat('P', l_linenumber, 'D') as c from {lineitem}")
    ok = lambda c, t: checks.valid_typed(F.col(c), t).alias(c)
    return rows.select("l_orderkey", "l_linenumber", ok("a", "numeric:integer"), ok("b", "numeric:interval"), ok("c", "numeric:duration"))


@query("select o_orderkey as source_index from orders where o_orderstatus <> 'F'")
def stop_policy(d):
    rows = d.sql("select o_orderkey as source_index, if(o_orderstatus = 'F', 'boxes', 'items') as resource_name, o_orderkey as id from {orders}")
    return checks.stop_policy(rows, checks.check_resources(rows, "update"), "continue_on_error").select("source_index")


@query("select o_orderkey as id from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def missing_subtype(d):
    rows = d.sql("select o_orderkey as id, 'items' as resource_name from {orders}")
    return checks.missing_subtype(rows, d.sql("select l_orderkey as id from {lineitem} where l_returnflag = 'R'"), "items").select("id")


@query("select p_partkey as id from part where p_size % 3 = 0")
def empty_assets(d):
    rows = d.sql("select p_partkey as id, if(p_size % 3 = 0, '', p_name) as name, cast(null as string) as media_type, '' as extension, cast(null as bigint) as owner_id from {part}")
    return checks.empty_assets(rows).select("id")


@query("select l_orderkey, l_linenumber from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus in ('O', 'P') and l_returnflag <> 'A'")
def status_filter(d):
    items, docs = d.sql("select o_orderkey as k, o_orderstatus from {orders}"), d.sql("select l_orderkey as k, l_linenumber, l_returnflag from {lineitem}")
    return checks.status_filter(items, docs, ["O", "P"], "k", "o_orderstatus", F.col("l_returnflag") == "A")[1].select(F.col("k").alias("l_orderkey"), "l_linenumber")


@query("select l_orderkey * 10 + l_linenumber as source_index from lineitem where l_linestatus = 'F' or l_partkey in (select p_partkey from part where p_size > 10)")
def drop_missing_files(d):
    media = d.sql("select l_orderkey * 10 + l_linenumber as source_index, if(l_linestatus = 'F', 1, null) as id, cast(l_partkey as string) as source from {lineitem}")
    return checks.drop_missing_files(media, d.sql("select cast(p_partkey as string) as source from {part} where p_size > 10"), True)[0].select("source_index")


@query("""with k as (select c_name, min(c_custkey) as id from customer where c_custkey % 2 = 0 group by c_name)
    select o_orderkey as resource_id, 'dcterms:creator' as term, case when k.id is null then 'literal' else 'resource:item' end as type, case when k.id is null then c.c_name end as value, k.id as value_resource_id from orders join customer c on o_custkey = c_custkey left join k on k.c_name = c.c_name
    union all select o_orderkey, 'dcterms:status', case when o_orderstatus = 'P' then 'literal' else 'customvocab:1' end, o_orderstatus, null from orders join customer on o_custkey = c_custkey""")
def choose_datatype(d):
    e = d.sql("select o_orderkey as source_index, array(c_name) as creator, array(o_orderstatus) as status from {orders} join {customer} on o_custkey = c_custkey")
    m = entries.melt(e, {"creator": "dcterms:creator ^^item ^^literal", "status": "dcterms:status ^^customvocab:1"})
    known = d.sql("select c_name as identifier, c_custkey as id, 'items' as resource_name from {customer} where c_custkey % 2 = 0")
    vocab = d.spark.createDataFrame([("customvocab:1", "F"), ("customvocab:1", "O")], "type string, term_value string")
    chosen, _ = checks.choose_datatype(m, known, vocab, literal_fallback=True)
    return metadata.fill_values(chosen.withColumnRenamed("source_index", "resource_id")).select("resource_id", "term", "type", "value", "value_resource_id")


@query("select o_orderkey as source_index, o_orderstatus = 'F' as is_public, o_custkey as owner_id, case o_orderkey % 3 when 0 then 'item_sets' when 1 then 'media' end as resource_name from orders")
def coerce_metadata(d):
    e = d.sql("select o_orderkey as source_index, array('?', if(o_orderstatus = 'F', 'Yes', 'private')) as is_public, array(cast(o_custkey as string)) as owner_id, array(case o_orderkey % 3 when 0 then 'Collection' when 1 then ' Files' else 'box' end) as resource_name from {orders}")
    out = metadata.coerce_metadata(e, {"is_public": "boolean", "owner_id": "integer", "resource_name": "string"})
    return out.withColumn("resource_name", metadata.normalize_resource_name(F.col("resource_name")))


@query("select c_custkey as resource_id, t.term, t.value from customer, (values ('dcterms:license', 'Public domain'), ('dcterms:rights', 'None')) t(term, value)")
def apply_defaults(d):
    got = metadata.apply_defaults(d.v.limit(0), d.sql("select c_custkey as resource_id from {customer}"), {"dcterms:license": "Public domain", "dcterms:rights": "None"})
    return got.select("resource_id", "term", "value")


@query("select p_partkey, case p_partkey % 4 when 0 then 'url' when 1 then 'sideload' when 2 then 'iiif' else 'html' end as ingester, case p_partkey % 4 when 0 then 'https://x/' || p_partkey when 1 then p_partkey || '.png' when 2 then 'https://i/' || p_partkey || '/info.json' else '<p>' || p_partkey || '</p>' end as source from part")
def media_from_value(d):
    p = d.sql("select p_partkey, case p_partkey % 4 when 0 then concat('https://x/', p_partkey) when 1 then concat(p_partkey, '.png') when 2 then concat(p_partkey, '/info.json') else concat('<p>', p_partkey, '</p>') end as s from {part}")
    return p.select("p_partkey", metadata.media_source(F.col("s"), "https://i/").alias("_m")).select("p_partkey", "_m.*")


@query("select resource_id, term, case when term = 'dcterms:type' then 'html' else 'literal' end as type, value from v")
def fallback_datatype(d):
    v = d.v.withColumn("type", F.when(F.col("term") == "dcterms:type", "rdf:HTML").when(F.col("term") == "dcterms:title", "xsd:date").otherwise(F.col("type")))
    return metadata.fallback_datatype(v, ["literal", "html", "numeric:timestamp"]).select("resource_id", "term", "type", "value")


@query("select c_custkey, cast(c_custkey as double) / 2 as lat, cast(c_nationkey as double) as lng, case c_nationkey % 3 when 0 then 'fra' when 1 then 'eng' else 'xx' end as lang from customer where c_custkey % 5 <> 0 union all select c_custkey, null, null, case c_nationkey % 3 when 0 then 'fra' when 1 then 'eng' else 'xx' end from customer where c_custkey % 5 = 0")
def places_and_languages(d):
    c = d.sql("select c_custkey, if(c_custkey % 5 = 0, 'nowhere', concat(c_custkey / 2, ' / ', c_nationkey)) as place, case c_nationkey % 3 when 0 then 'FR' when 1 then 'eng' else 'xx' end as l from {customer}")
    return c.select("c_custkey", metadata.geo_marker(F.col("place")).alias("_g"), metadata.iso_language(F.col("l")).alias("lang")).select("c_custkey", "_g.*", "lang")


@query("select p_partkey as id, coalesce(case when p_size % 2 = 0 then p_type end, case when p_brand < 'Brand#3' then 'bibo:Book' end) as class, case when p_brand < 'Brand#3' then 'Book' else 'Other' end as template from part")
def default_class_template(d):
    r = d.sql("select p_partkey as id, if(p_size % 2 = 0, p_type, null) as class, if(p_brand < 'Brand#3', 'Book', null) as template from {part}")
    t = d.spark.createDataFrame([("Book", "bibo:Book"), ("Other", None)], "label string, class string")
    return metadata.default_class_template(r, t, template_="Other")[0]


@query("select o_orderkey as resource_id, 'dcterms:creator' as term, case when o_custkey % 2 = 0 then null else 'c' || o_custkey end as value, case when o_custkey % 2 = 0 then o_custkey end as value_resource_id from orders where o_custkey % 6 <> 0")
def flatten_resources(d):
    nested = d.sql("select o_orderkey as `o:id`, array(named_struct('type', if(o_custkey % 2 = 0, 'resource', 'literal'), '@value', concat('c', o_custkey), 'value_resource_id', if(o_custkey % 2 = 0, o_custkey, null))) as `dcterms:creator` from {orders}")
    known = d.sql("select distinct o_custkey as id from {orders} where o_custkey % 3 <> 0")
    return metadata.flatten_resources(nested, ["dcterms:creator"], known)[0].select("resource_id", "term", "value", "value_resource_id")


@query("select distinct l_orderkey as resource_id, 'dcterms:format' as term, l_returnflag as value from lineitem")
def media_metadata_values(d):
    x = d.sql("select l_orderkey as resource_id, 'flag' as key, l_returnflag as value from {lineitem} union all select l_orderkey, 'line', l_linestatus from {lineitem}")
    return metadata.media_metadata_values(x, {"flag": "dcterms:format"}).select("resource_id", "term", "value")
