"""Readers: tables split into blocks, databases, lists and maps of configuration, and XML records."""

import random

import pytest
from pyspark.sql import functions as F

from colophon import migrate, patterns, sources, xml_values


def entries_of(df):
    fields = [c for c in df.columns if c != "source_index"]
    return sorted((r["source_index"], *(tuple(r[c]) for c in fields)) for r in df.collect())


def write(path, text):
    path.write_text(text, newline="")
    return f"file://{path}"


def random_table(rng, rows, end="\n"):
    cells = ["", "a", "b c", '"q, ""x"""', '"one\ntwo"', '"\n\n"', '"x,\n,y\n"', " pad ", "é", '"a\\"b"', "0"]
    out = ["name,text,name,last"]
    for _ in range(rows):
        out.append(",".join(rng.choice(cells) for _ in range(rng.choice([4, 4, 4, 2, 5]))))
        if rng.random() < 0.1:
            out.append("")
    return "﻿" + end.join(out) + end


@pytest.mark.parametrize("block", ["64b", "1k", "128m"])
def test_csv_of_many_blocks(spark, tmp_path, block):
    """A file that is cut anywhere, in cells too, gives the rows, in the order and with the numbers, that one task gives."""
    path = write(tmp_path / "a.csv", random_table(random.Random(4), 200))
    want = entries_of(sources.read_csv(spark, path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = sources.read_csv(spark, path, split=True)
        assert entries_of(got) == want and len(want) > 150
        if block == "1k":
            assert spark.read.text(path).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_files_with_headers_of_their_own(spark, tmp_path):
    write(tmp_path / "1.csv", "b,a\r\nx,\"1\r\n2\"\r\n\r\ny,2\r\n")
    write(tmp_path / "2.csv", "a,c,a\n3,z,4\n")
    write(tmp_path / "3.csv", "")
    write(tmp_path / "4.csv", "a,c,a\n5,\n,,\n")
    got = sources.read_csv(spark, f"file://{tmp_path}", split=True)
    assert sorted((r["source_index"], *(tuple(r[c]) for c in "abc")) for r in got.collect()) == [(1, ("1\n2",), ("x",), ()), (2, ("2",), ("y",), ()), (3, ("3", "4"), (), ("z",)), (4, ("5",), (), ()), (5, (), (), ())]
    assert sources.read_csv(spark, f"file://{tmp_path}/3.csv", split=True).count() == 0


def test_database_tables(spark):
    """Ranges of a key are read by many tasks, and filters go to the database."""
    url = "jdbc:derby:memory:colophon;create=true"
    spark.createDataFrame([(i, f"n{i % 7}", i % 3 if i % 5 else None) for i in range(1, 101)], "K long, NAME string, G long").write.format("jdbc").options(url=url, dbtable="things", createTableColumnTypes="NAME VARCHAR(20)").save()
    got = sources.read_jdbc(spark, url, "things", "k", 5, ["k > 20", "name <> 'n1'"])
    assert got.rdd.getNumPartitions() == 5
    plan = got.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(" in plan.replace(" ", "") or "20" in plan
    assert "name" not in plan.split("ReadSchema")[1].lower()
    assert {r["K"] for r in got.collect()} == {i for i in range(21, 101) if i % 7 != 1}
    assert sources.read_jdbc(spark, url, "things", filters=["k < 0"]).count() == 0 and sources.read_jdbc(spark, url, "things", "k", filters=["k < 0"]).count() == 0
    names = spark.createDataFrame([("n2", "two")], "NAME string, label string")
    table = sources.read_table(got, ["g is not null"], [(names, "NAME")], ["K desc"], ["K", "label"])
    assert [r["K"] for r in table.collect()] == [i for i in range(100, 20, -1) if i % 7 == 2 and i % 5]
    by = {r["NAME"]: [x["K"] for x in r["rows"]] for r in sources.rows_by(got, "NAME", ["K", "G"]).collect()}
    assert by["n3"] == [i for i in range(21, 101) if i % 7 == 3]


def test_lists_and_maps(spark, tmp_path):
    path = write(tmp_path / "l.txt", " a \n\nb\na\n")
    assert sorted(r["value"] for r in sources.read_list(spark, path).collect()) == ["a", "b"]
    path = write(tmp_path / "l.csv", 'head,x\n" a, b ",1\n,2\nc,3\n')
    assert sorted(r["value"] for r in sources.read_list(spark, path, ",").collect()) == ["a, b", "c"]
    e = sources.read_csv(spark, write(tmp_path / "m.csv", "From,To,n\na,t:x,1\nb,t:no,2\n,t:x,3\nd,,\n,,\n"))
    terms = spark.createDataFrame([("t:x",), ("t:y",)], "term string")
    rows, messages = sources.read_table_map(e, {"From": "source", "To": "destination"}, terms)
    assert [tuple(r) for r in rows.select("source", "destination", "n").collect()] == [("a", "t:x", "1")]
    assert sorted(tuple(r) for r in messages.collect()) == [(2, "warn", "unknown term: t:no"), (3, "warn", "a row without a source"), (4, "warn", "no destination: d")]
    assert sources.read_table_map(e)[0].count() == 4


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "y"), (4, "z", "x")], "i int, c string, d string")
    t = {"t": spark.createDataFrame([("a", "A2"), ("a", "A1"), (None, "N"), ("b", "B")], "code string, label string"), "u": spark.createDataFrame([("x", "X")], "code string, label string")}
    assert sorted(tuple(r) for r in patterns.lookup(df, {"c": "t", "d": "u"}, t).collect()) == [(1, "A1", "X"), (2, "B", None), (3, None, "y"), (4, "z", "X")]
    assert [r["d"] for r in patterns.lookup(df, {"d": "u"}, t, "other").orderBy("i").collect()] == ["X", None, "other", "X"]
    assert patterns.lookup(df, {"c": "t"}, t).columns == df.columns


XML = """<?xml version="1.0"?><!-- <resource>not one</resource> --><resources xmlns:o="http://o" xmlns:dcterms="http://d">
<resource o:is_public="false" o:template="Base">
  <dcterms:title xml:lang="fr"> A &lt;title&gt; </dcterms:title><dcterms:title/><dcterms:subject o:type="customvocab:3">s</dcterms:subject>
  <dcterms:description o:type="html"><p>in <b a='1"'>bold</b> &amp; more</p></dcterms:description>
  <dcterms:description o:type="rdf:HTML"><![CDATA[<p>raw</p>]]></dcterms:description>
  <dcterms:relation o:type="resource:item">12</dcterms:relation>
  <dcterms:date o:type="xsd:date" xml:lang="en">2001-02</dcterms:date><dcterms:date o:type="xsd:date">soon</dcterms:date>
  <dcterms:extent o:type="http://www.w3.org/2001/XMLSchema#integer">12 pages</dcterms:extent><dcterms:available o:type="xsd:boolean">off</dcterms:available>
  <dcterms:creator o:type="valuesuggest:x" o:label="Her" o:is_public="no">http://c</dcterms:creator><dcterms:other o:type="no:such">t</dcterms:other>
  <o:class>Book</o:class>
  <o:item_set><dcterms:title>A set</dcterms:title></o:item_set>
  <o:media o:ingester="url">http://m/1</o:media>
  <o:media o:is_public="0"><o:media o:ingester="html"><p>x</p></o:media><dcterms:title>Of the media</dcterms:title></o:media>
  <o:media></o:media>
</resource>
<resource><dcterms:title>Second</dcterms:title></resource><resource/>
<resource wrapper="1"><record><tag a="1">t</tag></record></resource>
<resource><broken></resource>
</resources>"""


def test_xml_records(spark, tmp_path):
    records = xml_values.read_xml_records(spark, write(tmp_path / "a.xml", XML)).withColumn("key", F.monotonically_increasing_id())
    assert records.count() == 5
    x = xml_values.extract_xml_values(records, "key").orderBy("key", "part", "pos").collect()
    first = [r for r in x if r["key"] == x[0]["key"]]
    got = [tuple(r)[4:] for r in first if r["part"] == 0]
    assert got == [
        ("field", "o:is_public", None, "false", None, None, None), ("field", "o:resource_template", None, "Base", None, None, None),
        ("property", "dcterms:title", "literal", "A <title>", None, "fr", None), ("property", "dcterms:subject", "customvocab:3", "s", None, None, None),
        ("property", "dcterms:description", "html", '<p>in <b a=\'1"\'>bold</b> &amp; more</p>', None, None, None), ("property", "dcterms:description", "html", "<p>raw</p>", None, None, None),
        ("error", "dcterms:relation", "resource:item", "12", None, None, None), ("property", "dcterms:date", "numeric:timestamp", "2001-02", None, None, None), ("property", "dcterms:date", "numeric:timestamp", "soon", None, None, None),
        ("property", "dcterms:extent", "numeric:integer", "12", None, None, None), ("property", "dcterms:available", "boolean", "0", None, None, None),
        ("property", "dcterms:creator", "valuesuggest:x", "Her", "http://c", None, False), ("property", "dcterms:other", "literal", "t", None, None, None), ("field", "o:resource_class", None, "Book", None, None, None),
    ]
    parts = {(r["part"], r["part_name"], r["term"], r["value"]) for r in first if r["part"]}
    assert parts == {
        (1, "o:item_set", "o:is_public", "1"), (1, "o:item_set", "o:is_open", "1"), (1, "o:item_set", "dcterms:title", "A set"),
        (2, "o:media", "o:ingester", "url"), (2, "o:media", "o:is_public", "1"), (2, "o:media", "o:source", "http://m/1"),
        (3, "o:media", "o:ingester", "html"), (3, "o:media", "o:is_public", "0"), (3, "o:media", "o:source", "<p>x</p>"), (3, "o:media", "dcterms:title", "Of the media"),
    }
    rest = [(r["kind"], r["term"], r["value"].split(":")[0]) for r in x if r["key"] != first[0]["key"]]
    assert rest == [("property", "dcterms:title", "Second"), ("property", "tag", "t"), ("error", None, "not well formed")]
    v = {(r["term"], r["type"], r["value"]) for r in xml_values.xml_values(xml_values.extract_xml_values(records, "key"), "key").collect()}
    assert ("dcterms:date", "literal", "soon") in v and ("dcterms:date", "numeric:timestamp", "2001-02") in v


def test_migrations_that_cannot_be(spark):
    a, b = spark.createDataFrame([(1, 2), (2, None)], "id long, b long"), spark.createDataFrame([(2, 1), (3, 9)], "id long, a long")
    with pytest.raises(ValueError, match="circle"):
        migrate.migrate_tables({"a": a, "b": b}, {"a": "id", "b": "id"}, {"a": {"b": "b"}, "b": {"a": "a"}})
    with pytest.raises(ValueError, match="no table"):
        migrate.migrate_tables({"a": a}, {"a": "id"}, {"a": {"b": "b"}})
    with pytest.raises(ValueError, match="2 different"):
        migrate.migrate_tables({"a": a.union(a.limit(1))}, {"a": "id"}, {})
    # a table may refer to itself; links of several kinds are tried in order
    tree = spark.createDataFrame([(1, None, "2"), (2, 1, "5"), (5, 7, "1")], "id long, parent long, link string")
    got = migrate.migrate_tables({"tree": tree, "b": b}, {"tree": "id", "b": "id"}, {"tree": {"parent": "tree", "link": ["b", "tree"]}}, {"tree": spark.createDataFrame([(5,), (10,)], "id long")})
    assert sorted((r["id"], r["parent"], r["link"]) for r in got.tables["tree"].collect()) == [(11, None, 2), (12, 11, 13), (13, None, 11)]
    assert [tuple(r) for r in got.unknown.collect()] == [("tree", "parent", "7", 1)]
