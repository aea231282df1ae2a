"""Titles through links and ancestors, by doubled ways."""

from pyspark.sql import functions as F

from colophon import hierarchy, schema, transform, values


def chain(spark, n, last="end"):
    """Resource i is titled by resource i - 1; resource 0 has the text."""
    v = [(i, i, "dcterms:title", "resource:item" if i else "literal", None if i else last, None, i - 1 if i else None, None, True) for i in range(n)]
    return spark.createDataFrame([(i, None) for i in range(n)], "id long, title string"), spark.createDataFrame(v, schema.VALUE)


def titles(df):
    return {r["id"]: r["title"] for r in df.collect()}


def test_titles_are_twenty_links_away_at_most(spark):
    r, v = chain(spark, 24, " end ")
    got = titles(hierarchy.resource_titles(r, v))
    assert all(got[i] == "end" for i in range(21)) and all(got[i] is None for i in (21, 22, 23))


def test_cycles_blank_titles_and_lost_links(spark):
    rows = [(1, 1, None, None, 2), (2, 2, None, None, 3), (3, 3, None, None, 1), (4, 4, " ", "http://x", None), (5, 5, "", "http://y", 1), (6, 6, None, None, 99), (7, 7, None, None, 5)]
    v = spark.createDataFrame([(i, r, "dcterms:title", None, t, u, to, None, True) for i, r, t, u, to in rows], schema.VALUE)
    got = titles(hierarchy.resource_titles(spark.createDataFrame([(i, None) for i in range(1, 9)], "id long, title string"), v))
    assert got == {1: None, 2: None, 3: None, 4: None, 5: "http://y", 6: None, 7: "http://y", 8: None}


def test_linked_resources_are_read_by_the_term_of_the_first(spark):
    r = spark.createDataFrame([(1, None, "person"), (2, None, None), (3, "old", "unknown")], "id long, title string, template string")
    rows = [(1, "foaf:name", None, 2), (2, "foaf:name", "name", None), (2, "dcterms:title", "title", None), (3, "dcterms:title", "old", None)]
    v = spark.createDataFrame([(i, rid, t, None, x, None, to, None, True) for i, (rid, t, x, to) in enumerate(rows)], schema.VALUE)
    t = spark.createDataFrame([("person", "foaf:name"), ("none", None)], "label string, title_term string")
    got = {x["id"]: (x["title"], x["changed"]) for x in hierarchy.resource_titles(r, v, templates=t).collect()}
    assert got == {1: ("name", True), 2: ("title", True), 3: ("old", False)}


def test_a_value_without_an_id_comes_last(spark):
    v = spark.createDataFrame([(None, 1, "dcterms:title", "literal", "appended", None, None, None, True), (5, 1, "dcterms:title", "literal", "stored", None, None, None, True), (None, 2, "dcterms:title", "literal", "b", None, None, None, True), (None, 2, "dcterms:title", "literal", "a", None, None, None, True)], schema.VALUE)
    assert {r["resource_id"]: r["value"] for r in values.first_value(v, ["dcterms:title"]).collect()} == {1: "stored", 2: "a"}
    assert titles(hierarchy.resource_titles(spark.createDataFrame([(1, "stored"), (2, None)], "id long, title string"), v)) == {1: "stored", 2: "a"}
    order = spark.createDataFrame([("x", 1)], "term string, position int")
    assert [r["value"] for r in values.reorder_values(v.where("resource_id = 1"), order).orderBy("position").collect()] == ["stored", "appended"]


def test_ancestors(spark):
    edges = [(i, i - 1) for i in range(1, 12)] + [(11, 3), (20, 21), (21, 20), (None, 1), (5, None)]
    rows = spark.createDataFrame(edges, "id long, parent_id long")
    up = {}
    for a, b in edges:
        if a is not None and b is not None:
            up.setdefault(a, set()).add(b)
    for depth in (1, 3, 10):
        want = {}
        for a in up:
            now = {a}
            for d in range(1, depth + 1):
                now = {b for x in now for b in up.get(x, ())}
                for b in now:
                    want.setdefault((a, b), d)
        assert {(r["id"], r["ancestor_id"]): r["depth"] for r in hierarchy.ancestors(rows, depth).collect()} == want


def test_new_values_have_ids_that_later_operations_see(spark):
    rows = [(7, 1, "a", "x / y"), (3, 2, "a", "x / z"), (9, 2, "t", "stored")]
    v = spark.createDataFrame([(i, r, t, "literal", x, None, None, None, True) for i, r, t, x in rows], schema.VALUE)
    mapper = spark.createDataFrame([("X", "b", "uri", "ex", "http://x", None, None, True), ("x", "b", "literal", "later", None, None, None, True)], "source string, term string, type string, value string, uri string, value_resource_id long, lang string, is_public boolean")
    steps = [{"action": "cut_value", "params": {"source": "a", "separator": "/", "dest1": "b", "dest2": "c"}}, {"action": "replace_table_update", "params": {"mapper": mapper, "source": "b"}}]
    got = transform.transform_pipeline(v, steps)
    ids = [r["id"] for r in got.collect()]
    assert None not in ids and len(ids) == len(set(ids)) == 5 and {i for i in ids if i > 9} == {10, 11}
    assert {(r["resource_id"], r["value"]) for r in got.where("term = 'b'").collect()} == {(1, "later"), (2, "later")}
    # of equal rows too
    twice = transform.append_raw_value(transform.append_raw_value(v, v.select(F.col("resource_id").alias("id")), ["a", "n"], "k"), v.select(F.lit(1).alias("id")), ["n"], "k")
    ids = [r["id"] for r in twice.collect()]
    assert len(ids) == len(set(ids)) == 8 and None not in ids


def test_operations_over_the_whole_state(spark):
    """The third step changes what the first made, and items join a set that a step made."""
    v = spark.createDataFrame([(1, 1, "dcterms:publisher", "literal", "Éditions A", None, None, None, True), (2, 2, "dcterms:publisher", "literal", "editions a", None, None, None, True), (3, 2, "dcterms:type", "literal", "map", None, None, None, True)], schema.VALUE)
    r = spark.createDataFrame([(1, "items", "one"), (2, "items", "two")], "id long, resource_name string, title string")
    none = spark.createDataFrame([], "item_id long, item_set_id long")
    suggested = spark.createDataFrame([("map", "http://v/map", "Map"), ("book", "http://v/b1", "b"), ("book", "http://v/b2", "b")], "source string, uri string, label string")
    steps = [
        {"action": "create_resource", "params": {"mapping": {"dcterms:type": "dcterms:identifier"}, "resource_name": "item_sets", "class_": "Set"}},
        {"action": "attach_item_set", "params": {"source": "dcterms:type"}},
        {"action": "modify_value", "params": {"source": "dcterms:identifier", "prefix": "set:"}},
        {"action": "convert_datatype", "params": {"source": "dcterms:type", "datatype": "valuesuggest:x", "mapping": suggested}},
        {"action": "create_resource", "params": {"mapping": {"dcterms:publisher": "foaf:name"}, "link": {"dcterms:publisher": "dcterms:publisher"}, "reciprocal": "foaf:made"}},
    ]
    got = transform.transform_state(transform.State(v, r, none), steps)
    assert [tuple(x) for x in got.item_sets.collect()] == [(2, 3)]
    assert {(x["id"], x["resource_name"], x["title"]) for x in got.resources.collect()} == {(1, "items", "one"), (2, "items", "two"), (3, "item_sets", "map"), (4, "items", "editions a"), (5, "items", "Éditions A")}
    rows = {(x["resource_id"], x["term"], x["type"], x["value"], x["uri"], x["value_resource_id"]) for x in got.values.collect()}
    assert {(3, "dcterms:identifier", "literal", "set:map", None, None), (2, "dcterms:type", "valuesuggest:x", "Map", "http://v/map", None), (1, "dcterms:publisher", "resource:item", None, None, 4)} <= rows
    assert (4, "foaf:made", "resource:item", None, None, 2) in rows
    ids = [x["id"] for x in got.values.collect()]
    assert None not in ids and len(ids) == len(set(ids))
    for bad in ({"action": "no_such"}, {"action": "convert_datatype", "params": {"source": "a", "datatype": "numeric:integer", "mapping": suggested}}):
        try:
            transform.transform_state(transform.State(v, r, none), [bad])
            raise AssertionError
        except ValueError:
            pass
