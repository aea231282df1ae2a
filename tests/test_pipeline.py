"""An import from a file, then updates of what it made."""

from pyspark.sql import functions as F

from colophon import pipeline, schema, sources


def read(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return sources.read_csv(spark, f"file://{tmp_path}/{name}")


def rows(df):
    return sorted(tuple(r) for r in df.select("resource_id", "term", F.coalesce("value", "uri", F.col("value_resource_id").cast("string")).alias("v")).collect())


def unique_ids(df):
    ids = [r["id"] for r in df.select("id").collect()]
    return None not in ids and len(ids) == len(set(ids))


def nothing(spark):
    return schema.empty(spark, schema.VALUE), schema.empty(spark, "id long, resource_name string")


def test_sequence(spark, tmp_path):
    none, resources = nothing(spark)
    header = "dcterms:identifier,dcterms:title ~ {{ value|upper }},dcterms:relation ^^item ^^literal,dcterms:source ^^uri\n"
    got = pipeline.import_entries(read(spark, tmp_path, "a.csv", header + "a,one|two,,http://x\nb,three,nowhere,\n,,,\n,lost,,\n"), none, resources, ["dcterms:identifier"], separator="|", job_id=7)
    assert rows(got.values) == [(1, "dcterms:title", "LOST"), (2, "dcterms:identifier", "a"), (2, "dcterms:source", "http://x"), (2, "dcterms:title", "ONE"), (2, "dcterms:title", "TWO"), (3, "dcterms:identifier", "b"), (3, "dcterms:relation", "nowhere"), (3, "dcterms:title", "THREE")]
    assert {(r["job_id"], r["entity_id"]) for r in got.ledger.collect()} == {(7, 1), (7, 2), (7, 3)} and got.messages.count() == 0 and unique_ids(got.values)
    # ids are in the order of the source, so the first cell is the first value
    assert [r["value"] for r in got.values.where("term = 'dcterms:title'").orderBy("id").collect()] == ["ONE", "TWO", "THREE", "LOST"]

    again = pipeline.import_entries(read(spark, tmp_path, "b.csv", header + "a,,b,\nz,new,,\n"), got.values, got.resources, ["dcterms:identifier"], "revise", unidentified="skip")
    assert (2, "dcterms:relation", "3") in rows(again.values) and (2, "dcterms:title", "ONE") in rows(again.values) and unique_ids(again.values)
    assert [(r["source_index"], r["severity"]) for r in again.messages.collect()] == [(2, "warn")] and again.resources.count() == 3

    update = pipeline.import_entries(read(spark, tmp_path, "c.csv", header + "a,only,b,\n"), again.values, again.resources, ["dcterms:identifier"], "update")
    assert [r for r in rows(update.values) if r[0] == 2] == [(2, "dcterms:identifier", "a"), (2, "dcterms:relation", "3"), (2, "dcterms:title", "ONLY")]
    gone = pipeline.import_entries(read(spark, tmp_path, "d.csv", "dcterms:identifier\nb\n"), update.values, update.resources, ["dcterms:identifier"], "delete")
    # what linked to it doesn't any more
    assert [r for r in rows(gone.values) if r[0] != 1] == [(2, "dcterms:identifier", "a"), (2, "dcterms:title", "ONLY")] and gone.resources.count() == 2

    stop = pipeline.import_entries(read(spark, tmp_path, "e.csv", header + "a,x,,\nq,y,,\n"), gone.values, gone.resources, ["dcterms:identifier"], "append", mode="stop_on_error")
    assert rows(stop.values) == rows(gone.values) and stop.messages.where("severity = 'err'").count() == 1
    bare = pipeline.import_entries(read(spark, tmp_path, "g.csv", "o:id,dcterms:title\n2,bare\n"), gone.values, gone.resources, ["o:id"], "replace")
    assert [r for r in rows(bare.values) if r[0] == 2] == [(2, "dcterms:title", "bare")]


def test_links_within_a_table(spark, tmp_path):
    """To earlier and later entries and to the entry itself; of two entries with one identifier the last counts; a lost one is reported."""
    none, resources = nothing(spark)
    header = "dcterms:identifier,dcterms:alternative,dcterms:relation ^^item ^^literal,dcterms:date ^^integer\n"
    text = header + "x,,y,\ny,both,x,\nz,both,z,\nw,,both,\nq,,bad,\nbad,,x,no number\n"
    got = pipeline.import_entries(read(spark, tmp_path, "a.csv", text), none, resources, ["dcterms:identifier", "dcterms:alternative"], literal_fallback=False)
    ids = {r["value"]: r["resource_id"] for r in got.values.where("term = 'dcterms:identifier'").collect()}
    links = {(r["resource_id"], r["value_resource_id"]) for r in got.values.where("value_resource_id is not null").collect()}
    assert links == {(ids["x"], ids["y"]), (ids["y"], ids["x"]), (ids["z"], ids["z"]), (ids["w"], ids["z"])} and "bad" not in ids and "q" in ids
    assert sorted((r["source_index"], r["severity"]) for r in got.messages.collect()) == [(5, "warn"), (6, "err")]


def test_item_sets_and_media(spark, tmp_path):
    none, resources = nothing(spark)
    header = "dcterms:identifier,o:resource_name,o:item_set,o:media,o:item,dcterms:title\n"
    text = header + "set,Collection,,,,A set\nit,Item,set,http://x/a.jpg|b.jpg,,An item\nme,file,,,it,A media\nlost,item,nowhere,,,Lost\nalone,media,,,,Alone\nbad,thing,,,,Bad\n"
    got = pipeline.import_entries(read(spark, tmp_path, "a.csv", text), none, resources, ["dcterms:identifier"], separator="|")
    ids = {r["value"]: r["resource_id"] for r in got.values.where("term = 'dcterms:identifier'").collect()}
    assert set(ids) == {"set", "it", "me"} and {(r["id"], r["resource_name"]) for r in got.resources.collect()} >= {(ids["set"], "item_sets"), (ids["it"], "items"), (ids["me"], "media")}
    assert [tuple(r) for r in got.item_sets.collect()] == [(ids["it"], ids["set"])]
    media = sorted(((r["item_id"], r["ingester"] or "", r["source"] or "") for r in got.media.collect()))
    assert media == [(ids["it"], "", ""), (ids["it"], "sideload", "b.jpg"), (ids["it"], "url", "http://x/a.jpg")] and unique_ids(got.media)
    assert got.resources.where("resource_name = 'media'").count() == 3 and got.ledger.count() == 5
    assert sorted(r["source_index"] for r in got.messages.where("severity = 'err'").collect()) == [4, 5, 6]

    again = pipeline.import_entries(read(spark, tmp_path, "b.csv", "dcterms:identifier,o:media\nit,b.jpg|c.jpg\n"), got.values, got.resources, ["dcterms:identifier"], "append", separator="|", media=got.media, item_sets=got.item_sets)
    assert sorted(r["source"] for r in again.media.where("source is not null").collect()) == ["b.jpg", "c.jpg", "http://x/a.jpg"] and again.item_sets.count() == 1
    gone = pipeline.import_entries(read(spark, tmp_path, "c.csv", "dcterms:identifier\nit\n"), again.values, again.resources, ["dcterms:identifier"], "delete", media=again.media, item_sets=again.item_sets)
    assert [r["resource_name"] for r in gone.resources.collect()] == ["item_sets"] and gone.media.count() == gone.item_sets.count() == 0 and {r[0] for r in rows(gone.values)} == {ids["set"]}


def test_a_sequence_of_updates(spark, tmp_path):
    """One item, changed by every action in turn, with its media, item sets and single fields."""
    v, r = nothing(spark)
    state = pipeline.Import(v, r.selectExpr("*", "cast(null as string) as class", "cast(null as string) as template", "cast(null as boolean) as is_public"), None, None, None, None)
    n = 0

    def step(action, text, terms=("dcterms:identifier", "dcterms:title"), **how):
        nonlocal state, n
        n += 1
        state = pipeline.import_entries(read(spark, tmp_path, f"{n}.csv", text), state.values, state.resources, list(terms), action, separator="|", media=state.media, item_sets=state.item_sets, **how)
        assert unique_ids(state.values) and unique_ids(state.resources) and state.messages.where("severity = 'err'").count() == 0
        out = {}
        for x in state.values.where("resource_id = 1").orderBy("id").collect():
            out.setdefault(x["term"].removeprefix("dcterms:"), []).append(x["value"])
        return out

    def fields(i=1):
        x = state.resources.where(f"id = {i}").first()
        return x["class"], x["template"], x["is_public"]

    media = lambda: sorted(x["source"][-1] for x in state.media.collect())
    sets = lambda: sorted(x["item_set_id"] for x in state.item_sets.where("item_id = 1").collect())
    head = "dcterms:title,dcterms:description,dcterms:identifier,dcterms:publisher,dcterms:rights,dcterms:subject,o:media\n"
    new = step("create", "dcterms:title,dcterms:creator,dcterms:description,dcterms:subject,o:media\nPond,H,old,book|classic,http://m/1|http://m/2\n")
    assert new == {"title": ["Pond"], "creator": ["H"], "description": ["old"], "subject": ["book", "classic"]} and media() == ["1", "2"]
    step("create", "dcterms:identifier\nset1\nset2\nissn: 9\n", resource_name="item_sets")
    ids = {x["value"]: x["resource_id"] for x in state.values.where("term = 'dcterms:identifier'").collect()}
    assert step("skip", head + "Pond,SKIPPED,,,,,\n") == new
    got = step("append", head + "Pond|Pond; or,new,doc:p,T,,book|NE|wild,http://m/2|http://m/1\n")
    assert got == {"title": ["Pond", "Pond; or"], "creator": ["H"], "description": ["old", "new"], "identifier": ["doc:p"], "publisher": ["T"], "subject": ["book", "classic", "NE", "wild"]} and media() == ["1", "2"]
    got = step("revise", head + "Pond|Pond; or,All,doc:p,,PD|Ev,book|NE|wild|novel,\n")
    assert got == {"title": ["Pond", "Pond; or"], "creator": ["H"], "description": ["All"], "identifier": ["doc:p"], "publisher": ["T"], "rights": ["PD", "Ev"], "subject": ["book", "NE", "wild", "novel"]} and media() == ["1", "2"]
    got = step("update", head + "Pond|Pond; or,All,doc:p,,PD,book,http://m/1|http://m/2\n")
    assert got == {"title": ["Pond", "Pond; or"], "creator": ["H"], "description": ["All"], "identifier": ["doc:p"], "rights": ["PD"], "subject": ["book"]}
    got = step("replace", "dcterms:title,dcterms:creator,dcterms:description,o:media\nPond,T H,,http://m/3|http://m/2\n")
    assert got == {"title": ["Pond"], "creator": ["T H"]} and media() == ["2", "3"] and state.resources.where("resource_name = 'media'").count() == 2
    assert step("replace", "dcterms:title,dcterms:creator\nPond,T H\n") == got and media() == ["2", "3"]
    step("replace", "dcterms:identifier,o:resource_template,o:resource_class,o:is_public,dcterms:title\nset1,Base,Set,no,First\n")
    assert fields(ids["set1"]) == ("Set", "Base", False) and fields(ids["set2"]) == (None, None, None)
    whole = "dcterms:identifier,o:resource_template,o:resource_class,o:is_public,o:item_set,dcterms:title,dcterms:description,dcterms:description,dcterms:subject\n"
    got = step("replace", whole + "p,Base,,Yes,issn: 9,Pond|Pond; or,one|two,three,book\n")
    assert got == {"identifier": ["p"], "title": ["Pond", "Pond; or"], "description": ["one", "two", "three"], "subject": ["book"]} and fields() == (None, "Base", True) and sets() == [ids["issn: 9"]]
    got = step("append", whole + "p,,Text,,set2,Pond,two,,novel\n")
    assert got["description"] == ["one", "two", "three"] and got["subject"] == ["book", "novel"] and fields() == ("Text", "Base", True) and sets() == sorted([ids["issn: 9"], ids["set2"]])
    got = step("revise", whole + "p,,,No,set1,Pond (revised),,,\n")
    assert got["title"] == ["Pond (revised)"] and got["subject"] == ["book", "novel"] and fields() == ("Text", "Base", False) and len(sets()) == 3
    got = step("update", whole + "p,,Text,,set2,Pond|Pond; or,,,book\n")
    assert got == {"identifier": ["p"], "title": ["Pond", "Pond; or"], "subject": ["book"]} and fields() == ("Text", None, False) and sets() == [ids["set2"]]
    step("delete", "dcterms:title\nPond\n", terms=["dcterms:title"])
    assert state.values.where("resource_id = 1").count() == state.media.count() == state.item_sets.count() == 0 and state.resources.count() == 3
