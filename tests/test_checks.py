"""Checks and fields of resources on small rows."""

import pytest
from pyspark.sql import functions as F

from colophon import checks, metadata


def pairs(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_resources_and_policy(spark):
    rows = spark.createDataFrame([(1, "items", None), (2, "items", 7), (3, "boxes", None), (4, None, 1)], "source_index long, resource_name string, id long")
    got = checks.check_resources(rows, "create")
    assert pairs(got, "source_index", "severity") == [(2, "err"), (3, "err"), (4, "err"), (4, "err")]
    assert pairs(checks.check_resources(rows, "update", "skip"), "source_index", "severity") == [(1, "warn"), (3, "err"), (3, "warn"), (4, "err")]
    assert pairs(checks.check_resources(rows, "update", "create"), "source_index") == [(3,), (4,)]
    assert pairs(checks.stop_policy(rows, got, "continue_on_error"), "source_index") == [(1,)]
    assert checks.stop_policy(rows, got, "stop_on_error").count() == checks.stop_policy(rows, got, "dry_run").count() == 0
    assert checks.stop_policy(rows, got.limit(0), "stop_on_error").count() == 4
    with pytest.raises(ValueError, match="unknown mode"):
        checks.stop_policy(rows, got, "x")


def test_media_and_urls(spark):
    rows = spark.createDataFrame([(1, None, None, "http://a/b", "text/html; charset=utf-8", "HTML"), (2, 1, None, "gopher://a", "x", None), (3, None, 1, None, "image/png", "exe")], "source_index long, id long, item_id long, u string, media_type string, extension string")
    assert pairs(checks.check_media(rows, "create"), "source_index") == [(1,)] and checks.check_media(rows, "delete").count() == 0
    assert pairs(checks.check_urls(rows, "u"), "source_index") == [(2,), (3,)]
    got = checks.check_media_type_extension(rows, ["text/html"], ["html"])
    assert pairs(got, "source_index", "message") == [(2, "the extension is not allowed"), (2, "the media type is malformed"), (3, "the extension is not allowed"), (3, "the media type is not allowed")]


def test_typed(spark):
    cases = [("12", "numeric:integer", True), ("1.5", "numeric:integer", False), ("a", "numeric:integer", False), ("1999-05", "numeric:timestamp", True), ("1999/2000", "numeric:interval", True), ("2000/1999", "numeric:interval", False), ("2000", "numeric:interval", False), ("P1Y2MT3H", "numeric:duration", True), ("P", "numeric:duration", False), ("PT", "numeric:duration", False), ("ftp://x", "uri", True), ("x", "uri", False), ("x", "html", True), (None, "html", False)]
    df = spark.createDataFrame(cases, "v string, t string, want boolean")
    assert df.where(checks.valid_typed(F.col("v"), F.col("t")) != F.col("want")).collect() == []


def test_choice(spark):
    m = spark.createDataFrame([(1, "id1", ["resource:item", "literal"]), (2, "id1", ["resource:media"]), (3, "red", ["customvocab:2", "customvocab:1"]), (4, "x", ["uri"]), (5, "http://x y", ["uri"]), (6, "x", []), (7, "12", ["numeric:timestamp"])], "source_index long, raw string, types array<string>")
    known = spark.createDataFrame([("id1", 9, "items")], "identifier string, id long, resource_name string")
    vocab = spark.createDataFrame([("customvocab:1", "red")], "type string, term_value string")
    got, messages = checks.choose_datatype(m, known, vocab)
    assert {r["source_index"]: (r["type"], r["target_id"]) for r in got.collect()} == {1: ("resource:item", 9), 2: (None, None), 3: ("customvocab:1", None), 4: (None, None), 5: (None, None), 6: ("literal", None), 7: ("numeric:timestamp", None)}
    assert pairs(messages, "source_index", "severity") == [(2, "err"), (4, "err"), (5, "err")]
    got, messages = checks.choose_datatype(m, literal_fallback=True)
    assert {r["type"] for r in got.where("source_index < 6").collect()} == {"literal"} and messages.where("severity <> 'notice'").count() == 0


def test_files(spark, tmp_path):
    media = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, 5, "b"), (4, None, None)], "source_index long, id long, source string")
    kept, messages = checks.drop_missing_files(media, spark.createDataFrame([("a",), ("a",)], "source string"), True)
    assert pairs(kept, "source_index") == [(1,), (3,)] and pairs(messages, "source_index", "severity") == [(2, "warn"), (4, "warn")]
    log = spark.createDataFrame([(1, "err", "a\nb"), (2, "err", "c Stack trace: d")], "source_index long, severity string, message string")
    checks.write_check_log(log, f"file://{tmp_path}/log", 1)
    assert [tuple(r) for r in spark.read.csv(f"file://{tmp_path}/log", sep="\t", header=True).collect()] == [("1", "err", "a  b")]


def test_fields(spark):
    e = spark.createDataFrame([(1, ["no", "Yes"], ["1", "x"], ["a", "b"]), (2, [], ["5"], [])], "source_index long, p array<string>, n array<string>, s array<string>")
    got = metadata.coerce_metadata(e, {"p": "boolean", "n": "integer", "s": "strings"}).orderBy("source_index").collect()
    assert [tuple(r)[1:] for r in got] == [(True, None, ["a", "b"]), (None, 5, [])]
    one = lambda f, x: spark.createDataFrame([(x,)], "v string").select(f(F.col("v"))).first()[0]
    assert [one(metadata.normalize_resource_name, x) for x in ("Collection", " FILES ", "?")] == ["item_sets", "media", None]
    assert [tuple(one(lambda c: metadata.media_source(c, "https://i/"), x)) for x in ("<p>x</p>", "a/info.json", "https://youtu.be/1", "http://x/y", "d/", "f.png")] == [("html", "<p>x</p>"), ("iiif", "https://i/a/info.json"), ("oembed", "https://youtu.be/1"), ("url", "http://x/y"), ("sideload_dir", "d/"), ("sideload", "f.png")]
    assert tuple(one(metadata.geo_marker, "1.5 / -2")) == (1.5, -2.0) and one(metadata.geo_marker, "1/x") is None and tuple(one(metadata.geo_bounds, "1,2,3,4")) == (1.0, 2.0, 3.0, 4.0)
    assert [one(metadata.iso_language, x) for x in ("FR", "fra", "Zz")] == ["fra", "fra", "Zz"] and one(lambda c: metadata.iso_language(c, 2), "deu") == "de"
    assert [one(lambda c, m=m: metadata.asset_name(F.lit(" "), c, m), "http://a/b.c.png?x=/") for m in ("filename", "name", "none")] == ["b.c.png", "b.c", None]


def test_values(spark):
    v = spark.createDataFrame([(1, 1, "t", "xsd:date", "1999", None, None, None, True), (2, 1, "t", "xsd:date", "soon", None, None, None, True), (3, 1, "t", "odd:uri", None, "http://x", None, None, True), (4, 1, "t", "literal", "a", "u", None, None, True)], "id long, resource_id long, term string, type string, value string, uri string, value_resource_id long, lang string, is_public boolean")
    got = metadata.fallback_datatype(v, ["literal", "numeric:timestamp"])
    assert pairs(got, "id", "type", "value", F.coalesce("uri", F.lit("-"))) == [(1, "numeric:timestamp", "1999", "-"), (2, "literal", "soon", "-"), (3, "literal", "http://x", "-"), (4, "literal", "a", "u")]
    r = spark.createDataFrame([(1, None, None), (2, "c", "T"), (3, None, "U")], "id long, class string, template string")
    t = spark.createDataFrame([("T", "k")], "label string, class string")
    got, errors = metadata.default_class_template(r, t, template_="T")
    assert {tuple(x) for x in got.collect()} == {(1, "k", "T"), (2, "c", "T"), (3, None, "U")} and pairs(errors, "id") == [(3,)]
    nested = spark.createDataFrame([(1, [("uri", None, "http://x", "L", None)]), (2, [("resource", "t", None, None, 1), ("resource", None, None, None, 8)]), (3, None)], "`o:id` long, `dcterms:x` array<struct<type: string, `@value`: string, `@id`: string, `o:label`: string, value_resource_id: long>>")
    got, lost = metadata.flatten_resources(nested, ["dcterms:x", "other"], nested.select(F.col("`o:id`").alias("id")))
    assert {(x["resource_id"], x["value"], x["uri"], x["value_resource_id"]) for x in got.collect()} == {(1, "L", "http://x", None), (2, None, None, 1)} and pairs(lost, "resource_id", "target") == [(2, 8)]
