"""Sources and entries against small files."""

import pytest

from colophon import entries, sources


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Title, Subject ,Title\nx," a, b ",y\n\n,,\nx,,x,beyond\nshort\n"two\nlines",0,\n')
    got = [tuple(r) for r in sources.read_csv(spark, f"file://{tmp_path}/a.csv").orderBy("source_index").collect()]
    assert got == [(1, ["x", "y"], ["a, b"]), (2, [], []), (3, ["x"], []), (4, ["short"], []), (5, ["two\nlines"], ["0"])]


def test_many_files_and_union(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for k in range(3):
        (tmp_path / f"t/{k}.tsv").write_text("A\n" + "".join(f'{k}"{i}\n' for i in range(40 * k + 5)))
    df = sources.read_tsv(spark, f"file://{tmp_path}/t")
    got = [(r[0], r[1][0]) for r in df.orderBy("source_index").collect()]
    assert got == list(enumerate((f'{k}"{i}' for k in range(3) for i in range(40 * k + 5)), 1))
    (tmp_path / "b.tsv").write_text("B\nz\n")
    both = sources.union_sources([df, sources.read_tsv(spark, f"file://{tmp_path}/b.tsv")])
    assert tuple(both.orderBy("source_index").collect()[-1]) == (len(got) + 1, [], ["z"])
    assert [r[0] for r in sources.limit_entries(both, 3, 2).orderBy("source_index").collect()] == [4, 5]


def test_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert sources.read_csv(spark, f"file://{tmp_path}/a.csv").count() == 0


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"d": {"items": [{"k": 1}, {"k": 2}]}}')
    assert {r["k"] for r in sources.read_json(spark, f"file://{tmp_path}/a.json", "d.items").collect()} == {1, 2}
    assert sources.read_json(spark, f"file://{tmp_path}/a.json", "d", single=True).columns == ["items"]


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<r><resource id="7"><t>x</t></resource><resource><t>y</t></resource></r>')
    assert {(r["_id"], r["t"]) for r in sources.read_xml(spark, f"file://{tmp_path}/a.xml").collect()} == {("7", "x"), (None, "y")}


def test_dump(spark, tmp_path):
    sources.export_table(spark.createDataFrame([("a", "x"), ("b", ""), ("c", None)], "k string, v string"), f"file://{tmp_path}/o", ["v"])
    assert [r[1] for r in sources.read_tsv(spark, f"file://{tmp_path}/o").collect()] == [["a"]]


@pytest.mark.parametrize(
    ("header", "want"),
    [
        ("Title", [entries.Target("Title")]),
        ("dcterms:title ^^item ^^literal @fr-FR §private", [entries.Target("dcterms:title", ("resource:item", "literal"), "fr-FR", False)]),
        ("dcterms:creator ^^literal @fr | foaf:name ^^uri", [entries.Target("dcterms:creator", ("literal",), "fr"), entries.Target("foaf:name", ("literal",), "fr")]),
        ('dcterms:subject ^^customvocab:"My list" ~ {{ value|upper }}', [entries.Target("dcterms:subject", ('customvocab:"My list"',), pattern="{{ value|upper }}")]),
        (" ", []),
    ],
)
def test_header(header, want):
    assert entries.parse_header(header) == want


def test_clean_and_melt(spark):
    df = spark.createDataFrame([(1, ["a; b;a", None, " "], None), (2, None, ["0"]), (3, [" "], [])], "source_index long, `x.y` array<string>, z array<string>")
    clean = entries.clean_entry(df, ";")
    assert [tuple(r) for r in clean.orderBy("source_index").collect()] == [(1, ["a", "b"], []), (2, [], ["0"]), (3, [], [])]
    assert [r[0] for r in entries.drop_empty_entries(clean).orderBy("source_index").collect()] == [1, 2]
    got = [tuple(r) for r in entries.melt(clean, {"x.y": "t @en | u", "z": ""}).orderBy("pos", "term").collect()]
    assert got == [(1, "x.y", p, t, [], "en", True, w) for p, w in ((0, "a"), (1, "b")) for t in "tu"]
    assert entries.melt(clean, {"x.y": "", "z": ""}).count() == 0


def test_header_pattern(spark):
    """A header's pattern changes each cell, with other fields' first cells at hand."""
    df = spark.createDataFrame([(1, ["a", "b"], ["z"]), (2, ["c"], [])], "source_index long, x array<string>, y array<string>")
    got = [tuple(r) for r in entries.melt(df, {"x": "t | u ~ {{ value|upper }}-{{ y }}", "y": ""}).select("source_index", "pos", "term", "raw").orderBy("source_index", "pos", "term").collect()]
    assert got == [(1, 0, "t", "A-z"), (1, 0, "u", "A-z"), (1, 1, "t", "B-z"), (1, 1, "u", "B-z"), (2, 0, "t", "C-"), (2, 0, "u", "C-")]
