"""Dates and text patterns, case by case."""

import calendar
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from colophon import dates, patterns


def one(spark, c, value="x"):
    return spark.createDataFrame([(value,)], "v string").select(c(F.col("v"))).first()[0]


@pytest.mark.parametrize(("text", "first", "last"), [("1890", (1890, 1, 1, 0, 0, 0), (1890, 12, 31, 23, 59, 59)), ("2024-02", (2024, 2, 1, 0, 0, 0), (2024, 2, 29, 23, 59, 59)), ("1900-02", (1900, 2, 1, 0, 0, 0), (1900, 2, 28, 23, 59, 59)), ("1999-12-31T10", (1999, 12, 31, 10, 0, 0), (1999, 12, 31, 10, 59, 59)), ("2001-02-31", (2001, 3, 3, 0, 0, 0), (2001, 3, 3, 23, 59, 59))])
def test_instants(spark, text, first, last):
    for want, flag in ((first, True), (last, False)):
        got = one(spark, lambda c, flag=flag: dates.iso_parse(c, flag), text)
        assert got["epoch"] == calendar.timegm(datetime(*want, tzinfo=timezone.utc).timetuple())
    assert one(spark, lambda c: dates.iso_format(dates.iso_parse(c)), text) == text


@pytest.mark.parametrize(("text", "epoch"), [("1970-01-01T05:00+05", 0), ("1970-01-01T00:00-05:30", 19800), ("1970-01-01T00Z", 0), ("-0001-01-01", -62198755200), ("0000", -62167219200), ("12000", 316516204800), ("292277026595", 2**63 - 1 - (703 * 86400 + 55807))])
def test_epochs(spark, text, epoch):
    assert one(spark, dates.iso_parse, text)["epoch"] == epoch


@pytest.mark.parametrize("text", ["", "x", "1999-13", "1999-01-32", "1999-01T10", "1999Z", "1999-01-01T24", "1999-01-01T10+24", "99999999999999999999", None, " 1999"])
def test_no_dates(spark, text):
    assert one(spark, dates.iso_parse, text) is None


def test_generated_code(spark, capsys):
    """A text is matched once, so the code that Spark makes stays below the 8,000 bytes of a method up to which the JVM compiles it."""
    texts = spark.range(1).select(F.col("id").cast("string").alias("v"))
    parsed = dates.iso_parse(F.col("v"))
    for c in (parsed, dates.iso_format(parsed), F.when(F.col("v") > "1", parsed)):
        texts.select(c.alias("c")).explain(mode="codegen")
        sizes = re.findall(r"maxMethodCodeSize:(-?[0-9]+)", capsys.readouterr().out)
        assert sizes and all(0 < int(n) < 8000 for n in sizes)


def test_database_dates(spark):
    text = lambda tz=None: lambda c: dates.full_date(dates.sql_datetime(c, tz))
    cases = {"2020-05-06 07:08:09": "2020-05-06T07:08:09", "2020-05-06T00:00:00.123": "2020-05-06", "86461": "1970-01-02T00:01:01", "0000-00-00 00:00:00": None, "2038-01-01": None, "1970-01-01 01:00:00": None, "0999-01-01": None, "": None, "abc": None, "0": None}
    assert {k: one(spark, text(), k) for k in cases} == cases
    assert one(spark, text("Europe/Paris"), "2020-07-01 01:30:00") == "2020-06-30T23:30:00"


def test_implode(spark):
    lit = lambda *a: dates.implode_date(*(F.lit(x).cast("string") for x in a))
    got = [one(spark, lambda c, a=a: lit(*a)) for a in ((1999, None), (1999, 5, None), (1999, 5, 6, 7, 8, 9), (0, 1), (None, 5), (1999, None, 3), (None, None, None, None, None, None, 60))]
    assert got == ["1999", "1999-05", "1999-05-06T07:08:09", None, None, None, "1970-01-01T00:01:00"]


def test_timestamp_index(spark):
    v = spark.createDataFrame([(1, 1, "t", "numeric:timestamp", "1970-01"), (2, 1, "t", "numeric:timestamp", "soon"), (3, 2, "t", "literal", "soon")], "id long, resource_id long, term string, type string, value string")
    index, kept, bad = dates.numeric_timestamp_index(v)
    assert [tuple(r) for r in index.collect()] == [(1, "t", 0)]
    assert {(r["id"], r["type"]) for r in kept.collect()} == {(1, "numeric:timestamp"), (2, "literal"), (3, "literal")}
    assert [r[0] for r in bad.collect()] == ["soon"]


@pytest.mark.parametrize(("f", "text", "want"), [
    (patterns.date_iso, "d1605110512", "1605-11-05T12"), (patterns.date_iso, "[1984]-", "[1984]-"), (patterns.date_iso, "c0044", "-0044"), (patterns.date_iso, "19uu", "19uu"), (patterns.date_iso, " 1984", "1984"),
    (patterns.date_revert, "5/6/21", "2021-06-05"), (patterns.date_revert, "05061999", "1999-06-05"), (patterns.date_revert, "050699", "2099-06-05"), (patterns.date_sql, "19850901141236.0", "1985-09-01 14:12:36"),
    (patterns.unimarc_coordinates, "w0241207", "W 24°12’7”"), (patterns.unimarc_coordinates, "+0100000", "N 10°0’0”"), (patterns.unimarc_time_hexa, "150027", "15h0m27s"), (patterns.unimarc_time_hexa, "000500", "5m"),
    (patterns.date, "1970-01-02", "86400"), (patterns.date, "soon", "soon"), (patterns.length, "été", 3),
])
def test_filters(spark, f, text, want):
    assert one(spark, f, text) == want


def test_names(spark):
    f = lambda **k: {n: F.lit(x) for n, x in k.items()}
    assert one(spark, lambda c: patterns.isbd_name(**f(a="Hugo", b="Victor", c="poet", f="1802-1885", o="1", i5="X"))) == "Hugo, Victor (1802-1885 ; poet) {1}, X"
    assert one(spark, lambda c: patterns.isbd_name_coll(**f(a="Body", g="", h="part", e="Rome", c="no"))) == "Body (part), Rome (no)"
    assert one(spark, lambda c: patterns.isbd_mark(**f(a="M", b="x", c="y"))) == "M, x (y)"


@pytest.mark.parametrize(("pattern", "want"), [("a {{ value|trim|upper }} b", "a XY b"), ("{{other}}-{{ value|trim }}", "o-xy"), ("{{ value|trim|slice(1, 1) }}", "y"), ("{{ value|trim|table({'xy': 'label'}) }}", "label"), ("{{ value|trim|replace({'x': '|'}) }}", "|y"), ("none", "none"), ("{{ unknown }}", ""), ("{{ upper }}", " XY ")])
def test_pattern(spark, pattern, want):
    assert one(spark, lambda c: patterns.apply_pattern(pattern, c, {"other": F.lit("o")}), " xy ") == want
