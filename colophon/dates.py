"""ISO 8601 dates of reduced accuracy and any year, kept as text with an epoch in seconds beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Years whose epoch fits 64 bits, and dates that stand for "unknown" in databases (fixed values).
YEARS = (-292277022656, 292277026595)
UNKNOWN_DATES = ("0000-00-00", "2038-01-01")

#: Year, month, day, hour, minute, second and offset, each in its range: an hour needs a day and an offset a time.
_ISO = (r"^(-?\d+)(?:-(0[1-9]|1[0-2])(?:-(0[1-9]|[12]\d|3[01])(?:T([01]\d|2[0-3]))?)?)?(?::([0-5]\d))?(?::([0-5]\d))?"
        r"((?<=[T:]\d\d)(?:[+-](?:[01]\d|2[0-3])(?::?[0-5]\d)?|:?(?:[01]\d|2[0-3])|Z))?$")  # fmt: skip
_PARTS = {"year": "long", "month": "int", "day": "int", "hour": "int", "minute": "int", "second": "int", "offset": "string"}
#: Days and years of the Gregorian calendar's cycle.
_CYCLE_DAYS, _CYCLE = 146097, 400


def _once(col: Column, made: Callable[[Column], Column]) -> Column:
    """made(col), with col worked out once for each row, however often made takes it: Spark would write it out at each place."""
    return F.transform(F.array(col), made)[0]


def iso_parse(col: Column, default_first: bool = True) -> Column:
    """Struct (year, month, day, hour, minute, second, offset, epoch, precision), null unless the text is such a date.

    Parts that the text lacks are null; the epoch takes the first instant of the period, or the last one if not default_first. An hour
    needs a day and an offset a time. Days up to 31 fit each month and run on into the next. precision counts the parts, 1 to 6.
    """
    at = lambda c, low, high: F.coalesce(c, F.lit(low if default_first else high))

    def dated(p: Column) -> Column:
        year, month, day, hour, minute, second, offset = (p[n] for n in _PARTS)
        # the calendar repeats every 400 years, so a year of the cycle from 2000 on stands for all that share its place there
        alias = F.pmod(year, F.lit(_CYCLE)) + 2000
        first = F.make_date(alias.cast("int"), at(month, 1, 12), F.lit(1))
        d = F.coalesce(day, F.lit(1) if default_first else F.dayofmonth(F.last_day(first)))
        days = F.unix_date(first) + d - 1 + F.call_function("div", year - alias, F.lit(_CYCLE).cast("long")) * _CYCLE_DAYS
        digits = F.rpad(F.translate(offset, "+-:", ""), 4, "0")
        shift = (F.left(digits, F.lit(2)).cast("int") * 3600 + F.right(digits, F.lit(2)).cast("int") * 60) * F.when(F.startswith(offset, F.lit("-")), -1).otherwise(1)
        time = at(hour, 0, 23) * 3600 + at(minute, 0, 59) * 60 + at(second, 0, 59) - F.when(offset != "Z", shift).otherwise(0)
        epoch = F.try_add(F.try_multiply(days, F.lit(86400).cast("long")), time.cast("long"))
        precision = F.when(second.isNotNull(), 6).when(minute.isNotNull(), 5).when(hour.isNotNull(), 4).when(day.isNotNull(), 3).when(month.isNotNull(), 2).otherwise(1)
        return F.when((year >= YEARS[0]) & (year <= YEARS[1]), F.struct(*(p[n].alias(n) for n in _PARTS), epoch.alias("epoch"), precision.alias("precision")))

    # one match gives all parts; those that the text lacks, and all of other texts, are empty and so null
    parts = F.regexp_replace(col, f"(?s){_ISO}|^.*$", "$1,$2,$3,$4,$5,$6,$7,")
    return _once(F.from_csv(parts, ", ".join(f"{n} {t}" for n, t in (_PARTS | {"rest": "string"}).items())), dated)


def iso_format(parsed: Column) -> Column:
    """The text of an iso_parse struct, as precise as it is: years have four digits or more."""

    def text(p: Column) -> Column:
        year = F.when(p["year"] >= 1000, p["year"].cast("string")).otherwise(F.format_string("%s%04d", F.when(p["year"] < 0, "-").otherwise(""), F.abs(p["year"])))
        part = lambda mark, n: F.get(F.split(F.lit(" ".join(f"{mark}{i:02d}" for i in range(60))), " "), p[n])
        return F.when(p.isNotNull(), F.concat_ws("", year, *(part(a, n) for a, n in (("-", "month"), ("-", "day"), ("T", "hour"), (":", "minute"), (":", "second"))), p["offset"]))

    return _once(parsed, text)


def sql_datetime(col: Column, timezone: str | None = None) -> Column:
    """Timestamp without zone of a database's date text or epoch, moved to UTC from timezone; null for placeholders and years outside 1000 to 9999."""
    text = F.nullif(F.trim(col.cast("string")), F.lit(""))
    day = F.left(text, F.lit(10))
    unknown = day.isin(*UNKNOWN_DATES) | ((day == "1970-01-01") & (F.substring(text, 14, 6) == ":00:00"))
    number = text.rlike(r"^[0-9]{1,12}$")
    written = F.left(F.translate(text, "T", " "), F.lit(19)).try_cast("timestamp_ntz")
    if timezone:
        written = F.convert_timezone(F.lit(timezone), F.lit("UTC"), written)
    counted = F.timestamp_add("SECOND", F.when(number, text).otherwise("0").cast("long"), F.lit("1970-01-01").cast("timestamp_ntz"))
    out = F.when(unknown | (text == "0"), None).when(number, counted).otherwise(written)
    return F.when(F.year(out).between(1000, 9999), out)


def full_date(col: Column) -> Column:
    """A timestamp as a date, with its time unless that is midnight."""
    return F.when(F.date_format(col, "HHmmss") == "000000", F.date_format(col, "yyyy-MM-dd")).otherwise(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss"))


def implode_date(year: Column, month: Column | None = None, day: Column | None = None, hour: Column | None = None, minute: Column | None = None, second: Column | None = None, epoch: Column | None = None) -> Column:
    """ISO text as deep as the last filled part; an epoch wins, and no year or an impossible date is null."""
    given = [c.try_cast("int") for c in (year, month, day, hour, minute, second) if c is not None]
    out, text = F.lit(None).cast("string"), None
    for c, mark, width in zip(given, ("", "-", "-", "T", ":", ":"), (4, 2, 2, 2, 2, 2)):
        piece = F.concat(F.lit(mark), F.lpad(F.coalesce(c, F.lit(0)).cast("string"), width, "0"))
        text = piece if text is None else F.concat(text, piece)
        out = F.when(c.isNotNull(), text).otherwise(out)
    out = F.when(F.coalesce(given[0], F.lit(0)) != 0, out)
    out = F.when(iso_parse(out).isNotNull(), out)
    if epoch is None:
        return out
    e = epoch.try_cast("long")
    at = F.date_format(F.timestamp_add("SECOND", F.coalesce(e, F.lit(0)), F.lit("1970-01-01").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.coalesce(e, F.lit(0)) != 0, at).otherwise(out)


def numeric_timestamp_index(v: DataFrame, report: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index (resource_id, term, epoch), v with unreadable timestamps as literals, the first few unreadable texts).

    Each text is parsed where it is; nothing is shuffled but the report.
    """
    parsed = v.withColumn("_p", F.when(F.col("type") == "numeric:timestamp", iso_parse(F.col("value"))))
    index = parsed.where("_p is not null").select("resource_id", "term", F.col("_p.epoch").alias("epoch"))
    bad = (F.col("type") == "numeric:timestamp") & F.col("_p").isNull()
    kept = parsed.withColumn("type", F.when(bad, "literal").otherwise(F.col("type"))).select(*v.columns)
    return index, kept, parsed.where(bad).select("value").distinct().orderBy("value").limit(report)
