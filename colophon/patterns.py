"""Filters for small text patterns, each a Column from a Column."""

from __future__ import annotations

import ast
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What trim takes off unless told otherwise, and the alphabet of identifiers' check characters (fixed values).
TRIM_MASK = " \t\n\r\0\x0b"
NOID = "0123456789bcdfghjkmnpqrstvwxz"


def absolute(c: Column) -> Column:
    n = c.try_cast("double")
    return F.when(n.isNull(), c).otherwise(F.regexp_replace(c, "^\\s*-", ""))


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def title(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, " "), capitalize), " ")


def trim(c: Column, mask: str = TRIM_MASK, side: str = "both") -> Column:
    return {"both": F.btrim, "left": F.ltrim, "right": F.rtrim}[side](c, F.lit(mask))


def slice(c: Column, start: int, length: int = 1) -> Column:
    """Characters from a place counted from 0, or from the end if negative; a negative length leaves that many off."""
    from_ = F.lit(start) if start >= 0 else F.greatest(F.length(c) + start, F.lit(0))
    n = F.lit(length) if length >= 0 else F.greatest(F.length(c) - from_ + length, F.lit(0))
    return F.substr(c, (from_ + 1).cast("int"), n.cast("int"))


def first(c: Column) -> Column:
    return F.left(c, F.lit(1))


def last(c: Column) -> Column:
    return F.right(c, F.lit(1))


def implode(delimiter: str, *cs: Column) -> Column:
    return F.concat_ws(delimiter, *(F.coalesce(c, F.lit("")) for c in cs))


def implodev(delimiter: str, *cs: Column) -> Column:
    """As implode, without empty parts."""
    return F.concat_ws(delimiter, *(F.nullif(c, F.lit("")) for c in cs))


def escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def striptags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def url_encode(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def table(c: Column, codes: dict[str, str]) -> Column:
    """The label of a code; other values pass through."""
    return F.coalesce(F.create_map(*(F.lit(x) for kv in codes.items() for x in kv))[c], c) if codes else c


def lookup(df: DataFrame, columns: dict[str, str], tables: dict[str, DataFrame], default: str | None = None) -> DataFrame:
    """df with each column's codes replaced by the labels of its named table (code, label); the smallest label of several, and what a table
    doesn't have passes through, or becomes default. Codes are compared as they are. A table is joined, by a broadcast if Spark finds it small."""
    for col, name in columns.items():
        t = tables[name].where("code is not null").groupBy(F.col("code").alias("_code")).agg(F.min("label").alias("_label"))
        other = F.col(col) if default is None else F.when(F.col(col).isNotNull(), F.lit(default))
        df = df.join(t, df[col] == t["_code"], "left").withColumn(col, F.coalesce("_label", other)).drop("_code", "_label")
    return df


def date_sql(c: Column) -> Column:
    """yyyymmddhhmmss as yyyy-mm-dd hh:mm:ss."""
    return F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2}).*$", "$1-$2-$3 $4:$5:$6")


def coordinates_hexa(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"^(..)(..)(..).*$", "$1°$2’$3”")


def noid_check(c: Column) -> Column:
    """Check character: the sum of place times value of each character, modulo the alphabet's length; others count 0."""
    at = F.aggregate(F.transform(F.split(c, ""), lambda x, i: (F.greatest(F.position(x, F.lit(NOID)) - 1, F.lit(0)) * (i + 1)).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return F.substr(F.lit(NOID), (at % len(NOID) + 1).cast("int"), F.lit(1))


def length(c: Column) -> Column:
    return F.length(c)


def split(c: Column, delimiter: str, limit: int = -1) -> Column:
    """Pieces between delimiters; the last of `limit` pieces keeps the rest."""
    return F.split(c, re.escape(delimiter), limit)


def replace(c: Column, pairs: dict[str, str]) -> Column:
    for a, b in pairs.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def format(c: Column, *args: Column) -> Column:
    """A printf text with the arguments filled in."""
    return F.call_function("format_string", c, *args)


def date(c: Column, fmt: str | None = None) -> Column:
    """An ISO-like date written as fmt (Spark's letters), or as its epoch; other texts pass through."""
    at = c.try_cast("timestamp_ntz")
    out = F.date_format(at, fmt) if fmt else F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), at).cast("string")
    return F.coalesce(out, c)


def date_iso(c: Column) -> Column:
    """d1605110512 as 1605-11-05T12: d, +, space or nothing stands for our era, c or - for before it; texts with u or another start pass."""
    digits = F.regexp_replace(c, r"^[-+cd ]", "")
    sizes = ((1, 4, "-"), (5, 2, "-"), (7, 2, "T"), (9, 2, ":"), (11, 2, ":"), (13, 2, ""))
    written = F.concat(F.when(c.rlike("^[-c]"), "-").otherwise(""), *(x for at, n, mark in sizes for x in (F.substring(digits, at, n), F.lit(mark))))
    return F.when(c.contains("u") | ~c.rlike(r"^[-+cd 0-9]"), c).otherwise(F.regexp_replace(written, "[-:T |#]+$", ""))


def date_revert(c: Column) -> Column:
    """dd/mm/yyyy, with any sign between, or ddmmyyyy as yyyy-mm-dd; years of two digits are of this century."""
    t = F.trim(c)
    parts = F.filter(F.split(t, r"\D+"), lambda x: x != "")
    day, month, year = (F.coalesce(F.get(parts, i), F.lit("0")) for i in range(3))
    four = lambda y: F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    marked = F.concat_ws("-", F.lpad(four(year), 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    plain = F.concat_ws("-", four(F.substring(t, 5, 4)), F.substring(t, 3, 2), F.substring(t, 1, 2))
    return F.when(t.rlike(r"\D"), marked).otherwise(plain)


def _group(fields: dict[str, Column], names: str) -> Column:
    """" (x ; y)" of the filled fields, or nothing."""
    inner = F.concat_ws(" ; ", *(F.nullif(fields[n], F.lit("")) for n in names if n in fields))
    return F.when(inner != "", F.concat(F.lit(" ("), inner, F.lit(")"))).otherwise("")


def _isbd(fields: dict[str, Column], layout: str) -> Column:
    """Fields in the layout's order: a letter alone is ", x", letters in parentheses share a pair of them, one in braces has those."""
    out = [F.coalesce(fields.get("a", F.lit("")), F.lit(""))]
    for x in layout.split():
        if x[0] == "(":
            out.append(_group(fields, x[1:-1]))
        elif (n := x.strip("{}")) in fields:
            a, b = (" {", "}") if x[0] == "{" else (", ", "")
            out.append(F.when(F.coalesce(fields[n], F.lit("")) != "", F.concat(F.lit(a), fields[n], F.lit(b))).otherwise(""))
    return F.concat(*out)


def isbd_name(**fields: Column) -> Column:
    """A person by the subfields a b c d f g k o p i5."""
    return _isbd({n.removeprefix("i"): c for n, c in fields.items()}, "b (g) d (fck) {o} p 5")


def isbd_name_coll(**fields: Column) -> Column:
    """A body by the subfields a b c d e f g h o p r i5."""
    return _isbd({n.removeprefix("i"): c for n, c in fields.items()}, "b (gh) d e (fc) {o} p r 5")


def isbd_mark(**fields: Column) -> Column:
    """A mark by the subfields a b c."""
    return _isbd(fields, "b (c)")


def unimarc_index(c: Column, index: str) -> Column:
    """A code with its index: a link for rameau, a label for others."""
    if index == "rameau":
        ark = F.concat(F.lit("cb"), c)
        return F.concat(F.lit("https://data.bnf.fr/ark:/12148/"), ark, noid_check(ark))
    return F.concat(F.lit("Unimarc/A : " if index == "unimarc/a" else f"{index} : "), c)


def unimarc_coordinates(c: Column) -> Column:
    """w0241207 as W 24°12’7”; + and - are north and south, another first sign is ?."""
    side = F.upper(F.left(c, F.lit(1)))
    side = F.when(side == "+", "N").when(side == "-", "S").when(side.isin("W", "E", "N", "S"), side).otherwise("?")
    n = lambda at, size: F.coalesce(F.substring(c, at, size).try_cast("int"), F.lit(0)).cast("string")
    return F.concat(side, F.lit(" "), n(2, 3), F.lit("°"), n(5, 2), F.lit("’"), n(7, 2), F.lit("”"))


def unimarc_time_hexa(c: Column) -> Column:
    """150027 as 15h0m27s, without parts that are zero unless they lie between others."""
    h, m, s = (F.coalesce(F.trim(F.substring(c, at, 2)).try_cast("int"), F.lit(0)) for at in (1, 3, 5))
    show = lambda x, mark, also=F.lit(False): F.when((x != 0) | also, F.concat(x.cast("string"), F.lit(mark))).otherwise("")
    return F.concat(show(h, "h"), show(m, "m", (h != 0) & (s != 0)), show(s, "s"))


#: Filters by the names that patterns give them (fixed values).
FILTERS = {
    "abs": absolute, "capitalize": capitalize, "date": date, "dateIso": date_iso, "dateRevert": date_revert, "dateSql": date_sql, "e": escape, "escape": escape,
    "first": first, "last": last, "length": length, "lower": F.lower, "replace": replace, "slice": slice, "split": split, "striptags": striptags, "table": table,
    "title": title, "trim": trim, "unimarcCoordinates": unimarc_coordinates, "unimarcCoordinatesHexa": coordinates_hexa, "unimarcTimeHexa": unimarc_time_hexa,
    "upper": F.upper, "url_encode": url_encode, "format": format,
}


def apply_pattern(pattern: str, value: Column, fields: dict[str, Column] | None = None) -> Column:
    """A text with `{{ name|filter|filter(argument) }}` in it, as one Column.

    value is what `value` stands for, fields what other names do; a name that is a filter is applied to value, an unknown one is empty.
    Arguments are Python literals: texts, numbers, and dictionaries for replace and table.
    """
    out = []
    for i, piece in enumerate(re.split(r"\{\{\s*(.*?)\s*\}\}(?!\})", pattern)):
        if i % 2 == 0:
            out.append(F.lit(piece))
            continue
        c = value
        for k, step in enumerate(re.findall(r"""((?:"[^"]*"|'[^']*'|[^|"'])+)""", piece)):
            name, _, args = step.strip().partition("(")
            if name in FILTERS:
                c = FILTERS[name](c, *(ast.literal_eval(f"({args[:-1]},)") if args[:-1].strip() else ()))
            elif k:
                raise ValueError(f"unknown filter: {name}")
            elif name != "value":
                c = (fields or {}).get(name, F.lit(""))
        out.append(F.coalesce(c.cast("string"), F.lit("")))
    return F.concat(*out)
