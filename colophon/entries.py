"""From entries to values: cleaning cells, and column headers that name property, type, language and visibility."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .patterns import apply_pattern
from .sources import INDEX
from .text import trim

#: Short names of data types (fixed values).
SHORT_TYPES = {"item": "resource:item", "itemset": "resource:itemset", "media": "resource:media", "timestamp": "numeric:timestamp", "interval": "numeric:interval", "integer": "numeric:integer", "duration": "numeric:duration"}


@dataclass(frozen=True)
class Target:
    term: str
    types: tuple[str, ...] = ()
    lang: str | None = None
    is_public: bool = True
    pattern: str | None = None


def parse_header(header: str) -> list[Target]:
    """Targets of `term ^^type ^^type @lang §visibility ~ pattern`; several are separated by | and share the first one's types and language."""
    spec, _, pattern = header.partition("~")
    out: list[Target] = []
    for part in spec.split("|"):
        term, marks = re.match(r"\s*(.*?)\s*((?:(?:\^\^|[@§]).*)?)$", part, re.S).groups()
        if not term:
            continue
        found = re.findall(r"""(\^\^|@|§)((?:"[^"]*"|'[^']*'|[^\s^@§"'])+)""", marks)
        types = tuple(SHORT_TYPES.get(v, v) for k, v in found if k == "^^")
        lang = next((v for k, v in found if k == "@"), None)
        public = not any(k == "§" and v == "private" for k, v in found)
        out.append(Target(term, out[0].types if out else types, out[0].lang if out else lang, public, pattern.strip() or None))
    return out


def _fields(entries: DataFrame) -> list[str]:
    return [c for c in entries.columns if c != INDEX]


def clean_entry(entries: DataFrame, separator: str | None = None) -> DataFrame:
    """Cells split at the separator and trimmed; empty pieces go and each piece stays once, where it is first. Null fields are empty."""
    def clean(c: str):
        x = F.coalesce(F.col(f"`{c}`"), F.array().cast("array<string>"))
        if separator:
            x = F.flatten(F.transform(F.filter(x, lambda s: s.isNotNull()), lambda s: F.split(s, re.escape(separator), -1)))
        return F.array_distinct(F.filter(F.transform(x, trim), lambda s: s.isNotNull() & (s != ""))).alias(c)

    return entries.select(INDEX, *map(clean, _fields(entries)))


def is_empty(entries: DataFrame):
    """Whether no field has a cell that isn't empty."""
    out = F.lit(True)
    for c in _fields(entries):
        out = out & ~F.coalesce(F.exists(f"`{c}`", lambda s: F.coalesce(s != "", F.lit(False))), F.lit(False))
    return out


def drop_empty_entries(entries: DataFrame) -> DataFrame:
    """Without empty entries; the others keep their index."""
    return entries.where(~is_empty(entries))


def _patterned(pattern: str, fields: dict[str, Column]) -> Callable[[Column], Column]:
    return lambda x: apply_pattern(pattern, x, fields)


def melt(entries: DataFrame, headers: dict[str, str] | None = None) -> DataFrame:
    """(source_index, field, pos, term, types, lang, is_public, raw): a row for each cell and target of its column's header.

    headers gives fields another header than their name; fields without a target are left out. pos counts a field's cells from 0.
    A header's pattern is applied to each cell; in it other fields' names stand for their first cells.
    A scan and two generators: nothing is shuffled.
    """
    arms = []
    first = {c: F.get(f"`{c}`", F.lit(0)) for c in _fields(entries)}
    for c in _fields(entries):
        if targets := parse_header((headers or {}).get(c, c)):
            to = F.array(*(F.struct(F.lit(t.term).alias("term"), F.array(*map(F.lit, t.types)).cast("array<string>").alias("types"), F.lit(t.lang).cast("string").alias("lang"), F.lit(t.is_public).alias("is_public")) for t in targets))
            cells = F.col(f"`{c}`")
            if targets[0].pattern:
                cells = F.transform(cells, _patterned(targets[0].pattern, first))
            arms.append(F.struct(F.lit(c).alias("field"), cells.alias("cells"), to.alias("to")))
    if not arms:
        return entries.select(INDEX, F.expr("'' as field"), F.expr("0 as pos"), F.expr("'' as term"), F.expr("cast(array() as array<string>) as types"), F.expr("cast(null as string) as lang"), F.expr("true as is_public"), F.expr("'' as raw")).where("false")
    each = entries.select(INDEX, F.explode(F.array(*arms)).alias("_a")).select(INDEX, "_a.field", "_a.to", F.posexplode("_a.cells").alias("pos", "raw"))
    return each.select(INDEX, "field", "pos", "raw", F.explode("to").alias("_t")).select(INDEX, "field", "pos", "_t.*", "raw")
