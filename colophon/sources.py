"""Reading tables of entries, and writing lists and dumps.

An entry is a row of a source: `source_index`, from 1 in the order of files and lines, and an array of strings for each field.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import cut
from .text import trim

INDEX = "source_index"


def _texts(cells: list[Column]) -> Column:
    """The cells of one field as an array: trimmed, without empty ones, each text once."""
    return F.array_distinct(F.filter(F.array(*map(trim, cells)), lambda x: x.isNotNull() & (x != "")))


def _number(df: DataFrame) -> DataFrame:
    """df with source_index from 1 in the order of _file, _start and the lines there.

    The rows of one block of a file are read in a row by one task, so a row's place is its distance from the block's first; only the
    blocks' sizes, a row for each, are summed in order.
    """
    x = df.withColumn("_at", F.monotonically_increasing_id())
    blocks = x.groupBy("_file", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    # one task, but a row for each block only
    before = F.sum("_size").over(Window.orderBy("_file", "_start")) - F.col("_size")
    blocks = blocks.withColumn("_before", before).drop("_size")
    return x.join(blocks, ["_file", "_start"]).withColumn(INDEX, F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_file", "_start", "_at", "_first", "_before")


def _header(cells: list[str | None]) -> list[str]:
    return [(x or "").strip().removeprefix("\ufeff").strip() for x in cells]


def _named(names: list[str], cell: Callable[[int], Column]) -> dict[str, Column]:
    """A column for each name that isn't empty, of all cells headed by it."""
    return {n: _texts([cell(i) for i, m in enumerate(names) if m == n]) for n in dict.fromkeys(names) if n}


def read_csv(spark: SparkSession, path: str, delimiter: str = ",", quote: str = '"', escape: str = "\\", multiline: bool = True, split: bool = False) -> DataFrame:
    """Entries of text tables with one header row. Large files are read by many tasks with split, or where cells have no line ends, multiline=False.

    Nothing is inferred: cells are texts. Blank lines are skipped, lines of separators alone are empty entries; short lines are filled
    up and cells beyond the header are left out. Columns with the same header are one field with the values from left to right. An
    empty file gives no field and no row. Without split all files of a folder must have the header of the first; with it each
    may have its own, and the fields are those of all.
    """
    if split and quote:
        return _read_split(spark, path, delimiter, quote, escape)
    source = spark.read.options(sep=delimiter, quote=quote, escape=escape, multiLine=multiline, mode="PERMISSIVE")
    first = source.option("header", False).csv(path).limit(1).collect()
    if not first:
        return spark.createDataFrame([], f"{INDEX} long")
    names = _header(first[0])
    schema = ", ".join(f"_{i} string" for i in range(len(names)))
    raw = source.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    raw = raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    fields = _named(names, lambda i: F.col(f"_{i}"))
    return _number(raw.select("_file", "_start", *(c.alias(n) for n, c in fields.items()))).select(INDEX, *(f"`{n}`" for n in fields))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, start, line, quotes, odd) of blocks, one block after another, where odd says whether the block begins inside quotes, with
    at, the line's number in the block, nth, how many of the block's records have begun by its end, and inside, whether it begins inside quotes."""
    block, odd, nth, at = None, 0, 0, 0
    for b in batches:
        keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        quotes, first = b.column(3).to_numpy(), b.column(4).to_numpy()
        blank = pc.equal(pc.utf8_trim_whitespace(b.column(2)), "").to_numpy(zero_copy_only=False)
        n, line, inside = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for i, j in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            if keys[i] != block:
                block, odd, nth, at = keys[i], int(first[i]), 0, 0
            after = odd + np.cumsum(quotes[i:j])
            inside[i:j] = (after - quotes[i:j]) % 2 == 1
            n[i:j], line[i:j] = nth + np.cumsum(~inside[i:j] & ~blank[i:j]), at + np.arange(j - i)
            odd, nth, at = int(after[-1] % 2), int(n[j - 1]), at + j - i
        keep = pa.array(inside | ~blank)
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(line), pa.array(n), pa.array(inside)], ["file", "start", "line", "quotes", "at", "nth", "inside"]).filter(keep)


def _read_split(spark: SparkSession, path: str, delimiter: str, quote: str, escape: str) -> DataFrame:
    """Entries of files that are read in blocks by many tasks, though cells may have line ends inside quotes.

    A line end ends a record if the quotes before it in its file are even. Quotes are summed by block first, a row for each, so every task
    knows whether its block begins inside quotes, and how many records were before. Most records are one line and stay where they are;
    only the lines of longer ones are brought together. Quotes stand around cells, doubled or escaped inside them.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.regexp_replace("value", "\r$", "").alias("line"))
    plain = F.regexp_replace("line", re.escape(escape) + "(?s:.)", "") if escape and escape != quote else F.col("line")
    lines = lines.withColumn("quotes", (F.length(plain) - F.length(F.replace(plain, F.lit(quote), F.lit("")))).cast("long"))
    w = Window.partitionBy("file").orderBy("start")
    sums = lines.groupBy("file", "start").agg(F.sum("quotes").alias("q"))
    odd = sums.select("file", "start", ((F.sum("q").over(w) - F.col("q")) % 2).alias("odd"))
    # a row for each block of megabytes; the broadcast leaves lines in order
    placed = lines.join(F.broadcast(odd), ["file", "start"]).select("file", "start", "line", "quotes", "odd")
    placed = placed.mapInArrow(_places, "file string, start long, line string, quotes long, at long, nth long, inside boolean")
    blocks = placed.groupBy("file", "start").agg(F.max("nth").alias("n"))
    # the first record of a file is its header
    files = Window.orderBy("file", "start")
    blocks = blocks.withColumn("before", F.sum("n").over(w) - F.col("n"))
    blocks = cut(blocks.withColumn("headers", F.count_if((F.col("before") == 0) & (F.col("n") > 0)).over(files)).withColumn("all", F.sum("n").over(files) - F.col("n")))
    # headers counts the files up to this block's own
    x = placed.join(F.broadcast(blocks.drop("n")), ["file", "start"]).withColumn("nth_of_file", F.col("before") + F.col("nth"))
    x = x.withColumn(INDEX, F.col("all") + F.col("nth") - F.col("headers"))
    long_ = F.col("inside") | (F.col("quotes") % 2 == 1)
    one = x.where(~long_).select("file", "nth_of_file", INDEX, F.col("line").alias("record"))
    many = x.where(long_).groupBy("file", "nth_of_file", INDEX).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "at", "line"))), lambda s: s["line"]), "\n").alias("record"))
    records = one.union(many)
    heads = cut(records.where("nth_of_file = 1").select("file", F.col("record").alias("header")))
    layouts = [r[0] for r in heads.select("header").distinct().orderBy("header").collect()]
    cells = lambda c, width: F.from_csv(c, F.lit(", ".join(f"_{i} string" for i in range(width))), {"sep": delimiter, "quote": quote, "escape": escape, "mode": "PERMISSIVE"})
    body, out = records.where("nth_of_file > 1"), []
    if len(layouts) > 1:
        body = body.join(heads, "file")
    for text in layouts:
        width = text.count(delimiter) + 1
        names = _header(list(spark.createDataFrame([(text,)], "t string").select(cells("t", width).alias("c")).first()[0]))
        own = (body if len(layouts) == 1 else body.where(F.col("header") == text)).select(INDEX, cells("record", len(names)).alias("_c"))
        out.append(own.select(INDEX, *(c.alias(n) for n, c in _named(names, lambda i: F.col(f"_c._{i}")).items())))
    if not out:
        return spark.createDataFrame([], f"{INDEX} long")
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)
    return both.select(INDEX, *(F.coalesce(F.col(f"`{c}`"), F.array().cast("array<string>")).alias(c) for c in both.columns if c != INDEX))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Entries of tables with tabs, where neither quotes nor backslashes have a meaning."""
    return read_csv(spark, path, "\t", "", "", multiline=False)


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """Entries of several sources with the fields of all, numbered on from one source to the next; fields that one lacks are empty."""
    start, out = 0, []
    for s in sources:
        out.append(s.withColumn(INDEX, F.col(INDEX) + F.lit(start)))
        start += s.agg(F.coalesce(F.max(INDEX), F.lit(0))).first()[0]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)
    return both.select(INDEX, *(F.coalesce(F.col(f"`{c}`"), F.array().cast("array<string>")).alias(c) for c in both.columns if c != INDEX))


def read_json(spark: SparkSession, path: str, root: str | None = None, single: bool = False) -> DataFrame:
    """Objects of JSON files: the elements of the array under root (a path with dots), or the one object there if single."""
    df = spark.read.option("multiLine", True).json(path)
    if root is None:
        return df
    return df.select((F.col(root) if single else F.explode(root)).alias("_o")).where("_o is not null").select("_o.*")


def read_xml(spark: SparkSession, path: str, row_tag: str = "resource") -> DataFrame:
    """Elements of XML files as rows; attributes have the prefix _."""
    return spark.read.format("xml").option("rowTag", row_tag).option("inferSchema", False).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, partitions: int | None = None, filters: list[str] = (), properties: dict[str, str] | None = None) -> DataFrame:
    """A database's table, read by many tasks where key names a numeric or date column: its least and largest value are asked for, and each
    task reads a range between them. Filters and the columns that are used go to the database; rows with a null key are in the first range.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if key is not None:
        # as the database writes it, since it is quoted
        key = next(c for c in reader.option("dbtable", table).load().columns if c.lower() == key.lower())
        name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
        low, high = spark.read.format("jdbc").option("url", url).options(**(properties or {})).option("query", f"select min({name}) as low, max({name}) as high from {table}").load().first()
        if low is not None:
            n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
            reader = reader.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(n))
    return reduce(lambda df, f: df.where(f), filters, reader.option("dbtable", table).load())


def _ordered(order: str) -> Column:
    """A column by its name, with asc or desc after it."""
    name, _, way = order.strip().rpartition(" ")
    return F.desc(name.strip()) if name and way.lower() == "desc" else F.asc(name.strip()) if name and way.lower() == "asc" else F.asc(order.strip())


def read_table(table: DataFrame, filters: list[str] = (), joins: list[tuple[DataFrame, str]] = (), orders: list[str] = (), keys: list[str] | None = None) -> DataFrame:
    """A table (of read_jdbc, or any other) joined on the given columns, filtered, cut to keys and ordered, all left to the scan where it can do them."""
    out = reduce(lambda a, j: a.join(j[0], j[1]), joins, table)
    out = reduce(lambda a, f: a.where(f), filters, out)
    out = out.orderBy(*map(_ordered, orders)) if orders else out
    return out.select(*keys) if keys else out


def rows_by(table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, rows): the rows of each key as an array of structs, in the order of their columns. For keys of few rows each, such as a record's
    parts; the rows of one key are one cell."""
    return table.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))


def read_list(spark: SparkSession, path: str, delimiter: str | None = None, quote: str = '"') -> DataFrame:
    """(value): the distinct texts of a configuration file of one column, trimmed and without empty ones: every line, or, with a delimiter, every
    first cell under a header."""
    if delimiter is None:
        lines = spark.read.text(path).select(trim(F.col("value")).alias("value"))
    else:
        cells = spark.read.csv(path, sep=delimiter, quote=quote, header=True)
        lines = cells.select(trim(F.col(f"`{cells.columns[0]}`")).alias("value"))
    return lines.where("value <> ''").distinct()


def read_table_map(entries: DataFrame, headers: dict[str, str] | None = None, vocabulary: DataFrame | None = None, source: str = "source", destination: str = "destination") -> tuple[DataFrame, DataFrame]:
    """(rows, messages) of a configuration table read as entries: single texts for its fields, which headers rename, without empty rows.

    With a vocabulary (a column term) rows need a source and a destination that is one of its terms; others are left out, each with a
    message (source_index, severity, message).
    """
    names = {c: (headers or {}).get(c, c) for c in entries.columns if c != INDEX}
    flat = entries.select(INDEX, *(F.coalesce(F.get(f"`{c}`", F.lit(0)), F.lit("")).alias(n) for c, n in names.items()))
    rows = flat.where(F.concat(*(F.col(f"`{n}`") for n in names.values())) != "") if names else flat
    none = rows.select(INDEX, F.lit("").alias("severity"), F.lit("").alias("message")).where("false")
    if vocabulary is None:
        return rows, none
    # terms of a vocabulary are few: the scan's own size decides whether they are broadcast
    known = vocabulary.select(F.col("term").alias("_term")).distinct()
    x = rows.join(known, F.col(destination) == F.col("_term"), "left")
    ok = F.col("_term").isNotNull() & (F.col(source) != "")
    text = F.when(F.col(source) == "", F.lit("a row without a source")).when(F.col(destination) == "", F.concat(F.lit("no destination: "), source)).otherwise(F.concat(F.lit("unknown term: "), destination))
    return x.where(ok).drop("_term"), x.where(~ok).select(INDEX, F.lit("warn").alias("severity"), text.alias("message"))


def read_keyvalue(table: DataFrame, value: str, keys: list[str], lower: bool = False) -> DataFrame:
    """(key, value): every key column, also in lower case if asked for, leads to the value column; blank keys and values are left out."""
    each = F.array(*(trim(F.col(k)) for k in keys))
    each = F.concat(each, F.transform(each, F.lower)) if lower else each
    out = table.select(F.explode(F.array_distinct(each)).alias("key"), trim(F.col(value)).alias("value"))
    return out.where("key <> '' and value <> ''").distinct()


def limit_entries(entries: DataFrame, skip: int = 0, max_entries: int = 0) -> DataFrame:
    """Without the first `skip` entries, then at most max_entries of them; 0 is all."""
    out = entries.where(F.col(INDEX) > skip)
    return out.where(F.col(INDEX) <= skip + max_entries) if max_entries else out


def export_table(df: DataFrame, path: str, non_empty: list[str] = ()) -> None:
    """Rows whose listed columns are neither null nor empty, written with tabs and a header."""
    for c in non_empty:
        df = df.where(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
    df.write.option("sep", "\t").option("header", True).csv(path)


def write_id_map(id_map: DataFrame, path: str) -> None:
    """Id maps as a table with a folder for each entity, which later jobs read alone."""
    id_map.write.partitionBy("entity").parquet(path)
