"""Line deduplication with a tree of line templates: lines that recur across documents stay only in the first of them."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, words

#: Leading tokens that, with the number of tokens, lead to a leaf of the tree.
DEPTH = 3
#: Fields of neighbouring tokens that a line is compared in; up to this length a field is a token.
FIELDS = 8
#: Share of its fields that a template must fix.
SIMILARITY = 0.75
#: Lines of fewer tokens have no variable fields: they are compared whole.
MIN_TOKENS = 5
VARIABLE = "<*>"


def _lines(docs: DataFrame, id_col: str, text: str, depth: int, fields: int, min_tokens: int) -> DataFrame:
    line = F.col("line")
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^\\x20\\x09-\\x0D]*[0-9][^\\x20\\x09-\\x0D]*", VARIABLE)).otherwise(line)
    d = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    d = d.select("doc", "h", "pos", "line", words(masked).alias("w")).where(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(fields))
    cut_at = lambda i: F.floor(i * F.size("w") / k).cast("int")
    parts = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.xxhash64(F.slice("w", cut_at(i) + 1, cut_at(i + 1) - cut_at(i))))
    short = F.size("w") < min_tokens
    # a short line is a leaf of its own
    leaf = F.when(short, F.xxhash64(words(line))).otherwise(F.xxhash64(F.size("w"), F.slice("w", 1, depth)))
    # the first fields lie in the tokens that lead to the leaf
    fixed = F.least(k, F.ceil((depth + 1) * k / F.size("w")) - 1).cast("int")
    return d.select("doc", "h", "pos", leaf.alias("leaf"), F.when(short, F.array("leaf")).otherwise(parts).alias("fields"), fixed.alias("fixed"))


def _templates(size: int, similarity: float) -> list[tuple[int, ...]]:
    """The fields that a template of lines of so many fields leaves variable: each choice of as many as similarity allows."""
    return list(combinations(range(size), size - math.ceil(similarity * size)))


def _keys(kinds: DataFrame, fields: int, similarity: float) -> DataFrame:
    """(line, lo, key): every template that a line belongs to. Fields that all lines of a leaf share are never left variable."""
    names = [f"_{i}" for i in range(fields)]
    d = kinds.select("line", "lo", "leaf", "fixed", F.size("fields").alias("size"), *(F.xxhash64(F.lit(i), F.get("fields", F.lit(i))).alias(x) for i, x in enumerate(names)))
    xor = lambda x, y: x.bitwiseXOR(y)
    d = d.withColumn("_all", reduce(xor, map(F.col, names)))

    def of(size: int) -> Column:
        out = _templates(size, similarity)
        key = lambda v: F.xxhash64("leaf", F.lit(sum(1 << i for i in v)), reduce(xor, (F.col(names[i]) for i in v), F.col("_all")))
        return F.array(*(F.when(F.least("fixed", F.lit(size - len(v))) <= min(v, default=size), key(v)) for v in out))

    keys = reduce(lambda c, n: c.when(F.col("size") == n, of(n)), range(2, fields + 1), F.when(F.col("size") == 1, of(1)))
    return d.select("line", "lo", F.explode(keys).alias("key")).where("key is not null")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", depth: int = DEPTH, fields: int = FIELDS, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS) -> DataFrame:
    r"""docs with text replaced by what is kept of it, and n_lines and n_dropped added (columns of those names are replaced).

    A line is cut into tokens; those with a digit become a variable. The number of tokens and the first tokens lead to a leaf. A template
    of a leaf fixes at least `similarity` of its fields and leaves the others variable, and a line belongs to every template that it
    agrees with. A line is dropped from a document if one of its templates is found in a document with a smaller id, that is, if an
    earlier document has a line of the same leaf that agrees in at least `similarity` of the fields. A template's lines stay in the
    first document unless they in turn agree with an earlier line, so the first line of a kind always stays.

    Lines are separated by \n; lines under min_tokens are compared whole, digits and all, and blank ones always stay. A null text stays
    null and an emptied one is ''. Lines that repeat only within one document stay; rows with the same id count as one document; a
    row with a null id keeps all its lines, and is no earlier document to any other. Equal
    lines are one row before any comparison, and joins back to the lines are on a unique key, so that a line of a third of all documents
    can be split among tasks.
    """
    lines = cut(_lines(docs, id_col, text, depth, fields, min_tokens).withColumn("line", F.xxhash64("leaf", "fields")))
    # only lines whose leaf another document has too can go; dealt by leaf, their kinds need no further shuffle
    common = lines.groupBy("leaf").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("leaf")
    kinds = cut(lines.join(common, "leaf", "left_semi").groupBy("line", "leaf", "fields", "fixed").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")))
    shared = kinds.groupBy("leaf").count().where("count > 1").select("leaf")
    keys = _keys(kinds.join(shared, "leaf", "left_semi"), fields, similarity)
    template = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("first")).where("n > 1").select("key", "first")
    earlier = keys.join(template, "key").where(F.col("first") < F.col("lo")).groupBy("line").agg(F.min("first").alias("first"))
    first = kinds.select("line", "lo", "hi").join(earlier, "line", "left").select("line", "hi", F.coalesce("first", "lo").alias("first")).where(F.col("first") < F.col("hi")).select("line", "first")
    # names that no column of docs has, nor the two new ones
    doc, h, gone, parts = fresh(docs, "_doc", "_h", "_gone", "_parts")
    dropped = lines.join(first, "line").where(F.col("doc") > F.col("first")).groupBy(F.col("doc").alias(doc), F.col("h").alias(h)).agg(F.collect_set("pos").alias(gone))
    out = docs.join(dropped, (F.col(id_col) == F.col(doc)) & (F.xxhash64(text) == F.col(h)), "left")
    out = out.withColumn(parts, F.split(text, "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    clean = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(F.get(F.transform(F.array(parts), lambda own: F.transform(kept, lambda i: F.get(own, i))), 0), "\n"))
    n = F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long")
    return out.withColumns({text: clean, "n_lines": n, "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long")}).drop(doc, h, gone, parts)
