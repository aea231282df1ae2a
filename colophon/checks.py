"""Checking entries, media and values before an import: messages, and what goes on.

Messages are rows (source_index, severity, message) with the severities err, warn and notice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import iso_parse

#: Schemes of addresses, names of resources, header and length of the log.
SCHEMES = ("http", "https", "ftp", "sftp")
RESOURCE_NAMES = ("items", "item_sets", "media")
LOG_ROWS = 1_000_000

_DURATION = r"^P(?=.)(\d+Y)?(\d+M)?(\d+W)?(\d+D)?(T(?=.)(\d+H)?(\d+M)?(\d+S)?)?$"
_MEDIA_TYPE = r"^[a-z0-9][a-z0-9.+-]*/[a-z0-9][a-z0-9.+-]*$"


def _messages(df: DataFrame, rules: list[tuple[Column, str, str | Column]]) -> DataFrame:
    """A message for each rule (condition, severity, text) that holds for a row."""
    each = F.array(*(F.when(c, F.struct(F.lit(s).alias("severity"), (F.lit(m) if isinstance(m, str) else m).alias("message"))) for c, s, m in rules))
    return df.select("source_index", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("_m")).select("source_index", "_m.*")


def is_url(col: Column) -> Column:
    """Whether a text is an address of a known scheme."""
    return F.coalesce(col.rlike("(?i)^(" + "|".join(SCHEMES) + r")://\S+$"), F.lit(False))


def valid_typed(col: Column, type: str | Column) -> Column:
    """Whether a text is a value of the numeric type or a uri; texts of other types are valid unless empty."""
    t = F.lit(type) if isinstance(type, str) else type
    point = lambda i, first: iso_parse(F.get(F.split(col, "/"), i), first)["epoch"]
    interval = (F.size(F.split(col, "/")) == 2) & (point(0, True) < point(1, False))
    ok = (F.when(t.isin("numeric:integer", "xsd:integer"), col.rlike(r"^\s*[+-]?\d+(\.0*)?$") & col.try_cast("double").isNotNull())
          .when(t == "numeric:timestamp", iso_parse(col).isNotNull()).when(t == "numeric:interval", interval).when(t == "numeric:duration", col.rlike(_DURATION))
          .when(t == "uri", is_url(col)).otherwise(col != ""))
    return F.coalesce(ok, F.lit(False))


def check_resources(rows: DataFrame, action: str, unidentified: str = "error", allow_duplicates: bool = False) -> DataFrame:
    """Messages for rows (source_index, resource_name, id): wrong names, existing ids to create, missing ids to change or delete.

    unidentified says what becomes of rows without an id: error, skip (a warning) or create (nothing to report).
    """
    rules = [(~F.coalesce(F.col("resource_name").isin(*RESOURCE_NAMES), F.lit(False)), "err", "unknown resource name")]
    if action == "create":
        rules.append((F.col("id").isNotNull() & F.lit(not allow_duplicates), "err", "the resource exists"))
    elif unidentified != "create" or action == "delete":
        rules.append((F.col("id").isNull(), "warn" if unidentified == "skip" else "err", "no resource is identified"))
    return _messages(rows, rules)


def check_media(rows: DataFrame, action: str) -> DataFrame:
    """Messages for media (source_index, id, item_id) with neither an id nor an item, unless they are deleted."""
    return _messages(rows, [(F.col("id").isNull() & F.col("item_id").isNull() & F.lit(action != "delete"), "err", "the media has no item")])


def check_urls(rows: DataFrame, col: str) -> DataFrame:
    """Messages for empty addresses and unknown schemes."""
    empty = F.coalesce(F.trim(col), F.lit("")) == ""
    return _messages(rows, [(empty, "err", "the url is empty"), (~empty & ~is_url(F.trim(col)), "err", "the url is not of a known scheme")])


def check_media_type_extension(rows: DataFrame, types: list[str], extensions: list[str]) -> DataFrame:
    """Messages for media_type (without its parameters) and extension (in lower case) outside the lists; an empty list allows all."""
    kind = F.lower(F.trim(F.substring_index(F.coalesce("media_type", F.lit("")), ";", 1)))
    ext = F.lower(F.coalesce("extension", F.lit("")))
    none = F.lit(False)
    return _messages(rows, [
        (~kind.rlike(_MEDIA_TYPE), "err", "the media type is malformed"),
        (kind.rlike(_MEDIA_TYPE) & ~kind.isin(*types) if types else none, "err", "the media type is not allowed"),
        (~ext.isin(*extensions) if extensions else none, "err", "the extension is not allowed"),
    ])


def stop_policy(rows: DataFrame, messages: DataFrame, mode: str) -> DataFrame:
    """Rows that are imported: none (dry_run), all or none (stop_on_error), or those without an error (continue_on_error)."""
    if mode not in ("dry_run", "stop_on_error", "continue_on_error"):
        raise ValueError(f"unknown mode: {mode}")
    errors = messages.where("severity = 'err'").select("source_index")
    if mode == "dry_run" or (mode == "stop_on_error" and not errors.isEmpty()):
        return rows.limit(0)
    return rows.join(errors.distinct(), "source_index", "left_anti").select(*rows.columns)


def missing_subtype(resources: DataFrame, sub: DataFrame, name: str) -> DataFrame:
    """Resources of this name that their own table lacks."""
    return resources.where(F.col("resource_name") == name).join(sub.select("id"), "id", "left_anti").select(*resources.columns)


def empty_assets(asset: DataFrame) -> DataFrame:
    """Assets without name, media type, extension and owner."""
    blank = reduce(lambda a, c: a & (F.coalesce(F.col(c), F.lit("")) == ""), ("name", "media_type", "extension"), F.lit(True))
    return asset.where(blank & F.col("owner_id").isNull())


def status_filter(items: DataFrame, docs: DataFrame, statuses: list[str], key: str, status: str, technical: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Items of these states, and the documents of these items that aren't technical."""
    kept = items.where(F.col(status).isin(statuses))
    own = docs.where(~F.coalesce(technical, F.lit(False))) if technical is not None else docs
    return kept, own.join(kept.select(key).distinct(), key, "left_semi").select(*docs.columns)


def drop_missing_files(media: DataFrame, available: DataFrame, skip_missing: bool) -> tuple[DataFrame, DataFrame]:
    """(media that stay, messages): new media (no id) whose source is not available (a column `source`) go, with a warning if skip_missing."""
    here = available.select("source").where("source is not null").distinct().withColumn("_here", F.lit(True))
    x = media.join(here, "source", "left")
    gone = F.col("id").isNull() & F.col("_here").isNull()
    text = F.concat(F.lit("the file is missing: "), F.coalesce("source", F.lit("")))
    return x.where(~gone).select(*media.columns), _messages(x, [(gone, "warn" if skip_missing else "err", text)])


def choose_datatype(melted: DataFrame, known: DataFrame | None = None, vocab: DataFrame | None = None, literal_fallback: bool = False) -> tuple[DataFrame, DataFrame]:
    """(melted with `type` and `target_id`, messages): the first type of each value's `types` that its text `raw` is valid for.

    known (identifier, id, resource_name) are resources that links may go to, vocab (type, term_value) the terms of vocabularies. A value
    without types is literal; one that fits none is literal with a notice if literal_fallback, else its type is null and an error.
    """
    x = melted.withColumn("target_id", F.lit(None).cast("long")).withColumn("_name", F.lit(None).cast("string"))
    if known is not None:
        one = known.groupBy(F.col("identifier").alias("raw")).agg(F.min(F.struct("id", "resource_name")).alias("_k"))
        x = x.join(one, "raw", "left").withColumns({"target_id": F.col("_k.id"), "_name": F.col("_k.resource_name")}).drop("_k")
    x = x.withColumn("_vocabs", F.array().cast("array<string>"))
    if vocab is not None:
        # a term belongs to no more types than there are vocabularies
        member = vocab.groupBy(F.col("term_value").alias("raw")).agg(F.collect_set("type").alias("_in"))
        x = x.join(member, "raw", "left").withColumn("_vocabs", F.coalesce("_in", "_vocabs")).drop("_in")
    named = F.create_map(*(F.lit(s) for kv in {"resource:item": "items", "resource:itemset": "item_sets", "resource:media": "media"}.items() for s in kv))

    def fits(t: Column) -> Column:
        link = F.col("target_id").isNotNull() & ((t == "resource") | F.coalesce(named[t] == F.col("_name"), F.lit(False)))
        return F.when(t == "literal", F.lit(True)).when(t.startswith("resource"), link).when(t.startswith("customvocab"), F.array_contains("_vocabs", t)).otherwise(valid_typed(F.col("raw"), t))

    types = F.when(F.size("types") > 0, F.col("types")).otherwise(F.array(F.lit("literal")))
    x = x.withColumn("_fit", F.get(F.filter(types, fits), F.lit(0)))
    none = F.col("_fit").isNull()
    text = F.concat(F.lit("no type fits: "), F.col("raw"))
    messages = _messages(x, [(none, "notice" if literal_fallback else "err", text)])
    kind = F.coalesce("_fit", F.lit("literal")) if literal_fallback else F.col("_fit")
    target = F.when(kind.startswith("resource"), F.col("target_id"))
    return x.withColumns({"type": kind, "target_id": target}).drop("_name", "_vocabs", "_fit").select(*melted.columns, "type", "target_id"), messages


def write_check_log(messages: DataFrame, path: str, rows: int = LOG_ROWS) -> None:
    """Messages as one table with tabs: line ends are two spaces, stack traces are cut off, and the log ends after `rows` rows."""
    plain = F.regexp_replace(F.substring_index("message", "Stack trace:", 1), r"\r?\n", "  ")
    out = messages.withColumn("message", F.rtrim(plain)).orderBy("source_index", "severity", "message").limit(rows)
    out.coalesce(1).write.option("sep", "\t").option("header", True).csv(path)
