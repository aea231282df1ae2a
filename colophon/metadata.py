"""From cells to the fields of resources: booleans, names, links' labels, media sources, places, languages and defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import is_url
from .dates import iso_parse
from .schema import PAYLOAD
from .text import split_uri_label

#: Words for yes and no, names of resources, other names of types (fixed values).
FALSE_WORDS = ("0", "false", "no", "off", "private", "closed", "none")
TRUE_WORDS = ("1", "true", "yes", "on", "public", "open")
RESOURCE_ALIASES = {"item": "items", "items": "items", "collection": "item_sets", "collections": "item_sets", "item set": "item_sets", "item sets": "item_sets", "item_set": "item_sets", "item_sets": "item_sets", "itemset": "item_sets", "itemsets": "item_sets", "file": "media", "files": "media", "media": "media", "medias": "media", "resource": "resources", "resources": "resources", "asset": "assets", "assets": "assets"}
TYPE_ALIASES = {"rdf:HTML": "html", "rdf:XMLLiteral": "xml", "xsd:boolean": "boolean", "xsd:integer": "numeric:integer", "xsd:date": "numeric:timestamp", "xsd:dateTime": "numeric:timestamp", "xsd:gYear": "numeric:timestamp", "xsd:gYearMonth": "numeric:timestamp", "idref": "valuesuggest:idref:person"}
#: Language codes of two and of three letters for the languages of the demo; pass a table for others (fixed values).
LANGUAGES = {"en": "eng", "fr": "fra", "de": "deu", "es": "spa", "it": "ita", "la": "lat", "pt": "por", "nl": "nld"}


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def boolean(col: Column) -> Column:
    """True or false for their words, null for any other text."""
    word = F.lower(F.trim(col))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def coerce_metadata(entries: DataFrame, types: dict[str, str]) -> DataFrame:
    """Fields of cells as single values: the last cell as string, boolean or integer, or all cells (strings)."""
    made = {}
    for c, kind in types.items():
        last = F.element_at(F.when(F.size(c) > 0, F.col(c)), -1)
        made[c] = {"string": last, "boolean": boolean(last), "integer": last.try_cast("long"), "strings": F.col(c)}[kind]
    return entries.withColumns(made)


def normalize_resource_name(col: Column) -> Column:
    """items, item_sets or media for their other names in any case; null for unknown ones."""
    return _map(RESOURCE_ALIASES)[F.lower(F.trim(col))]


def fill_values(chosen: DataFrame) -> DataFrame:
    """Value rows of chosen texts (resource_id, term, type, raw, target_id, lang, is_public; and id if there is one): text, uri with label, or link.

    Chosen rows without a type, which no type fitted, are left out.
    """
    uri, label = split_uri_label(F.col("raw"))
    is_uri = (F.col("type") == "uri") | F.col("type").startswith("valuesuggest")
    link = F.col("type").startswith("resource")
    return chosen.where("type is not null").select(
        *(["id"] if "id" in chosen.columns else []), "resource_id", "term", "type",
        F.when(is_uri, F.nullif(label, F.lit(""))).when(~link, F.col("raw")).alias("value"), F.when(is_uri, uri).alias("uri"), F.when(link, F.col("target_id")).alias("value_resource_id"),
        F.when(~link, F.col("lang")).alias("lang"), F.coalesce("is_public", F.lit(True)).alias("is_public"),
    )


def apply_defaults(v: DataFrame, resource_ids: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """v and a literal of each term's default for every resource (resource_id)."""
    if not defaults:
        return v
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("term"), F.lit(x).alias("value")) for t, x in defaults.items())))
    new = resource_ids.select("resource_id").distinct().select("resource_id", each.alias("_d")).select("resource_id", "_d.*")
    new = new.withColumns({"type": F.lit("literal"), "is_public": F.lit(True)})
    return v.unionByName(new, allowMissingColumns=True).select(*v.columns)


def media_source(col: Column, base_iiif: str = "") -> Column:
    """Struct (ingester, source): markup is html, manifests and addresses of images are iiif, videos oembed, other addresses url, folders
    sideload_dir, files sideload. A path that ends as an image description does is put after base_iiif."""
    s = F.trim(col)
    url = is_url(s)
    iiif = s.rlike(r"(?i)/info\.json$")
    kind = (F.when(s.rlike(r"(?s)^<.*>$"), "html").when(iiif, "iiif").when(url & s.rlike(r"(?i)^https?://(www\.)?(youtube\.com|youtu\.be|vimeo\.com)/"), "oembed")
            .when(url, "url").when(s.endswith("/"), "sideload_dir").when(s != "", "sideload"))
    return F.when(kind.isNotNull(), F.struct(kind.alias("ingester"), F.when(iiif & ~url, F.concat(F.lit(base_iiif), s)).otherwise(s).alias("source")))


def fallback_datatype(v: DataFrame, allowed: list[str]) -> DataFrame:
    """Types that aren't allowed are replaced by their other name if that is, dates only if readable; else by literal, without uri and link.

    A literal made of a uri keeps its label, or else the uri, as text.
    """
    other = F.coalesce(_map(TYPE_ALIASES)[F.col("type")], F.col("type"))
    other = F.when(other.isin(allowed) & ((other != "numeric:timestamp") | iso_parse(F.col("value")).isNotNull()), other).otherwise("literal")
    new = F.when(F.col("type").isin(allowed), F.col("type")).otherwise(other)
    plain = (new == "literal") & (F.coalesce("type", F.lit("")) != "literal")
    text = F.coalesce(F.nullif("value", F.lit("")), "uri")
    return v.withColumns({"type": new, "value": F.when(plain, text).otherwise(F.col("value")), "uri": F.when(~plain, F.col("uri")), "value_resource_id": F.when(~plain, F.col("value_resource_id"))})


def geo_marker(col: Column) -> Column:
    """Struct (lat, lng) of two numbers around a slash, null for anything else."""
    return _numbers(col, "/", ("lat", "lng"))


def geo_bounds(col: Column) -> Column:
    """Struct (west, south, east, north) of four numbers between commas."""
    return _numbers(col, ",", ("west", "south", "east", "north"))


def _numbers(col: Column, mark: str, names: tuple[str, ...]) -> Column:
    n = F.transform(F.split(col, mark), lambda x: F.trim(x).try_cast("double"))
    ok = (F.size(n) == len(names)) & ~F.exists(n, lambda x: x.isNull())
    return F.when(ok, F.struct(*(F.get(n, F.lit(i)).alias(c) for i, c in enumerate(names))))


def iso_language(col: Column, letters: int = 3, codes: dict[str, str] = LANGUAGES) -> Column:
    """Codes of two or three letters, in lower case; unknown ones pass through as they are."""
    pairs = codes if letters == 3 else {b: a for a, b in codes.items()}
    low = F.lower(F.trim(col))
    return F.when(low.isin(*pairs.values()), low).otherwise(F.coalesce(_map(pairs)[low], col))


def asset_name(name: Column, source: Column, mode: str) -> Column:
    """The name, or if empty the source's file name (filename), the name before its extension (name), the whole (url, full) or nothing (none)."""
    file = F.substring_index(F.regexp_replace(source, "[?#].*$", ""), "/", -1)
    made = {"filename": file, "name": F.regexp_replace(file, r"\.[^.]*$", ""), "url": source, "full": source, "none": F.lit(None).cast("string")}[mode]
    return F.coalesce(F.nullif(F.trim(name), F.lit("")), made)


def media_metadata_values(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Literals of extracted metadata (resource_id, key, value) whose key is mapped to a term, each once for a resource."""
    if not mapping:
        mapping = {"": ""}
    x = df.withColumn("term", _map(mapping)[F.col("key")]).where("term is not null and term <> '' and value <> ''")
    return x.select("resource_id", "term", "value").distinct().withColumns({"type": F.lit("literal"), "is_public": F.lit(True)})


def default_class_template(resources: DataFrame, template: DataFrame, class_: str | None = None, template_: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(resources, errors (id, message)): the template is the own or the given one, the class the own, the given, or the template's.

    Templates are few: the table (label, class) is a configuration.
    """
    t = template.groupBy(F.col("label").alias("_label")).agg(F.min("class").alias("_class"))
    x = resources.withColumn("template", F.coalesce("template", F.lit(template_).cast("string"))).join(t, F.col("template") == F.col("_label"), "left")
    errors = x.where("template is not null and _label is null").select("id", F.concat(F.lit("unknown template: "), "template").alias("message"))
    return x.withColumn("class", F.coalesce("class", F.lit(class_).cast("string"), "_class")).select(*resources.columns), errors


def _nested_value(x: Column, fields: set[str], term: str) -> Column:
    """A value row of a nested value with these fields."""
    get = lambda n, t="string": (x[n] if n in fields else F.lit(None)).cast(t)
    link, uri = get("value_resource_id", "long"), get("@id")
    text = F.when(uri.isNotNull(), get("o:label")).otherwise(get("@value"))
    return F.struct(
        F.lit(term).alias("term"), F.coalesce(get("type"), F.lit("literal")).alias("type"), F.when(link.isNull(), text).alias("value"), F.when(link.isNull(), uri).alias("uri"),
        link.alias("value_resource_id"), get("@language").alias("lang"), F.coalesce(get("is_public", "boolean"), F.lit(True)).alias("is_public"),
    )


def flatten_resources(nested: DataFrame, terms: list[str], known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(value rows, warnings (resource_id, term, target)) of nested resources: o:id and, for each of these terms, an array of structs with
    type, @value, @id, o:label, value_resource_id, @language and is_public. A link wins over a text; a uri's label is its text.
    """
    arms = []
    for term in (t for t in terms if t in nested.columns):
        fields = set(nested.schema[term].dataType.elementType.names)
        arms.append(F.coalesce(F.transform(F.col(f"`{term}`"), lambda x: _nested_value(x, fields, term)), F.array()))  # noqa: B023
    if not arms:
        raise ValueError("no known term")
    v = nested.select(F.col("`o:id`").cast("long").alias("resource_id"), F.explode(F.concat(*arms)).alias("_v")).select("resource_id", "_v.*")
    if known is None:
        return v, v.select("resource_id", "term", F.col("value_resource_id").alias("target")).limit(0)
    x = v.join(known.select(F.col("id").alias("_to")).distinct(), F.col("value_resource_id") == F.col("_to"), "left")
    lost = F.col("value_resource_id").isNotNull() & F.col("_to").isNull()
    return x.where(~lost).select("resource_id", "term", *PAYLOAD), x.where(lost).select("resource_id", "term", F.col("value_resource_id").alias("target"))
