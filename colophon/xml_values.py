"""Records of XML files as typed values, whatever elements they hold.

A file is cut behind each record's end tag, so large files are read by many tasks. Each record is parsed by itself; prefixes are taken
as they are written, since what declares them may stand in another record's part of the file.
"""

from __future__ import annotations

import re
import xml.parsers.expat
from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .metadata import FALSE_WORDS

#: Other names of data types (fixed values); a type that is neither here nor below is literal.
TYPES = {
    "dcterms:URI": "uri", "rdf:HTML": "html", "http://www.w3.org/1999/02/22-rdf-syntax-ns#HTML": "html", "rdf:XMLLiteral": "xml", "http://www.w3.org/1999/02/22-rdf-syntax-ns#XMLLiteral": "xml",
    "xsd:boolean": "boolean", "http://www.w3.org/2001/XMLSchema#boolean": "boolean", "geometry:geometry": "geometry", "geometry:geography": "geography", "geometry:geometry:position": "geometry:position",
    "geometry:geometry:coordinates": "geometry:coordinates", "geometry:geography:coordinates": "geography:coordinates", "http://www.opengis.net/ont/geosparql#wktLiteral": "geography",
    "xsd:integer": "numeric:integer", "http://www.w3.org/2001/XMLSchema#integer": "numeric:integer", "http://www.w3.org/2001/XMLSchema#duration": "numeric:duration",
    "xsd:date": "numeric:timestamp", "xsd:dateTime": "numeric:timestamp", "xsd:gYear": "numeric:timestamp", "xsd:gYearMonth": "numeric:timestamp",
    "http://www.w3.org/2001/XMLSchema#date": "numeric:timestamp", "http://www.w3.org/2001/XMLSchema#dateTime": "numeric:timestamp", "http://www.w3.org/2001/XMLSchema#gYear": "numeric:timestamp", "http://www.w3.org/2001/XMLSchema#gYearMonth": "numeric:timestamp",
    "idref": "valuesuggest:idref:person",
}
#: Types as they are, and those whose texts have no language (fixed values).
OWN_TYPES = ("literal", "uri", "html", "xml", "boolean", "geography", "geometry", "geography:coordinates", "geometry:coordinates", "geometry:position", "numeric:integer", "numeric:timestamp", "numeric:interval", "numeric:duration")
NO_LANGUAGE = ("uri", "boolean", "geography", "geometry", "geography:coordinates", "geometry:coordinates", "geometry:position", "numeric:integer", "numeric:timestamp", "numeric:interval", "numeric:duration", "valuesuggest:idref:person")
WITHOUT_LANGUAGE = ("xsd:decimal", "xsd:gDay", "xsd:gMonth", "xsd:gMonthDay", "xsd:time")
#: Elements of a record that hold a resource of their own; other names of single fields (fixed values).
PARTS = ("o:item_set", "o:media")
FIELDS = {"o:class": "o:resource_class", "o:resource_class": "o:resource_class", "o:template": "o:resource_template", "o:resource_template": "o:resource_template"}
#: kind: property, field (of the record, or of a part), or error.
SCHEMA = "part int, part_name string, pos int, kind string, term string, type string, value string, uri string, lang string, is_public boolean"


class Element:
    """An element with its children and, in order, what stands in it: texts, or children."""

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.inside = name, attributes, []

    @property
    def children(self) -> list[Element]:
        return [x for x in self.inside if isinstance(x, Element)]

    def inner(self) -> str:
        """The element's own text, or if that is blank the markup of its children."""
        own = "".join(x for x in self.inside if isinstance(x, str)).strip()
        return own or "".join(x if isinstance(x, str) else x.markup() for x in self.inside).strip()

    def markup(self) -> str:
        marks = "".join(f" {k}={quoteattr(v)}" for k, v in self.attributes.items())
        body = "".join(escape(x) if isinstance(x, str) else x.markup() for x in self.inside)
        return f"<{self.name}{marks}>{body}</{self.name}>" if body else f"<{self.name}{marks}/>"


def parse(text: str) -> Element:
    """The outermost element of a text; ExpatError if it isn't well formed."""
    top = Element("", {})
    stack = [top]

    def start(name: str, attributes: dict[str, str]) -> None:
        e = Element(name, attributes)
        stack[-1].inside.append(e)
        stack.append(e)

    p = xml.parsers.expat.ParserCreate()
    p.buffer_text = True
    p.StartElementHandler, p.EndElementHandler = start, lambda name: stack.pop()
    p.CharacterDataHandler = lambda s: stack[-1].inside.append(s)
    p.Parse(text.encode(), True)
    return top.children[0]


def is_true(text: str) -> bool:
    return text.strip().lower() not in ("", *FALSE_WORDS)


def typed(e: Element) -> tuple | None:
    """(kind, term, type, value, uri, lang, is_public) of a property; None if it is empty. Visibility that isn't said is null."""
    text = e.inner()
    if not text:
        return None
    given = e.attributes.get("o:type") or e.attributes.get("xsi:type") or "literal"
    public = is_true(e.attributes["o:is_public"]) if "o:is_public" in e.attributes else None
    if given.startswith("resource"):
        return "error", e.name, given, text, None, None, public
    kind = given if given in OWN_TYPES or given.startswith(("customvocab:", "valuesuggest")) else TYPES.get(given, "literal")
    lang = None if kind in NO_LANGUAGE or given in WITHOUT_LANGUAGE else e.attributes.get("xml:lang") or None
    if kind == "uri" or kind.startswith("valuesuggest") and given != "idref":
        return "property", e.name, kind, e.attributes.get("o:label") or None, text, lang, public
    if kind == "boolean":
        text = "1" if is_true(text) else "0"
    elif kind == "numeric:integer":
        n = re.match(r"\s*[+-]?\d+", text)
        text = str(int(n[0])) if n else "0"
    return "property", e.name, kind, text, None, lang, public


def record_rows(text: str) -> Iterator[tuple]:
    """Rows of SCHEMA of one record. Part 0 is the record itself, others are its item sets and media in order; without a wrapper that says it is
    one. Attributes are fields of their part; a media's own inner element gives it ingester and source."""
    try:
        top = parse(text)
    except xml.parsers.expat.ExpatError as x:
        yield 0, None, 0, "error", None, None, f"not well formed: {x}", None, None, None
        return
    if is_true(top.attributes.get("wrapper", "")) and top.children:
        top = top.children[0]
    parts = [(0, top)]
    pos = 0

    def field(part: int, name: str | None, term: str, value: str) -> tuple:
        return part, name, pos, "field", term, None, value, None, None, None

    while parts:
        part, e = parts.pop(0)
        name = e.name if part else None
        attributes = dict(e.attributes)
        if part:
            for c in ("o:is_public", *(["o:is_open"] if name == "o:item_set" else [])):
                attributes[c] = "1" if c not in attributes or is_true(attributes[c]) else "0"
        children = e.children
        if name == "o:media":
            base = [c for c in children if c.name == "o:media"][-1:] or ([e] if not children or not any(":" in c.name for c in children) else [])
            for b in base:
                attributes |= {k: v for k, v in b.attributes.items() if k != "o:is_public" or b is not e}
                if source := b.inner():
                    attributes["o:source"] = attributes.get("o:source") or source
                    attributes.setdefault("o:ingester", "file")
            children = [] if base == [e] else [c for c in children if c.name != "o:media"]
            if base and base[0] is not e and "o:is_public" in base[0].attributes:
                attributes["o:is_public"] = "1" if is_true(base[0].attributes["o:is_public"]) else "0"
            if not attributes.get("o:ingester"):
                continue
        for k, v in attributes.items():
            if not k.startswith("xmlns") and k != "wrapper":
                yield field(part, name, FIELDS.get(k, k), v)
        for c in children:
            pos += 1
            if part == 0 and c.name in PARTS:
                parts.append((max((p for p, _ in parts), default=0) + 1, c))
            elif part == 0 and c.name in FIELDS:
                if value := c.inner():
                    yield field(part, name, FIELDS[c.name], value)
            elif row := typed(c):
                yield part, name, pos, *row


def read_xml_records(spark: SparkSession, path: str, row_tag: str = "resource") -> DataFrame:
    """(record, file): each element of this name, as text. Elements of the name aren't nested; the file is cut behind each end tag, in
    blocks that many tasks read."""
    start = rf"<{re.escape(row_tag)}(?=[\s>/])"
    raw = spark.read.option("lineSep", f"</{row_tag}>").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    # before a record's start tag may stand the file's head, comments, and elements of the name that are empty
    own = F.regexp_extract_all(F.concat("value", F.lit(f"</{row_tag}>")), F.lit(rf"(?s)<!--.*?(?:-->|\z)|({start}(?:[^>\x22']|\x22[^\x22]*\x22|'[^']*')*?(?:/>|>.*))"), F.lit(1))
    return raw.where(F.col("value").rlike(start)).select(F.explode(F.filter(own, lambda x: x != "")).alias("record"), "file")


def extract_xml_values(records: DataFrame, key: str, record: str = "record") -> DataFrame:
    """(key, part, part_name, pos, kind, term, type, value, uri, lang, is_public) of each record.

    kind is property (a typed value: aliases of types are resolved, uris have their label as value, texts their language), field (single
    fields and attributes of the record or of a part of it) or error (a link, which has no target here, or a text that isn't XML). Parts are
    the item sets and media inside a record. Null records have no rows.
    """
    kind = records.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows = [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for row in record_rows(text) if text is not None else ():
                    keys.append(k)
                    rows.append(row)
            columns = list(zip(*rows, strict=True)) or [()] * 10
            types = [pa.int32(), pa.string(), pa.int32(), *[pa.string()] * 6, pa.bool_()]
            names = [key, "part", "part_name", "pos", "kind", "term", "type", "value", "uri", "lang", "is_public"]
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)

    return records.select(key, record).mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")


def xml_values(extracted: DataFrame, key: str) -> DataFrame:
    """Value rows of the records themselves (part 0), their resource_id the key; dates that can't be read are literal."""
    from .dates import iso_parse

    x = extracted.where("kind = 'property' and part = 0")
    late = (F.col("type") == "numeric:timestamp") & iso_parse(F.col("value")).isNull()
    return x.select(F.col(key).alias("resource_id"), "term", F.when(late, "literal").otherwise(F.col("type")).alias("type"), "value", "uri", F.lit(None).cast("long").alias("value_resource_id"), "lang", F.coalesce("is_public", F.lit(True)).alias("is_public"), "pos")
