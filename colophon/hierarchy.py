"""Titles through links, and trees of concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .schema import PAYLOAD
from .store import cut

HOPS = 20


def resource_titles(resources: DataFrame, v: DataFrame, term: str = "dcterms:title", templates: DataFrame | None = None) -> DataFrame:
    """(id, title, changed): the first value of the title term: its text, else its uri, else that of the resource it links to, and so on.

    templates (label, title_term) gives resources of a template another term; linked resources are read by the term of the one that is titled.
    A link is followed HOPS times at most, so a cycle gives no title; titles are trimmed and blank ones null. The ways of all links are
    doubled each round, so that HOPS links take five joins; rows whose title is found are not joined again.
    """
    x = resources.select("id", F.col("title").alias("_old"), F.lit(term).alias("term"))
    terms = [term]
    if templates is not None:
        t = templates.where("title_term is not null").groupBy(F.col("label").alias("template")).agg(F.min("title_term").alias("_term"))
        x = resources.select("id", F.col("title").alias("_old"), "template").join(t, "template", "left").select("id", "_old", F.coalesce("_term", F.lit(term)).alias("term"))
        terms += [r[0] for r in t.select("_term").distinct().collect()]
    w = v.where(F.col("term").isin(terms))
    rest = [c for c in PAYLOAD if c in v.columns]
    w = w.groupBy(F.col("resource_id").alias("id"), "term").agg(F.min(F.struct(F.col("id").isNull().alias("_none"), F.col("id").alias("_i"), *rest)).alias("_v"))
    text = F.coalesce(F.nullif("_v.value", F.lit("")), F.nullif("_v.uri", F.lit("")))
    nodes = cut(w.select("id", "term", text.alias("text"), F.when(text.isNull(), F.col("_v.value_resource_id")).alias("to")))
    done = nodes.where("to is null").select("id", "term", "text", F.lit(0).alias("hops"))
    open_ = nodes.where("to is not null").select("id", "term", "to", F.lit(1).alias("hops"))
    hops = 1
    while hops <= HOPS and not open_.isEmpty():
        here = done.select(F.col("id").alias("to"), "term", "text", F.lit(None).cast("long").alias("_next"), F.col("hops").alias("_hops"))
        here = here.union(open_.select(F.col("id").alias("_i"), "term", F.lit(None).cast("string"), "to", "hops"))
        step = cut(open_.join(here, ["to", "term"], "left").select("id", "term", "text", "_next", (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops")))
        done = done.union(step.where("_next is null").select("id", "term", "text", "hops"))
        open_ = step.where("_next is not null").select("id", "term", F.col("_next").alias("to"), "hops")
        hops *= 2
    title = F.nullif(F.trim(F.col("text")), F.lit(""))
    found = done.where(F.col("hops") <= HOPS).select("id", "term", title.alias("_t"))
    return x.join(found, ["id", "term"], "left").select("id", F.col("_t").alias("title"), (~F.col("_t").eqNullSafe(F.nullif("_old", F.lit("")))).alias("changed"))


def thesaurus_structure(concept: DataFrame, sort: str = "id") -> tuple[DataFrame, DataFrame]:
    """(tops (id), edges (parent_id, id, position)): tops have no parent; narrower concepts are in order of id or of label."""
    edges = concept.where("parent_id is not null").groupBy("parent_id", "id").agg(F.min("label").alias("label"))
    order = Window.partitionBy("parent_id").orderBy(*(["id"] if sort == "id" else [F.lower("label"), "id"]))
    return concept.where("parent_id is null").select("id").distinct(), edges.select("parent_id", "id", F.row_number().over(order).alias("position"))


def ancestors(edges: DataFrame, max_depth: int = 10) -> DataFrame:
    """(id, ancestor_id, depth): what edges (id, parent_id) lead to in max_depth steps or fewer, and the fewest.

    Each round joins the ancestors that are as far as has been reached with all ancestors of theirs, which doubles the reach.
    """
    known = cut(edges.where("id is not null and parent_id is not null").select("id", F.col("parent_id").alias("ancestor_id"), F.lit(1).alias("depth")).distinct())
    reach = 1
    while reach < max_depth:
        far = known.where(F.col("depth") == reach)
        if far.isEmpty():
            break
        up = known.select(F.col("id").alias("ancestor_id"), F.col("ancestor_id").alias("_up"), F.col("depth").alias("_more"))
        more = far.join(up, "ancestor_id").select("id", F.col("_up").alias("ancestor_id"), (F.col("depth") + F.col("_more")).alias("depth")).where(F.col("depth") <= max_depth)
        known = cut(known.union(more).groupBy("id", "ancestor_id").agg(F.min("depth").alias("depth")))
        reach *= 2
    return known


def thesaurus_values(concept: DataFrame, scheme_id: int, untitled: str = "[Untitled]") -> DataFrame:
    """Value rows (resource_id, term, type, value, value_resource_id) of concepts (id, parent_id, label, definition, note) in a scheme.

    Labels default to untitled; broader, narrower, inScheme, topConceptOf and hasTopConcept are links. A parent that is no concept is the
    literal of its id.
    """
    c = concept.dropDuplicates(["id"])
    known = c.select(F.col("id").alias("_known"))
    x = c.join(known, F.col("parent_id") == F.col("_known"), "left")
    text = lambda term, value: F.struct(F.lit(term).alias("term"), F.lit("literal").alias("type"), value.cast("string").alias("value"), F.lit(None).cast("long").alias("value_resource_id"))
    link = lambda term, to: F.struct(F.lit(term).alias("term"), F.lit("resource:item").alias("type"), F.lit(None).cast("string").alias("value"), to.cast("long").alias("value_resource_id"))
    lost = F.col("parent_id").isNotNull() & F.col("_known").isNull()
    own = [
        text("skos:prefLabel", F.coalesce(F.nullif(F.trim("label"), F.lit("")), F.lit(untitled))), text("skos:definition", F.nullif("definition", F.lit(""))), text("skos:scopeNote", F.nullif("note", F.lit(""))),
        link("skos:inScheme", F.lit(scheme_id)), link("skos:broader", F.col("_known")), text("skos:broader", F.when(lost, F.col("parent_id"))),
        link("skos:topConceptOf", F.when(F.col("parent_id").isNull(), F.lit(scheme_id))),
    ]
    flat = lambda df, arms, who: df.select(F.col(who).alias("resource_id"), F.explode(F.array(*arms)).alias("_v")).select("resource_id", "_v.*").where("value is not null or value_resource_id is not null")
    down = flat(x.where("_known is not null"), [link("skos:narrower", F.col("id"))], "_known")
    tops = flat(x.where("parent_id is null").withColumn("_s", F.lit(scheme_id).cast("long")), [link("skos:hasTopConcept", F.col("id"))], "_s")
    return flat(x, own, "id").union(down).union(tops)


def concept_tables(names: DataFrame, langs: DataFrame, parents: DataFrame, roots: list[str], max_depth: int = 10) -> tuple[DataFrame, DataFrame]:
    """(labels (id, pos, label, lang), places (id, parent_id, scheme)) of names (id, pos, name), langs (id, pos, lang) and parents (id,
    parent_id): the scheme is the nearest ancestor among the roots, the smallest of several; a parent that is a root is no broader concept."""
    labels = names.join(langs, ["id", "pos"], "left").select("id", "pos", F.col("name").alias("label"), "lang")
    up = ancestors(parents, max_depth).where(F.col("ancestor_id").isin(roots))
    scheme = up.groupBy("id").agg(F.min_by("ancestor_id", F.struct("depth", "ancestor_id")).alias("scheme"))
    places = parents.select("id", F.when(~F.col("parent_id").isin(roots), F.col("parent_id")).alias("parent_id")).join(scheme, "id", "left")
    return labels, places


def display_title(resources: DataFrame, v: DataFrame, terms: tuple[str, ...] = ("dcterms:title", "foaf:name", "skos:prefLabel")) -> DataFrame:
    """(id, title): the own title, else the first text of the first of these terms that has one."""
    order = F.array_position(F.array(*map(F.lit, terms)), F.col("term"))
    first = v.where(F.col("term").isin(*terms) & (F.col("value") != "")).groupBy(F.col("resource_id").alias("id")).agg(F.min_by("value", F.struct(order.alias("o"), F.col("id").isNull().alias("n"), F.col("id"), F.col("value"))).alias("_t"))
    return resources.select("id", "title").join(first, "id", "left").select("id", F.coalesce(F.nullif("title", F.lit("")), "_t").alias("title"))
