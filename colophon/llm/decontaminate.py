"""Benchmark decontamination with a positional inverted index of the training texts.

The texts are dealt into segments of some million places. A segment's index has a row for each term, with the sorted places where
it stands; texts lie apart in it, so that no match runs over from one to the next. A test window asks only the segments that hold its two
rarest terms. There its terms' lists are shifted by their offsets in the window and intersected, the rarest first: what is left are the
places where the whole phrase stands, or, with some slack, where every term stands near its place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

SIZE = 10
#: Places that a term may be off in a proximity match.
SLACK = 2
#: Places between two texts of a segment, and places of a segment: what a task holds.
GAP, SEGMENT = 64, 2_000_000
#: Test terms, and bytes of them, that travel to the tasks which build the index; with more than either, all terms are indexed.
TERMS, TERM_BYTES = 1_000_000, 16_000_000
#: Letters and digits of ASCII, in lower case, and all other characters stay; the rest stands between words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, A-Z in lower case."""
    return (text or b"").translate(_FOLD).split()


def windows(items: DataFrame, id_col: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(item, terms): each item's runs of `size` consecutive words; all its words if they are fewer; none for an item without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, t in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                w = terms(t)
                own = sorted({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}) if w else []
                yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(own), b.schema.field(0).type), pa.array(own, pa.list_(pa.binary()))], ["item", "terms"])

    return items.select(id_col, F.col(text).cast("binary")).mapInArrow(run, f"item {items.schema[id_col].dataType.simpleString()}, terms array<binary>")


def index(docs: DataFrame, wanted: DataFrame | None = None, id_col: str = "doc_id", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """The index, written in the shared folder: rows (segment, term, places) of each segment and term, and with a null term a row for each
    segment whose ids, places and sizes are the texts', where they begin, and their numbers of words. wanted: the terms (a column term)
    to index, if they are few enough to travel."""
    only = None
    if wanted is not None:
        n, volume = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("term")), F.lit(0))).first()
        if n <= TERMS and volume <= TERM_BYTES:
            only = [bytes(r[0]) for r in wanted.select("term").collect()]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(only or ())}
        ids, starts, sizes, codes, at, id_type = [], [], [], [], 0, pa.int64()

        def flush() -> Iterator[pa.RecordBatch]:
            name = uuid.uuid4().int >> 65
            flat = np.concatenate(codes)
            place = np.repeat(np.array(starts) - np.cumsum(sizes) + np.array(sizes), sizes) + np.arange(len(flat))
            if only is not None:
                place, flat = place[flat >= 0], flat[flat >= 0]
            order = np.argsort(flat, kind="stable")
            flat, place = flat[order], place[order].astype(np.int32)
            cuts = np.flatnonzero(np.diff(flat, prepend=-1))
            known = list(number)
            n = len(cuts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(flat)).astype(np.int32)), pa.array(place))
            none = pa.nulls(n, pa.list_(id_type)), pa.nulls(n, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.int64()), pa.array([known[c] for c in flat[cuts].tolist()], pa.binary()), lists, *none], names)
            last = [pa.array([name]), pa.array([None], pa.binary()), pa.array([starts], pa.list_(pa.int32())), pa.array([ids], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(last, names)

        names = ["segment", "term", "places", "ids", "sizes"]
        for b in batches:
            id_type = b.schema.field(0).type
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = terms(t.as_py())
                if only is None:
                    codes.append(np.fromiter((number.setdefault(x, len(number)) for x in w), np.int32, len(w)))
                else:
                    codes.append(np.fromiter((number.get(x, -1) for x in w), np.int32, len(w)))
                ids.append(d)
                starts.append(at)
                sizes.append(len(w))
                at += len(w) + GAP
                if at >= segment:
                    yield from flush()
                    ids, starts, sizes, codes, at = [], [], [], [], 0
                    if only is None:
                        number = {}
        if ids:
            yield from flush()

    return cut(docs.select(id_col, F.col(text).cast("binary")).mapInArrow(run, f"segment long, term binary, places array<int>, ids array<{kind}>, sizes array<int>"))


def intersect(lists: list[np.ndarray], slack: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted lists of places, each shifted by its term's offset, the rarest first: the places of the first one that every other list
    has within slack, and for each how far the furthest is."""
    at, off = lists[0], np.zeros(len(lists[0]), np.int64)
    for other in lists[1:]:
        if not len(at) or not len(other):
            return at[:0], off[:0]
        i = np.searchsorted(other, at)
        d = np.minimum(np.abs(other[np.minimum(i, len(other) - 1)] - at), np.abs(other[np.maximum(i, 1) - 1] - at))
        keep = d <= slack
        at, off = at[keep], np.maximum(off[keep], d[keep])
    return at, off


def matches(ix: DataFrame, asked: DataFrame, slack: int = 0) -> DataFrame:
    """(segment, at, words, hits, windows, near) of the texts of an index that hold windows (window, terms) asked for.

    at is where the text begins in its segment; words the places in it that exact matches cover, hits their number; windows are those that
    stand in it exactly, near those that only stand in it with terms up to slack from their places. A window goes to the segments that hold
    its two rarest terms, and one with a term that no text has goes nowhere.
    """
    lists = ix.where("term is not null").select("segment", "term", "places")
    stats = lists.groupBy("term").agg(F.sum(F.size("places")).alias("n"))
    each = asked.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term")).join(stats, "term")
    plan = each.groupBy("window", "size").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("plan")).where(F.size("plan") == F.col("size"))
    plan = cut(plan.select("window", F.transform("plan", lambda x: x["offset"]).alias("offsets"), F.transform("plan", lambda x: x["term"]).alias("terms")))
    where = lists.select("segment", "term")
    to = plan.join(where.withColumnRenamed("term", "_1"), F.get("terms", F.lit(0)) == F.col("_1")).join(where.select(F.col("segment").alias("_s"), F.col("term").alias("_2")), (F.col("segment") == F.col("_s")) & (F.coalesce(F.get("terms", F.lit(1)), F.col("_1")) == F.col("_2")), "left_semi")

    def run(key: tuple, x: pa.Table, y: pa.Table) -> pa.Table:
        found: dict[int, tuple[list, set, set]] = {}
        known = {t: i for i, t in enumerate(y["term"].to_pylist())}
        flat = y["places"].combine_chunks()
        ends, flat, starts = flat.offsets.to_numpy(), flat.values.to_numpy(zero_copy_only=False).astype(np.int64), np.zeros(0, np.int64)
        of = lambda i: flat[ends[i] : ends[i + 1]]
        if None in known:
            starts = of(known[None])
        for w, offsets, own in zip(*(x[c].to_pylist() for c in ("window", "offsets", "terms")), strict=True):
            if any(t not in known for t in own):
                continue
            at, off = intersect([of(known[t]) - o for o, t in zip(offsets, own, strict=True)], slack)
            # the text is that of the rarest term: with slack a window may begin before its text does
            text = starts[np.searchsorted(starts, at + offsets[0], "right") - 1] if len(at) else at
            for p, s, d in zip(at.tolist(), text.tolist(), off.tolist(), strict=True):
                covered, exact, near = found.setdefault(s, ([], set(), set()))
                if d:
                    near.add(w)
                else:
                    exact.add(w)
                    covered.append(np.arange(p - s, p - s + len(own)))
        rows = [(s, np.unique(np.concatenate([np.zeros(0, np.int64), *c])).astype(np.int32), sorted(e), sorted(n - e)) for s, (c, e, n) in found.items()]
        many = lambda i, kind: pa.array([r[i] for r in rows], pa.list_(kind))
        return pa.table({"segment": pa.array([key[0].as_py()] * len(rows), pa.int64()), "at": pa.array([r[0] for r in rows], pa.int32()), "words": many(1, pa.int32()), "hits": pa.array([len(r[1]) for r in rows], pa.int64()), "windows": many(2, pa.int64()), "near": many(3, pa.int64())})

    right = ix.select(F.col("segment").alias("own"), "term", "places")
    return to.select("segment", "window", "offsets", "terms").groupBy("segment").cogroup(right.groupBy("own")).applyInArrow(run, "segment long, at int, words array<int>, hits long, windows array<long>, near array<long>")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, slack: int = SLACK, segment: int = SEGMENT) -> DataFrame:
    """(id, n_words, n_hit, items, near_items): for every document its words, those inside an exact occurrence of a window of an item, the
    items with such windows, and those of which only a proximity match was found; both as sorted arrays of strings.

    A window is `size` consecutive words of an item, or all words of a shorter one. Null and empty texts have no words, and an item without
    words has no window; null item ids count as one item named ''; repeated rows are looked at each on its own, null ids too; other columns
    are not read. A long text is part of one segment, whose lists one task holds.
    """
    if size + 2 * slack > GAP:
        raise ValueError(f"size + 2 * slack may be {GAP} at most")
    of_items = cut(windows(items, item_id, item_text, size))
    asked = cut(of_items.select("terms").distinct().withColumn("window", F.monotonically_increasing_id()))
    names = of_items.join(asked, "terms").select("window", F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item")).distinct()
    ix = index(docs, asked.select(F.explode("terms").alias("term")).distinct(), id_col, text, segment)
    found = cut(matches(ix, asked, slack))
    each = found.select("segment", "at", F.explode("windows").alias("window"), F.lit(True).alias("exact")).union(found.select("segment", "at", F.explode("near"), F.lit(False)))
    # an item that has both kinds is exact
    each = each.join(names, "window").groupBy("segment", "at", "item").agg(F.max("exact").alias("exact"))
    kept = each.groupBy("segment", "at").agg(*(F.sort_array(F.collect_list(F.when(F.col("exact") == e, F.col("item")))).alias(c) for e, c in ((True, "items"), (False, "near_items"))))
    texts = ix.where("term is null").select("segment", F.explode(F.arrays_zip("ids", "places", "sizes")).alias("_t"))
    texts = texts.select("segment", F.col("_t.places").alias("at"), F.col("_t.ids").alias(id_col), F.col("_t.sizes").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    out = texts.join(found.select("segment", "at", "hits"), ["segment", "at"], "left").join(kept, ["segment", "at"], "left")
    return out.select(id_col, "n_words", F.coalesce("hits", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"))
