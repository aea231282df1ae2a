"""Near-duplicates by Jaccard similarity of 5-word shingles: candidates by SimHash and by bands of minhashes, each measured exactly.

The first candidates are texts whose SimHash fingerprints (of these shingles) the pigeonring links. Fingerprints of texts of similarity
0.8 differ in about 10 of 64 bits, often in more, and with such a distance no segments prune anything; so bands of minhashes find the
rest. A pair is a candidate there if all ROWS minhashes of one of BANDS bands agree. A pair of similarity 0.8, the least that counts, has no such
band with probability (1 - 0.8**3)**24 = 3e-8; more similar ones are missed less often still. Candidates are linked only if the
shingle sets themselves, made again from the texts, are similar enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, fresh, small
from .simhash import links, majority

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 3
#: Classes of sizes within the factor that two similar sets' sizes may differ by.
CLASSES = 8
SEED = 42
_rng = np.random.default_rng(SEED)
#: Of each minhash a mask and an odd factor, of each row of a band an odd factor.
MASK, FACTOR, MIX = (_rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (BANDS * ROWS, BANDS * ROWS, ROWS))


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted XXH64 of a UTF-8 text's distinct shingles: A-Z in lower case, words; a shorter text is one shingle, no word none."""
    w = (text or b"").lower().split()
    if not w:
        return np.zeros(0, "<u8")
    s = {b" ".join(w)} if len(w) < SHINGLE else set(map(b" ".join, zip(*(w[i:] for i in range(SHINGLE)), strict=False)))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in s), "<u8", len(s)))


def bands(s: np.ndarray) -> np.ndarray:
    """A key for each band of the minhashes of a set."""
    low = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for i in range(0, len(s), 1024):
        np.minimum(low, ((s[i : i + 1024, None] ^ MASK) * FACTOR).min(axis=0), out=low)
    return (low.reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)


def row_hash(docs: DataFrame) -> Column:
    """Of all columns, nulls told apart."""
    return F.xxhash64(*(x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())))


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, set, fp, bands): the hash of the row, that of its shingle set, and the set's fingerprint and band keys (none without a word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t.as_py()) for t in b.column(2)]
            whole = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], "<u8").view("<i8")
            keys = pa.array([bands(s).view(np.int64) if len(s) else [] for s in sets], pa.list_(pa.int64()))
            fps = np.array([majority(s) for s in sets], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(whole), pa.array(fps), keys], ["id", "row", "set", "fp", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), row_hash(docs).alias("row"), F.col(text).cast("binary").alias("t")).mapInArrow(run, f"id {kind}, row long, set long, fp long, bands array<long>")


def _texts(wanted: DataFrame, docs: DataFrame, own: DataFrame, text: str) -> DataFrame:
    """(set, s): the shingles, made again from a text, of each wanted set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t.as_py()).tobytes() for t in b.column(1)], pa.binary())], ["set", "s"])

    # one row of each set, and one of rows that repeat it
    rows = cut(own.groupBy("set").agg(F.min("row").alias("row")).join(wanted, "set", "left_semi"))
    texts = docs.select(row_hash(docs).alias("row"), F.col(text).cast("binary").alias("t")).join(small(rows), "row").select("set", "t").dropDuplicates(["set"])
    return cut(texts.mapInArrow(sets, "set long, s binary"))


def _alike(pairs: DataFrame, docs: DataFrame, own: DataFrame, text: str, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets whose similarity is high enough."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    s = _texts(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), docs, own, text)
    sides = pairs.join(s.select(F.col("set").alias("a"), F.col("s").alias("x")), "a").join(s.select(F.col("set").alias("b"), F.col("s").alias("y")), "b")
    return sides.select("a", "b", "x", "y").mapInArrow(measure, "a long, b long")


def _rows(sets: DataFrame) -> DataFrame:
    """(set, h): the shingles of sets (set, s), a row each."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                h = np.frombuffer(v.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k)), pa.array(h)], ["set", "h"])

    return sets.mapInArrow(each, "set long, h long")


def _shared(sets: DataFrame) -> DataFrame:
    """(set, size, shared) of sets (set, s): the number of shingles, and of those that another of these sets has too."""
    alone = _rows(sets).groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("set").alias("set")).where("n = 1").groupBy("set").agg(F.count(F.lit(1)).alias("alone"))
    size = (F.octet_length("s") / 8).cast("long")
    return sets.select("set", size.alias("size")).join(alone, "set", "left").select("set", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared"))


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(set, size, shared, h, low, high): keys of which two sets (set, s) that are similar enough have one in common, and few others have.

    Sizes are dealt to CLASSES classes for each step that similarity allows between two sizes; low and high are the classes of the two
    sets of a pair. A set of n shingles has at least similarity / (1 + similarity) * (n + m) in common with a similar one of m, and m is
    at least the least size of its class. So if shingles are put in one order, the rarest first, the first shingle that both have is
    among the first n + 1 less that number of either. Shingles that no other set has come first and need no key; a set that has too
    many of them for a class has no keys for it.
    """
    rows = cut(_rows(sets))
    common = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    of_set = Window.partitionBy("set")
    x = rows.join(common, "h").select("set", "h", F.count(F.lit(1)).over(of_set).alias("shared"), F.row_number().over(of_set.orderBy("n", "h")).alias("rank"))
    x = x.join(sets.select("set", (F.octet_length("s") / 8).cast("long").alias("size")), "set")
    step = max(math.log(1 / similarity) / CLASSES, 1e-9)
    own = F.floor(F.log("size") / step)
    # the slack is for products that are whole numbers but for their last bits
    needed = lambda b: F.ceil((F.col("size") + F.greatest(F.exp(b * step), F.col("size") * similarity)) * (similarity / (1 + similarity)) - 1e-6)
    classes = F.filter(F.sequence(own - CLASSES, own + CLASSES), lambda b: F.col("rank") <= F.col("shared") - needed(b) + 1)
    x = x.where(F.col("rank") <= F.col("shared") - F.ceil(F.col("size") * similarity - 1e-6) + 1).withColumns({"own": own, "other": F.explode(classes)})
    return x.select("set", "size", "shared", "h", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_sets(docs: DataFrame, own: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(node, root): the components of all candidate pairs of sets that are similar enough; sets without one don't appear.

    First every set is compared with one hub of each block (the sets that share a fingerprint or a band) that it is in, and the hubs of
    linked fingerprints with each other. A band's hub is the member with the largest blocks altogether: the text that its near copies
    have most in common with. What is then left to find are pairs of members of a band's block that are not in one component yet. A set
    is part of none if too many of its shingles stand in no other set that is left; of the others those pairs are made that have one of
    their rarest shingles in common, as every pair of that similarity has (_prefixes). So no link is left out, a large group of near
    copies costs about its size in comparisons, not its square, and different texts that share a band only cost no pairs at all.
    """
    sets = own.where(F.size("bands") > 0).groupBy("set").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    prints = cut(sets.groupBy("fp").agg(F.min("set").alias("hub")))
    hub_of = lambda name: prints.select(F.col("fp").alias(name), F.col("hub").alias(f"{name}_hub"))
    linked = links(prints.select("fp")).join(hub_of("a"), "a").join(hub_of("b"), "b").select(*_pair("a_hub", "b_hub"))
    same = sets.select("set", "fp").join(prints, "fp").where("set <> hub").select(*_pair("set", "hub"))
    keys = sets.select("set", F.posexplode("bands").alias("band", "key"))
    blocks = cut(keys.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    keys = cut(keys.join(small(blocks), ["band", "key"]))
    weight = cut(keys.groupBy("set").agg(F.sum("n").alias("w")))
    heavy = keys.join(weight, "set").groupBy("band", "key").agg(F.max_by("set", F.struct("w", F.xxhash64("set"))).alias("hub"))
    keys = keys.join(small(cut(heavy)), ["band", "key"])
    tried = cut(keys.where("set <> hub").select(*_pair("set", "hub")).union(linked).union(same).distinct())
    found = cut(_alike(tried, docs, own, text, similarity))
    roots = cut(components(found))
    # blocks of two are settled
    left = cut(keys.where("n > 2").select("band", "key", "set").join(roots, F.col("set") == F.col("node"), "left").select("band", "key", "set", F.coalesce("root", "set").alias("root")))
    apart = left.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band", "key")
    left = cut(left.join(apart, ["band", "key"]).select("set", "root").distinct())
    sets = _texts(left.select("set"), docs, own, text)
    sets = cut(sets.join(_shared(sets).where(F.col("shared") >= similarity * F.col("size")).select("set"), "set"))
    return components(found.union(_alike(cut(_apart(sets, left, similarity).join(tried, ["a", "b"], "left_anti")), docs, own, text, similarity)))


def _apart(sets: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of sets (set, s) of different components (set, root) that may be similar enough: all that are, and few others."""
    key = ["h", "low", "high"]
    x = cut(_prefixes(sets, similarity).join(roots, "set"))
    sizes = x.groupBy(*key, "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = sizes.groupBy(*key).agg(F.max(F.struct("n", "root")).alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select(*key, F.col("m.root").alias("top"))
    x = cut(x.join(open_, key))
    # of two members apart, one at least is outside the component with the most members here
    side = lambda df, s: df.select(*key, "top", F.col("set").alias(s), F.col("root").alias(f"r{s}"), F.col("size").alias(f"n{s}"), F.col("shared").alias(f"s{s}"))
    out, every = side(x.where("root <> top"), "x").drop("top"), side(x, "y")
    possible = F.least("sx", "sy") * (1 + similarity) >= similarity * (F.col("nx") + F.col("ny")) - 1e-6
    return out.join(every, key).where("rx <> ry and (ry = top or x < y)").where(possible).select(*_pair("x", "y")).distinct()


def representatives(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of docs, with all columns, for each component of texts whose similarity is at least `similarity`: that with the smallest id.

    Rows, not ids, are chosen: of repeated rows one stays, and a row of another component stays or goes by itself if it repeats an id. A
    null id comes after all others, so such a row stays if no row with an id is like it. Of rows with the same id the one with the
    smallest hash stays. Null and empty texts are one component.
    """
    own = cut(signatures(docs, id_col, text))
    roots = near_sets(docs, own, text, similarity)
    best = own.groupBy("set").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("best"))
    best = best.join(roots, F.col("set") == F.col("node"), "left").groupBy(F.coalesce("root", "set").alias("root")).agg(F.min("best").alias("best"))
    row = fresh(docs, "_row")[0]
    best = best.select(F.col("best.row").alias(row))
    return docs.withColumn(row, row_hash(docs)).join(best, row, "left_semi").dropDuplicates([row]).select(*(f"`{c}`" for c in docs.columns))
