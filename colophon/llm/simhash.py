"""Near-duplicates by SimHash: fingerprints of 3-word shingles, linked by pigeonring filtering of their Hamming distance.

The 64 bits are cut into a ring of five segments. If two fingerprints differ in at most 2 bits, then some segment starts a chain
along the ring in which the first l segments together differ in at most floor(2 l / 5) bits, for every l: none in the first two,
one in the first three or four. So a pair is looked for only among fingerprints that agree in two neighbouring segments (about 26
bits), is dropped unless its chain keeps the other budgets, and is measured in full only then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut

SHINGLE = 3
SEED = 42
DISTANCE = 2
#: Segments of the ring: bits from the lowest up.
WIDTHS = (13, 13, 13, 13, 12)
#: Fingerprints that share a ring key are compared in pairs up to this number; a larger block is split by its other bits, with nothing left out.
BLOCK = 64


def fingerprint(text: bytes | None) -> int:
    """SimHash of a UTF-8 text: A-Z in lower case, words, shingles with their repeats; 0 without a word."""
    w = (text or b"").lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < SHINGLE else map(b" ".join, zip(*(w[i:] for i in range(SHINGLE)), strict=False))
    return majority(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8"))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of some 64-bit hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        ones += np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp) with fp the fingerprint as a signed long. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py()) for t in b.column(1)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text).cast("binary").alias("t")).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def _ring() -> list[list[int]]:
    """For each start of the ring, the masks of its first two, three and four segments, and of what is outside the first two."""
    at = np.cumsum([0, *WIDTHS])
    seg = [((1 << w) - 1) << int(a) for w, a in zip(WIDTHS, at, strict=False)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    n = len(seg)
    return [[signed(sum(seg[(i + k) % n] for k in range(m))) for m in (2, 3, 4)] for i in range(n)]


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) among distinct fingerprints (fp) with the components of all pairs that differ in DISTANCE bits or fewer.

    Blocks of up to BLOCK fingerprints give all their links. In a larger block every member is written under itself and under each
    neighbour that differs in one bit outside the key: two members differ in at most two bits exactly if they meet there, in a group
    of at most 39, and each links to the smallest of that group. That grows with the block, not with its square.
    """
    ring = _ring()
    keys = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("pos"), F.col("fp").bitwiseAND(F.lit(m2)).alias("key")) for i, (m2, _, _) in enumerate(ring)))).alias("k")).select("fp", "k.pos", "k.key")
    sizes = keys.groupBy("pos", "key").count().where("count > 1")
    keys = cut(keys.join(sizes, ["pos", "key"]))
    masks = lambda j: F.element_at(F.array(*(F.lit(m[j]) for m in ring)), F.col("pos") + 1)
    few = keys.where(F.col("count") <= BLOCK)
    x = F.col("a").bitwiseXOR(F.col("b"))
    chain = (F.bit_count(x.bitwiseAND(masks(1))) <= 1) & (F.bit_count(x.bitwiseAND(masks(2))) <= 1)
    pairs = few.select("pos", "key", F.col("fp").alias("a")).join(few.select("pos", "key", F.col("fp").alias("b")), ["pos", "key"]).where((F.col("a") > F.col("b")) & chain & (F.bit_count(x) <= DISTANCE)).select("a", "b")
    bits = F.array(F.lit(0), *(F.lit((1 << i) - (1 << 64) * (i == 63)) for i in range(64)))
    near = keys.where(F.col("count") > BLOCK).select("pos", "key", "fp", F.explode(F.filter(bits, lambda v: v.bitwiseAND(masks(0)) == 0)).alias("bit")).withColumn("at", F.col("fp").bitwiseXOR(F.col("bit")))
    hubs = near.groupBy("pos", "at").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return pairs.union(hubs.select(F.explode("all").alias("a"), "b").where("a <> b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component_id): every document with the smallest id reachable over fingerprints that differ in at most two bits.

    Null and empty texts have fingerprint 0 and are linked like any other; repeated rows stay and share a component; a null id is larger
    than any other, so a component has a null id only if all its ids are null; other columns are not read. Equal fingerprints are one
    node from the start, named by the smallest of their ids, so the root of a component is its smallest id and nothing is joined by root.
    """
    own = cut(fingerprints(docs, id_col, text))
    nodes = cut(own.groupBy("fp").agg(F.min(id_col).alias("first")))
    node = lambda name: nodes.select(F.col("fp").alias(name), F.struct(F.col("first").isNull().alias("none"), "first", "fp").alias(f"{name}_node"))
    edges = links(nodes.select("fp")).join(node("a"), "a").join(node("b"), "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    roots = components(edges).select(F.col("node.fp").alias("fp"), F.col("root.first").alias("root"))
    # written, so that the join is of two plain tables and a fingerprint of many documents can be split among tasks
    of = cut(nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "first").alias("component_id")))
    return own.join(of, "fp").select(id_col, "fp", "component_id")
