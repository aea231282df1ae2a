"""Toxicity by compression distance: windows that a dictionary of toxic text compresses better than one of ordinary text.

Both dictionaries are trained by zstandard, on windows of toxic and of ordinary documents. Most windows of a toxic document are ordinary
text, so the toxic dictionary is trained again on those that the compression distance itself picks: toxic documents fall into two
halves, and a half keeps the windows that the other half's dictionary shortens by more than it shortens all but a few ordinary ones.
Texts apart from both dictionaries calibrate what a document's windows save.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh

#: Labelled documents of either kind that are learned from at most, and windows (of at most WINDOW_BYTES) of each third of a kind.
MAX_TOXIC, MAX_ORDINARY, MAX_WINDOWS, WINDOW_BYTES = 2000, 4000, 60_000, 512
#: Words of a window, and the compression level.
WINDOW, LEVEL = 6, 5
#: Bytes of the dictionaries, and the lengths of the segments and of the byte runs that zstandard builds each from.
ORDINARY_BYTES, ORDINARY_COVER = 131_072, {"k": 64, "d": 8}
TOXIC_BYTES, TOXIC_COVER = 2048, {"k": 16, "d": 8}
#: Bytes of the toxic dictionaries that pick windows, one after the other, and the share of ordinary windows that must save less.
PICKING_BYTES, QUANTILE = (16_384, 4096, 2048), 0.998
#: Savings of a window, in bytes, that a document's features count from.
SAVINGS = (2, 3, 4, 5, 6, 8)
RIDGE = 0.3
THRESHOLD = 0.7


def compressor(content: bytes) -> Callable[[bytes], bytes]:
    """Compresses a window after a dictionary's bytes as plain history: entropy tables, made for long inputs, would blur short windows."""
    d = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=64, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(compression_params=p, dict_data=d).compress


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    coefficients: np.ndarray

    def compressors(self) -> tuple[Callable, Callable]:
        """By the ordinary dictionary alone, and by the toxic one with the ordinary one behind it: ordinary words cost the same in both."""
        return compressor(self.ordinary), compressor(self.toxic + self.ordinary)


def windows(text: bytes | None) -> list[bytes]:
    """The whole text, in lower case (A-Z), as windows of WINDOW words."""
    w = (text or b"").lower().split()
    return [b" " + b" ".join(w[i : i + WINDOW]) + b" " for i in range(0, len(w), WINDOW)]


def savings(x: list[bytes], own: Callable, other: Callable) -> np.ndarray:
    """Bytes by which the second compressor shortens each window more than the first."""
    return np.array([len(own(w)) - len(other(w)) for w in x] or [0])


def features(text: bytes | None, own: Callable, other: Callable) -> np.ndarray:
    """1, the number of windows, and for each of SAVINGS the number and the share of windows that save as much, in logarithms and roots."""
    s = savings(windows(text), own, other)
    n = np.array([(s >= k).sum() for k in SAVINGS])
    return np.array([1.0, np.log1p(len(s)) / 4, *np.log1p(n), *np.sqrt(n / len(s))])


def dictionary(samples: list[bytes], size: int, cover: dict[str, int]) -> bytes:
    """Trained by zstandard; with fewer samples than it accepts, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, **cover).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionaries(toxic: tuple[list[bytes], list[bytes]], ordinary: list[bytes], others: list[bytes]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary from windows: those of two halves of the toxic documents, of ordinary ones, and of ordinary
    ones apart from these, which tell what chance saves."""
    base = dictionary(ordinary, ORDINARY_BYTES, ORDINARY_COVER)
    own, picked = compressor(base), list(toxic)
    for size in PICKING_BYTES:
        new = []
        for half, from_ in ((0, 1), (1, 0)):
            other = compressor(dictionary(picked[from_], size, TOXIC_COVER) + base)
            least = np.quantile(savings(others, own, other), QUANTILE) + 1
            new.append([w for w, s in zip(toxic[half], savings(toxic[half], own, other), strict=False) if s >= least])
        if min(map(len, new)) < 10:  # nothing to train on
            break
        picked = new
    return base, dictionary(picked[0] + picked[1], TOXIC_BYTES, TOXIC_COVER)


def calibrated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic regression with a small ridge, by Newton's method; with labels of one kind alone, or none, a constant."""
    b = np.zeros(2 + 2 * len(SAVINGS))
    if len(set(y.tolist())) < 2:
        b[0] = 60.0 * y.mean() - 30.0 if len(y) else 0.0
        return b
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b = b + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + RIDGE * np.eye(len(b)), x.T @ (y - p) - RIDGE * b)
    return b


def _measure(docs: DataFrame, keep: list[str], text: Column, model: Model, schema: str, f: Callable[[np.ndarray], list[pa.Array]]) -> DataFrame:
    """The columns to keep, and what f makes of the texts' features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, other = model.compressors()
        for b in batches:
            x = np.array([features(t.as_py(), own, other) for t in b.column(b.num_columns - 1)]).reshape(-1, len(model.coefficients))
            arrays = [*b.columns[:-1], *f(x)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    made = docs.select(*keep, text.cast("binary").alias(fresh(docs, "text")[0]))
    types = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    names = [*keep, *(x.split()[0] for x in schema.split(", "))]
    return made.mapInArrow(run, ", ".join([*types, schema]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY, max_windows: int = MAX_WINDOWS) -> Model:
    """Learn from labelled rows: of each label those with the smallest hashes of their ids, at most max_toxic and max_ordinary.

    Two thirds of either kind make the dictionaries, by at most max_windows windows a third, and one third calibrates (all, if that third
    lacks a kind). The driver gets these windows and a few numbers of each text, never whole texts. Null ids take no part; of
    repeated ids the largest label and text count.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("y"))
    pick = lambda y, n: known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    ids = cut(pick(1, max_toxic).union(pick(0, max_ordinary)).withColumn("third", F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(3)).cast("int")))
    # ids has a fixed bound
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("binary").alias("t")).join(F.broadcast(ids), "_id")
    sample = cut(texts.groupBy("_id", "y", "third").agg(F.max("t").alias("t")))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, third, h, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                w = [x for x in windows(t) if len(x) <= WINDOW_BYTES]
                n = len(w)
                yield pa.RecordBatch.from_arrays([pa.array([y] * n, pa.int32()), pa.array([third] * n, pa.int32()), pa.array([h] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(w, pa.binary())], ["y", "third", "h", "pos", "w"])

    each = cut(sample.select("y", "third", F.xxhash64("_id").alias("h"), "t").mapInArrow(split, "y int, third int, h long, pos int, w binary"))
    some = lambda y, third: [bytes(r[0]) for r in each.where((F.col("y") == y) & (F.col("third") == third)).orderBy("h", "pos", "w").limit(max_windows).select("w").toLocalIterator()]
    ordinary, toxic = dictionaries((some(1, 0), some(1, 1)), some(0, 0) + some(0, 1), some(0, 2))
    model = Model(ordinary, toxic, np.zeros(2 + 2 * len(SAVINGS)))
    kinds = {(r["y"], r["third"]) for r in ids.select("y", "third").distinct().collect()}
    apart = sample.where("third = 2") if {(0, 2), (1, 2)} <= kinds else sample
    rows = _measure(apart, ["_id", "y"], F.col("t"), model, "x array<double>", lambda x: [pa.array(x.tolist(), pa.list_(pa.float64()))]).orderBy("_id").collect()
    model.coefficients = calibrated(np.array([r["x"] for r in rows]).reshape(-1, len(model.coefficients)), np.array([float(r["y"]) for r in rows]))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) of every whole text; score is the calibrated probability, predicted 1 from threshold on.

    Null and empty texts have the score of a text without any saving. Without labels of one kind all scores are 0 or 1 (0.5 without
    any). Repeated rows and null ids are scored like any other; other columns are not read.
    """

    def judge(x: np.ndarray) -> list[pa.Array]:
        p = 1 / (1 + np.exp(-np.clip(x @ model.coefficients, -30, 30)))
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    return _measure(docs, [id_col], F.col(text), model, "score double, predicted int", judge)
