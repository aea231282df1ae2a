"""Language identification: multinomial naive Bayes over hashed character n-grams, texts counted and scored a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

ORDERS = (1, 2, 3)
BITS = 14
SMOOTHING = 0.1
UNKNOWN = "und"
#: The model is broadcast: languages x 2**bits doubles stay below this; more languages get fewer bits, down to LEAST_BITS.
MODEL_BYTES, LEAST_BITS = 256 << 20, 8
#: Characters of texts that are worked on at once; longer texts are worked on in parts.
PART = 1 << 17
#: Languages that a task counts before it hands on what it has.
HELD = 256


def ngrams(texts: list[str], bits: int = BITS, part: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of texts, hash buckets) of all n-grams of the lower-cased texts' code points, some at a time; the numbers don't decrease."""
    over = max(ORDERS) - 1
    held: list[tuple[int, int, np.ndarray]] = []
    for i, t in enumerate(texts):
        a = np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        for at in range(0, max(len(a), 1), part):
            # a part begins with the last characters of the one before it
            own = a[max(at - over, 0) : at + part]
            if held and sum(len(x) for _, _, x in held) + len(own) > part:
                yield from _hashed(held, bits)
                held = []
            held.append((i, min(at, over), own))
    if held:
        yield from _hashed(held, bits)


def _hashed(parts: list[tuple[int, int, np.ndarray]], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    a = np.concatenate([x for _, _, x in parts]).astype(np.uint64)
    sizes = np.array([len(x) for _, _, x in parts])
    ends = np.cumsum(sizes)
    text, skip = np.repeat([i for i, _, _ in parts], sizes), np.repeat(ends - sizes + [s for _, s, _ in parts], sizes)
    end, place = np.repeat(ends, sizes), np.arange(len(a))
    for n in ORDERS:
        if len(a) < n:
            break
        m = len(a) - n + 1
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h + a[k : m + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        # inside its part, and not all of it among the repeated characters
        ok = (place[:m] + n <= end[:m]) & (place[:m] + n > skip[:m])
        yield text[:m][ok], ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)[ok]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", where: Column | None = None, bits: int = BITS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, log-probabilities (2**bits, languages) and log-priors from rows with a language and a letter in the text.

    Each task adds up its counts before they are shuffled; what reaches the driver is one count for each language and bucket. With so
    many languages that the model would be too large, neighbouring buckets are merged before that.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def counts() -> Iterator[pa.RecordBatch]:
            for g, c in sums.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([g] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(c[at], rows[g]), pa.int64())], ["lang", "bucket", "n"])
            sums.clear()
            rows.clear()

        for b in batches:
            by: dict[str, list[str]] = {}
            for t, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if has_letter(t):
                    by.setdefault(g, []).append(t)
            for g, texts in by.items():
                own = sums.setdefault(g, np.zeros(1 << bits, np.int64))
                rows[g] = rows.get(g, 0) + len(texts)
                for _, buckets in ngrams(texts, bits):
                    own += np.bincount(buckets, minlength=1 << bits)
                if len(sums) >= HELD:
                    yield from counts()
        yield from counts()

    kept = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = (kept if where is None else kept.where(where)).select(F.col(text).alias("t"), F.col(lang).alias("g")).mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = cut(counts)
    # one row with bucket -1 for each language
    n = counts.where("bucket = -1").count()
    fewer = bits
    while fewer > LEAST_BITS and n * 8 << fewer > MODEL_BYTES:
        fewer -= 1
    if n * 8 << fewer > MODEL_BYTES:
        raise ValueError(f"{n} languages make a model of more than {MODEL_BYTES} bytes even with {fewer} bits")
    if fewer < bits:
        counts = counts.groupBy("lang", F.expr(f"if(bucket < 0, bucket, bucket >> {bits - fewer})").alias("bucket")).agg(F.sum("n").alias("n"))
    table = counts.toPandas()
    langs = sorted(table["lang"].unique())
    w, prior = np.full((1 << fewer, len(langs)), SMOOTHING), np.zeros(len(langs))
    at = {g: i for i, g in enumerate(langs)}
    col, row, n_ = table["lang"].map(at).to_numpy(int), table["bucket"].to_numpy(int), table["n"].to_numpy(float)
    w[row[row >= 0], col[row >= 0]] += n_[row >= 0]
    prior[col[row < 0]] = n_[row < 0]
    if not langs:
        return langs, w, prior
    return langs, np.log(w / w.sum(axis=0)), np.log(prior / prior.sum())


def posteriors(texts: list[str], w: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Log-posteriors (texts, languages), up to a constant for each text: the rows of the matrix that a text's n-grams name, added up."""
    out = np.tile(prior, (len(texts), 1))
    for text, buckets in ngrams(texts, int(w.shape[0]).bit_length() - 1, max(4096, PART * 4 // max(w.shape[1], 4))):
        if len(text):
            begin = np.flatnonzero(np.diff(text, prepend=-1))
            out[text[begin]] += np.add.reduceat(w[buckets], begin, axis=0)
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text; score is the posterior probability of the language.

    Null texts, texts without a letter, and all texts when nothing was learned: `und` and 0. Equal posteriors: the first language in
    alphabetical order. Other columns are not read, so their names don't matter; repeated rows and null ids give results like any other.
    """
    langs, w, prior = model
    shared = docs.sparkSession.sparkContext.broadcast((w, prior))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, prior = shared.value
        for b in batches:
            names, scores = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows)
            texts = b.column(1).to_pylist()
            at = [i for i, t in enumerate(texts) if langs and has_letter(t)]
            s = posteriors([texts[i] for i in at], w, prior)
            if at:
                best = s.argmax(axis=1)
                names[at] = np.array(langs, object)[best]
                scores[at] = 1 / np.exp(s - s.max(axis=1)[:, None]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(score, f"`{id_col}` {kind}, lang_pred string, score double")
