"""Language-model scores from a probabilistic suffix tree over words.

The root of the tree gives a word its share of the training tokens. A node below is a context of 1 to DEPTH words, with the words that
follow it at least LEAST times in the whole corpus. It stays in the tree if those words diverge enough from what the context without
its oldest word predicts: if they save GAIN bits or more altogether. Its distribution is smoothed with that shorter context's, and the
longest context in the tree before a word scores it. There is no other bound, so the tree grows with the corpus.

The tree is never brought together. Documents are coded in chunks, once; a chunk's n-grams go to the bucket of their hash, where all
chunks' counts are added, and the sums come back to the chunks that asked. Contexts are summed and tested the same way. Each round
reads the chunks where they lie (a bucketed table), and moves about 5 bytes for each different n-gram of a chunk.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, scratch

DEPTH = 2
#: Occurrences of a context, and of a word after it, that count.
LEAST = 2
#: Bits that a context must save, the weight of its parent in smoothing, and what is taken off each count for unseen words.
GAIN, PRIOR, DISCOUNT = 8.0, 2.0, 0.5
#: Tokens of a chunk at least: what a task holds at once. Blocks go from each chunk to each bucket, so larger corpora want larger chunks.
CHUNK_TOKENS = 1_200_000
ADD = 0.1
#: Bits of an n-gram's hash that are kept, and units of a bit in sums.
KEY_BITS, UNIT = 56, 1024
BLOCK = "bucket int, tag long, kind int, n int, keys binary, sums binary"
REPLY = "tag long, kind int, bucket int, reply binary, distinct long"


def pack(x: np.ndarray) -> bytes:
    """Whole numbers of 8 bytes, compressed byte by byte: all first bytes, then all second ones, and so on."""
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(raw: bytes, kind: type = np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1).T).view(kind).ravel()


def chunks(docs: DataFrame, held_out: Column, id_col: str, text: str, size: int = CHUNK_TOKENS) -> DataFrame:
    """A row for each chunk of documents: (tag, ids, held_out, sizes, tokens, words, n_train).

    tokens are the places, in words, of all documents' tokens; a word is known by the XXH64 of its UTF-8 bytes, and the end of a text by
    that of no bytes. n_train counts the tokens of training documents.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        names, held, tokens, id_type = [], [], [], pa.int64()

        def chunk() -> pa.RecordBatch:
            sizes = list(map(len, tokens))
            words = np.array([xxhash.xxh64_intdigest(w, 42) for w in number], np.uint64)
            row = [uuid.uuid4().int >> 65, names, held, sizes, zstandard.compress(np.concatenate(tokens).tobytes(), 3), words.tobytes(), sum(n for n, out in zip(sizes, held, strict=True) if not out)]
            types = [pa.int64(), pa.list_(id_type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], ["tag", "ids", "held_out", "sizes", "tokens", "words", "n_train"])
            for x in (names, held, tokens, number):
                x.clear()
            return out

        total = 0
        for b in batches:
            id_type = b.schema.field(0).type
            for d, t, out in zip(*(c.to_pylist() for c in b.columns), strict=True):
                tokens.append(np.fromiter(map(number.__getitem__, [*(t or b"").lower().split(), b""]), np.uint32))
                names.append(d)
                held.append(out)
                total += len(tokens[-1])
                if total >= size:
                    yield chunk()
                    total = 0
        if tokens:
            yield chunk()

    x = docs.select(id_col, F.col(text).cast("binary"), F.coalesce(held_out, F.lit(True)))
    return x.mapInArrow(run, f"tag long, ids array<{kind}>, held_out array<boolean>, sizes array<int>, tokens binary, words binary, n_train long")


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """df written once, dealt by key, so that no later grouping by key moves it. The table's name is given up at once, its files stay."""
    spark = df.sparkSession
    name, n = f"colophon_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(n, key).option("path", scratch(spark)).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"drop table {name}")
    return out


class Grams:
    """The n-grams of one order in a chunk: keys are the different ones, sorted.

    at: places of a chunk where one ends; of: for each of these, its number among the keys; place: the same for each place of the chunk, -1
    where none ends; one: for each key, a place where it ends; own: occurrences in the chunk's training documents; asked: whether its count is wanted; n, first: its count in the corpus and whether
    this chunk is the one that reports it; p: its last word's probability after the others.
    """

    def __init__(self, keys: np.ndarray, at: np.ndarray | None, train: np.ndarray, of: np.ndarray | None = None):
        """keys: of each place in at; or the different keys, and for each place of the chunk its number among them."""
        if of is None:
            order = np.argsort(keys)
            keys = keys[order]
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            self.keys, self.one = keys[new], at[order[new]]
            self.of = np.empty(len(order), np.int32)
            self.of[order] = np.cumsum(new, dtype=np.int32) - 1
            self.place = np.full(len(train), -1, np.int32)
            self.place[at] = self.of
            train = train[at]
        else:
            self.keys, self.of, self.place = keys, of, of
        self.at = at
        self.own = np.bincount(self.of[train], minlength=len(self.keys))
        self.asked = np.ones(len(self.keys), bool)
        self.n = self.first = self.p = None


class Chunk:
    """A chunk with what is known so far: replies gives, by kind, the sums that came back; order k has kinds 2k (counts) and 2k + 1 (contexts)."""

    def __init__(self, row: dict, replies: dict[int, np.ndarray], total: int, distinct: int, depth: int):
        tokens = np.frombuffer(zstandard.decompress(row["tokens"]), np.uint32)
        self.sizes, self.tag = np.array(row["sizes"], np.int64), row["tag"]
        self.starts = np.cumsum(self.sizes) - self.sizes
        words = np.frombuffer(row["words"], np.uint64)
        train = np.repeat(~np.array(row["held_out"], bool), self.sizes)
        inside = np.ones(len(tokens), bool)
        inside[self.starts] = False
        norm = total + ADD * (distinct + 1)
        full = last = words[tokens]
        drop = np.uint64(64 - KEY_BITS)
        self.grams: list[Grams] = []
        for k in range(1, depth + 2):
            if k == 1:
                keys, number = np.unique(words >> drop, return_inverse=True)
                g = Grams(keys, None, train, number.astype(np.int32)[tokens])
            else:
                low = self.grams[-1]
                at = np.flatnonzero(inside).astype(np.int32)
                if k > 2:
                    # a context that occurs less often than counts has no node
                    context = low.place[at - 1]
                    at = at[np.where(context >= 0, low.n[context] >= LEAST, False)]
                mixed = (full[:-1] * np.uint64(0x9E3779B97F4A7C15) + last[1:]) * np.uint64(0xBF58476D1CE4E5B9)
                full = np.concatenate([last[:1], mixed ^ (mixed >> np.uint64(29))])
                g = Grams(full[at] >> drop, at, train)
                g.context, g.tail = low.place[g.one - 1], low.place[g.one]
                if k > 2:
                    g.asked = low.n[g.tail] >= LEAST
            self.grams.append(g)
            if 2 * k not in replies:
                if k == 1:  # words and pairs are asked for together
                    continue
                break
            g.n, g.first = np.zeros(len(g.keys), np.int64), np.zeros(len(g.keys), bool)
            g.n[g.asked], g.first[g.asked] = replies[2 * k] >> 1, replies[2 * k] & 1 > 0
            if k == 1:
                g.p = (g.n + ADD) / norm
                continue
            follows = np.zeros(len(low.keys), bool)
            follows[g.context] = True
            g.nodes = np.flatnonzero(follows & (low.n >= LEAST))
            if 2 * k + 1 not in replies:
                continue
            seen, kinds = np.zeros((2, len(low.keys)))
            seen[g.nodes], kinds[g.nodes] = replies[2 * k + 1].reshape(2, -1)
            here, n = seen[g.context], low.n[g.context]
            left = n - here + DISCOUNT * kinds[g.context]
            g.p = np.where(here > 0, (np.maximum(g.n - DISCOUNT, 0) + (left + PRIOR) * low.p[g.tail]) / (n + PRIOR), low.p[g.tail])

    def counts(self, k: int) -> tuple[int, np.ndarray, np.ndarray]:
        g = self.grams[k - 1]
        return 2 * k, g.keys[g.asked], g.own[g.asked][None]

    def contexts(self, k: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Of each context of order k's n-grams: occurrences and number of the words after it that this chunk reports, and what they save."""
        g, low = self.grams[k - 1], self.grams[k - 2]
        mine = np.flatnonzero(g.first)
        n, context = g.n[mine], g.context[mine]
        saved = np.rint(n * np.log2(n / low.n[context] / low.p[g.tail[mine]]) * UNIT)
        sums = np.stack([np.bincount(context, weights=w, minlength=len(low.keys)) for w in (n, np.ones(len(n)), saved)])
        return 2 * k + 1, low.keys[g.nodes], sums[:, g.nodes].astype(np.int64)

    def scores(self) -> tuple[np.ndarray, ...]:
        """Of each document: tokens, known tokens, log10 by the root alone, log10 by the tree."""
        low = self.grams[0]
        base = np.log10(low.p)[low.of]
        best = base.copy()
        for g in self.grams[1:]:
            best[g.at] = np.log10(g.p)[g.of]
        add = lambda x: np.add.reduceat(x, self.starts)
        return self.sizes, add((low.n > 0)[low.of].astype(np.int64)), add(base), add(best)


def _blocks(tag: int, kind: int, keys: np.ndarray, sums: np.ndarray, bits: int) -> list[tuple]:
    """A row for each bucket, the first bits of a key, that has keys: their differences, and their sums."""
    ends = np.searchsorted(keys, np.arange(1, (1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS - bits))
    cuts = zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)
    return [(b, tag, kind, hi - lo, pack(np.diff(keys[lo:hi], prepend=np.uint64(0))), pack(sums[:, lo:hi])) for b, (lo, hi) in enumerate(cuts) if hi > lo]


def _tally(t: pa.Table) -> pa.Table:
    """Replies to the blocks of a bucket: for counts twice the sum, plus one in the one block that shall report it (sums under LEAST of two
    words or more: 0); for contexts the sums of those that stay in the tree, else 0."""
    out = []
    kinds = np.array(t["kind"])
    for kind in np.unique(kinds).tolist():
        rows = t.filter(pa.array(kinds == kind)).to_pylist()
        keys = np.concatenate([np.cumsum(unpack(r["keys"], np.uint64), dtype=np.uint64) for r in rows])
        sums = np.concatenate([unpack(r["sums"]).reshape(-1, r["n"]) for r in rows], axis=1)
        order = np.argsort(keys, kind="stable")
        new = np.diff(keys[order], prepend=keys[order[:1]] + np.uint64(1)) != 0
        begin = np.flatnonzero(new)
        sums = np.add.reduceat(sums[:, order], begin, axis=1)
        of = np.empty(len(keys), np.int64)
        of[order] = np.cumsum(new) - 1
        if kind % 2:
            reply = np.where(sums[2] >= GAIN * UNIT, sums[:2], 0)[:, of]
        else:
            total = np.where(sums[0] >= (LEAST if kind > 2 else 1), sums[0], 0)
            reply = 2 * total[of]
            reply[order[begin]] += total > 0
            reply = reply[None]
        at = 0
        for r in rows:
            out.append((r["tag"], kind, r["bucket"], pack(reply[:, at : at + r["n"]]), int((sums[0] > 0).sum()) if at == 0 and kind == 2 else 0))
            at += r["n"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
    return pa.table([pa.array(c, x) for c, x in zip(zip(*out, strict=True), types, strict=True)], ["tag", "kind", "bucket", "reply", "distinct"])


def _joined(t: pa.Table) -> dict[int, np.ndarray]:
    """A chunk's replies by kind, each put together from its buckets in order."""
    parts: dict[int, list] = {}
    for r in sorted(t.to_pylist(), key=lambda r: (r["kind"], r["bucket"])):
        parts.setdefault(r["kind"], []).append(unpack(r["reply"]).reshape(1 + r["kind"] % 2, -1))
    return {k: np.concatenate(v, axis=1).ravel() for k, v in parts.items()}


class _Replies(dict):
    """Kinds that were asked for but had no key have an empty reply."""

    def __init__(self, known: dict[int, np.ndarray], asked: set[int]):
        super().__init__({k: np.zeros(0, np.int64) for k in asked} | known)


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text", depth: int = DEPTH, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, gain) of every whole text.

    Tokens are words and one end; the model learns from rows that held_out does not select (null counts as held out). base_score
    is the unigram score with 0.1 added to each count, score that of the suffix tree, both in log10; gain is what contexts add to a
    token. Null texts are empty: only their end is scored. Without training rows both scores are 0. Repeated rows are counted and
    scored each on their own, null ids too; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    made = bucketed(chunks(docs, held_out, id_col, text, chunk_tokens), "tag")
    n, total = made.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    bits = max(6, (n // 2).bit_length())
    coded = made.select("tag", "held_out", "sizes", "tokens", "words")

    def send(c: Chunk, round_: int) -> pa.Table:
        """Round 1 counts words and pairs; round r tests the contexts of r words' n-grams, and counts those of one word more."""
        ask = [c.counts(k) for k in (1, 2) if k <= depth + 1] if round_ == 1 else [c.contexts(round_), *([c.counts(round_ + 1)] if round_ <= depth else [])]
        rows = [r for kind_, keys, sums in ask for r in _blocks(c.tag, kind_, keys, sums, bits)]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.table([pa.array(col, t) for col, t in zip(columns, types, strict=True)], ["bucket", "tag", "kind", "n", "keys", "sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from send(Chunk(b.slice(i, 1).to_pylist()[0], {}, 0, 0, 1), 1).to_batches()

    def with_replies(f: Callable[[Chunk, pa.Table], pa.Table], known: set[int], distinct: int):
        def run(key: tuple, x: pa.Table, y: pa.Table) -> pa.Table:
            return f(Chunk(x.to_pylist()[0], _Replies(_joined(y), known), total, distinct, depth), x)

        return run

    tally = lambda blocks: cut(blocks.groupBy("bucket").applyInArrow(_tally, REPLY))
    replies = tally(coded.mapInArrow(first, BLOCK))
    distinct = replies.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    known = {2, 4} if depth else {2}
    for r in range(2, depth + 2):
        back = coded.groupBy("tag").cogroup(replies.groupBy("tag"))
        replies = replies.union(tally(back.applyInArrow(with_replies(lambda c, _, r=r: send(c, r), set(known), distinct), BLOCK)))
        known |= {2 * r + 1} | ({2 * r + 2} if r <= depth else set())

    def scores(c: Chunk, x: pa.Table) -> pa.Table:
        tokens, seen, base, best = c.scores()
        flat = [x[name].combine_chunks().flatten() for name in ("ids", "held_out")]
        return pa.table([*flat, tokens, seen, np.full(len(tokens), total), base, best, (best - base) / tokens], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "gain"])

    back = made.select("tag", "ids", "held_out", "sizes", "tokens", "words").groupBy("tag").cogroup(replies.groupBy("tag"))
    out = back.applyInArrow(with_replies(scores, known, distinct), f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, gain double")
    return out.withColumnRenamed("id", id_col)
