"""Collocations: phrases counted by a multikey three-way quicksort of suffix pointers, scored by how much more often their words meet
than their parts would by chance.

Every word of a piece of text begins a suffix of up to DEPTH words. A task sorts the suffixes of some million words and sends equal ones
as one, with their number, to the bucket of their leading words: of the first word alone, or of the first two or three if that
is so frequent that its suffixes would be too many for one task. A bucket's suffixes lie in one task; there a three-way quicksort takes
them apart word by word. The size of an equal partition is the count of its words, and a partition of fewer than LEAST is given up
unsorted. Only of leading words that are split among buckets the sizes are parts, which are added up afterwards.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

DEPTH, LEAST, TOP = 3, 10, 2000
#: A candidate goes if a longer one holds it in this share (of 100) of its occurrences.
HELD = 50
#: Words that a task sorts before it sends them, and suffixes of a bucket: leading words with half as many are split further.
CHUNK, BUCKET = 1_000_000, 1_000_000
UNIT = 1_000_000
#: Partitions of fewer suffixes are taken apart in one pass, not around a pivot.
FEW = 128
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))


def marked(text: bytes | None) -> bytes:
    """A UTF-8 text with A-Z in lower case, single spaces around each word, or more, and a line end as a word wherever a piece ends."""
    return (text or b"").translate(_FOLD).replace(b"\n", b" \n ") + b" \n"


def _folded(columns: list[np.ndarray]) -> np.ndarray:
    """One whole number for each row, in the order of the columns' whole numbers, the first first."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        width = int(c.max(initial=0)) + 1
        if int(key.max(initial=0)) >= (1 << 62) // width:
            key = np.unique(key, return_inverse=True)[1]
        key = key * width + c
    return key


class _Chunk:
    """Some texts, and their suffixes: codes of languages and words from 1, 0 where a piece has ended."""

    def __init__(self) -> None:
        self.langs: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.own: list[int] = []
        self.sizes: list[int] = []
        self.size = 0

    def add(self, lang: bytes, text: bytes | None) -> None:
        self.texts.append(marked(text))
        self.own.append(self.langs.setdefault(lang, len(self.langs) + 1))
        self.sizes.append(self.texts[-1].count(b" ") + 1)
        self.size += self.sizes[-1]

    def close(self) -> None:
        """Words become codes: from here on flat and lang have the chunk's words and ends, and names the texts of languages and words."""
        found = pc.split_pattern(pa.array([b" ".join(self.texts)], pa.binary()), " ").flatten().dictionary_encode()
        words = found.dictionary
        code = np.ones(len(words), np.int32)
        for word, n in ((b"\n", 0), (b"", -1)):
            if (i := pc.index(words, pa.scalar(word, pa.binary())).as_py()) >= 0:
                code[i] = n
        real = code == 1
        code[real] = np.arange(1, real.sum() + 1)
        flat = code[found.indices.to_numpy()]
        self.lang = np.repeat(np.array(self.own), self.sizes)[flat >= 0]
        self.flat = flat[flat >= 0]
        self.names = pa.array([b"", *self.langs], pa.binary()), pa.concat_arrays([pa.array([b""], pa.binary()), words.filter(pa.array(real))])
        self.texts = []

    def columns(self, depth: int, often: np.ndarray | None = None) -> list[np.ndarray]:
        """The language and the words of each suffix; often: of those only that begin with such a word (a flag for each)."""
        flat = np.concatenate([self.flat, np.zeros(depth, np.int32)])
        at = np.flatnonzero(flat[:-depth] if often is None else often[flat[:-depth]])
        columns = [self.lang[at], flat[at]]
        for k in range(1, depth):
            columns.append(np.where(columns[-1] > 0, flat[at + k], 0))
        return columns


def _sorted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows in order, and how often each occurs."""
    key = _folded(columns)
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.diff(key[order], prepend=-1))
    return [c[order[new]] for c in columns], np.diff(np.append(new, len(order)))


def _hash(names: tuple[pa.Array, pa.Array], columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of leading words, a language and one word or more each."""
    parts = [pc.take(names[min(i, 1)], pa.array(c)) for i, c in enumerate(columns)]
    lines = pc.binary_join_element_wise(*parts, b"\t").to_pylist()
    return np.array([xxhash.xxh64_intdigest(x) for x in lines], np.uint64)


def _begins(columns: list[np.ndarray]) -> np.ndarray:
    """Whether a row of ordered columns differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _chunked(docs: DataFrame, lang: str, text: str, f, schema: str, chunk: int) -> DataFrame:
    """f applied to chunks of texts; a null language is `und`, and null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _Chunk()
        for b in batches:
            for own, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                c.add(own, t.as_py())
                if c.size >= chunk:
                    c.close()
                    yield from f(c)
                    c = _Chunk()
        if c.size:
            c.close()
            yield from f(c)

    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).cast("binary"), F.col(text).cast("binary")).mapInArrow(run, schema)


def survey(docs: DataFrame, n_words: int, lang: str = "lang", text: str = "text", depth: int = DEPTH, chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """Rows (lang, n, lead): each chunk's number of words of a language, and with a lead, the hash of leading words, what these begin in it.

    A chunk reports leading words, but not whole suffixes, with half the share of all (about n_words) that would be half a bucket. So
    none that is hot altogether is missed, and reports are few.
    """
    share = min(1.0, bucket / 2 / max(1, n_words))

    def report(c: _Chunk) -> Iterator[pa.RecordBatch]:
        names = c.names
        (langs, words) = c.columns(1)
        least = max(1.0, share / 2 * len(words))
        of_lang = np.bincount(langs, minlength=len(names[0]))
        yield pa.RecordBatch.from_arrays([names[0].slice(1), pa.array(of_lang[1:], pa.int64()), pa.nulls(len(c.langs), pa.int64())], ["lang", "n", "lead"])
        # leads of several words are only looked for where the word before leads often enough; 0 ends a piece
        often = np.bincount(words, minlength=len(names[1])) >= least
        often[0] = False
        for k in range(1, depth) if often.any() else ():
            columns, n = _sorted(c.columns(k, often))
            hot = (n >= least) & (columns[k] > 0)
            columns = [x[hot] for x in columns]
            yield pa.RecordBatch.from_arrays([pc.take(names[0], pa.array(columns[0])), pa.array(n[hot], pa.int64()), pa.array(_hash(names, columns).view(np.int64))], ["lang", "n", "lead"])

    return cut(_chunked(docs, lang, text, report, "lang binary, n long, lead long", chunk))


def hot_leads(found: DataFrame, bucket: int = BUCKET) -> np.ndarray:
    """Sorted hashes of the leading words of a survey that begin over half a bucket's suffixes: for each length so many at most as there are
    half buckets of words, of 8 bytes each."""
    hot = found.where("lead is not null").groupBy("lead").agg(F.sum("n").alias("n")).where(F.col("n") >= bucket // 4)
    return np.sort(np.array([r[0] for r in hot.select("lead").collect()], np.int64).view(np.uint64))


def suffixes(docs: DataFrame, hot: np.ndarray, buckets: int, lang: str = "lang", text: str = "text", depth: int = DEPTH, chunk: int = CHUNK) -> DataFrame:
    """Rows (bucket, lang, fixed, lines): the different suffixes of a chunk that go to a bucket, of one language, and led by so many words.

    lines: for each suffix its words, as many as depth, and its number, between single spaces. There are no more rows of a chunk than leading
    words, however many buckets there are.
    """

    def send(c: _Chunk) -> Iterator[pa.RecordBatch]:
        columns, n = _sorted(c.columns(depth))
        names = c.names
        fixed, hashes = np.ones(len(n), np.int64), np.zeros(len(n), np.uint64)
        for k in range(1, depth + 1):
            # the leading words so far, of suffixes whose shorter leading words are all hot
            own = np.flatnonzero(fixed == k)
            if not len(own):
                break
            lead = [x[own] for x in columns[: k + 1]]
            new = _begins(lead)
            of = _hash(names, [x[new] for x in lead])
            hashes[own] = of[np.cumsum(new) - 1]
            if k < depth:
                fixed[own[np.isin(hashes[own], hot)]] = k + 1
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(_folded([columns[0], fixed, bucket]), kind="stable")
        texts = [pc.take(names[1], pa.array(x[order])) for x in columns[1:]]
        lines = pc.binary_join_element_wise(*texts, pc.cast(pc.cast(pa.array(n[order]), pa.string()), pa.binary()), b" ")
        keys = [columns[0][order], fixed[order], bucket[order]]
        first = np.flatnonzero(_begins(keys))
        # a large row is cut
        size = np.diff(np.append(first, len(n)))
        first = np.concatenate([np.arange(a, a + s, 65536) for a, s in zip(first.tolist(), size.tolist(), strict=True)]) if (size > 65536).any() else first
        for i in range(0, len(first), 512):
            at = first[i : i + 512]
            end = int(first[i + 512]) if i + 512 < len(first) else len(n)
            offsets = pa.array((np.append(at, end) - at[0]).astype(np.int32))
            blobs = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.slice(int(at[0]), end - int(at[0]))), b"\n")
            yield pa.RecordBatch.from_arrays([pa.array(keys[2][at]), pc.take(names[0], pa.array(keys[0][at])), pa.array(keys[1][at], pa.int32()), blobs], ["bucket", "lang", "fixed", "lines"])

    return _chunked(docs, lang, text, send, "bucket long, lang binary, fixed int, lines binary", chunk)


def equal_partitions(keys: list[np.ndarray], weight: np.ndarray, fixed: int, least: int, parts: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(row, words, size) of a multikey three-way quicksort: for each equal partition a row of it, how many words it shares, and its weight.

    keys: the language's codes, then each word's, 0 where the suffix has ended; parts: the rows, as they are dealt already. A partition
    lighter than least is given up, unless it shares fewer than `fixed` words: then it is a part of what lies in other buckets too.
    """
    todo = [(p, 0) for p in parts]
    while todo:
        rows, d = todo.pop()
        if len(rows) < FEW:
            yield from _few([k[rows].tolist() for k in keys[d:]], weight[rows].tolist(), rows.tolist(), d, fixed, least)
            continue
        k = keys[d][rows]
        pivot = sorted((int(k[0]), int(k[len(k) >> 1]), int(k[-1])))[1]
        under, over = k < pivot, k > pivot
        low, high, same = rows[under], rows[over], rows[~(under | over)]
        size = int(weight[same].sum())
        for p in (low, high):
            if len(p) and (d < fixed or len(p) >= least or int(weight[p].sum()) >= least):
                todo.append((p, d))
        if (size >= least or d < fixed) and (d == 0 or pivot):
            if d:
                yield int(same[0]), d, size
            if d + 1 < len(keys):
                todo.append((same, d + 1))


def _few(keys: list[list[int]], weight: list[int], rows: list[int], depth: int, fixed: int, least: int) -> Iterator[tuple[int, int, int]]:
    """As equal_partitions, of few rows that share `depth` words, with their keys from there on: each partition is taken apart in one pass."""
    todo: list[tuple] = [(range(len(rows)), 0)]
    while todo:
        part, i = todo.pop()
        k, d, equal = keys[i], depth + i, {}
        for r in part:
            x = k[r]
            if x in equal:
                equal[x].append(r)
            else:
                equal[x] = [r]
        for x, same in equal.items():
            size = sum([weight[r] for r in same])
            if (size >= least or d < fixed) and (d == 0 or x):
                if d:
                    yield rows[same[0]], d, size
                if i + 1 < len(keys):
                    todo.append((same, i + 1))


def _count(t: pa.Table, depth: int, least: int) -> pa.Table:
    """(lang, words, phrase, n) of a bucket's suffixes."""
    out = []
    for f in pc.unique(t["fixed"]).to_pylist():
        own = t.filter(pc.equal(t["fixed"], f))
        blobs = own["lines"].to_pylist()
        names = [f"w{i}" for i in range(depth)]
        # the first line names the columns, so that no word is taken for a mark of the encoding
        raw = " ".join([*names, "n"]).encode() + b"\n" + b"\n".join(blobs) + b"\n"
        kinds = {w: pa.dictionary(pa.int32(), pa.binary()) for w in names} | {"n": pa.int64()}
        read = pa.csv.read_csv(io.BytesIO(raw), pa.csv.ReadOptions(use_threads=False), pa.csv.ParseOptions(delimiter=" ", quote_char=False, escape_char=False, newlines_in_values=False), pa.csv.ConvertOptions(column_types=kinds, check_utf8=False, strings_can_be_null=False))
        encoded = [read[w].unify_dictionaries().combine_chunks() for w in names]
        codes, texts = [], []
        for e in encoded:
            e = e.chunk(0) if isinstance(e, pa.ChunkedArray) else e
            words = e.dictionary.to_pylist()
            none = words.index(b"") if b"" in words else -1
            code = e.indices.to_numpy() + 1
            codes.append(np.where(code == none + 1, 0, code) if none >= 0 else code)
            texts.append([b"", *words])
        lang = own["lang"].combine_chunks().dictionary_encode()
        lines = np.array([b.count(b"\n") + 1 for b in blobs])
        keys, weight = [np.repeat(lang.indices.to_numpy(), lines), *codes], read["n"].to_numpy()
        # the suffixes of each lead; leads that are too light, which most are, go at once
        lead = _folded(keys[: f + 1])
        order = np.argsort(lead, kind="stable")
        first = np.flatnonzero(np.diff(lead[order], prepend=-1))
        ends = np.append(first[1:], len(order))
        stay = (np.add.reduceat(weight[order], first) >= least) if f == 1 else np.ones(len(first), bool)
        parts = [order[i:j] for i, j in zip(first[stay].tolist(), ends[stay].tolist(), strict=True)]
        known = lang.dictionary.to_pylist()
        for row, words, n in equal_partitions(keys, weight, f, least, parts):
            out.append((known[keys[0][row]], words, b" ".join([texts[i][codes[i][row]] for i in range(words)]), n))
    columns = list(zip(*out, strict=True)) or [()] * 4
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, (pa.binary(), pa.int32(), pa.binary(), pa.int64()), strict=True)], ["lang", "words", "phrase", "n"])


def counts(docs: DataFrame, hot: np.ndarray, buckets: int, lang: str = "lang", text: str = "text", depth: int = DEPTH, least: int = LEAST, chunk: int = CHUNK) -> DataFrame:
    """(lang, words, phrase, n): every phrase of 1 to depth words that occurs least times or more in a language, its words joined by spaces."""
    sent = suffixes(docs, hot, buckets, lang, text, depth, chunk)
    parts = sent.groupBy("bucket").applyInArrow(lambda t: _count(t, depth, least), "lang binary, words int, phrase binary, n long")
    return parts.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least).withColumns({c: F.col(c).cast("string") for c in ("lang", "phrase")})


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", depth: int = DEPTH, least: int = LEAST, held: int = HELD, top: int = TOP, chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` collocations of each language.

    Words are what stands between spaces and tabs, A-Z in lower case; no phrase goes over `.,;:!?` or a line end. A phrase of 2 to depth
    words with a >= least occurrences is a candidate. Cut after its first words, the two parts occur l and r times, and score is the floor
    of UNIT * a * a / (l * r), in exact arithmetic; the lowest-scoring cut counts, and the shortest first part of several. A candidate is
    dropped if a longer one, dropped or not, holds its words next to each other and occurs held % as often or more. Order: score and a
    falling, phrase in the order of its bytes. n counts the language's words. A null language is `und`, null and empty texts
    have no words, repeated rows count each, other columns are not read. A text is part of one chunk, whole.
    """
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_words = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0] // 6
    seen = survey(docs, n_words, lang, text, depth, chunk, bucket)
    f = cut(counts(docs, hot_leads(seen, bucket), max(shares, 2 * n_words // bucket), lang, text, depth, least, chunk))
    c = f.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    some = lambda w, i, n: F.array_join(F.slice(w, i, n), " ")
    cuts = c.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", some(F.col("w"), F.lit(1), F.col("k")).alias("left"), some(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    part = lambda name, n: f.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    exact = lambda x: F.col(x).cast("decimal(15,0)")
    cuts = cuts.withColumns({"up": exact("a") * exact("a") * F.lit(UNIT).cast("decimal(7,0)"), "down": exact("l") * exact("r")})
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("s"))
    # the shorter phrases inside each candidate, with its count
    inside = c.where("words > 2").select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("n")).select("lang", "a", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("i"))
    holds = inside.groupBy("lang", some(F.col("w"), F.col("i"), F.col("n")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(holds, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < held * F.col("a"), F.lit(True)))
    kept = cut(kept.select("lang", "phrase", "a", "s.l", "s.r", "s.score"))
    order = (F.desc("score"), F.desc("a"), "phrase")
    # first within shares of a language, then of fewer, so that no task ranks all of it
    for n in (shares, 16):
        share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(n))).orderBy(*order)
        kept = kept.withColumn("_n", F.row_number().over(share)).where(F.col("_n") <= top).drop("_n")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = seen.where("lead is null").groupBy(F.col("lang").cast("string").alias("lang")).agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
