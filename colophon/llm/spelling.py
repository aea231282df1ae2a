"""Spelling variants: words one edit apart, found through the one-edit neighbourhoods of their reduced forms.

Every letter is hashed to one of a few symbols, which turns a word into its reduced form; an edit of a word is an edit of its reduced
form at the same place, or none. So two words one edit apart have reduced forms that are equal or one edit apart, and are found by joining
the one-edit neighbourhoods of the reduced forms with the reduced vocabulary. Each edit is made from one of its two ends: what is inserted
in one word is deleted in the other, and a symbol is replaced by higher ones only. What meets is compared as it was written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

RUN = "[A-Za-zÀ-ÿ]+"
LETTERS = "".join(map(chr, [*range(97, 123), *range(0xC0, 0x100)]))
#: One occurrence of a run in so many loses a letter (a typing error that is made on purpose), and the fewest code points and occurrences of a word.
SLIP, LENGTH, LEAST = 31, 7, 2
#: A form must occur so many times as often as the word.
RATIO = 10
#: Reduced forms of the shortest words that there are for each word of the vocabulary, and words that may share one: with more of them the
#: letters are hashed to twice the symbols.
ROOM, SHARED = 4, 256
#: Hashes of reduced forms are sums of symbols times powers of an odd number, whose inverse takes a power back; both modulo 2**64.
POWER = 0x9E3779B97F4A7C15
BACK = pow(POWER, -1, 1 << 64)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of all whole texts and their occurrences; a null id is written as nothing before the colon."""
    d = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= LENGTH)
    d = d.select("doc", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("run")).alias("run"))
    d = d.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = d.select(F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST)


def letters(words: DataFrame) -> str:
    """LETTERS, those first that the most words hold."""
    n = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).groupBy("c").count()
    often = {r["c"]: r["count"] for r in n.collect()}
    return "".join(sorted(LETTERS, key=lambda c: (-often.get(c, 0), c)))


def alphabet(order: str, symbols: int) -> np.ndarray:
    """The symbol, from 1 to symbols, of each letter's code point: letters are dealt in their order, so common ones have symbols apart."""
    out = np.zeros(256, np.uint64)
    for i, c in enumerate(order):
        out[ord(c)] = i % symbols + 1
    return out


def reduced(word: Column, order: str, symbols: int) -> Column:
    """The reduced form as a text, in the order of symbols."""
    return F.translate(word, order, "".join(chr(32 + int(alphabet(order, symbols)[ord(c)])) for c in order))


def _short(h: np.ndarray) -> np.ndarray:
    return (((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def neighbourhoods(x: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own, rows, keys) of reduced forms of one length, a row of symbols each: the hash of each; and the hashes of all forms that lack one of
    its symbols, or have a higher one in place of one, and its own, each hash of a row once, with the row's number."""
    n, m = x.shape
    powers = np.array([pow(POWER, i, 1 << 64) for i in range(m)], np.uint64)
    part = x * powers
    upto = np.cumsum(part, axis=1, dtype=np.uint64)
    whole = upto[:, -1]
    rows, keys = [np.arange(n)], [whole]

    def add(at: np.ndarray, h: np.ndarray) -> None:
        rows.append(at)
        keys.append(h)

    for i in range(m):
        # of equal neighbours only the first is deleted
        at = np.flatnonzero(x[:, i] != x[:, i - 1]) if i else rows[0]
        add(at, (upto[:, i] - part[:, i] + (whole - upto[:, i]) * np.uint64(BACK))[at])
        for c in range(2, symbols + 1):
            at = np.flatnonzero(x[:, i] < c)
            add(at, whole[at] + (np.uint64(c) - x[at, i]) * powers[i])
    both = np.unique(np.concatenate(rows).astype(np.uint64) << np.uint64(32) | _short(np.concatenate(keys)).view(np.uint32))
    return _short(whole), (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def _hashed(words: DataFrame, order: str, symbols: int, all_: bool) -> DataFrame:
    """(id, key): the hash of each word's reduced form; with all_ those of its neighbourhood."""
    code = alphabet(order, symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_numpy(), [w.encode("latin-1") for w in b.column(1).to_pylist()]
            sizes = np.array(list(map(len, texts)), np.int64)
            for m in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == m)
                x = code[np.frombuffer(b"".join([texts[i] for i in at.tolist()]), np.uint8)].reshape(-1, m)
                # long words a few at a time
                for i in range(0, len(at), max(1, 200_000 // m)):
                    own, rows, keys = neighbourhoods(x[i : i + max(1, 200_000 // m)], symbols if all_ else 1)
                    part = ids[at[i : i + len(own)]]
                    yield pa.RecordBatch.from_arrays([pa.array(part[rows] if all_ else part), pa.array(keys if all_ else own)], ["id", "key"])

    return words.select("id", "word").mapInArrow(run, "id long, key int")


def symbols_for(words: DataFrame, order: str, shared: int = SHARED) -> int:
    """So many symbols that the shortest words have ROOM times more reduced forms than there are words, and twice that until no more than
    `shared` words have the same. With a symbol for each letter no two words share one: no group of words is compared in pairs,
    however its letters fall."""
    n, symbols = words.count(), 2
    while symbols**LENGTH < ROOM * n:
        symbols += 1
    while symbols < len(LETTERS):
        if words.groupBy(reduced(F.col("word"), order, symbols)).count().where(F.col("count") > shared).isEmpty():
            return symbols
        symbols *= 2
    return len(LETTERS)


def near_words(words: DataFrame, order: str = LETTERS, symbols: int | None = None) -> DataFrame:
    """(id, n, other, other_n): all pairs of words (id, word, n) that differ by exactly one inserted, deleted or replaced code point, both
    ways round, as the one's id and n and the other's word and n.

    Only hashes and ids are dealt out for the neighbourhoods. A word has each hash once, and of a pair only the longer word, or that with
    the lower reduced form or id, may find the other, so a pair is found once, whatever hashes meet.
    """
    symbols = symbols or symbols_for(words, order)
    form = lambda w: reduced(F.col(w), order, symbols)
    # words come in a few files: dealt out, so that many tasks make their neighbourhoods
    dealt = words.select("id", "word", "n").repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    asked = _hashed(dealt, order, symbols, True)
    of = _hashed(dealt, order, symbols, False).withColumnRenamed("id", "other_id")
    met = asked.join(of, "key").where("id <> other_id").select("id", "other_id")
    met = met.join(words.select(F.col("id").alias("other_id"), F.col("word").alias("other"), F.col("n").alias("other_n")), "other_id").join(words, "id")
    step = F.length("word") - F.length("other")
    first = (step == 1) | ((step == 0) & ((form("word") < form("other")) | ((form("word") == form("other")) & (F.col("id") < F.col("other_id")))))
    pairs = met.where((F.levenshtein("word", "other", 1) == 1) & first)
    way = lambda *names: F.struct(*(F.col(c).alias(x) for c, x in zip(names, ("id", "n", "other", "other_n"), strict=True)))
    return pairs.select(F.explode(F.array(way("id", "n", "other", "other_n"), way("other_id", "other_n", "word", "n"))).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the last of the forms that follow each other. Each round doubles the steps that are taken.

    A form is RATIO times as frequent as its word, so forms make no circle, and chains are as long as a count has digits at most."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = cut(now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    r"""(word, form, root, n, n_near, form_n) of every word of the texts.

    Words are runs of letters of LENGTH code points or more that occur LEAST times or more, A-Z in lower case; of a run of a document that a
    hash picks, one in SLIP, one letter is left out first. The form is the near word with the largest n, if that is ratio times the word's
    or more; ties go to the first in code-point order. The root is where forms lead, the word itself without one. Null and empty texts
    have no words; a null id picks as the empty text does; repeated rows count each; other columns are not read. A text is one row in
    memory, its runs are rows of their own.
    """
    words = cut(vocabulary(docs, id_col, text).withColumn("id", F.monotonically_increasing_id()))
    # minima, so that a task's pairs are one row for each word before they are dealt
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("form")))
    near = near_words(words, letters(words)).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.n") >= ratio * F.col("n")
    own = cut(words.join(near, "id", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.n")).alias("form_n")))
    last = roots(own.where("form is not null"))
    return own.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
