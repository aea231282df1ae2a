"""Packing into training sequences: several window sizes, long windows filled up from short tiers, steps of equal size."""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS

BLANK = re.compile("[ \t-\r]+")
END_ID = 2
#: Window sizes of the tiers, each a power of two; the last is the longest sequence.
TIERS = (512, 1024, 2048, 4096)
#: Tokens packed together: a task works through its rows in groups of about this many.
GROUP = 1 << 21
#: Tokens of a step.
STEP = 1 << 16
#: Distinct words whose ids a task remembers before it starts anew.
CACHE = 700_000
#: The tokenizer's way of splitting that WordIds relies on (fixed values); texts of other tokenizers are encoded whole.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_chars() -> dict[int, int]:
    """Byte-level tokenizers write a byte as a character: printable ones as they are, the others as those from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class WordIds(dict):
    """Token ids of words, as little-endian uint32 bytes, each word encoded once; a text is the join of its words.

    That holds for tokenizers that split at white space and drop it, which the file's own description tells; texts are encoded whole
    with any other. A word of letters, in normal form and lower case, is one piece to the tokenizer, so it goes to its merges directly;
    a full stop or comma after such a word is a piece of its own. All other words are encoded as texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.table = self.tokenizer.model, byte_chars()
        made = json.loads(self.tokenizer.to_str())
        steps, split = made["normalizer"] or {}, made["pre_tokenizer"] or {}
        first, *rest = split.get("pretokenizers") or [{}]
        self.by_words = steps.get("normalizers") == NORMALIZERS and first.get("pattern") == {"Regex": WORD_PATTERN} and first.get("behavior") == "Removed" and first.get("invert") is True and [(x["type"], x.get("use_regex"), x.get("add_prefix_space")) for x in rest] == [("ByteLevel", False, False)]
        self.marks = {m: self.whole(m) for m in ".,"}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def letters(self, word: str) -> str | None:
        """A word of letters in the form that the tokenizer makes of it; None if that isn't letters alone."""
        if word.isascii():
            return word.lower() if word.isalpha() else None
        if not word.isalpha():
            return None
        plain = "".join(c.lower() for c in unicodedata.normalize("NFC", word))
        return plain if plain.isalpha() and unicodedata.is_normalized("NFC", plain) else None

    def __missing__(self, word: str) -> bytes:
        stem = word[:-1] if len(word) > 1 and word[-1] in self.marks else word
        plain = self.letters(stem)
        if plain is None:
            ids = self.whole(word)
        elif stem is not word:
            ids = self[stem] + self.marks[word[-1]]
        elif plain != word:
            ids = self[plain]
        else:
            found = self.model.tokenize(plain if plain.isascii() else plain.encode().decode("latin-1").translate(self.table))
            ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        self[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        end = struct.pack("<I", END_ID)
        if not self.by_words:
            return [np.array(e.ids, "<u4").tobytes() + end for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self) > CACHE:
            self.clear()
        get, out = self.__getitem__, []
        for t in texts:
            # str.split() also splits at the separators x1c to x1f, which are no white space to the tokenizer
            own = BLANK.split(t.strip(BLANKS)) if any(c in t for c in "\x1c\x1d\x1e\x1f") and t.strip(BLANKS) else t.split()
            out.append(b"".join(map(get, own)) + end)
        return out


def fill(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[tuple[int, int, int]]]], list[tuple[int, int, int]]]:
    """Full windows (size, [(document, start, length), ...]) of documents of these lengths, and the pieces of the one that stays open.

    A document is routed to the smallest tier that holds it; longer ones give full windows of the last tier first and route what
    remains. The tiers are packed from the longest down, best fit by decreasing length. What a window has left over is filled
    from the shorter tiers, the last document that fits the gap whole or, if none is that short, a part of the next one, whose rest
    goes on to its own tier. Only when every document is used up can a window stay open.
    """
    top = tiers[-1]
    rest_of: list[tuple[int, int, int]] = []
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    pools: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}

    def route(doc: int, start: int, length: int) -> None:
        if length:
            pools[next(t for t in tiers if length <= t)].append((length, doc, start))

    for doc, n in enumerate(lengths):
        whole = n - n % top
        out.extend((top, [(doc, s, top)]) for s in range(0, whole, top))
        route(doc, whole, n - whole)
    for tier in reversed(tiers):
        pool = sorted(pools[tier])
        pools[tier] = []
        while pool:
            length, doc, start = pool.pop()
            window, gap = [(doc, start, length)], tier - length
            while gap:
                if pool and pool[0][0] <= gap:
                    k = _last_fit(pool, gap)
                    length, doc, start = pool.pop(k)
                else:
                    source = next((pools[t] for t in reversed(tiers) if t < tier and pools[t]), None) or pool
                    if not source:
                        break
                    length, doc, start = source.pop()
                    if length > gap:
                        rest = (length - gap, doc, start + gap)
                        length = gap
                        if source is pool:
                            pool.insert(_last_fit(pool, rest[0]) + 1, rest)
                        else:
                            route(rest[1], rest[2], rest[0])
                window.append((doc, start, length))
                gap -= length
            if not gap:
                out.append((tier, window))
            else:
                rest_of = window
    return out, rest_of


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """As fill, with the open window cut into powers of two: every token is in exactly one piece, and nothing is padded."""
    full, rest = fill(lengths, tiers)
    return full + _powers(rest)


def _last_fit(pool: list[tuple[int, int, int]], gap: int) -> int:
    """Index of the longest entry not over gap, -1 if none; the pool is sorted by length."""
    lo, hi = 0, len(pool)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if pool[mid][0] <= gap else (lo, mid)
    return lo - 1


def _powers(window: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """An open window as full windows, one for each bit of its length."""
    total, out, pieces = sum(p[2] for p in window), [], list(reversed(window))
    for bit in reversed(range(total.bit_length())):
        if need := total & (1 << bit):
            own = []
            while need:
                doc, start, length = pieces.pop()
                take = min(length, need)
                own.append((doc, start, take))
                if length > take:
                    pieces.append((doc, start + take, length - take))
                need -= take
            out.append((1 << bit, own))
    return out


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", tiers: tuple[int, ...] = TIERS, ids: bool = False) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, tier, step_id) of all documents.

    tokenizer is the path of a tokenizers file at every worker. With ids the pieces also carry their token ids. A null text is empty
    and still has its end id. Rows are packed where they are read, in groups of about GROUP tokens, so nothing is shuffled and a task
    holds one group; sequences are numbered by task and group. What a group leaves in an open window goes on to the next one; only a
    task's last open window is cut into powers of two. A step has STEP tokens of sequences of one size, but for each group's last step
    of a size. Repeated rows are packed each on its own; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, words = TaskContext.get().partitionId() << 36, WordIds(tokenizer)
        # (id, tokens before it, tokens of the whole document, token ids) of each part that waits
        parts: list[tuple] = []
        held, group = 0, 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, group, parts
            windows, rest = fill([len(p[3]) // 4 for p in parts], tiers)
            if last:
                windows, rest = windows + _powers(rest), []
            windows = sorted(enumerate(windows), key=lambda x: (-x[1][0], x[0]))
            rows: dict[str, list] = {k: [] for k in ("id", "start", "length", "crc", "total", "seq", "at", "n", "tier", "step", "ids")}
            step, room, size = -1, 0, 0
            first = base + (group << 22)
            for seq, (_, (tokens, pieces)) in enumerate(windows):
                if tokens != size or room < tokens:
                    step, room, size = step + 1, max(STEP, tokens), tokens
                room -= tokens
                at = 0
                for d, s, n in pieces:
                    doc, before, total, raw = parts[d]
                    own = raw[4 * s : 4 * (s + n)]
                    for k, v in zip(rows, (doc, before + s, n, zlib.crc32(own), total, first + seq, at, tokens, next(t for t in tiers if t >= tokens), first + step, own if ids else None), strict=True):
                        rows[k].append(v)
                    at += n
            parts = [(parts[d][0], parts[d][1] + s, parts[d][2], parts[d][3][4 * s : 4 * (s + n)]) for d, s, n in rest]
            group, held = group + 1, 0
            arrays = [pa.array(rows["id"], id_type), *(pa.array(rows[k], pa.int64()) for k in list(rows)[1:-1])]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "tier", "step_id"]
            if ids:
                arrays, names = [*arrays, pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in rows["ids"]], pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

        id_type: pa.DataType | None = None
        for b in batches:
            id_type = b.schema.field(0).type
            for lo in range(0, b.num_rows, 256):
                rows = b.slice(lo, 256)
                new = words.encode([t or "" for t in rows.column(1).to_pylist()])
                parts += [(d, 0, len(raw) // 4, raw) for d, raw in zip(rows.column(0).to_pylist(), new, strict=True)]
                held += sum(map(len, new)) // 4
                if held >= GROUP:
                    yield from flush(False)
        if parts:
            yield from flush(True)

    more = ", ids array<int>" if ids else ""
    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, tier long, step_id long{more}")


def padding(pieces: DataFrame, longest: int = TIERS[-1]) -> DataFrame:
    """Tokens, padded tokens and sequences, counting a sequence as padded to the longest size unless its length is a power of two."""
    each = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    full = F.when(F.bit_count("n") == 1, F.col("n")).otherwise(F.lit(longest))
    return each.agg(F.sum("n").alias("tokens"), F.sum(full - F.col("n")).alias("padding"), F.count(F.lit(1)).alias("sequences"))
