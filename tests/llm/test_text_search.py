"""Spelling variants, collocations and decontamination against plain versions of themselves, with the edges of each."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from colophon.llm import decontaminate, phrases, queries, spelling

DIR = "/root/testdata/sf0.001"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def documents(spark):
    return [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]


# spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_spelling(docs):
    n = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    # two words one edit apart share what is left when one letter is taken out of each, or of the longer one
    left = defaultdict(set)
    for w in n:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            left[k].add(w)
    near = {w: {x for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for x in left[k] if one_edit(w, x)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def got_spelling(docs, **how):
    return [tuple(r) for r in spelling.variants(docs, **how).collect()]


def test_spelling_of_the_documents(spark):
    got = got_spelling(spark.read.parquet(f"{DIR}/documents.parquet"))
    assert len(got) == len(set(got)) and set(got) == brute_spelling([(d, t) for d, t, _ in documents(spark)])


def test_spelling_edges(spark):
    rng = random.Random(3)
    base = ["encounter", "Éléphants", "façades", "aaaaaaa", "aaaaaaaa", "aaaaaab", "×××××××÷", "recounter", "nœudwords", "straßes"]
    texts = [None, "", "12 34", "short it"] + [" ".join(rng.choice(base) for _ in range(60)) for _ in range(40)] + ["encountre " * 3 + "Encounters encounters encunter encunter"] * 2 + ["encounteŕ " * 3000]
    docs = [(None if i == 5 else i // 2, t) for i, t in enumerate(texts)]
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, word string, n int")
    got = got_spelling(rows)
    assert len(got) == len(set(got)) and set(got) == brute_spelling(docs)
    assert ("encunter", "encounter") in {r[:2] for r in got}
    assert got_spelling(rows.where("false")) == []


def test_spelling_follows_forms(spark):
    counts = [("abcdefg", 2), ("abcdefgh", 30), ("abcdefghi", 400), ("abcdefgx", 30), ("abcdefghij", 5000)]
    text = " ".join(" ".join([w] * n) for w, n in counts)
    # an id for which no word loses a letter
    own = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w, _ in counts))
    got = {r[0]: r[1:3] for r in got_spelling(spark.createDataFrame([(own, text)], "doc_id long, text string"))}
    assert got["abcdefg"] == ("abcdefgh", "abcdefghij") and got["abcdefghi"] == ("abcdefghij", "abcdefghij") and got["abcdefgx"] == (None, "abcdefgx")


def test_crowded_reduced_forms_get_more_symbols(spark):
    """Words of letters that share a symbol are told apart by more symbols, and nothing is lost."""
    alike = [c for c in spelling.LETTERS if spelling.alphabet(spelling.LETTERS, 4)[ord(c)] == 1][:5]
    rng = random.Random(8)
    words = {"".join(rng.choice(alike) for _ in range(8)) for _ in range(3000)}
    names = sorted(words)
    rows = spark.createDataFrame([(i, w, 5) for i, w in enumerate(names)], "id long, word string, n long")
    # 4 symbols would have room for them
    assert 4**spelling.LENGTH > spelling.ROOM * len(words) and spelling.symbols_for(rows, spelling.LETTERS) > 4
    got = [(names[r["id"]], r["other"]) for r in spelling.near_words(rows).collect()]
    assert len(got) == len(set(got))
    got = set(got)
    left = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            left[i, w[:i] + w[i + 1 :]].add(w)
    assert got == {(a, b) for s in left.values() for a in s for b in s if a != b}


# collocations


def brute_collocations(docs, least=10, top=2000, depth=3):
    n, f = Counter(), Counter()
    for t, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(t)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, depth + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = set()
    for p, a in cand.items():
        w = p[1:]
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                q = (p[0], *w[i : i + size])
                if 100 * a >= 50 * cand[q]:
                    gone.add(q)
    rows = defaultdict(list)
    for p, a in cand.items():
        if p not in gone:
            lang, w = p[0], p[1:]
            score, _, l, r = min((1_000_000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
            rows[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return [(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, x in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1)]


def got_collocations(docs, **how):
    return [tuple(r) for r in phrases.collocations(docs, **how).collect()]


def test_collocations_of_the_documents(spark):
    got = got_collocations(spark.read.parquet(f"{DIR}/documents.parquet"))
    assert sorted(got) == sorted(brute_collocations([(t, lang) for _, t, lang in documents(spark)])) and len(got) > 50


@pytest.mark.parametrize(("chunk", "bucket", "top"), [(1_000_000, 1_000_000, 2000), (500, 400, 2000), (300, 40, 15)])
def test_collocations_edges(spark, chunk, bucket, top):
    """Leading words too frequent for a bucket are split by the next ones, and nothing changes."""
    rng = random.Random(5)
    words = ["the"] * 8 + ["of", "of", "a", "né", "x1", "﻿q", '"quote', "back\\", " ", "é"]
    texts = [rng.choice(["", " ", "\t"]).join([""]) + " ".join(rng.choice(words) + rng.choice([""] * 6 + [",", ".", "\n", "?!", "\r\n"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = [(None if rng.random() < 0.05 else t, rng.choice(["en", "en", "fr", None, "und", "a b"])) for t in [*texts, *texts[:20], "", "the of a " * 3000]]
    rows = spark.createDataFrame([(t, lang, 7, "p") for t, lang in docs], "text string, lang string, n int, phrase string").repartition(3)
    got = got_collocations(rows, chunk=chunk, bucket=bucket, top=top)
    assert sorted(got) == sorted(brute_collocations(docs, top=top)) and any(r[0] == "und" for r in got)


def test_collocations_of_nothing(spark):
    assert got_collocations(spark.createDataFrame([], "text string, lang string")) == []
    assert got_collocations(spark.createDataFrame([(None, "en"), ("", None), (" .\n", "en")], "text string, lang string")) == []


def test_scores_beyond_64_bits(spark):
    """2,000,000 x 2,000,000 x 1,000,000 is over 2**63, and a floor stays one."""
    text = "aa bb " * 20_000
    rows = spark.createDataFrame([(text, "en")], "text string, lang string").withColumn("text", F.concat(*["text"] * 50))
    got = {r[2]: r[3:] for r in got_collocations(rows, depth=2, chunk=200_000)}
    a, b = 1_000_000, 999_999
    assert got["aa bb"] == (a, a, a, 2_000_000, 1_000_000) and got["bb aa"] == (b, a, a, 2_000_000, 1_000_000 * b * b // (a * a))


@pytest.mark.parametrize("fixed", [1, 2, 3])
def test_equal_partitions(fixed):
    rng = np.random.default_rng(2)
    keys = [rng.integers(0, m, 3000) for m in (2, 6, 9, 5)]
    keys[1] += 1
    for k in (2, 3):
        keys[k][keys[k - 1] == 0] = 0
    weight = rng.integers(1, 4, 3000)
    want = Counter()
    for *key, n in zip(*(k.tolist() for k in keys), weight.tolist(), strict=True):
        for d in (1, 2, 3):
            if key[d]:
                want[tuple(key[: d + 1])] += n
    got = {tuple(int(k[row]) for k in keys[: d + 1]): n for row, d, n in phrases.equal_partitions(keys, weight, fixed, 40, [np.arange(3000)])}
    assert got == {p: n for p, n in want.items() if n >= 40 or len(p) - 1 < fixed}


# decontamination


def item_words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t))


def brute_contaminated(docs, items, size=10):
    windows = defaultdict(set)
    for item, t in items:
        w = item_words(t)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            windows[tuple(w[i : i + size])].add("" if item is None else str(item))
    sizes = sorted(set(map(len, windows)))
    out = []
    for d, t in docs:
        w, hit, found = item_words(t), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if own := windows.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= own
        out.append((d, len(w), len(hit), tuple(sorted(found, key=str.encode))))
    return out


def got_contaminated(docs, items, **how):
    return [(r[0], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontaminate.contaminated(docs, items, **how).collect()]


def sortable(rows):
    return sorted(rows, key=lambda r: (r[0] is None, str(r)))


def test_contaminated_documents(spark):
    docs = [(d, t) for d, t, _ in documents(spark)]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute_contaminated(docs, items)}
    got = {r["doc_id"]: tuple(r)[1:6] for r in queries.op13_decontamination(spark, DIR).collect()}
    assert got == want and any(v[4] for v in got.values())


@pytest.mark.parametrize("segment", [decontaminate.SEGMENT, 400])
def test_contamination_edges(spark, monkeypatch, segment):
    rng = random.Random(6)
    words = ["the", "of", "The", "né", "x1", "42", " q", "a"]
    some = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choice(words) for _ in range(n))
    items = [(None, some(12)), (7, some(30)), (7, some(30)), (8, "the"), (9, ""), (10, None), (11, "né né 42"), (12, "unknown " + some(9)), (13, some(10))]
    items += [(14, items[1][1]), (15, "of of of of of of of of of of of")]
    docs = [(i % 40, some(rng.randrange(90))) for i in range(60)] + [(None, None), (None, items[1][1]), (3, ""), (3, "!!"), (70, "of " * 4000), (71, items[1][1] + " x1 " + items[0][1]), (71, items[1][1] + " x1 " + items[0][1])]
    rows = spark.createDataFrame([(d, t, "s", 1) for d, t in docs], "doc_id long, text string, item_id string, places int")
    tests = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    want = sortable(brute_contaminated(docs, items))
    assert sortable(got_contaminated(rows, tests, segment=segment)) == want
    # with more test terms than travel, all terms are indexed
    monkeypatch.setattr(decontaminate, "TERMS", 2)
    assert sortable(got_contaminated(rows, tests, segment=segment)) == want
    assert got_contaminated(rows.where("false"), tests) == []
    assert {r[2:] for r in got_contaminated(rows, tests.where("false"))} == {(0, ())}


def test_proximity_matches(spark):
    """A word put in or taken away in the middle leaves a proximity match, words in another order don't."""
    w = [f"w{i}" for i in range(10)]
    docs = [(1, w), (2, [*w[:5], "new", *w[5:]]), (3, [*w[:5], "new", "new", *w[5:]]), (4, [*w[:5], *["new"] * 3, *w[5:]]), (5, w[::-1]), (6, w[1:]), (7, [w[1], w[0], *w[2:]])]
    rows = spark.createDataFrame([(d, " ".join(t)) for d, t in docs], "doc_id long, text string")
    items = spark.createDataFrame([("a", " ".join(w))], "item_id string, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["near_items"]) for r in decontaminate.contaminated(rows, items).collect()}
    assert got[1] == (10, ["a"], []) and all(got[i] == (0, [], ["a"]) for i in (2, 3, 7)) and all(got[i] == (0, [], []) for i in (4, 5, 6))
    with pytest.raises(ValueError):
        decontaminate.contaminated(rows, items, slack=40)


def test_intersection():
    a, b = np.array([3, 9, 20, 40]), np.array([1, 9, 22, 38])
    assert [x.tolist() for x in decontaminate.intersect([a, b])] == [[9], [0]]
    assert [x.tolist() for x in decontaminate.intersect([a, b], 2)] == [[3, 9, 20, 40], [2, 0, 2, 2]]
    assert len(decontaminate.intersect([a, b[:0]])[0]) == 0
