"""Operators against plain versions of themselves, and the pipeline against a plain version of all its stages."""

import base64
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from colophon.llm import langid, linededup, mixing, nearest, neardup, packing, quality, queries, simhash, suffixtree, toxicity, warc

DIR = "/root/testdata/sf0.001"
BLANK = re.compile("[\x20\x09-\x0d]+")
VOCABULARY = "alpha beta gamma delta the of and to zeta né omega x1 pi".split()


def words(t):
    return [w for w in BLANK.split(t or "") if w]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def some_texts(n, seed=1, least=0, most=60):
    rng = random.Random(seed)
    return [None if rng.random() < 0.03 else " ".join(rng.choice(VOCABULARY) for _ in range(rng.randrange(least, most))) for _ in range(n)]


# quality


def brute_ratio(docs, trusted):
    """{id: (llr, kept)} of {id: text}."""
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    number = lambda h: signed(h) % quality.BUCKETS
    single = lambda w: xxhash.xxh64_intdigest(w.encode(), 42)
    long_ = lambda x, seed: xxhash.xxh64_intdigest(struct.pack("<q", x), seed)

    def grams(t):
        h = [signed(single(x)) for x in words(t)]
        return [x % quality.BUCKETS for x in h] + [number(long_(b, long_(a, 42))) for a, b in zip(h, h[1:], strict=False)]

    held = {d for d in trusted if signed(xxhash.xxh64_intdigest(struct.pack("<i", 1), long_(d, 42))) % quality.HOLD == 0}
    raw, target = Counter(), Counter()
    for d, t in docs.items():
        raw.update(grams(t))
        if d in trusted - held:
            target.update(grams(t))
    n, m, size = sum(target.values()), sum(raw.values()), quality.BUCKETS
    weight = lambda g: round((math.log((target[g] + 1) / (n + size)) - math.log((raw[g] + 1) / (m + size))) * 1_000_000) if n else 0
    llr = {d: sum(map(weight, grams(t))) / len(grams(t)) / 1_000_000 if words(t) else 0.0 for d, t in docs.items()}
    failed = {d: base_failed(t) for d, t in docs.items()}
    own = sorted(llr[d] for d in held if d in docs and not failed[d])
    at = lambda q: np.percentile(own, 100 * q)
    least = at(quality.LOW) - (at(0.5) - at(quality.LOW)) / 2 if own else -math.inf
    return {d: (llr[d], not failed[d] and llr[d] >= least - 1e-12) for d in docs}


def base_failed(t):
    w = words(t)
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    again = {k for k, n in Counter(win).items() if n > 1}
    return len(w) < 10 or 100 * len({i + k for i, x in enumerate(win) if x in again for k in range(5)}) > 20 * len(w)


def test_quality(spark):
    rng = random.Random(4)
    docs = {i: " ".join(rng.choice(VOCABULARY[: 13 - 9 * (i % 3 == 0)]) + str(rng.randrange(9)) for _ in range(rng.randrange(40))) for i in range(120)}
    trusted = {i for i in docs if i % 3 and i % 2}
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["llr"], r["kept"]) for r in quality.score_quality(rows, spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()}
    want = brute_ratio(docs, trusted)
    assert {d: k for d, (_, k) in got.items()} == {d: k for d, (_, k) in want.items()}
    assert all(abs(got[d][0] - want[d][0]) < 1e-5 for d in docs)


def test_quality_learns_from_all(spark):
    """Every trusted document counts, however many ids are trusted; rows without an id, and ids that are repeated or have no document."""
    rng = random.Random(6)
    docs = {i: " ".join(rng.choice(VOCABULARY[: 13 - 9 * (i % 3 == 0)]) + str(rng.randrange(9)) for _ in range(rng.randrange(40))) for i in range(120)}
    trusted = {i for i in docs if i % 3 and i % 2}
    rows = spark.createDataFrame([*docs.items(), (None, None)], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in [*trusted, *trusted, None]], "doc_id long").union(spark.range(1000, 301_000).toDF("doc_id"))
    got = {r["doc_id"]: (r["llr"], r["kept"]) for r in quality.score_quality(rows, ids).collect()}
    want = brute_ratio(docs, trusted)
    assert got.pop(None) == (0.0, False)
    assert {d: k for d, (_, k) in got.items()} == {d: k for d, (_, k) in want.items()}
    assert all(abs(got[d][0] - want[d][0]) < 1e-5 for d in docs)


def test_quantiles(spark):
    """As F.percentile, with ties, negative values and values on the edges of bins."""
    rng = random.Random(7)
    shares = [0.0, 0.005, 0.3, 0.5, 1.0]
    for x in ([0.25], [-1.0, 2.0], [-0.0, 0.0, 0.001], [rng.gauss(0, 2) for _ in range(999)] + [0.5] * 300, [k / 1000 for k in range(-50, 50)] * 3):
        df = spark.createDataFrame([(v,) for v in x], "v double")
        assert quality.quantiles(df, shares) == df.agg(F.percentile("v", shares)).first()[0]
    assert quality.quantiles(spark.createDataFrame([], "v double"), shares) == []


def test_quality_held_out(spark):
    """Labelled documents that nothing was learned from: good ones stay, bad ones go."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    other = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = quality.score_quality(docs, labels.where("quality = 1").where(other)).where(~other).where("not base_failed").join(labels, "doc_id")
    rate = {r["quality"]: r["k"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.99 and rate[0] < 0.1


# near-duplicates


def test_near_dedup_of_a_crowded_block(spark, monkeypatch):
    """20,000 different texts with a passage in common are in one block: every planted pair is found, and few others are made."""
    rng = random.Random(5)
    passage = [rng.choice(VOCABULARY) + str(rng.randrange(900)) for _ in range(100)]
    own = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts = [" ".join(passage + own(rng.randrange(10, 40))) for _ in range(20_000)]
    pairs = set()
    for i in range(40):
        # a text of which one loses its last words: still alike, or just not
        t = words(texts[i])
        texts.append(" ".join(t[: len(t) - rng.randrange(1, 45)]))
        pairs.add((i, len(texts) - 1))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    sig = neardup.cut(neardup.signatures(docs).withColumn("bands", F.array(F.lit(1).cast("long"))))
    made, apart = [], neardup._apart
    monkeypatch.setattr(neardup, "_apart", lambda *a: made.append(neardup.cut(apart(*a))) or made[0])
    got = neardup.near_sets(docs, sig)
    root = {r["id"]: r["root"] for r in sig.join(got, F.col("set") == F.col("node")).collect()}
    sets = {i: set(neardup.shingles(texts[i].encode()).tolist()) for pair in pairs for i in pair}
    alike = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert 5 < len(alike) < 40
    # cut texts are like each other too, as the passage is most of them
    assert all(root.get(a) is not None and root.get(a) == root.get(b) for a, b in alike)
    assert made[0].count() < 2_000_000


def test_near_sets_against_all_pairs(spark):
    """Random subsets of few shingles, all in one block: the components are those of every pair that is similar enough."""
    for similarity, seed in ((0.8, 1), (0.8, 2), (0.5, 3)):
        rng = random.Random(seed)
        base = [[f"v{rng.randrange(400)}" for _ in range(rng.randrange(5, 70))] for _ in range(25)]
        texts = [" ".join(w for w in rng.choice(base) if rng.random() > 0.02) + f" x{rng.randrange(3)}" * rng.randrange(4) for _ in range(260)]
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
        sig = neardup.cut(neardup.signatures(docs).withColumn("bands", F.when(F.size("bands") > 0, F.array(F.lit(1).cast("long"))).otherwise(F.col("bands"))))
        root = {r["id"]: r["root"] for r in sig.join(neardup.near_sets(docs, sig, similarity=similarity), F.col("set") == F.col("node")).collect()}
        own = {r["id"]: r["set"] for r in sig.collect()}
        sets = [set(neardup.shingles(t.encode()).tolist()) for t in texts]
        want = {i: i for i in range(len(texts))}

        def find(i, want=want):
            while want[i] != i:
                i = want[i]
            return i

        for a in range(len(texts)):
            for b in range(a):
                if sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                    want[find(a)] = find(b)
        groups = lambda of: sorted(sorted(g) for g in {k: [i for i in range(len(texts)) if of(i) == k] for k in map(of, range(len(texts)))}.values())
        # fingerprints may link more than the block does, but only what is similar
        assert groups(lambda i: root.get(i, own[i])) == groups(find)


# mixing


def brute_draw(rows, max_repeat=2.0, budget=None, block_tokens=1000, seed=mixing.SEED):
    """Rows (id, source, epoch, block) of rows (id, source, tokens) with different ids."""
    digits = lambda *x: int(hashlib.md5(":".join(map(str, x)).encode()).hexdigest()[:15], 16)
    tokens = Counter()
    for _, s, n in rows:
        tokens[s] += n
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}
    ok = lambda a: max(p ** (a - 1) for p in share.values()) <= max_repeat * min(p ** (a - 1) for p in share.values())
    lo, hi = 0.0, 1.0
    if ok(0.0):
        hi = 0.0
    else:
        for _ in range(25):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if ok(mid) else (mid, hi)
    z = sum(p ** round(hi, 6) for p in share.values())
    weight = {s: p ** round(hi, 6) / z for s, p in share.items()}
    full = max(tokens[s] / weight[s] for s in tokens)
    quota = {s: max(round(weight[s] * full), tokens[s]) for s in tokens}
    blocks = max(1, -(-sum(quota.values()) // block_tokens))
    out = []
    for s, q in quota.items():
        at, epoch = 0, 0
        while at < q:
            for d, _, n in sorted((r for r in rows if r[1] == s), key=lambda r: (digits(seed, epoch, r[0], r[2], 1), r[0])):
                if at < q:
                    out.append((d, s, epoch, min(int(at / q * blocks), blocks - 1)))
                at += n
            epoch += 1
    return out


def test_mixing(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("aaaaaaaabbbccd"), rng.randrange(1, 30)) for i in range(600)]
    docs = spark.createDataFrame([(d, s, " ".join("w" * n)) for d, s, n in rows], "doc_id long, source string, text string")
    for slices in (4096, 50):
        got = [tuple(r) for r in mixing.draw(docs, block_tokens=1000, slice_rows=slices).select("doc_id", "source", "epoch", "block").collect()]
        assert sorted(got) == sorted(brute_draw(rows))


def test_mixing_of_rows_without_ids(spark):
    """A source of rows with null or equal ids is dealt over its slices, and its order doesn't depend on where its rows lie."""
    rows = [(None, "a", "w " * (1 + i % 3)) for i in range(9_000)] + [(7, "a", "w")] * 3_000 + [(i, "b", "w w") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = [mixing.draw(x, block_tokens=1000, slice_rows=100).cache() for x in (docs.repartition(1), docs.repartition(7))]
    columns = ["doc_id", "source", "n_tokens", "epoch", "block", "place"]
    a, b = (Counter(tuple(r) for r in x.select(columns).collect()) for x in got)
    assert a == b
    assert Counter(k[0] for k, n in a.items() for _ in range(n) if k[3] == 0 and k[1] == "a") == {None: 9_000, 7: 3_000}
    numbered = mixing._numbered(docs.select("source", F.size(F.split(F.trim("text"), " ")).alias("n")))
    assert numbered.groupBy("source", "n").agg(F.count("*").alias("k"), F.count_distinct("copy").alias("d"), F.max("copy").alias("m")).where("k <> d or k <> m").count() == 0
    # every block has its share of them: no slice is one null id's whole run
    blocks = Counter(k[4] for k in a.elements() if k[0] is None)
    total = Counter(k[4] for k in a.elements())
    assert all(0.2 * total[k] < blocks[k] for k in list(total)[:-1])


def test_mixing_budget(spark):
    """Quotas add up to the budget, whatever its size."""
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 10).alias("source"), F.lit("a b c").alias("text"))
    shares = mixing.source_shares(docs.withColumn("n_tokens", F.lit(3)))
    for budget in (0, 1, 7, 10, 1001):
        quota = [r["quota"] for r in mixing.source_weights(shares, 0.5, budget).collect()]
        assert sum(quota) == budget and max(quota) - min(quota) <= 1
    assert mixing.draw(docs, budget=1).count() == 1


# WARC


def test_warc(spark):
    rng = random.Random(2)
    bodies = [None, "", "same", "other", "é" * 3000, "x" * 70_000]
    rows = [(rng.choice((i, i, -i, None)), rng.choice((None, f"http://h/{i}", "a\r\nb")), rng.choice(bodies)) for i in range(1, 200)] + [(500, "u", "same"), (500, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    largest = {}
    for p, _, h in rows:
        if p is not None:
            largest[h or ""] = max(p, largest.get(h or "", p))
    want = Counter()
    for p, _, h in rows:
        raw = (h or "").encode()
        to = largest.get(h or "")
        refers = to if to is not None and (p is None or p < to) else None
        want[p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if refers is None else "revisit", refers, None if refers is not None else raw] += 1
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    got = Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in warc.round_trip(pages).select(columns).collect())
    assert got == want


# language


def test_language(spark):
    rng = random.Random(3)
    rows = [(i, g, "".join(rng.choice(s) for _ in range(rng.randrange(0, 90)))) for i in range(150) for g, s in [rng.choice((("a", "abcdé "), ("b", "abcxyz "), ("c", "Abcd xyz1")))]]
    docs = spark.createDataFrame([*rows, (900, "a", None), (901, None, "abc"), (902, "a", "12")], "doc_id long, lang string, text string")
    counts, prior = defaultdict(Counter), Counter()
    grams = lambda t: [(b,) for _, bs in langid.ngrams([t], langid.BITS, 1 << 20) for b in bs.tolist()]
    for _, g, t in rows:
        if any(map(str.isalpha, t)):
            prior[g] += 1
            counts[g].update(grams(t))
    size = 1 << langid.BITS
    got = {r["doc_id"]: r for r in langid.identify(docs, langid.train(docs)).collect()}
    for d, _, t in rows:
        if not any(map(str.isalpha, t)):
            assert (got[d]["lang_pred"], got[d]["score"]) == ("und", 0.0)
            continue
        s = {g: math.log(prior[g] / sum(prior.values())) + sum(math.log((counts[g][x] + 0.1) / (sum(counts[g].values()) + 0.1 * size)) for x in grams(t)) for g in counts}
        best = max(sorted(s), key=s.get)
        assert got[d]["lang_pred"] == best and got[d]["score"] == pytest.approx(1 / sum(math.exp(x - s[best]) for x in s.values()))
    assert {got[d]["lang_pred"] for d in (900, 902)} == {"und"}


def test_language_many(spark, monkeypatch):
    """More languages than the model's bytes allow at full width share buckets."""
    monkeypatch.setattr(langid, "MODEL_BYTES", 40 * 8 << 10)
    docs = spark.createDataFrame([(i, f"l{i % 40:02}", chr(0x4E00 + i % 40) * 9) for i in range(80)], "doc_id long, lang string, text string")
    langs, w, _ = langid.train(docs)
    assert len(langs) == 40 and w.shape == (1 << 10, 40)
    assert langid.identify(docs, langid.train(docs)).join(docs, "doc_id").where("lang_pred <> lang").count() <= 8


# suffix tree


def brute_tree(docs, depth):
    """{id: (base, score)} of {id: (text, held out)}, the contexts in the tree, and p(context, word)."""
    end = None
    seqs = {d: [*words(lower(t)), end] for d, (t, _) in docs.items()}
    count = Counter()
    for d, (_, held) in docs.items():
        if not held:
            for k in range(1, depth + 2):
                count.update(tuple(seqs[d][i : i + k]) for i in range(len(seqs[d]) - k + 1))
    total = sum(n for g, n in count.items() if len(g) == 1)
    distinct = sum(len(g) == 1 for g in count)
    root = lambda w: (count[w,] + 0.1) / (total + 0.1 * (distinct + 1))
    below = defaultdict(dict)
    for g, n in count.items():
        if len(g) > 1 and n >= suffixtree.LEAST and count[g[:-1]] >= suffixtree.LEAST:
            below[g[:-1]][g[-1]] = n
    nodes = {}

    def p(context, w):
        if not context:
            return root(w)
        if context not in nodes:
            return p(context[1:], w)
        seen, n = below[context], count[context]
        left = n - sum(seen.values()) + suffixtree.DISCOUNT * len(seen)
        return (max(seen.get(w, 0) - suffixtree.DISCOUNT, 0) + (left + suffixtree.PRIOR) * p(context[1:], w)) / (n + suffixtree.PRIOR)

    for context in sorted(below, key=len):
        saved = sum(round(n * math.log2(n / count[context] / p(context[1:], w)) * suffixtree.UNIT) for w, n in below[context].items())
        if saved >= suffixtree.GAIN * suffixtree.UNIT:
            nodes[context] = saved
    score = lambda s: sum(math.log10(p(tuple(s[max(0, i - depth) : i]), w)) for i, w in enumerate(s))
    return {d: (sum(math.log10(root(w)) for w in s), score(s)) for d, s in seqs.items()}, nodes, p


@pytest.mark.parametrize(("depth", "chunk"), [(0, 10_000), (1, 300), (2, 10_000), (2, 300), (3, 500)])
def test_suffix_tree(spark, depth, chunk):
    texts = some_texts(90, 5) + ["Alpha beta zeta gamma rare words " + str(i // 2) + " here" for i in range(10)]
    docs = {i: (t, i % 7 == 0) for i, t in enumerate(texts)}
    rows = spark.createDataFrame([(i, t, h) for i, (t, h) in docs.items()], "doc_id long, text string, h boolean")
    want, nodes, _ = brute_tree(docs, depth)
    assert depth == 0 or {len(c) for c in nodes} == set(range(1, depth + 1))
    got = {r["doc_id"]: r for r in suffixtree.score_documents(rows, F.col("h"), depth=depth, chunk_tokens=chunk).collect()}
    assert set(got) == set(docs)
    for d, (base, score) in want.items():
        assert got[d]["base_score"] == pytest.approx(base) and got[d]["score"] == pytest.approx(score)


def test_tree_is_a_distribution():
    """The probabilities after any context, of all words, the end and one unknown word, add up to 1."""
    _, nodes, p = brute_tree({i: (t, False) for i, t in enumerate(some_texts(60, 6))}, 2)
    for context in [(), *nodes, ("unknown",)]:
        assert sum(p(context, w) for w in [*VOCABULARY, None, "unknown"]) == pytest.approx(1)


# packing


def test_every_letter():
    """The ids of every letter, alone and before a full stop or a comma, are the tokenizer's."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    texts = [x + m for c in letters for x in (c, f"a{c}") for m in ("", ".", ",")]
    ids = packing.WordIds(path)
    assert ids.by_words
    want = Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)
    wrong = [t for t, e in zip(texts, want, strict=True) if np.frombuffer(ids[t], "<u4").tolist() != e.ids]
    assert wrong == []


def test_whole_table():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    want = Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)
    assert all(np.frombuffer(raw, "<u4").tolist() == [*e.ids, 2] for raw, e in zip(packing.WordIds(path).encode(texts), want, strict=True))


def test_other_tokenizer():
    """A tokenizer that doesn't drop white space encodes whole texts."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = packing.WordIds(path)
    texts = ["a  b\tc d.", "", " x"]
    assert not ids.by_words
    assert [np.frombuffer(x, "<u4").tolist()[:-1] for x in ids.encode(texts)] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_groups_go_on(spark, monkeypatch):
    """An open window goes on to the next group of a task; only the task's last one is cut."""
    monkeypatch.setattr(packing, "GROUP", 3000)
    docs = spark.createDataFrame([(i, "word " * (i % 97) * 3) for i in range(400)], "doc_id long, text string").coalesce(1)
    got = packing.pack_documents(docs, queries.tokenizer_path(), ids=True).collect()
    sizes = {r["sequence_id"]: r["sequence_tokens"] for r in got}
    assert sum(n < 512 for n in sizes.values()) <= 9
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for d, own in by.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            at += r["length"]
        assert at == own[0]["doc_tokens"] == d % 97 * 3 + 1
    assert len(by) == 400


# nearest


def test_nearest_many_components(spark):
    """Vectors longer than one exact float32 product."""
    rng = np.random.default_rng(9)
    x = np.sign(rng.normal(size=(60, 3000))) + rng.normal(size=(60, 3000)) * 0.01
    x[1::2] = x[::2] + rng.normal(size=(30, 3000)) * 1e-4
    got = defaultdict(list)
    for r in nearest.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    y = x / np.linalg.norm(x, axis=1)[:, None]
    for q in range(0, 60, 10):
        best = sorted((-float(y[q] @ y[i]), i) for i in range(60) if i != q)[:5]
        assert [(n, i) for n, i, _ in sorted(got[q])] == [(n + 1, i) for n, (_, i) in enumerate(best)]
        assert [s for _, _, s in sorted(got[q])] == pytest.approx([-s for s, _ in best], abs=1e-12)


def test_nearest_edges(spark):
    """Query rows that repeat an id ask each with its own vector; clashing columns and an empty table do no harm."""
    rows = [(0, [1.0, 0.0], 1), (0, [0.0, 1.0], 2), (0, [0.0, 1.0], 3), (1, [1.0, 0.1], 4), (2, [0.1, 1.0], 5), (3, [1.0, 1.0], 6), (None, [1.0, 0.0], 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row int").withColumns({"id": F.lit("x"), "v": F.lit(1), "q": F.lit(True), "dim": F.lit(0)})
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in nearest.nearest(df, F.col("vec_id") % 50 == 0).collect())
    want = [(0, n, i) for order in ([1, 3, 2], [2, 3, 1], [2, 3, 1]) for n, i in enumerate(order, 1)]
    assert got == sorted(want)
    assert nearest.nearest(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_products():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-127, 128, (7, 5000)).astype(np.int8) for _ in range(2))
    assert (nearest._products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


# SimHash and lines


def test_null_ids(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (9, "A b c d"), (None, "other words are here"), (5, None), (5, "a b c d")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter([(None, 5), (7, 5), (9, 5), (5, 5), (None, None), (5, 5)])


def test_clashing_columns(spark):
    rows = [(1, "one line here is long\nown", "s", 1, 2, 3), (2, "one line here is long\nmine", "s", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _doc long, _H long, _epochs long")
    got = {r["doc_id"]: r for r in linededup.dedup_lines(docs).collect()}
    assert (got[1]["text"], got[2]["text"], got[2]["_doc"], got[2]["_H"]) == (rows[0][1], "mine", 1, 2)
    import corpus_pipeline as p

    odd = docs.withColumnsRenamed({"_doc": "_row", "_H": "_id", "_epochs": "_turns"})
    for name, stage in p.STAGES[1:4]:
        out = stage(spark, odd, DIR)
        assert out.columns == odd.columns and {r["_row"] for r in out.collect()} == {1}, name


# toxicity


def test_toxicity_features():
    import zstandard

    ordinary, toxic = b" the words of common text and more of it ", b" foul nasty stuff "
    own, other = toxicity.Model(ordinary, toxic, np.zeros(14)).compressors()

    def size(content, w):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        p = zstandard.ZstdCompressionParameters.from_level(toxicity.LEVEL, source_size=64, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(zstandard.ZstdCompressor(compression_params=p, dict_data=d).compress(w))

    for text in (None, "", "Foul NASTY stuff is in this text, and more", "the words of common text " * 9, "nasty stuff " * 4):
        w = words(lower(text))
        win = [" " + " ".join(w[i : i + 6]) + " " for i in range(0, len(w), 6)]
        saved = [size(ordinary, x.encode()) - size(toxic + ordinary, x.encode()) for x in win] or [0]
        n = [sum(s >= k for s in saved) for k in toxicity.SAVINGS]
        want = [1, math.log1p(len(saved)) / 4, *map(math.log1p, n), *(math.sqrt(x / len(saved)) for x in n)]
        assert toxicity.features(None if text is None else text.encode(), own, other).tolist() == pytest.approx(want)
    assert toxicity.savings([b" nasty stuff of common text "], own, other)[0] > 3


# pipeline


def test_pipeline(spark):
    """Which documents are packed, how often, and of how many tokens: every stage done plainly."""
    import corpus_pipeline as p
    from tokenizers import Tokenizer

    d = pq.read_table(f"{DIR}/documents.parquet").to_pydict()
    text, source = dict(zip(d["doc_id"], d["text"], strict=True)), dict(zip(d["doc_id"], d["source"], strict=True))
    assert len(text) == len(d["doc_id"])
    labels = pq.read_table(f"{DIR}/labels.parquet").to_pydict()
    verdict = brute_ratio(text, {i for i, q in zip(labels["doc_id"], labels["quality"], strict=True) if q == 1})
    kept = {i: text[i] for i in sorted(text) if verdict[i][1]}
    # line dedup
    seen, out = defaultdict(list), {}
    for i, t in kept.items():
        lines, own, stay = (t or "").split("\n"), [], []
        for x in lines:
            w = [re.sub(".*[0-9].*", "<*>", y) for y in words(x)]
            short = len(w) < 5
            leaf = tuple(words(x)) if short else (len(w), *w[:3])
            k = 1 if short else min(8, len(w))
            fields = [leaf] if short else [w[j * len(w) // k : (j + 1) * len(w) // k] for j in range(k)]
            own.append((leaf, fields))
            if not w or not any(4 * sum(map(lambda a, b: a == b, fields, f)) >= 3 * k for f in seen[leaf]):
                stay.append(x)
        for leaf, fields in own:
            seen[leaf].append(fields)
        if len(stay) == len(lines) or words("\n".join(stay)):
            out[i] = "\n".join(stay)
    # near-dedup
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(lower(t))) else set() for i, t in out.items()}
    root = {i: i for i in out}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(out)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    alone = {i: out[i] for i in ids if find(i) == i}
    # mixing and packing
    drawn = Counter((r[0]) for r in brute_draw([(i, source[i], len(words(t))) for i, t in alone.items() if words(t)], block_tokens=mixing.BLOCK_TOKENS))
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter({(i, len(tokenizer.encode(alone[i], add_special_tokens=False).ids) + 1): n for i, n in drawn.items()})
    got = p.run(spark, DIR).collect()
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in got if r["start"] == 0) == want
    assert sum(r["length"] for r in got) == sum(n * k for (_, n), k in want.items())


@pytest.mark.parametrize("name", ["op2_warc", "op9_nearest", "op11_spelling", "op12_collocations", "op13_decontamination"])
def test_twin(spark, name):
    """The same rows as the DuckDB twin's, on whole tables."""
    import duckdb
    from colophon.llm import oracles

    con, d = duckdb.connect(), "/root/testdata/sf0.01"
    for t in ("pages", "embeddings", "documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    cur = con.execute(oracles.ORACLES[name])
    names = sorted(c[0] for c in cur.description)
    want = Counter(tuple(dict(zip((c[0] for c in cur.description), r, strict=True))[n] for n in names) for r in cur.fetchall())
    df = queries.QUERIES[name](spark, d)
    got = Counter(tuple(r[n] for n in names) for r in df.collect())
    assert sorted(df.columns) == names and got == want, (list((got - want))[:3], list((want - got))[:3])
