"""Quality rules: word and repetition counts of each text, then a hashed n-gram log-likelihood ratio of trusted against raw text."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, words

#: Hash buckets of the two multinomials.
BUCKETS = 1 << 16
#: Smoothing, in occurrences for each bucket.
ALPHA = 1.0
#: Share of the trusted texts that the threshold is first laid under; it is then lowered by half their distance from the median.
LOW = 0.005
#: One in so many trusted documents sets the threshold, the others are learned from.
HOLD = 4
#: Of quantiles: bins that values are counted in, for each unit.
BINS = 1000
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20


def _covered(win: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; win: the windows' hashes in order.

    The sorted windows are bound to a variable, so that no rewriting of the plan can make each step sort them anew.
    """
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda acc, p: F.struct((p + WINDOW).cast("int").alias("end"), (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).cast("int").alias("n"))

    def covered(at: Column) -> Column:
        again = F.filter(at, lambda s, k: ((k > 0) & (F.get(at, k - 1)["h"] == s["h"])) | F.coalesce(F.get(at, k + 1)["h"] == s["h"], F.lit(False)))
        return F.aggregate(F.array_sort(F.transform(again, lambda s: s["i"])), start, step, lambda acc: acc["n"])

    at = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.get(F.transform(F.array(at), covered), 0)


def base_rules(docs: DataFrame, id_col: str = "doc_id", text: str = "text", weights: Column | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed), all counted over the whole text; null counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(id_col, *carry, t.alias("_t"), (F.lit(None).cast("array<bigint>") if weights is None else weights).alias("_weights")).withColumn("_w", words(F.col("_t")))
    d = d.withColumn("_h", hashes(F.col("_w")))
    last = F.greatest(F.size("_h") - (WINDOW - 1), F.lit(0))
    d = d.withColumn("_win", F.transform(F.arrays_zip(*(F.slice("_h", k + 1, last).alias(f"h{k}") for k in range(WINDOW))), lambda s: F.xxhash64(s)))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    n = F.size("_w").cast("long")
    weight = lambda h, i: F.get("_weights", bucket(h)) + F.when(i > 0, F.get("_weights", pair_bucket(F.get("_h", i - 1), h))).otherwise(0)
    out = d.select(
        id_col, *carry, n.alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_win")) < F.size("_win"), _covered(F.col("_win"))).otherwise(0).cast("long").alias("n_repeat_words"),
        *([] if weights is None else [F.aggregate(F.transform("_h", weight), F.lit(0).cast("long"), lambda s, x: s + x).alias("_sum")]),
    )
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def bucket(h: Column, buckets: int = BUCKETS) -> Column:
    """Of a word, by its hash."""
    return F.pmod(h, F.lit(buckets)).cast("int")


def pair_bucket(first: Column, second: Column, buckets: int = BUCKETS) -> Column:
    """Of two neighbouring words, by their hashes."""
    return F.pmod(F.xxhash64(first, second), F.lit(buckets)).cast("int")


def split(trusted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, _hold) of every trusted id, once: those that set the threshold, and those that are counted."""
    return trusted.where(F.col(id_col).isNotNull()).select(id_col).distinct().withColumn("_hold", F.pmod(F.xxhash64(id_col, F.lit(1)), F.lit(HOLD)) == 0)


def ratio_weights(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row (weights): log p_target - log p_raw of each bucket; all 0 when nothing is trusted.

    The n-grams are words and pairs of neighbouring words. The raw multinomial counts every document; the target one those of all ids that
    aren't held for the threshold. Their texts are joined apart, so that rows with null ids aren't dealt out by id, and by a shuffle, for
    the ids grow with the input. The counts are summed before they are shuffled: a row for each bucket and task.
    """
    learned = docs.select(id_col, text).join(ids.where("not _hold").select(id_col).hint("merge"), id_col, "left_semi")
    d = docs.select(text, F.lit(0).alias("target")).union(learned.select(text, F.lit(1)))
    d = d.select(hashes(words(F.col(text))).alias("_h"), "target")
    d = d.select(F.inline(F.arrays_zip(F.col("_h").alias("a"), F.slice("_h", 2, F.greatest(F.size("_h") - 1, F.lit(0))).alias("b"))), "target")
    both = F.stack(F.lit(2), bucket(F.col("a"), buckets), F.when(F.col("b").isNotNull(), pair_bucket(F.col("a"), F.col("b"), buckets)))
    d = d.select(both.alias("bucket"), "target").where("bucket is not null")
    counts = d.groupBy("bucket").agg(F.sum(1 - F.col("target")).alias("raw"), F.sum("target").alias("target"))
    # one row for each of a fixed number of buckets
    total = F.sum("target").over(Window.partitionBy()), F.sum("raw").over(Window.partitionBy())
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0, ["raw", "target"])
    p, q = ((F.col(c) + ALPHA) / (t + ALPHA * buckets) for c, t in zip(("target", "raw"), total, strict=True))
    w = every.select("bucket", F.when(total[0] > 0, F.log(p) - F.log(q)).otherwise(0.0).alias("w"))
    return w.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "w"))), lambda s: F.round(s["w"] * 1_000_000).cast("long")).alias("weights"))


def quantiles(values: DataFrame, shares: list[float]) -> list[float]:
    """Exact quantiles of values, a DataFrame of one column, interpolated between neighbours; empty if there is none.

    Equal values are counted, and the counts of bins summed in order; then each bin has its values' places by itself.
    """
    n = cut(values.toDF("x").groupBy("x").agg(F.count(F.lit(1)).alias("n")).withColumn("bin", F.floor(F.col("x") * BINS)))
    total = n.agg(F.sum("n")).first()[0]
    if not total:
        return []
    bins = n.groupBy("bin").agg(F.sum("n").alias("size"))
    before = bins.select("bin", (F.sum("size").over(Window.orderBy("bin")) - F.col("size")).alias("before"))
    placed = n.join(F.broadcast(before), "bin").withColumn("last", F.col("before") + F.sum("n").over(Window.partitionBy("bin").orderBy("x")))
    places = [(total - 1) * s for s in shares]
    found = placed.agg(*(F.min(F.when(F.col("last") > k, F.col("x"))) for at in places for k in (math.floor(at), math.ceil(at)))).first()
    return [low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high for at, low, high in zip(places, found[::2], found[1::2], strict=True)]


def score_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """base_rules with llr (mean log-likelihood ratio of a word or pair of words; 0 without any) and kept.

    kept is false if the base rules fail or llr < threshold. The threshold is learned unless given: from all trusted documents that pass
    the base rules and that the ratio wasn't learned from; for that the scores are written, with the columns named in carry. Null and
    empty texts fail the base rules. Repeated rows are judged alike, null ids too; what carry names goes along, other columns aren't
    looked at, whatever their names. Without trusted documents only the base rules decide. The sums are of rounded whole numbers, so no
    order of rows changes a verdict.
    """
    ids = cut(split(trusted, id_col))
    w = cut(ratio_weights(docs, ids, id_col, text))
    llr = F.when(F.col("n_words") > 0, F.col("_sum") / (2 * F.col("n_words") - 1) / 1_000_000).otherwise(0.0)
    scored = base_rules(docs, id_col, text, w.scalar(), carry).withColumn("llr", llr).drop("_sum")
    if threshold is None:
        scored = cut(scored)
        held = scored.where("not base_failed").select(id_col, "llr").join(ids.where("_hold").select(id_col), id_col, "left_semi")
        low, middle = quantiles(held.select("llr"), [LOW, 0.5]) or (float("-inf"), 0.0)
        threshold = low - (middle - low) / 2
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
