"""Mixing sources to target weights by temperature, and drawing the mixture as permuted blocks of a token budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, words

#: Times that a document of a source may be drawn on average.
MAX_REPEAT = 2.0
#: Tokens of a block.
BLOCK_TOKENS = 1 << 20
#: Documents in a slice of a source's permutation: slices are summed first, so that no source is put in order as a whole.
SLICE_ROWS = 4096
SEED = 17
#: Equal rows that are numbered by one task.
COPIES = 4096
#: Steps of bisection in one pass over the sources, and passes.
LEVELS, PASSES = 5, 5
#: Source tables up to this many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 10_000
#: Parts that sources are dealt to by their hash, so that their quotas are added up part by part.
PARTS = 1024


def permuted(seed: int, *parts: Column) -> Column:
    """A pseudo-random number below 2**60 of the values: hexadecimal digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts))), 1, 15), 16, 10).cast("long")


def _part(share: Column, n: Column) -> Column:
    """Which of n equal parts of [0, 1] holds share, from 0; in doubles, as the products would not fit a long."""
    return F.least(F.floor(share * n).cast("long"), n.cast("long") - 1)


def source_shares(docs: DataFrame, source: str = "source", tokens: str = "n_tokens") -> DataFrame:
    """(source, rows, tokens, share) of each source with tokens; null is a source of its own."""
    own = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("rows"), F.sum(tokens).cast("long").alias("tokens")).where("tokens > 0")
    own = cut(own)
    total = own.agg(F.sum("tokens")).first()[0]
    return own.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))


def fit_exponent(shares: DataFrame, max_repeat: float | None = MAX_REPEAT, target_entropy: float | None = None) -> float:
    """The exponent in [0, 1] that flattens the shares most while the limit holds, to six decimals.

    With target_entropy (nats), the largest exponent whose weights p^a / sum p^a have at least that entropy (0 if none has). Otherwise
    the smallest exponent at which no source is repeated more than max_repeat times as often as the least repeated one. Both measures
    change in one direction with a, so the exponent is bisected; a pass over the sources measures the LEVELS next midpoints at once.
    """
    lo, hi = 0.0, 1.0
    for _ in range(PASSES):
        n = 1 << LEVELS
        grid = [lo + (hi - lo) * k / n for k in range(n + 1)]
        p, a = F.col("share"), F.col("a")
        rows = shares.select("share", F.explode(F.array(*map(F.lit, grid))).alias("a")).groupBy("a").agg(F.sum(F.pow(p, a)).alias("z"), F.sum(F.pow(p, a) * F.log(p)).alias("s"), F.max(F.pow(p, a - 1)).alias("most"), F.min(F.pow(p, a - 1)).alias("least")).collect()
        if not rows:
            return 1.0
        at = {r["a"]: r for r in rows}
        if target_entropy is not None:
            import math

            holds = [math.log(at[a]["z"]) - a * at[a]["s"] / at[a]["z"] >= target_entropy for a in grid]
            k = max((i for i, ok in enumerate(holds) if ok), default=None)
            if k is None:
                return 0.0
            if k == n:
                return round(hi, 6)
        else:
            holds = [max_repeat is None or at[a]["most"] <= max_repeat * at[a]["least"] for a in grid]
            k = min((i for i, ok in enumerate(holds) if ok), default=n)
            if k == 0:
                return round(lo, 6)
            k -= 1
        lo, hi = grid[k], grid[k + 1]
    return round(lo if target_entropy is not None else hi, 6)


def source_weights(shares: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """shares with weight and quota (tokens to draw). Without a budget, the smallest one that draws every document at least once.

    The quotas of a budget add up to it: each is the difference of two neighbouring sums of weights, both rounded. Sources are dealt to
    parts by hash, and only the parts, a fixed number, are put in order as a whole.
    """
    p = F.pow("share", F.lit(exponent))
    z = shares.agg(F.sum(p)).first()[0] or 1.0
    out = shares.withColumn("weight", p / F.lit(z))
    if budget is None:
        total = out.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
        return out.withColumn("quota", F.greatest(F.round(F.col("weight") * total).cast("long"), F.col("tokens")))
    # whole numbers, so that sums don't depend on their order
    units = F.greatest(F.round(F.col("weight") * float(1 << 50)).cast("long"), F.lit(1).cast("long"))
    out = cut(out.withColumns({"_h": F.xxhash64("source"), "_units": units}).withColumn("_part", F.pmod("_h", F.lit(PARTS))))
    parts = out.groupBy("_part").agg(F.sum("_units").alias("_n"))
    parts = cut(parts.select("_part", "_n", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before")))
    all_ = float(parts.agg(F.sum("_n")).first()[0] or 1)
    x = out.join(F.broadcast(parts), "_part").withColumn("_end", F.col("_before") + F.sum("_units").over(Window.partitionBy("_part").orderBy("_h", "source").rowsBetween(Window.unboundedPreceding, 0)))
    place = lambda c: F.round(c / F.lit(all_) * budget).cast("long")
    return x.withColumn("quota", place(F.col("_end")) - place(F.col("_end") - F.col("_units"))).select(*shares.columns, "weight", "quota")


def _numbered(d: DataFrame) -> DataFrame:
    """d with a number, from 1, for each of its equal rows: they are counted, and made again from their counts by many tasks."""
    c = d.groupBy(*d.columns).agg(F.count(F.lit(1)).alias("_n"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES)))
    c = c.withColumn("_part", part).repartition(*d.columns, "_part")
    copies = F.sequence(F.col("_part") * COPIES + 1, F.least("_n", (F.col("_part") + 1) * COPIES))
    return c.select(*d.columns, F.explode(copies).alias("copy"))


def draw(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", max_repeat: float | None = MAX_REPEAT, target_entropy: float | None = None, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(id, source, n_tokens, epoch, block, place): the mixture, a row for each time that a document is drawn.

    A source of quota q is gone through in epochs, each a permutation of all its documents, until q tokens are drawn; the document
    that reaches the quota is drawn whole. Positions in its source's quota spread a source evenly over the blocks, and a block is
    permuted as a whole: place counts from 1. Tokens are words. Documents without a word have no tokens: they take no part. A null
    source is a source, a null id an id. Rows that repeat, or repeat an id, are drawn each on their own: equal ones are numbered, and the
    permutation is by id, tokens and number, so it is the same in every run and spreads them over the slices. Ties of it go to the smaller
    id, then to fewer tokens. Other columns are not read. No source is sorted in one task: its permutation is cut into slices of about slice_rows documents, which are summed.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("n_tokens")).where("n_tokens > 0")
    d = cut(d)
    shares = cut(source_shares(d))
    weights = cut(source_weights(shares, fit_exponent(shares, max_repeat, target_entropy), budget).withColumn("slices", F.ceil(F.col("rows") / slice_rows)).drop("rows", "share"))
    quota = weights.agg(F.sum("quota")).first()[0] or 0
    weights = weights.withColumn("blocks", F.lit(max(1, -(-quota // block_tokens)))).withColumnRenamed("source", "s")
    small = F.broadcast(weights) if weights.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else weights
    epochs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / F.col("tokens")))
    x = _numbered(d).join(small, F.col("source").eqNullSafe(F.col("s"))).where("quota > 0").drop("s").withColumn("epoch", F.explode(epochs))
    row = (F.col("epoch"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("n_tokens"), F.col("copy"))
    x = x.withColumn("order", permuted(seed, *row)).withColumn("slice", _part(F.col("order") / F.lit(float(1 << 60)), F.col("slices")))
    key = ["source", "epoch", "slice"]
    before = x.groupBy(*key).agg(F.sum("n_tokens").alias("_n")).withColumn("_before", F.sum("_n").over(Window.partitionBy("source", "epoch").orderBy("slice")) - F.col("_n")).drop("_n")
    within = F.sum("n_tokens").over(Window.partitionBy(*key).orderBy("order", "id", "n_tokens", "copy").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    x = x.withColumn("_within", within).join(before.select(*(F.col(k).alias(f"_{k}") for k in key), "_before"), F.col("source").eqNullSafe(F.col("_source")) & (F.col("epoch") == F.col("_epoch")) & (F.col("slice") == F.col("_slice")))
    x = x.withColumn("position", F.col("epoch") * F.col("tokens") + F.col("_before") + F.col("_within")).where("position < quota")
    x = x.withColumn("block", _part(F.col("position") / F.col("quota"), F.col("blocks")))
    x = x.withColumn("_order", permuted(seed + 1, *row))
    x = x.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy("_order", "id", "epoch", "position")).cast("long"))
    return x.select(F.col("id").alias(id_col), F.col("source").alias(source), "n_tokens", "epoch", "block", "place")
