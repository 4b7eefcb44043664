"""Temperature mixing of sources, with DataFrame functions only.

A source's share of the tokens (bytes of text) is raised to an exponent t in [0, 1] and normalised. t is bisected to the
largest value whose weights reach `entropy` (a share of the entropy of equal weights), and raised if otherwise a source
would be repeated more than `repeats` times. The budget is `budget` tokens, or if None the least at which the most
shrunk source is used exactly once, so that no document is lost.

Weights are realised by block permutations: in each epoch a document's md5 (seed, epoch, doc_id) puts it into one of its
source's blocks, of about `block_tokens` each, and orders it there. Whole epochs take every document; the last one takes
documents in the order (block, md5, doc_id) while the running sum stays within the budget. Running sums are taken over
blocks and within blocks, so a source with a third of all rows is many groups. Which documents are taken then follows
from one cut per source.

Edge cases: a null source is a source of its own; null or empty texts have 0 tokens and stay in whole epochs; rows that
repeat a doc_id are taken or left together; a source without tokens has weight 0 and one whole epoch; an empty table
gives an empty result; extra columns pass through. Up to `max_sources` sources are held in one row, and their plan is
broadcast; beyond that the sums which the bisection needs are aggregates over the table of sources, of which the driver sees a
few numbers, and the plan is joined without a hint.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._state import shared_dir

STEPS, AHEAD = 40, 5  # of the bisection; steps whose possible exponents are summed up in one pass


def tokens() -> Column:
    """Tokens of a document: the bytes of its text."""
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def plan(docs: DataFrame, entropy: float | None = None, repeats: float = 2.0, budget: int | None = None, max_sources: int = 10_000) -> DataFrame:
    """One row per source: tokens, exponent, weight, times (how often its tokens are used)."""
    shared_dir(docs.sparkSession)
    sizes = docs.groupBy("source").agg(F.sum(tokens()).alias("tokens")).checkpoint()
    if sizes.count() > max_sources:
        return _plan_of_many(sizes, entropy, repeats, budget)
    every = sizes.agg(F.sort_array(F.collect_list(F.struct("source", "tokens"))).alias("all"))  # max_sources entries at most
    every = every.withColumn("used", F.expr("filter(all, x -> x.tokens > 0)")).withColumn("total", F.expr("aggregate(used, 0D, (s, x) -> s + x.tokens)"))
    every = every.withColumn("p", F.expr("transform(used, x -> x.tokens / total)"))
    z = "aggregate(p, 0D, (s, x) -> s + pow(x, {t}))"
    h = f"aggregate(p, 0D, (s, x) -> s - pow(x, {{t}}) / {z} * ln(pow(x, {{t}}) / {z}))"
    worst = f"array_max(transform(p, x -> pow(x, {{t}} - 1))) / {z} * {budget}D / total" if budget is not None else "pow(array_max(p) / array_min(p), 1 - {t})"

    def bisected(good: str, up: bool) -> Column:
        """The end of [0, 1] towards which `good` fails, moved in: the largest good t if up, else the least."""
        move = "if({0}, named_struct('lo', {1}, 'hi', ends.hi), named_struct('lo', ends.lo, 'hi', {1}))" if up else "if({0}, named_struct('lo', ends.lo, 'hi', {1}), named_struct('lo', {1}, 'hi', ends.hi))"
        mid = "((ends.lo + ends.hi) / 2)"
        return F.expr(f"aggregate(sequence(1, {STEPS}), named_struct('lo', 0D, 'hi', 1D), (ends, i) -> {move.format(good.format(t=mid), mid)}, ends -> ends.{'lo' if up else 'hi'})")

    least = bisected(f"({worst}) <= {repeats}D", up=False)
    wide = bisected(f"({h}) >= {entropy}D * ln(size(p))", up=True) if entropy is not None else F.lit(0.0)
    every = every.withColumn("t", F.when(F.size("used") > 1, F.round(F.greatest(least, wide), 6)).otherwise(F.lit(1.0)))
    rows = every.select("t", "p", "total", F.explode("all").alias("x")).select("t", "p", "total", F.col("x.source").alias("source"), F.col("x.tokens").alias("tokens"))
    share = F.col("tokens") / F.col("total")
    weight = F.when(F.col("tokens") > 0, F.pow(share, "t") / F.expr(z.format(t="t"))).otherwise(F.lit(0.0))
    times = F.when(F.col("tokens") <= 0, F.lit(1.0)).otherwise(F.col("weight") * budget / F.col("tokens") if budget is not None else F.pow(F.expr("array_max(p)") / share, 1 - F.col("t")))
    return rows.withColumn("weight", weight).select("source", "tokens", F.col("t").alias("exponent"), F.round("weight", 9).alias("weight"), F.round(times, 9).alias("times"))


def _exponent(good: Callable[[list[float]], list[bool]], up: bool) -> float:
    """The bisection of plan(), with the exponents that the next few steps may come to tried at once."""
    lo, hi = 0.0, 1.0
    for _ in range(STEPS // AHEAD):
        tree, level = [], [(lo, hi)]
        for _ in range(AHEAD):
            tree += [(a + b) / 2 for a, b in level]
            level = [half for a, b in level for half in ((a, (a + b) / 2), ((a + b) / 2, b))]
        fine = dict(zip(tree, good(tree), strict=True))
        for _ in range(AHEAD):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if fine[mid] == up else (lo, mid)
    return lo if up else hi


def _plan_of_many(sizes: DataFrame, entropy: float | None, repeats: float, budget: int | None) -> DataFrame:
    """plan() of any number of sources."""
    used = sizes.filter("tokens > 0")
    total, high, low, n = used.agg(F.sum("tokens").cast("double"), F.max("tokens"), F.min("tokens"), F.count("*")).first()
    if not n:
        return sizes.select("source", "tokens", F.lit(1.0).alias("exponent"), F.lit(0.0).alias("weight"), F.lit(1.0).alias("times"))
    p, high, low = F.col("tokens") / total, high / total, low / total

    def sums(ts: list[float]) -> list[tuple[float, float]]:
        """For each exponent the sum of p^t, and of p^t ln(p^t)."""
        powers = [F.pow(p, F.lit(t)) for t in ts]
        found = used.agg(*[F.sum(x) for x in powers], *[F.sum(x * F.log(x)) for x in powers]).first()
        return list(zip(found[: len(ts)], found[len(ts) :], strict=True))

    def few_repeats(ts: list[float]) -> list[bool]:
        if budget is None:
            return [(high / low) ** (1 - t) <= repeats for t in ts]
        return [max(high ** (t - 1), low ** (t - 1)) / z * budget / total <= repeats for t, (z, _) in zip(ts, sums(ts), strict=True)]

    def wide(ts: list[float]) -> list[bool]:
        return [math.log(z) - h / z >= entropy * math.log(n) for z, h in sums(ts)]

    t = 1.0
    if n > 1:
        t = round(max(_exponent(few_repeats, up=False), _exponent(wide, up=True) if entropy is not None else 0.0), 6)
    weight = F.when(F.col("tokens") > 0, F.pow(p, F.lit(t)) / sums([t])[0][0]).otherwise(F.lit(0.0))
    times = F.when(F.col("tokens") <= 0, F.lit(1.0)).otherwise(weight * budget / F.col("tokens") if budget is not None else F.pow(F.lit(high) / p, F.lit(1 - t)))
    return sizes.select("source", "tokens", F.lit(t).alias("exponent"), F.round(weight, 9).alias("weight"), F.round(times, 9).alias("times"))


def _place(frame: DataFrame, epoch: Column, seed: int, block_tokens: int) -> DataFrame:
    """Adds _block and _order of an epoch; needs doc_id, and tokens of the source as `_source_tokens`."""
    order = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_source_tokens") / block_tokens)).cast("long")
    return frame.withColumn("_order", order).withColumn("_block", F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % blocks)


def realise(docs: DataFrame, weights: DataFrame, seed: int = 17, block_tokens: int = 2_000_000, max_sources: int = 10_000) -> DataFrame:
    """The rows of docs, each as often as it is used, with mix_epoch, mix_block, mix_order (its place in the block) and
    mix_weight (its source's weight). Columns of these names in docs give way."""
    small = F.broadcast if weights.count() <= max_sources else lambda rows: rows
    own = weights.select(F.col("source").alias("_of"), F.col("tokens").alias("_source_tokens"), F.col("weight").alias("_weight"), F.floor("times").cast("long").alias("_whole"), (F.col("times") - F.floor("times")).alias("_part"))
    light = docs.select("doc_id", "source", tokens().alias("_n")).join(small(own), F.col("source").eqNullSafe(F.col("_of")))
    light = _place(light, F.col("_whole"), seed, block_tokens).withColumn("_budget", F.floor(F.col("_part") * F.col("_source_tokens") + 1e-6))
    blocks = light.groupBy("_of", "_block").agg(F.sum("_n").alias("_sum"))
    ahead = F.sum("_sum").over(Window.partitionBy("_of").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(F.col("_of").alias("_of2"), F.col("_block").alias("_block2"), F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    within = F.sum("_n").over(Window.partitionBy("_of", "_block").orderBy("_order"))  # rows of one doc_id are taken or left together
    taken = light.withColumn("_within", within).join(blocks, F.col("_of").eqNullSafe(F.col("_of2")) & (F.col("_block") == F.col("_block2"))).filter(F.col("_ahead") + F.col("_within") <= F.col("_budget"))
    cut = taken.groupBy("_of").agg(F.max(F.struct("_block", "_order")).alias("_cut")).select(F.col("_of").alias("_of3"), "_cut")
    own = own.join(small(cut), F.col("_of").eqNullSafe(F.col("_of3")), "left").drop("_of3")  # a row for each source
    rows = docs.select("doc_id", "source", F.struct("*").alias("_row")).join(small(own), F.col("source").eqNullSafe(F.col("_of")))
    rows = _place(rows, F.col("_whole"), seed, block_tokens)
    more = (F.coalesce(F.struct("_block", "_order") <= F.col("_cut"), F.lit(False)) & (F.col("_part") > 0)).cast("long")
    rows = rows.withColumn("_copies", F.col("_whole") + more).filter("_copies > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    made = {"mix_epoch": "_epoch", "mix_block": "_block", "mix_order": "_order", "mix_weight": "_weight"}
    rows = _place(rows, F.col("_epoch"), seed, block_tokens)
    return rows.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in made], *[F.col(c).alias(k) for k, c in made.items()])


def mix(docs: DataFrame, entropy: float | None = None, repeats: float = 2.0, budget: int | None = None, seed: int = 17, block_tokens: int = 2_000_000, max_sources: int = 10_000) -> DataFrame:
    """plan() and realise() in one."""
    return realise(docs, plan(docs, entropy, repeats, budget, max_sources), seed, block_tokens, max_sources)
