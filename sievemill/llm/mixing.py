"""Mixing sources to target weights by temperature.

A source's token share p becomes the weight p**t, normalised. The exponent t is bisected between 0 (equal
weights) and 1 (the shares themselves): it is the one that meets the target entropy, or the smallest that keeps
within the repetition limit, whichever is larger. The budget is the smallest number of tokens at which every
source is used once in full, so no document is lost; a source of weight w is then passed budget * w / tokens
times.

The weights are realised as block permutations. A source's documents are dealt by hash into blocks of about
`block_tokens` tokens. Every pass goes through the blocks in an order of its own; the last, partial pass takes
blocks in its order until the source's budget is met, and the documents of the block that crosses it in hash
order until it is met. So a source's partial pass is three numbers: the crossing block, its place, and the last
hash in it. Budgets are worked out on keys and token counts; the texts are never shuffled. Sums by ranges of a
pass's order come first, so that no task orders more than the blocks of one range, or the hashes of one block.
Each emission carries a key that interleaves all sources evenly: sorting by it, in all or in parts, gives the mixed order.

The exponent needs sums over sources only: over how many sources have how many tokens, which are collected, or over
the table of sources by Spark where there are more than MAX_COUNTS such numbers. Sources may be as many as there are rows.

A null source is one of its own. Documents without tokens, and sources of such only, are emitted once. Rows that
repeat an id and text stay rows; they are dealt as one, so the partial pass takes all of them or none. Null ids are
dealt by text; ties in hash cannot be told apart and are taken together likewise. Texts of any length are counted
whole. Columns of any names pass through, unless they start with the prefix. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill.llm.names import unused

#: Different token counts of sources that are collected, and sources of a plan that is broadcast, at most.
MAX_COUNTS = 100_000
BLOCK_TOKENS = 1_000_000
#: Bits of the ranges of a pass's order that are summed first.
_RANGE_BITS = 12


@dataclass
class Mix:
    exponent: float
    budget: float
    weights: list[float]
    passes: list[float]  # how often each source is gone through


#: For an exponent t and shares x of the largest source: the sums of x**t and of x**t * log(x).
Sums = Callable[[float], tuple[float, float]]


def bisect(sums: Sums, smallest: float, entropy: float | None = None, repetition: float | None = None) -> float:
    """The exponent. smallest: the share x of the smallest source with tokens. entropy: of the weights, in nats; repetition: passes over any source, 1 at least. One of them is given."""
    if entropy is None and repetition is None:
        raise ValueError("give a target entropy, a repetition limit, or both")

    def fits(t: float) -> bool:
        if repetition is not None and smallest ** (t - 1) > repetition:  # passes over the smallest source
            return False
        if entropy is None:
            return True
        total, logs = sums(t)
        return math.log(total) - t * logs / total <= entropy

    low, high = 0.0, 1.0  # both conditions hold from some exponent on
    if fits(low):
        return low
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def sums_of(counts: dict[float, int], largest: float) -> Sums:
    """Sums over sources, given how many have each number of tokens."""
    x = np.array(sorted(counts), float) / largest
    n = np.array([counts[c] for c in sorted(counts)], float)

    def sums(t: float) -> tuple[float, float]:
        p = n * x**t
        return float(p.sum()), float((p * np.log(x)).sum())

    return sums


def solve(tokens: list[float], entropy: float | None = None, repetition: float | None = None) -> Mix:
    """The plan of a list of sources by their tokens."""
    some = [x for x in tokens if x]
    if not some:
        if entropy is None and repetition is None:
            raise ValueError("give a target entropy, a repetition limit, or both")
        return Mix(1.0, 0.0, [0.0] * len(tokens), [1.0] * len(tokens))
    largest = max(some)
    sums = sums_of(Counter(some), largest)
    t = bisect(sums, min(some) / largest, entropy, repetition)
    total = sums(t)[0]
    passes = [max(1.0, (largest / x) ** (1 - t)) if x else 1.0 for x in tokens]
    return Mix(t, sum(x * p for x, p in zip(tokens, passes, strict=True)), [(x / largest) ** t / total if x else 0.0 for x in tokens], passes)


def _exponent(known: DataFrame, entropy: float | None, repetition: float | None) -> tuple[float, float]:
    """The exponent for a table of sources (s, n), and the tokens of the largest one."""
    some = known.filter("n > 0")
    largest, smallest = some.agg(F.max("n"), F.min("n")).first()
    if largest is None:
        return 1.0, 1.0
    counts = some.groupBy("n").agg(F.count("*").alias("sources")).limit(MAX_COUNTS + 1).collect()
    if len(counts) <= MAX_COUNTS:
        sums = sums_of({r["n"]: r["sources"] for r in counts}, largest)
    else:

        def sums(t: float) -> tuple[float, float]:
            x = F.col("n") / float(largest)
            return tuple(some.agg(F.sum(F.pow(x, F.lit(t))), F.sum(F.pow(x, F.lit(t)) * F.log(x))).first())

    return bisect(sums, smallest / largest, entropy, repetition), float(largest)


def _cuts(keys: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Where each source's partial pass ends: (t, cut block, cut turn, cut deal); no row for a source without one."""
    dealt = keys.filter("n > 0").join(sources.filter("rest > 0"), F.col("s").eqNullSafe(F.col("t"))).withColumn("b", _block(F.col("deal"), F.col("blocks")))
    blocks = dealt.groupBy("s", "b").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"), F.first("whole").alias("whole"))
    blocks = blocks.withColumn("turn", _turn(seed, F.col("whole"), F.col("b"))).withColumn("range", F.shiftright("turn", 64 - _RANGE_BITS)).checkpoint()

    def crossing(rows: DataFrame, need: str, *order: str) -> DataFrame:
        """The row of each source at which the sum, in this order, reaches what is needed, and what is left there."""
        before = F.sum("n").over(Window.partitionBy("s").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn("left", F.col(need) - F.coalesce(before, F.lit(0))).filter("left > 0")
        return rows.groupBy("s").agg(F.min_by(F.struct(*order, "left"), "left").alias("c")).select(F.col("s").alias("t"), "c.*")

    ranges = crossing(blocks.groupBy("s", "range").agg(F.sum("n").alias("n"), F.first("rest").alias("rest")), "rest", "range")
    inside = blocks.join(ranges.withColumnsRenamed({"range": "r", "left": "need"}), F.col("s").eqNullSafe(F.col("t")) & (F.col("range") == F.col("r"))).drop("t")
    block = crossing(inside, "need", "turn", "b").checkpoint()
    rows = dealt.drop("t").join(block.withColumnsRenamed({"b": "cut block", "left": "need"}), F.col("s").eqNullSafe(F.col("t")) & (F.col("b") == F.col("cut block")))
    last = crossing(rows.groupBy("s", "deal").agg(F.sum("n").alias("n"), F.first("need").alias("need")), "need", "deal").select(F.col("t").alias("u"), F.col("deal").alias("cut deal"))
    return block.join(last, F.col("t").eqNullSafe(F.col("u"))).select("t", F.col("b").alias("cut block"), F.col("turn").alias("cut turn"), "cut deal")


def _block(deal: Column, blocks: Column) -> Column:
    return F.pmod(deal, blocks).cast("int")


def _turn(seed: int, whole: Column, number: Column) -> Column:
    """A block's place in the last pass."""
    return F.xxhash64(F.lit(seed), whole, number)


def mix(df: DataFrame, entropy: float | None = None, repetition: float | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1, block_tokens: int = BLOCK_TOKENS, prefix: str = "mix ") -> DataFrame:
    """The rows of the table as often as the mix takes them, with `mix tokens` long, `mix epoch` int (from 0) and `mix key` double.

    prefix: of these names, and of inner ones; no column of the table may start with it.
    """
    if unused(df.columns, prefix) != prefix:
        raise ValueError(f"a column starts with {prefix}")
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"\S+")), F.lit(0)).cast("long")
    source = F.col(source_col).cast("string")
    keyed = df.withColumns({f"{prefix}tokens": words, f"{prefix}deal": F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))})
    keys = keyed.select(source.alias("s"), F.col(f"{prefix}tokens").alias("n"), F.col(f"{prefix}deal").alias("deal")).checkpoint()
    known = keys.groupBy("s").agg(F.sum("n").alias("n")).checkpoint()
    t, largest = _exponent(known, entropy, repetition)
    bounded = known.limit(MAX_COUNTS + 1).count() <= MAX_COUNTS
    small = F.broadcast if bounded else lambda d: d  # so many short rows at most
    passes = F.when(F.col("n") > 0, F.greatest(F.lit(1.0), F.pow(F.lit(largest) / F.col("n"), F.lit(1 - t)))).otherwise(1.0)
    sources = known.withColumn("passes", passes).withColumn("whole", F.floor("passes").cast("int"))
    sources = sources.select(
        F.col("s").alias("t"), F.greatest(F.lit(1), F.round(F.col("n") / block_tokens)).cast("int").alias("blocks"), "whole", F.round((F.col("passes") - F.col("whole")) * F.col("n")).cast("long").alias("rest"), "passes"
    ).checkpoint()
    cuts = _cuts(keys, small(sources), seed)
    plan = sources.drop("rest").join(cuts.withColumnRenamed("t", "u"), F.col("t").eqNullSafe(F.col("u")), "left").drop("u")
    names = ["t", "blocks", "whole", "passes", "cut block", "cut turn", "cut deal"]  # beside any column of the table
    plan = small(plan.select(*(F.col(n).alias(f"{prefix}{n}") for n in names)).checkpoint())
    t_, n_blocks, whole, passes, cut_block, cut_turn, cut_deal = (F.col(f"{prefix}{n}") for n in names)
    chosen = keyed.join(plan, source.eqNullSafe(t_)).withColumn(f"{prefix}block", _block(F.col(f"{prefix}deal"), n_blocks))
    block, deal = F.col(f"{prefix}block"), F.col(f"{prefix}deal")
    more = (F.col(f"{prefix}tokens") > 0) & ((_turn(seed, whole, block) < cut_turn) | ((block == cut_block) & (deal <= cut_deal)))
    epochs = F.sequence(F.lit(0), whole - 1 + F.coalesce(more, F.lit(False)).cast("int"))
    out = chosen.withColumn(f"{prefix}epoch", F.explode(epochs))
    unit = lambda x: (F.pmod(x, F.lit(1 << 40)) / float(1 << 40))
    place = (unit(F.xxhash64(F.lit(seed), F.col(f"{prefix}epoch"), block)) + unit(F.xxhash64(deal, F.col(f"{prefix}epoch"))) / n_blocks) / (1 + 1 / n_blocks)
    share = F.when(F.col(f"{prefix}epoch") < whole, 1.0).otherwise(passes - whole)  # of a pass
    return out.withColumn(f"{prefix}key", (F.col(f"{prefix}epoch") + place * share) / passes).select(*df.columns, f"{prefix}tokens", f"{prefix}epoch", f"{prefix}key")


#: Passes over a source, at most, in the registered query and the pipeline.
REPETITION = 1.5


def op5_temperature_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = mix(docs, repetition=REPETITION)
    return out.select("doc_id", "source", F.col("mix tokens").alias("n_tokens"), F.col("mix epoch").alias("epoch"), F.col("mix key").alias("mix_key"))
