"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The documents of a source lie in hashed order on a line of words; the mix takes the first
``quota`` words of that line, going round again past its end, so every document is taken
``quota / source size`` times give or take one, and each source's words are its quota exactly
(the last copy may be cut).  Quotas are counted in blocks of words.  A binary tree over the output
shards splits the vector of block quotas: at each node the left half's blocks are a
multivariate-hypergeometric draw from the node's, so every block is dealt once, shards are
equally large and each has a random mix with the right mean.  A source's blocks are permuted
(an affine permutation modulo their number) and a shard draws the run of permuted
blocks that its quota gives it.  A copy belongs to the block it starts in; a shard is
shuffled by a hash of its copies.

A node is one row per source.  Positions on a hot source's line come from sums in hashed parts
and a running sum over parts, so no task sees a whole source.  Every draw is seeded by its node,
so reruns and retried tasks agree.

Defined results: a null source is a source, last in order; a null or blank text has size 0 and
is taken 0 words; a source of size 0 has target 0; repeated rows are documents of their own;
an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, need, ship_by_value, word_count

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2
SHARDS, BLOCK_WORDS, SEED = 16, 4096, 20240917
#: Blocks of a mix at most: larger mixes get larger blocks (numpy's draws need counts below 1e9).
MAX_BLOCKS = 1 << 28
ship_by_value(__name__)


def primes_from(n: int, count: int) -> list[int]:
    """The first primes from ``n``: larger than any number of blocks, so prime to it."""
    out: list[int] = []
    while len(out) < count:
        if n % 2 and all(n % d for d in range(3, int(n ** 0.5) + 1, 2)):
            out.append(n)
        n += 1
    return out


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(src, no_src, source_size, target) from (src, no_src, source_size).

    Targets are min(cap * size, level * weight) with the level at which they add up to
    ``share`` of all words: what handing the excess round by weight ends at.  The windows
    run over one row per source."""
    by_name = Window.orderBy(F.col("no_src"), F.col("src"))
    by_ratio = Window.orderBy("ratio", "no_src", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("i"), F.lit(len(weights))) + 1).cast("int"))
    s = (sizes.withColumn("i", F.row_number().over(by_name) - 1).withColumn("weight", w)
         .withColumn("limit", F.col("source_size") * float(cap)).withColumn("ratio", F.col("limit") / F.col("weight")))
    total = F.sum("source_size").over(everything) * float(share)
    full = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumns({"level": (total - full) / open_weight, "rank": F.row_number().over(by_ratio)})
    # the first source, by ratio, that the level leaves open ends the filling
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("rank", "level"))).over(everything)
    s = s.withColumn("level", level["level"])
    return s.select("src", "no_src", "source_size", F.least(
        F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))).alias("target"))


def split_node(seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values(["no_src", "src"], kind="stable")
        number, leaves = int(node["node"].iloc[0]), int(node["leaves"].iloc[0])
        counts = node["blocks"].to_numpy(np.int64)
        left_leaves = leaves // 2
        rng = np.random.default_rng([seed, number])
        left = rng.multivariate_hypergeometric(counts, int(counts.sum()) * left_leaves // leaves, method="marginals")
        halves = [node.assign(node=2 * number, leaves=left_leaves, first=node["first"], blocks=left),
                  node.assign(node=2 * number + 1, leaves=leaves - left_leaves, first=node["first"] + left_leaves,
                              blocks=counts - left)]
        return pd.concat(halves)

    return run


def deal_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(src, no_src, first, blocks): the blocks of each source that each output shard
    (``first``) gets, from (src, no_src, blocks)."""
    schema = "src string, no_src boolean, blocks long, node long, leaves int, first int"
    nodes = quotas.select("src", "no_src", "blocks", F.lit(1).cast("long").alias("node"),
                          F.lit(shards).alias("leaves"), F.lit(0).alias("first"))
    done = nodes.filter("leaves = 1")
    for _ in range(max(shards - 1, 0).bit_length()):
        nodes = nodes.filter("leaves > 1").groupBy("node").applyInPandas(split_node(seed), schema)
        done = done.unionByName(nodes.filter("leaves = 1"))
    return done.select("src", "no_src", "first", "blocks")


def mixing_plan(sizes: DataFrame, total: int, store: Callable[[DataFrame], DataFrame], shards: int = SHARDS,
                weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP, block_words: int = BLOCK_WORDS,
                seed: int = SEED) -> DataFrame:
    """One row per source: source_size, target, quota (words), blocks, block_words, step (of the
    permutation) and ends, the permuted block at which each shard's run ends."""
    words = max(block_words, -(-int(total * share) // MAX_BLOCKS))
    quota = F.least(F.floor(F.col("target") + 0.5).cast("long"), (F.col("source_size") * cap).cast("long"))
    steps = F.array(*[F.lit(p) for p in primes_from(MAX_BLOCKS * 2, 16)])
    step = F.element_at(steps, (F.pmod(F.xxhash64(F.lit(seed), "src", "no_src"), F.lit(16)) + 1).cast("int"))
    s = (source_targets(sizes, weights, share, cap).withColumn("quota", quota)
         .withColumns({"blocks": F.ceil(F.col("quota") / words).cast("long"), "block_words": F.lit(words).cast("long")})
         .withColumn("step", step % F.greatest(F.col("blocks"), F.lit(1))))
    s = store(s)
    upto = Window.partitionBy("src", "no_src").orderBy("first")
    dealt = (deal_quotas(s.select("src", "no_src", "blocks"), shards, seed)
             .withColumn("end", F.sum("blocks").over(upto))
             .groupBy("src", "no_src").agg(F.array_sort(F.collect_list("end")).alias("ends")))
    return store(s.join(dealt, ["src", "no_src"], "left"))


def mix(df: DataFrame, store: Callable[[DataFrame], DataFrame], text: str = "text", id_col: str = "doc_id",
        source: str = "source", keep_columns: list[str] | None = None, whole: bool = False, shards: int = SHARDS,
        weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP, block_words: int = BLOCK_WORDS,
        seed: int = SEED) -> DataFrame:
    """``df`` (or its ``keep_columns``) with size, source_size, target and ``copies``: an array
    of (copy, words, shard, place), place ordering the shard; earlier columns of these names
    give way.  ``whole``: the copy that a quota's end would cut is taken whole or not at all,
    whichever is nearer."""
    need(df, text, id_col, source)
    made = ["size", "source_size", "target", "copies"]
    columns = [c for c in (keep_columns if keep_columns is not None else df.columns) if c.lower() not in made]
    df = df.drop(*[c for c in df.columns if c.lower() in made])
    src, no_src, part, turn, size, at = fresh(df, "src", "no_src", "part", "turn", "size", "at")
    placed = df.select(*columns, *[c for c in (id_col, source) if c not in columns],
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias(src), F.col(source).isNull().alias(no_src),
                       word_count(F.col(text)).alias(size), F.xxhash64(F.lit(seed), F.col(id_col)).alias(turn))
    # words are counted once where the texts don't come along, else once more for the rows themselves
    if text in columns:
        narrow = store(placed.select(src, no_src, size, turn))
    else:
        narrow = placed = store(placed)
    sizes = store(narrow.groupBy(F.col(src).alias("src"), F.col(no_src).alias("no_src"))
                  .agg(F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("rows")))
    total, rows = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    plan = mixing_plan(sizes.select("src", "no_src", "source_size"), total, store, shards, weights, share, cap,
                       block_words, seed)
    n_parts = isqrt(rows) + 1  # as many parts of a source as rows in a part, at any size
    dealt = F.pmod(F.col(turn), F.lit(n_parts)).cast("int")
    placed, narrow = placed.withColumn(part, dealt), narrow.withColumn(part, dealt)
    keys = [src, no_src, part]
    sums = narrow.groupBy(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keys)]).agg(F.sum(size).alias("k_sum"))
    before = Window.partitionBy("k_0", "k_1").orderBy("k_2").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("k_from", F.coalesce(F.sum("k_sum").over(before), F.lit(0))).drop("k_sum")
    inner = Window.partitionBy(*keys).orderBy(turn, F.col(id_col), size).rowsBetween(Window.unboundedPreceding, 0)
    line = placed.withColumn(at, F.sum(size).over(inner) - F.col(size))
    same = (F.col(src) == F.col("k_0")) & (F.col(no_src) == F.col("k_1")) & (F.col(part) == F.col("k_2"))
    line = line.join(offsets, same).withColumn(at, F.col(at) + F.col("k_from")).drop("k_0", "k_1", "k_2", "k_from")
    p = plan.select(F.col("src").alias("p_src"), F.col("no_src").alias("p_no"), F.struct(
        "source_size", "target", "quota", "blocks", "block_words", "step", "ends").alias("p_"))
    line = line.join(p, (F.col(src) == F.col("p_src")) & (F.col(no_src) == F.col("p_no")))
    q, n = F.col("p_"), F.greatest(F.col("p_.blocks"), F.lit(1))

    def copy(i: Column) -> Column:
        start = i * q["source_size"] + F.col(at)
        words = F.least(F.greatest(q["quota"] - start, F.lit(0)), F.col(size))
        if whole:
            words = F.when(words * 2 >= F.col(size), F.col(size)).otherwise(F.lit(0))
        place = F.pmod(F.floor(start / q["block_words"]).cast("long") * q["step"] + q["step"], n)
        return F.struct(i.cast("int").alias("copy"), words.cast("long").alias("words"),
                        F.size(F.filter(q["ends"], lambda e: e <= place)).cast("int").alias("shard"),
                        F.xxhash64(F.lit(seed + 1), F.col(id_col), i).alias("place"))

    rounds = F.array(*[F.lit(i).cast("long") for i in range(int(np.ceil(cap)))])
    copies = F.filter(F.transform(rounds, copy), lambda x: x["words"] > 0)
    return line.select(*columns, F.col(size).alias("size"), q["source_size"].alias("source_size"),
                       q["target"].alias("target"), copies.alias("copies"))


def taken(copies: Column) -> Column:
    return F.aggregate(copies, F.lit(0).cast("long"), lambda n, x: n + x["words"])
