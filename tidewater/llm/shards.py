"""Minimax contiguous sharding.

Atomic groups (rows with equal texts) are ordered by the 64-bit hash of their text.  The
shards are contiguous runs of that order, and the largest shard is as small as possible:
a binary search over capacities, each checked greedily (fill a shard until the next group
doesn't fit), gives the smallest feasible capacity, and the greedy cuts at that capacity
are the shards.  A group larger than the share of a shard gets a shard of its own, and the
runs before, between and after such groups are cut by a second search over the remaining
shards, as far as these suffice and no shard gets larger for it.

The groups stay in Spark.  The driver holds a prefix table of at most a few ten thousand
hash ranges (bytes and largest group of each).  A range is an interval for the greedy cut
that falls into it: where the verdict depends on the place of the cut inside, and only
there, one Spark job splits the range into 64, and the search goes on.  The result is
that of the search over all single groups.

Only DataFrame functions on the data; the driver works on the bounded prefix table.
Defined results: a null text is a group of its own, of 16 bytes a row, checksum 0; rows of
one text never part, so a text with more bytes than a shard's share has a shard as large as
that, and the others share the rest; fewer groups than shards leave the last shards empty; repeated rows are rows like
any other; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, need

N_SHARDS = 40
ROW_BYTES = 16
#: Hash ranges of the first prefix table, and the parts a range is split into.
RANGES, SPLIT = 1 << 12, 64
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


class Ranges:
    """Consecutive hash ranges with the bytes, the number of groups and the largest group of each."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, int, int]] = []  # lo, hi (inclusive), bytes, groups, largest

    def put(self, rows: list[tuple[int, int, int, int, int]], replaced: set[int]) -> None:
        self.rows = sorted([r for r in self.rows if r[0] not in replaced] + rows)
        self.start = [0]
        for r in self.rows:
            self.start.append(self.start[-1] + r[2])

    def runs(self, alone: set[int]) -> list[Ranges]:
        """The runs of ranges between those that start at ``alone``."""
        out: list[list[tuple[int, int, int, int, int]]] = [[]]
        for r in self.rows:
            if r[0] in alone:
                out.append([])
            else:
                out[-1].append(r)
        found = []
        for rows in filter(None, out):
            found.append(Ranges())
            found[-1].put(rows, set())
        return found

    def check(self, capacity: int, shards: int) -> tuple[int, int, set[int]]:
        """Shards that a greedy filling needs if each cut falls as late (first number) or as
        early (second) as the ranges allow, and the ranges with such a cut, where they differ."""
        counts, open_ranges = [], set()
        for early in (False, True):
            at, n, used = 0, 0, set()
            while at < self.start[-1] and n <= shards + 1:
                n += 1
                k = bisect_right(self.start, at + capacity) - 1  # ranges before k end within the shard
                if k >= len(self.rows):
                    break
                lo, _, _, groups, largest = self.rows[k]
                if groups == 1 or at + capacity == self.start[k]:
                    at = self.start[k]
                else:
                    used.add(lo)
                    # the next group doesn't fit: the cut leaves less than the largest group unfilled
                    at = max(self.start[k], at + capacity - largest + 1) if early else at + capacity
            counts.append(n)
            open_ranges |= used
        return counts[0], counts[1], open_ranges

    def cuts(self, capacity: int, shards: int) -> tuple[list[int], set[int]]:
        """First hash of the second and each later shard; or the ranges to split before that's known."""
        at, out = 0, []
        while at < self.start[-1]:
            k = bisect_right(self.start, at + capacity) - 1
            if k >= len(self.rows):
                break
            if self.rows[k][3] > 1 and at + capacity != self.start[k]:
                return [], {self.rows[k][0]}
            at = self.start[k]
            out.append(self.rows[k][0])
        return out, set()


def hash_ranges(groups: DataFrame, spans: list[tuple[int, int]], parts: int) -> list[tuple[int, int, int, int, int]]:
    """Bytes, groups and largest group of the parts of each span of hashes; parts without
    a group are left out.  ``groups``: one row per group, (h, bytes)."""
    out: list[tuple[int, int, int, int, int]] = []
    if len(spans) == 1:
        span_lo, span_hi = F.lit(spans[0][0]), F.lit(spans[0][1])
        inside = F.col("h").between(span_lo, span_hi)
    else:
        los = F.array(*[F.lit(a) for a, _ in spans])
        his = F.array(*[F.lit(b) for _, b in spans])
        j = F.size(F.filter(los, lambda x: x <= F.col("h")))
        groups = groups.withColumn("j", j).filter("j > 0")
        span_lo, span_hi = F.element_at(los, F.col("j")), F.element_at(his, F.col("j"))
        inside = F.col("h") <= span_hi
    # as decimals: the difference of two longs may exceed a long
    width = (span_hi.cast("decimal(20,0)") - span_lo.cast("decimal(20,0)") + 1)
    part = F.floor((F.col("h").cast("decimal(20,0)") - span_lo.cast("decimal(20,0)")).cast("decimal(20,0)")
                   * parts / width).cast("long")
    rows = (groups.filter(inside).select(span_lo.alias("lo"), span_hi.alias("hi"), part.alias("part"), "h", "bytes")
            .groupBy("lo", "hi", "part")
            .agg(F.min("h").alias("first"), F.max("h").alias("last"), F.sum("bytes").alias("bytes"),
                 F.count(F.lit(1)).alias("n"), F.max("bytes").alias("largest")).collect())
    for r in rows:
        out.append((r["first"], r["last"], int(r["bytes"]), r["n"], r["largest"]))
    return out


def minimax_cuts(groups: DataFrame, shards: int = N_SHARDS, ranges: int = RANGES,
                 split: int = SPLIT) -> tuple[list[int], int]:
    """The first hashes of shards 1, 2, ... and the smallest feasible capacity."""
    table = Ranges()
    table.put(hash_ranges(groups, [(LOW, HIGH)], ranges), set())
    if not table.rows:
        return [], 0

    def refine(los: set[int]) -> None:
        spans = sorted((r[0], r[1]) for r in table.rows if r[0] in los)
        for i in range(0, len(spans), 128):  # bounded expressions and results
            some = spans[i: i + 128]
            table.put(hash_ranges(groups, some, split), {a for a, _ in some})

    def smallest(alone: set[int], most: int) -> int | None:
        """The smallest capacity up to ``most`` of the runs between ``alone``, if there is one."""
        left, runs = shards - len(alone), table.runs(alone)
        if len(runs) > left:
            return None
        if not runs:
            return 0
        low = max(-(-sum(x.start[-1] for x in runs) // left), max(r[4] for x in runs for r in x.rows))
        high = most + 1
        while low < high:
            mid = (low + high) // 2
            checks = [x.check(mid, left) for x in table.runs(alone)]
            if sum(early for _, early, _ in checks) <= left:
                high = mid
            elif sum(late for late, _, _ in checks) > left:
                low = mid + 1
            else:
                refine(set().union(*(unsure for _, _, unsure in checks)))
        return low if low <= most else None

    capacity = smallest(set(), table.start[-1])
    alone, inner = set(), capacity
    for big in oversized(table, shards, refine):
        found = smallest(big, capacity)
        if found is not None:
            alone, inner = big, found
            break
    while True:
        done = [x.cuts(inner, shards) for x in table.runs(alone)]
        if not (unsure := set().union(*(u for _, u in done))):
            starts = {x.rows[0][0] for x in table.runs(alone)} | alone
            return sorted((starts | {c for found, _ in done for c in found}) - {table.rows[0][0]}), capacity
        refine(unsure)


def oversized(table: Ranges, shards: int, refine: Callable[[set[int]], None]) -> list[set[int]]:
    """The groups over an equal share of what the larger ones leave, as single ranges: all of
    them, all but the smallest, and so on to the largest one alone."""
    big: list[tuple[int, int, int, int, int]] = []
    while True:
        share = (table.start[-1] - sum(r[2] for r in big)) / max(1, shards - len(big))
        if several := {r[0] for r in table.rows if r[4] > share and r[3] > 1}:
            refine(several)
            continue
        more = sorted((r for r in table.rows if r[4] > share), key=lambda r: (-r[2], r[0]))
        if len(more) == len(big) or len(more) >= shards:
            return [{r[0] for r in more[:k]} for k in range(min(len(more), shards - 1), 0, -1)]
        big = more


def shard_rows(spark: SparkSession, df: DataFrame, cuts: list[int], rows: int, shards: int = N_SHARDS,
               hash_col: str = "h", id_col: str = "doc_id") -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).  Slots are
    numbered inside (shard, part) with parts dealt by the id's hash, so that a hot shard or
    text is numbered by many tasks, and shifted by the rows of the earlier parts."""
    part, shard, slot = fresh(df, "part", "shard", "slot")
    n_parts = isqrt(rows // shards) + 1  # as many parts of a shard as rows in a part, at any size
    edges = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    placed = df.withColumns({
        shard: F.size(F.filter(edges, lambda x: x <= F.col(hash_col))).cast("int"),
        part: F.pmod(F.xxhash64(F.col(id_col), F.lit("slot")), F.lit(n_parts)).cast("int"),
    })
    counts = placed.groupBy(F.col(shard).alias("k_shard"), F.col(part).alias("k_part")).agg(F.count(F.lit(1)).alias("k_n"))
    before = Window.partitionBy("k_shard").orderBy("k_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("k_from", F.coalesce(F.sum("k_n").over(before), F.lit(0))).drop("k_n")
    inner = Window.partitionBy(shard, part).orderBy(F.col(id_col).asc_nulls_first(), F.col(hash_col))
    numbered = placed.withColumn(slot, F.row_number().over(inner) - 1)
    out = numbered.join(offsets, (F.col(shard) == F.col("k_shard")) & (F.col(part) == F.col("k_part")), "left")
    return out.withColumn(slot, (F.col(slot) + F.col("k_from")).cast("long")).drop(part, "k_shard", "k_part", "k_from")


def minimax_shards(spark: SparkSession, df: DataFrame, store, text: str = "text", id_col: str = "doc_id",
                   shards: int = N_SHARDS, keep_text: bool = False) -> DataFrame:
    """``df`` (without its text unless ``keep_text``) with size, text_crc32, shard and slot;
    columns of these names that it had before give way.

    ``store`` writes a table and reads it back: the rows' sizes and hashes are computed
    once, from one scan of the texts."""
    need(df, text, id_col)
    made = ["size", "text_crc32", "shard", "slot"]
    columns = [c for c in df.columns if c.lower() not in made and (keep_text or c != text)]
    (h,) = fresh(df, "h")
    t = F.col(text)
    measured = store(df.select(*columns, *[text] * (text not in columns and keep_text),
                               text_size(t).alias("size"),
                               F.coalesce(F.crc32(t), F.lit(0)).cast("long").alias("text_crc32"),
                               F.xxhash64(t, t.isNull()).alias(h)))
    groups = store(measured.groupBy(F.col(h).alias("h")).agg(F.sum("size").alias("bytes"), F.sum(F.lit(1)).alias("n")))
    cuts, _ = minimax_cuts(groups, shards)
    rows = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return shard_rows(spark, measured, cuts, rows, shards, h, id_col).drop(h)
