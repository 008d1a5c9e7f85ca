"""Importance resampling of documents towards a target text, on hashed word n-grams.

Texts are lower-cased (A-Z) and cut into words by an untrained ``tokenizers`` pre-tokeniser (a
Regex Split whose pieces carry their offsets); windows over the offset pairs give the n-grams.  A
feature's bucket is the crc32 of its bytes modulo ``buckets``.

1. Every document is read once: its bucket counts (at most ``buckets`` pairs) are stored.
2. Spark adds them up over the corpus, and the target's; the two histograms give a whole-number
   gain for each bucket, floor(1000 * ln of the smoothed ratio).  They are ``buckets`` long, the
   only data that pass through the driver.
3. A document's weight is the sum of its features' gains, its score adds Gumbel noise from a hash
   of its id.  The highest scores are a draw without replacement in proportion to the weights.
4. Ranks: a histogram of scores, summed up from above, tells how many rows have a higher score
   and where the draw ends; only rows above that are ordered, each score by itself, so no task
   sorts the whole draw.  (The sums run over runs of 128 neighbouring scores first.)

A task holds one Arrow batch of texts and the offsets of ``SLICE`` characters.

Defined results: a null or wordless text has no features and weight 0; a null id hashes as an
empty one and ranks behind equal scores with ids; equal rows get different ranks; without enough
eligible rows nothing is drawn; an empty target is a uniform one; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import need, ship_by_value

BUCKETS, MAX_N, PERCENT, LEAST_WORDS, SEED = 10_000, 1, 10, 20, 2024
SLICE, CACHED = 1 << 18, 1 << 17
#: What words are made of, and a break between words.
WORD, BREAK = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

ship_by_value(__name__)


def splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def slices(text: str, size: int) -> Iterator[str]:
    """Runs of about ``size`` characters that end at a break between words."""
    at = 0
    while at < len(text):
        found = BREAK.search(text, at + size)
        to = found.end() if found else len(text)
        yield text[at:to]
        at = to


class Buckets(dict):
    """Buckets of features seen lately."""

    def __init__(self, count: int) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, feature: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[feature] = bucket = crc32(feature.encode()) % self.count
        return bucket


def features(text: str | None, split, max_n: int, size: int = SLICE) -> Iterator[tuple[int, list[str]]]:
    """(words, features) of each slice of a text; windows reach back over slices."""
    low = (text or "").encode().lower().decode()  # bytes: A-Z only
    before: list[str] = []
    for part in slices(low, size):
        spans = [span for _, span in split.pre_tokenize_str(part)]
        words = [part[a:b] for a, b in spans]
        out = list(words)
        if max_n > 1:
            line, k = before + words, len(before)
            for n in range(2, max_n + 1):
                out.extend(" ".join(line[i:i + n]) for i in range(max(0, k - n + 1), len(line) - n + 1))
            before = line[max(0, len(line) - max_n + 1):]
        yield len(words), out


def bucket_counts(buckets: int, max_n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (text, id) to (id, n_words, n_features, buckets, counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, bucket = splitter(), Buckets(buckets)
        for batch in batches:
            words, total, keys, counts = [], [], [], []
            for text in batch.column(0):
                n, found = 0, Counter()
                for n_words, part in features(text.as_py(), split, max_n):
                    n += n_words
                    found.update(map(bucket.__getitem__, part))
                words.append(n)
                total.append(found.total())
                keys.append(np.fromiter(found.keys(), np.int32, len(found)))
                counts.append(np.fromiter(found.values(), np.int64, len(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(words, pa.int64()), pa.array(total, pa.int64()),
                 pa.array(keys, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                [batch.schema.names[1], "n_words", "n_features", "buckets", "counts"])

    return run


def counted(df: DataFrame, text: str, id_col: str, buckets: int, max_n: int) -> DataFrame:
    rows = df.select(F.col(text).alias("text_"), F.col(id_col).alias("id"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(bucket_counts(buckets, max_n),
                           f"id {kind}, n_words long, n_features long, buckets array<int>, counts array<long>")


def histogram(counts: DataFrame, buckets: int) -> list[int]:
    """The features in each bucket: ``buckets`` numbers."""
    pairs = counts.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    out = [0] * buckets
    for b, n in pairs.groupBy("x.buckets").agg(F.sum("x.counts")).collect():
        out[b] = n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))), in doubles."""
    k, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [math.floor(1000 * math.log(float(t + 1) * float(s_all + k) / (float(s + 1) * float(t_all + k))))
            for s, t in zip(corpus, target, strict=True)]


def weigh(gain: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.array(gain.value, np.int64)
        for batch in batches:
            keys, counts = batch.column(3), batch.column(4)
            products = by_bucket[keys.flatten().to_numpy()] * counts.flatten().to_numpy()
            ends = np.cumsum(keys.value_lengths().to_numpy())
            total = np.concatenate(([0], np.cumsum(products)))[np.concatenate(([0], ends))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(total))],
                                             ["id", "n_words", "n_features", "weight"])

    return run


def noise(id_col: str, seed: int) -> F.Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))) with the first 8 hex digits of sha256(``seed:id``) as h."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, store: Callable[[DataFrame], DataFrame], eligible: F.Column, percent: int) -> DataFrame:
    """``scored`` with the rank of the rows drawn: floor(percent * N / 100) of the N eligible ones."""
    hist = store(scored.filter(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")))
    draw = (hist.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * percent) // 100
    run = F.shiftright("score", 7)
    above = Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    runs = (hist.groupBy(run.alias("run")).agg(F.sum("n").alias("n"))
            .withColumn("higher", F.coalesce(F.sum("n").over(above), F.lit(0))).drop("n"))
    inside = Window.partitionBy("run").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    before = (hist.withColumn("run", run).withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(runs, "run").select("score", (F.col("higher") + F.col("inner")).alias("before")))
    before = store(before.filter(F.col("before") < draw))
    lowest = before.agg(F.min("score")).first()[0]
    taken = eligible & (F.col("score") >= lowest) if lowest is not None else F.lit(False)
    same = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last(), "n_features")
    place = F.col("before") + F.row_number().over(same)
    top = (scored.filter(taken).join(before, "score")
           .withColumn("rank", F.when(place <= draw, place)).drop("before"))
    rest = scored.filter(~F.coalesce(taken, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return top.unionByName(rest)


def resample(spark: SparkSession, df: DataFrame, target: DataFrame, store: Callable[[DataFrame], DataFrame],
             text: str = "text", id_col: str = "doc_id", target_text: str = "text", buckets: int = BUCKETS,
             max_n: int = MAX_N, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of ``df``; rank is null where not drawn."""
    need(df, text, id_col)
    need(target, target_text)
    docs = store(counted(df, text, id_col, buckets, max_n))
    wanted = counted(target.select(F.col(target_text).alias("text"), F.lit(0).alias("id")), "text", "id", buckets, max_n)
    gain = spark.sparkContext.broadcast(gains(histogram(docs, buckets), histogram(wanted, buckets)))
    kind = docs.schema["id"].dataType.simpleString()
    weighed = docs.mapInArrow(weigh(gain), f"id {kind}, n_words long, n_features long, weight long")
    scored = store(weighed.withColumn("score", F.col("weight") + noise("id", seed)))
    out = ranked(scored, store, F.col("n_words") >= least_words, percent)
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def resampled_rows(df: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that were drawn, for tables with distinct ids."""
    drawn = found.filter(F.col("rank").isNotNull()).select(F.col(id_col).alias("drawn_id_"))
    return df.join(drawn, df[id_col].eqNullSafe(F.col("drawn_id_")), "left_semi")
