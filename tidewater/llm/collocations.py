"""Phrase collocations from a prefix-free parse.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends and the pieces into
words.  Repeated text is counted once:

1. *Parse.*  A window of ``max_words - 1`` words whose hash is 0 modulo ``PERIOD`` is a trigger.  A
   piece is cut at its triggers into chunks; every chunk but a piece's last goes on over the whole
   next trigger, so neighbours overlap by that window.  Where a cut falls depends on the words
   alone, so equal passages give equal chunks whatever stands around them.  Spark adds up how often
   each distinct (language, chunk) occurs: the dictionary, stored with its parse frequencies.
2. *Count.*  An n-gram belongs to the chunk in whose own words (those before the next trigger) it
   starts, and lies inside that chunk as a whole: overlaps are assigned once.  So an n-gram's
   frequency is the sum of the parse frequencies over its places in distinct chunks.  A phrase found
   ``least`` times has all its parts found so often: words come first, then the pairs of words that may
   be frequent, then the longer n-grams whose pairs all may be (and of the words, those of frequent
   pairs go on).  These passes add up 64-bit keys, and hand on a bitmap of the keys that reach ``least`` (at most ``MAX_BITS`` bits,
   32 MiB; where the keys outgrow it, it lets more places through, never fewer).  A last pass counts
   the n-grams that the bitmaps let through by their words: frequencies don't rest on hashes.
3. *Score.*  Each cut of a candidate joins the frequencies of its two parts; products are Python
   integers of any size.  Candidates inside a longer phrase that is (nearly) as frequent go, and the
   best of each language are taken from the best of hashed parts.

A task holds a window of ``WINDOW`` bytes of text (or one longer piece) and ``SLAB`` keys at a time.

Defined results: a null or blank text has no words; a null language is ``und``; repeated rows count
as often as they occur; an empty table gives no phrase; equal scores and frequencies rank by the
phrase's bytes; other columns of the table, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import need, ship_by_value

MAX_WORDS, LEAST, TOP, SHARE = 5, 100, 2000, 100
#: One window in so many is a trigger, on average.
PERIOD = 16
#: Bytes of text handled at a time, keys added up in a task before they are handed on.
WINDOW, SLAB = 1 << 21, 1 << 22
#: Size of a bitmap at most, and bits for each key below that.
MAX_BITS, BITS_PER_KEY = 1 << 28, 32

#: Kinds of bytes: 0 of words, 1 blanks, 2 ends of pieces (fixed by the contract).
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2

ship_by_value(__name__)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers (a bijection: distinct numbers stay distinct)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(max(count, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word from the words' bytes, one after the other."""
    place = np.arange(len(data)) - np.repeat(first, lengths)
    terms = byte_values()[data] * powers(0xD6E8FEB86659FD93, int(lengths.max(initial=1)))[place]
    return mixed(np.add.reduceat(terms, first) + lengths.astype(np.uint64)) if len(first) else np.empty(0, np.uint64)


def rolled(keys: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n-grams from those of the (n - 1)-grams; entries past the end mean nothing."""
    if n == 1:
        return hashes
    out = np.zeros(len(hashes), np.uint64)
    k = len(hashes) - n + 1
    if k > 0:
        out[:k] = mixed(keys[:k] * np.uint64(0xA0761D6478BD642F) + hashes[n - 1:])
    return out


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The strings data[start : start + length]."""
    ends = np.cumsum(lengths)
    place = np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets),
                                            pa.py_buffer(np.ascontiguousarray(data[place]))).cast(pa.string())


def sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, a place of each, the sum of its weights)."""
    if not len(keys):
        return keys, np.empty(0, np.int64), weights
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    return ranked[first], order[first], np.add.reduceat(weights[order], first)


# ---------------------------------------------------------------- the parse


def windows(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of about ``size`` bytes that end with an end of a piece."""
    at = 0
    while at < len(data):
        step, to = size, len(data)
        while at + step < len(data):
            ends = np.flatnonzero(KIND[data[at:at + step]] == 2)
            if len(ends):
                to = at + int(ends[-1]) + 1
                break
            step *= 2
        yield at, to
        at = to


def chunks(data: np.ndarray, overlap: int, period: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(place in ``data``, text, own words) of each chunk."""
    kind = KIND[data]
    word = np.concatenate(([False], kind == 0, [False]))
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    n = len(starts)
    if not n:
        return np.empty(0, np.int64), pa.array([], pa.string()), np.empty(0, np.int64)
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    begins = np.concatenate(([True], piece[1:] != piece[:-1]))
    piece_ends = np.append(np.flatnonzero(begins)[1:], n)[np.cumsum(begins) - 1]  # of each word's piece
    bytes_ = data[kind == 0]
    first = np.cumsum(lengths) - lengths
    hashes, keys = word_hashes(bytes_, first, lengths), None
    for k in range(1, overlap + 1):
        keys = rolled(keys, hashes, k)
    trigger = (keys % np.uint64(period) == 0) & (np.arange(n) + overlap <= piece_ends)
    at = np.flatnonzero(begins | trigger)
    nxt, end = np.append(at[1:], n), piece_ends[at]
    stop = np.where(nxt < end, nxt + overlap, end)
    # the words with one blank after each
    blanked = np.full(len(bytes_) + n, 32, np.uint8)
    blanked[np.arange(len(bytes_)) + np.repeat(np.arange(n), lengths)] = bytes_
    first = first + np.arange(n)
    text = gathered(blanked, first[at], first[stop - 1] + lengths[stop - 1] - first[at])
    return starts[at], text, np.minimum(nxt, end) - at


def parse(overlap: int, period: int, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (text, lang) to (lang, chunk, own)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode().lower() for t in batch.column(0)]  # bytes: A-Z only
            ends = np.cumsum([len(t) + 1 for t in texts])
            data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
            del texts
            for a, b in windows(data, window):
                place, text, own = chunks(data[a:b], overlap, period)
                if len(own):
                    lang = batch.column(1).take(pa.array(np.searchsorted(ends, place + a, "right")))
                    yield pa.RecordBatch.from_arrays([lang, text, pa.array(own.astype(np.int32))], ["lang", "chunk", "own"])

    return run


def dictionary(df: DataFrame, text: str, lang: str, max_words: int = MAX_WORDS, period: int = PERIOD,
               window: int = WINDOW) -> DataFrame:
    """(lang, chunk, own, n): the distinct chunks, how many of their words are their own, and
    how often each occurs."""
    rows = df.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    return (rows.mapInArrow(parse(max_words - 1, period, window), "lang string, chunk string, own int")
            .groupBy("lang", "chunk", "own").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- counting in the dictionary


class Places:
    """The words of a batch of dictionary rows: hash, place in the chunk and weight of each."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        lang, chunk, own, n = (batch.column(i) for i in range(4))
        lang = lang.dictionary_encode()
        langs = np.array([hash_text(x) for x in lang.dictionary.to_pylist()], np.uint64)
        text = chunk.cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
        self.data = np.frombuffer(text.buffers()[2], np.uint8)[:offsets[-1]]
        blank = self.data == 32
        blank[:offsets[0]] = True
        word_at = ~blank
        begins = word_at.copy()
        begins[1:] &= blank[:-1]
        begins[offsets[:-1]] = True  # a chunk is never empty and starts with a word
        self.starts = np.flatnonzero(begins)
        last = np.cumsum(begins)[offsets[1:] - 1]
        count = np.diff(last, prepend=0)
        row = np.repeat(np.arange(len(text)), count)
        place = np.arange(len(self.starts)) - np.repeat(last - count, count)
        ends = np.append(self.starts[1:], offsets[-1] + 1) - 1
        chunk_last = last - 1
        ends[chunk_last] = offsets[1:]
        self.lengths = ends - self.starts
        first = np.cumsum(self.lengths) - self.lengths
        # a word's hash depends on the language, so the keys of different languages differ
        self.hashes = word_hashes(self.data[word_at], first, self.lengths) ^ langs[lang.indices.to_numpy()][row]
        self.left = np.repeat(last, count) - np.arange(len(self.starts))  # words to the chunk's end
        self.own = place < own.to_numpy()[row]
        self.weight = n.to_numpy()[row]
        self.row, self.lang = row, lang

    def alive(self, bitmaps: list[np.ndarray], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For the lengths 1 to n: (keys, places whose two shorter n-grams may be frequent)."""
        keys, may = None, np.ones(len(self.starts), bool)
        for k in range(1, n + 1):
            keys = rolled(keys, self.hashes, k)
            if k > 1:
                may[:-1] &= may[1:]
            may &= self.left >= k
            yield keys, may
            if k <= len(bitmaps):
                may &= marked(bitmaps[k - 1], keys)


def hash_text(text: str) -> int:
    data = np.frombuffer(text.encode() + b" ", np.uint8)
    return int(word_hashes(data, np.zeros(1, np.int64), np.array([len(data)]))[0])


def marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def slabs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes."""
    held, total = [], 0

    def put() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            total += held[-1].nbytes
            if total >= size:
                yield put()
                held, total = [], 0
    if held:
        yield put()


def count_keys(levels: list[int], bitmaps: Broadcast, slab: int, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(words, key, sum of the parse frequencies) of the n-grams of some lengths that may be frequent;
    with a bitmap of pairs also the words of pairs that may be."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {1: [], **{n: [] for n in levels}}
        pairs_known = len(bitmaps.value) == 2

        def put(k: int) -> pa.RecordBatch:
            keys, _, w = sums(*(np.concatenate(c) for c in zip(*held[k], strict=True)))
            held[k] = []
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int32)), pa.array(keys.view(np.int64)),
                                               pa.array(w)], ["words", "key", "n"])

        for batch in slabs(batches, window):
            at = Places(batch)
            for k, (found, may) in enumerate(at.alive(bitmaps.value, max([2 if pairs_known else 1, *levels])), 1):
                if k == 2 and pairs_known:
                    pairs = np.flatnonzero(may & marked(bitmaps.value[1], found))
                    words = sums(at.hashes[np.concatenate((pairs, pairs + 1))], np.ones(2 * len(pairs), np.int64))[0]
                    held[1].append((words, np.ones(len(words), np.int64)))
                if k in levels:
                    take = may & at.own
                    held[k].append((found[take], at.weight[take]))
            for k in held:
                if sum(len(keys) for keys, _ in held[k]) >= slab:
                    yield put(k)
        for k in held:
            if held[k]:
                yield put(k)

    return run


def count_phrases(n: int, bitmaps: Broadcast, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, phrase, words, sum of the parse frequencies) of the n-grams of all lengths whose keys
    are marked.  N-grams are told apart by the numbers of their words, not by keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, window // 2):
            at = Places(batch)
            words = gathered(at.data, at.starts, at.lengths).dictionary_encode()
            number = words.indices.to_numpy().astype(np.int64)
            langs = at.lang.indices.to_numpy().astype(np.int64)[at.row]
            code, distinct = None, max(len(words.dictionary), len(at.lang.dictionary))
            for k, (keys, may) in enumerate(at.alive(bitmaps.value, n), 1):
                places = np.flatnonzero(may & marked(bitmaps.value[k - 1], keys))
                # codes of the places' k-grams: below the number of places, so products fit 64 bits
                both = (langs if k == 1 else code)[places] * distinct + number[places + k - 1]
                code = np.zeros(len(number), np.int64)
                code[places] = np.unique(both, return_inverse=True)[1]
                places = places[at.own[places]]
                _, first, n_ = sums(code[places], at.weight[places])
                if len(first):
                    i = places[first]
                    end = i + k - 1
                    phrase = gathered(at.data, at.starts[i], at.starts[end] + at.lengths[end] - at.starts[i])
                    yield pa.RecordBatch.from_arrays(
                        [at.lang.dictionary.take(pa.array(langs[i])), phrase, pa.array(np.full(len(i), k, np.int32)),
                         pa.array(n_)], ["lang", "phrase", "words", "n"])

    return run


def bitmap(keys: DataFrame, max_bits: int) -> np.ndarray:
    """The bits ``key mod size`` of all keys; Spark ORs the 64-bit words, at most max_bits / 64 rows."""
    size = 64
    n = keys.count()
    while size < min(n * BITS_PER_KEY, max_bits):
        size *= 2
    slot = F.col("key").bitwiseAND(F.lit(size - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    rows = keys.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return out


def frequent_phrases(spark: SparkSession, words: DataFrame, store: Callable[[DataFrame], DataFrame],
                     max_words: int = MAX_WORDS, least: int = LEAST, slab: int = SLAB, window: int = WINDOW,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """(lang, phrase, words, n) of every phrase of 2 to ``max_words`` words found ``least`` times or more,
    and of the words in them, stored, from a stored ``dictionary``.  Other words may be there too."""
    bitmaps: list[np.ndarray] = []
    for levels in ([1], [2], list(range(3, max_words + 1))):
        counted = words.mapInArrow(count_keys(levels, spark.sparkContext.broadcast(list(bitmaps)), slab, window),
                                   "words int, key long, n long")
        summed = counted.groupBy("words", "key").agg(F.sum("n").alias("n"))
        kept = store(summed.filter((F.col("n") >= least) | ~F.col("words").isin(levels)).select("words", "key"))
        if len(bitmaps) == 2:  # from here on only the words of frequent pairs count
            bitmaps[0] = bitmap(kept.filter("words = 1"), max_bits)
        bitmaps += [bitmap(kept.filter(F.col("words") == n), max_bits) for n in levels]
    found = words.mapInArrow(count_phrases(max_words, spark.sparkContext.broadcast(bitmaps), window),
                             "lang string, phrase string, words int, n long")
    return store(found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


# ---------------------------------------------------------------- scores


def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds floor(1000 * a * n / (l * r)) to rows (..., a, l, r, n), in integers of any size."""
    for batch in batches:
        a, l, r, n = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "l", "r", "n"))
        score = [1000 * w * x // (y * z) for w, y, z, x in zip(a, l, r, n, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.int64())], [*batch.schema.names, "score"])


def parts(phrase: str, first: F.Column | int, count: F.Column | int) -> F.Column:
    return F.array_join(F.slice(F.split(F.col(phrase), " "), first, count), " ")


def collocations(spark: SparkSession, df: DataFrame, store: Callable[[DataFrame], DataFrame], text: str = "text",
                 lang: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, share: int = SHARE,
                 period: int = PERIOD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases of 2 to ``max_words``
    words.  ``share``: a phrase goes where a longer one around it has so many percent of its
    frequency or more."""
    need(df, text, lang)
    if max_words < 2 or least < 1:
        raise ValueError("phrases have two words or more and occur")
    words = store(dictionary(df, text, lang, max_words, period))
    found = frequent_phrases(spark, words, store, max_words, least)
    totals = store(words.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n")))
    several = found.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    # a candidate's proper parts of two words or more, with its own frequency
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    inner = F.flatten(F.transform(lengths, lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: parts("phrase", i, m))))
    longer = (several.filter("words > 2").select("lang", "a", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longest")))
    kept = (several.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * share)).drop("longest"))

    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = kept.withColumn("k", cut).withColumns({
        "left_part": parts("phrase", F.lit(1), F.col("k")),
        "right_part": parts("phrase", F.col("k") + 1, F.col("words") - F.col("k"))})
    left = found.select("lang", F.col("phrase").alias("left_part"), F.col("n").alias("l"))
    right = found.select("lang", F.col("phrase").alias("right_part"), F.col("n").alias("r"))
    joined = (cuts.join(left, ["lang", "left_part"]).join(right, ["lang", "right_part"]).join(totals, "lang")
              .select("lang", "phrase", "k", "a", "l", "r", "n"))
    scored = joined.mapInArrow(scores, "lang string, phrase string, k int, a long, l long, r long, n long, score long")
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    lowest = store(lowest.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score"))

    # the best of hashed parts of a language, then the best of these
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    n_parts = isqrt(lowest.count() // max(top, 1)) + 1
    part = F.pmod(F.xxhash64("phrase"), F.lit(n_parts))
    heads = (lowest.withColumn("part", part)
             .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
             .filter(F.col("rank") <= top).drop("rank", "part"))
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
