"""Near duplicates by SimHash, found with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments (22, 21 and 21 bits), each a vector of the
perfect binary Golay code (23, 12, 7).  Every vector lies within distance 3 of exactly one
codeword, and ``near(v)``, the codewords within distance 4, are one or six.  Hence

* vectors at distance 2 or less share a codeword of ``near`` (the codeword nearest to a
  vector between them), and
* for vectors at distance 1 or less, the codeword nearest to one is in ``near`` of the other.

Fingerprints with at most 4 differing bits have two segments with at most 2 of them
together (pigeonhole), split 0 + 2, 2 + 0 or 1 + 1.  So for each pair of segments (X, Y) a
fingerprint gets the keys (X itself, each of near(Y)), (each of near(X), Y itself),
(nearest(X), each of near(Y)) and (each of near(X), nearest(Y)): about 61 keys, and any two
fingerprints to be linked share one.  Equal keys meet in a shuffle; the members of a key
are compared with numpy, and each key gives the edges of a spanning forest of its links,
never all pairs.  Connected components run on distinct fingerprints.

Memory: a key's members are 8 bytes each (distinct fingerprints agreeing in 24 bits or
more), compared in slices.  Copies meet as one fingerprint before any key is made.

Defined results: null, empty and blank texts have no words and the fingerprint 0, linked
like any other; a null id takes part but is never a component's id unless all its ids
are null; repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import need, ship_by_value

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Generator polynomial of the binary Golay code (fixed value).
GENERATOR = 0xC75
#: First bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Shingles unpacked at a time.
CHUNK = 1 << 15
#: Keys that the members of one component are dealt over.
SALTS = 32

ship_by_value(__name__)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of one text as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - size + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        h = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in
                         zip(starts[at:at + CHUNK], ends[at:at + CHUNK], strict=True)), "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="int64")


def _remainder(v: int) -> int:
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= GENERATOR << (bit - 11)
    return v


class Golay:
    """Nearest codewords of 23-bit vectors, by syndrome tables built from the generator."""

    def __init__(self) -> None:
        unit = np.array([_remainder(1 << b) for b in range(23)], np.int64)
        self.low = np.zeros(1 << 12, np.int64)   # syndromes of the low 12 bits
        self.high = np.zeros(1 << 11, np.int64)  # and of the high 11
        for b in range(12):
            self.low[1 << b: 2 << b] = self.low[: 1 << b] ^ unit[b]
        for b in range(11):
            self.high[1 << b: 2 << b] = self.high[: 1 << b] ^ unit[12 + b]
        # error patterns of weight 0 to 4 by syndrome: the leader first, then those of weight 4
        self.errors = np.full((1 << 11, 6), -1, np.int64)
        filled = np.zeros(1 << 11, np.int64)
        patterns: list[tuple[int, int]] = [(0, 0)]
        for weight in range(5):
            for e, s in patterns:
                self.errors[s, filled[s]] = e
                filled[s] += 1
            patterns = [(e | 1 << b, s ^ int(unit[b])) for e, s in patterns for b in range(e.bit_length(), 23)]

    def near(self, v: np.ndarray) -> np.ndarray:
        """(n, 6) indices of the codewords within distance 4 of each vector, the nearest
        first; -1 where there are fewer."""
        e = self.errors[self.low[v & 0xFFF] ^ self.high[v >> 12]]
        return np.where(e < 0, -1, (v[:, None] ^ e) >> 11)


def fuzzy_keys(fp: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(keys, row numbers) of all keys of the fingerprints; a row's keys are distinct."""
    u = fp.astype(np.uint64)
    seg = [((u >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    near = [golay.near(s) for s in seg]
    rows = np.arange(len(fp))
    keys, owners = [], []

    def put(kind: int, left: np.ndarray, right: np.ndarray, shift: int, ok: np.ndarray) -> None:
        key = (np.int64(kind) << np.int64(58)) | (left << np.int64(shift)) | right
        keys.append(key[ok])
        owners.append(rows[ok])

    for p, (x, y) in enumerate(PAIRS):
        for i in range(6):
            put(3 * p, seg[x], near[y][:, i], 12, near[y][:, i] >= 0)
            put(3 * p + 1, near[x][:, i], seg[y], 22, near[x][:, i] >= 0)
            put(3 * p + 2, near[x][:, 0], near[y][:, i], 12, near[y][:, i] >= 0)
            if i:  # (nearest, nearest) is there already
                put(3 * p + 2, near[x][:, i], near[y][:, 0], 12, near[x][:, i] >= 0)
    return np.concatenate(keys), np.concatenate(owners)


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    golay = Golay()
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at in range(0, len(fp), 2048):
            keys, owners = fuzzy_keys(fp[at:at + 2048], golay)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[at:at + 2048][owners])], ["key", "fp"])


def bucket_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links among fingerprints with equal keys (rows sorted by key).
    Rows are compared at distance 1, 2, ... in the sorted order while any have equal keys."""
    parent = np.arange(len(keys))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left, right = [], []
    alive, d = np.arange(len(keys)), 1
    while True:
        alive = alive[alive + d < len(keys)]
        alive = alive[keys[alive] == keys[alive + d]]
        if not len(alive):
            break
        hit = alive[np.bitwise_count(fps[alive].view(np.uint64) ^ fps[alive + d].view(np.uint64)) <= max_bits]
        while len(hit):  # flat labels drop most links inside a tree at once
            flat = parent[parent]
            while not np.array_equal(flat, parent):
                parent[:] = flat
                flat = parent[parent]
            hit = hit[parent[hit] != parent[hit + d]]
            for i in hit[:4096].tolist():
                a, b = root(i), root(i + d)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    left.append(i)
                    right.append(i + d)
            hit = hit[4096:]
        d += 1
    return np.array(left, np.int64), np.array(right, np.int64)


def link_rows(max_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)

        def linked(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            i, j = bucket_links(k, f, max_bits)
            a, b = np.minimum(f[i], f[j]), np.maximum(f[i], f[j])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False)])
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last key may go on
            if whole:
                yield linked(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield linked(keys, fps)

    return run


def components(edges: DataFrame, store: Callable[[DataFrame], DataFrame], rounds: int = 60) -> DataFrame:
    """(node, root) with the smallest node of each connected component as its root, from
    edges (a, b) of longs.  Alternating large and small stars: aggregations and joins only,
    so the centre of a large star is split like any skewed join key.  Each round is written."""

    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e.select("a", "b") if small else e.select("a", "b").union(e.select(F.col("b"), F.col("a")))
        # small: b > a, node b with its smaller neighbours a; large: any node u with neighbours v
        pairs = both.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        joined = pairs.join(least, "u")
        out = joined.select(F.col("m").alias("a"), F.col("v").alias("b")) if small else \
            joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        if small:
            out = out.union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.filter("a < b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    e = store(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    seen = mark(e)
    for _ in range(rounds):
        if not seen[0]:
            break
        e = store(star(star(e, small=False), small=True))
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: no end after {rounds} rounds")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root"))


def simhash_components(spark: SparkSession, df: DataFrame, store: Callable[[DataFrame], DataFrame],
                       text: str = "text", id_col: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: the id, ``h`` (hash of its text), ``fp`` (long), ``root``
    (the smallest fingerprint of its component) and ``component_id`` (the smallest id)."""
    need(df, text, id_col)
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys find links of up to {MAX_BITS} bits")
    t = F.col(text)
    docs = store(df.select(F.col(id_col).alias("id"), F.xxhash64(t, t.isNull()).alias("h"),
                           fingerprints(t).alias("fp")))
    nodes = store(docs.groupBy("fp").agg(F.min("id").alias("least_id")))
    keyed = nodes.select("fp").mapInArrow(key_rows, "key long, fp long")
    links = (keyed.repartition("key").sortWithinPartitions("key")
             .mapInArrow(link_rows(max_bits), "a long, b long"))
    roots = components(links, store)
    # a component's members, its root among them; single fingerprints need no component
    members = roots.select(F.col("node").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct())
    linked = store(members.join(nodes, "fp"))
    ids = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    # a component of a third of all fingerprints is dealt over ``SALTS`` keys
    salted = ids.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = linked.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")).join(salted, ["root", "salt"])
    single = nodes.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("fp").alias("root"), F.col("least_id").alias("component_id"))
    found = store(joined.select("fp", "root", "component_id").unionByName(single))
    return docs.join(found, "fp").select(F.col("id").alias(id_col), "h", "fp", "root", "component_id")


def one_of_each(components_of: DataFrame, df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay: of each component the one with the smallest id (null
    last), of equal ids that with the smallest hash, of equal rows one."""
    stay = (components_of.groupBy("root")
            .agg(F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "h")).alias("x"))
            .select(F.col("x.id").alias("stay_id"), F.col("x.h").alias("stay_h")))
    t = F.col(text)
    keyed = df.select(*df.columns, F.xxhash64(t, t.isNull()).alias("row_h_"))
    out = keyed.join(stay, keyed[id_col].eqNullSafe(F.col("stay_id")) & (F.col("row_h_") == F.col("stay_h")), "left_semi")
    return out.dropDuplicates([id_col, "row_h_"]).select(*df.columns)
