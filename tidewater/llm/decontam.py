"""Benchmark decontamination with a distributed positional inverted index.

An item's windows are its runs of ``window`` consecutive words (one run, if it has fewer).
Every window is represented by the positions of its two rarest words, rarity counted over
the whole corpus; a window with a word that the corpus lacks can't occur.  The words at
those positions are the index terms.  One pass over the documents stores their postings
(term, document, position, the words around it) as a table.  Each posting of a term at offset
``o`` of an item proposes the alignment (item, document, position - o); the lists of an
item's terms are intersected on it: an alignment survives only if at least as many
terms agree as every window holds.  The stored neighbours then tell exactly how far item
and document agree to both sides, and runs as long as a window are the phrase matches.
``proximity_matches`` intersects the same lists with a tolerance instead; ``decontaminate``
returns its items too where a ``slop`` is given.

Shuffled are postings of rare terms and alignments, never the documents' words; a passage
that a third of the documents share costs one row per posting and anchor, and its hot
terms meet only their own anchors (broadcast in blocks of a checked size, a term that many
items share in several).

Only DataFrame functions.  Defined results: a null or wordless document has n_words 0 and
no hit; a null or wordless item occurs nowhere; items with equal words are matched
once and all listed; an item without an id can be hit but not listed (n_items counts listed
items); repeated documents give repeated rows; empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, need

WINDOW, ANCHORS = 10, 2
#: Characters of terms broadcast at once (about 10 times as many bytes); more terms go in blocks.
BLOCK_CHARS = 4 << 20


def item_words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))),
                                  "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def blocks(terms: DataFrame, *columns: str, by: tuple[str, ...] = ()) -> list[DataFrame]:
    """``terms`` in parts small enough to broadcast, sized by the characters in ``columns`` (strings
    or arrays of them) and dealt by hash of the first one, or of the key ``by``."""
    size = terms.agg(F.sum(sum((F.char_length(F.concat_ws(" ", c)) for c in columns), F.lit(8)))).first()[0] or 0
    n = size // BLOCK_CHARS + 1
    return [F.broadcast(terms.filter(F.pmod(F.xxhash64(*(by or columns[:1])), F.lit(n)) == i)) for i in range(n)]


def anchor_blocks(anchor: DataFrame) -> list[DataFrame]:
    """The anchors in parts small enough to broadcast; those of a term that many items share are
    dealt over several parts."""
    return blocks(anchor, "term", "item", "before", "after", by=("term", "item", "off"))


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def anchors(items: DataFrame, frequency: DataFrame, window: int = WINDOW, k: int = ANCHORS) -> DataFrame:
    """(item, term, off, n, need, before, after): the index terms of every item.

    ``items``: (item, words, n); ``frequency``: (term, freq) over the corpus.  off counts
    from 0; before and after are the item's words next to it, nearest first; ``need`` of
    the item's anchors lie in every window."""
    at = items.select("item", "n", F.posexplode("words").alias("off", "term")).join(frequency, "term", "left")
    # a word of an item belongs to the windows that start up to window - 1 words before it
    starts = F.sequence(F.greatest(F.lit(0), F.col("off") - window + 1),
                        F.least(F.col("off"), F.greatest(F.lit(0), F.col("n") - window)))
    rank = Window.partitionBy("item", "start").orderBy("freq", "term", "off")
    whole = Window.partitionBy("item", "start")
    chosen = (at.select("item", "term", "off", F.coalesce("freq", F.lit(0)).alias("freq"), F.explode(starts).alias("start"))
              .withColumns({"rank": F.row_number().over(rank), "least": F.min("freq").over(whole)})
              .filter((F.col("rank") <= k) & (F.col("least") > 0))
              .select("item", "term", "off").distinct())
    side = lambda a, b: F.when(a <= b, F.slice(F.col("words"), a, b - a + 1)).otherwise(F.array().cast("array<string>"))
    off = F.col("off")
    return chosen.join(items, "item").select(
        "item", "term", "off", "n", F.least(F.lit(k), F.col("n")).alias("need"),
        F.reverse(side(F.greatest(F.lit(1), off - window + 2), off)).alias("before"),
        side(off + 2, F.least(F.col("n"), off + window)).alias("after"))


def postings(docs: DataFrame, terms: DataFrame, store: Callable[[DataFrame], DataFrame],
             window: int = WINDOW) -> DataFrame:
    """The stored index: (doc, h, term, pos, n_words, left, right) for the terms' occurrences,
    pos from 0, left and right the neighbouring words, nearest first; and one row with a null
    term for each document row, so that a document's word count needs no second pass."""
    side = lambda a, b: F.when(a <= b, F.slice(F.col("words"), a, b - a + 1)).otherwise(F.array().cast("array<string>"))
    base = docs.select("doc", "h", F.size("words").alias("n_words"), "words")
    # '' is no word: it marks the end of the document's words and finds the '' among the terms
    rows = base.select("doc", "h", "n_words", "words", F.posexplode_outer(F.concat("words", F.array(F.lit("")))).alias("pos", "word"))
    parts = []
    for i, block in enumerate(blocks(terms, "term")):
        some = block if i else F.broadcast(block.union(block.sparkSession.range(1).select(F.lit("").alias("term"))))
        parts.append(rows.join(some, F.col("word") == F.col("term")).select(
            "doc", "h", F.when(F.col("term") != "", F.col("term")).alias("term"), "pos", "n_words",
            F.reverse(side(F.greatest(F.lit(1), F.col("pos") - window + 2), F.col("pos"))).alias("left"),
            side(F.col("pos") + 2, F.least(F.col("n_words"), F.col("pos") + window)).alias("right")))
    return store(union(parts))


def agreement(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def alignments(index: DataFrame, anchor: DataFrame, window: int = WINDOW) -> DataFrame:
    """Offset-adjusted intersection: (item, n, doc, h, delta, hits) with at least ``need``
    anchors at delta; hits: the anchors' (pos, agreeing words to the left, to the right)."""
    listed = union([index.filter(F.col("term").isNotNull()).join(b, "term") for b in anchor_blocks(anchor)])
    return (listed.groupBy("item", "n", "need", "doc", "h", (F.col("pos") - F.col("off")).alias("delta"))
            .agg(F.collect_set(F.struct("pos", agreement(F.col("left"), F.col("before")).alias("l"),
                                        agreement(F.col("right"), F.col("after")).alias("r"))).alias("hits"))
            .filter(F.size("hits") >= F.col("need")))


def phrase_matches(aligned: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, doc, h, lo, hi): the document's words lo..hi are covered by windows of the item."""
    return (aligned.select("item", "n", "doc", "h", F.explode("hits").alias("x"))
            .filter(F.col("x.l") + F.col("x.r") + 1 >= F.least(F.lit(window), F.col("n")))
            .select("item", "doc", "h", (F.col("x.pos") - F.col("x.l")).alias("lo"),
                    (F.col("x.pos") + F.col("x.r")).alias("hi")).distinct())


def proximity_matches(index: DataFrame, anchor: DataFrame, slop: int = 3) -> DataFrame:
    """(item, doc, h, lo, hi, terms): documents with two different anchors of an item, at two
    positions, at their item distance give or take ``slop`` words: each posting looks at those
    whose alignment is at most ``slop`` before its own."""
    listed = union([index.filter(F.col("term").isNotNull()).join(b, "term") for b in anchor_blocks(anchor)])
    listed = listed.select("item", "doc", "h", "pos", "off", (F.col("pos") - F.col("off")).alias("delta"))
    near = (Window.partitionBy("item", "doc", "h").orderBy("delta").rangeBetween(-slop, 0))
    return (listed.withColumn("near", F.collect_set(F.struct("pos", "off")).over(near))
            .withColumn("near", F.filter("near", lambda x: (x["pos"] != F.col("pos")) & (x["off"] != F.col("off"))))
            .filter(F.size("near") > 0)
            .select("item", "doc", "h", F.least("pos", F.array_min("near.pos")).alias("lo"),
                    F.greatest("pos", F.array_max("near.pos")).alias("hi"),
                    (F.size(F.array_distinct("near.off")) + 1).alias("terms")).distinct())


def covered(ranges: Column) -> Column:
    """Positions covered by an array of (lo, hi) structs."""
    start = F.struct(F.lit(-1).cast("int").alias("upto"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, x: Column) -> Column:
        return F.struct(F.greatest(acc["upto"], x["hi"]).alias("upto"),
                        (acc["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(acc["upto"] + 1, x["lo"]) + 1)).alias("n"))

    return F.aggregate(F.array_sort(ranges), start, add, lambda acc: acc["n"])


def decontaminate(spark: SparkSession, df: DataFrame, benchmark: DataFrame,
                  store: Callable[[DataFrame], DataFrame], text: str = "text", id_col: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", window: int = WINDOW,
                  slop: int | None = None) -> DataFrame:
    """One row per row of ``df``: the id, ``h`` (hash of the text), n_words, n_hit, n_items,
    item_ids (sorted strings), items_sha256 and contaminated; with ``slop`` also n_near and
    near_ids, the items with a proximity match (those of phrases too).  ``contaminated`` is by
    phrases alone."""
    need(df, text, id_col)
    need(benchmark, item_text, item_id)
    named = store(benchmark.select(F.col(item_id).cast("string").alias("name"), item_words(F.col(item_text)).alias("words"))
                  .filter(F.size("words") > 0).withColumn("item", F.sha2(F.concat_ws(" ", "words"), 256)))
    items = named.select("item", "words").dropDuplicates(["item"]).withColumn("n", F.size("words"))
    t = F.col(text)
    docs = df.select(F.col(id_col).alias("doc"), F.xxhash64(t, t.isNull()).alias("h"), item_words(t).alias("words"))
    terms = store(items.select(F.explode("words").alias("term")).distinct())
    words = docs.select(F.explode_outer("words").alias("word"))  # outer: Spark else splits twice, to drop empty lists first
    frequency = store(union([words.join(b, F.col("word") == F.col("term")).groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
                             for b in blocks(terms, "term")]))
    anchor = store(anchors(items, frequency, window))
    index = postings(docs, anchor.select("term").distinct(), store, window)
    matches = store(phrase_matches(alignments(index, anchor, window), window))
    names = named.select("item", "name").distinct()
    by_doc = (matches.groupBy("doc", "h").agg(covered(F.collect_set(F.struct("lo", "hi"))).alias("n_hit"))
              .withColumnsRenamed({"doc": "m_doc", "h": "m_h"}))
    listed = (matches.select("item", "doc", "h").distinct().join(names, "item").groupBy("doc", "h")
              .agg(F.array_sort(F.collect_set("name")).alias("item_ids"))
              .withColumnsRenamed({"doc": "l_doc", "h": "l_h"}))
    rows = index.filter(F.col("term").isNull()).select("doc", "h", "n_words")
    more = []
    if slop is not None:
        # an item of one anchor has no distance: a phrase counts as near
        found = proximity_matches(index, anchor, slop).select("item", "doc", "h").unionByName(matches.select("item", "doc", "h"))
        near = store(found.distinct().join(names, "item").groupBy(F.col("doc").alias("n_doc"), F.col("h").alias("n_h"))
                     .agg(F.array_sort(F.collect_set("name")).alias("near_ids")))
        rows = (rows.join(near, rows["doc"].eqNullSafe(F.col("n_doc")) & (rows["h"] == F.col("n_h")), "left")
                .select("doc", "h", "n_words", F.coalesce("near_ids", F.array().cast("array<string>")).alias("near_ids")))
        more = [F.size("near_ids").cast("long").alias("n_near"), "near_ids"]
    out = (rows.join(by_doc, rows["doc"].eqNullSafe(F.col("m_doc")) & (rows["h"] == F.col("m_h")), "left")
           .join(listed, rows["doc"].eqNullSafe(F.col("l_doc")) & (rows["h"] == F.col("l_h")), "left"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(F.col("doc").alias(id_col), "h", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
                      F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
                      F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), *more)


def clean_rows(found: DataFrame, df: DataFrame, store: Callable[[DataFrame], DataFrame], text: str = "text",
               id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` without the contaminated ones.  Their keys are stored: Spark broadcasts
    them if that table is small and shuffles both sides if not."""
    t = F.col(text)
    bad = store(found.filter("contaminated").select(F.col(id_col).alias("bad_id"), F.col("h").alias("bad_h")).distinct())
    h = F.xxhash64(t, t.isNull())
    return df.join(bad, df[id_col].eqNullSafe(F.col("bad_id")) & (h == F.col("bad_h")), "left_anti")
