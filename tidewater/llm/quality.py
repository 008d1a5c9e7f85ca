"""Quality rules with adaptive thresholds.

Every document gets integer signals; each (language, source) keeps one mergeable
quantile sketch per signal, the fences are derived from the sketches' quantiles, and the
documents are filtered by a join with the fences of their own group.

The sketch is a log-linear histogram (``bucket -> count``): values below 64 have a bucket
of their own, larger ones 32 buckets for each doubling (relative error below 1/32).  Two
sketches merge by adding counts, so partial aggregation builds them map-side, a group
holding a third of all rows costs no more than a small one, the sketch of a language is the
sum of its sources', and the same rows always give the same thresholds.

Only DataFrame functions.  Defined results: a null text has no words (all signals 0, base
rule failed); a null language or source is a group of its own; a group with fewer than
``min_group`` documents uses the merged sketch of its language, then that of all
languages; repeated rows are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import WHITE, fresh, need, words

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: Symbols counted by the base rule (fixed by the contract).
SYMBOLS = "#*$%&|<>"
#: Fence distance in inter-quartile ranges and the fewest documents a group's own fences need.
FENCE_IQR, MIN_GROUP = 6, 100
#: Least inter-quartile range of each signal (per mille, or hundredths of a character): a group
#: of documents that are all alike must not reject one that differs a little.
SIGNALS = {"symbols_pm": 10, "dup_lines_pm": 100, "repeat_pm": 80, "word_len": 30}
#: Signals with a lower fence too.
TWO_SIDED = ("word_len",)


def repeat_words(word_list: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, the first one included.
    The windows' hashes are sorted with their positions; a window is repeated if a neighbour
    has its hash; each repeated position then covers up to the next one, three words at most."""
    n = F.size(word_list)
    hashed = F.transform(
        F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.xxhash64(F.element_at(word_list, i), F.element_at(word_list, i + 1),
                       F.element_at(word_list, i + 2)).alias("h"), i.alias("p")))
    ordered = F.array_sort(hashed)
    # (lambda variables see the sorted array once, as the argument of the outer transform)
    positions = F.transform(F.array(ordered), lambda a: F.array_sort(F.transform(
        F.filter(a, lambda x, i: (F.get(a, i - 1)["h"] == x["h"]) | (F.get(a, i + 1)["h"] == x["h"])),
        lambda x: x["p"])))[0]
    return F.transform(F.array(positions), lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.coalesce(F.least(F.lit(3), F.get(p, i + 1) - x), F.lit(3))),
        F.lit(0).cast("long"), lambda acc, d: acc + d))[0]


def signals(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the base counts n_words, word_chars, n_symbols, n_lines, n_dup_lines and
    n_repeat_words (long) of the column ``text``."""
    need(df, text)
    (w,) = fresh(df, "w")
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(WHITE)) != "")
    out = df.withColumn(w, words(F.col(text)))
    (ls,) = fresh(out, "ls")
    out = out.withColumn(ls, lines)
    return out.withColumns({
        f"{prefix}n_words": F.size(w).cast("long"),
        f"{prefix}word_chars": F.char_length(F.translate(t, WHITE, "")).cast("long"),
        f"{prefix}n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
        f"{prefix}n_lines": F.size(ls).cast("long"),
        f"{prefix}n_dup_lines": (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"),
        f"{prefix}n_repeat_words": repeat_words(F.col(w)),
    }).drop(w, ls)


def bucket(v: Column) -> Column:
    """The sketch's bucket of a whole number >= 0; buckets have the values' order."""
    v = v.cast("long")
    shift = F.length(F.bin(v)) - 6  # 32 buckets for each power of two
    return F.when(v < 64, v).otherwise(
        shift.cast("long") * 32 + F.floor(v / F.pow(F.lit(2.0), shift))).cast("long")


def bucket_value(b: Column) -> Column:
    """The smallest value of a bucket."""
    shift = F.floor((b - 32) / 32)
    return F.when(b < 64, b).otherwise(
        ((b - shift * 32) * F.pow(F.lit(2.0), shift)).cast("long")).cast("long")


def sketches(measured: DataFrame, lang: str, source: str, names: list[str]) -> DataFrame:
    """Mergeable sketches: rows (lang, source, signal, bucket, n)."""
    return (measured
            .select(F.col(lang).alias("g_lang"), F.col(source).alias("g_source"), F.explode(F.array(*[
                F.struct(F.lit(i).alias("signal"), bucket(F.col(c)).alias("bucket"))
                for i, c in enumerate(names)])).alias("x"))
            .groupBy("g_lang", "g_source", "x.signal", "x.bucket").agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """First and third quartile and size of every group of ``keys`` and signal, from merged
    sketches (a window over at most a few thousand buckets of one signal)."""
    merged = sketch.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "signal").orderBy("bucket")
    all_of = Window.partitionBy(*keys, "signal")
    ranked = merged.withColumns({"upto": F.sum("n").over(w), "total": F.sum("n").over(all_of)})
    return ranked.groupBy(*keys, "signal").agg(
        F.first("total").alias("total"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("b1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("b3"),
    ).select(*keys, "signal", "total", bucket_value(F.col("b1")).alias("q1"), bucket_value(F.col("b3")).alias("q3"))


def fences(sketch: DataFrame, least: list[int], fence_iqr: int = FENCE_IQR,
           min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (g_lang, g_source): lo_<i> and hi_<i> for every signal i."""
    own = quartiles(sketch, ["g_lang", "g_source"])
    by_lang = quartiles(sketch, ["g_lang"]).select(
        F.col("g_lang").alias("l_lang"), F.col("signal").alias("l_signal"), F.col("total").alias("l_total"),
        F.col("q1").alias("l_q1"), F.col("q3").alias("l_q3"))
    overall = quartiles(sketch, []).select(
        F.col("signal").alias("a_signal"), F.col("q1").alias("a_q1"), F.col("q3").alias("a_q3"))
    q = (own.join(by_lang, F.col("g_lang").eqNullSafe(F.col("l_lang")) & (F.col("signal") == F.col("l_signal")), "left")
         .join(overall, F.col("signal") == F.col("a_signal"), "left"))
    pick = lambda c: (F.when(F.col("total") >= min_group, F.col(c))
                      .when(F.col("l_total") >= min_group, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}")))
    q = q.select("g_lang", "g_source", "signal", pick("q1").alias("q1"), pick("q3").alias("q3"))
    at = lambda i, c: F.max(F.when(F.col("signal") == i, F.col(c)))
    out = []
    for i, iqr in enumerate(least):
        spread = F.greatest(at(i, "q3") - at(i, "q1"), F.lit(iqr)) * fence_iqr
        out += [(at(i, "q1") - spread).alias(f"lo_{i}"), (at(i, "q3") + spread).alias(f"hi_{i}")]
    return q.groupBy("g_lang", "g_source").agg(*out)


def quality_rules(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                  fence_iqr: int = FENCE_IQR, min_group: int = MIN_GROUP, keep_columns: list[str] | None = None,
                  store=None) -> DataFrame:
    """``df`` (or its ``keep_columns``) with the base counts, ``base_failed`` and ``kept``.

    The sketches see the documents that pass the base rule; a document is kept if each
    signal lies within the fences of its language and source.  ``store`` (a function of
    a DataFrame) may cut the lineage of the measured rows, so that the signals, the costly
    part, are computed once."""
    need(df, text, lang, source)
    columns = keep_columns if keep_columns is not None else df.columns
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    if clash := {c.lower() for c in columns} & {*counts, "base_failed", "kept"}:
        df = df.drop(*[c for c in df.columns if c.lower() in clash])  # an earlier verdict gives way
        columns = [c for c in columns if c.lower() not in clash]
    carried = list(dict.fromkeys([*columns, lang, source]))
    m = signals(df.select(*dict.fromkeys([*carried, text])), text).select(*carried, *counts)
    m = store(m) if store else m
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    some = F.greatest(F.col("n_words"), F.lit(1))
    whole = lambda a, b: F.floor(a / b).cast("long")
    names = fresh(m, *SIGNALS)
    m = m.withColumns({
        "base_failed": failed,
        names[0]: whole(F.col("n_symbols") * 1000, some),
        names[1]: whole(F.col("n_dup_lines") * 1000, F.greatest(F.col("n_lines"), F.lit(1))),
        names[2]: whole(F.col("n_repeat_words") * 1000, some),
        names[3]: whole(F.col("word_chars") * 100, some),
    })
    f = fences(sketches(m.filter(~F.col("base_failed")), lang, source, names), list(SIGNALS.values()),
               fence_iqr, min_group)
    f = store(f) if store else f  # a written table: Spark broadcasts it only if its files are small
    verdict = F.lit(True)
    for i, (name, signal) in enumerate(zip(names, SIGNALS, strict=True)):
        verdict = verdict & (F.col(name) <= F.col(f"hi_{i}"))
        if signal in TWO_SIDED:
            verdict = verdict & (F.col(name) >= F.col(f"lo_{i}"))
    # every group is a (language, source) of the table: its fences are one row each
    joined = m.join(f, m[lang].eqNullSafe(f["g_lang"]) & m[source].eqNullSafe(f["g_source"]), "left")
    return joined.select(*columns, *counts, "base_failed",
                         (~F.col("base_failed") & F.coalesce(verdict, F.lit(False))).alias("kept"))
