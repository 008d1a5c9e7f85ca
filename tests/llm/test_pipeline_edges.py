"""The pipeline's stages on awkward rows that pass the quality rules, and on empty tables."""

import collections
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

CLASHING = ["H", "size", "shard", "score", "w", "x", "copies", "fp", "kept", "term", "part", "n_words", "id", "slot", "law",
            "root", "salt", "component_id", "target", "src", "turn", "n_symbols", "copy", "doc", "item"]


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n)) + "."


def awkward(spark):
    """Nulls, repeated rows, copies, a near copy, ties, a long text and leaks, all over 50 words."""
    long = "\n".join(prose(1000 + k, 60) for k in range(300))
    changed = prose(3).split(" ")
    changed[60] = "changed"
    rows = [(1, prose(1), "en", "a"), (1, prose(1), "en", "a"), (2, prose(1), "de", "b"),  # a repeated row, and a copy
            (3, prose(3), None, "a"), (4, " ".join(changed), "en", None), (None, prose(5), "en", "a"), (None, prose(6), None, None),
            (7, prose(7), "en", "c"), (7, prose(8), "en", "c"),  # one id, two texts
            (9, long, "fr", "c"), (10, prose(10) + " " + brute.PASSAGE.upper(), "en", "a"),
            (11, None, "en", "a"), (12, "", None, None), (13, "too short", "en", "a")]
    rows += [(100 + i, prose(100 + i), ["en", "de"][i % 2], "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    return df.withColumns({n: F.lit(f"own {n}") for n in CLASHING})


@pytest.fixture()
def folder(spark, tmp_path):
    items = [(1, brute.PASSAGE), (2, None), (None, ""), (3, "words that nothing holds at all, not one of them zzz")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_stages_on_awkward_rows(spark, folder):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    one = stages["quality rules"](spark, docs, folder).cache()
    good = docs.filter("doc_id IS NULL OR doc_id NOT IN (11, 12, 13)")
    key = lambda df: sorted((str(tuple(r)) for r in df.select(*docs.columns).collect()))
    assert one.columns == docs.columns and key(one) == key(good)

    two = stages["near duplicates"](spark, one, folder).cache()
    assert two.columns == docs.columns
    fps = {r["text"]: brute.simhash(r["text"]) for r in good.collect()}
    texts = [r["text"] for r in two.collect()]
    # one of each group: the copy, the repeated row and, if its fingerprint is near, the near copy are gone
    assert len(set(texts)) == len(texts) and set(texts) <= set(fps)
    groups = brute.components(len(fps), [(a, b) for a, x in enumerate(fps.values()) for b, y in enumerate(fps.values())
                                         if b < a and (x ^ y).bit_count() <= 4])
    assert len(texts) == len(set(groups))
    assert [r["doc_id"] for r in two.collect() if r["text"] == prose(1)] == [1]
    assert sum(r["doc_id"] is None for r in two.collect()) == 2 and sum(r["doc_id"] == 7 for r in two.collect()) == 2

    three = stages["decontamination"](spark, two, folder).cache()
    assert three.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in three.collect()) == sorted(str(r["doc_id"]) for r in two.collect() if r["doc_id"] != 10)

    four = stages["mixing"](spark, three, folder).cache()
    assert four.columns == docs.columns
    copies = collections.Counter(r["text"] for r in four.collect())
    assert set(copies) <= {r["text"] for r in three.collect()} and max(copies.values()) <= 2

    five = stages["sharding"](spark, four, folder).collect()
    assert collections.Counter(r["text"] for r in five) == copies and {r["shard"] for r in five} <= set(range(40))
    again = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter(r["text"] for r in again) == copies


@pytest.mark.parametrize("name", ["quality rules", "near duplicates", "decontamination", "mixing", "sharding"])
def test_stages_keep_repeated_and_null_rows_apart(spark, folder, name):
    """Each stage by itself on rows that all pass the others: repeated rows, null ids, null texts."""
    import corpus_pipeline

    rows = [(None, None, None, None)] * 3 + [(5, prose(5), None, "a")] * 4 + [(None, prose(6), "en", None)] * 2 + [(6, "", "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.lit(0).cast("long"))
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder).collect()
    n = collections.Counter(r["text"] for r in out)
    if name == "quality rules":
        assert n == {prose(5): 4, prose(6): 2}
    elif name == "near duplicates":  # null and empty texts share the fingerprint 0: one of them stays, the one with an id
        assert n == {prose(5): 1, prose(6): 1, "": 1}
    elif name in ("decontamination", "sharding"):
        assert n == {None: 3, prose(5): 4, prose(6): 2, "": 1}
    else:
        assert set(n) <= {prose(5), prose(6)} and all(k <= 8 for k in n.values())


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    awkward(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "sharding" or out.columns == docs.columns)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
