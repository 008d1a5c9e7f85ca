import collections
import math
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from tidewater.llm.common import stored  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def store(spark):
    return lambda df: stored(spark, df, "test")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def oracle(name):
    from tidewater.llm.queries import ORACLES

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = con.execute(ORACLES[name])
    return [c[0] for c in got.description], got.fetchall()


@pytest.mark.parametrize("name", ["op7_quality_quantiles", "op9_decontamination", "op10_warc_zip"])
def test_query_equals_its_sql(spark, name):
    from tidewater.llm.queries import QUERIES

    columns, expected = oracle(name)
    assert rows(QUERIES[name](spark, SMALL), *columns) == sorted(expected, key=str)


# --- quality -------------------------------------------------------------------------------------

def test_quality_counts_and_verdict(spark, store):
    from tidewater.llm.quality import quality_rules

    df = brute.messy(spark)
    out = quality_rules(df, store=store).collect()
    assert len(out) == df.count()
    for r in out:
        n, chars, symbols, dup, repeat = brute.quality_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert not (r["base_failed"] and r["kept"])
        assert r["H"] == "own H" and r["size"] == "own size"
    assert quality_rules(brute.empty(spark), store=store).count() == 0


def test_quality_buckets_keep_order_and_merge(spark):
    from tidewater.llm.quality import bucket, bucket_value

    values = [*range(300), 1023, 1024, 10**6, 10**12, 2**62]
    got = spark.createDataFrame([(v,) for v in values], "v long").select(
        "v", bucket(F.col("v")).alias("b"), bucket_value(bucket(F.col("v"))).alias("low")).orderBy("v").collect()
    assert [r["b"] for r in got] == sorted(r["b"] for r in got)
    assert all(r["low"] <= r["v"] and r["v"] - r["low"] <= r["v"] / 32 for r in got)
    assert all(r["low"] == r["v"] for r in got if r["v"] < 64)


def test_quality_rejects_outliers_and_keeps_equals(spark, store):
    from tidewater.llm.quality import quality_rules

    rng = random.Random(3)
    text = lambda extra: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) for _ in range(80)) + extra
    data = [(i, text(""), "xx", "s") for i in range(150)] + [(1000, text(" # $ % & |" * 40), "xx", "s")]
    out = quality_rules(spark.createDataFrame(data, "doc_id long, text string, lang string, source string"), store=store)
    assert {r["doc_id"] for r in out.filter("NOT kept").collect()} == {1000}


# --- shards --------------------------------------------------------------------------------------

@pytest.mark.parametrize("n,ranges,split", [(300, 8, 4), (7, 64, 8)])
def test_minimax_capacity_is_the_smallest(spark, n, ranges, split):
    from tidewater.llm.shards import minimax_cuts

    rng = random.Random(n)
    groups = sorted({(rng.randint(-(1 << 63), (1 << 63) - 1), rng.choice([16, 17, 400, rng.randint(16, 3000)])) for _ in range(n)})
    df = spark.createDataFrame(groups, "h long, bytes long").cache()
    cuts, capacity = minimax_cuts(df, 12, ranges, split)
    assert capacity == brute.minimax([b for _, b in groups], 12)
    held = collections.Counter()
    for h, b in groups:
        held[sum(c <= h for c in cuts)] += b
    assert max(held.values()) == capacity and len(held) <= 12


def test_minimax_with_many_open_ranges(spark):
    from tidewater.llm.shards import minimax_cuts

    rng = random.Random(9)
    groups = sorted({(rng.randint(-(1 << 63), (1 << 63) - 1), rng.randint(16, 3000)) for _ in range(4000)})
    cuts, capacity = minimax_cuts(spark.createDataFrame(groups, "h long, bytes long").cache(), 200, 256, 4)
    assert capacity == brute.minimax([b for _, b in groups], 200)
    held = collections.Counter()
    for h, b in groups:
        held[sum(c <= h for c in cuts)] += b
    assert max(held.values()) == capacity and len(held) <= 200


@pytest.mark.parametrize("big", [[200_000], [200_000, 40_000, 9_000], [9_000] * 25])
def test_only_an_oversized_group_has_a_large_shard(spark, big):
    from tidewater.llm.shards import minimax_cuts

    rng = random.Random(4)
    sizes = [*big, *[rng.randint(16, 400) for _ in range(2000)]]
    groups = sorted((rng.randint(-(1 << 63), (1 << 63) - 1), b) for b in sizes)
    cuts, capacity = minimax_cuts(spark.createDataFrame(groups, "h long, bytes long").cache(), 40, 64, 8)
    assert capacity == brute.minimax([b for _, b in groups], 40) and len(cuts) <= 39
    held = collections.Counter()
    for h, b in groups:
        held[sum(c <= h for c in cuts)] += b
    assert max(held.values()) == capacity
    if len(big) < 4:
        small = [v for v in held.values() if v not in big]
        assert len(held) >= 38 and max(small) <= 1.25 * sum(small) / (40 - len(big))


def check_shards(out, source):
    assert len(out) == source.count()
    slots, shard_of = collections.defaultdict(list), collections.defaultdict(set)
    for r in out:
        data = (r["text"] or "").encode()
        assert r["size"] == len(data) + 16 and r["text_crc32"] == zlib.crc32(data) and 0 <= r["shard"] < 40
        slots[r["shard"]].append(r["slot"])
        shard_of[r["text"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())


def test_shards_of_documents_and_of_messy_rows(spark, store, docs):
    from tidewater.llm import shards

    out = shards.minimax_shards(spark, docs, store, keep_text=True).collect()
    check_shards(out, docs)
    got = collections.Counter()
    for r in out:
        got[r["shard"]] += r["size"]
    groups = docs.groupBy(F.xxhash64("text", F.col("text").isNull()).alias("h")).agg(
        F.sum(shards.text_size(F.col("text"))).alias("b")).orderBy("h").collect()
    assert max(got.values()) == brute.minimax([r["b"] for r in groups], 40)
    df = brute.messy(spark)
    out = shards.minimax_shards(spark, df, store, keep_text=True)
    assert out.columns.count("shard") == 1 and "H" in out.columns
    check_shards(out.collect(), df)
    assert shards.minimax_shards(spark, brute.empty(spark), store).count() == 0


def test_copies_of_one_text_are_numbered_in_parts(spark, store):
    from tidewater.llm import shards

    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, F.lit("copy")).otherwise(
        F.concat(F.lit("text "), F.col("id"))).alias("text"))
    check_shards(shards.minimax_shards(spark, df, store, keep_text=True).collect(), df)


# --- SimHash -------------------------------------------------------------------------------------

def test_golay_keys_miss_no_link():
    from tidewater.llm.simhash import Golay, fuzzy_keys

    golay, rng = Golay(), np.random.default_rng(1)
    assert np.bincount((golay.errors >= 0).sum(1)).tolist() == [0, 277, 0, 0, 0, 0, 1771]
    a = rng.integers(-(1 << 63), (1 << 63) - 1, 4000)
    flips = np.zeros(4000, np.uint64)
    for i in range(4000):
        for k in rng.choice(64, rng.integers(0, 5), replace=False):
            flips[i] |= np.uint64(1) << np.uint64(k)
    ka, oa = fuzzy_keys(a, golay)
    kb, ob = fuzzy_keys((a.view(np.uint64) ^ flips).view(np.int64), golay)
    shared = set(zip(oa.tolist(), ka.tolist())) & set(zip(ob.tolist(), kb.tolist()))
    assert {o for o, _ in shared} == set(range(4000))
    assert len(set(zip(oa.tolist(), ka.tolist()))) == len(ka)


def test_bucket_links_span_the_links():
    from tidewater.llm.simhash import bucket_links

    rng = np.random.default_rng(2)
    keys, fps = np.sort(rng.integers(0, 20, 600)), rng.integers(0, 256, 600)
    i, j = bucket_links(keys, fps, 1)
    links = [(a, b) for a in range(600) for b in range(a + 1, 600)
             if keys[a] == keys[b] and int(fps[a] ^ fps[b]).bit_count() <= 1]
    assert brute.components(600, links) == brute.components(600, zip(i.tolist(), j.tolist()))
    assert len(i) < 600


def check_components(out, data):
    """data: (id, text) rows; out: rows with fp and component_id."""
    fps = [brute.simhash(t) for _, t in data]
    links = [(a, b) for a in range(len(data)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    root = brute.components(len(data), links)
    least = {}
    for (key, _), r in zip(data, root):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    expected = sorted(((key, fp, least.get(r)) for (key, _), fp, r in zip(data, fps, root)), key=str)
    assert sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in out), key=str) == expected


def test_simhash_components_equal_brute_force(spark, store, docs):
    from tidewater.llm.simhash import one_of_each, simhash_components

    data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = simhash_components(spark, docs, store).cache()
    check_components(found.collect(), data)
    kept = one_of_each(found, docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["component_id"] for r in found.collect()}
    df = brute.messy(spark)
    data = [tuple(r) for r in df.select("doc_id", "text").collect()]
    found = simhash_components(spark, df, store).cache()
    check_components(found.collect(), data)
    assert one_of_each(found, df).count() == found.select("root").distinct().count()
    assert simhash_components(spark, brute.empty(spark), store).count() == 0


def test_components_of_a_chain_and_a_star(spark, store):
    from tidewater.llm.simhash import components

    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 3)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), store).collect()}
    assert all(out[i] == 0 for i in range(1, 41)) and all(out[i] == 100 for i in range(101, 160)) and 200 not in out


# --- decontamination -------------------------------------------------------------------------------

def items(spark):
    return spark.createDataFrame(
        [(1, brute.PASSAGE), (2, "Nine, TEN; eleven"), (3, None), (4, ""), (5, brute.PASSAGE + " fifteen"), (None, "another text"),
         (6, brute.PASSAGE), (10, "absent " * 12), (7, "word1 und1 " * 6), (8, "fox jumps over the lazy dog the quick brown fox jumps over")],
        "item_id long, text string")


@pytest.mark.parametrize("block_chars", [4 << 20, 40])
def test_decontamination_equals_brute_force(spark, store, monkeypatch, block_chars):
    from tidewater.llm import decontam

    monkeypatch.setattr(decontam, "BLOCK_CHARS", block_chars)  # small: the index is built block by block
    df, bench = brute.messy(spark), items(spark)
    known = [tuple(r) for r in bench.collect()]
    out = decontam.decontaminate(spark, df, bench, store).collect()
    expected = []
    for r in df.collect():
        n, hit, ids = brute.contamination(r["text"], known)
        expected.append((r["doc_id"], n, hit, [i for i in ids if i != "None"]))
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in out), key=str) == sorted(expected, key=str)


def test_decontamination_of_empty_tables(spark, store):
    from tidewater.llm.decontam import decontaminate

    assert decontaminate(spark, brute.empty(spark), items(spark), store).count() == 0
    out = decontaminate(spark, brute.messy(spark), items(spark).limit(0), store)
    assert out.filter("contaminated").count() == 0 and out.count() == brute.messy(spark).count()


def test_anchors_of_one_term_are_broadcast_in_parts(spark, monkeypatch):
    from tidewater.llm import decontam as d

    monkeypatch.setattr(d, "BLOCK_CHARS", 2000)
    side = F.array(F.repeat(F.lit("long"), 25))
    anchor = spark.range(200).select(F.col("id").cast("string").alias("item"), F.lit("hot").alias("term"), F.lit(3).alias("off"),
                                     side.alias("before"), side.alias("after"))
    parts = [b.count() for b in d.anchor_blocks(anchor)]
    assert sum(parts) == 200 and max(parts) * 210 < 3 * 2000


def test_clean_rows_and_proximity(spark, store):
    from tidewater.llm import decontam as d

    df = spark.createDataFrame([(1, f"a {brute.PASSAGE} b"), (2, "nothing of it"), (2, "nothing of it"),
                                (3, brute.PASSAGE.replace("five", "five extra"))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, brute.PASSAGE)], "item_id long, text string")
    found = d.decontaminate(spark, df, bench, store)
    assert [r["doc_id"] for r in d.clean_rows(found, df, store).orderBy("doc_id").collect()] == [2, 2, 3]
    words = bench.select(F.lit("i").alias("item"), d.item_words(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    docs = df.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("h"), d.item_words(F.col("text")).alias("words"))
    freq = docs.select(F.explode("words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    anchor = d.anchors(words, freq)
    index = d.postings(docs, anchor.select("term").distinct(), store)
    assert {r["doc"] for r in d.proximity_matches(index, anchor, slop=3).collect()} == {1, 3}


def test_near_items_are_returned(spark, store):
    from tidewater.llm import decontam as d

    words = [f"w{i}" for i in range(40)]
    spread = " ".join(w + " between" * (i % 9 == 8) for i, w in enumerate(words))  # no ten words in a row
    df = spark.createDataFrame([(1, " ".join(words)), (2, spread), (3, "nothing of it"), (4, " far ".join(words[::9]))],
                               "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    out = {r["doc_id"]: r for r in d.decontaminate(spark, df, bench, store, slop=3).collect()}
    assert [out[i]["contaminated"] for i in (1, 2, 3, 4)] == [True, False, False, False]
    assert [out[i]["near_ids"] for i in (1, 2, 3, 4)] == [["7"], ["7"], [], []] and out[2]["n_near"] == 1


@pytest.mark.parametrize("gap,found", [(0, True), (3, True), (4, False), (5, False), (7, False)])
def test_proximity_is_within_the_slop(spark, gap, found):
    from tidewater.llm import decontam as d

    index = spark.createDataFrame([("a", 1, 9, 0), ("b", 1, 9, 1 + gap)], "term string, doc long, h long, pos int")
    anchor = spark.createDataFrame([("i", "a", 0, ["b"], ["b"]), ("i", "b", 1, ["a"], ["a"]), ("i", "a", 2, ["b"], ["b"])],
                                   "item string, term string, off int, before array<string>, after array<string>").filter("off < 2")
    got = d.proximity_matches(index, anchor, slop=3).collect()
    assert [(r["lo"], r["hi"], r["terms"]) for r in got] == [(0, 1 + gap, 2)] * found


# --- mixing ----------------------------------------------------------------------------------------

def check_mix(out, data):
    sizes = collections.Counter({s: 0 for _, _, s in data})
    for _, t, s in data:
        sizes[s] += len(brute.WORD.findall(t or ""))
    goal = brute.targets(dict(sizes))
    assert len(out) == len(data)
    taken = collections.Counter()
    for r in out:
        got = sum(c["words"] for c in r["copies"])
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], goal[r["source"]], abs_tol=1e-6)
        assert r["size"] == len(brute.WORD.findall(r["text"] or "")) and 0 <= got <= 2 * r["size"]
        assert all(0 <= c["shard"] < 16 for c in r["copies"])
        taken[r["source"]] += got
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)


def test_mix_meets_targets(spark, store, docs):
    from tidewater.llm.mixing import mix

    for df in (docs, brute.messy(spark)):
        out = mix(df, store, block_words=64)
        data = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
        check_mix(out.collect(), data)
        assert out.columns.count("size") == 1
        again = mix(df, store, block_words=64)
        assert rows(out, "doc_id", "source", "size", "copies") == rows(again, "doc_id", "source", "size", "copies")
    assert mix(brute.empty(spark), store).count() == 0


def test_mix_of_whole_copies(spark, store, docs):
    from tidewater.llm import mixing

    for r in mixing.mix(docs, store, whole=True).collect():
        assert all(c["words"] == r["size"] for c in r["copies"])


def test_tree_deals_every_block_once(spark):
    from tidewater.llm.mixing import deal_quotas, primes_from

    quotas = spark.createDataFrame([("a", False, 1000), ("b", False, 37), ("", True, 0)], "src string, no_src boolean, blocks long")
    for shards in (1, 5, 16):
        out = deal_quotas(quotas, shards).collect()
        per_source, per_shard = collections.Counter(), collections.Counter()
        for r in out:
            assert r["blocks"] >= 0
            per_source[r["src"]] += r["blocks"]
            per_shard[r["first"]] += r["blocks"]
        assert per_source == {"a": 1000, "b": 37, "": 0} and len(per_shard) == shards
        assert max(per_shard.values()) - min(per_shard.values()) <= shards.bit_length()
    assert primes_from(10, 3) == [11, 13, 17]


# --- token counts ----------------------------------------------------------------------------------

def test_head_of_the_vocabulary_is_bounded(spark):
    from tidewater.llm.token_counts import cut_off

    rng = random.Random(1)
    for counts in ([rng.choice([1, 1, 1, 2, 3, 70, 71, 5000, 10**9, 10**15]) for _ in range(500)], [7] * 50, list(range(1, 400)), []):
        vocab = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate(counts)], "pretoken string, n long")
        for head in (0, 1, 49, 50, 300, 10_000):
            least = cut_off(vocab, head)
            taken = [n for n in counts if n >= least]
            assert len(taken) <= head  # the most frequent ones, as many steps of the histogram as fit
            if head >= len(counts):
                assert len(taken) == len(counts)
    low = [n for n in range(1, 64) for _ in range(3)]  # exact steps: the next frequency would be too many
    least = cut_off(spark.createDataFrame([(f"w{i}", n) for i, n in enumerate(low)], "pretoken string, n long"), 100)
    assert sum(n >= least for n in low) == 99


@pytest.mark.parametrize("head", [0, 1 << 17])
def test_token_counts_equal_the_library(spark, store, docs, head):
    import sentencepiece

    from tidewater.llm.token_counts import count_tokens, model_path

    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    named = brute.messy(spark).withColumn("doc_id", F.concat(F.lit("d-"), F.col("doc_id").cast("string")))
    for df in (docs, brute.messy(spark), named):  # ids of any type
        out = count_tokens(spark, df, store, model_path(), limit=100, head=head)
        expected = []
        for r in df.collect():
            n = len(model.encode(r["text"] or ""))
            expected.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 100))
        assert rows(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=str)
    assert count_tokens(spark, brute.empty(spark), store, model_path()).count() == 0


def test_pretokens_of_random_texts_add_up():
    from tidewater.llm.token_counts import Counts, model_path, pretokens

    counts, rng = Counts(model_path()), random.Random(5)
    parts = ["a", " ", "  ", "\n", "▁", "é", "日", "\t", "\x00", "the ", "<s>", "\xa0", "👍", "\r\n", "1", ".", "x" * 30]
    for _ in range(500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 20)))
        assert sum(counts.of(pretokens(text))) == len(counts.model.encode(text)), repr(text)


# --- language ----------------------------------------------------------------------------------------

def test_language_on_held_out_documents(spark):
    from tidewater.llm.queries import QUERIES

    out = QUERIES["op1_lang_id"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id")
    got = out.filter("held_out").select("lang_pred", "lang", "score").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_messy_rows(spark, docs):
    from tidewater.llm.lang_id import identify_language

    df = brute.messy(spark)
    out = identify_language(df, df).collect()
    assert len(out) == df.count()
    for r in out:
        none = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == none and (r["score"] == 0) == none
    assert identify_language(brute.empty(spark), df).count() == 0
    assert {r["lang_pred"] for r in identify_language(df, brute.empty(spark)).collect()} == {"und"}


def test_every_label_is_learned(spark):
    from tidewater.llm.lang_id import identify_language, training_pieces

    # 64 languages with 9 documents each, 2 rarer ones with letters of their own
    data = [(100 * k + i, " ".join([chr(0x4E00 + 16 * k) * 3, chr(0x4E00 + 16 * k + 5) * 2] * 20), f"l{k:02}") for k in range(64) for i in range(9)]
    data += [(9000 + i, "ელენე და გია " * 20, "rare1") for i in range(8)] + [(9100 + i, "שלום עולם " * 20, "rare2") for i in range(8)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    assert set(training_pieces(df, "text", "lang")["lang"]) == {x[2] for x in data}
    out = identify_language(df.drop("lang"), df).filter("doc_id >= 9000").collect()
    assert all(r["lang_pred"] == ("rare1" if r["doc_id"] < 9100 else "rare2") for r in out)


def test_language_sample_rests_on_texts_alone(spark):
    from tidewater.llm.lang_id import identify_language, training_pieces

    data = [(f"{w} " * (20 + k), lang) for k in range(300) for w, lang in (("house", "en"), ("größe", "de"))]
    one, none = ([(i, *x) for x in data] * 5 for i in (7, None))
    schema = "doc_id long, text string, lang string"
    samples = [training_pieces(spark.createDataFrame(rows, schema).repartition(n), "text", "lang", per_lang=100)
               for rows, n in ((one, 2), (none, 5), ([(i, *x) for i, x in enumerate(data)], 3))]
    assert samples[0].equals(samples[1]) and samples[0].equals(samples[2])
    assert all(60 <= n <= 3 * 140 for n in samples[0]["lang"].value_counts())
    df = spark.createDataFrame(none, schema)
    assert all(r["lang_pred"] == r["lang"] for r in identify_language(df, df).distinct().collect())


def test_language_of_whole_texts_equals_plain_scoring(spark, docs):
    """Each window by a plain convolution, pooled, and the windows' probabilities by their bytes."""
    from tidewater.llm.lang_id import STRIDE, WIDTHS, WINDOW, byte_classes, fit, identify_language, softmax, training_pieces

    df = docs.union(brute.messy(spark, extra=False).withColumn("n_chars", F.lit(0)).select(docs.columns))
    net, classes = fit(training_pieces(docs, "text", "lang")), byte_classes()
    got = {r["text"]: r for r in identify_language(df, docs).collect()}
    few = sorted((t for t in got if t), key=lambda t: (len(t) > 3000, len(t)))
    for text in few[:25] + few[-3:]:
        raw = classes[np.frombuffer(text.encode(), np.uint8)]
        total = np.zeros(len(net.langs))
        at = 0
        while True:
            x = np.zeros(WINDOW, np.uint8)
            x[:len(raw[at:at + WINDOW])] = raw[at:at + WINDOW]
            pooled, _ = net.pooled(x[None])
            total += softmax(np.maximum(pooled, 0) @ net.out + net.bias)[0] * len(raw[at:at + WINDOW])
            at += STRIDE
            if at + max(WIDTHS) - 1 >= len(raw):
                break
        if any(c.isalpha() for c in text):
            assert got[text]["lang_pred"] == net.langs[int(total.argmax())]
            assert got[text]["score"] == pytest.approx(total.max() / total.sum(), abs=1e-4)


def test_pair_tables_score_like_the_network():
    from tidewater.llm.lang_id import Network, softmax, windows_of, byte_classes

    rng = np.random.default_rng(0)
    net = Network(["a", "b", "c"], rng)
    x, weight = windows_of("Grüße an ALLE 123 " * 60, byte_classes())
    pooled, _ = net.pooled(x)
    assert np.allclose(net.scorer()(x), softmax(np.maximum(pooled, 0) @ net.out + net.bias), atol=1e-5)
    assert weight.sum() == len(("Grüße an ALLE 123 " * 60).encode())


# --- toxicity ------------------------------------------------------------------------------------------

def test_marginals_equal_enumeration():
    import itertools

    from tidewater.llm.toxicity import Field

    rng, field = np.random.default_rng(4), Field()
    field.step = rng.normal(size=(2, 2))
    odds, lengths = rng.normal(size=(3, 64)), np.array([5, 1, 3])
    p, pairs = field.marginals(odds, lengths, pairs=True)
    expected = np.zeros((2, 2))
    for row, n in enumerate(lengths):
        weight, on, trans = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            s = np.exp(sum(odds[row, k] for k in range(n) if y[k]) + sum(field.step[y[k], y[k + 1]] for k in range(n - 1)))
            weight += s
            on += s * np.array(y)
            for k in range(n - 1):
                trans[y[k], y[k + 1]] += s
        assert np.allclose(p[row, :n], on / weight)
        expected += trans / weight
    assert np.allclose(pairs, expected)


def plain_marginals(field, words):
    """Forward-backward over one line, word by word."""
    t = np.exp(field.step)
    e = [np.array([1.0, np.exp(np.clip(x, -30, 30))]) for x in field.emissions([w.lower() for w in words])]
    forward, backward = [e[0]], [np.ones(2)]
    for x in e[1:]:
        a = (forward[-1] @ t) * x
        forward.append(a / a.sum())
    for x in reversed(e[1:]):
        b = t @ (x * backward[0])
        backward.insert(0, b / b.sum())
    return [float((f * b)[1] / (f * b).sum()) for f, b in zip(forward, backward)]


def trained_field(seed=8):
    from tidewater.llm.toxicity import Field

    rng, field = np.random.default_rng(seed), Field()
    field.weight = rng.normal(size=field.weight.shape) * 2
    field.bias, field.step = -0.5, rng.normal(size=(2, 2))
    field.base = 0.5
    return field


def test_lines_are_whole_chains():
    rng, field = random.Random(2), trained_field()
    lines = [" ".join(rng.choices(["alpha", "Beta", "GAMMA", "dİlta", "eps", "ß"], k=k)) for k in (1, 64, 65, 128, 200, 700, 0, 3)]
    for texts in (["\n".join(lines)], lines, ["\n\n".join(lines * 3), "", "one word"]):
        for (p, text), given in zip(field.score_words(texts), texts, strict=True):
            words = [re.findall(r"[^\W\d_]+", line) for line in given.split("\n")]
            expected = [x for line in words if line for x in plain_marginals(field, line)]
            assert text == given and np.allclose(p, expected, atol=1e-9)


def test_toxic_spans_equal_brute_force(spark):
    from tidewater.llm.toxicity import spans_of

    rng, field = random.Random(3), trained_field(9)
    vocabulary = ["İstanbul", "good", "idiot", "end", "ẞtraße", "ǆ", "x9y", "1", "--", "日本"]
    texts = ["İstanbul good idiot end", "", "\n\n", *("\n".join(" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 90, 300])))
                                                       for _ in range(6)) for _ in range(20))]
    some = 0
    for p, text in field.score_words(texts):
        expected, base = [], 0
        for line in text.split("\n"):
            found = list(re.finditer(r"[^\W\d_]+", line))
            marks = [x > 0.5 for x in plain_marginals(field, [m.group() for m in found])] if found else []
            k = 0
            while k < len(marks):
                j = k
                while j < len(marks) and marks[j] == marks[k]:
                    j += 1
                if marks[k]:
                    expected.append((base + found[k].start(), base + found[j - 1].end()))
                k = j
            base += len(line) + 1
        got = spans_of(text, p)
        assert [(s["start"], s["end"]) for s in got] == expected and all(0.5 < s["p"] <= 1 for s in got)
        some += len(got)
    assert some > 50


def test_toxicity_sample_is_bounded_and_repeatable(spark):
    from tidewater.llm.toxicity import training_texts

    docs = spark.createDataFrame([(i % 50, f"text {i % 70}") for i in range(2000)] + [(None, "x"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 50, i % 2) for i in range(500)] + [(None, 1), (4, None), (5, 7)], "doc_id long, toxic int")
    a, b = (training_texts(docs.repartition(n), labels.repartition(n), "text", "toxic", "doc_id", per_class=10) for n in (2, 7))
    assert a.equals(b) and len(a) == 20 and a["id"].is_unique and sorted(a["label"]) == [0] * 10 + [1] * 10


def test_toxicity_held_out_and_spans(spark):
    from tidewater.llm.toxicity import score_toxicity

    sf = "/root/testdata/sf0.01"
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = score_toxicity(docs, docs, labels.filter(~held)).join(labels, "doc_id").filter(held).collect()
    got = [(r["predicted"], r["toxic"]) for r in out]
    assert np.mean([a == b for a, b in got]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    for r in out:
        assert all(re.match(r"[^\W\d_]", r["text"][s["start"]:s["end"]]) for s in r["toxic_spans"])


def test_toxicity_of_messy_rows(spark):
    from tidewater.llm.toxicity import score_toxicity

    df = brute.messy(spark)
    labels = spark.createDataFrame([(1, 0), (7, 1), (10, 1), (2, 0), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    out = score_toxicity(df, df, labels).collect()
    assert len(out) == df.count() and all(0 <= r["score"] <= 1 for r in out)
    assert score_toxicity(brute.empty(spark), df, labels).count() == 0
    assert {r["score"] for r in score_toxicity(df, df, labels.limit(0)).collect()} == {0.0}


# --- html ----------------------------------------------------------------------------------------------

PAGE = """<html><head><title>T &amp; x</title></head><body><div class="cookie-notice">We use cookies</div><header><h1>Site</h1></header>
<div id="sidebar"><p>side</div><main><article class="post"><header><h1>Head&nbsp;line</h1></header><p>One<br>two &lt;b&gt; &eacute;&copy<p>Three <b>bold</b>
 x<ul><li>a<li>b</ul><div class="ad-box">Buy</div><aside>note</aside><form><p>mail</form><blockquote>q1</blockquote>tail<table><tr><td>c1<td>c2</table></article>
<section class="comments"><article class="comment"><p>nice</p></article></section></main><footer>f</footer><script>if (a<b) x("</p>")</script></body></html>"""


def test_main_text_of_a_page():
    from tidewater.llm.html_text import main_text

    assert main_text(PAGE).split("\n") == ["Head line", "One two <b> é©", "Three bold x", "a", "b", "q1", "tail", "c1", "c2"]
    assert main_text(None) == main_text("") == main_text("<div>") == ""
    assert main_text("plain <b>text</b> &amp; more") == "plain text & more"
    assert main_text('<div class="ad">x<article><p>y</article>') == "y"  # an advert that never ends
    assert main_text("<div>" * 5000 + "deep") == "deep"


def test_site_templates_go_but_copies_stay(spark, store):
    from tidewater.llm.html_text import extract_main_text

    page = lambda i: f"<body><div><p>Read us daily</p><p>Call now</p></div><div><h1>Title {i}</h1><p>Body {i} text</p></div></body>"
    data = [(i, "http://Host.example/x", page(i)) for i in range(12)]
    data += [(100 + i, "http://copy.example/", page(5)) for i in range(20)]  # copies of one article are no template
    data += [(200, None, None), (201, "no host", "")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("text", F.lit("own")).withColumn("host", F.lit("own"))
    out = {r["page_id"]: r["text"] for r in extract_main_text(df, store).collect()}
    assert len(out) == len(data) and out[3] == "Title 3\nBody 3 text"
    assert out[100] == "Read us daily\nCall now\nTitle 5\nBody 5 text" and out[200] == out[201] == ""
    assert extract_main_text(df.limit(0), store).count() == 0


def test_names_inside_articles_must_be_whole_words():
    from tidewater.llm.html_text import main_text

    kept = ('<section class="related-work"><p>Earlier studies.</p></section><div id="share-prices">Prices rose.</div>'
            '<div class="login-tutorial">How to log in.</div><div class="wide notice-period">Two weeks.</div>')
    gone = ('<div class="ad">Buy</div><div class="wide comments"><p>First!</p></div><div id="comment-list">x</div>'
            '<aside>See</aside><div class="share">f</div><form>q</form>')
    assert main_text(f"<article><h1>T</h1>{kept}{gone}</article>") == "T\nEarlier studies.\nPrices rose.\nHow to log in.\nTwo weeks."
    assert main_text(f"<body><p>T</p>{kept}{gone}</body>") == "T"  # outside of articles a listed word is enough


def test_template_of_a_large_host_needs_no_half_of_it(spark, store):
    """Boxes on 10 of 200 articles go, sentences on 30 of them stay, in articles and outside of them."""
    from tidewater.llm.html_text import extract_main_text

    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijk", k=6))
    rows, expected = [], {}
    for i in range(200):
        own = [" ".join(word() for _ in range(40)) + "." for _ in range(3)]
        said = "A sentence that many articles have." if i % 7 == 0 else f"Another one, {word()}."
        box = f"<div class=x{i % 20}><div>Read more about topic {i % 20}</div><ul><li>all of it {i % 20}</li></ul></div>"
        body = f"<h1>{word()} {i}</h1>{box}<p>{own[0]}</p><p>{said}</p><p>{own[1]}</p><p>{own[2]}</p>"
        rows.append((i, "https://big.example/a", f"<html><body>{body}</body></html>" if i % 2 else f"<body><article>{body}</article></body>"))
        head = body[4:body.index("</h1>")]
        expected[i] = "\n".join([head, *([] if i % 2 else [f"Read more about topic {i % 20}", f"all of it {i % 20}"]), own[0], said, own[1], own[2]])
    out = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), store).collect()
    assert {r["page_id"]: r["text"] for r in out} == expected


def test_site_templates_equal_a_plain_count(spark, store):
    from tidewater.llm import html_text as H

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url", "html")
    pages = pages.union(spark.createDataFrame([(None, None), ("https://x.example", ""), ("//y.example/1", "<p>a</p>")] * 2, "url string, html string"))
    host = lambda u: (re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", u or "") or ["", ""])[1].lower()
    texts, where = collections.defaultdict(set), collections.defaultdict(list)
    for r in pages.collect():
        root, seen = H.parse(r["html"] or ""), {}
        H.hash_subtrees(root, seen)
        subject = H.subjects(root, H.blocks(root))
        texts[host(r["url"])].add(subject)
        where[host(r["url"])].append((subject, {d: H.strict(e) for d, e in seen.items()}))
    for min_pages, share in ((2, 0.5), (2, 0.05), (1, 0.9)):
        expected = {}
        for h, found in where.items():
            same = [max(collections.Counter(t[k] for t in texts[h]).values()) >= len(texts[h]) * share and len(texts[h]) >= min_pages for k in (0, 1)]
            by = 0 if not same[0] else 2 if same[1] else 1
            articles, on, flags = {t[by] for t in texts[h]}, collections.defaultdict(set), {}
            for subject, seen in found:
                for d, flag in seen.items():
                    on[d].add(subject[by])
                    flags[d] = flag
            if template := sorted(d for d, a in on.items() if len(a) >= min_pages and (not flags[d] or len(a) >= len(articles) * share)):
                expected[h] = template
        got = {r["host"]: r["template"] for r in H.site_templates(pages, store, "url", "html", min_pages, share).collect()}
        assert expected and got == expected


def test_near_copies_that_fill_a_host_keep_their_text(spark, store):
    from tidewater.llm.html_text import extract_main_text

    body = "".join(f"<p>paragraph {k} of the article that all copies share</p>" for k in range(6))
    data = [(i, "http://copies.example/", f"<body><article><h1>Title {i}</h1>{body}<p>Like what you read? Call us</p></article></body>")
            for i in range(30)]
    data += [(100 + i, "http://site.example/", f"<body><article><h1>Title {i}</h1><p>{'own words ' + str(i)} {'text ' * 20}</p>"
                                               "<p>Call us now</p></article></body>") for i in range(30)]
    out = {r["page_id"]: r["text"] for r in extract_main_text(
        spark.createDataFrame(data, "page_id long, url string, html string"), store).collect()}
    assert all(out[i].count("\n") == 7 for i in range(30))  # a near copy loses nothing
    assert all("Call us" not in out[100 + i] and f"own words {i}" in out[100 + i] for i in range(30))


def test_boilerplate_larger_than_the_text_goes(spark, store):
    from tidewater.llm.html_text import extract_main_text

    menu = "".join(f"<li><a href=/{k}>Department number {k} of the house</a></li>" for k in range(40))
    block = "".join(f"<p>Line {k} about the newsletter of this house</p>" for k in range(5))
    data = [(i, "http://item.example/", f"<body><article><h1>Item {i}</h1><p>{f'own words {i} ' * 24}</p><div>{block}</div></article></body>")
            for i in range(30)]
    data += [(100 + i, "http://note.example/", f"<body><div><ul>{menu}</ul></div><div><h1>Note {i}</h1><p>short note {i}</p></div>"
                                               f"<div>{block}</div></body>") for i in range(30)]
    body = "".join(f"<p>paragraph {k} of the article that all copies share</p>" for k in range(6))
    data += [(200 + i, "http://copies.example/", f"<body><div><ul>{menu}</ul></div><div><h1>Title {i}</h1>{body}<p>edited in copy {i}</p></div></body>")
             for i in range(30)]
    out = {r["page_id"]: r["text"] for r in extract_main_text(
        spark.createDataFrame(data, "page_id long, url string, html string"), store).collect()}
    for i in range(30):
        assert out[i] == f"Item {i}\n{f'own words {i} ' * 24}".strip()
        assert out[100 + i] == f"Note {i}\nshort note {i}"
        assert out[200 + i].count("\n") == 7 and "Department" not in out[200 + i]  # near copies keep the article


def test_hosts_with_one_first_heading_have_a_template(spark, store):
    from tidewater.llm.html_text import extract_main_text

    def page(i, title):
        return (f"<html><head><title>{title}</title></head><body><div id=logo><h1>Site</h1></div><div><p>Home and more</p></div>"
                f"<div><h2>Head {i}</h2><p>Body {i} text</p></div><div><p>{'All rights are with the house. ' * 9}</p></div></body></html>")

    data = [(i, "http://logo.example/", page(i, f"Page {i}")) for i in range(12)]
    data += [(100 + i, "http://same.example/", page(i, "Site")) for i in range(12)]
    data += [(200 + i, "http://article.example/", f"<body><h1>Site</h1><main><h1>Head {i}</h1><p>Body {i}</p><div>Buy now</div></main></body>")
             for i in range(12)]
    copy = "".join(f"<p>paragraph {k} of the one article here</p>" for k in range(6))
    data += [(300 + i, "http://edits.example/", f"<title>One</title><body><div><h1>One</h1><div>day {i}</div>{copy}</div></body>") for i in range(12)]
    out = {r["page_id"]: r["text"] for r in extract_main_text(
        spark.createDataFrame(data, "page_id long, url string, html string"), store).collect()}
    for i in range(12):
        assert out[i] == out[100 + i] == f"Head {i}\nBody {i} text"
        assert out[200 + i] == f"Head {i}\nBody {i}"
        assert out[300 + i].count("paragraph") == 6  # near copies with one heading and title


# --- WARC ----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("zip64,package_bytes", [(False, 1 << 25), (True, 200)])
def test_warc_round_trip(spark, store, tmp, zip64, package_bytes):
    import zipfile

    from tidewater.llm.warc import DATA, read_archives, write_archives

    data = [(1, "http://a/", "hello é"), (2, None, "hello é"), (3, "http://b/", None), (4, "x\r\ny", ""), (5, "u", "z" * 300_000),
            (9, "u", "hello é"), (9, "u", "hello é"), (None, "n", "hello é"), (None, "n", "alone")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("payload", F.lit("own")).withColumn("n", F.lit(1))
    manifest = write_archives(spark, df, store, folder=f"file://{tmp}/warc", zip64=zip64, package_bytes=package_bytes)
    got = read_archives(manifest).collect()
    assert len(got) == len(data) == manifest.agg(F.sum("n_records")).first()[0]
    for path in (r["path"] for r in manifest.collect()):
        with zipfile.ZipFile(path.removeprefix("file://")) as z:  # another reader agrees
            assert z.testzip() is None and z.getinfo(DATA).compress_type == 0
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["id"]].append((r["record_type"], r["refers_to"], r["payload_bytes"], r["payload"] and bytes(r["payload"]).decode()))
    assert by_id[1] == by_id[2] == [("revisit", 9, 8, None)] and by_id[9] == [("response", None, 8, "hello é")] * 2
    assert by_id[4] == [("response", None, 0, b"" and "")] or by_id[4][0][:3] == ("response", None, 0)
    assert by_id[3][0][:3] == ("revisit", 4, 0) and by_id[5][0][3] == "z" * 300_000
    assert sorted(by_id[None]) == sorted([("revisit", 9, 8, None), ("response", None, 5, "alone")], key=str) or \
        {x[0] for x in by_id[None]} == {"revisit", "response"}
    assert write_archives(spark, df.limit(0), store).count() == 0


def test_small_payloads_are_all_responses(spark, store):
    from tidewater.llm.warc import read_archives, write_archives

    df = spark.createDataFrame([(1, "a", "xx"), (2, "a", "xx"), (3, "a", "long one"), (4, "a", "long one")],
                               "page_id long, url string, html string")
    got = {r["id"]: r["record_type"] for r in read_archives(write_archives(spark, df, store, min_bytes=5)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


# --- pipeline --------------------------------------------------------------------------------------------

def test_pipeline_stages_equal_brute_force(spark, docs):
    import corpus_pipeline
    from tidewater.llm.quality import quality_rules

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near duplicates", "decontamination", "mixing", "sharding"]
    key = lambda df: sorted((tuple(r) for r in df.select(*docs.columns).collect()), key=str)

    one = stages["quality rules"](spark, docs, SMALL).cache()
    assert key(one) == key(quality_rules(docs).filter("kept"))
    data = [tuple(r) for r in one.select("doc_id", "text").collect()]
    fps = [brute.simhash(t) for _, t in data]
    root = brute.components(len(data), [(a, b) for a in range(len(data)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4])
    least = {}
    for (i, _), r in zip(data, root):
        least[r] = min(i, least.get(r, i))
    two = stages["near duplicates"](spark, one, SMALL).cache()
    assert sorted(r["doc_id"] for r in two.collect()) == sorted(least.values())
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    three = stages["decontamination"](spark, two, SMALL).cache()
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(
        r["doc_id"] for r in two.collect() if not brute.contamination(r["text"], bench)[1])
    four = stages["mixing"](spark, three, SMALL).cache()
    assert four.columns == docs.columns
    copies = collections.Counter(r["doc_id"] for r in four.collect())
    assert set(copies) <= {r["doc_id"] for r in three.collect()} and max(copies.values()) <= 2
    five = stages["sharding"](spark, four, SMALL).collect()
    assert sorted(r["doc_id"] for r in five) == sorted(copies.elements()) and {r["shard"] for r in five} <= set(range(40))
    assert collections.Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()) == copies
