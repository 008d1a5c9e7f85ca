"""Importance resampling, Merkle fingerprints and phrase collocations against plain Python."""

import collections
import hashlib
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


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_target_resampling", "op12_merkle_fingerprints", "op13_collocations"])
def test_query_equals_its_sql(spark, name):
    from tidewater.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = con.execute(ORACLES[name])
    columns = [c[0] for c in got.description]
    out = QUERIES[name](spark, SMALL)
    assert sorted(out.columns) == sorted(columns)
    assert sorted(map(tuple, out.select(*columns).collect()), key=str) == sorted(got.fetchall(), key=str)


# --- importance resampling -----------------------------------------------------------------------

def brute_resample(rows, target, buckets, max_n, percent, least, seed):
    """[(doc_id, n_features, weight, score, rank)] by the definition."""
    def counts(text):
        w = brute.item_words(text)
        grams = [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
        return len(w), collections.Counter(zlib.crc32(g.encode()) % buckets for g in grams)

    own = [(i, *counts(text)) for i, text in rows]
    s, t = collections.Counter(), collections.Counter()
    for _, _, c in own:
        s.update(c)
    for text in target:
        t.update(counts(text)[1])
    big_s, big_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for i, n, c in own:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(k * gain(b) for b, k in c.items())
        out.append([i, c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = {id(r): k for k, r in enumerate(able[:percent * len(able) // 100], 1)}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize("buckets,max_n,percent,least", [(10_000, 1, 10, 20), (97, 3, 50, 1)])
def test_resampling_equals_brute_force(spark, store, docs, buckets, max_n, percent, least):
    from tidewater.llm.target_resampling import resample, resampled_rows

    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    target = [r["text"] for r in bench.collect()]
    awkward = brute.messy(spark)
    for df in (docs, awkward.withColumn("lang", F.lit(1))):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        out = resample(spark, df, bench, store, buckets=buckets, max_n=max_n, percent=percent, least_words=least)
        expected = brute_resample(rows, target, buckets, max_n, percent, least, 2024)
        assert sorted(map(tuple, out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str) == expected
    drawn = resampled_rows(docs, resample(spark, docs, bench, store))
    assert drawn.columns == docs.columns and drawn.count() > 0


def test_resampling_of_ties_and_empty_tables(spark, store):
    from tidewater.llm.target_resampling import resample

    df = spark.createDataFrame([(i, "same words again") for i in range(40)] * 3 + [(None, "same words again")] * 9,
                               "doc_id long, text string")
    bench = spark.createDataFrame([("words",)], "text string")
    out = resample(spark, df, bench, store, percent=100, least_words=3)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 130))
    ordered = out.orderBy("rank").collect()
    assert all(a["score"] >= b["score"] for a, b in zip(ordered, ordered[1:]))
    assert resample(spark, df.limit(0), bench, store).count() == 0
    none = resample(spark, df, bench.limit(0), store, least_words=99)
    assert none.filter("rank IS NOT NULL").count() == 0 and none.count() == 129


def test_slices_of_a_long_text_give_the_same_features():
    from tidewater.llm.target_resampling import features, splitter

    rng = random.Random(5)
    text = "".join(rng.choices("abÉ日xZ -.\n", k=5000))
    for n in (1, 3):
        whole = collections.Counter(x for _, part in features(text, splitter(), n) for x in part)
        for size in (1, 7, 100):
            parts = list(features(text, splitter(), n, size))
            assert collections.Counter(x for _, part in parts for x in part) == whole
            assert sum(k for k, _ in parts) == len(brute.item_words(text))


# --- Merkle fingerprints -------------------------------------------------------------------------

def test_trees_are_lossless_and_cut_by_content():
    from tidewater.llm.merkle import pieces, tree

    rng = random.Random(1)
    texts = ["", "\n", "one", "a. b! c?\n\n d", brute.LONG, "x" * 5000, "日本。" * 400,
             *("".join(rng.choices("ab. \n!é\r", k=300)) for _ in range(50))]
    for text in texts:
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert "".join(p for line in lines for p in pieces(line)) == text
        root = tree(text)
        level = [root]
        for _ in range(3):
            assert sum(n.chars for n in level) == len(text)
            at = 0
            for n in level:
                assert n.start == at
                at += n.chars
            level = [c for n in level for c in n.children]
    assert len({tree(t).hash for t in texts}) == len(set(texts))
    # an insertion in front leaves all later paragraphs as they are
    body = "\n".join(" ".join(rng.choices(["sun", "moon", "star"], k=9)) + f" {i}." for i in range(200))
    old, new = tree(body), tree("A new first line.\n" + body)
    held = {n.hash for s in old.children for n in s.children}
    assert held <= {n.hash for s in new.children for n in s.children}


def plain_likeness(a, b):
    """By leaves alone: characters of the leaves that both texts hold, as multisets."""
    from tidewater.llm.merkle import pieces

    leaves = [collections.Counter(p for line in re.findall(r"[^\n]*\n|[^\n]+", t) for p in pieces(line)) for t in (a, b)]
    return 2 * sum(len(p) * n for p, n in (leaves[0] & leaves[1]).items()) / (len(a) + len(b))


def check_next(rows, out):
    """rows: (doc_id, text) with distinct ids in order; out: by id."""
    from tidewater.llm.merkle import tree

    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = out[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == tree(text).hash and r["edited_fingerprint"] == tree(edited).hash
        for near, other in ((r["near_edited"], edited), (r["near_next"], following)):
            assert 0 <= near <= 1 and (near == 1) == (text == other)
            if text != other:  # going down by branches finds no more than comparing all leaves
                assert near <= plain_likeness(text, other) + 1e-12
        if text == edited:
            assert r["edit_start"] is None and r["edit_end"] is None
        else:  # both texts are the same before the first differing leaf
            assert text[:r["edit_start"] or 0] == edited[:r["edit_start"] or 0] or r["edit_start"] is None
            first = next((j for j, (x, y) in enumerate(zip(text, edited)) if x != y), min(len(text), len(edited)))
            assert r["edit_start"] is None or r["edit_start"] <= first


@pytest.mark.parametrize("range_bytes", [1 << 23, 20_000])
def test_compare_with_next_equals_brute_force(spark, store, docs, range_bytes):
    from tidewater.llm.merkle import compare_with_next

    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    out = compare_with_next(spark, docs.repartition(5), store, range_bytes=range_bytes).collect()
    assert len(out) == len(rows)
    check_next(rows, {r["doc_id"]: r for r in out})
    # half of a text is kept: most edited texts are nearer than the next one
    near = [(r["near_edited"], r["near_next"]) for r in out if r["n_chars"] > 2000]
    assert near and np.mean([a > b for a, b in near]) > 0.9 and np.mean([a for a, _ in near]) > 0.3
    by_text = collections.defaultdict(set)
    for i, text in rows:
        by_text[text or ""].add(next(r["fingerprint"] for r in out if r["doc_id"] == i))
    assert all(len(x) == 1 for x in by_text.values()) and len(set().union(*by_text.values())) == len(by_text)


@pytest.mark.parametrize("range_bytes", [1 << 23, 400])
def test_compare_with_next_on_awkward_rows(spark, store, range_bytes):
    from tidewater.llm.merkle import compare_with_next

    df = brute.messy(spark)
    out = compare_with_next(spark, df, store, range_bytes=range_bytes).collect()
    assert collections.Counter(r["doc_id"] for r in out) == collections.Counter(r["doc_id"] for r in df.collect())
    fox = [r["near_next"] for r in out if r["doc_id"] == 1]
    assert fox == [1.0, 1.0]  # its equal, then the equal text of document 2
    edited = {hashlib.sha256(("" + x).encode()).hexdigest() for x in ("",)}
    assert {r["edited_sha256"] for r in out if r["doc_id"] in (3, 4)} == edited
    assert compare_with_next(spark, brute.empty(spark), store).count() == 0
    one = compare_with_next(spark, df.filter("doc_id = 9"), store, range_bytes=range_bytes).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    names = spark.createDataFrame([("b", "two. texts"), ("a", "one. text"), (None, "x")], "doc_id string, text string")
    by = {r["doc_id"]: r for r in compare_with_next(spark, names, store, range_bytes=1).collect()}
    check_next([("a", "one. text"), ("b", "two. texts"), (None, "x")], by)


def test_compare_locates_edits(spark, store):
    from tidewater.llm.merkle import compare, fingerprints

    rng = random.Random(2)
    base = [" ".join(rng.choices(["sun", "moon", "star", "sea"], k=12)) + f" {i}.\n" for i in range(60)]
    changed = list(base)
    changed[10], changed[40] = "Something else.\n", ""
    old = spark.createDataFrame([(1, "".join(base)), (2, "same"), (3, None), (4, "only here")], "doc_id long, text string")
    new = spark.createDataFrame([(1, "".join(changed)), (2, "same"), (3, ""), (5, "new")], "doc_id long, text string")
    out = compare(old.withColumn("a", F.lit(0)), new).collect()
    assert [r["doc_id"] for r in out] == [1]
    text = "".join(base)
    assert "".join(text[s["start"]:s["end"]] for s in out[0]["old_spans"]) == base[10] + base[40]
    text = "".join(changed)
    assert "".join(text[s["start"]:s["end"]] for s in out[0]["new_spans"]) == changed[10]
    trees = {r["doc_id"]: r for r in fingerprints(old).collect()}
    assert [n["level"] for n in trees[1]["nodes"]].count(2) == 60 and trees[3]["nodes"][0]["chars"] == 0


# --- phrase collocations -------------------------------------------------------------------------

def brute_collocations(rows, max_words, least, top, share):
    """[(lang, rank, phrase, a, l, r, n, score)] by counting every n-gram."""
    f, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = set()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * a >= share * f[lang, w[i:i + m]]:
                    inside.add((lang, w[i:i + m]))
    out = collections.defaultdict(list)
    for (lang, w), a in cand.items():
        if (lang, w) in inside:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(((lang, rank, p.decode(), -a, l, r, total[lang], -s) for lang, found in out.items()
                   for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)), key=str)


@pytest.mark.parametrize("max_words,least,top,share,period", [(5, 3, 50, 100, 16), (3, 2, 2000, 80, 2), (2, 5, 7, 100, 1)])
def test_collocations_equal_brute_force(spark, store, docs, max_words, least, top, share, period):
    from tidewater.llm.collocations import collocations

    for df in (docs.limit(120), brute.messy(spark)):
        rows = [(r["text"], r["lang"]) for r in df.collect()]
        out = collocations(spark, spark.createDataFrame(rows, "text string, lang string").withColumn("n", F.lit("x")),
                           store, max_words=max_words, least=least, top=top, share=share, period=period)
        expected = brute_collocations(rows, max_words, least, top, share)
        assert expected and sorted(map(tuple, out.collect()), key=str) == expected
    assert collocations(spark, brute.empty(spark), store).count() == 0


def test_chunks_cover_each_word_once_and_follow_the_content(spark, store):
    from tidewater.llm.collocations import chunks, dictionary

    rng = random.Random(4)
    vocabulary = ["sun", "moon", "é日", "of", "the", "$$$"]
    text = ". ".join(" ".join(rng.choices(vocabulary, k=rng.randint(1, 80))) for _ in range(40))
    data = np.frombuffer((text + "\n").encode(), np.uint8)
    _, found, own = chunks(data, 4, 8)
    words = [w for piece in text.split(".") for w in piece.split()]
    assert [w for c, k in zip(found.to_pylist(), own) for w in c.split(" ")[:k]] == words
    # the same passage in different surroundings shares its inner chunks
    passage = " ".join(rng.choices(vocabulary, k=300))
    a, b = (set(chunks(np.frombuffer(f"{x} {passage} {x}\n".encode(), np.uint8), 4, 8)[1].to_pylist()) for x in ("left side", "other"))
    assert len(a & b) >= len(a) - 4
    # windows don't change the dictionary, copies are counted in it
    df = spark.createDataFrame([(text, "x"), (text, "x"), (None, "x"), (text.upper(), None)], "text string, lang string")
    small, large = (sorted(map(tuple, dictionary(df, "text", "lang", window=w).collect())) for w in (50, 1 << 21))
    assert small == large and all(r[3] % 2 == 0 for r in small if r[0] == "x")


def test_small_bitmaps_and_slabs_lose_nothing(spark, store, docs):
    from tidewater.llm.collocations import dictionary, frequent_phrases

    words = store(dictionary(docs, "text", "lang"))
    whole = frequent_phrases(spark, words, store, least=20)
    tight = frequent_phrases(spark, words, store, least=20, slab=64, window=5_000, max_bits=64)
    found, more = ({(r["lang"], r["phrase"], r["words"]): r["n"] for r in df.collect()} for df in (whole, tight))
    assert any(k[2] > 1 for k in found) and found.items() <= more.items()
    assert all(k in found for k in more if k[2] > 1)  # small bitmaps let other words through, no other phrase
    parts = {(lang, w) for lang, phrase, n in found if n > 1 for w in phrase.split(" ")}
    assert parts <= {(lang, phrase) for lang, phrase, n in found if n == 1}


def test_scores_pass_64_bits():
    import pyarrow as pa

    from tidewater.llm.collocations import scores

    a, l, r, n = 10**11 + 7, 10**12 + 3, 10**13 + 9, 10**16 + 1
    batch = pa.RecordBatch.from_pydict({"a": [a], "l": [l], "r": [r], "n": [n]})
    assert next(scores(iter([batch]))).column(4).to_pylist() == [1000 * a * n // (l * r)]
