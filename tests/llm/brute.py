"""Plain Python versions of the operators, and the awkward table they are tried on."""

import re

from pyspark.sql import functions as F

WORD = re.compile("[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977} und{i % 13}" for i in range(30_000)) + "\nend"
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def messy(spark, extra=True):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a"),  # a repeated row
        (2, "The quick brown fox jumps over the lazy dog. " * 12, "en", "b"),
        (3, None, "en", "a"), (4, "", None, "b"), (5, "  \n\t \r", "de", None), (6, LONG, "de", "a"),
        (None, "no id at all, but a text " + PASSAGE, "en", "b"), (None, None, None, None),
        (7, f"Start. {PASSAGE.upper()} end", "en", "b"), (7, "the same id, another text", "en", "c"),
        (8, "é" * 40 + " ▁ <s> 日本 \x00 naïve\nline\nline\n line \nline", "fr", "c"), (9, "one", "en", "c"),
        (10, f"noise {PASSAGE} more noise {PASSAGE}", "en", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ["H", "size", "shard", "score", "w", "x", "copies", "fp", "kept", "term", "part", "n_words", "id"]
    return df.withColumns({n: F.lit(f"own {n}") for n in names}) if extra else df


def empty(spark):
    return messy(spark).limit(0)


def components(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def simhash(text):
    import xxhash

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            counts[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(shingles))


def quality_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def item_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(text, items):
    """(n_words, n_hit, sorted item ids) by comparing every window with every position."""
    w, hit, ids = item_words(text), set(), set()
    for item_id, item in items:
        v = item_words(item)
        n = min(10, len(v))
        if not n:
            continue
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                ids.add(str(item_id))
    return len(w), len(hit), sorted(ids)


def minimax(sizes, shards):
    def needed(capacity):
        n, used = 1, 0
        for s in sizes:
            if used + s > capacity:
                n, used = n + 1, 0
            used += s
        return n

    low, high = max([*sizes, -(-sum(sizes) // shards)]), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if needed(mid) <= shards else (mid + 1, high)
    return low


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Hand the excess round by weight until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full, out = sum(sizes.values()) * share, set(), {}
    while True:
        open_ones = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_ones)
        out |= {s: left * weight[s] / total for s in open_ones}
        over = [s for s in open_ones if out[s] > cap * sizes[s]]
        if not over:
            return out
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            full.add(s)
