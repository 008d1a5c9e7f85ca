"""Language identification by a byte convolutional network.

Filters of widths 2, 3 and 4 slide over a window of 256 bytes, each is pooled by its maximum,
and a softmax over the pooled values gives the window's languages.  The network is trained
here in numpy on labelled text; a document's whole text is cut into windows (overlapping by 3
bytes, so no 4-gram is lost) that are scored in batches, and the document's probabilities are
the mean over its windows weighted by their bytes.

The first layer works on one-hot bytes, so a filter is a table; for scoring, tables for
byte pairs turn a window position into three look-ups.  Training learns every label that
occurs, from a sample of about ``PER_LANG`` different texts a language and ``PIECES`` pieces of
each (over ``SAMPLE`` texts in all, fewer of each language, but ``LEAST`` at least);
scoring has no limits.  A task holds one Arrow batch and one batch of
windows, however long a text is.

Defined results: a null text, and one without a letter, is ``und`` with score 0; without any
labelled row every text is ``und``; repeated rows give equal rows, and copies are learned from
once; an empty table gives an empty table; labels that are null are not learned from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, need, ship_by_value

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
STRIDE = WINDOW - max(WIDTHS) + 1
#: Bounds of the training sample.
PER_LANG, PIECES, SAMPLE, LEAST = 400, 3, 25_600, 50
EPOCHS, BATCH, RATE, DECAY, SEED = 10, 64, 0.02, 1e-5, 7
#: Windows scored at a time.
SCORED = 256
UNKNOWN = "und"

ship_by_value(__name__)


def byte_classes() -> np.ndarray:
    """A-Z as a-z, digits as one, white space and controls as blank; 0 pads."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    table[ord("0"):ord("9") + 1] = ord("0")
    table[:33] = 32
    return table


def windows_of(text: str, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, WINDOW) bytes of a text, padded with 0, and the new bytes of each window."""
    raw = classes[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    n = max(1, -(-(len(raw) - (WINDOW - STRIDE)) // STRIDE))
    padded = np.zeros((n - 1) * STRIDE + WINDOW, np.uint8)
    padded[:len(raw)] = raw
    cut = np.lib.stride_tricks.as_strided(padded, (n, WINDOW), (STRIDE, 1))
    weight = np.full(n, float(STRIDE))
    weight[-1] = max(1, len(raw) - (n - 1) * STRIDE)
    return cut, weight


class Network:
    """tables[w]: (w, 256, FILTERS), the filters of width w; out: (filters, languages); bias."""

    def __init__(self, langs: list[str], rng: np.random.Generator) -> None:
        self.langs = langs
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), np.float32)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        values, places = [], []
        for table, w in zip(self.tables, WIDTHS, strict=True):
            n = x.shape[1] - w + 1
            c = table[0][x[:, :n]]
            for j in range(1, w):
                c += table[j][x[:, j:j + n]]
            places.append(c.argmax(1))
            values.append(np.take_along_axis(c, places[-1][:, None], 1)[:, 0])
        return np.concatenate([v + s for v, s in zip(values, self.shift, strict=True)], 1), places

    def train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int = EPOCHS) -> None:
        """Adam on the cross-entropy; only the bytes under a filter's maximum get its gradient."""
        params = [*self.tables, *self.shift, self.out, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
                pooled, places = self.pooled(x[at])
                hidden = np.maximum(pooled, 0)
                p = softmax(hidden @ self.out + self.bias)
                p[np.arange(len(at)), y[at]] -= 1
                p /= len(at)
                back = (p @ self.out.T) * (pooled > 0)
                grads: list[np.ndarray] = []
                for k, w in enumerate(WIDTHS):
                    g = np.zeros_like(self.tables[k])
                    part = back[:, k * FILTERS:(k + 1) * FILTERS]
                    for j in range(w):
                        np.add.at(g[j], (np.take_along_axis(x[at], places[k] + j, 1), np.arange(FILTERS)[None, :]), part)
                    grads.append(g)
                grads += [back[:, k * FILTERS:(k + 1) * FILTERS].sum(0) for k in range(len(WIDTHS))]
                grads += [hidden.T @ p, p.sum(0)]
                step += 1
                for v, g, m, s in zip(params, grads, first, second, strict=True):
                    m *= 0.9
                    m += 0.1 * g
                    s *= 0.99
                    s += 0.01 * g * g
                    v -= rate * (m / (1 - 0.9 ** step) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6) + DECAY * v)

    def scorer(self) -> Callable[[np.ndarray], np.ndarray]:
        """Probabilities of (n, WINDOW) windows, by look-ups of byte pairs."""
        two, three, four = self.tables
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        head = np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], 1)
        last, tail = three[2], pair(four[2], four[3])
        shift = np.concatenate(self.shift)

        def run(x: np.ndarray) -> np.ndarray:
            pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
            c = head.take(pairs, axis=0)
            c2 = c[:, :, :FILTERS].max(1)
            c3 = (c[:, :-1, FILTERS:2 * FILTERS] + last.take(x[:, 2:], axis=0)).max(1)
            c4 = (c[:, :-2, 2 * FILTERS:] + tail.take(pairs[:, 2:], axis=0)).max(1)
            return softmax(np.maximum(np.concatenate([c2, c3, c4], 1) + shift, 0) @ self.out + self.bias)

        return run


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(pieces: pd.DataFrame, seed: int = SEED) -> Network | None:
    """A network from labelled pieces (lang, piece); every other one is shortened, so that short
    documents are known too."""
    langs = sorted(pieces["lang"].unique())
    if not langs:
        return None
    rng, classes = np.random.default_rng(seed), byte_classes()
    x = np.zeros((len(pieces), WINDOW), np.uint8)
    for i, piece in enumerate(pieces["piece"]):
        raw = classes[np.frombuffer(piece.encode("utf-8", "replace")[:WINDOW], np.uint8)]
        raw = raw[:rng.integers(16, WINDOW)] if i % 2 else raw
        x[i, :len(raw)] = raw
    y = np.searchsorted(langs, pieces["lang"].to_numpy(str))
    net = Network(langs, rng)
    net.train(x, y, rng)
    return net


def training_pieces(df: DataFrame, text: str, lang: str, per_lang: int = PER_LANG) -> pd.DataFrame:
    """The bounded sample: hashed texts choose about ``per_lang`` different texts of each language.
    Copies count once and ids play no part, so repeated or null ids change nothing."""
    rows = df.filter(F.col(lang).isNotNull() & letters(F.col(text))).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"))
    counts = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    per_lang = min(per_lang, max(LEAST, SAMPLE // max(len(counts), 1)))
    # a row for each label, as the network has an output for each: the texts aren't shuffled to meet it
    shares = df.sparkSession.createDataFrame([(r["lang"], r["n"]) for r in counts], "c_lang string, n long")
    turn = F.pmod(F.xxhash64("h", F.lit("lang")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.join(F.broadcast(shares), F.col("lang") == F.col("c_lang")).filter(turn * F.col("n") < per_lang)
    n = F.char_length("text")
    start = lambda i: (F.pmod(F.xxhash64("h", F.lit(i)), F.greatest(n - WINDOW, F.lit(1))) + 1).cast("int")
    pieces = F.array_distinct(F.array(*[F.substring(F.col("text"), start(i), F.lit(WINDOW)) for i in range(PIECES)]))
    once = chosen.select("lang", "h", pieces.alias("pieces")).dropDuplicates(["lang", "h"])
    found = once.select("lang", "h", F.posexplode("pieces").alias("i", "piece")).toPandas()
    return found.sort_values(["h", "i", "lang", "piece"], kind="stable")[["lang", "piece"]].reset_index(drop=True)


def letters(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def scores_of(net: Network) -> Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]:
    """A pandas UDF body: texts (null for none) to lang_pred and score."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score, classes, langs = net.scorer(), byte_classes(), np.array(net.langs, dtype=object)
        for texts in batches:
            total = np.zeros((len(texts), len(langs)))
            held: list[tuple[int, np.ndarray, np.ndarray]] = []
            size = 0

            def put() -> None:
                x, w = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
                rows = np.repeat([h[0] for h in held], [len(h[1]) for h in held])
                np.add.at(total, rows, score(x) * w[:, None])
                held.clear()

            for i, text in enumerate(texts):
                if text is None:
                    continue
                x, w = windows_of(text, classes)
                for at in range(0, len(x), SCORED):
                    held.append((i, x[at:at + SCORED], w[at:at + SCORED]))
                    size += len(held[-1][1])
                    if size >= SCORED:
                        put()
                        size = 0
            if held:
                put()
            mass = total.sum(1)
            known = mass > 0
            best = total.argmax(1)
            top = np.where(known, total[np.arange(len(total)), best] / np.where(known, mass, 1), 0.0)
            yield pd.DataFrame({"lang_pred": np.where(known, langs[best], UNKNOWN), "score": np.clip(top, 0.0, 1.0)})

    return run


def identify_language(df: DataFrame, labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``df`` with lang_pred and score (earlier columns of these names give way), learned from
    the rows of ``labelled`` with a non-null ``lang``."""
    need(df, text)
    need(labelled, text, lang)
    columns = [c for c in df.columns if c.lower() not in ("lang_pred", "score")]
    net = fit(training_pieces(labelled, text, lang))
    if net is None:
        return df.select(*columns, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    predict = F.pandas_udf(scores_of(net), "lang_pred string, score double")
    (x,) = fresh(df, "x")
    scored = df.withColumn(x, predict(F.when(letters(F.col(text)), F.col(text))))
    return scored.select(*columns, F.col(x)["lang_pred"].alias("lang_pred"), F.col(x)["score"].alias("score"))
