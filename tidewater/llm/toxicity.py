"""Toxicity by a linear-chain conditional random field over the words of a text.

The field has two states, clean and toxic.  A word's features (the word, its prefixes of 3 to 6
characters and its suffix of 3) are hashed into a weight table; transitions join
neighbouring words of a line.  Forward-backward gives each word's marginal; the toxic spans are
the runs of words over 0.5, with their character offsets, and a logistic calibration of a
document's strongest and summed marginals gives its score.

Labels are of documents, so labelled tokens come first: a feature is toxic if at least
``SEED_SHARE`` of the training documents that hold it are toxic, and so many that among all
features tried such a one is expected less than ``SEED_CHANCE`` times by chance (a binomial
bound); words of toxic documents with a toxic feature are the toxic tokens.
The field and the calibration are fitted in numpy on a sample of at most about ``PER_CLASS``
labelled documents a class, each of at most ``SAMPLE_CHARS`` characters, in pieces of ``PIECE`` words
(training only).  Scoring has no limits: the chain is the whole line.  Its pieces are worked on
side by side; the products of their transfer matrices carry the forward and backward messages
from piece to piece, so that marginals are those of one pass over the line.

Defined results: null and empty texts have no words and get the score that the calibration
gives to no evidence; a null id has no label; copies of a labelled id, or of its label, are learned
from once; without labels of both classes every score is the share of toxic labels (0
without any); repeated rows give equal rows; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, need, ship_by_value

#: Bounds of the training sample.
PER_CLASS, SAMPLE_CHARS = 1500, 20_000
SEED_SHARE, SEED_CHANCE = 0.9, 0.01
BITS, PIECE, EPOCHS, BATCH, RATE, L2, SEED = 18, 64, 6, 256, 0.3, 1e-4, 11
#: Words scored at a time, and words whose log-odds a task keeps.
SCORED, KNOWN = 1 << 16, 1 << 19
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")
SPANS = "array<struct<start:int,end:int,p:double>>"

ship_by_value(__name__)


def features(word: str) -> list[str]:
    """A word's features: itself, prefixes and a suffix; ``word`` is in lower case."""
    n = len(word)
    return [f"w{word}", *[f"p{word[:k]}" for k in range(3, 7) if k < n], *([f"s{word[-3:]}"] if n > 3 else [])]


def slots(word: str) -> list[int]:
    from xxhash import xxh32_intdigest

    return [xxh32_intdigest(f) >> (32 - BITS) for f in features(word)]


class Words:
    """Word -> number, with the log-odds of the words numbered so far."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.odds = np.empty(0)

    def scored(self, field: Field) -> np.ndarray:
        """Log-odds of all words; only new ones are computed.  The last entry is a pad's."""
        new = list(islice(self.number, len(self.odds), None))
        self.odds = np.concatenate([self.odds, field.emissions(new)])
        return np.append(self.odds, 0.0)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' numbers, the places where a piece starts (lines and every PIECE words), and
        the pieces' places in their lines."""
        ids, starts, place = [], [], []
        get = self.number.setdefault
        for line in text.split("\n"):
            found = WORD.findall(line)
            pieces = range(len(ids), len(ids) + len(found), PIECE)
            starts.extend(pieces)
            place.extend(range(len(pieces)))
            ids.extend([get(w.lower(), len(self.number)) for w in found])
        return np.array(ids, np.int64), np.array(starts, np.int64), np.array(place, np.int64)


def pieces_of(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, PIECE) word numbers, -1 beyond a piece's end, and the pieces' lengths."""
    lengths = np.diff(np.append(starts, len(ids)))
    at = starts[:, None] + np.arange(PIECE)[None, :]
    inside = np.arange(PIECE)[None, :] < lengths[:, None]
    return np.where(inside, ids[np.minimum(at, len(ids) - 1)], -1), lengths


class Field:
    """weight: log-odds of toxic by feature slot; bias; step[i, j]: score of state j after i."""

    def __init__(self) -> None:
        self.weight = np.zeros(1 << BITS)
        self.bias = -4.0
        self.step = np.zeros((2, 2))
        self.calibration = np.zeros(4)
        self.base = 0.0

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log-odds of each word by itself."""
        flat = [slots(w) for w in words]
        owner = np.repeat(np.arange(len(flat)), [len(x) for x in flat])
        out = np.full(len(words), self.bias)
        np.add.at(out, owner, self.weight[np.array([s for x in flat for s in x], np.int64)])
        return out

    def messages(self, odds: np.ndarray, lengths: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The forward message into each piece and the backward message out of it (ones at a
        line's ends), from the products of the transfer matrices of a line's pieces, which are
        consecutive rows."""
        n, t = len(odds), np.exp(self.step)
        before, after = np.ones((n, 2)), np.ones((n, 2))
        last = np.append(place[1:] == 0, True)
        rows = np.flatnonzero((place > 0) | ~last)  # of lines with several pieces
        if not len(rows):
            return before, after
        e = np.exp(np.clip(odds[rows], -30, 30))
        m = np.broadcast_to(np.eye(2), (len(rows), 2, 2)).copy()
        for k in range(int(lengths[rows].max())):
            step = (t if k else np.where(place[rows, None, None] == 0, np.eye(2), t)) * np.stack([np.ones(len(rows)), e[:, k]], 1)[:, None, :]
            m = np.where((k < lengths[rows])[:, None, None], m @ step, m)
            m /= m.sum((1, 2), keepdims=True)
        whole = np.empty((n, 2, 2))
        whole[rows] = m
        deepest = int(place.max())
        for j in range(1, deepest + 1):
            at = np.flatnonzero(place == j)
            x = np.einsum("ni,nij->nj", before[at - 1], whole[at - 1])
            before[at] = x / x.sum(1, keepdims=True)
        for j in range(deepest - 1, -1, -1):
            at = np.flatnonzero((place == j) & ~last)
            x = np.einsum("nij,nj->ni", whole[at + 1], after[at + 1])
            after[at] = x / x.sum(1, keepdims=True)
        return before, after

    def marginals(self, odds: np.ndarray, lengths: np.ndarray, pairs: bool = False, first: np.ndarray | None = None,
                  before: np.ndarray | None = None, after: np.ndarray | None = None):
        """P(toxic) of each word of (n, PIECE) log-odds, by forward-backward with all pieces side
        by side, given the messages from their lines' other pieces (``first`` ones of a line have
        none before them); with ``pairs`` the summed probabilities of the transitions too."""
        n, width = odds.shape
        width = int(lengths.max()) if n else 0
        odds = odds[:, :width]
        inside = np.arange(width)[None, :] < lengths[:, None]
        t = np.exp(self.step)
        e = np.exp(np.clip(odds, -30, 30))
        forward = np.empty((n, width, 2))
        a = np.ones((n, 2))
        for k in range(width):
            if k:
                a = a @ t
            elif first is not None:
                a = np.where(first[:, None], 1.0, before @ t)
            a[:, 1] *= e[:, k]
            a /= a.sum(1, keepdims=True)
            forward[:, k] = a
        p = np.zeros((n, width))
        end = np.ones((n, 2)) if after is None else after
        b = end
        counts = np.zeros((2, 2))
        for k in range(width - 1, -1, -1):
            b = np.where((k < lengths - 1)[:, None], b, end)
            joint = forward[:, k] * b
            p[:, k] = joint[:, 1] / joint.sum(1)
            back = b.copy()
            back[:, 1] *= e[:, k]
            if pairs and k:
                both = forward[:, k - 1, :, None] * t[None] * back[:, None, :]
                both = both[inside[:, k]]
                counts += (both / both.sum((1, 2), keepdims=True)).sum(0)
            b = back @ t.T
            b /= b.sum(1, keepdims=True)
        return (np.where(inside, p, 0.0), counts) if pairs else np.where(inside, p, 0.0)

    def fit(self, texts: list[str], labels: np.ndarray) -> None:
        """Labelled tokens from the documents' labels, then the field by stochastic gradient ascent
        (Adagrad) on the likelihood of the tokens' states, then the calibration."""
        self.base = float(labels.mean()) if len(labels) else 0.0
        if not 0 < self.base < 1:
            return
        rng, words = np.random.default_rng(SEED), Words()
        docs = [words.of(t) for t in texts]
        names = list(words.number)
        held = [features(w) for w in names]
        toxic, clean = Counter(), Counter()
        for (ids, _, _), label in zip(docs, labels, strict=True):
            (toxic if label else clean).update({f for i in set(ids.tolist()) for f in held[i]})
        surprise = np.log(len(toxic) / SEED_CHANCE)
        seeds = {f for f, n in toxic.items() if not f.startswith("s") and n >= SEED_SHARE * (n + clean[f])
                 and (n + clean[f]) * divergence(n / (n + clean[f]), self.base) >= surprise}
        marked = np.array([any(f in seeds for f in fs) for fs in held], bool)
        flat = [slots(w) for w in names]
        some = [(ids, starts, bool(label)) for (ids, starts, _), label in zip(docs, labels, strict=True) if len(ids)]
        rows = [(*pieces_of(ids, starts), label) for ids, starts, label in some]
        x = np.concatenate([r[0] for r in rows])
        lengths = np.concatenate([r[1] for r in rows])
        y = np.where(x >= 0, marked[x], False) & np.repeat([r[2] for r in rows], [len(r[0]) for r in rows])[:, None]
        # pieces without a toxic token teach little each: one in eight of them
        use = np.flatnonzero(y.any(1) | (rng.random(len(x)) < 0.125))
        owner = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
        slot = np.array([s for f in flat for s in f], np.int64)
        squares, step_squares, bias_square = np.full(1 << BITS, 1e-8), np.full((2, 2), 1e-8), 1e-8
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(use), max(1, len(use) // BATCH)):
                width = int(lengths[part].max())
                ids, truth, inside = x[part, :width], y[part, :width], x[part, :width] >= 0
                by_word = self.weight[slot]
                odds = np.full(len(flat), self.bias)
                np.add.at(odds, owner, by_word)
                p, counts = self.marginals(np.where(inside, odds[ids], 0.0), lengths[part], pairs=True)
                error = np.where(inside, truth - p[:, :width], 0.0)
                word_error = np.bincount(ids[inside], error[inside], len(flat)) / len(part)
                grad = np.bincount(slot, word_error[owner], 1 << BITS)
                grad -= L2 * self.weight * (grad != 0)
                squares += grad * grad
                self.weight += RATE * grad / np.sqrt(squares)
                total = float(error.sum()) / len(part)
                bias_square += total * total
                self.bias += RATE * total / np.sqrt(bias_square)
                nxt = inside[:, 1:]
                seen = np.array([[(nxt & (truth[:, :-1] == i) & (truth[:, 1:] == j)).sum() for j in (0, 1)] for i in (0, 1)])
                g = (seen - counts) / len(part) - L2 * self.step
                step_squares += g * g
                self.step += RATE * g / np.sqrt(step_squares)
        self.calibrate(texts, labels)

    def calibrate(self, texts: list[str], labels: np.ndarray) -> None:
        """Logistic regression of the labels on the evidence, by Newton steps."""
        x = np.array([np.append(evidence(p), 1.0) for p, _ in self.score_words(texts)])
        w = np.zeros(4)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(4)
            w += np.linalg.solve(h, x.T @ (labels - p) - 0.05 * w)
        self.calibration = w

    def score_words(self, texts, words: Words | None = None) -> Iterator[tuple[np.ndarray, str]]:
        """The marginals of the words of each text, in order."""
        held: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]] = []
        words, size = words or Words(), 0

        def put() -> Iterator[tuple[np.ndarray, str]]:
            odds = words.scored(self)
            full = [(*pieces_of(ids, starts), place) for _, ids, starts, place in held if len(ids)]
            p = np.empty(0)
            if full:
                x, lengths, place = (np.concatenate([f[k] for f in full]) for k in range(3))
                before, after = self.messages(odds[x], lengths, place)
                order = np.argsort(lengths, kind="stable")  # pieces of like length side by side
                found = np.zeros(x.shape)
                for at in range(0, len(x), 2048):
                    some = order[at:at + 2048]
                    m = self.marginals(odds[x[some]], lengths[some], False, place[some] == 0, before[some], after[some])
                    found[some, :m.shape[1]] = m
                p = found[np.arange(PIECE)[None, :] < lengths[:, None]]
            at = 0
            for text, ids, _, _ in held:
                yield p[at:at + len(ids)], text
                at += len(ids)
            held.clear()

        for text in texts:
            text = text or ""
            held.append((text, *words.of(text)))
            size += len(held[-1][1])
            if size >= SCORED:
                yield from put()
                size = 0
                if len(words.number) > KNOWN:
                    words.__init__()
        if held:
            yield from put()

    def score(self, p: np.ndarray) -> float:
        if not 0 < self.base < 1:
            return self.base
        return float(1 / (1 + np.exp(-np.clip(np.append(evidence(p), 1.0) @ self.calibration, -30, 30))))


def divergence(q: float, base: float) -> float:
    """Of a coin that shows ``q`` from one that shows ``base``, in nats a toss."""
    return q * np.log(q / base) + ((1 - q) * np.log((1 - q) / (1 - base)) if q < 1 else 0.0)


def evidence(p: np.ndarray) -> np.ndarray:
    """A document's strongest marginal and, damped, the expected number of toxic words among
    those that are likelier toxic than not; its length, since a long text has more chances."""
    return np.array([p.max(initial=0.0), np.log1p(p[p > 0.5].sum()), np.log1p(len(p)) / 10])


def spans_of(text: str, p: np.ndarray) -> list[dict]:
    """Runs of toxic words of a line: character offsets (end exclusive) and the strongest marginal."""
    out: list[dict] = []
    if not (p > 0.5).any():
        return out
    at, base = 0, 0
    for line in text.split("\n"):
        joined = False
        for m in WORD.finditer(line):  # the same words as ``Words.of`` numbers
            toxic = p[at] > 0.5
            if toxic and joined:
                out[-1]["end"], out[-1]["p"] = base + m.end(), max(out[-1]["p"], float(p[at]))
            elif toxic:
                out.append({"start": base + m.start(), "end": base + m.end(), "p": float(p[at])})
            joined = toxic
            at += 1
        base += len(line) + 1
    return out


def scorer(field: Field, with_spans: bool) -> Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = Words()
        for texts in batches:
            found = [(field.score(p), spans_of(t, p) if with_spans else []) for p, t in field.score_words(texts, words)]
            yield pd.DataFrame({"score": [f[0] for f in found], "spans": [f[1] for f in found]})

    return run


def training_texts(docs: DataFrame, labels: DataFrame, text: str, label: str, id_col: str,
                   per_class: int = PER_CLASS) -> pd.DataFrame:
    """The bounded sample: of each class the ``per_class`` labelled ids with the smallest hashes, and
    one text of each (that with the smallest hash), whatever repeats."""
    once = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("l_id"), F.col(label).cast("int").alias("label")).distinct()
    turn = F.xxhash64("l_id", F.lit("toxic"))
    first = [once.filter(F.col("label") == k).orderBy(turn, "l_id").limit(per_class) for k in (0, 1)]
    chosen = first[0].unionByName(first[1])  # at most twice ``per_class`` ids
    texts = (docs.filter(F.col(text).isNotNull() & (F.char_length(text) <= SAMPLE_CHARS))
             .select(F.col(id_col).alias("id"), F.col(text).alias("text"))
             .join(F.broadcast(chosen), F.col("id") == F.col("l_id")))
    found = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).toPandas()
    return found.sort_values(["id", "text", "label"], kind="stable").reset_index(drop=True)


def score_toxicity(df: DataFrame, docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic",
                   id_col: str = "doc_id", threshold: float = THRESHOLD, with_spans: bool = True) -> DataFrame:
    """``df`` with score, predicted and, unless ``with_spans`` is off, toxic_spans (earlier columns of
    these names give way), learned from ``labels`` (id, label) of the documents ``docs`` (id, text)."""
    need(df, text)
    need(docs, text, id_col)
    need(labels, label, id_col)
    columns = [c for c in df.columns if c.lower() not in ("score", "predicted", "toxic_spans")]
    sample = training_texts(docs, labels, text, label, id_col)
    field = Field()
    field.fit(sample["text"].tolist(), sample["label"].to_numpy(float))
    predict = F.pandas_udf(scorer(field, with_spans), f"score double, spans {SPANS}")
    (x,) = fresh(df, "x")
    out = df.withColumn(x, predict(F.col(text)))
    made = [F.col(x)["score"].alias("score"), (F.col(x)["score"] >= threshold).cast("int").alias("predicted")]
    return out.select(*columns, *made, *([F.col(x)["spans"].alias("toxic_spans")] if with_spans else []))
