"""Token counts by distinct pre-tokens.

A text with its blanks as ``▁`` (the library's mark, which also starts the text) falls into
pre-tokens: a run of marks with the characters up to the next mark, and every line feed by
itself.  No piece of the model goes on past a non-mark into a mark, nor holds a line feed (the
model is checked for both), so pieces never cross pre-tokens and a text's count is the sum of
its pre-tokens' counts.

1. Every task counts its documents' pre-tokens; Spark adds the counts up.  Each distinct pre-token
   of the corpus is then tokenised once, and only its number of pieces is kept, in a stored
   vocabulary (pre-token, occurrences, pieces).
2. Per-document pre-token frequencies are joined with it and summed.  The ``HEAD`` most frequent
   pre-tokens of at most ``HEAD_CHARS`` characters (a bounded size) are broadcast and joined in
   the scan; the frequencies of all other pre-tokens meet the vocabulary in a shuffled join.

Token ids are never kept.  A task holds one Arrow batch of texts, and the distinct pre-tokens
of ``SLICE`` characters of text at a time.

Defined results: a null text is empty, 0 bytes and 0 tokens; repeated rows give equal rows;
an empty table gives an empty table; ids are of any type.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewater.llm.common import need, ship_by_value

MODEL = "piece_bpe_32k.model"
MARK = "▁"
HEAD, HEAD_CHARS = 1 << 18, 64
SLICE = 8 << 20
LIMIT = 4096
PRETOKEN = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")

ship_by_value(__name__)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counts:
    """Numbers of pieces of single pre-tokens."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if MARK in piece.lstrip(MARK) or "\n" in piece:
                raise ValueError(f"piece {piece!r} crosses pre-tokens")
        self.before = len(self.model.encode("\n"))  # the mark at the start, and the line feed

    def of(self, pretokens: list[str]) -> list[int]:
        """After a line feed a pre-token stands alone, without the mark that starts a text."""
        ids = self.model.encode(["\n" + p for p in pretokens], num_threads=1)
        return [1 if p == "\n" else len(x) - self.before for p, x in zip(pretokens, ids, strict=True)]


def pretokens(text: str | None) -> list[str]:
    return PRETOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


def corpus_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pretoken, n) of slices of the input; Spark adds them up."""
    def put(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                          ["pretoken", "n"])

    found, size = Counter(), 0
    for batch in batches:
        for text in batch.column(0):
            text = text.as_py()
            if text:
                found.update(pretokens(text))
                size += len(text)
            if size >= SLICE:
                yield put(found)
                found, size = Counter(), 0
    if found:
        yield put(found)


def piece_counts(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(path)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            pieces = [n for at in range(0, len(tokens), 4096) for n in counts.of(tokens[at:at + 4096])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pieces, pa.int64())],
                                             ["pretoken", "n", "pieces"])

    return run


def frequencies(head, kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, h, text) to (id, h, own, pretoken, n, pieces): for each document one row of its
    own (its hash as pre-token, its bytes as n, and the pieces of its head pre-tokens), and a row
    for each other pre-token with its frequency."""
    types = (kind, pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64())
    names = ["id", "h", "own", "pretoken", "n", "pieces"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])

            def put() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names)
                for c in rows:
                    c.clear()
                return out

            for key, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text, pieces, rest = text.as_py(), 0, []
                for p, n in Counter(pretokens(text)).items():
                    one = known.get(p)
                    if one is None:
                        rest.append((p, n))
                    else:
                        pieces += one * n
                k = len(rest)
                rows[0].extend([key] * (k + 1))
                rows[1].extend([h] * (k + 1))
                rows[2].extend([True] + [False] * k)
                rows[3].append(str(h))
                rows[3].extend(p for p, _ in rest)
                rows[4].append(len(text.encode()))
                rows[4].extend(n for _, n in rest)
                rows[5].append(pieces)
                rows[5].extend([None] * k)
                if len(rows[0]) >= 65_536:
                    yield put()
            if rows[0]:
                yield put()

    return run


def vocabulary(df: DataFrame, store: Callable[[DataFrame], DataFrame], text: str, path: str) -> DataFrame:
    """(pretoken, n, pieces) of every distinct pre-token of the corpus, stored."""
    counted = (df.select(text).mapInArrow(corpus_counts, "pretoken string, n long")
               .groupBy("pretoken").agg(F.sum("n").alias("n")))
    return store(counted.mapInArrow(piece_counts(path), "pretoken string, n long, pieces long"))


def cut_off(vocab: DataFrame, head: int) -> int:
    """The least frequency of the ``head`` most frequent pre-tokens, from a histogram of the
    frequencies (exact up to 64, then 32 steps an octave: some 2,000 rows).  A step that doesn't
    go in as a whole stays out."""
    octave = F.greatest(F.floor(F.log2(F.col("n").cast("double"))).cast("int") - 5, F.lit(0))
    step = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), octave), octave)
    least, room = 1 << 62, head
    for low, k in sorted(map(tuple, vocab.groupBy(step.alias("low")).agg(F.count(F.lit(1))).collect()), reverse=True):
        if k > room:
            break
        least, room = low, room - k
    return least


def count_tokens(spark: SparkSession, df: DataFrame, store: Callable[[DataFrame], DataFrame], path: str,
                 text: str = "text", id_col: str = "doc_id", limit: int = LIMIT, head: int = HEAD) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``df``."""
    need(df, text, id_col)
    t = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("h"), t.alias("t"))
    vocab = vocabulary(docs, store, "t", path)
    short = vocab.filter(F.char_length("pretoken") <= HEAD_CHARS)
    top = short.filter(F.col("n") >= cut_off(short, head)).select("pretoken", "pieces").toArrow()  # at most ``head``
    known = spark.sparkContext.broadcast(dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist(), strict=True)))
    kind = docs.schema["id"].dataType
    rows = docs.mapInArrow(frequencies(known, to_arrow_type(kind)), f"id {kind.simpleString()}, h long, own boolean, pretoken string, n long, pieces long")
    # documents' own rows match nothing: a join key of their own spreads them
    ones = vocab.select(F.lit(False).alias("v_own"), F.col("pretoken").alias("v_pretoken"), F.col("pieces").alias("one"))
    joined = rows.join(ones, (F.col("own") == F.col("v_own")) & (F.col("pretoken") == F.col("v_pretoken")), "left")
    own = F.col("own")
    total = joined.groupBy("id", "h").agg(
        F.sum(F.when(own, F.col("pieces")).otherwise(F.col("n") * F.col("one"))).alias("pieces"),
        F.sum(own.cast("long")).alias("copies"), F.max(F.when(own, F.col("n"))).alias("n_bytes"))
    # equal rows share (id, h): their sum is dealt back to as many rows
    n = (F.col("pieces") / F.col("copies")).cast("long")
    return (total.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(F.col("id").alias(id_col), "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")))
