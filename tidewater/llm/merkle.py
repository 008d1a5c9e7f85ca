"""Document fingerprints: Merkle trees over sections and paragraphs.

A text is cut without loss: paragraphs are its lines with their line feed, a section ends with a
blank line or with a paragraph whose hash begins with one of ``SECTION``, and the leaves are a
paragraph's sentences, long ones (over ``LONG`` characters) cut on after words whose hash begins with
``CUT``.  Each cut depends on the text next to it alone, so an edit changes the leaves it touches
and the nodes above them, and no other.  A leaf's hash is that of its characters, an inner node's
that of its children's hashes, by level (``DIGITS`` hexadecimal digits of SHA-256); the root is
the fingerprint.

Equal roots: equal texts.  Otherwise the comparison goes down: children that both nodes hold are
equal as a whole, and only the branches that differ are opened.  The leaves left over locate the
edit; the characters in common give the likeness, 2 * common / (all of both), from 0 to 1.

``fingerprints`` gives trees, ``compare`` locates the edits between two versions of a table, and
``compare_with_next`` compares each text with its edited text and with the next text by id.  For
the latter, rows are dealt to ranges of ids cut by Spark's range partitioning of (id, hash); the
first row of a range also goes to the end of the range before, so neighbours meet in a task that
sees one row and the next at a time.  Whole texts are shuffled once.

Defined results: a null text is an empty one, its tree has no leaf; two empty texts are
equal; null ids come last; equal ids are ordered by a hash of the text; a repeated row's successor
may be its equal, wholly equal rows (id and text) stay in one range; a single row is its own
successor; an empty table gives an empty table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import need, ship_by_value

#: One paragraph in four ends a section, one word in sixteen a leaf of a long sentence.
SECTION, LONG, CUT, DIGITS = "048c", 240, "0", 32
#: Bytes of text of a range, and ranges at most (larger tables get larger ranges).
RANGE_BYTES, RANGES = 8 << 20, 50_000

BLANKS = " \t\n\r\x0b\x0c"
SENTENCE = re.compile(r"[^.!?\n]*[.!?]*[ \t\r\x0b\x0c]*\n?")
WORDS = re.compile(r"[^ \t\n\r\x0b\x0c]{1,64}[ \t\n\r\x0b\x0c]*|[ \t\n\r\x0b\x0c]+")

ship_by_value(__name__)


class Node(NamedTuple):
    hash: str
    start: int  # in code points
    chars: int
    children: list["Node"]


def digest(level: str, data: str) -> str:
    return hashlib.sha256(f"{level}:{data}".encode()).hexdigest()[:DIGITS]


def pieces(paragraph: str) -> Iterator[str]:
    """The leaves of a paragraph."""
    for sentence in SENTENCE.findall(paragraph):
        if len(sentence) <= LONG:
            if sentence:
                yield sentence
            continue
        held: list[str] = []
        for word in WORDS.findall(sentence):
            held.append(word)
            if hashlib.sha256(word.encode()).hexdigest()[0] in CUT:
                yield "".join(held)
                held = []
        if held:
            yield "".join(held)


def parent(level: str, children: list[Node], start: int) -> Node:
    return Node(digest(level, "".join(c.hash for c in children)), start, sum(c.chars for c in children), children)


def tree(text: str | None) -> Node:
    """root -> sections -> paragraphs -> leaves."""
    sections, held, at = [], [], 0

    def close() -> None:
        sections.append(parent("section", held, held[0].start))

    for line in re.findall(r"[^\n]*\n|[^\n]+", text or ""):
        leaves, place = [], at
        for piece in pieces(line):
            leaves.append(Node(digest("leaf", piece), place, len(piece), []))
            place += len(piece)
        held.append(parent("paragraph", leaves, at))
        at += len(line)
        if not line.strip(BLANKS) or held[-1].hash[0] in SECTION:
            close()
            held = []
    if held:
        close()
    return parent("root", sections, 0)


def left_over(a: list[Node], b: list[Node]) -> tuple[list[Node], list[Node], int]:
    """The nodes of either side without an equal on the other, and the characters of the others."""
    have = Counter(n.hash for n in b)
    rest_a, common, used = [], 0, Counter()
    for n in a:
        if used[n.hash] < have[n.hash]:
            used[n.hash] += 1
            common += n.chars
        else:
            rest_a.append(n)
    rest_b = []
    for n in b:
        if used[n.hash] > 0:
            used[n.hash] -= 1
        else:
            rest_b.append(n)
    return rest_a, rest_b, common


def differing(a: Node, b: Node) -> tuple[list[Node], list[Node], int]:
    """The leaves of either tree that the other lacks, and the characters in common."""
    if a.hash == b.hash:
        return [], [], a.chars
    left, right, common = [a], [b], 0
    for _ in range(3):  # sections, paragraphs, leaves
        left, right, more = left_over([c for n in left for c in n.children], [c for n in right for c in n.children])
        common += more
    return left, right, common


def likeness(a: Node, b: Node) -> float:
    if a.hash == b.hash:
        return 1.0
    return 2 * differing(a, b)[2] / (a.chars + b.chars)


def spans(leaves: list[Node]) -> list[tuple[int, int]]:
    """Neighbouring leaves as (from, to)."""
    out: list[tuple[int, int]] = []
    for n in leaves:
        if out and out[-1][1] == n.start:
            out[-1] = (out[-1][0], n.start + n.chars)
        else:
            out.append((n.start, n.start + n.chars))
    return out


# ---------------------------------------------------------------- tables


def nodes_of(root: Node) -> list[dict]:
    """Root, sections and paragraphs, from above."""
    out, level = [], [root]
    for number in range(3):
        out.extend({"level": number, "start": n.start, "chars": n.chars, "hash": n.hash} for n in level)
        level = [c for n in level for c in n.children]
    return out


def tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("level", pa.int32()), ("start", pa.int64()), ("chars", pa.int64()), ("hash", pa.string())]))
    for batch in batches:
        nodes = [nodes_of(tree(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([n[0]["hash"] for n in nodes], pa.string()), pa.array(nodes, kind)],
            ["id", "fingerprint", "nodes"])


def fingerprints(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, fingerprint, nodes) of every row: its root, and its nodes (level 0 root, 1 section, 2
    paragraph; start and length in code points; hash)."""
    need(df, text, id_col)
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(tree_rows, f"id {kind}, fingerprint string, "
                                     "nodes array<struct<level:int,start:long,chars:long,hash:string>>")
    return out.withColumnRenamed("id", id_col)


def edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out: tuple[list, ...] = ([], [], [])
        for a, b in zip(batch.column(1), batch.column(2), strict=True):
            a, b = tree(a.as_py()), tree(b.as_py())
            left, right, common = differing(a, b)
            out[0].append(1.0 if a.hash == b.hash else 2 * common / (a.chars + b.chars))
            out[1].append([{"start": x, "end": y} for x, y in spans(left)])
            out[2].append([{"start": x, "end": y} for x, y in spans(right)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out[0], pa.float64()), pa.array(out[1], span), pa.array(out[2], span)],
            ["id", "likeness", "old_spans", "new_spans"])


def compare(old: DataFrame, new: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, likeness, old_spans, new_spans) of the ids (distinct in either table) whose texts
    differ: where the old and where the new text has leaves that the other lacks."""
    need(old, text, id_col)
    need(new, text, id_col)
    a = old.select(F.col(id_col).alias("id"), F.col(text).alias("a"))
    b = new.select(F.col(id_col).alias("new_id"), F.col(text).alias("b"))
    pairs = a.join(b, a["id"] == b["new_id"]).filter(~F.coalesce("a", F.lit("")).eqNullSafe(F.coalesce("b", F.lit(""))))
    kind = a.schema["id"].dataType.simpleString()
    spans_ = "array<struct<start:long,end:long>>"
    out = pairs.select("id", "a", "b").mapInArrow(
        edit_rows, f"id {kind}, likeness double, old_spans {spans_}, new_spans {spans_}")
    return out.withColumnRenamed("id", id_col)


# ---------------------------------------------------------------- each text and the next


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) characters replaced by the first as many of the following text."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


def ranges_of(first: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (no_id, id, h, text) to (part, tail, no_id, id, h, text): the row in its range and,
    where it is a range's first, at the end of the one before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = first.value
        for batch in batches:
            rows, parts, tails = [], [], []
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                key = (key[0], () if key[0] else (key[1],), key[2])
                part = bisect.bisect_right(bounds, key) - 1
                rows.append(i)
                parts.append(part)
                tails.append(False)
                if bounds[part] == key:
                    rows.append(i)
                    parts.append(part - 1 if part else len(bounds) - 1)
                    tails.append(True)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(tails, pa.bool_()), *taken.columns],
                                             ["part", "tail", "no_id", "id", "h", "t"])

    return run


def neighbours(kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One range's rows in order, its tail last, to the comparison of each with the next."""
    types = (kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: tuple[list, ...] = tuple([] for _ in types)

        def put() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], COLUMNS)
            for c in rows:
                c.clear()
            return out

        def compared(key, text: str, own: Node, following: str, other: Node) -> None:
            new = edited(text, following)
            changed = own if new == text else tree(new)
            left, _, common = differing(own, changed)
            near = 1.0 if own.hash == changed.hash else 2 * common / (own.chars + changed.chars)
            values = (key, len(text), hashlib.sha256(new.encode()).hexdigest(), own.hash, changed.hash, near,
                      likeness(own, other), left[0].start if left else None, left[-1].start + left[-1].chars if left else None)
            for column, value in zip(rows, values, strict=True):
                column.append(value)

        last, part, ended = None, None, False
        for batch in batches:
            for i in range(batch.num_rows):
                now, tail = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if now != part:
                    last, part, ended = None, now, False
                if ended:
                    continue  # a copy of the tail
                text = batch.column(5)[i].as_py() or ""
                root = tree(text)
                if last:
                    compared(*last, text, root)
                    if len(rows[0]) >= 4096:
                        yield put()
                last, ended = (batch.column(3)[i].as_py(), text, root), tail
        if rows[0]:
            yield put()

    return run


COLUMNS = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
           "edit_start", "edit_end"]


def compare_with_next(spark: SparkSession, df: DataFrame, store: Callable[[DataFrame], DataFrame], text: str = "text",
                      id_col: str = "doc_id", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every row's fingerprint, and its likeness to its edited text and to the next text by id
    (after the last: the first).  ``edit_start`` and ``edit_end``: the part of the text, in code
    points, outside which all leaves are the edited text's too; null where that is all of it."""
    need(df, text, id_col)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.xxhash64(t).alias("h"), t.alias("t"))
    keys = store(rows.select("no_id", "id", "h", F.octet_length("t").cast("long").alias("bytes")))
    kind = keys.schema["id"].dataType.simpleString()
    total = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    count = min(total // range_bytes + 1, RANGES)
    order = ["no_id", "id", "h"]
    first = (keys.select(*order).repartitionByRange(count, *order).groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min(F.struct(*order)).alias("x")).select("x.*").collect())  # a row for each range
    bounds = sorted((r["no_id"], () if r["no_id"] else (r["id"],), r["h"]) for r in first)
    dealt = rows.mapInArrow(ranges_of(spark.sparkContext.broadcast(bounds)),
                            f"part int, tail boolean, no_id boolean, id {kind}, h long, t string")
    in_order = dealt.repartitionById(max(len(bounds), 1), F.col("part")).sortWithinPartitions("part", "tail", *order)
    out = in_order.mapInArrow(neighbours(arrow_type(keys)),
                              f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                              "near_edited double, near_next double, edit_start long, edit_end long")
    return out.withColumnRenamed("id", id_col)


def arrow_type(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["id"].dataType)
