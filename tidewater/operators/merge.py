"""Set operations: schema-era merges and source unions (narrow: no shuffle)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tidewater.functions.columns import col_of, tag_source


def align_case(df: DataFrame, reference_names: list[str]) -> DataFrame:
    """Respell columns that match ``reference_names`` case-insensitively."""
    by_lower = {n.lower(): n for n in reference_names}
    renames = {c: by_lower[c.lower()] for c in df.columns if c.lower() in by_lower and by_lower[c.lower()] != c}
    return df.withColumnsRenamed(renames) if renames else df


def merge_eras(*eras: DataFrame) -> DataFrame:
    """Union schema eras by name; later eras add columns, missing ones are NULL.

    Names match case-insensitively and the first era's spelling wins.  Column order is
    the first era's, then new columns in order of appearance (what an append with
    schema merge gives).  A union is narrow: no shuffle, one plan, one write.
    """
    if not eras:
        raise ValueError("merge_eras needs at least one frame")

    def step(acc: DataFrame, nxt: DataFrame) -> DataFrame:
        nxt = align_case(nxt, acc.columns)
        return acc.unionByName(nxt, allowMissingColumns=True)

    return reduce(step, eras)


def union_sources(green: DataFrame, yellow: DataFrame, tag_yellow: bool = False) -> DataFrame:
    """Union two clean sources by name, missing columns NULL, duplicates kept.

    A column typed differently on the two sides (``rate_code_id``: int on green, text
    on yellow) becomes text on both, so the union never depends on ANSI widening.
    ``tag_yellow`` fills ``data_source`` with ``'yellow'`` (off by default: the
    reference leaves it NULL).
    """
    yellow = align_case(yellow, green.columns)
    if tag_yellow:
        yellow = tag_source(yellow, "yellow")
    g_types = dict(green.dtypes)
    y_types = dict(yellow.dtypes)
    clash = [c for c in g_types if c in y_types and g_types[c] != y_types[c]]
    if clash:
        green = green.withColumns({c: col_of(c).cast("string") for c in clash})
        yellow = yellow.withColumns({c: col_of(c).cast("string") for c in clash})
    return green.unionByName(yellow, allowMissingColumns=True)
