"""Ordered operators: positions in groups, chapter runs, block assignment, gaps and islands, interpolation, neighbours.

A group may be as large as the table, so no window spans one. Rows are cut into ranges of the order column (of ``span``
values, or between sampled keys); a window works inside a range, and a few numbers for each range, summed or carried along
the ranges of a group, complete it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import fresh

SPAN = 4096
#: Ranges of a key column, rows sampled for each, and characters of a key that decide its range.
RANGES, SAMPLE_A_RANGE, KEY_LENGTH = 256, 16, 64


def _in_ranges(df: DataFrame, group: str, order: str, span: int) -> tuple[DataFrame, str]:
    cut = fresh(df.columns, "cut")
    return df.withColumn(cut, F.floor(F.col(order) / span)), cut


def _meet(df: DataFrame, few: DataFrame, group: str, cut: str) -> DataFrame:
    """df with the columns of few, a row for each group and range, under names of its own."""
    g, c = fresh([*df.columns, *few.columns], "few_group"), fresh([*df.columns, *few.columns], "few_cut")
    few = few.withColumnsRenamed({group: g, cut: c})
    return df.join(few, F.col(group).eqNullSafe(F.col(g)) & F.col(cut).eqNullSafe(F.col(c))).drop(g, c)


def positions(df: DataFrame, group: str, order: str, out: str = "row", span: int = SPAN) -> DataFrame:
    """df with each row's 0-based place in its group by an integer column. Rows keep their columns on the way, so give it what
    is needed later and nothing else."""
    d, cut = _in_ranges(df, group, order, span)
    n, start, i = (fresh(d.columns, x) for x in ("range_n", "range_start", "range_i"))
    sizes = d.groupBy(group, cut).agg(F.count("*").alias(n))
    before = Window.partitionBy(group).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, cut, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    d = d.withColumn(i, F.row_number().over(Window.partitionBy(group, cut).orderBy(order)) - 1)
    return _meet(d, starts, group, cut).withColumn(out, (F.col(start) + F.col(i)).cast("long")).select(*(F.col(f"`{c}`") for c in df.columns if c != out), out)


def chapter_runs(rows: DataFrame) -> DataFrame:
    """First row, rows and whether they are contiguous, of each chapter. rows: book, row, chapter."""
    return rows.groupBy("book", "chapter").agg(F.min("row").alias("first_row"), F.count("*").alias("n_rows"), (F.max("row") - F.min("row") + 1 == F.count("*")).alias("contiguous"))


def block_assignment(rows: DataFrame, target: int) -> DataFrame:
    """Blocks of consecutive rows of a book, closed when their bytes reach the target. rows: book, row, bytes.
    A block's start depends on all rows before it, so a book's (row, bytes) stream through one task in order; the task
    holds one batch and the running total, never the book."""

    def cut(batches):
        book = object()
        held = block = 0
        for batch in batches:
            out = []
            for own, size in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own != book:
                    book, held, block = own, 0, 0
                out.append(block)
                held += size or 0
                if held >= target:
                    held, block = 0, block + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int32())], names=["book", "row", "block"])

    own = rows.select("book", F.col("row").cast("long").alias("row"), F.col("bytes").cast("long").alias("bytes"))
    book = own.schema["book"].dataType.simpleString()
    return own.repartition("book").sortWithinPartitions("book", "row").mapInArrow(cut, f"book {book}, row long, block int")


def with_neighbours(df: DataFrame, group: str, order: str, before: dict[str, str] | None = None, after: dict[str, str] | None = None, span: int = SPAN, tie: str | None = None) -> DataFrame:
    """df with columns for known values near each row, by an integer order (and, for rows equal in it, by tie): before maps an
    output to the column whose last known value before the row it holds, after likewise the first known one behind it."""
    before, after = before or {}, after or {}
    d, cut = _in_ranges(df, group, order, span)
    by = [order, tie] if tie else [order]
    inside = Window.partitionBy(group, cut).orderBy(*by)
    place = [F.col(c).alias(f"o{i}") for i, c in enumerate(by)]
    up, down = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(1, Window.unboundedFollowing)
    last, first = {o: fresh(d.columns, f"last_{o}") for o in before}, {o: fresh(d.columns, f"first_{o}") for o in after}
    per = d.groupBy(group, cut).agg(
        *(F.max(F.when(F.col(c).isNotNull(), F.struct(*place, F.col(c).alias("v")))).alias(last[o]) for o, c in before.items()),
        *(F.min(F.when(F.col(c).isNotNull(), F.struct(*place, F.col(c).alias("v")))).alias(first[o]) for o, c in after.items()),
    )
    along = Window.partitionBy(group).orderBy(cut)
    carried = per.select(
        group, cut,
        *(F.last(F.col(last[o]), True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias(last[o]) for o in before),
        *(F.first(F.col(first[o]), True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias(first[o]) for o in after),
    )
    d = d.withColumns({o: F.last(c, True).over(up) for o, c in before.items()} | {o: F.first(c, True).over(down) for o, c in after.items()})
    d = _meet(d, carried, group, cut)
    d = d.withColumns({o: F.coalesce(F.col(o), F.col(last[o])["v"]) for o in before} | {o: F.coalesce(F.col(o), F.col(first[o])["v"]) for o in after})
    return d.drop(cut, *last.values(), *first.values())


def islands(df: DataFrame, group: str, order: str, breaks: Column, span: int = SPAN) -> DataFrame:
    """df with island: how many breaks a row's group has had up to it."""
    d, cut = _in_ranges(df, group, order, span)
    b, base = fresh(d.columns, "break_here"), fresh(d.columns, "breaks_before")
    d = d.withColumn(b, F.coalesce(breaks, F.lit(False)).cast("int"))
    sums = d.groupBy(group, cut).agg(F.sum(b).alias(base))
    sums = sums.withColumn(base, F.coalesce(F.sum(base).over(Window.partitionBy(group).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.withColumn("island", F.sum(b).over(Window.partitionBy(group, cut).orderBy(order)))
    return _meet(d, sums, group, cut).withColumn("island", F.col("island") + F.col(base)).drop(cut, b, base)


def steady_runs(pairs: DataFrame, least: int = 5, max_step: int = 4) -> DataFrame:
    """Matched pairs that lie in runs of at least ``least`` where row and donor both step by 1 to max_step.
    pairs: book, row, donor."""
    d = with_neighbours(pairs, "book", "row", {"prev_row": "row", "prev_donor": "donor"})
    breaks = (F.col("row") - F.col("prev_row") > max_step) | ~(F.col("donor") - F.col("prev_donor")).between(1, max_step)
    runs = islands(d, "book", "row", breaks).drop("prev_row", "prev_donor")
    sizes = runs.groupBy("book", "island").agg(F.count("*").alias("run")).filter(F.col("run") >= least)
    return runs.join(sizes, ["book", "island"]).select(*pairs.columns, "island", "run")


def interpolate(rows: DataFrame) -> DataFrame:
    """Open rows between two anchors get the donors between theirs where both gaps are equally long. rows: book, row, donor.
    One pass is the fixpoint: filling a gap changes no other gap's anchors."""
    d = rows.select("book", "row", "donor", F.when(F.col("donor").isNotNull(), F.col("row")).alias("anchor"))
    d = with_neighbours(d, "book", "row", {"lo": "donor", "lo_row": "anchor"}, {"hi": "donor", "hi_row": "anchor"})
    filled = F.when(F.col("hi_row") - F.col("lo_row") == F.col("hi") - F.col("lo"), F.col("lo") + F.col("row") - F.col("lo_row"))
    tier = F.when(F.col("donor").isNotNull(), "matched").when(filled.isNotNull(), "interpolated").otherwise("open")
    return d.select("book", "row", F.coalesce("donor", filled).alias("donor"), tier.alias("tier"))


def descents(df: DataFrame, group: str, order: str, value: str, tie: str | None = None, span: int = SPAN) -> DataFrame:
    """A row for each group: its rows and how many of them have a lower value than the row before, by an integer order."""
    own = df.select(group, order, *([tie] if tie else []), F.col(value).alias("own"), F.struct(F.col(value).alias("x")).alias("boxed"))
    near = with_neighbours(own, group, order, {"before": "boxed"}, span=span, tie=tie)
    return near.groupBy(group).agg(F.count("*").alias("n_rows"), F.count_if(F.col("own") < F.col("before.x")).alias("descents"))


def adjudicate(df: DataFrame, group: str, order: str, value: str, suspect: Column, span: int = SPAN) -> DataFrame:
    """The suspect rows with lo and hi, the nearest values around them that are not suspect, and between: whether their own
    value lies strictly between. What is said of one suspect changes nothing for another."""
    known, lo, hi = (fresh(df.columns, x) for x in ("sure", "lo", "hi"))
    d = df.withColumn(known, F.when(~suspect, F.col(value)))
    d = with_neighbours(d, group, order, {lo: known}, {hi: known}, span).filter(suspect).drop(known)
    return d.withColumn("between", F.coalesce((F.col(lo) < F.col(value)) & (F.col(value) < F.col(hi)), F.lit(False)))


def key_ranges(df: DataFrame, key: str, n: int = RANGES, length: int = KEY_LENGTH) -> Column:
    """A column that numbers ranges of a string key in order. Cut points come from a bounded sample, the rows with the
    smallest hashes; they only balance the ranges, and every row lies in one."""
    own = df.select(F.substring(key, 1, length).alias("k"), F.xxhash64(key).alias("h")).orderBy("h").limit(n * SAMPLE_A_RANGE)
    points = np.array(sorted(r["k"] for r in own.collect() if r["k"] is not None)[SAMPLE_A_RANGE::SAMPLE_A_RANGE], dtype=object)

    @F.pandas_udf("int")
    def number(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, k.fillna("").to_numpy(dtype=object), "right").astype(np.int32)) if len(points) else pd.Series(np.zeros(len(k), np.int32))

    return number(F.substring(key, 1, length))


def running_count(df: DataFrame, group: str, key: str, counted: Column, out: str, then: str | None = None, length: int = KEY_LENGTH) -> DataFrame:
    """df with how many counted rows its group has up to and with each row, by a string key (and then by another column).
    A counted number counts for as many rows; the first length characters of a key decide its range."""
    cut, base, one = (fresh([*df.columns, out], x) for x in ("key_cut", "key_base", "key_one"))
    d = df.withColumns({cut: key_ranges(df, key, length=length), one: counted.cast("long")})
    sums = d.groupBy(group, cut).agg(F.sum(one).alias(base))
    sums = sums.withColumn(base, F.coalesce(F.sum(base).over(Window.partitionBy(group).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy(group, cut).orderBy(key, *([then] if then else [])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _meet(d.withColumn(out, F.sum(one).over(inside)), sums, group, cut).withColumn(out, (F.col(out) + F.col(base)).cast("long")).drop(cut, base, one)
