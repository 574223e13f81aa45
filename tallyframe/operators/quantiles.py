"""Exact quantiles that hold at any row count.

Wanted are order statistics: the rows at given ranks of a column.  A scan of
mergeable sketches brackets each rank by two values, a second scan counts the
rows below and inside every bracket, and the rows inside are counted per value,
spread by hash.  The counts decide, so a sketch that errs costs a repetition and
never a digit.  Columns whose values are few by their range, or short columns,
are counted per value at once.  No task ever holds the values of a column.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.functions.numbers import as_double, doubles, ref
from tallyframe.operators.columns import ColumnStats, column_stats

EXACT_ROWS = 50_000
SKETCH_SIZE = 2048
MARGIN = 0.004  # ranks are off by less than a quarter of this with nearly all sketches
MERGE_GROUPS = 256


def linear_rank(n: int, q: float) -> float:
    """0-based fractional rank of quantile ``q``: linear between closest ranks."""
    return q * (n - 1)


def midpoint_rank(n: int, q: float) -> float:
    """0-based fractional rank with ``n*q + 1/2`` counted from one, clipped to the data.

    This is the rule box-plot drawing libraries use for quartiles.
    """
    return min(max(n * q - 0.5, 0.0), n - 1.0)


@dataclass(frozen=True)
class _Bracket:
    """Closed value range that holds the rows of the 0-based ``ranks``; ``below`` rows lie below it, about ``rows`` inside."""

    column: str
    ranks: tuple[int, ...]
    low: float
    high: float
    below: int
    rows: int


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    rank: Callable[[int, float], float] = linear_rank,
    stats: ColumnStats | None = None,
    sketches: DataFrame | None = None,
    exact_rows: int = EXACT_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles of the non-null values of each column, in order of ``probabilities``.

    ``sketches`` are those of exactly the rows of ``df`` (see ``column_sketches``), in any number of parts; then only counting and reading scan the data.
    """
    columns = list(columns)
    if not columns:
        return {}
    data = doubles(df, columns)
    if sketches is not None:
        stats = stats_of_sketches(sketches)
    stats = stats or column_stats(data, columns)
    counts = {c: stats.non_null[c] for c in columns}
    brackets = []
    for c, n in counts.items():
        places = [rank(n, q) for q in probabilities] if n else []
        for ranks in sorted({(math.floor(p), math.ceil(p)) for p in places}):  # neighbouring rows, read together
            brackets.append(_Bracket(c, tuple(sorted(set(map(int, ranks)))), float(stats.low[c]), float(stats.high[c]), 0, n))
    coded = {c for c in columns if stats.is_coded(c, exact_rows)}
    found = _order_statistics(data, brackets, coded, exact_rows, sketches)
    result: dict[str, list[float | None]] = {}
    for c, n in counts.items():
        result[c] = [None] * len(probabilities) if not n else []
        for q in probabilities if n else []:
            place = rank(n, q)
            lower, part = math.floor(place), place - math.floor(place)
            a, b = found[c, int(lower)], found[c, int(math.ceil(place))]
            result[c].append(a if a == b else a * (1.0 - part) + b * part)
    return result


def _order_statistics(
    data: DataFrame, brackets: list[_Bracket], coded: set[str], exact_rows: int, sketches: DataFrame | None = None
) -> dict[tuple[str, int], float]:
    found: dict[tuple[str, int], float] = {}
    ready: list[_Bracket] = []
    while brackets:
        wide = []
        for b in brackets:
            if b.low == b.high:
                found.update({(b.column, r): b.low for r in b.ranks})
            elif b.rows <= exact_rows or b.column in coded:
                ready.append(b)
            else:
                wide.append(b)
        brackets = []
        if wide:
            known, sketches = sketches, None  # sketches of whole columns serve the first round
            for before, after in zip(wide, _narrowed(data, wide, known)):
                # what does not shrink any more is held up by values that many rows share, and these are few
                (brackets if after.rows <= before.rows // 2 or after.low == after.high else ready).append(after)
    if ready:
        found.update(_read(data, ready, coded))
    return found


def _ranges(brackets: Sequence[_Bracket]) -> list[tuple[str, float, float]]:
    return sorted({(b.column, b.low, b.high) for b in brackets})


def _inside(column: str, low: float, high: float) -> Column:
    return ref(column).between(F.lit(low), F.lit(high))


def _sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE))


def _in_groups(data: DataFrame, *aggregates: Column) -> DataFrame:
    """Aggregates of the tasks of a scan in ``MERGE_GROUPS`` groups, so that no task takes one from every task of the scan."""
    return data.withColumn("__part", F.spark_partition_id() % MERGE_GROUPS).groupBy("__part").agg(*aggregates)


def column_sketches(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, non_null, low, high, whole, sketch): what quantiles of ``df`` need to know first, one row per column, from one scan.

    Rows of several parts of a table, such as the batches of a stream, stand side by side: ``exact_quantiles`` merges them.
    """
    names = list(columns)
    figures, entries, last = [F.count(F.lit(1)).alias("n")], [], [F.sum("n").alias("n")]
    for i, c in enumerate(names):
        v = ref(c)
        figures += [F.count(v).alias(f"c{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.bool_and(v == F.rint(v)).alias(f"w{i}"), _sketch(v).alias(f"s{i}")]
        last += [F.sum(f"c{i}").alias(f"c{i}"), F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"), F.bool_and(f"w{i}").alias(f"w{i}"), F.kll_merge_agg_double(f"s{i}").alias(f"s{i}")]
        kinds = {"rows": "n", "non_null": f"c{i}", "low": f"lo{i}", "high": f"hi{i}", "whole": f"w{i}", "sketch": f"s{i}"}
        entries.append(F.struct(F.lit(c).alias("column"), *[F.col(v).alias(k) for k, v in kinds.items()]))
    return _in_groups(doubles(df, names), *figures).agg(*last).select(F.inline(F.array(*entries)))


def stats_of_sketches(sketches: DataFrame) -> ColumnStats:
    """Counts and ranges of all parts of a table of ``column_sketches`` together."""
    merged = sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"), F.min("low").alias("low"), F.max("high").alias("high"), F.bool_and("whole").alias("whole")
    )
    rows = merged.collect()  # one row per column
    of = lambda key: {r["column"]: r[key] for r in rows}
    return ColumnStats(max((r["rows"] for r in rows), default=0), of("non_null"), of("low"), of("high"), of("whole"))


def _narrowed(data: DataFrame, brackets: list[_Bracket], known: DataFrame | None = None) -> list[_Bracket]:
    """Each bracket cut to about ``MARGIN`` of its rows: one scan of sketches, unless they are known, and one of counts."""
    ranges = _ranges(brackets)
    merge = lambda value: F.kll_merge_agg_double(value)
    if known is None:
        grouped = _in_groups(data, *[_sketch(F.when(_inside(*r), ref(r[0]))).alias(f"s{i}") for i, r in enumerate(ranges)])
        merged = grouped.agg(*[merge(F.col(f"s{i}")).alias(f"s{i}") for i in range(len(ranges))])
    else:
        merged = known.agg(*[merge(F.when(F.col("column") == r[0], F.col("sketch"))).alias(f"s{i}") for i, r in enumerate(ranges)])
    index = {r: i for i, r in enumerate(ranges)}
    asked = []
    for i, b in enumerate(brackets):
        sketch = F.col(f"s{index[b.column, b.low, b.high]}")
        for side, r, margin in (("l", b.ranks[0], -MARGIN / 2), ("h", b.ranks[-1], MARGIN / 2)):
            share = (r - b.below + 0.5) / b.rows + margin
            asked.append(F.kll_sketch_get_quantile_double(sketch, F.lit(min(max(share, 0.0), 1.0))).alias(f"{side}{i}"))
    guess = merged.select(*asked).first()
    spans = [(b.column, max(guess[f"l{i}"], b.low), min(guess[f"h{i}"], b.high)) for i, b in enumerate(brackets)]
    tallies = []
    for i, (column, low, high) in enumerate(spans):
        tallies += [F.count_if(ref(column) < low).alias(f"b{i}"), F.count_if(_inside(column, low, high)).alias(f"n{i}")]
    seen = data.agg(*tallies).first()
    out = []
    for i, (b, (column, low, high)) in enumerate(zip(brackets, spans)):
        below, upto = seen[f"b{i}"], seen[f"b{i}"] + seen[f"n{i}"]
        # a rank that the sketch has missed lies between the end of the span and the end of the bracket
        if b.ranks[0] < below:
            low, below = b.low, b.below
        if b.ranks[-1] >= upto:
            high, upto = b.high, b.below + b.rows
        out.append(_Bracket(column, b.ranks, low, high, below, upto - below))
    return out


def _read(data: DataFrame, brackets: list[_Bracket], coded: Collection[str] = ()) -> dict[tuple[str, int], float]:
    """Order statistics of brackets from the counts of their values.

    Counting is spread by range and value; a window then runs over the different values of one range. Columns of few values are counted whole;
    of the others only rows inside a range leave the scan.
    """
    ranges = _ranges(brackets)
    few = [i for i, r in enumerate(ranges) if r[0] in coded]
    some = [i for i, r in enumerate(ranges) if r[0] not in coded]
    parts = []
    if few:
        whole = data.select(*[ref(ranges[i][0]).alias(str(i)) for i in few])
        parts.append(whole.unpivot([], [str(i) for i in few], "range", "value").where("value IS NOT NULL").select(F.col("range").cast("int").alias("range"), "value"))
    if some:
        near = data.where(reduce(or_, [_inside(*ranges[i]) for i in some]))
        pairs = F.array(*[F.when(_inside(*ranges[i]), F.struct(F.lit(i).alias("range"), ref(ranges[i][0]).alias("value"))) for i in some])
        parts.append(near.select(F.explode(pairs).alias("v")).where("v IS NOT NULL").select("v.range", "v.value"))
    rows = reduce(DataFrame.unionByName, parts).groupBy("range", "value").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("range").orderBy("value")
    placed = rows.withColumn("upto", F.sum("n").over(own))
    index = {r: i for i, r in enumerate(ranges)}
    wanted = sorted({(index[b.column, b.low, b.high], r - b.below) for b in brackets for r in b.ranks})
    hits = F.filter(
        F.array(*[F.struct(F.lit(i).alias("range"), F.lit(r).cast("long").alias("rank")) for i, r in wanted]),
        lambda w: (w["range"] == F.col("range")) & (w["rank"] < F.col("upto")) & (w["rank"] >= F.col("upto") - F.col("n")),
    )
    values = {(r["range"], r["rank"]): r["value"] for r in placed.select("value", F.inline(hits)).collect()}
    return {(b.column, r): values[index[b.column, b.low, b.high], r - b.below] for b in brackets for r in b.ranks}


def medians(df: DataFrame, columns: Sequence[str], **options) -> dict[str, float | None]:
    """Exact median of each column."""
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5], **options).items()}


def means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Mean of each column, null where a column has no value; one aggregate."""
    columns = list(columns)
    if not columns:
        return {}
    row = df.agg(*[F.avg(as_double(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(columns)}
