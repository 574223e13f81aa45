"""Quality rules whose thresholds come from mergeable quantile sketches per language and source."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import words as W
from tallyframe.llm.base import bounded_broadcast, fresh, release_memory, saved

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent
GROWTH = 1.02  # relative width of a sketch bucket: quantiles are right to 1 %
REACH = 4.0  # the fence of word length lies this many spreads beyond its quartiles
ABOVE = 1.5  # the fence of a share is so many times the upper quantile among the documents of the group that have any of it
TOP = 100  # that quantile leaves out the highest one in so many documents, and one at least: a document is no evidence for itself
PRIOR = 50  # documents' worth of their language that each group is merged with, and languages of all documents
UNIT = 1_000_000  # weights are whole numbers of so many to a document, so that sums do not depend on order
BROADCAST_GROUPS = 10_000
# Least spread of word length; least fence of the shares: a share up to it is never a reason to reject.
FEATURES = {"symbol_share": 0.02, "dup_line_share": 0.1, "repeat_share": 0.15, "word_length": 0.5}
LOW_SIDE = ("word_length",)


def _sum_by(owner: np.ndarray, weight: np.ndarray | None, rows: int) -> np.ndarray:
    return np.bincount(owner, weights=weight, minlength=rows).astype(np.int64)


def _measure(texts: pa.Array) -> dict[str, np.ndarray]:
    rows = len(texts)
    texts = pc.fill_null(texts, "")
    words, starts = W.split_words(texts)
    owner = W.owners(starts)
    hashes = W.hash_strings(words)
    out = {"n_words": np.diff(starts), "word_chars": _sum_by(owner, np.asarray(pc.utf8_length(words)).astype(np.float64), rows)}
    out["n_symbols"] = np.asarray(pc.count_substring_regex(texts, SYMBOLS)).astype(np.int64)

    at = W.windows(starts, WINDOW)
    runs = W.segment_hashes(hashes, at, at + WINDOW)
    order = np.lexsort((runs, owner[at]))
    text_of, run_of = owner[at][order], runs[order]
    equal = (text_of[1:] == text_of[:-1]) & (run_of[1:] == run_of[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    marks = np.zeros(len(owner) + 1, np.int32)
    first = at[order[twice]]
    np.add.at(marks, first, 1)
    np.add.at(marks, first + WINDOW, -1)
    out["n_repeat_words"] = _sum_by(owner[np.cumsum(marks[:-1]) > 0], None, rows)

    lists = pc.split_pattern(texts, "\n")
    line_starts = np.asarray(lists.offsets).astype(np.int64)
    lines = lists.values
    line_owner = W.owners(line_starts)
    filled = np.asarray(pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0)).astype(bool)
    line_hash = W.hash_strings(lines)
    picked = np.flatnonzero(filled)
    order = picked[np.lexsort((picked, line_hash[picked], line_owner[picked]))]
    again = (line_owner[order][1:] == line_owner[order][:-1]) & (line_hash[order][1:] == line_hash[order][:-1])
    out["n_dup_lines"] = _sum_by(line_owner[order[1:][again]], None, rows)
    out["n_lines"] = _sum_by(line_owner, None, rows)
    return out


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of ``BASE`` added as longs; null text counts as empty. Columns of these names are replaced."""
    docs = docs.select(*[c for c in docs.columns if c.lower() not in BASE])
    schema = T.StructType(docs.schema.fields + [T.StructField(n, T.LongType()) for n in BASE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for start, stop in W.text_slices(texts):
                counts = _measure(texts.slice(start, stop - start))
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(counts[n], pa.int64()) for n in BASE]], names=[*batch.schema.names, *BASE]
                )
        release_memory()

    return docs.mapInArrow(run, schema)


def _share(part: str, whole: Column) -> Column:
    return F.when(whole > 0, F.col(part) / whole).otherwise(F.lit(0.0))


def features() -> dict[str, Column]:
    words = F.col("n_words")
    return {
        "symbol_share": _share("n_symbols", F.col("word_chars")),
        "dup_line_share": _share("n_dup_lines", F.col("n_lines")),
        "repeat_share": _share("n_repeat_words", words),
        "word_length": _share("word_chars", words),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


def bucket(x: Column) -> Column:
    """Number of the logarithmic bucket of a value not below 0; null for 0."""
    return F.when(x > 0, F.ceil(F.log(x) / math.log(GROWTH)))


def sketch_rows(counts: DataFrame) -> DataFrame:
    """(lang, source, feature, bucket, n): the sketches of all groups. Adding ``n`` over groups merges their sketches."""
    values = F.array(*[F.struct(F.lit(name).alias("feature"), bucket(value).alias("bucket")) for name, value in features().items()])
    rows = counts.where(~base_failed()).select("lang", "source", F.explode(values).alias("v"))
    return rows.groupBy("lang", "source", "v.feature", "v.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(lang, source, feature, bucket, w, one): each group's sketch merged with ``prior`` documents' worth of its language's, in ``UNIT`` a document.

    The language's sketch is merged in the same way with that of all documents. Merging is adding up, and is alike for groups of any size: what a
    group's own documents show takes over as they become more. ``one`` is what a single document of the group adds to it in all.
    """
    per = Window.partitionBy("feature")
    every = sketch.groupBy("feature", "bucket").agg(F.sum("n").alias("n"))
    every = every.select("feature", "bucket", (F.col("n").cast("double") / F.sum("n").over(per)).alias("p"), F.sum("n").over(per).alias("all"))
    langs = sketch.groupBy("lang", "feature").agg(F.sum("n").alias("total")).withColumnsRenamed({"feature": "of"})
    wide = langs.join(every, F.col("of") == F.col("feature")).select("lang", "feature", "bucket", "total", "all", "p", F.lit(0).cast("long").alias("n"))
    none = F.lit(0).cast("long")
    own = sketch.select("lang", "feature", "bucket", none.alias("total"), none.alias("all"), F.lit(0.0).alias("p"), "n")
    largest = [F.max(c).alias(c) for c in ("p", "total", "all")]
    lang = wide.unionByName(own).groupBy("lang", "feature", "bucket").agg(F.sum("n").alias("n"), *largest)
    worth = lambda n, p: F.floor(F.lit(float(prior * UNIT)) * ((n + F.lit(float(prior)) * p) / (F.col("total") + F.lit(float(prior)))))
    one = worth(F.lit(1), 1.0 / F.col("all")) + (UNIT + 1)  # and what rounding down may hide
    lang = lang.select(F.col("lang").alias("in_lang"), F.col("feature").alias("of"), "bucket", worth(F.col("n"), F.col("p")).alias("w"), one.alias("one"))
    groups = sketch.select("lang", "source", "feature").distinct()
    inherited = groups.join(lang, F.col("lang").eqNullSafe(F.col("in_lang")) & (F.col("feature") == F.col("of")))
    rows = inherited.select("lang", "source", "feature", "bucket", "w", "one")
    rows = rows.unionByName(sketch.select("lang", "source", "feature", "bucket", (F.col("n") * UNIT).alias("w"), none.alias("one")))
    return rows.groupBy("lang", "source", "feature", "bucket").agg(F.sum("w").alias("w"), F.max("one").alias("one"))


def thresholds(counts: DataFrame, prior: int = PRIOR, reach: float = REACH) -> DataFrame:
    """(lang, source, feature, low, high): what documents of the group may have. A window holds the buckets of one group: some thousand at most."""
    keys = ["lang", "source", "feature"]
    group = Window.partitionBy(*keys)
    ranked = merged(saved(sketch_rows(counts), "sketch"), prior).withColumn("upto", F.sum("w").over(group.orderBy(F.col("bucket").asc_nulls_first())))
    zero = F.sum(F.when(F.col("bucket").isNull(), F.col("w"))).over(group)
    ranked = ranked.withColumn("total", F.sum("w").over(group)).withColumn("zeros", F.coalesce(zero, F.lit(0)))
    edge = F.pow(F.lit(GROWTH), F.col("bucket"))
    middle = F.when(F.col("bucket").isNull(), F.lit(0.0)).otherwise(2 * edge / (GROWTH + 1))
    value = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, middle))
    some = F.col("total") - F.col("zeros")
    rank = some - F.greatest(F.floor(some / TOP), F.max("one").over(group))
    ranked = ranked.withColumn("rank", rank)
    over = F.col("bucket").isNotNull() & (F.col("rank") > 0) & (F.col("upto") - F.col("zeros") >= F.col("rank"))
    found = ranked.groupBy(*keys).agg(value(1).alias("q25"), value(3).alias("q75"), F.min(F.when(over, edge)).alias("upper"))
    least = F.element_at(F.create_map(*[F.lit(x) for pair in FEATURES.items() for x in pair]), F.col("feature"))
    spread = F.greatest(F.col("q75") - F.col("q25"), least) * reach
    high = F.when(F.col("feature").isin(*LOW_SIDE), F.col("q75") + spread).otherwise(F.greatest(F.col("upper") * ABOVE, least))
    low = F.when(F.col("feature").isin(*LOW_SIDE), F.col("q25") - spread)
    return found.select(*keys, low.alias("low"), high.alias("high"))


def judged(docs: DataFrame, prior: int = PRIOR, reach: float = REACH, with_text: bool = True) -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and ``kept``; without ``text`` if it is not wanted, so that no copy of it is written.

    Four features of each document (symbols per character of words, repeated lines, words in repeated windows, mean word length) are
    sketched per language and source over all documents that pass the base rule: counts of logarithmic buckets, which merge by adding up,
    do not depend on order, and give every quantile to 1 %. Each group's sketch is merged with that of its language (see ``merged``). A
    document is kept if it passes the base rule, no share is above ``ABOVE`` times the upper quantile among its group's documents that have
    any of it (or a least fence), and its word length lies within ``reach`` spreads (quartile ranges, of a least width) of its group's quartiles.

    Null text is empty: no words, base rule failed. Null ``lang`` and null ``source`` are values like any other. Very long texts are
    measured whole. Every row is judged by itself, so repeated rows get equal verdicts; a value on a fence is kept. An empty table gives an empty table.
    """
    wanted = measured(docs)
    counts = saved(wanted if with_text else wanted.drop("text"), "quality")
    fences = thresholds(counts, prior, reach)
    wide = fences.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("feature") == f, F.col(side))).alias(f"{side}_{f}") for f in FEATURES for side in ("low", "high")]
    )
    names = {c: fresh(counts, f"fence_{c}") for c in wide.columns}
    wide = bounded_broadcast(saved(wide.withColumnsRenamed(names), "fences"), BROADCAST_GROUPS)
    on = counts["lang"].eqNullSafe(wide[names["lang"]]) & counts["source"].eqNullSafe(wide[names["source"]])
    inside = F.lit(True)
    for name, value in features().items():
        inside = inside & F.coalesce(value <= F.col(names[f"high_{name}"]), F.lit(True)) & F.coalesce(value >= F.col(names[f"low_{name}"]), F.lit(True))
    both = counts.join(wide, on, "left")
    keep = [c for c in counts.columns if c.lower() not in ("base_failed", "kept")]
    return both.select(*keep, base_failed().alias("base_failed"), (~base_failed() & inside).alias("kept"))


def filtered(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, columns unchanged."""
    inner = docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns if c.lower() in (*BASE, "base_failed", "kept")})
    kept = judged(inner, **options).where("kept")
    return kept.select(*[F.col(i).alias(c) for i, c in zip(inner.columns, docs.columns)])
