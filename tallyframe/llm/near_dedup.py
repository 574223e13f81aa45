"""Near-duplicate documents from bottom-k sketches of one hash function."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import words as W
from tallyframe.llm.base import bounded_broadcast, fresh, release_memory, saved, spread_join
from tallyframe.llm.components import components

SHINGLE = 5
PERCENT = 80
SKETCH = 256  # smallest hashes kept of a document, for estimates
LISTED = 24  # of these, how many take part in inverted lists, which are kept for pairs of neighbours among them
BLOCK = 512  # documents of a list that are compared in one block
CELLS_AT_ONCE = 4_000  # rows that one group of blocks holds, about
SIGMAS = 5.0
MISSED = 1e-9  # probability with which an estimate may drop a pair that reaches the threshold
BROADCAST_IDS = 500_000
BROADCAST_SKETCHES = 10_000
BROADCAST_HEADS = 100_000
BROADCAST_LOST = 2_000_000  # ids of documents that go: about 100 MB in a task, against a shuffle of all texts
_MARK = np.uint64(0x5851F42D4C957F2D)
_HALF = np.uint64(32)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``size`` lower-cased words; of all words if they are fewer; none without words."""
    words, starts = W.split_words(texts, lower=True)
    hashes = W.hash_strings(words)
    at = W.windows(starts, size)
    runs = W.segment_hashes(hashes, at, at + size)
    bounds = np.searchsorted(at, starts)
    for row in range(len(starts) - 1):
        own = runs[bounds[row] : bounds[row + 1]]
        if not len(own) and starts[row + 1] > starts[row]:
            own = W.segment_hashes(hashes, starts[row : row + 1], starts[row + 1 : row + 2]) ^ _MARK
        yield np.unique(own)


def listed_values(low: np.ndarray, listed: int = LISTED) -> np.ndarray:
    """One number for each two neighbours among the first ``listed`` of a sketch: the names of its inverted lists."""
    head = low[:listed].astype(np.uint64)
    return W.mix(head[:-1] << _HALF | head[1:]).view(np.int64)


def sketches(docs: DataFrame, shingle: int = SHINGLE, sketch: int = SKETCH, listed: int = LISTED) -> DataFrame:
    """(doc_id, n, set_a, set_b, sketch, listed): size of the shingle set, 128 bits of it, and its smallest hashes.

    ``sketch`` holds the upper halves of the smallest hashes as bytes. ``listed`` has one number for each two neighbours among the first
    ``listed`` of them: a pair of neighbours is shared by chance far more rarely than one frequent shingle.
    """
    kind = docs.schema["doc_id"].dataType
    longs = T.LongType()
    fields = [("doc_id", kind), ("n", longs), ("set_a", longs), ("set_b", longs), ("sketch", T.BinaryType()), ("listed", T.ArrayType(longs))]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in W.text_slices(batch.column(1)):
                rows = []
                for own in shingle_sets(batch.column(1).slice(start, stop - start), shingle):
                    digest = xxhash.xxh3_128_digest(own.tobytes())
                    a, b = np.frombuffer(digest, np.int64).tolist()
                    low = (own[:sketch] >> _HALF).astype(np.uint32)
                    rows.append((len(own), a, b, low.tobytes(), listed_values(low, listed)))
                columns = list(zip(*rows))
                arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *arrays], names=schema.names)
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[float, float]:
    """Jaccard similarity estimated from the union of two bottom-k sketches, and its standard error (0 if the sketches are whole sets)."""
    edge = min([x[-1] for x, n in ((a, n_a), (b, n_b)) if n > len(x)], default=None)
    if edge is not None:
        a, b = a[: np.searchsorted(a, edge, "right")], b[: np.searchsorted(b, edge, "right")]
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    value = common / union if union else 0.0
    return value, 0.0 if edge is None else (0.25 / max(union, 1)) ** 0.5


@lru_cache(1 << 16)
def most_apart(seen: int, sizes: int, percent: int) -> int:
    """Most of the ``seen`` least hashes of a union that only one of two sets can have, if they reach ``percent``; ``sizes`` is the sum of theirs.

    Their similarity bounds how many of the whole union only one has. The seen ones are drawn from the union without replacement, so how
    many of these are among them is hypergeometric; more than returned have a probability of at most ``MISSED``.
    """
    apart = sizes * (100 - percent) // (100 + percent)
    apart -= (sizes - apart) % 2
    union = (sizes + apart) // 2
    if seen >= union:
        return apart
    choose = lambda n, k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
    most, beyond = min(seen, apart), 0.0
    while most > max(0, seen - (union - apart)):
        beyond += exp(choose(apart, most) + choose(union - apart, seen - most) - choose(union, seen))
        if beyond > MISSED:
            break
        most -= 1
    return most


def may_reach(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Whether sets of ``n_a`` and ``n_b`` shingles with these sketches may reach ``percent``: certain if the sketches are whole sets."""
    held = min([len(x) for x, n in ((a, n_a), (b, n_b)) if n > len(x)], default=None)
    times = np.unique(np.concatenate([a, b]), return_counts=True)[1][:held]
    common = int((times == 2).sum())
    if held is None:
        return common > 0 and 100 * common >= percent * len(times)
    return len(times) - common <= most_apart(len(times), int(n_a) + int(n_b), percent)


def _unpacked(values) -> list[np.ndarray]:
    return [np.unique(np.frombuffer(x, np.uint32)) for x in values]


class _Forest:
    """Groups of a block's documents that certain links have joined."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _common_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Common values of all pairs of sets, by products of 0/1 tables of at most ``width`` values, so memory is bounded."""
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(where, minlength=len(values)) > 1
    place = (np.cumsum(shared) - 1)[where]
    picked = np.flatnonzero(shared[where])
    picked = picked[np.argsort(place[picked], kind="stable")]
    row, column = owner[picked], place[picked]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(shared.sum()), width):
        low, high = np.searchsorted(column, [first, first + width])
        table = np.zeros((len(sets), min(width, int(shared.sum()) - first)), np.float32)
        table[row[low:high], column[low:high] - first] = 1
        common += table @ table.T
    return common


def _block_pairs(
    value: int, rep: np.ndarray, n: np.ndarray, group: np.ndarray, packed: list, left: np.ndarray, right: np.ndarray, percent: int
) -> Iterator[tuple[int, int]]:
    """Pairs of a block of the list ``value`` that may reach ``percent``: one document from each side, not yet in one component.

    Pairs whose sketches are whole sets are certain, and so are estimates ``SIGMAS`` standard errors above the threshold; of these, only as
    many as connect the block. The others are first held against the least number of common hashes that the estimate can need, and
    estimated in the least of all lists that have both: they meet in each of these, as none can be settled that parts two components.
    """
    sets = _unpacked(packed)
    held = np.array([len(s) for s in sets])
    common = _common_counts(sets)
    small, large = np.minimum(n[:, None], n[None]), np.maximum(n[:, None], n[None])
    open_ = (left[:, None] & right[None]) & (group[:, None] != group[None]) & (100 * small >= percent * large)
    whole = held >= n
    certain = whole[:, None] & whole[None]
    least = np.minimum(held[:, None], held[None])
    needed = least - (n[:, None] + n[None]) * ((100 - percent) / (100 + percent))
    open_ &= np.where(certain, 100 * common >= percent * (held[:, None] + held[None] - common), common >= needed)
    open_ = np.triu(open_ | open_.T, 1)
    forest = _Forest(len(rep))
    for i, j in zip(*np.nonzero(open_ & certain)):
        if forest.join(i, j):
            yield int(rep[i]), int(rep[j])
    lists: dict[int, set[int]] = {}
    for i, j in zip(*(x.tolist() for x in np.nonzero(open_ & ~certain))):
        if forest.root(i) != forest.root(j):
            for k in (i, j):
                if k not in lists:
                    lists[k] = set(listed_values(np.frombuffer(packed[k], np.uint32)).tolist())
            if min(lists[i] & lists[j], default=value) == value and may_reach(sets[i], sets[j], n[i], n[j], percent):
                yield int(rep[i]), int(rep[j])
                seen, error = estimate(sets[i], sets[j], n[i], n[j])
                if 100 * (seen - SIGMAS * error) >= percent:
                    forest.join(i, j)


def block_candidates(rows: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, that may be similar, from rows (value, a, rep, component, left) and the sketches (rep, n, sketch) of their ``rep``.

    A row of a list stands on the left if its links are open, and on the right always. Both sides of a list are cut into blocks of about
    ``BLOCK`` rows; each left block meets each right block in one task, so no list is gathered and its pairs are not rows of a join.
    Lists with one least member ``a``, of which there are ``LISTED`` at most, mostly have the same others and go to one task, where a
    sketch comes once for all rows of its ``rep``.
    """
    sizes = rows.groupBy("value").agg(F.sum(F.col("left").cast("int")).alias("n_left"), F.count("*").alias("n_right"))
    parts = lambda c: F.floor((F.col(c) + BLOCK - 1) / BLOCK).cast("int")
    sized = rows.join(sizes, "value").withColumn("p", parts("n_left")).withColumn("q", parts("n_right")).drop("n_left", "n_right")
    mine = lambda c: F.pmod(F.xxhash64("rep", F.lit(3)), F.col(c)).cast("int")
    cell = lambda i, j, left, right: F.struct(i.alias("i"), j.alias("j"), left.alias("as_left"), right.alias("as_right"))
    as_right = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda i: cell(i, mine("q"), F.lit(False), F.lit(True)))
    as_left = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda j: cell(mine("p"), j, F.lit(True), j == mine("q")))
    cells = F.when(F.col("left"), F.concat(as_left, F.filter(as_right, lambda c: c["i"] != mine("p")))).otherwise(as_right)
    dealt = saved(sized.where("p > 0").withColumn("cell", F.explode(cells)).select("value", "a", "rep", "component", "cell.*"), "cells")
    schema = "a long, b long"

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        found = []
        is_row = block["sketch"].isna()
        block = block.loc[is_row].drop(columns=["n", "sketch"]).merge(block.loc[~is_row, ["rep", "n", "sketch"]], on="rep")
        value, i, j, rep = (block[c].to_numpy() for c in ("value", "i", "j", "rep"))
        order = np.lexsort((rep, j, i, value))
        new_cell = np.ones(len(order), bool)
        new_cell[1:] = False
        for c in (value, i, j):
            new_cell[1:] |= c[order][1:] != c[order][:-1]
        left, right, n, group, packed = (block[c].to_numpy() for c in ("as_left", "as_right", "n", "component", "sketch"))
        bounds = [*np.flatnonzero(new_cell).tolist(), len(order)]
        for a, b in zip(bounds, bounds[1:]):
            if b - a > 1:
                own = order[a:b]
                found += _block_pairs(int(value[own[0]]), rep[own], n[own], group[own], packed[own].tolist(), left[own], right[own], percent)
        return pd.DataFrame([(min(p), max(p)) for p in found], columns=["a", "b"], dtype="int64")

    key = F.pmod(F.xxhash64("a", "i", "j"), F.lit(dealt.count() // CELLS_AT_ONCE + 1))
    rows = dealt.withColumn("bucket", key).drop("a")
    once = rows.select("bucket", "rep").distinct().join(sketched.select("rep", "n", "sketch"), "rep")
    # zeros, not nulls: pandas holds longs with nulls as doubles, which have too few digits for ``value``
    blank = [F.lit(0).cast(rows.schema[c].dataType).alias(c) for c in ("value", "component", "i", "j", "as_left", "as_right")]
    once = once.select("bucket", "rep", *blank, "n", "sketch")
    return rows.withColumn("n", F.lit(0).cast("long")).withColumn("sketch", F.lit(None).cast("binary")).unionByName(once).groupBy("bucket").applyInPandas(compare, schema).distinct()


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those ``pairs`` (a, b) whose whole shingle sets have 100 * intersection >= ``percent`` * union."""
    pairs = saved(pairs, "pairs")
    wanted = saved(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(bounded_broadcast(wanted, BROADCAST_IDS), "id")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in W.text_slices(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(batch.column(1).slice(start, stop - start), shingle)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(sets, pa.binary())], names=["id", "hashes"])

    sets = saved(texts.mapInArrow(sets_of, "id long, hashes binary"), "sets")
    one, other = (sets.select(F.col("id").alias(c), F.col("hashes").alias(f"set_{c}")) for c in "ab")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = (batch.column(batch.schema.get_field_index(n)) for n in ("a", "b", "set_a", "set_b"))
            keep = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release_memory()

    return saved(pairs.join(one, "a").join(other, "b").mapInArrow(check, "a long, b long"), "confirmed")


def _meetings(classes: DataFrame) -> DataFrame:
    """(value, many, a, rep): the entries of each inverted list of several members, with its least member ``a``, which has no row of its own.

    Entries are dealt by list once, for their minima and for the join with these.
    """
    entries = classes.select("rep", F.explode(F.array_distinct("listed")).alias("value")).where("rep IS NOT NULL").repartition("value")
    heads = entries.groupBy("value").agg(F.min("rep").alias("a"), F.count("*").alias("many")).where("many > 1")
    return saved(entries.join(heads, "value").where("a <> rep").select("value", "many", "a", "rep"), "met")


def _sketches_of(ids: DataFrame, classes: DataFrame, own: DataFrame) -> DataFrame:
    """(rep, n, sketch) of the representatives in ``ids`` (rep). Sketches are read from ``own``, so the others' are never shuffled."""
    sets = ["set_a", "set_b", "n"]
    named = classes.join(bounded_broadcast(ids, BROADCAST_IDS), "rep", "left_semi").select("rep", *sets)
    wanted = bounded_broadcast(saved(named, "wanted-sketches"), BROADCAST_IDS)
    return own.withColumn("rep", F.col("doc_id").cast("long")).join(wanted, ["rep", *sets]).select("rep", "n", "sketch")


def _promising_links(pairs: DataFrame, sketched: DataFrame, percent: int, most_rows: int) -> DataFrame:
    """Those ``pairs`` whose sketches (rep, n, sketch) do not rule out ``percent``. A hub of very many pairs meets them by broadcast."""
    sides = [sketched.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}")) for c in "ab"]
    hubs = saved(pairs.groupBy("a").agg(F.count("*").alias("pairs")).join(sides[0], "a"), "hubs")
    met = spread_join(pairs, hubs, ["a"], "pairs", pairs.count(), most_rows=most_rows).join(sides[1], "b")

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, s_a, s_b = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "n_a", "n_b", "s_a", "s_b"))
            keep = []
            for left, right, x, y in zip(s_a, s_b, n_a.to_pylist(), n_b.to_pylist()):
                keep.append(may_reach(*_unpacked((left.as_buffer(), right.as_buffer())), x, y, percent))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    similar = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return met.where(similar).mapInArrow(promising, "a long, b long")


def _star_links(meetings: DataFrame, classes: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of each representative and the least member of each inverted list that it is in, which may reach ``percent``.

    Most share a list by chance. The first ``LISTED`` hashes, a sketch themselves, rule these out, so whole sketches move for the rest alone.
    """
    stars = saved(meetings.select("a", F.col("rep").alias("b")).distinct(), "stars")
    heads = classes.select("rep", "n", F.col("head").alias("sketch"))
    left = saved(_promising_links(stars, heads, percent, BROADCAST_HEADS), "star-heads")
    ids = saved(left.select(F.col("a").alias("rep")).union(left.select(F.col("b").alias("rep"))).distinct(), "star-ids")
    return _promising_links(left, _sketches_of(ids, classes, own), percent, BROADCAST_SKETCHES)


def _open_lists(meetings: DataFrame, joined: DataFrame) -> DataFrame:
    """(value, a, rep, component, left) of the inverted lists whose members, without the least one, are not all in one component.

    The least member has been held against all others, so its pairs are decided. ``left`` marks the members outside the largest
    component of the list: each pair that is neither joined nor decided has one of them.
    """
    several = meetings.where("many > 2").select("value", "a", "rep")
    found = several.join(bounded_broadcast(joined, BROADCAST_IDS), F.col("rep") == F.col("node"), "left")
    entries = saved(found.select("value", "a", "rep", F.coalesce("component", "rep").alias("component")), "entries")
    ends = entries.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rows = saved(entries.join(ends.where("low <> high").select("value"), "value"), "lists")
    shares = rows.groupBy("value", "component").agg(F.count("*").alias("share"))
    largest = shares.groupBy("value").agg(F.max(F.struct("share", "component")).alias("top"))
    return rows.join(largest.select("value", F.col("top.component").alias("top")), "value").withColumn("left", F.col("component") != F.col("top")).drop("top")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the near-duplicate class of each document.

    Documents whose sets of ``shingle``-word shingles are equal collapse into one representative first. Each two neighbours
    among its ``LISTED`` smallest hashes name an inverted list. Of the smallest hashes in the union of two similar sets, each is common with the
    probability of the similarity, and two common ones in a row are neighbours in both sets, so a pair at 0.85 misses all its lists with
    a probability of 5e-09, one at 0.8 of 2e-07; sets of up to ``LISTED`` shingles miss none. All members of a list
    are first held against its least one, which joins most groups of copies. Only lists whose other members are not in one component then go on: their
    members outside the largest component are compared with all of these, in blocks. The union of both sketches drops a pair that
    reaches the threshold with a probability of ``MISSED`` at most, and so do their first ``LISTED`` hashes; the rest is confirmed on whole sets.

    Null or empty texts and those of blanks only have no shingles and are linked with nothing; so is a null ``doc_id``, whose component is
    null. Rows with one ``doc_id`` should have one text; of several, each gives a row, and the least set by hash stands for the document in
    its component. An empty table gives an empty table. Other columns are not read.
    """
    own = saved(sketches(docs, shingle), "sketches")
    classes = own.where("n > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b", "n").agg(
        F.min("doc_id").cast("long").alias("rep"), F.first(F.substring("sketch", 1, 4 * LISTED)).alias("head"), F.first("listed").alias("listed")
    )
    classes = saved(classes, "classes")
    meetings = _meetings(classes)
    links = confirmed(_star_links(meetings, classes, own, percent), docs, shingle, percent)
    lists = saved(_open_lists(meetings, saved(components(links), "joined")), "open")
    wanted = saved(lists.select("rep").distinct(), "listed")
    candidates = block_candidates(lists, _sketches_of(wanted, classes, own), percent)
    more = confirmed(candidates, docs, shingle, percent)
    joined = components(links.union(more))
    grouped = classes.join(joined, classes["rep"] == joined["node"], "left").select(
        "set_a", "set_b", "n", F.coalesce("component", "rep").alias("component_id")
    )
    members = own.join(grouped, ["set_a", "set_b", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id").cast("long"))
    return members.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those that another document of their component stands for; columns unchanged.

    Rows with one ``doc_id`` are one document, and go if one of them does; of such rows with one text, one stays. A row without
    ``doc_id`` stays. Very long texts are compared whole. An empty table gives an empty table.
    """
    key = fresh(docs, "lost_id")
    found = saved(near_duplicates(docs, shingle, percent), "near-duplicates")
    lost = saved(found.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct(), "lost")
    left = docs.join(bounded_broadcast(lost, BROADCAST_LOST), docs["doc_id"] == lost[key], "left_anti")
    again = found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("n")).where("n > 1").select(key)
    if not again.limit(1).count():
        return left
    again = saved(again, "repeated-ids")
    once = left.join(again, left["doc_id"] == again[key], "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(again, left["doc_id"] == again[key], "left_anti").unionByName(once)
