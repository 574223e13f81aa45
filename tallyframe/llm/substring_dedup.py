"""Substring deduplication: documents are parsed against an index of all reference blocks, and long factors are cut out."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import words as W
from tallyframe.llm.base import bounded_broadcast, saved, spread_join

WINDOW = 50
BROADCAST_IDS = 500_000
BROADCAST_BLOCKS = 100_000


def _least(hashes: np.ndarray, count: int) -> np.ndarray:
    """Position of the least (of equals, the first) of each run of ``count`` neighbours, by doubling."""
    at, have = np.arange(len(hashes)), 1
    while have < count:
        step = min(have, count - have)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(hashes[left] <= hashes[right], left, right)
        have += step
    return at


def zones_of(hashes: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Zones of all texts: (first window, windows, block hash, zone hash).

    A block is half a window long. Every window chooses the block in it with the least hash, so equal windows choose equal blocks.
    Neighbouring windows with the same choice are a zone; its hash covers all its words and the place of the block.
    """
    block = window // 2
    at = W.windows(starts, window)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    places = np.arange(len(hashes) - block + 1)
    blocks = W.segment_hashes(hashes, places, places + block)
    chosen = _least(blocks, window - block + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    begin, key = at[first], chosen[first]
    whole = W.segment_hashes(hashes, begin, begin + count - 1 + window)
    place = ((key - begin) * window + count).astype(np.uint64)
    return begin, count, blocks[key], W.mix(whole ^ W.mix(place))


def _zone_rows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, zones): each document's zones as parallel arrays; only documents of at least one window."""
    schema = T.StructType.fromDDL("doc_id bigint, block array<bigint>, zone array<bigint>, start array<int>, n array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in W.text_slices(batch.column(1)):
                words, starts = W.split_words(batch.column(1).slice(a, b - a))
                begin, count, block, zone = zones_of(W.hash_strings(words), starts, window)
                row = np.searchsorted(starts, begin, "right") - 1
                bounds = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
                values = (block.view(np.int64), zone.view(np.int64), (begin - starts[row]).astype(np.int32), count.astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in values]
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *lists], names=schema.names)
                yield out.filter(pc.greater(pc.list_value_length(lists[0]), 0))

    ids = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, schema)


def _window_rows(docs: DataFrame, zones: DataFrame, window: int) -> DataFrame:
    """(block, key, doc_id, start): each window of the given zones (doc_id, start, n, block)."""
    per_doc = saved(zones.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "block")).alias("zones")), "open-zones")
    ids = per_doc.select(F.col("doc_id").alias("id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(bounded_broadcast(ids, BROADCAST_IDS), "id")
    both = texts.join(per_doc.withColumnRenamed("doc_id", "id"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in W.text_slices(batch.column(1)):
                words, starts = W.split_words(batch.column(1).slice(a, b - a))
                hashes = W.hash_strings(words)
                lists = batch.column(2).slice(a, b - a)
                sizes = np.asarray(pc.list_value_length(lists)).astype(np.int64)
                flat = lists.flatten()
                first, n, block = (np.asarray(flat.field(c)).astype(np.int64) for c in ("start", "n", "block"))
                row = np.repeat(np.repeat(np.arange(b - a), sizes), n)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(first, n) + step
                key = W.segment_hashes(hashes, starts[row] + at, starts[row] + at + window)
                ids_ = batch.column(0).slice(a, b - a).take(pa.array(row))
                columns = [pa.array(np.repeat(block, n)), pa.array(key.view(np.int64)), ids_, pa.array(at.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "key", "doc_id", "start"])

    return both.mapInArrow(run, "block bigint, key bigint, doc_id bigint, start int")


def factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, n, source): ``n`` windows of the document from word ``start`` on that also start in the earlier document ``source``.

    This is relative Lempel-Ziv parsing with content-defined reference blocks. The index of all documents' blocks is a table spread by
    block hash. A document's longest pieces around a block, its zones, are looked up whole: the document with the least id that has
    the zone is its source. What is left are zones at the boundaries of factors, where the same block is known with other words
    around it. Those are checked window by window, one document for each different zone, so copies never multiply work.
    """
    parsed = saved(_zone_rows(docs, window), "zones")
    rows = parsed.select("doc_id", F.inline(F.arrays_zip("block", "zone", "start", "n")))
    meet = lambda rows, groups, keys: spread_join(rows, groups, keys, "rows", rows.count(), most_rows=BROADCAST_BLOCKS).where("rows IS NOT NULL").drop("rows")
    known = rows.groupBy("block").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("rows")).where("least < most")
    shared = saved(meet(rows, saved(known.select("block", "rows"), "blocks"), ["block"]), "shared-zones")
    zones = saved(shared.groupBy("block", "zone").agg(F.min("doc_id").alias("source"), F.count("*").alias("rows")), "index")
    several = zones.groupBy("block").agg(F.count("*").alias("different")).where("different > 1").select("block", F.lit(True).alias("open"))
    index = saved(zones.join(several, "block", "left"), "open-index")
    placed = saved(meet(shared, index, ["block", "zone"]), "placed-zones")
    whole = placed.where("doc_id > source").select("doc_id", "start", "n", "source")
    open_ = placed.where("doc_id = source AND open").select("doc_id", "start", "n", "block")
    windows = saved(_window_rows(docs, open_, window), "open-windows")
    least = windows.groupBy("block", "key").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("most"), F.count("*").alias("rows")).where("source < most").drop("most")
    checked = meet(windows, saved(least, "open-sources"), ["block", "key"]).where("doc_id > source").select("doc_id", "start", F.lit(1).alias("n"), "source")
    return whole.union(checked)


def greedy_parse(cut: np.ndarray, window: int) -> list[dict[str, int]]:
    """Factors of one document from rows (start, n, source): n windows from ``start`` on that the source has as well.

    From each position the longest match is taken, of equals that with the least source, and the next factor begins after it. Where no match begins, the
    boundary is checked: a window that begins inside the factor before it and reaches over its end belongs to a match, whose rest is the
    next factor. All other words are literals. So factors lie side by side and cover just the words of all matched windows.
    """
    runs: dict[int, list[list[int]]] = {}  # of each source: first and last window
    for start, n, source in cut[np.lexsort((cut[:, 0], cut[:, 2]))].tolist():
        own = runs.setdefault(source, [])
        if own and start <= own[-1][1] + 1:
            own[-1][1] = max(own[-1][1], start + n - 1)
        else:
            own.append([start, start + n - 1])
    matches = sorted((first, last, source) for source, own in runs.items() for first, last in own)
    out, at, i = [], 0, 0
    held: list[tuple[int, int, int]] = []  # matches that reach beyond ``at``: (-last window, source, first window)
    while i < len(matches) or held:
        while i < len(matches) and matches[i][0] <= at:
            heapq.heappush(held, (-matches[i][1], matches[i][2], matches[i][0]))
            i += 1
        while held and window - held[0][0] <= at:
            heapq.heappop(held)
        if held:
            # the match that reaches farthest is the longest from here, whether a window begins here or began before the boundary
            end = window - held[0][0]
            out.append({"start": at, "words": end - at, "source": held[0][1]})
            at = end
        elif i < len(matches):
            at = matches[i][0]
    return out


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_words, n_removed, spans): each document's words that stay, joined by one space, and the spans cut out.

    Words are runs of anything but blanks. A word goes if it lies in a run of ``window`` words that also starts in a document with a
    smaller ``doc_id``; runs are judged on the texts as they come in. ``spans`` lists the factors of the greedy parse in order: first word,
    words and source. They lie side by side, and are words of the source, unless a boundary cuts a match short at its beginning.

    Null or empty text has no words. A document without ``doc_id`` has no order: it loses nothing and is no source. Rows with one
    ``doc_id`` should be equal, and lose nothing to each other. Texts shorter than a window lose nothing. A very long text is parsed whole. Of
    matches that tie, the least source counts. An empty table gives an empty table. Other columns are not returned.
    """
    found = saved(factors(docs, window).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "source")).alias("cut")), "factors")
    base = docs.select("doc_id", "text")
    both = base.join(found.withColumnRenamed("doc_id", "cut_id"), base["doc_id"] == F.col("cut_id"), "left").select("doc_id", "text", "cut")
    span = T.ArrayType(T.StructType.fromDDL("start bigint, words bigint, source bigint"))
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("text string, n_words bigint, n_removed bigint").fields, T.StructField("spans", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in W.text_slices(batch.column(1)):
                words, starts = W.split_words(batch.column(1).slice(a, b - a))
                lists = batch.column(2).slice(a, b - a)
                gone = np.zeros(len(words) + 1, np.int32)
                spans: list[list[dict[str, int]]] = [[] for _ in range(b - a)]
                for row in np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(lists), 0))):
                    flat = lists[int(row)].values
                    cut = np.stack([np.asarray(flat.field(c)).astype(np.int64) for c in ("start", "n", "source")], axis=1)
                    spans[row] = greedy_parse(cut, window)
                    for s in spans[row]:
                        gone[starts[row] + s["start"]] += 1
                        gone[starts[row] + s["start"] + s["words"]] -= 1
                stays = np.cumsum(gone[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(stays)])[starts]
                kept = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.filter(pa.array(stays)).cast(pa.string()))
                n_words = np.diff(starts)
                columns = [pc.binary_join(kept, " "), pa.array(n_words), pa.array(n_words - np.diff(left))]
                kinds = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("source", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns, pa.array(spans, kinds)], names=schema.names)

    return both.mapInArrow(run, schema)
