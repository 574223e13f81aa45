"""Packing token sequences with little padding: minimum bin slack over the lengths of all pieces."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import words as W
from tallyframe.llm.base import release_memory, saved, worker_state

CAPACITY = 4096
END = 2
CACHED_WORDS = 150_000  # most words whose ids a Python worker remembers
OFTEN = 3  # times in a slice from which a word is remembered
SLICE_BYTES = 2 << 20
RANK_ROWS = 20_000  # pieces that one window numbers, about
TOKENIZER = "word_bpe_49k.json"
_RANK_BITS = 44


def _tokenizer(path: str | None):
    held = worker_state("tokenizer")
    if path not in held:
        # Spark's tasks fill the cores; threads of each worker besides cost CPU time and memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            held[path] = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
        else:
            held[path] = Tokenizer.from_file(path)
    return held[path]


def word_ids(tokenizer, words: list[str], group: int = 100, at_once: int = 5000) -> list[bytes]:
    """Ids of each word as little-endian unsigned 32-bit numbers.

    Words are encoded in groups with a special token between them, at which the ids are parted again. That is right for tokenizers that
    drop white space, as each word then has the ids it has in its text. Words that might hold a special token are encoded alone.
    What the tokenizer returns is far larger than the ids, so it is asked for ``at_once`` words only.
    """
    special = "<|endoftext|>"
    mark = tokenizer.token_to_id(special)
    plain = [i for i, w in enumerate(words) if mark is not None and "<|" not in w]
    out: list[bytes] = [b""] * len(words)
    for k in range(0, len(plain), at_once):
        part = plain[k : k + at_once]
        joined = [special.join(words[i] for i in part[g : g + group]) for g in range(0, len(part), group)]
        ids = np.concatenate([np.array([*e.ids, mark], "<u4") for e in tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        flat, begin = ids.tobytes(), 0
        for i, end in zip(part, (4 * np.flatnonzero(ids == mark)).tolist(), strict=True):
            out[i] = flat[begin:end]
            begin = end + 4
    for i in set(range(len(words))).difference(plain):
        out[i] = np.array(tokenizer.encode(words[i], add_special_tokens=False).ids, "<u4").tobytes()
    return out


def _ids_of(tokenizer, vocabulary: list[str], times: np.ndarray, cache: dict[str, bytes]) -> list[bytes]:
    """Ids of each word; those found ``OFTEN`` times are remembered, as most others do not come back."""
    found = list(map(cache.get, vocabulary))
    missing = [i for i, ids in enumerate(found) if ids is None]
    for i, ids in zip(missing, word_ids(tokenizer, [vocabulary[i] for i in missing])):
        found[i] = ids
    often = [i for i in missing if times[i] >= OFTEN]
    cache.update((vocabulary[i], found[i]) for i in often[: CACHED_WORDS - len(cache)])
    return found


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the ids of each text and then ``end``, cut after every ``capacity`` ids.

    ``tokenizer`` is the path of a tokenizer file that drops white space, by default the public vocabulary named in ``TOKENIZER``.
    Each distinct word of a slice is encoded once; a worker remembers frequent words between slices, up to a fixed number.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind)] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    )

    def of_slice(texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        words, starts = W.split_words(texts)
        coded = words.dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        times = np.bincount(np.asarray(coded.indices), minlength=len(vocabulary))
        found = _ids_of(_tokenizer(tokenizer), vocabulary, times, worker_state(f"word ids {tokenizer}"))
        found.append(np.array([end], "<u4").tobytes())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        first = np.cumsum(size) - size
        codes = np.insert(np.asarray(coded.indices).astype(np.int64), starts[1:], len(found) - 1)
        starts = starts + np.arange(len(starts))
        row = 0
        while row < len(texts):  # a part has about 300,000 words, or one text
            stop = max(row + 1, int(np.searchsorted(starts, starts[row] + 300_000, "right")) - 1)
            own = codes[starts[row] : starts[stop]]
            n = size[own]
            to = np.cumsum(n)
            stream = flat[np.repeat(first[own] - (to - n), n) + np.arange(to[-1])]
            bounds = np.concatenate([[0], to])[starts[row : stop + 1] - starts[row]].tolist()
            for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                for at in range(a, b, capacity):
                    upto = min(at + capacity, b)
                    yield row + i, at - a, upto - at, zlib.crc32(stream[at:upto]), b - a
            row = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in W.text_slices(batch.column(1), SLICE_BYTES):
                rows = np.array(list(of_slice(batch.column(1).slice(start, stop - start))), np.int64).reshape(-1, 5)
                ids = batch.column(0).slice(start, stop - start).take(pa.array(rows[:, 0]))
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, rows[:, 1:].T.copy())], names=schema.names)
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def bin_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Minimum bin slack over a multiset of lengths: (times, {length: pieces of it in one bin}) until no length is left.

    Each bin takes the longest length left and, of all multisets of the others, one that fills it closest to ``capacity``. Reachable sums
    are the bits of one number; a length with c pieces enters as groups of 1, 2, 4, ... pieces; the states before each group lead back from
    the best sum to the counts. The same bin is made as often as the lengths left allow, so the work depends on the number
    of different lengths, not on that of pieces.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    order = sorted(left, reverse=True)
    out = []
    while order:
        longest = order[0]
        room = capacity - longest
        mask = (1 << (room + 1)) - 1
        reach, steps = 1, []
        for length in order:
            if length > room or reach >> room & 1:
                continue
            n, group = min(left[length] - (length == longest), room // length), 1
            while n > 0 and not reach >> room & 1:
                take = min(group, n)
                steps.append((length, take, reach))
                reach |= reach << (length * take) & mask
                n, group = n - take, group * 2
        best, used = reach.bit_length() - 1, {longest: 1}
        for length, take, before in reversed(steps):
            if not before >> best & 1:
                used[length] = used.get(length, 0) + take
                best -= length * take
        times = min(left[length] // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                order.remove(length)
        out.append((times, used))
    return out


def _places(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length and first rank, pieces of the length per bin, first bin, offset in the bin), sorted by the first."""
    rank: dict[int, int] = {}
    rows, bins = [], 0
    for times, used in patterns:
        offset = 0
        for length, n in used.items():
            rows.append((length << _RANK_BITS | rank.get(length, 0), n, bins, offset))
            rank[length] = rank.get(length, 0) + n * times
            offset += n * length
        bins += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _ranked(cut: DataFrame, total: int) -> DataFrame:
    """``cut`` with ``rank`` from 0 among the pieces of its length: numbered within salted groups, whose sizes are then added up."""
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(total // RANK_ROWS + 1))
    salted = cut.withColumn("salt", salt)
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    inner = salted.withColumn("rank", F.row_number().over(order) - 1)
    return inner.join(sizes, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before")).drop("salt", "before")


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``, the place of each in a sequence of at most ``capacity`` ids.

    Only the number of pieces per length, at most ``capacity`` rows, reaches the driver, which plans the bins from it by minimum bin slack;
    the plan, a few rows per length, goes to all tasks. A piece finds its bin from its length and its rank among the pieces of its length.

    Null or empty text, and text of blanks only, has one id: ``end``. A null ``doc_id`` is kept. Repeated rows are packed once each; pieces
    equal in all columns may swap places. A text of any length is cut into full pieces and a rest. An empty table gives an empty table. Other
    columns are not returned.
    """
    cut = saved(pieces(docs, tokenizer, capacity, end), "pieces")
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    places = cut.sparkSession.sparkContext.broadcast(_places(bin_patterns(counts, capacity)))
    schema = T.StructType(cut.schema.fields + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = places.value
        for batch in batches:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(n))).astype(np.int64) for n in ("length", "rank"))
            key = length << _RANK_BITS | rank
            key_at = np.searchsorted(table[:, 0], key, "right") - 1
            first, n, bins, offset = table[key_at].T
            row = key - first
            added = [pa.array(bins + row // n), pa.array(offset + row % n * length)]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in schema.fields[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, *added], names=schema.names)

    return _ranked(cut, sum(chain([0], counts.values()))).mapInArrow(place, schema)
