"""Scores by a class-based bigram model: words are assigned to classes by exchange, classes follow each other, words come from classes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import words as W
from tallyframe.llm.base import release_memory, saved

CLASSES = 24  # least number of classes; more words have words ** GROWTH of them
GROWTH = 0.28
LEAST = 8  # words seen more rarely have no class of their own: they take part in exchange together, with the words of their ending
PLACED = 1 << 22  # most words that have one of their own, the most frequent ones, so that a table of all classes is 8 MB at most
CORE = 512  # most frequent words, which are clustered first; all others begin where they fit those best
HEAD = 1 << 18  # most frequent words whose counts and classes go to every task; those of all others are joined
HEAD_BYTES = 64  # longer words are never in the head, which bounds its size
ENDINGS = 1 << 12  # endings, hashed to so many values; words that training has not seen have the class of theirs
ENDING = 3  # code points
EPS = 1e-4  # gains in log-likelihood up to this are rounding
SHARE = 0.5  # of the words that would gain, at most so many move at once, as neighbours that move together undo each other's gain
STOP = 1e-2  # exchange ends after a round that raises the log-likelihood by less than this share of what classes have won over a single one
CHUNK = 1 << 17  # rows of bigrams that are handed to a task as one value, about
PAIRS = 1 << 19  # words of training for each bucket of bigrams, which one task adds up or sorts at once
END = 0  # key of a text's end
SMOOTH = 0.5
_SLICE = 24 << 20
_SMALL_SLICE = 4 << 20  # where a word takes many numbers


@dataclass
class Model:
    """Head words, most frequent first, with counts and classes; classes of endings; totals; logarithms to base 10."""

    words: pa.Array
    counts: np.ndarray
    tokens: int  # training tokens, ends included
    distinct: int
    ends: int
    head_class: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ending_class: np.ndarray = field(default_factory=lambda: np.zeros(ENDINGS, np.int64))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    class_tokens: np.ndarray = field(default_factory=lambda: np.zeros(0))
    class_words: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1)))

    def emission(self, count: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Each class keeps the share of one more word for all it has not seen."""
        return np.log10((count + SMOOTH) / (self.class_tokens[group] + SMOOTH * (self.class_words[group] + 1)))


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 1 when divided by 5. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def _slices(batches: Iterator[pa.RecordBatch], at: int = 0, most: int = _SLICE) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    for batch in batches:
        for a, b in W.text_slices(batch.column(at), most):
            yield (batch.slice(a, b - a), *W.split_words(batch.column(at).slice(a, b - a), lower=True))


def ending_of(words: pa.Array) -> np.ndarray:
    return (W.hash_strings(pc.utf8_slice_codeunits(words, start=-ENDING)) % np.uint64(ENDINGS)).astype(np.int64)


def _coded(words: pa.Array, head: pa.Array) -> np.ndarray:
    """Rank of each word in the head; -1 for others."""
    return np.asarray(pc.fill_null(pc.index_in(words, value_set=head), -1)).astype(np.int64)


def _stream(codes: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts with ``end`` after each, and the code before each of them; a text follows an end."""
    all_ = np.insert(codes, starts[1:], end)
    before = np.empty_like(all_)
    before[1:] = all_[:-1]
    before[:1] = end
    return all_, before


def keys(words: pa.Array) -> np.ndarray:
    """64-bit key of each word; words that share one by chance share a class."""
    out = W.hash_strings(words).astype(np.int64)
    out[out == END] = 1
    return out


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c, key, ending) over all words of all training texts; each task adds up its slices before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, _ in _slices(batches):
            coded = words.dictionary_encode()
            n = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(n.astype(np.int64))], names=["word", "n"])
        release_memory()

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys(word)), pa.array(ending_of(word))], names=["word", "c", "key", "ending"])
        release_memory()

    rows = training.select("text").mapInArrow(run, "word string, n bigint")
    return saved(rows.groupBy("word").agg(F.sum("n").alias("c")).mapInArrow(named, "word string, c bigint, key bigint, ending bigint"), "word-counts")


_PACKED = ("pairs", "i", "j", "n")
_PACKED_DDL = "pairs bigint, i binary, j binary, n binary"


def _planes(x: np.ndarray) -> bytes:
    """Numbers from 0 on as the lowest bytes of all, then the next ones, as many as the largest number has: the higher ones mostly repeat."""
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return np.ascontiguousarray(x.astype("<i8")).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: pa.Scalar, rows: int) -> np.ndarray:
    out = np.zeros((rows, 8), np.uint8)
    planes = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, rows)
    out[:, : len(planes)] = planes.T
    return out.view("<i8").ravel()


def _packed(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Their number and bigrams as three values; ``i`` rises, so its steps are stored."""
    return len(i), _planes(np.diff(i, prepend=0)), _planes(j), _planes(n)


def _packed_rows(parts: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*parts)) or [()] * 4
    return [pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))]


def _rows(row: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, j, n = (_from_planes(c, row[0].as_py()) for c in row[1:])
    return np.cumsum(i), j, n


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each different key, ascending, and the sum of its ``n``."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n[order], first) if len(first) else n


def _dealt(i: np.ndarray, j: np.ndarray, n: np.ndarray, bucket: np.ndarray, buckets: int, name: str) -> pa.RecordBatch:
    """Rows sorted by ``i`` as one packed row for each bucket that has some."""
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    i, j, n = i[order], j[order], n[order]
    filled = np.flatnonzero(np.diff(bounds))
    packed = [_packed(*(x[bounds[k] : bounds[k + 1]] for x in (i, j, n))) for k in filled]
    return pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), *_packed_rows(packed)], names=[name, *_PACKED])


def packed_bigrams(training: DataFrame, placed: Broadcast, buckets: int = 16) -> DataFrame:
    """Bigrams of units over all neighbours in all training texts, as packed columns of up to ``CHUNK`` rows; a text's end stands before its first word too.

    Units are the words of ``placed`` (sorted keys), then the endings of all others, then the end of a text. Each task counts its slices and
    deals the pairs by their hash into ``buckets``, which are then added up one by one.
    """

    def units() -> int:
        return len(placed.value) + ENDINGS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = units() - 1
        for _, words, starts in _slices(batches, most=_SMALL_SLICE):
            coded = words.dictionary_encode()
            of = np.append(_units(coded.dictionary, placed.value), end)
            now, before = _stream(np.asarray(coded.indices).astype(np.int64), starts, len(of) - 1)
            pair, n = np.unique(of[before] * (end + 1) + of[now], return_counts=True)
            yield _dealt(pair // (end + 1), pair % (end + 1), n, W.mix(pair) % np.uint64(buckets), buckets, "bucket")
        release_memory()

    def added(group: pa.Table) -> pa.Table:
        parts = [_rows(row) for row in zip(*(group.column(c) for c in _PACKED))]
        i, j, n = (np.concatenate(c) for c in zip(*parts))
        pair, n = _summed(i * units() + j, n)
        del parts, i, j
        cuts = [slice(at, at + CHUNK) for at in range(0, len(pair), CHUNK)]
        out = pa.table(_packed_rows([_packed(pair[c] // units(), pair[c] % units(), n[c]) for c in cuts]), names=list(_PACKED))
        release_memory()
        return out

    rows = training.select("text").mapInArrow(run, f"bucket int, {_PACKED_DDL}")
    return saved(rows.groupBy("bucket").applyInArrow(added, _PACKED_DDL), "bigrams")


def unit_bigrams(training: DataFrame, placed: Broadcast) -> DataFrame:
    """(i, j, n): the rows of ``packed_bigrams``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                i, j, n = _rows(row)
                yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n)], names=["i", "j", "n"])

    return packed_bigrams(training, placed).mapInArrow(run, "i int, j int, n bigint")


def _repacked(bigrams: DataFrame) -> DataFrame:
    """Rows (i, j, n) as packed columns, one row for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            i, j, n = (np.asarray(c).astype(np.int64) for c in batch.columns)
            order = np.argsort(i, kind="stable")
            yield pa.RecordBatch.from_arrays(_packed_rows([_packed(i[order], j[order], n[order])]), names=list(_PACKED))

    return bigrams.select("i", "j", "n").mapInArrow(run, _PACKED_DDL)


def _units(words: pa.Array, placed: np.ndarray) -> np.ndarray:
    """Unit of each word: its own if its key is among the sorted ``placed`` ones, else that of its ending."""
    key = keys(words)
    at = np.minimum(np.searchsorted(placed, key), max(len(placed) - 1, 0))
    out = len(placed) + ending_of(words)
    return np.where(placed[at] == key, at, out) if len(placed) else out


def head_cutoff(counts: DataFrame, head: int) -> int:
    """Least count that at most ``head`` words reach, by a few aggregates over ``counts``; no task sorts or gathers words."""
    row = counts.agg(F.count("*"), F.max("c")).first()
    low, high = 0, 1
    if row[0] > head:
        low, high = 1, row[1] + 1
    while high - low > 1:
        points = sorted({p for p in map(int, np.geomspace(low + 1, high, 64)) if low < p < high})
        reach = counts.agg(*[F.count_if(F.col("c") >= p).alias(f"p{i}") for i, p in enumerate(points)]).first()
        low = max([low, *(p for p, n in zip(points, reach) if n > head)])
        high = min([high, *(p for p, n in zip(points, reach) if n <= head)])
    return high


def most_frequent(counts: DataFrame, head: int) -> Column:
    """Which words of ``counts`` are the ``head`` most frequent; of those that tie at the last count, about as many as have room, by hash."""
    cutoff = head_cutoff(counts, head)
    above, ties = counts.agg(F.count_if(F.col("c") >= cutoff), F.count_if(F.col("c") == cutoff - 1)).first()
    room = (head - above) / ties * 0.99 if ties else 0.0
    draw = F.pmod(F.xxhash64("word"), F.lit(1 << 30))
    return (F.col("c") >= cutoff) | ((F.col("c") == cutoff - 1) & (draw < int(room * (1 << 30))))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """Log-likelihood of the classes of all texts, up to what does not depend on the classes."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(axis=1)).sum() - _xlogx(pairs.sum(axis=0)).sum())


def best_moves(unit: np.ndarray, side: np.ndarray, near: np.ndarray, n: np.ndarray, own: np.ndarray, old: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class where each unit raises the likelihood most while all others stay, and the gain; its old class if nothing is gained.

    Rows (unit, side, near, n) count the class ``near`` after (side 0) or before (1) a unit, pairs with itself left out: those are ``own``.
    ``pairs`` holds all pairs of classes, ends last; ``old`` is -1 for units that are in no class and not counted there.
    """
    side_, classes, units = len(pairs), len(pairs) - 1, len(old)
    f, every, has = _xlogx, np.arange(units), old >= 0
    seen = np.bincount((unit * 2 + side) * side_ + near, weights=n, minlength=units * 2 * side_).reshape(units, 2, side_)
    right, left = seen[:, 0], seen[:, 1]
    gains = np.zeros((units, classes))

    # pairs with classes other than the old and the new one: few different (side, class, count), so each is computed once
    u, s, c = np.nonzero(seen)
    other = c != old[u]
    u, s, c = u[other], s[other], c[other]
    if len(u):
        kinds, which = np.unique(np.stack([s, c, seen[u, s, c].astype(np.int64)]), axis=1, return_inverse=True)
        with_ = np.where(kinds[0][:, None] == 0, pairs.T[kinds[1], :classes], pairs[kinds[1], :classes])
        more = f(with_ + kinds[2][:, None]) - f(with_)
        inner = np.flatnonzero(kinds[1] < classes)
        more[inner, kinds[1][inner]] = 0
        first = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
        gains[u[first]] = np.add.reduceat(more[which.ravel()], first, axis=0)

    from_ = np.where(has, old, 0)
    row, column = pairs[from_], pairs.T[from_]
    away = np.where(has[:, None], f(row - right) - f(row) + f(column - left) - f(column), 0)
    away[every, from_] = 0
    gains += away.sum(axis=1, keepdims=True) - away[:, :classes]
    old_right, old_left = (np.where(has, v[every, from_], 0)[:, None] for v in (right, left))
    row, column, to_right, to_left = row[:, :classes], column[:, :classes], right[:, :classes], left[:, :classes]
    gains += np.where(has[:, None], f(column + old_right - to_left) - f(column) + f(row + old_left - to_right) - f(row), 0)
    inside = pairs.diagonal()[:classes][None]
    gains += f(inside + to_right + to_left + own[:, None]) - f(inside)
    inside = pairs.diagonal()[from_]
    gains += np.where(has, f(inside - old_right[:, 0] - old_left[:, 0] - own) - f(inside), 0)[:, None]
    for total, part in ((pairs.sum(axis=1), right.sum(axis=1) + own), (pairs.sum(axis=0), left.sum(axis=1) + own)):
        gains -= f(total[None, :classes] + part[:, None]) - f(total[None, :classes])
        gains -= np.where(has, f(total[from_] - part) - f(total[from_]), 0)[:, None]
    gains[every[has], old[has]] = 0
    best = gains.argmax(axis=1)
    gain = gains[every, best]
    stay = has & (gain <= EPS)
    return np.where(stay, old, best), np.where(stay, 0.0, gain)


def _draws(keys_: np.ndarray, turn: int) -> np.ndarray:
    """Number from 0 to 1 of each key in each round."""
    return W.mix(keys_.astype(np.int64).view(np.uint64) + W.mix(np.array([turn + 1]))) / 2.0**64


def _settled(state, pairs_of, propose, move, stop: float = 0.0):
    """Rounds of moves until one raises the likelihood by less than ``stop`` of what was won so far, or until no word alone can raise it.

    Of all that would gain, ``SHARE`` move at once, chosen by a hash, if that raises the likelihood; else half as many, down to the one
    that gains most. So the likelihood rises in each round. Returns the last state and its class pairs.
    """
    between, share, turn, gained = pairs_of(state), SHARE, 0, 1.0
    single = likelihood(between.sum().reshape(1, 1))
    while gained > max(stop * (likelihood(between) - single), 0.0) or not turn:
        moves, movers = propose(state, between, turn)
        gained, turn = 0.0, turn + 1
        while movers:
            alone = share * movers < 1
            tried = move(state, moves, None if alone else share)
            after = pairs_of(tried)
            gain = likelihood(after) - likelihood(between)
            if gain > 0:
                state, between, share, gained = tried, after, min(SHARE, 2 * share), gain
                break
            if alone:  # the gain is below what sums of this size resolve
                break
            share /= 2
    return state, between


def _class_pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray, of: np.ndarray, side: int) -> np.ndarray:
    return np.bincount(of[a].astype(np.int64) * side + of[b], weights=n, minlength=side * side).reshape(side, side)


def _best_of_chunk(
    w: np.ndarray, v: np.ndarray, at: np.ndarray, n: np.ndarray, of: np.ndarray, pairs: np.ndarray, asked: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, best class, gain) of the units of whole rows (w, v, side, n) sorted by w, or of the ``asked`` ones; ``of`` has the class of every unit, -1 for none."""
    if asked is not None:
        rows = np.flatnonzero(asked[w])
        w, v, at, n = w[rows], v[rows], at[rows], n[rows]
    first = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.zeros(0, np.int64)
    units, best, gain = w[first], [], []
    bounds = np.append(first, len(w))
    for x in range(0, len(units), 4096):
        y = min(x + 4096, len(units))
        rows = slice(bounds[x], bounds[y])
        unit = np.repeat(np.arange(y - x), np.diff(bounds[x : y + 1]))
        self_, near = w[rows] == v[rows], of[v[rows]].astype(np.int64)
        own = np.bincount(unit, weights=n[rows] * (self_ & (at[rows] == 0)), minlength=y - x)
        use = ~self_ & (near >= 0)
        found = best_moves(unit[use], at[rows][use].astype(np.int64), near[use], n[rows][use], own, of[units[x:y]].astype(np.int64), pairs)
        # a unit that meets none of those with a class begins in any
        lost = (of[units[x:y]] < 0) & (np.bincount(unit, weights=use, minlength=y - x) == 0)
        best.append(np.where(lost, units[x:y] % (len(pairs) - 1), found[0]))
        gain.append(found[1])
    none = [np.zeros(0)]
    return units, np.concatenate(best or none).astype(np.int64), np.concatenate(gain or none)


def exchanged_rows(a: np.ndarray, b: np.ndarray, n: np.ndarray, keys_: np.ndarray, group: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes after exchange from ``group``, and their pairs, for bigrams (a, b, n) of few units; the unit after the last one is the end."""
    units, side_ = len(group), classes + 1
    w, v, side, count = np.concatenate([a, b]), np.concatenate([b, a]), np.repeat([0, 1], len(a)), np.tile(n, 2)
    order = np.flatnonzero(w < units)
    order = order[np.argsort(w[order], kind="stable")]
    w, v, side, count = w[order], v[order], side[order], count[order]
    ended = lambda g: np.append(g, classes)

    def propose(g: np.ndarray, between: np.ndarray, turn: int):
        at, best, gain = _best_of_chunk(w, v, side, count, ended(g), between)
        return (at, best, gain, _draws(keys_[at], turn)), np.count_nonzero(gain)

    def move(g: np.ndarray, moves, share: float | None) -> np.ndarray:
        at, best, gain, draw = moves
        picked = np.lexsort((keys_[at], gain))[-1:] if share is None else np.flatnonzero(draw < share)
        g = g.copy()
        g[at[picked]] = best[picked]
        return g

    return _settled(group, lambda g: _class_pairs(a, b, n, ended(g), side_), propose, move)


def exchanged(pairs: np.ndarray, classes: int) -> np.ndarray:
    """Class of each word from the counts of word pairs: words move to the class where the likelihood is highest, until none moves."""
    a, b = np.nonzero(pairs)
    at = np.arange(len(pairs))
    return exchanged_rows(a, b, pairs[a, b], at, at % classes, classes)[0]


_CHUNK = "w binary, v binary, side binary, n binary"
_KINDS = (np.int32, np.int32, np.int8, np.int64)


def _chunks(bigrams: DataFrame, end: int, buckets: int) -> DataFrame:
    """All packed bigrams once from each of their units, as packed columns of about ``CHUNK`` rows each; the rows of a unit are in one chunk.

    Units are dealt by hash into ``buckets``, which are sorted one by one. The side of a row is the lowest bit of its ``j``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                i, j, n = _rows(row)
                back = np.argsort(j, kind="stable")
                for w, v, count, side in ((i, j, n, 0), (j[back], i[back], n[back], 1)):
                    use = w != end
                    w, v, count = w[use], v[use], count[use]
                    yield _dealt(w, 2 * v + side, count, W.mix(w) % np.uint64(buckets), buckets, "part")
        release_memory()

    def cut(group: pa.Table) -> pa.Table:
        parts = [_rows(row) for row in zip(*(group.column(c) for c in _PACKED))]
        w, v, n = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(w, kind="stable")
        w, v, n = w[order], v[order], n[order]
        ends = np.searchsorted(w, w[CHUNK::CHUNK]) if len(w) > CHUNK else []
        bounds = np.unique([0, *ends, len(w)])
        chunks = [[w[a:b], v[a:b] >> 1, v[a:b] & 1, n[a:b]] for a, b in zip(bounds, bounds[1:])]
        columns = list(zip(*[[c.astype(k).tobytes() for c, k in zip(chunk, _KINDS)] for chunk in chunks]))
        del parts, w, v, n, order, chunks
        release_memory()
        return pa.table([pa.array(list(c), pa.binary()) for c in columns], names=["w", "v", "side", "n"])

    return saved(bigrams.mapInArrow(run, f"part int, {_PACKED_DDL}").groupBy("part").applyInArrow(cut, _CHUNK), "chunks")


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    for row in zip(*batch.columns):
        yield tuple(np.frombuffer(c.as_buffer(), k) for c, k in zip(row, _KINDS))


def clustered(bigrams: DataFrame, placed: np.ndarray, core: np.ndarray, classes: int, buckets: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Class of every unit, and the counts of all class pairs, ends last: exchange over all bigrams, each round two scans of packed rows.

    ``bigrams`` are rows (i, j, n) of numbers, or packed ones.
    The most frequent words (``core``, as units) are clustered first, and all others begin where they fit those best. A unit that no bigram has is in class -1.
    """
    spark, side, end = bigrams.sparkSession, classes + 1, len(placed) + ENDINGS
    if dict(bigrams.dtypes)["i"] != "binary":
        bigrams = _repacked(bigrams)
    chunks = _chunks(bigrams, end, buckets)

    def scanned(rows_of: Callable[[tuple, np.ndarray], pa.RecordBatch], schema: str, of: np.ndarray, added: bool = False) -> pa.Table:
        held = spark.sparkContext.broadcast(of)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in _unpacked(batch):
                    yield rows_of(chunk, held.value)
            release_memory()

        found = chunks.mapInArrow(run, schema)
        table = (found.groupBy("cell").agg(F.sum("n").alias("n")) if added else found).toArrow()
        held.destroy()
        return table

    def pairs_of(of: np.ndarray) -> np.ndarray:
        """From the left end of each bigram; those that begin with a text's end, from the right one."""

        def rows_of(chunk: tuple, of: np.ndarray) -> pa.RecordBatch:
            w, v, at, n = chunk
            a, b = np.where(at == 0, w, v), np.where(at == 0, v, w)
            use = (at == 0) | (v == end)
            found = _class_pairs(a[use], b[use], n[use], of, side).ravel()
            cells = np.flatnonzero(found)
            return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(found[cells].astype(np.int64))], names=["cell", "n"])

        table = scanned(rows_of, "cell bigint, n bigint", of, added=True)
        out = np.zeros(side * side)
        out[np.asarray(table.column("cell"))] = np.asarray(table.column("n"))
        out[-1] += ends_alone
        return out.reshape(side, side)

    def propose(of: np.ndarray, between: np.ndarray, turn: int):
        # only those that may move in this round are looked at
        asked = _draws(np.arange(end + 1) + 1, turn) < SHARE if turn else None
        asked_bits = None if asked is None else spark.sparkContext.broadcast(np.packbits(asked))

        def rows_of(chunk: tuple, of: np.ndarray) -> pa.RecordBatch:
            some_ = None if asked_bits is None else np.unpackbits(asked_bits.value, count=end + 1).astype(bool)
            at, best, gain = _best_of_chunk(*chunk, of, between, some_)
            some = (gain > 0) | (of[at] < 0)
            return pa.RecordBatch.from_arrays([pa.array(at[some]), pa.array(best[some].astype(np.int16)), pa.array(gain[some])], names=["unit", "best", "gain"])

        table = scanned(rows_of, "unit int, best short, gain double", of)
        at, best, gain = (np.asarray(table.column(c)) for c in ("unit", "best", "gain"))
        return (at, best, gain, _draws(at.astype(np.int64) + 1, turn)), int(np.count_nonzero(gain > 0))

    def move(of: np.ndarray, moves, share: float | None) -> np.ndarray:
        at, best, gain, draw = moves
        picked = np.lexsort((at, gain))[-1:] if share is None else np.flatnonzero(draw < share)
        of = of.copy()
        of[at[picked]] = best[picked]
        return of

    place = np.full(end + 1, -1, np.int64)  # of the core words, and last of the end, among these
    place[[*core, end]] = np.arange(len(core) + 1)
    places = spark.sparkContext.broadcast(place)

    def of_core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                i, j, n = _rows(row)
                a, b = places.value[i], places.value[j]
                both = (a >= 0) & (b >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(a[both]), pa.array(b[both]), pa.array(n[both])], names=["a", "b", "n"])
        release_memory()

    found = bigrams.mapInArrow(of_core, "a bigint, b bigint, n bigint").toArrow()
    a, b, n = (np.asarray(found.column(c)).astype(np.int64) for c in ("a", "b", "n"))
    ends_alone = int(n[(a == len(core)) & (b == len(core))].sum())
    group, core_pairs = exchanged_rows(a, b, n, core.astype(np.int64) + 1, np.arange(len(core)) % classes, classes)
    of = np.full(end + 1, -1, np.int16)
    of[core], of[end] = group, classes
    seed = propose(of, core_pairs, 0)[0]  # round 0 looks at all units
    fresh = of[seed[0]] < 0
    of[seed[0][fresh]] = seed[1][fresh]
    return _settled(of, pairs_of, lambda state, between, turn: propose(state, between, turn + 1), move, STOP)


def learned(docs: DataFrame, classes: int | None = None, core: int = CORE, placed: int = PLACED, head: int = HEAD, least: int = LEAST) -> tuple[Model, DataFrame]:
    """The model and the table (word, c, class), from all documents that are not held out.

    The counts of all words and of all bigrams stay tables; ``classes`` follows the number of words unless given. Words that occur ``least``
    times, the ``placed`` most frequent of them, take part in exchange one by one, rarer ones with all rare words of their ending, so
    that no class is chosen from a single context. To the driver come the keys and classes of those words, the moves of a round, bigrams
    among ``core`` words, pairs of classes, and up to ``head`` words with counts: all of bounded size, at most 10 bytes a word.
    """
    spark = docs.sparkSession
    training = docs.where(~held_out(F.col("doc_id"))).select("text")
    counts = word_counts(training)
    total = counts.agg(F.sum("c"), F.count("*")).first()
    ends = training.count()
    if classes is None:
        classes = max(CLASSES, round(total[1] ** GROWTH))
    short = F.octet_length("word") <= HEAD_BYTES
    key_of = lambda where: np.unique(np.asarray(counts.where(where).select("key").toArrow().column("key")).astype(np.int64))
    own = key_of((F.col("c") >= least) & most_frequent(counts, placed))
    units = spark.sparkContext.broadcast(own)
    first = key_of((F.col("c") >= least) & short & most_frequent(counts, core))
    buckets = ((total[0] or 0) + ends) // PAIRS + 1
    of, pairs = clustered(packed_bigrams(training, units, buckets), own, np.searchsorted(own, np.intersect1d(first, own)), classes, buckets)

    classes_of = spark.sparkContext.broadcast(of)

    def with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = classes_of.value[_units(batch.column(0), units.value)].astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["word", "c", "ending", "class"])

    counts = saved(counts.select("word", "c", "ending").mapInArrow(with_class, "word string, c bigint, ending bigint, class bigint"), "word-classes")
    top = counts.where(short & most_frequent(counts, head)).select("word", "c", "class").toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    words = pa.concat_arrays(top.column("word").chunks) if top.num_rows else pa.array([], pa.string())
    model = Model(words.cast(pa.string()), np.asarray(top.column("c")).astype(np.int64), (total[0] or 0) + ends, total[1] + (ends > 0), ends)
    model.head_class = np.asarray(top.column("class")).astype(np.int64)
    found = counts.groupBy("ending", "class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).toArrow()
    ending, group, c, n = (np.asarray(found.column(x)).astype(np.int64) for x in ("ending", "class", "c", "n"))
    model.class_tokens = np.bincount(group, weights=c, minlength=classes + 1)
    model.class_words = np.bincount(group, weights=n, minlength=classes + 1)
    model.ending_class = np.full(ENDINGS, int(model.class_words[:classes].argmax()))
    order = np.lexsort((-group, n))  # the last of an ending stays: the class of most of its words
    model.ending_class[ending[order]] = group[order]
    merged = of[len(own) : len(own) + ENDINGS].astype(np.int64)  # endings of rare words have a class from all their contexts
    model.ending_class = np.where(merged >= 0, merged, model.ending_class)
    model.transition = np.log10((pairs + SMOOTH) / (pairs.sum(axis=1, keepdims=True) + SMOOTH * (classes + 1)))
    return model, counts.select("word", "c", "class")


def _class_of(words: pa.Array, code: np.ndarray, model: Model) -> np.ndarray:
    """Class of each word of the head; of others the class that they have if training has not seen them."""
    out = np.empty(len(code), np.int64)
    known = code >= 0
    out[known] = model.head_class[code[known]]
    other = np.flatnonzero(~known)
    out[other] = model.ending_class[ending_of(words.take(pa.array(other)))]
    return out


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``docs`` without ``text`` but with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity``.

    ``score`` is the model's log10 probability of the text: of each word's class after the class before it, and of the word in its class.
    Words of the head are scored where the text is read. The others, which are rare and so never hot, go out as rows with the word before,
    meet their counts and classes in joins, and come back as sums per text. A word that training has not seen has the class of its ending.

    Null or empty text is one end. Repeated rows have equal scores. A null ``doc_id`` belongs to training. Without training tokens every
    count is 0. Other columns pass through, and those of the added names are replaced. An empty table gives an empty table.
    """
    added = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in added])
    kept = [f for f in docs.schema.fields if f.name != "text"]
    extra = T.StructType.fromDDL("row_ bigint, n_ bigint, known_ bigint, base_ double, score_ double, befores_ array<string>, words_ array<string>, from_ array<bigint>, to_ array<bigint>")
    schema = T.StructType([T.StructField(f"in_{i}", f.dataType) for i, f in enumerate(kept)] + extra.fields)
    held = docs.sparkSession.sparkContext.broadcast(vars(model))
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        m = Model(**held.value)
        end = m.transition.shape[0] - 1
        for part, words, starts in _slices(batches, text_at, _SMALL_SLICE):
            rows = part.num_rows
            code = _coded(words, m.words)
            inside = code >= 0
            group = _class_of(words, code, m)
            now, before = _stream(group, starts, end)
            place = np.insert(np.arange(len(code)), starts[1:], -1)  # of each word or end of the stream among the words
            rare = (place >= 0) & np.append(~inside, False)[place]
            rare_before = np.append(False, rare[:-1])
            of = np.repeat(np.arange(rows), np.diff(starts) + 1)
            sure = ~(rare | rare_before)
            move = np.bincount(of[sure], weights=m.transition[before[sure], now[sure]], minlength=rows)
            owner = W.owners(starts)
            count = m.counts[code[inside]]
            sums = lambda v: np.bincount(owner[inside], weights=v, minlength=rows)
            base = sums(m.base(count)) + m.base(np.array([m.ends]))[0]
            score = sums(m.emission(count, group[inside])) + move
            known = np.bincount(owner[inside], minlength=rows) + (m.ends > 0)
            open_ = np.flatnonzero(~sure)
            bounds = pa.array(np.searchsorted(of[open_], np.arange(rows + 1)).astype(np.int32))
            word = lambda at, is_: words.take(pa.array(at, mask=~is_)).cast(pa.string())
            values = (word(place[open_ - 1], rare_before[open_]), word(place[open_], rare[open_]), pa.array(before[open_]), pa.array(now[open_]))
            lists = [pa.ListArray.from_arrays(bounds, v) for v in values]
            columns = [c for i, c in enumerate(part.columns) if i != text_at]
            columns += [pa.array(row + np.arange(rows)), pa.array(np.diff(starts) + 1), pa.array(known.astype(np.int64)), pa.array(base.astype(float)), pa.array(score.astype(float)), *lists]
            row += rows
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        release_memory()

    partial = saved(docs.mapInArrow(run, schema), "scores")
    tail = saved(partial.select("row_", F.inline(F.arrays_zip("befores_", "words_", "from_", "to_"))), "rare-words")
    known = counts.select(F.col("word").alias("known_word"), F.col("c"), F.col("class"))
    now = tail.where("words_ IS NOT NULL").join(known, F.col("words_") == F.col("known_word"), "left")
    now = now.select("row_", "befores_", "from_", F.coalesce("class", "to_").alias("to_"), F.coalesce("c", F.lit(0)).alias("c"))
    now = now.unionByName(tail.where("words_ IS NULL").select("row_", "befores_", "from_", "to_", F.lit(None).cast("long").alias("c")))
    met = now.where("befores_ IS NOT NULL").join(known.drop("c"), F.col("befores_") == F.col("known_word"), "left")
    met = met.select("row_", F.coalesce("class", "from_").alias("from_"), "to_", "c").unionByName(now.where("befores_ IS NULL").select("row_", "from_", "to_", "c"))
    scale = model.tokens + SMOOTH * (model.distinct + 1)
    numbers = lambda values: F.array(*[F.lit(float(x)) for x in values])
    per_class = numbers(model.class_tokens + SMOOTH * (model.class_words + 1))
    side = len(model.transition)
    cell = np.arange(side * side)
    steps = docs.sparkSession.createDataFrame(pa.table({"from_": cell // side, "to_": cell % side, "step_": model.transition.ravel().astype(float)}))
    met = met.join(F.broadcast(steps), ["from_", "to_"])
    log = lambda over: F.coalesce(F.log10((F.col("c") + SMOOTH) / over), F.lit(0.0))
    sums = met.groupBy("row_").agg(
        F.count_if(F.col("c") > 0).alias("more_known"),
        F.sum(log(F.lit(float(scale)))).alias("more_base"),
        F.sum(log(F.element_at(per_class, (F.col("to_") + 1).cast("int"))) + F.col("step_")).alias("more_score"),
    )
    plus = lambda c, more: F.col(c) + F.coalesce(F.col(more), F.lit(0))
    out = partial.drop("befores_", "words_", "from_", "to_").join(sums, "row_", "left")
    named = [F.col(f"in_{i}").alias(f.name) for i, f in enumerate(kept)]
    doc_id = next(F.col(f"in_{i}") for i, f in enumerate(kept) if f.name == "doc_id")
    score = plus("score_", "more_score")
    return out.select(
        *named,
        held_out(doc_id).alias("held_out"),
        F.col("n_").alias("n_tokens"),
        plus("known_", "more_known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        plus("base_", "more_base").alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_")).alias("perplexity"),
    )
