"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours, deepest first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.base import WORD, saved, spread_join

GROUP = 20  # conversations that share the head of one of them
HEADS = 4  # of that, fewer turns than this
PART_TURNS = 50_000  # turns of different conversations that one task makes a forest of, about
PART_MEMBERS = 200_000  # ids that one task hashes, about
SIZE = 16  # bytes of a turn's digest
_NOTHING = hashlib.sha256().hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (place, turn, digest, words); null role or text counts as empty.

    Turns are ordered by ``turn``, null first; those with one number, by digest. Rows without ``conv_id`` are left out. A conversation is one
    record of 40 bytes a turn; texts are not gathered.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(empty("role")).cast("string"), F.lit(":"), empty("role"), empty("text"))
    digest = F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * SIZE))
    words = F.regexp_count(empty("text"), F.lit(WORD)).cast("long")
    place = F.struct(F.col("turn").isNotNull().alias("place"), "turn", digest.alias("digest"), words.alias("words"))
    return conversations.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("turns"))


def with_heads(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """``turns`` (conv_id, turns) rebuilt: the first h turns of conversation c - c % ``group``, then the own ones after the first h.

    h is the unsigned CRC-32 of the id as text modulo ``heads``. A head that is absent adds nothing.
    """
    first = turns.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("of"), F.slice("turns", 1, heads).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    both = turns.join(first, turns["conv_id"] - turns["conv_id"] % group == first["of"], "left")
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), h), F.expr("array()").cast(turns.schema["turns"].dataType)), rest).alias("turns"))


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences of digests have in common at their beginning."""
    n = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return (int(differ.argmax()) if differ.any() else n) // SIZE


def merged(lengths: np.ndarray, common: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes of the forest over sorted different sequences of these ``lengths``, with ``common`` turns between neighbours.

    Each sequence is a component with the node of its end. Edges between neighbours join components in descending depth: the node at an edge's depth
    takes in what is right of the edge, and is made if the left component has no node of that depth. So components are intervals, every
    branching is one node, and a sequence that begins another is the node it branches at. ``first`` is the least member of each; ``children`` leaves out the leftmost of a branching.
    """
    n = len(lengths)
    up, top = list(range(n)), list(range(n))
    depth, left, right, least, parent, joins = lengths.tolist(), list(range(n)), list(range(n)), first.tolist(), [-1] * n, [0] * n

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for edge in np.argsort(-common, kind="stable").tolist():
        d, a, b = int(common[edge]), root(edge), root(edge + 1)
        x, y = top[a], top[b]
        if depth[x] != d:
            parent[x] = len(depth)
            depth.append(d), left.append(left[x]), right.append(right[x]), least.append(least[x]), parent.append(-1), joins.append(0)
            x = parent[x]
        parent[y] = x
        right[x], least[x], joins[x] = right[y], min(least[x], least[y]), joins[x] + 1
        if a < b:
            up[b] = a
            top[a] = x
    columns = {"depth": depth, "left": left, "right": right, "least": least, "parent": parent, "children": joins}
    return {c: np.array(v, np.int64) for c, v in columns.items()}


def _chain(key: bytes, upto: int) -> list[bytes]:
    """Names of the prefixes of 0 to ``upto`` turns."""
    state, out = hashlib.blake2b(digest_size=SIZE), []
    out.append(state.copy().digest())
    for at in range(0, upto * SIZE, SIZE):
        state.update(key[at : at + SIZE])
        out.append(state.copy().digest())
    return out


def forest(keys: list[bytes], members: np.ndarray, first: np.ndarray, words: list[np.ndarray], before: bytes | None, after: bytes | None) -> dict[str, object]:
    """All nodes of the trie that sorted different sequences make, as columns.

    ``before`` and ``after`` are the sequences next to them in other parts. A node that they share has a ``name``, and its numbers are shares that
    add up with those of the other parts; all others are final. ``parent_name`` is set where the parent is shared, else ``parent_conv``.
    """
    lengths = np.array([len(k) // SIZE for k in keys], np.int64)
    common = np.array([_common(a, b) for a, b in zip(keys, keys[1:])], np.int64)
    shared_left = -1 if before is None else _common(before, keys[0])
    shared_right = -1 if after is None else _common(keys[-1], after)
    nodes = merged(lengths, common, first)

    # one row for each depth between a node and its parent
    above = np.where(nodes["parent"] < 0, -1, nodes["depth"][nodes["parent"]])
    repeat = nodes["depth"] - above
    node = np.repeat(np.arange(len(repeat)), repeat)
    d = np.arange(len(node)) - np.repeat(np.cumsum(repeat) - repeat, repeat) + np.repeat(above + 1, repeat)
    left, right, own = nodes["left"][node], nodes["right"][node], d == nodes["depth"][node]
    goes_left, goes_right = (left == 0) & (d <= shared_left), (right == len(keys) - 1) & (d <= shared_right)

    sums = [np.concatenate([[0], np.cumsum(w)]) for w in words]  # words in the first 0, 1, 2, ... turns
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    flat = np.concatenate(sums)
    total = flat[at[1:] - 1]
    new_from = np.concatenate([[max(shared_left, 0)], common])  # turns that the sequence before has as well
    new = total - flat[at[:-1] + new_from]
    running = lambda x: np.concatenate([[0], np.cumsum(x)])
    between = lambda x: running(x)[right + 1] - running(x)[left]
    leaf = lengths > np.append(common, shared_right)
    skipped = flat[at[left] + np.maximum(d - 1, 0)]
    n_convs = between(members)
    once = between(new) + np.where(goes_left, 0, total[left] - skipped - new[left])
    saved_tokens = between(members * total) - n_convs * skipped - once
    fresh_child = np.where(goes_left, d == shared_left, lengths[left] > d)
    n_children = np.where(own, nodes["children"][node], 0) + fresh_child

    names_left = _chain(keys[0], shared_left) if shared_left >= 0 else []
    names_right = _chain(keys[-1], shared_right) if shared_right >= 0 else []
    shared = goes_left | goes_right
    named = lambda l, x: names_left[x] if l else names_right[x]
    names = [named(l, x) if s else None for s, l, x in zip(shared.tolist(), goes_left.tolist(), d.tolist())]
    row_above = np.where(d > above[node] + 1, np.arange(len(node)) - 1, (np.cumsum(repeat) - 1)[nodes["parent"][node]])
    row_above = np.where(d == 0, -1, row_above).tolist()
    least = nodes["least"][node].tolist()
    return {
        "name": names,
        "conv_id": least,
        "depth": d,
        "parent_name": [names[r] if r >= 0 else None for r in row_above],
        "parent_conv": [least[r] if r >= 0 and names[r] is None else None for r in row_above],
        "n_convs": n_convs,
        "n_children": n_children,
        "n_leaves": between(leaf.astype(np.int64)),
        "saved_tokens": saved_tokens,
        "ends": [int(first[n]) if e else None for n, e in zip(node.tolist(), (own & (node < len(keys)) & ~goes_left).tolist())],
    }


def _parts(total: int, size: int) -> int:
    return total // size + 1


def _forests(distinct: DataFrame, part_turns: int) -> DataFrame:
    """The nodes of ``forest`` over all of ``distinct`` (key, members, first, words), cut into ranges of sorted keys."""
    row = distinct.agg(F.sum(F.octet_length("key") + SIZE)).first()
    ranged = distinct.repartitionByRange(_parts((row[0] or 0) // SIZE, part_turns), "key").withColumn("part", F.spark_partition_id())
    ranged = saved(ranged, "ranges")
    ends = ranged.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    order = Window.orderBy("part")  # one row per part
    near = ends.select("part", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    kinds = [F.struct(F.lit(-1).cast("long").alias("members"), F.col("before").alias("key")), F.struct(F.lit(-2).cast("long").alias("members"), F.col("after").alias("key"))]
    near = near.select("part", F.inline(F.array(*kinds))).where("key IS NOT NULL")
    rows = ranged.unionByName(near, allowMissingColumns=True)
    schema = "name binary, conv_id bigint, depth bigint, parent_name binary, parent_conv bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends bigint"
    arrow = {"binary": pa.binary(), "bigint": pa.int64()}

    def run(table: pa.Table) -> pa.Table:
        key, members, first, words = (table.column(c).to_pylist() for c in ("key", "members", "first", "words"))
        beside = {m: k for k, m in zip(key, members) if m < 0}
        order = sorted((i for i, m in enumerate(members) if m >= 0), key=key.__getitem__)
        numbers = lambda x: np.array([x[i] for i in order], np.int64)
        found = forest([key[i] for i in order], numbers(members), numbers(first), [np.array(words[i], np.int64) for i in order], beside.get(-1), beside.get(-2))
        return pa.table({c: pa.array(found[c], arrow[k]) for c, k in (f.split() for f in schema.split(", "))})

    return saved(rows.groupBy("part").applyInArrow(run, schema), "forests")


def ends_hashes(members: DataFrame, total: int, part_members: int = PART_MEMBERS) -> DataFrame:
    """(first, ends_sha256) of each group of ``members`` (name, conv_id): its least id, and the hash of its ids, ascending, comma-joined.

    Ids are sorted over all tasks, which join those of one group into text. Only a group that goes on in the next task leaves text behind: one row
    per task, which a last task hashes in order as it reads them, for SHA-256 has no parts that could be hashed side by side.
    """
    ranged = members.select("name", "conv_id").repartitionByRange(_parts(total, part_members), "name", "conv_id").sortWithinPartitions("name", "conv_id")
    schema = T.StructType.fromDDL("name binary, first bigint, sha string, ids string")
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.string()]
    table = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = None, 0  # name, first and texts of the group at hand, and how many groups ended
        for batch in batches:
            name, ids = batch.column(0).to_pylist(), batch.column(1)
            cuts = [0, *(i for i in range(1, len(name)) if name[i] != name[i - 1]), len(name)]
            rows = []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                text = ",".join(map(str, ids.slice(a, b - a).to_pylist()))
                if held and held[0] == name[a]:
                    held[2].append(text)
                    continue
                if held:
                    whole = ",".join(held[2])
                    rows.append((held[0], held[1], None, whole) if n == 0 else (held[0], held[1], hashlib.sha256(whole.encode()).hexdigest(), None))
                    n += 1
                held = (name[a], ids[a].as_py(), [text])
            if rows:
                yield table(rows)
        if held:
            yield table([(held[0], held[1], None, ",".join(held[2]))])

    pieces = saved(ranged.mapInArrow(joined, schema), "ends")
    open_ = pieces.where("ids IS NOT NULL").repartition("name").sortWithinPartitions("name", "first")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, state = None, 0, hashlib.sha256()
        for batch in batches:
            rows = []
            for own, least, ids in zip(*(batch.column(i) for i in (0, 1, 3))):
                if own.as_py() != name:
                    if name is not None:
                        rows.append((name, first, state.hexdigest(), None))
                    name, first, state = own.as_py(), least.as_py(), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
            if rows:
                yield table(rows)
        if name is not None:
            yield table([(name, first, state.hexdigest(), None)])

    done = pieces.where("ids IS NULL").unionByName(open_.mapInArrow(hashed, schema))
    return done.select("first", F.col("sha").alias("ends_sha256"))


def trie(turns: DataFrame, part_turns: int = PART_TURNS, part_members: int = PART_MEMBERS, **options) -> DataFrame:
    """The nodes of the prefix trie over ``turns`` (conv_id, turns): one row for each different sequence of first turns, from the empty one.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); ``conv_id`` is the least conversation that
    begins so and, with the depth, names a node. Equal conversations collapse first. The different ones are sorted by their turns' digests and
    cut into ranges; each range makes its forest by union-find over the common prefixes of neighbours, deepest first. Nodes that go on
    in the next range are its prefixes only; their shares, which add up, are merged by name, and then give
    their children their parent's id. Conversations without turns belong to the root alone. An empty table has no root, and gives no row.
    """
    digests = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    rows = turns.select("conv_id", F.unhex(digests).alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = saved(rows.withColumn("name", F.unhex(F.substring(F.sha2("key", 256), 1, 2 * SIZE))), "conversations")
    members = rows.groupBy("name").agg(F.count("*").alias("members"), F.min("conv_id").alias("first"))
    distinct = members.join(rows.select(F.col("conv_id").alias("first"), "key", "words"), "first").drop("name")
    nodes = _forests(saved(distinct, "distinct"), part_turns)
    adds = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    shared = nodes.where("name IS NOT NULL").groupBy("name", "depth").agg(F.min("conv_id").alias("conv_id"), F.first("parent_name", True).alias("parent_name"), *adds, F.max("ends").alias("ends"))
    shared = saved(shared, "shared-nodes")
    columns = ["conv_id", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    plain = nodes.where("name IS NULL")
    under = plain.where("parent_name IS NOT NULL").unionByName(shared.where("parent_name IS NOT NULL"), allowMissingColumns=True)
    parents = shared.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("shared_parent"), F.col("n_children").alias("size"))
    total = shared.agg(F.sum("n_children")).first()[0] or 0
    under = spread_join(under, parents, ["parent_name"], "size", total, **options).withColumn("parent_conv", F.col("shared_parent"))
    every = plain.where("parent_name IS NULL").select(*columns).unionByName(under.select(*columns))
    every = every.unionByName(shared.where("parent_name IS NULL").withColumn("parent_conv", F.lit(None).cast("long")).select(*columns))
    hashes = ends_hashes(rows, rows.count(), part_members)
    ended = every.where("ends IS NOT NULL").join(hashes, F.col("ends") == F.col("first"))
    out = lambda df, sha: df.select("conv_id", "depth", F.col("parent_conv").alias("parent_conv_id"), *columns[3:-1], sha.alias("ends_sha256"))
    return out(every.where("ends IS NULL"), F.lit(_NOTHING)).unionByName(out(ended, F.col("ends_sha256")))
