"""Hard negatives within a window of scores, found by a multiway hyperplane tree with distance ranges between siblings."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tallyframe.llm.base import among_first, saved

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score
FAN = 8  # split points of a node
SAMPLE = 4096  # rows of least hash that split points are chosen from
LEAF_ROWS = 2048  # rows that a leaf holds, about, until the tree has SAMPLE / FAN leaves; larger leaves are met in blocks
BLOCK_ROWS = 4096  # rows of a leaf that meet a block of queries
BLOCK_QUERIES = 2048
LARGEST = 1 << 56  # scores are below it, so that their percentages are longs
SLACK = 1e-6  # of the largest distance: no rounding of distances moves a row out of a range
_FAR = np.iinfo(np.int64).max


def whole_components(vectors: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which vectors have all components present and finite, and floor(``scale`` * component) of those."""
    lists = vectors.cast(pa.list_(pa.float64()))
    at = np.asarray(lists.offsets).astype(np.int64)
    flat = np.asarray(pc.fill_null(lists.values, np.nan))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ok = np.asarray(lists.is_valid()) & (bad[at[1:]] == bad[at[:-1]])
    return ok, [np.floor(scale * flat[a:b]) for a, b, good in zip(at, at[1:], ok) if good]


def coded(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """(uid, id, label, vec, dims, square) of the rows of ``rows`` (id, label, vector) that take part, as whole numbers.

    Components are ``floor(scale * x)``, x as double; ``vec`` holds them in as few bytes as they need, its first byte being the kind of number. Rows with a null id, label
    or vector, or with a null or non-finite component, take no part. A component of 2**53 or more is an error.
    """
    schema = T.StructType.fromDDL("id bigint, label string, vec binary, dims int, square double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, found = whole_components(batch.column(2), scale)
            packed, square = [], []
            for v in found:
                most = np.abs(v).max(initial=0)
                if most >= 2.0**53:
                    raise ValueError("a component is too large for whole scores")
                kind = "h" if most < 2**15 else "i" if most < 2**31 else "q"
                packed.append(kind.encode() + v.astype(f"<{np.dtype(kind).str[1:]}").tobytes())
                square.append(float(v @ v))
            keep = pa.array(ok)
            columns = [batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(packed, pa.binary()), pa.array(list(map(len, found)), pa.int32()), pa.array(square, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    given = rows.select(F.col("id").cast("bigint"), F.col("label").cast("string"), "vector").where("id IS NOT NULL AND label IS NOT NULL")
    return saved(given.mapInArrow(run, schema).withColumn("uid", F.monotonically_increasing_id()), "vectors")


def decoded(packed: list[bytes], dims: int) -> np.ndarray:
    """Rows of ``dims`` whole numbers as doubles; shorter vectors end in zeros."""
    if packed and len({(p[:1], len(p)) for p in packed}) == 1 and len(packed[0]) > 1:
        kind = np.dtype(packed[0][:1].decode())
        out = np.frombuffer(b"".join(p[1:] for p in packed), kind).reshape(len(packed), -1)
        if out.shape[1] == dims:
            return out.astype(np.float64)
    out = np.zeros((len(packed), dims))
    for row, p in zip(out, packed):
        values = np.frombuffer(p[1:], np.dtype(p[:1].decode()))
        row[: len(values)] = values
    return out


def scores(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers; ``exact`` if sums of doubles are."""
    return (a @ b.T).astype(np.int64) if exact else a.astype(np.int64) @ b.astype(np.int64).T


@dataclass
class Tree:
    """Split points of all nodes; ``child`` is the node below each, or -1 - leaf.

    Rows are lifted onto a sphere by one more component, which queries have as 0; so larger scores are smaller distances.
    ``low`` and ``high`` hold the distances from each split point to the rows of each sibling's subtree.
    """

    dims: int
    radius: float  # squared
    exact: bool
    points: list[np.ndarray]
    child: list[np.ndarray]
    leaves: int
    low: list[np.ndarray]
    high: list[np.ndarray]

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([rows, np.sqrt(np.maximum(self.radius - np.einsum("ij,ij->i", rows, rows), 0))])

    def routes(self, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
        """The leaf of each lifted row, and (node, rows, distances to its split points, nearest of them) of each node that rows pass."""
        leaf, steps, todo = np.zeros(len(rows), np.int64), [], [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            d = _distances(rows[at], self.points[node])
            near = d.argmin(axis=1)
            steps.append((node, at, d, near))
            for j, below in enumerate(self.child[node].tolist()):
                own = at[near == j]
                if below < 0:
                    leaf[own] = -1 - below
                elif len(own):
                    todo.append((below, own))
        return leaf, steps

    def alive(self, queries: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each leaf may hold rows between the ``inner`` and the ``outer`` distance of each query, and the distance to its split point.

        A sibling is eliminated if its range of distances from any split point of the node does not meet the annulus that the query's
        window, moved by the distance from query to split point, leaves open there.
        """
        slack = SLACK * (2 * np.sqrt(self.radius) + np.sqrt(np.einsum("ij,ij->i", queries, queries)))[:, None, None]
        out, away = np.zeros((len(queries), self.leaves), bool), np.full((len(queries), self.leaves), np.inf)
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, at = todo.pop()
            d = _distances(queries[at], self.points[node])
            if not len(at):
                continue
            low, high, to = self.low[node][None], self.high[node][None], d[:, :, None]
            beyond = low > to + outer[at, None, None] + slack[at]
            short = high < to - outer[at, None, None] - slack[at]
            inside = high + to < inner[at, None, None] - slack[at]
            open_ = ~(beyond | short | inside).any(axis=1)
            for j, below in enumerate(self.child[node].tolist()):
                if below < 0:
                    out[at, -1 - below] = open_[:, j]
                    away[at, -1 - below] = d[:, j]
                else:
                    todo.append((below, at[open_[:, j]]))
        return out, away


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _apart(rows: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` different rows far from each other: each the farthest from those before."""
    picked, nearest = [0], _distances(rows, rows[:1])[:, 0]
    while len(picked) < min(wanted, len(rows)) and nearest.max() > 1e-9 * (1 + np.abs(rows).max()):
        picked.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(rows, rows[picked[-1:]])[:, 0])
    return rows[picked]


def planted(sample: np.ndarray, dims: int, radius: float, exact: bool, leaves: int, fan: int = FAN) -> Tree:
    """A tree of about ``leaves`` leaves whose split points come from ``sample``; the nodes with most sample rows are split first."""
    tree = Tree(dims, radius, exact, [], [], 0, [], [])
    rows = tree.lifted(sample) if len(sample) else np.zeros((1, dims + 1))
    open_: list[tuple[int, int, np.ndarray]] = []

    def node(own: np.ndarray) -> int:
        at, points = len(tree.points), _apart(own, fan)
        tree.points.append(points)
        tree.child.append(np.zeros(len(points), np.int64))
        near = _distances(own, points).argmin(axis=1)
        open_.extend((at, j, own[near == j]) for j in range(len(points)))
        return at

    node(rows)
    while len(open_) < leaves:
        open_.sort(key=lambda x: len(x[2]))
        at, j, own = open_.pop()
        if len(own) < 2 * fan or len(np.unique(own, axis=0)) < 2:
            open_.append((at, j, own))
            break
        tree.child[at][j] = node(own)
    for leaf, (at, j, _) in enumerate(open_):
        tree.child[at][j] = -1 - leaf
    tree.leaves = len(open_)
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    return tree


def _with_ranges(rows: DataFrame, tree: Tree) -> None:
    """Fill in the distance ranges from all rows; each task sends least and largest distances of its rows only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = [x.copy() for x in tree.low], [x.copy() for x in tree.high]
        for batch in batches:
            _, steps = tree.routes(tree.lifted(decoded(batch.column(0).to_pylist(), tree.dims)))
            for node, _, d, near in steps:
                for j in range(len(tree.child[node])):
                    own = d[near == j]
                    if len(own):
                        low[node][:, j] = np.minimum(low[node][:, j], own.min(axis=0))
                        high[node][:, j] = np.maximum(high[node][:, j], own.max(axis=0))
        rows_ = [(n, i, j, x[i, j], high[n][i, j]) for n, x in enumerate(low) for i, j in zip(*np.nonzero(np.isfinite(x)))]
        yield pa.RecordBatch.from_pylist([dict(zip("nijxy", (*map(int, r[:3]), *map(float, r[3:])))) for r in rows_], schema=pa.schema([("n", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("x", pa.float64()), ("y", pa.float64())]))

    found = rows.select("vec").mapInArrow(run, "n int, i int, j int, x double, y double").groupBy("n", "i", "j").agg(F.min("x"), F.max("y"))
    for n, i, j, x, y in found.collect():
        tree.low[n][i, j], tree.high[n][i, j] = x, y


def indexed(rows: DataFrame, fan: int = FAN, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> tuple[Tree, DataFrame]:
    """The tree and every row of ``rows`` (of ``coded``) with its ``leaf``.

    Split points come from a sample of ``sample`` rows; the ranges and leaves hold all rows, so searches are exact whatever the sample.
    """
    row = rows.agg(F.count("*"), F.max("dims"), F.max("square")).first()
    total, dims, radius = row[0], row[1] or 0, row[2] or 0.0
    if radius >= LARGEST:
        raise ValueError("scores of these vectors do not fit")
    draw = F.xxhash64("id", "vec")
    picked = rows.where(among_first(draw, sample, F.lit(max(total, 1)))).select(draw.alias("draw"), "uid", "vec").orderBy("draw", "uid").limit(sample)
    leaves = min(max(total // leaf_rows, 1), sample // fan)
    tree = planted(decoded([r["vec"] for r in picked.collect()], dims), dims, radius, radius < 2.0**53, leaves, fan)
    _with_ranges(rows, tree)
    names = ["uid", "id", "label", "vec"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, _ = tree.routes(tree.lifted(decoded(batch.column(3).to_pylist(), tree.dims)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], names=[*names, "leaf"])

    return tree, saved(rows.select(*names).mapInArrow(run, "uid bigint, id bigint, label string, vec binary, leaf int"), "leaves")


_QUERY = "query bigint, uid bigint, label string, same boolean, low bigint, high bigint, vec binary"


def _visits(queries: DataFrame, tree: Tree, choose: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """``queries`` once for each leaf that ``choose`` picks from those whose ranges meet the window."""
    names = queries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                low, high, vec = (part.column(names.index(c)) for c in ("low", "high", "vec"))
                rows = decoded(vec.to_pylist(), tree.dims)
                square = np.einsum("ij,ij->i", rows, rows) + tree.radius
                edge = lambda s: np.sqrt(np.maximum(square - 2 * np.asarray(s).astype(np.float64), 0))
                inner, outer = edge(high), edge(low)
                alive, away = tree.alive(np.column_stack([rows, np.zeros(len(rows))]), inner, outer)
                probed = np.asarray(part.column(names.index("probed"))) if "probed" in names else np.full(len(rows), -1)
                picked = choose(alive, away, inner, probed)
                q, leaf = np.nonzero(picked)
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(q)).columns, pa.array(leaf.astype(np.int32))], names=[*names, "leaf"])

    schema = T.StructType(queries.schema.fields + [T.StructField("leaf", T.IntegerType())])
    return queries.mapInArrow(run, schema)


def _nearest(alive: np.ndarray, away: np.ndarray, inner: np.ndarray, probed: np.ndarray) -> np.ndarray:
    """The one leaf whose split point is nearest to the near edge of the window."""
    gap = np.where(alive, np.abs(away - inner[:, None]), np.inf)
    out = np.zeros_like(alive)
    out[np.arange(len(gap)), gap.argmin(axis=1)] = True
    return out & alive


def _others(alive: np.ndarray, away: np.ndarray, inner: np.ndarray, probed: np.ndarray) -> np.ndarray:
    out = alive.copy()
    rows = np.flatnonzero(probed >= 0)
    out[rows, probed[rows]] = False
    return out


def _met(index: DataFrame, visits: DataFrame, tree: Tree, wanted: int) -> DataFrame:
    """(query, id, score, uid): of the leaves that queries visit, the first ``wanted`` rows of each block that lie in the query's window.

    Leaves and their visitors are cut into blocks, and each two blocks meet in a task of their own, so no leaf is gathered.
    """
    visits = saved(visits, "visits")
    rows_per = index.groupBy("leaf").agg(F.count("*").alias("n_rows"))
    sizes = visits.groupBy("leaf").agg(F.count("*").alias("n_visits")).join(rows_per, "leaf")
    blocks = lambda c, size: F.floor((F.col(c) + size - 1) / size).cast("int")
    sizes = F.broadcast(saved(sizes.select("leaf", blocks("n_rows", BLOCK_ROWS).alias("p"), blocks("n_visits", BLOCK_QUERIES).alias("q")), "leaf-sizes"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    mine = lambda c, *by: F.pmod(F.xxhash64(*by), F.col(c)).cast("int")
    left = index.join(sizes, "leaf").select("leaf", mine("p", "uid").alias("i"), every("q").alias("j"), F.lit(None).cast("bigint").alias("query"), "uid", "id", "label", "vec")
    right = visits.join(sizes, "leaf").select("leaf", every("p").alias("i"), mine("q", "query").alias("j"), "query", "uid", "label", "vec", "same", "low", "high")
    schema = "query bigint, id bigint, score bigint, uid bigint"

    def best(table: pa.Table) -> pa.Table:
        is_query = np.asarray(table.column("query").is_valid())
        asked, held = table.filter(pa.array(is_query)), table.filter(pa.array(~is_query))
        get = lambda t, c: np.asarray(t.column(c).combine_chunks())
        label = np.asarray(table.column("label").combine_chunks().dictionary_encode().indices)
        found = scores(decoded(asked.column("vec").to_pylist(), tree.dims), decoded(held.column("vec").to_pylist(), tree.dims), tree.exact)
        fits = (label[is_query][:, None] == label[~is_query][None]) == get(asked, "same")[:, None]
        fits &= (found >= get(asked, "low")[:, None]) & (found <= get(asked, "high")[:, None])
        fits &= get(asked, "uid")[:, None] != get(held, "uid")[None]
        if held.num_rows > wanted:  # rows that tie with the last one wanted stay, so that the id decides
            least = np.partition(np.where(fits, found, -_FAR), -wanted, axis=1)[:, -wanted]
            fits &= found >= least[:, None]
        q, x = np.nonzero(fits)
        ids = get(held, "id")[x]
        order = np.lexsort((ids, -found[q, x], q))
        q, x, ids = q[order], x[order], ids[order]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1])[: len(q)])
        keep = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) < wanted
        q, x, ids = q[keep], x[keep], ids[keep]
        return pa.table({"query": pa.array(get(asked, "query")[q], pa.int64()), "id": pa.array(ids, pa.int64()), "score": pa.array(found[q, x], pa.int64()), "uid": pa.array(get(held, "uid")[x], pa.int64())})

    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy("leaf", "i", "j").applyInArrow(best, schema)


def _first(found: DataFrame, wanted: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def search(index: DataFrame, tree: Tree, queries: DataFrame, wanted: int) -> DataFrame:
    """(query, id, score, uid, rank): for each of ``queries`` the first ``wanted`` rows of its window, by score, then id. Exact.

    A query has a window ``low`` to ``high`` of scores and takes rows of the ``same`` label or of others, never itself (``uid``). It first
    visits the leaf nearest to the near edge of its window; if that holds enough rows, the last of them narrows the window. Then it visits
    every leaf that the ranges do not eliminate.
    """
    queries = saved(queries.select(*[c.split()[0] for c in _QUERY.split(", ")]), "queries")
    probes = saved(_visits(queries, tree, _nearest), "probes")
    near = saved(_first(_met(index, probes, tree, wanted), wanted), "near")
    enough = near.where(F.col("rank") == wanted).select("query", F.col("score").alias("least"))
    rest = probes.withColumnRenamed("leaf", "probed").join(enough, "query", "left")
    rest = rest.withColumn("low", F.greatest("low", F.coalesce("least", "low"))).drop("least")
    far = _met(index, _visits(saved(rest, "open"), tree, _others), tree, wanted)
    return _first(near.drop("rank").unionByName(far), wanted)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, scale: float = 256.0, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, **options
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows ``id, label, vector``.

    Scores are inner products of ``floor(scale * x)``, in whole numbers. The positives of an anchor (a row with ``is_anchor``, which may use ``id``) are
    the first ``positives`` other rows of its label by score, then id; the negatives of such a pair the first ``negatives`` rows of other labels
    whose score lies between ``low`` and ``high`` percent of the positive's. Pairs without negatives give no row.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Shorter vectors end in zeros. Rows that share an id are
    rows of their own, also as each other's positives. Equal scores go by id. Vectors whose scores reach 2**56 are an error. Other columns are not
    read. An empty table gives an empty table.
    """
    own = coded(rows, scale)
    tree, index = indexed(own, **options)
    asking = index.where(F.coalesce(is_anchor, F.lit(False)))
    fixed = lambda x: F.lit(x).cast("bigint")
    first = asking.select(F.col("uid").alias("query"), "uid", "label", F.lit(True).alias("same"), fixed(-LARGEST).alias("low"), fixed(LARGEST).alias("high"), "vec")
    pairs = search(index, tree, first, positives).select(F.col("query").alias("anchor"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "uid")
    pairs = saved(pairs.withColumn("pair", F.monotonically_increasing_id()), "positives")
    # whole numbers within the window: rounded up at the low end and down at the high end, whatever the sign
    least = F.ceil(F.col("positive_score").cast("decimal(20,0)") * low / 100).cast("bigint")
    most = F.floor(F.col("positive_score").cast("decimal(20,0)") * high / 100).cast("bigint")
    anchors = asking.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"), "label", "vec")
    asked = pairs.join(anchors, "anchor")
    second = asked.select(F.col("pair").alias("query"), F.col("anchor").alias("uid"), "label", F.lit(False).alias("same"), least.alias("low"), most.alias("high"), "vec").where("low <= high")
    found = search(index, tree, second, negatives).select(F.col("query").alias("pair"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(asked.select("pair", "anchor_id", "positive_id", "positive_score"), "pair").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
