"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests. SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.base import saved

TABLES = 3
SLOTS = 8
ROUNDS = 6
LEVELS = 3  # sizes of sketches that are tried
LONG = 1000  # code points of a line above which it is cut further
EVERY = 48  # words of such a piece, on average


def paragraphs(text: Column) -> Column:
    """The pieces between line feeds; of those longer than ``LONG`` code points, the runs of words up to each one whose hash says so.

    Such a cut depends on the word alone, so what two texts share is cut alike in both, wherever it stands.
    """

    def bound(value: Column, use) -> Column:
        """``use`` of a value that is computed once, however often it occurs in it."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def pieces(words: Column, ends: Column) -> Column:
        begin = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1)
        return F.transform(ends, lambda end, k: F.array_join(F.slice(words, begin(k) + 1, end - begin(k) + 1), " "))

    def cut(line: Column) -> Column:
        def of_words(words: Column) -> Column:
            last = F.size(words) - 1
            ends = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (F.pmod(F.xxhash64(F.get(words, i)), F.lit(EVERY)) == 0))
            return bound(ends, lambda e: pieces(words, e))

        return bound(F.split(line, " ", -1), of_words)

    lines = F.split(text, "\n", -1)
    whole = F.transform(lines, lambda line: F.when(F.char_length(line) > LONG, cut(line)).otherwise(F.array(line)))
    return F.when(F.char_length(text) > LONG, F.flatten(whole)).otherwise(lines)


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs; an empty text is one empty paragraph."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.cast("long").alias("key"), check.cast("long").alias("check"))


def _slot(key: Column, table: Column) -> Column:
    """Slot of a digest in one of the tables: three bits each."""
    return F.call_function("shiftright", key, (table * 3).cast("int")).bitwiseAND(F.lit(SLOTS - 1))


def _hits(key: Column, cell: Column) -> Column:
    return _slot(key, F.floor(cell / SLOTS)) == cell % SLOTS


def _xor(keys: Column, value=lambda k: k) -> Column:
    return F.aggregate(keys, F.lit(0).cast("long"), lambda total, k: total.bitwiseXOR(value(k)))


def cells(keys: Column) -> Column:
    """The sketch of a set of digests: per cell the number of its digests, and the exclusive or of them and of their hashes."""

    def one(cell: Column) -> Column:
        own = F.filter(keys, lambda k: _hits(k, cell))
        return _cell(F.size(own), _xor(own), _xor(own, lambda k: F.xxhash64(k)))

    return F.transform(F.sequence(F.lit(0), F.lit(TABLES * SLOTS - 1)), one)


def _places(key: Column, size: Column, level: Column) -> list[Column]:
    """Cell of a digest in each table of a sketch of ``size`` slots a table; level 0 is the fingerprint itself."""
    out = []
    for t in range(TABLES):
        own = _slot(key, F.lit(t)).cast("long")
        out.append(F.lit(t) * size + F.when(level == 0, own).otherwise(F.pmod(F.xxhash64(level, key, F.lit(t)), size)))
    return out


def _peeling_round(cells_: DataFrame) -> DataFrame:
    """One round over rows (row, kind, size, level, cell, n, key, check).

    A cell with one digest more on one side, whose hash agrees, shows that digest. Each digest shown, by one cell or more, is taken out
    of all its cells once, and counted in cell -1. Cells that have become empty go.
    """
    key = ["row", "kind", "size", "level"]
    pure = (F.col("cell") >= 0) & (F.abs("n") == 1) & (F.col("check") == F.xxhash64("key"))
    entry = lambda cell, n, digest, check, shown: F.struct(
        cell.cast("long").alias("cell"), n.cast("long").alias("n"), digest.alias("key"), check.alias("check"), shown.alias("shown")
    )
    none = F.lit(None).cast("long")
    own = entry(F.col("cell"), F.col("n"), F.col("key"), F.col("check"), none)
    out = [entry(place, -F.col("n"), F.col("key"), F.col("check"), F.col("key")) for place in _places(F.col("key"), F.col("size"), F.col("level"))]
    counted = entry(F.lit(-1), F.lit(1), F.lit(0).cast("long"), F.lit(0).cast("long"), F.col("key"))
    rows = cells_.select(*key, F.inline(F.when(pure, F.array(own, *out, counted)).otherwise(F.array(own))))
    once = rows.groupBy(*key, "cell", "shown").agg(F.max("n").alias("n"), F.max("key").alias("key"), F.max("check").alias("check"))
    return _summed(once)


def _summed(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("row", "kind", "size", "level", "cell").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    return sums.where("cell = -1 OR n <> 0 OR key <> 0 OR check <> 0")


def peeled(pairs: DataFrame) -> DataFrame:
    """(row, kind, found) from rows (row, kind, size, level, a, b): how many digests peeling recovers from the difference of two sketches.

    ``found`` is null if cells stay filled. Adding the digests of ``a`` and taking away those of ``b`` gives the subtracted sketch, as sketches are
    sums. The pairs are dealt out once; all rounds keep that partitioning, so nothing is shuffled between them.
    """
    signed = lambda c, n: F.transform(c, lambda k: F.struct(k.alias("key"), F.lit(n).cast("long").alias("n")))
    dealt = pairs.repartition("row", "kind")
    rows = dealt.select("row", "kind", "size", "level", F.inline(F.concat(signed("a", 1), signed("b", -1))))
    placed = rows.select("*", F.explode(F.array(*_places(F.col("key"), F.col("size"), F.col("level")))).alias("cell"), F.xxhash64("key").alias("check"))
    cells_ = _summed(placed)
    for _ in range(ROUNDS):
        cells_ = _peeling_round(cells_)
    ends = cells_.groupBy("row", "kind").agg(F.max(F.when(F.col("cell") == -1, F.col("n"))).alias("n"), F.count_if(F.col("cell") >= 0).alias("filled"))
    return ends.select("row", "kind", F.when(F.col("filled") == 0, F.coalesce("n", F.lit(0))).alias("found"))


def likeness(pairs: DataFrame) -> DataFrame:
    """(row, kind, likeness) from rows (row, kind, a, b) of digest arrays: shared paragraphs of all paragraphs of two versions.

    First the fingerprints are subtracted and peeled. Pairs on which that fails are tried again with sketches of as many slots a table as both
    have paragraphs, then with four times as many, and what fails even then is compared digest by digest.
    """
    total = F.size("a") + F.size("b")
    left, done = pairs, []
    for level in range(LEVELS):
        size = F.lit(SLOTS) if level == 0 else total * 4 ** (level - 1)
        tried = peeled(left.withColumn("size", size.cast("long")).withColumn("level", F.lit(level)))
        # a pair without rows left was equal from the start
        both = left.join(tried.withColumn("tried", F.lit(True)), ["row", "kind"], "left")
        both = saved(both.withColumn("found", F.when(F.col("tried").isNull(), F.lit(0)).otherwise(F.col("found"))).drop("tried"), "peeled")
        done.append(both.where("found IS NOT NULL").select("row", "kind", "found", total.alias("total")))
        left = both.where("found IS NULL").drop("found")
    exact = F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a"))
    found = left.select("row", "kind", exact.cast("long").alias("found"), total.alias("total"))
    for part in done:
        found = found.union(part)
    return found.select("row", "kind", ((F.col("total") - F.col("found")) / (F.col("total") + F.col("found"))).alias("likeness"))


def written(sketch: Column) -> Column:
    """Filled cells as number:count:digests:hashes, the last two in hexadecimal."""
    numbered = F.transform(sketch, lambda c, i: F.when(c["n"] != 0, F.concat_ws(":", i, c["n"], F.lower(F.hex(c["key"])), F.lower(F.hex(c["check"])))))
    return F.array_join(numbered, ",")


def previous_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, prev_id) for each distinct id; the first follows the last. Ids are dealt by range; windows hold one range each."""
    ids = docs.select("doc_id").distinct().repartitionByRange(F.col("doc_id").asc_nulls_first())
    ids = saved(ids.withColumn("part", F.spark_partition_id()), "ids")
    order = F.col("doc_id").asc_nulls_first()
    ends = ids.groupBy("part").agg(F.max_by("doc_id", F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("end"))
    by_part = Window.orderBy("part")
    last = F.last("end").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("part", F.when(F.row_number().over(by_part) == 1, last).otherwise(F.lag("end").over(by_part)).alias("before"))
    own = Window.partitionBy("part").orderBy(order)
    ranked = ids.withColumn("place", F.row_number().over(own)).withColumn("prev", F.lag("doc_id").over(own))
    both = ranked.join(ends, "part")
    return saved(both.select("doc_id", F.when(F.col("place") == 1, F.col("before")).otherwise(F.col("prev")).alias("prev_id")), "neighbours")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, head, next_digests): each row of ``docs`` with the first code points of the next larger ``doc_id``'s text, half as many as
    its own, and the digests of that text; null texts are empty.

    Of rows that share a ``doc_id``, the least text is the one that others see. Only the head of a text moves to its neighbour.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ids = previous_ids(docs).withColumnRenamed("doc_id", "id")
    sizes = base.groupBy("doc_id").agg(F.max(F.char_length("text")).alias("prev_size"), F.count("*").alias("rows"))
    sizes = saved(sizes, "sizes")
    before = saved(ids.join(sizes.drop("rows"), ids["prev_id"].eqNullSafe(sizes["doc_id"])).select("id", "prev_id", "prev_size"), "before")
    once = base if not sizes.where("rows > 1").limit(1).count() else base.groupBy("doc_id").agg(F.min("text").alias("text"))
    head = F.substr("text", F.lit(1), F.floor(F.col("prev_size") / 2).cast("int"))
    following = once.join(before, once["doc_id"].eqNullSafe(before["id"])).select("prev_id", head.alias("head"), digests(F.col("text")).alias("next_digests"))
    return base.join(following, base["doc_id"].eqNullSafe(following["prev_id"]), "left").drop("prev_id")


def edited(text: Column, other: Column) -> Column:
    """``text`` whose last half of code points, rounded down, gives way to the first as many of ``other``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.char_length(text) - half), F.substr(other, F.lit(1), half))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of ``docs``.

    The fingerprint is a sketch of the set of paragraphs, so equal texts have equal ones. Likeness is the number of shared paragraphs by
    that of all, 1 for equal sets and 0 for disjoint ones.

    Null or empty text is one empty paragraph. Long lines are cut at words chosen by their hash, so a long text of one line has several. A very
    long text is read whole, and its digests are one row's worth of memory. Of ids that tie, the least text is the next one. A null ``doc_id`` comes before all others. A single document follows itself. Repeated rows give
    equal results. An empty table gives an empty table. Other columns are not returned.
    """
    pairs = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("head")))
    keyed = pairs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"),
        digests(F.col("edited")).alias("edited"),
        F.col("next_digests").alias("next"),
    )
    keyed = saved(keyed, "digests")
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col("own").alias("a"), F.col(c).alias("b")) for i, c in enumerate(("edited", "next"))])
    near = likeness(keyed.select("row", F.inline(kinds)))
    near = near.groupBy("row").agg(*[F.max(F.when(F.col("kind") == i, F.col("likeness"))).alias(f"near_{n}") for i, n in enumerate(("edited", "next"))])
    prints = keyed.select(
        "row", "doc_id", "n_chars", "edited_sha256", written(cells(F.col("own"))).alias("fingerprint"), written(cells(F.col("edited"))).alias("edited_fingerprint")
    )
    return prints.join(near, "row").drop("row")
