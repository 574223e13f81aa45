"""Line deduplication: normalised lines found in many documents go, except in one of them."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import BLANKS, bounded_broadcast, fresh, saved, spread_join

MIN_CHARS = 40
MIN_DOCUMENTS = 5
LOOKED_UP = 64  # keys a document may lose for its lines to be looked up among them one by one
BROADCAST_KEYS = 200_000


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case.

    ``lower`` changes letters beyond A-Z as well, so lines that hold such letters take the slower ``translate``.
    """
    bare = F.btrim(line, F.lit(BLANKS))
    beyond = (F.octet_length(bare) != F.char_length(bare)) & bare.rlike(r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]")
    return F.when(beyond, F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(bare))


def key_hash(line: Column) -> Column:
    """128 bits of the key."""
    key = line_key(line)
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, key): hashes of the keys whose lines ``doc_id`` loses.

    The pairs (key, document) are made distinct where they are read and once more after a shuffle by both; counting documents per key then adds up
    partial counts. A key of very many documents meets its keeper by broadcast, so no line gathers in one task.
    """
    lines = docs.select("doc_id", F.explode(split_lines(F.col("text"))).alias("line"))
    long_enough = lines.where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= min_chars)
    pairs = saved(long_enough.select(key_hash(F.col("line")).alias("key"), "doc_id").distinct(), "lines")
    common = pairs.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_documents)
    met = spread_join(pairs, saved(common, "common-lines"), ["key"], "n", pairs.count(), most_rows=BROADCAST_KEYS)
    return met.where(F.col("n").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "key")


def _rebuilt(docs: DataFrame, lost: DataFrame, n_lines: str, left: str) -> DataFrame:
    """``docs`` with the lines that stay in ``left``, for documents that lose many keys: lines are rows that meet the lost keys in a join."""
    row, doc = fresh(docs, "row"), F.col("doc_id").alias("of")
    rows = saved(docs.withColumn(row, F.monotonically_increasing_id()), "long-documents")
    lines = rows.select(F.col(row).alias("row"), doc, F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    lines = lines.withColumn("key", F.when(F.char_length("line") > 0, key_hash(F.col("line"))))
    gone = lost.select(F.col("doc_id").alias("loser"), F.col("key").alias("lost_key"))
    stay = lines.join(gone, F.col("of").eqNullSafe(F.col("loser")) & (F.col("key") == F.col("lost_key")), "left_anti")
    kept = stay.groupBy(F.col("row").alias("kept_row")).agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("kept"))
    both = rows.join(kept, F.col(row) == F.col("kept_row"), "left").drop("kept_row")
    both = both.withColumn(left, F.coalesce(F.transform("kept", lambda x: x["line"]), F.array().cast("array<string>"))).drop("kept", row)
    return both.withColumn(n_lines, F.size(split_lines(F.col("text"))).cast("long"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, looked_up: int = LOOKED_UP) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that stay, in their order, and the counts ``n_lines`` and ``n_dropped``.

    A key is a line without blanks at both ends and with A-Z in lower case. Keys of at least ``min_chars`` code points that stand in at
    least ``min_documents`` documents lose all their lines except in the largest ``doc_id`` that holds them, which keeps all of its own.
    Documents that lose up to ``looked_up`` keys look each line up among them; the lines of others are joined, so work grows with the lines.

    Null or empty text is one empty line, and gives empty text. A null ``doc_id`` is a document like any other, smaller than all
    others. Rows that share a ``doc_id`` are one document when keys are counted and lose the same lines. A document that loses every line
    stays with empty text. A very long text is split whole, and its lines are one row's worth of memory. An empty table gives an empty table.
    Other columns pass through; if ``n_lines`` or ``n_dropped`` are among them, the counts replace them.
    """
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    docs = docs.select(*keep)
    loser, gone, n_lines, left = (fresh(docs, c) for c in ("lost_by", "gone", "n_lines", "left_lines"))
    lost = saved(repeated_lines(docs, min_chars, min_documents), "lost-lines")
    per_doc = lost.groupBy(F.col("doc_id").alias(loser)).agg(F.count("*").alias("n"), F.collect_list("key").alias(gone))
    few = per_doc.where(F.col("n") <= looked_up).drop("n")
    lines = split_lines(F.col("text"))
    looked = F.filter(lines, lambda line: (F.char_length(line) < min_chars) | ~F.array_contains(F.col(gone), key_hash(line)))

    def plain(rows: DataFrame) -> DataFrame:
        both = rows.join(few, rows["doc_id"].eqNullSafe(few[loser]), "left")
        return both.withColumn(left, F.when(F.col(gone).isNull(), lines).otherwise(looked)).withColumn(n_lines, F.size(lines).cast("long")).drop(gone, loser)

    many = lost.groupBy(F.col("doc_id").alias(loser)).agg(F.count("*").alias("n")).where(F.col("n") > looked_up).select(loser)
    if many.limit(1).count():
        many = bounded_broadcast(saved(many, "losers-of-many"), BROADCAST_KEYS)
        on = docs["doc_id"].eqNullSafe(many[loser])
        out = plain(docs.join(many, on, "left_anti")).unionByName(_rebuilt(docs.join(many, on, "left_semi"), lost, n_lines, left))
    else:
        out = plain(docs)
    text = F.array_join(F.col(left), "\n")
    n_dropped = (F.col(n_lines) - F.size(left)).cast("long")
    return out.select(
        *[(text.alias("text") if c == "text" else F.col(c)) for c in docs.columns], F.col(n_lines).alias("n_lines"), n_dropped.alias("n_dropped")
    )
