"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers. SQL functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import among_first, bounded_broadcast, fresh, saved

# kind: (pattern, least characters of the whole match, least characters of group 2)
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = {
    "assign": (ASSIGN, 0, 12),
    "access": ("AKIA[A-Z0-9]+", 18, 0),
    "hex": ("[0-9a-f]+", 16, 0),
}
# What a text must hold for a kind to occur at all; cheaper to search for than all matches are to list.
HINTS = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": "AKIA", "hex": "[0-9a-f]{16}"}
CANDIDATE = "[A-Za-z0-9+/_=-]{12,}"
PLAIN = "(?<![A-Za-z0-9+/_=-])[A-Za-z+/_=-]{12,}(?![A-Za-z0-9+/_=-])"  # tokens that may be candidates, without digits
NUMBER = "[0-9]{6,}"
WORD_IN_NAMES = "(?<![A-Za-z0-9+/_=-])[A-Za-z]{2,10}(?![A-Za-z0-9+/_=-])"
STEP = 29  # every so many words of a text begin a name that is made of words
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(ALPHABET) + 1  # the last for all other characters
SAMPLE = 4_000  # documents that ordinary identifiers are learned from
MIN_RATIO = 10.0  # nats, at least; the threshold itself comes from the share of ordinary identifiers that pass it
FALSE_SHARE = 2e-3
SPAN = "array<struct<start:bigint,kind_order:int,kind:string,end:bigint,value:string>>"


def spans_of(text: Column, pattern: str, kind: str, order: int, hint: str, min_match: int = 0, min_group: int = 0, value_group: int = 0) -> Column:
    """Matches of ``pattern``, leftmost and non-overlapping, as (start, kind_order, kind, end, value); positions in code points.

    The pieces between the matches and the matches themselves lie in turn, so their lengths add up to the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("between"), found.alias("match"), values.alias("value"))
    none = F.array().cast(SPAN)
    empty = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["between"])
        end = start + F.coalesce(F.char_length(part["match"]), F.lit(0))
        long_enough = part["match"].isNotNull() & (end - start >= min_match) & (F.char_length(part["value"]) >= min_group)
        one = F.array(F.struct(start.alias("start"), F.lit(order).alias("kind_order"), F.lit(kind).alias("kind"), end.alias("end"), part["value"].alias("value")))
        spans = F.when(long_enough, F.concat(state["spans"], one.cast(SPAN))).otherwise(state["spans"])
        return F.struct(end.cast("long").alias("at"), spans.alias("spans"))

    return F.when(text.rlike(hint), F.aggregate(parts, empty, step)["spans"]).otherwise(none)


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text`` but with ``base``, the spans of the fixed patterns, and ``tokens``, long tokens that none of them touches."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base, tokens = fresh(docs, "base"), fresh(docs, "tokens")
    found = [
        # A run of 16 or more is what passes of all runs, and shorter ones need not be listed.
        spans_of(text, pattern.replace("+", f"{{{least},}}") if kind == "hex" else pattern, kind, i, HINTS[kind], least, group, 2 if group else 0)
        for i, (kind, (pattern, least, group)) in enumerate(KINDS.items())
    ]
    out = docs.withColumn(base, F.array_sort(F.concat(*found)))
    out = out.withColumn(tokens, spans_of(text, CANDIDATE, "markov", len(KINDS), CANDIDATE))
    apart = lambda t: ~F.exists(F.col(base), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    return out.withColumn(tokens, F.filter(tokens, apart)).drop("text")


def transition_counts(strings: DataFrame) -> DataFrame:
    """(state, n): how often each pair of neighbouring characters occurs in the strings of column ``value``; a state is a pair's number."""
    pairs = strings.select("value", F.explode(F.sequence(F.lit(1), F.char_length("value") - 1)).alias("i"))
    return pairs.select(_pair(F.col("value"), F.col("i")).alias("state")).groupBy("state").agg(F.count("*").alias("n"))


def _pair(value: Column, i: Column) -> Column:
    """Number of the pair of characters at ``i``, which counts from 1, and after it."""
    one = lambda k: F.pmod(F.position(F.substr(value, k, F.lit(1)), F.lit(ALPHABET)) - 1, F.lit(STATES))
    return one(i) * STATES + one(i + 1)


def log_ratios(random: dict[int, int], ordinary: dict[int, int], backing: float = 5.0, smooth: float = 0.5) -> list[float]:
    """For each pair of states, the log-likelihood ratio of the second given the first; at most ``STATES`` squared numbers.

    A state seen rarely falls back on how often the second occurs at all, with the weight of ``backing`` observations.
    """

    def model(counts: dict[int, int]) -> list[float]:
        rows = [[counts.get(a * STATES + b, 0) for b in range(STATES)] for a in range(STATES)]
        second = [sum(row[b] for row in rows) + smooth for b in range(STATES)]
        total = sum(second)
        return [math.log((x + backing * second[b] / total) / (sum(row) + backing)) for row in rows for b, x in enumerate(row)]

    return [a - b for a, b in zip(model(random), model(ordinary))]


def made_names(words: Column, salt: Column) -> Column:
    """Names as people and programs make them, from runs of three words of a text: joined in several ways, encoded, hashed to identifiers, or dates."""

    def one(words: Column, i: Column) -> Column:
        a, b, c = (F.get(words, i + k) for k in range(3))
        draw = F.xxhash64(salt, i)
        part = lambda k, least, many, width=2: F.lpad((F.pmod(F.call_function("shiftright", draw, F.lit(k)), F.lit(many)) + least).cast("string"), width, "0")
        day = F.concat_ws("-", part(8, 1990, 40, 4), part(14, 1, 12), part(18, 1, 28))
        identifier = F.regexp_replace(F.md5(F.concat(a, b, c).cast("binary")), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
        kinds = [
            F.lower(F.concat_ws("_", a, b, c)),
            F.lower(F.concat_ws("-", a, b, c)),
            F.concat(F.lower(a), F.initcap(b), F.initcap(c)),
            F.concat(F.initcap(a), F.initcap(b), F.initcap(c)),
            F.upper(F.concat_ws("_", a, b, c)),
            F.concat_ws("/", a, b, c),
            F.base64(F.concat_ws(" ", a, b, c).cast("binary")),
            F.when(F.pmod(draw, F.lit(3)) == 0, F.upper(identifier)).otherwise(identifier),
            F.concat(day, F.lit("T"), F.concat_ws("-", part(24, 0, 24), part(30, 0, 60), part(36, 0, 60)), F.lit("Z")),
            F.concat(F.lower(F.concat_ws("-", a, b)), F.lit("-"), part(42, 0, 999, 3)),
        ]
        return F.get(F.array(*kinds), F.pmod(F.call_function("shiftright", draw, F.lit(48)), F.lit(len(kinds))).cast("int"))

    def names(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0)), F.lit(STEP))
        return F.when(F.size(words) >= 3, F.transform(starts, lambda i: one(words, i))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(F.array(words), names))  # so that the words are listed once, not at each use


def ordinary_names(docs: DataFrame) -> DataFrame:
    """(value, made) of the texts of ``docs`` outside the fixed patterns: long tokens without digits, numbers, and names ``made`` of their words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    for pattern, _, _ in (KINDS["assign"], KINDS["access"], ("[0-9a-f]{16,}", 0, 0)):
        text = F.regexp_replace(text, pattern, " ")
    listed = lambda pattern: F.regexp_extract_all(F.col("plain"), F.lit(pattern), F.lit(0))
    plain = docs.select("doc_id", text.alias("plain"))
    plain = plain.select("doc_id", F.concat(listed(PLAIN), listed(NUMBER)).alias("found"), listed(WORD_IN_NAMES).alias("words"))
    names = plain.select("found", made_names(F.col("words"), F.col("doc_id")).alias("made"))
    both = names.select(F.explode("found").alias("value"), F.lit(False).alias("made")).unionAll(names.select(F.explode("made").alias("value"), F.lit(True).alias("made")))
    return both.where(F.char_length("value") > 1)


def trained(docs: DataFrame, found: DataFrame, sample: int = SAMPLE, min_ratio: float = MIN_RATIO, false_share: float = FALSE_SHARE) -> tuple[list[float], float]:
    """Log-likelihood ratios from both models, and the threshold.

    Random strings are the values of all spans of the fixed patterns in ``found``, and a digest in base 64 for each document of the sample.
    Ordinary ones are the names in the ``sample`` documents with the least hashed ids. Of those that are made of words, and so known to be no
    secrets, half, by hash, train the model as well; of the other half a share of ``false_share`` passes the threshold, which is
    ``min_ratio`` at least. Only counts per pair of characters and the threshold reach the driver.
    """
    key = F.xxhash64("doc_id", F.lit(8))
    ids = docs.select("doc_id").where(among_first(key, sample, F.lit(docs.count()))).distinct().orderBy(key, "doc_id").limit(sample)
    ids = saved(ids, "sample")
    own = docs.select(F.col("doc_id").alias("id"), "text").join(bounded_broadcast(ids, sample), F.col("id").eqNullSafe(F.col("doc_id")))
    digest = F.base64(F.unhex(F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)))
    random = found.select(F.explode("base.value").alias("value")).where(F.char_length("value") > 1)
    random = random.unionByName(ids.select(F.rtrim(digest, F.lit("=")).alias("value")))
    names = saved(ordinary_names(own), "ordinary-names")
    learns = ~F.col("made") | (F.pmod(F.xxhash64("value", F.lit(9)), F.lit(2)) == 0)
    counts = [{r["state"]: r["n"] for r in transition_counts(part).collect()} for part in (random, names.where(learns).select("value"))]
    table = log_ratios(*counts)
    passed = names.where(~learns & (F.char_length("value") >= 12)).agg(F.percentile(ratio(F.col("value"), table), F.lit(1 - false_share))).first()[0]
    return table, max(min_ratio, passed or 0.0)


def ratio(value: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string of at least two characters."""
    weights = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    steps = F.sequence(F.lit(1), F.char_length(value) - 1)
    return F.aggregate(steps, F.lit(0.0), lambda total, i: total + F.element_at(weights, (_pair(value, i) + 1).cast("int")))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def with_secrets(docs: DataFrame, min_ratio: float = MIN_RATIO, sample: int = SAMPLE, false_share: float = FALSE_SHARE) -> DataFrame:
    """``docs`` without ``text`` but with ``base`` and ``added``: arrays of (start, kind_order, kind, end, value), each sorted by start and kind.

    ``added`` are tokens of at least 12 characters, apart from all base spans, whose log-likelihood ratio of random to ordinary
    transitions reaches the threshold of ``trained``.

    Null or empty text has no spans. A null ``doc_id`` is a document like any other, and repeated rows have equal spans. Spans with the same
    start are sorted by kind. A very long text is searched whole. Without any base span the random model knows digests only. An empty
    table gives an empty table. Columns named ``base`` or ``added`` are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("base", "tokens", "added")])
    found = saved(scanned(docs), "secrets")
    table, threshold = trained(docs, found, sample, min_ratio, false_share)
    return found.withColumn("added", F.filter("tokens", lambda t: ratio(t["value"], table) > threshold)).drop("tokens")
