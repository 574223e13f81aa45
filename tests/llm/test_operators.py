"""Each operator against a plain Python version, on odd rows, and on an empty table."""

import collections
import math
import random
import string
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import class_lm, components, fingerprints, language_id, line_dedup, mixing, near_dedup, packing, quality, secrets, substring_dedup


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


# 1 ---------------------------------------------------------------------------

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_quality_counts(which, request):
    frame = request.getfixturevalue(which)
    got = quality.judged(frame).collect()
    texts = collections.defaultdict(set)
    for i, t in pairs(frame):
        texts[i].add(brute.quality(t))
    assert len(got) == frame.count()
    assert all(tuple(r[c] for c in COUNTS) in texts[r["doc_id"]] for r in got)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_fences(spark):
    plain = [(i, f"w{i} " + " ".join(f"some{(i * 7 + k * k) % 91}word" for k in range(60)), "en", f"s{i % 2}") for i in range(500)]
    junk = [(900, " ".join(f"wor##d{k}$$" for k in range(60)), "en", "s0"), (901, " ".join("x" * 60 + str(k) for k in range(60)), "en", "s9")]
    frame = spark.createDataFrame(plain + junk, "doc_id long, text string, lang string, source string")
    kept = by_id(quality.judged(frame), "kept")
    assert [i for i, (k,) in kept.items() if not k] == [900, 901] or sorted(i for i, (k,) in kept.items() if not k) == [900, 901]
    assert quality.filtered(frame).columns == frame.columns


def test_quality_repeat_and_line_fences_reject(spark):
    """One document in 300 repeats a fifth of its words, one an eighth of its lines: the base rule passes both, the fences do not."""
    word = lambda i, k: f"w{(i * 7919 + k * 104729) % 99991}"
    line = lambda i, k: " ".join(word(i, k * 6 + j) for j in range(6))
    docs = []
    for i in range(300):
        some = [word(i, k) for k in range(120)]
        docs.append((i, " ".join(some + some[:8] * (i % 2)), "en", "a"))
    mild = [(1000 + i, "\n".join([line(i, k) for k in range(18)] + [line(i, 0)]), "en", "a") for i in range(300)]
    words = [word(900, k) for k in range(100)]
    bad = [(5000, " ".join(words + words[:14]), "en", "a"), (5001, "\n".join([line(901, 1 if k in (5, 10, 15) else k) for k in range(23)]), "en", "a")]
    rows = {r["doc_id"]: r for r in quality.judged(spark.createDataFrame(docs + mild + bad, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(r["base_failed"] for r in rows.values())
    assert {i for i, r in rows.items() if not r["kept"]} == {5000, 5001}


def _worded(i, n, repeated=0, symbols=0):
    some = [f"w{(i * 7919 + k * 104729) % 99991}" + ("#" if k < symbols else "") for k in range(n)]
    return " ".join(some + some[:repeated])


def test_quality_judges_small_and_large_groups_alike(spark):
    """A source whose texts hold many symbols is kept, however many documents it has; so are documents that repeat a little."""
    plain = [(i, _worded(i, 80), "en", "web") for i in range(1500)]
    for n in (20, 199, 200):
        code = [(10_000 + i, _worded(i, 60, symbols=50), "en", "code") for i in range(n)]
        kept = by_id(quality.judged(spark.createDataFrame(plain + code, "doc_id long, text string, lang string, source string")), "kept")
        assert all(k for k, in kept.values())
    mild = [(20_000, _worded(1, 100, 8), "en", "web"), (20_001, _worded(2, 100, 9), "en", "web")]
    for some in (mild, mild[:1], mild + [(30_000 + i, _worded(50 + i, 100, 8), "en", "web") for i in range(18)]):
        kept = by_id(quality.judged(spark.createDataFrame(plain[:400] + some, "doc_id long, text string, lang string, source string")), "kept")
        assert all(k for k, in kept.values())


def test_quality_verdicts_equal_plain_python(docs):
    """Every verdict from fences made anew: sketches as counters, merged and read in plain Python."""
    rows = [r.asDict() for r in quality.judged(docs).collect()]
    shares = lambda r: {
        "symbol_share": r["n_symbols"] / r["word_chars"] if r["word_chars"] else 0.0,
        "dup_line_share": r["n_dup_lines"] / r["n_lines"] if r["n_lines"] else 0.0,
        "repeat_share": r["n_repeat_words"] / r["n_words"] if r["n_words"] else 0.0,
        "word_length": r["word_chars"] / r["n_words"] if r["n_words"] else 0.0,
    }
    bucket = lambda x: math.ceil(math.log(x) / math.log(1.02)) if x > 0 else -(10**9)
    middle = lambda b: 0.0 if b == -(10**9) else 2 * 1.02**b / 2.02
    fences = {}
    for name, least in quality.FEATURES.items():
        own, lang, every = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.Counter()
        for r in rows:
            if not r["base_failed"]:
                b = bucket(shares(r)[name])
                for c in (own[r["lang"], r["source"]], lang[r["lang"]], every):
                    c[b] += 1
        for (lg, source), counts in own.items():
            n = sum(lang[lg].values())
            weight = {b: counts[b] * 10**6 + math.floor(50e6 * ((lang[lg][b] + 50 * (every[b] / sum(every.values()))) / (n + 50))) for b in every}
            upto, total, zeros, found = 0, sum(weight.values()), weight.get(-(10**9), 0), {}
            one = math.floor(50e6 * ((1 + 50 * (1.0 / sum(every.values()))) / (n + 50))) + 10**6 + 1
            rank = total - zeros - max((total - zeros) // 100, one)
            for b in sorted(weight):
                upto += weight[b]
                if 4 * upto >= total:
                    found.setdefault("q25", middle(b))
                if 4 * upto >= 3 * total:
                    found.setdefault("q75", middle(b))
                if b > -(10**9) and rank > 0 and upto - zeros >= rank:
                    found.setdefault("upper", 1.02**b)
            spread = max(found["q75"] - found["q25"], least) * 4
            fences[lg, source, name] = (found["q25"] - spread, found["q75"] + spread) if name == "word_length" else (-1.0, max(1.5 * found.get("upper", 0), least))
    for r in rows:
        ok = not r["base_failed"]
        for name, x in shares(r).items():
            low, high = fences.get((r["lang"], r["source"], name), (-1.0, math.inf))
            ok = ok and low <= x <= high
        assert r["kept"] == ok


def test_quality_passes_columns_and_empty(odd, none):
    assert quality.filtered(odd).columns == odd.columns
    assert quality.judged(none).count() == 0


# 2 ---------------------------------------------------------------------------


def test_mix_reaches_targets(docs):
    rows = mixing.with_copies(docs).collect()
    sources = sorted({r["source"] for r in rows})
    for r in rows:
        assert r["size"] == len(brute.words(r["text"])) and 0 <= r["copies"] <= 2
    total = sum(r["size"] for r in rows)
    target = {r["source"]: (r["target"], r["source_size"]) for r in rows}
    assert sum(t for t, _ in target.values()) == pytest.approx(1.5 * total)
    free = [t / [5, 2, 1][i % 3] for i, s in enumerate(sources) for t, n in [target[s]] if t < 2 * n]
    assert max(free) == pytest.approx(min(free))
    assert all(t <= 2 * n for t, n in target.values())


def test_mix_odd(odd, none):
    counted = mixing.with_copies(odd)
    taken = sum(r["copies"] for r in counted.collect())
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == taken
    assert {r["size"] for r in mixed.collect()} == {"size"}
    assert mixing.mix(none).count() == 0
    again = mixing.with_copies(odd.repartition(5))
    key = lambda f: sorted((r["doc_id"] or 0, r["text"] or "", r["copies"]) for r in f.collect())
    assert key(counted) == key(again)


# 3 ---------------------------------------------------------------------------


def test_class_lm_base(docs, texts):
    model, counts = class_lm.learned(docs, head=500, placed=200, core=60)
    rows = class_lm.scored(docs, model, counts).collect()
    want, n = brute.class_base(texts)
    for r in rows:
        tokens, known, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0 and r["perplexity"] > 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    # a head of every word gives the same scores as one of few
    wide, counts = class_lm.learned(docs, placed=200, core=60)
    assert by_id(class_lm.scored(docs, wide, counts), "n_known") == {r["doc_id"]: (r["n_known"],) for r in rows}


def test_class_probabilities_add_up(docs):
    model, counts = class_lm.learned(docs, head=10_000_000, placed=200, core=60)
    assert (10**model.transition).sum(axis=1) == pytest.approx(np.ones(class_lm.CLASSES + 1))
    own = np.bincount(model.head_class, weights=10 ** model.emission(model.counts, model.head_class), minlength=class_lm.CLASSES + 1)
    unseen = 10 ** model.emission(np.zeros(class_lm.CLASSES + 1), np.arange(class_lm.CLASSES + 1))
    assert (own + unseen)[: class_lm.CLASSES] == pytest.approx(np.ones(class_lm.CLASSES))


def test_exchange_finds_blocks():
    rng = np.random.default_rng(1)
    kind = np.arange(40) % 2
    table = np.where(kind[:, None] != kind[None], 50, 1) + rng.integers(0, 3, (40, 40))
    group = class_lm.exchanged(table, 2)
    assert len({tuple(group[kind == k]) for k in (0, 1)}) == 2 and all(len(set(group[kind == k])) == 1 for k in (0, 1))


def test_class_lm_odd(odd, none):
    model, counts = class_lm.learned(odd)
    out = class_lm.scored(odd, model, counts)
    rows = out.collect()
    assert len(rows) == odd.count() and [c for c in odd.columns if c != "text"] == out.columns[: len(odd.columns) - 1]
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert len({(r["score"], r["base_score"]) for r in rows if r["doc_id"] == 10}) == 1
    assert class_lm.scored(none, *class_lm.learned(none)).count() == 0
    assert class_lm.scored(odd, *class_lm.learned(none)).where("score > 0 OR n_known > 0").count() == 0


# 4 ---------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_fingerprints(which, request):
    frame = request.getfixturevalue(which)
    rows = [(i, t or "") for i, t in pairs(frame)]
    order = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0))
    text = {i: min(t for j, t in rows if j == i) for i in order}
    after = {i: text[order[(k + 1) % len(order)]] for k, i in enumerate(order)}
    got = fingerprints.fingerprinted(frame).collect()
    assert len(got) == len(rows)
    prints = {}
    for r in got:
        a, x = text[r["doc_id"]], after[r["doc_id"]]
        half = len(a) // 2
        e = a[: len(a) - half] + x[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(a), brute.sha(e))
        assert (r["near_edited"], r["near_next"]) == (pytest.approx(brute.likeness(a, e)), pytest.approx(brute.likeness(a, x)))
        assert prints.setdefault(a, r["fingerprint"]) == r["fingerprint"]


def test_peeling_recovers_or_fails(spark):
    rows = [(k, 0, [f"a{i}" for i in range(400)], [f"a{i}" for i in range(k, 400)] + [f"b{i}" for i in range(k)]) for k in (0, 1, 2, 4, 200)]
    frame = spark.createDataFrame(rows, "row long, kind int, a array<string>, b array<string>")
    keys = lambda c: fingerprints.F.transform(c, lambda x: fingerprints.F.xxhash64(x)).alias(c)
    frame = frame.select("row", "kind", keys("a"), keys("b"))
    sized = lambda size, level: frame.selectExpr("*", f"{size}L AS size", f"{level} AS level")
    small = {r["row"]: r["found"] for r in fingerprints.peeled(sized(8, 0)).collect()}
    assert small.get(0, 0) == 0 and small[1] == 2 and small[2] == 4 and small[200] is None
    large = {r["row"]: r["found"] for r in fingerprints.peeled(sized(800, 1)).collect()}
    assert {k: v for k, v in large.items() if k} == {1: 2, 2: 4, 4: 8, 200: 400}


def test_fingerprints_of_texts_of_one_line(spark):
    """A text without line feeds has paragraphs too: half of it given away, about a third of all is shared."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(4000))) for i in range(12)]
    got = fingerprints.fingerprinted(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(0.2 < r["near_edited"] < 0.45 and r["near_next"] < 0.05 for r in got)


def test_fingerprints_one_and_none(spark, none):
    one = spark.createDataFrame([(5, "a\nb")], "doc_id long, text string")
    assert fingerprints.fingerprinted(one).first()["near_next"] == 1.0
    assert fingerprints.fingerprinted(none).count() == 0


# 5 ---------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_line_dedup(which, request):
    frame = request.getfixturevalue(which)
    rows = [(-1 if i is None else i, t) for i, t in pairs(frame)]
    want = brute.line_dedup(rows)
    out = line_dedup.dedup_lines(frame)
    got = out.collect()
    assert len(got) == len(rows) and out.columns[: len(frame.columns)] == frame.columns
    for r in got:
        assert (r["n_lines"], r["n_dropped"], r["text"]) == want[-1 if r["doc_id"] is None else r["doc_id"]]


def test_line_dedup_drops_in_odd(odd, none):
    dropped = by_id(line_dedup.dedup_lines(odd), "n_dropped")
    assert dropped[5] == (2,) and dropped[19] == (0,) and dropped[9] == (1,) and dropped[None] == (1,)
    assert line_dedup.dedup_lines(none).count() == 0


# 6 ---------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_substring_dedup(which, request):
    frame = request.getfixturevalue(which)
    want = brute.cut_windows([p for p in pairs(frame) if p[0] is not None])
    got = substring_dedup.dedup_substrings(frame).collect()
    assert len(got) == frame.count()
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], brute.sha(r["text"])) == want[r["doc_id"]]
            covered = [p for s in r["spans"] for p in range(s["start"], s["start"] + s["words"])]
            assert len(covered) == len(set(covered)) == r["n_removed"] and all(s["source"] < r["doc_id"] for s in r["spans"])


def test_substring_dedup_chains(spark, none):
    """Overlapping passages from several sources, edits near window ends, and runs of one word."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    rows = []
    for i in range(40):
        a = rng.randrange(300)
        own = base[a : a + rng.randrange(40, 140)] + [f"u{i}_{k}" for k in range(rng.randrange(5))] + base[: rng.randrange(120)]
        if i % 3 == 0:
            own[rng.randrange(len(own))] = f"edit{i}"
        if i % 7 == 0:
            own += ["same"] * rng.randrange(45, 130)
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = by_id(substring_dedup.dedup_substrings(frame), "n_words", "n_removed", "text")
    assert {i: (a, b, brute.sha(t)) for i, (a, b, t) in got.items()} == brute.cut_windows(rows)
    assert substring_dedup.dedup_substrings(none).count() == 0


def _parsed_by_hand(rows, size):
    """Greedy parse, word by word: the windows of one source that follow each other are a match; at each word the match that goes on farthest."""
    source = {}
    for start, n, who in rows:
        for i in range(start, start + n):
            source.setdefault(i, set()).add(who)
    ends = {}
    for i in sorted(source, reverse=True):
        for who in source[i]:
            ends[i, who] = ends.get((i + 1, who), i + size)
    out, at = [], 0
    while at <= max(source, default=-1) + size:
        open_ = [(-end, who) for (i, who), end in ends.items() if i <= at < end]
        if open_:
            end, who = min(open_)
            out.append({"start": at, "words": -end - at, "source": who})
            at = -end
        else:
            at += 1
    return out


def test_greedy_parse_takes_the_longest_match():
    rng = random.Random(4)
    for _ in range(300):
        rows = [(rng.randrange(60), rng.randrange(1, 12), rng.randrange(4)) for _ in range(rng.randrange(1, 9))]
        assert substring_dedup.greedy_parse(np.array(rows), 6) == _parsed_by_hand(rows, 6)
    assert substring_dedup.greedy_parse(np.zeros((0, 3), int), 6) == []


def test_substring_spans_are_words_of_their_sources(spark):
    rng = random.Random(8)
    base = [[f"{c}{k}" for k in range(60)] for c in "abcd"]
    rows = []
    for i in range(30):
        own = []
        for _ in range(3):
            part = rng.choice(base)
            a = rng.randrange(30)
            own += part[a : a + rng.randrange(8, 30)] + [f"u{i}"] * rng.randrange(2)
        rows.append((i, " ".join(own)))
    words = {i: brute.words(t) for i, t in rows}
    got = by_id(substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), window=6), "n_removed", "spans")
    want = brute.cut_windows(rows, 6)
    some = 0
    for i, (removed, spans) in got.items():
        assert removed == want[i][1] == sum(s["words"] for s in spans)
        for s in spans:
            part, of = words[i][s["start"] : s["start"] + s["words"]], words[s["source"]]
            assert s["source"] < i and any(of[k : k + len(part)] == part for k in range(len(of)))
            some += 1
    assert some > 40


def test_line_dedup_is_linear_in_lost_lines(spark):
    """Documents that lose many lines are joined line by line; what is left is the same, in the same order."""
    line = lambda k: f"line number {k} that stands in every one of the documents"
    rows = [(i, "\n".join([line((k * 7 + i) % 150) for k in range(150)] + [f"own {i}", "", line(3)])) for i in range(6)] + [(9, line(1)), (None, line(2)), (2, "only\n" + line(5))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute.line_dedup([(-1 if i is None else i, t) for i, t in rows])
    texts = sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(frame, looked_up=1_000_000).collect())
    for limit in (0, 64):
        got = line_dedup.dedup_lines(frame, looked_up=limit).collect()
        assert sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"], r["text"]) for r in got) == texts
    assert all((r[1], r[2], r[3]) == want[r[0]] for r in texts if r[0] not in (0, 2))


# 7 ---------------------------------------------------------------------------


def test_near_dedup(docs, texts):
    for size, percent in ((3, 85), (5, 80)):
        got = by_id(near_dedup.near_duplicates(docs, size, percent), "n_shingles", "component_id")
        assert got == brute.near_components(texts, size, percent)


def test_near_dedup_hot_group(spark, monkeypatch):
    """A large group of edited copies, compared in many blocks, with links that only run through other copies."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    rows = []
    for i in range(160):
        own = list(base) if i % 2 else rows[rng.randrange(len(rows))][1].split() if rows else list(base)
        for _ in range(rng.randrange(1, 9)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10_000)}"
        rows.append((i * 3 + 1, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = by_id(near_dedup.near_duplicates(frame, 3, 85), "n_shingles", "component_id")
    assert got == brute.near_components(rows, 3, 85)
    assert len(set(c for _, c in got.values())) > 1


def test_near_dedup_long_sets(spark):
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in rng.integers(0, 50_000, 1200)]
    rows = []
    for i, edits in enumerate([0, 20, 38, 44, 60, 90, 200]):
        own = list(base)
        for k in rng.choice(1200, edits, replace=False):
            own[k] = f"e{i}_{k}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(near_dedup.near_duplicates(frame, 3, 85), "n_shingles", "component_id") == brute.near_components(rows, 3, 85)


def test_near_dedup_odd(odd, none):
    got = near_dedup.near_duplicates(odd, 3, 85).collect()
    assert len(got) == odd.count()
    want = brute.near_components([p for p in pairs(odd) if p[0] is not None], 3, 85)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    left = near_dedup.deduplicated(odd, 3, 85)
    assert left.columns == odd.columns and left.where("doc_id = 13").count() == 0 and left.where("doc_id IS NULL").count() == 1
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_dedup_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text + " more"), (3, "alone in here with a few words"), (3, "alone in here with a few words"), (None, text), (None, text)]
    left = near_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["doc_id"] or 0) for r in left) == [0, 0, 1, 3]


def test_texts_are_not_shuffled_to_drop_copies(spark, odd, monkeypatch):
    """Whatever Spark guesses of its size, a bounded table of lost ids goes to the texts; a larger one meets them in a shuffle, with the same rows."""
    monkeypatch.setattr(near_dedup, "near_duplicates", lambda docs, *_: docs.select("doc_id", F.lit(1).alias("n_shingles"), (F.col("doc_id") % 3 == 0).alias("kept")))
    plan = lambda df: df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    rows = odd.where("doc_id NOT IN (4, 10)").select("doc_id", "text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        near = near_dedup.deduplicated(rows)
        monkeypatch.setattr(near_dedup, "BROADCAST_LOST", 0)
        far = near_dedup.deduplicated(rows)
        assert "BroadcastHashJoin" in plan(near) and "Exchange hashpartitioning" not in plan(near)
        assert sorted(r["doc_id"] for r in near.collect()) == sorted(r["doc_id"] for r in far.collect()) == [3, 6, 9, 12, 15, 18]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_below_the_threshold_are_not_candidates(spark, monkeypatch):
    """60 documents with 0.72 of their shingles in common, in many lists together: their 1,770 pairs are not handed on."""
    draw = random.Random(7)
    word = lambda: "".join(draw.choices(string.ascii_lowercase, k=8))
    shared = [word() for _ in range(335)]
    rows = [(i, " ".join(shared + [word() for _ in range(65)])) for i in range(60)]
    rows += [(60, " ".join(shared + [word() for _ in range(12)])), (61, " ".join(shared + [word() for _ in range(12)]))]
    handed, confirmed = [], near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *rest: confirmed(handed.append(pairs.count()) or pairs, *rest))
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85), "n_shingles", "component_id")
    assert got == brute.near_components(rows, 3, 85) and got[61][1] == 60
    assert sum(handed) < 200


def test_pairs_held_against_the_least_member_are_not_compared_again(spark, monkeypatch):
    """Lists of two members, as chance makes most, are decided when these are held against each other: no row of them reaches the blocks."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choices(string.ascii_lowercase, k=8))
    rows = []
    for i in range(20):
        shared = [word() for _ in range(160)]
        rows += [(2 * i + k, " ".join(shared + [word() for _ in range(60)])) for k in (0, 1)]
    rows.append((100, rows[0][1] + " end"))
    seen, block_candidates = [], near_dedup.block_candidates
    monkeypatch.setattr(near_dedup, "block_candidates", lambda lists, *rest: block_candidates(seen.append(lists.select("rep").collect()) or lists, *rest))
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85), "n_shingles", "component_id")
    assert got == brute.near_components(rows, 3, 85) and got[100][1] == 0
    assert {r["rep"] for r in seen[0]} <= {1, 100}


def test_an_estimate_drops_a_similar_pair_with_a_stated_probability():
    for seen, sizes, percent in ((256, 800, 85), (256, 20_000, 80), (40, 100, 85), (256, 560, 80)):
        most = near_dedup.most_apart(seen, sizes, percent)
        apart = max(d for d in range(sizes) if (sizes - d) % 2 == 0 and 100 * (sizes - d) >= percent * (sizes + d))
        union = (sizes + apart) // 2
        ways = [math.comb(apart, d) * math.comb(union - apart, seen - d) for d in range(min(seen, apart) + 1)]
        beyond = lambda x: sum(ways[x + 1 :]) / math.comb(union, seen)
        assert beyond(most) <= near_dedup.MISSED * 1.001 and (not most or beyond(most - 1) > near_dedup.MISSED * 0.999)


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}


# 8 ---------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_secrets(which, request):
    frame = request.getfixturevalue(which)
    want = dict(pairs(frame))
    out = secrets.with_secrets(frame)
    got = out.select("doc_id", secrets.written(secrets.F.col("base")).alias("spans"), "added").collect()
    assert len(got) == frame.count()
    for r in got:
        assert r["spans"] == brute.secret_spans(want[r["doc_id"]])


def test_secrets_model_adds_random_strings(odd, none, spark):
    rng = random.Random(4)
    letters = string.ascii_letters + string.digits
    rows = [(i, f"key token={''.join(rng.choices(letters if i % 2 else 'abcdef0123456789', k=24))} and nothing") for i in range(400)]
    rows += [(1000 + i, "ordinary_identifier internationalization counterintuitive straightforwardly misunderstandings " * 3) for i in range(100)]
    rows += [(5000, "here qX7zR2mW9kTb4vLp8sNd stands"), (5001, "here internationalizations stands"), (5002, "number 4562298812442145 stands")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    added = {r["doc_id"]: [s["value"] for s in r["added"]] for r in secrets.with_secrets(frame).where("size(added) > 0").collect()}
    assert added == {5000: ["qX7zR2mW9kTb4vLp8sNd"]}
    assert secrets.with_secrets(none).count() == 0


def test_secret_models_tell_names_from_random_strings(spark):
    """Names of several kinds stay, strings drawn at random are found, the surer the longer they are."""
    rng = random.Random(6)
    vocabulary = """the of and to in is was for on that with as by at from this which or are were been have has not but other some such only new can
    number people water world hand part place year work first name great form sentence small sound large group often important example begin along
    children between country factory public abstract become course simple quickly company several problem before against morning history machine
    language function object value order table bright travel pattern receive nothing thought figure building produce measure question""".split()
    letters = string.ascii_letters + string.digits
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(200)) + (f" token={''.join(rng.choices(letters, k=30))}" if i % 3 == 0 else "")) for i in range(600)]
    named = ["550e8400-E29B-41d4-A716-446655440000", "2024-01-15T10-30-00Z", "SGVsbG8gd29ybGQh", "AbstractBeanFactoryImpl", "ordinary_identifier_of_mine"]
    rows += [(2000 + k, f"see {name} here") for k, name in enumerate(named)]
    planted = {n: ["".join(rng.choices(letters, k=n)) for _ in range(60)] for n in (12, 16, 24)}
    rows += [(10_000 + 100 * n + k, f"set {value} once") for n, values in planted.items() for k, value in enumerate(values)]
    added = {r["doc_id"]: [s["value"] for s in r["added"]] for r in secrets.with_secrets(spark.createDataFrame(rows, "doc_id long, text string")).where("size(added) > 0").collect()}
    assert not [i for i in added if i < 10_000]
    share = {n: sum(10_000 + 100 * n + k in added for k in range(60)) / 60 for n in planted}
    assert share[12] >= 0.6 and share[16] >= 0.8 and share[24] >= 0.95


def test_secret_positions_count_code_points(spark):
    text = "né 日本 😀 password = 'abcdef.012345' password: token = \"abcdefghijkl\""
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = secrets.scanned(frame).select(secrets.written(secrets.F.col("base")).alias("s")).first()["s"]
    assert got == brute.secret_spans(text)


# 9 ---------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing(which, request):
    import public_tokenizers
    from tokenizers import Tokenizer

    frame = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = pairs(frame)
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in rows}
    got = packing.packed(frame).collect()
    assert sum(r["length"] for r in got) == sum(len(ids[i]) for i, _ in rows)
    bins = collections.defaultdict(list)
    for r in got:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(bins) == list(range(len(bins)))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_special_strings_and_odd_words():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    words = ["Don't", "<|endoftext|>", "a<|endoftext|>b", "<|", "naïve", "é", "́x", "日本", "x y", "😀", "ΣΑΣ", "12", ""]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.word_ids(tokenizer, words)]
    assert got == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    text = "  ".join(words)
    assert sum(got, []) == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_encoded_a_few_thousand_at_a_time():
    """What a tokenizer returns is far larger than the ids of the words, so its size must not follow that of a slice."""
    import public_tokenizers
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self):
            self.inner, self.most = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)), 0

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **options):
            self.most = max(self.most, sum(t.count("<|endoftext|>") + 1 for t in texts))
            return self.inner.encode_batch_fast(texts, **options)

    tokenizer = Counting()
    words = [f"w{i}x" for i in range(12_345)] + ["a<|endoftext|>b", "é"]
    got = packing.word_ids(tokenizer, words)
    assert tokenizer.most <= 5000
    assert got == [np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]


def test_only_frequent_words_are_remembered():
    cache = {}
    tokenizer = packing._tokenizer(None)
    first = packing._ids_of(tokenizer, ["one", "three", "many"], np.array([1, 3, 50]), cache)
    assert sorted(cache) == ["many", "three"]
    assert packing._ids_of(tokenizer, ["three", "one"], np.array([1, 1]), cache) == [first[1], first[0]]


def test_bin_patterns_fill_closest():
    rng = np.random.default_rng(0)
    for _ in range(30):
        lengths = rng.integers(1, 41, rng.integers(1, 60)).tolist()
        counts = dict(collections.Counter(lengths))
        left = collections.Counter(counts)
        for times, used in packing.bin_patterns(counts, 40):
            for _ in range(times):
                longest = max(k for k, n in left.items() if n)
                sums = {longest}
                for k, n in (left - collections.Counter([longest])).items():
                    sums |= {s + k * m for s in sums for m in range(1, n + 1)}
                assert used[longest] >= 1 and sum(k * n for k, n in used.items()) == max(s for s in sums if s <= 40)
                left -= collections.Counter(used)
        assert not +left


def test_packing_wastes_little(docs, none):
    got = packing.packed(docs).collect()
    sequences = len({r["sequence_id"] for r in got})
    assert sequences == -(-sum(r["length"] for r in got) // packing.CAPACITY)
    assert packing.packed(none).count() == 0


# 10 --------------------------------------------------------------------------


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    net = language_id.fitted(np.zeros((0, 8), np.uint8), np.zeros((0, 8), bool), np.zeros(0, int), ["a", "b"], 3, 0)
    weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    spans, label = rng.integers(97, 101, (6, 4)), np.array([0, 1, 1, 0])
    valid = rng.random((6, 4)) < 0.8
    loss, grads = language_id.gradients(spans, valid, label, net.weights)
    for name in weights:
        for at in [tuple(rng.integers(0, n) for n in weights[name].shape) for _ in range(4)] + ([(98, 1), (99, 5)] if name[0] == "x" else []):
            changed = {k: w.astype(np.float32).copy() for k, w in weights.items()}
            changed[name][at] += 1e-2
            up = language_id.gradients(spans, valid, label, changed)[0]
            changed[name][at] -= 2e-2
            down = language_id.gradients(spans, valid, label, changed)[0]
            assert grads[name][at] == pytest.approx((up - down) / 2e-2, abs=2e-3)
    assert loss > 0


def test_language_held_out(docs):
    rows = language_id.with_language(docs, language_id.learned(docs, steps=150)).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd(odd, none):
    network = language_id.learned(odd, steps=20)
    out = language_id.with_language(odd, network)
    got = by_id(out, "lang_pred", "score")
    assert [got[i] for i in (1, 2, 3, 16)] == [("und", 0.0)] * 4 and got[4][0] in network.languages
    assert out.count() == odd.count() and [c for c in odd.columns if c != "text"] == out.columns[: len(odd.columns) - 1]
    assert language_id.with_language(odd, language_id.learned(none)).where("lang_pred <> 'und'").count() == 0
    assert language_id.with_language(none, network).count() == 0


def test_pooling_is_per_text():
    network = language_id.fitted(np.full((2, language_id.SPAN), 97, np.uint8), np.ones((2, language_id.SPAN), bool), np.array([0, 1]), ["a", "b"], 3, 2)
    texts = ["abc", "", "x" * 500, "é" * 77]
    whole = language_id.pooled(pa.array(texts), network)
    assert np.allclose(whole, [language_id.pooled(pa.array([t]), network)[0] for t in texts], atol=1e-6)
    assert np.allclose(whole.sum(axis=1), [1, 0, 1, 1], atol=1e-5)


def test_head_cutoff(spark):
    counts = [1] * 500 + [2] * 90 + [3] * 30 + [700, 900, 900, 10**9]
    frame = spark.createDataFrame([(f"w{i}", c) for i, c in enumerate(counts)], "word string, c long")
    for head in (0, 1, 2, 3, 4, 33, 34, 35, 124, 623, 624, 5000):
        cutoff = class_lm.head_cutoff(frame, head)
        assert sum(c >= cutoff for c in counts) <= head and (cutoff == 1 or sum(c >= cutoff - 1 for c in counts) > head)


def _classes(table):
    return {r["word"]: r["class"] for r in table.collect()}


def test_class_lm_clusters_every_word(spark, monkeypatch):
    """Words of two kinds take turns, and all but a few are rare: with a core of four, every one of them ends in a class by its contexts."""
    rng = random.Random(5)
    kinds = [[f"{k}{i}x{i % 7}" for i in range(60)] for k in "ab"]
    texts = [(i, " ".join(rng.choice(kinds[j % 2]) for j in range(20))) for i in range(60)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    model, counts = class_lm.learned(frame, classes=2, core=4, least=1)
    of = _classes(counts)
    groups = [{of[w] for w in k if w in of} for k in kinds]
    assert sorted(map(len, groups)) == [1, 1] and groups[0] != groups[1]
    # the head does not change a score, nor do the sizes of what tasks are handed
    want = by_id(class_lm.scored(frame, model, counts), "score", "base_score")
    for chunk, head in ((1 << 17, 0), (50, class_lm.HEAD)):
        monkeypatch.setattr(class_lm, "CHUNK", chunk)
        got = by_id(class_lm.scored(frame, *class_lm.learned(frame, classes=2, core=4, least=1, head=head)), "score", "base_score")
        assert all(got[i] == pytest.approx(want[i]) for i in want)


def _scores_by_hand(texts, of, ending, classes):
    """{doc_id: log10 probability} from counts made anew, with the class of each word of training and of each ending."""
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in texts}
    split = {i: brute.words(t, lower=True) for i, t in texts}
    c = collections.Counter(w for i, w_ in split.items() if not held[i] for w in w_)
    tokens, words = collections.Counter(), collections.Counter()
    for w, n in c.items():
        tokens[of[w]] += n
        words[of[w]] += 1
    steps = collections.Counter()
    for i, w_ in split.items():
        if not held[i]:
            path = [classes, *(of[w] for w in w_), classes]
            steps.update(zip(path, path[1:]))
    leaving = collections.Counter()
    for (a, _), n in steps.items():
        leaving[a] += n
    out = {}
    for i, w_ in split.items():
        path = [classes, *(of[w] if w in of else ending(w) for w in w_), classes]
        out[i] = sum(math.log10((steps[a, b] + 0.5) / (leaving[a] + 0.5 * (classes + 1))) for a, b in zip(path, path[1:]))
        out[i] += sum(math.log10((c[w] + 0.5) / (tokens[k] + 0.5 * (words[k] + 1))) for w, k in zip(w_, path[1:]))
    return out


def test_class_lm_scores_equal_sums_by_hand(docs, texts):
    """Every score from class transitions and emissions counted in plain Python, with the classes that the model found."""
    model, counts = class_lm.learned(docs, head=3000)
    classes = len(model.transition) - 1
    ending = lambda w: int(model.ending_class[class_lm.ending_of(pa.array([w]))[0]])
    want = _scores_by_hand(texts, _classes(counts), ending, classes)
    got = by_id(class_lm.scored(docs, model, counts), "score")
    assert all(got[i][0] == pytest.approx(want[i]) for i in want)


def test_class_lm_rounds_raise_the_likelihood(docs):
    """Likelihood of the classes is that of a plain count of the bigrams, and above that of classes by ending alone."""
    training = docs.where(~class_lm.held_out(class_lm.F.col("doc_id")))
    counts = class_lm.word_counts(training)
    own = np.unique([r["key"] for r in counts.where("c >= 5").collect()])
    bigrams = class_lm.unit_bigrams(training, docs.sparkSession.sparkContext.broadcast(own))
    of, pairs = class_lm.clustered(bigrams, own, np.arange(40), 24)
    rows = [(r["i"], r["j"], r["n"]) for r in bigrams.collect()]
    plain = np.zeros((25, 25))
    for i, j, n in rows:
        plain[of[i], of[j]] += n
    assert np.array_equal(plain, pairs) and pairs.sum() == sum(n for _, _, n in rows)
    first = np.arange(len(of)) % 24
    first[-1] = 24
    other = class_lm._class_pairs(*(np.array(x) for x in zip(*rows)), first, 25)
    assert class_lm.likelihood(pairs) > class_lm.likelihood(other)


def test_bigrams_move_packed(spark, docs):
    """Counts are those of plain Python; to be added up and to be sorted by word, bigrams move as a row for each slice and bucket, not each."""
    training = docs.where(~class_lm.held_out(class_lm.F.col("doc_id"))).repartition(3)
    own = np.unique([r["key"] for r in class_lm.word_counts(training).where("c >= 5").collect()])
    end = len(own) + class_lm.ENDINGS
    want, unit = collections.Counter(), lambda w: int(class_lm._units(pa.array([w]), own)[0])
    of = {}
    for r in training.collect():
        path = [end, *(of.setdefault(w, unit(w)) if w not in of else of[w] for w in brute.words(r["text"], lower=True)), end]
        want.update(zip(path, path[1:]))
    packed = class_lm.packed_bigrams(training, spark.sparkContext.broadcast(own), 7)
    got = [p for r in packed.collect() for p in zip(*(c.tolist() for c in class_lm._rows([pa.scalar(r["pairs"]), *(pa.scalar(bytes(r[c])) for c in "ijn")])))]
    assert len(got) == len(want) and {(i, j): n for i, j, n in got} == want and packed.count() <= 7
    sides = collections.Counter()
    units, chunks = [], class_lm._chunks(packed, end, 5)
    for r in chunks.collect():
        w, v, side, n = (np.frombuffer(r[c], k) for c, k in zip(("w", "v", "side", "n"), class_lm._KINDS))
        units += np.unique(w).tolist()
        for a, b, s, k in zip(w.tolist(), v.tolist(), side.tolist(), n.tolist()):
            sides[(b, a) if s else (a, b), s] += k
    assert len(units) == len(set(units)) and chunks.count() >= 5
    assert sides == {((i, j), s): n for (i, j), n in want.items() for s in (0, 1) if (j if s else i) != end}


def test_most_frequent_parts_ties(spark):
    frame = spark.createDataFrame([(f"w{i}", c) for i, c in enumerate([9] * 3 + [5] * 2000 + [1] * 50)], "word string, c long")
    some = frame.where(class_lm.most_frequent(frame, 1003))
    assert some.where("c = 9").count() == 3 and 800 < some.count() <= 1080 and some.where("c = 1").count() == 0
    assert frame.where(class_lm.most_frequent(frame, 5000)).count() == 2053


def test_class_lm_best_moves_are_exact():
    rng = np.random.default_rng(3)
    pairs = rng.integers(0, 9, (12, 12)).astype(float)  # the last is the end of a text
    group = np.append(rng.integers(0, 3, 11), 3)
    table = lambda g: np.eye(4)[g].T @ pairs @ np.eye(4)[g]
    between = table(group)
    for w in range(11):
        others = np.delete(np.arange(12), w)
        near, n = np.tile(group[others], 2), np.concatenate([pairs[w, others], pairs[others, w]])
        best, gain = class_lm.best_moves(np.zeros(22, int), np.repeat([0, 1], 11), near, n, pairs[w, w : w + 1], group[w : w + 1], between)
        gains = [class_lm.likelihood(table(np.where(np.arange(12) == w, g, group))) - class_lm.likelihood(between) for g in range(3)]
        assert gain[0] == pytest.approx(max(gains), abs=1e-6) and gains[best[0]] == pytest.approx(max(gains), abs=1e-6)


def test_class_count_follows_the_vocabulary(spark):
    frame = spark.createDataFrame([(i, " ".join(f"w{i}n{j}" for j in range(1000))) for i in range(120)], "doc_id long, text string")
    assert len(class_lm.learned(frame, core=10)[0].transition) > class_lm.CLASSES + 1
