"""Archives, hard negatives and the prefix trie against plain Python, on odd rows, and on empty tables."""

import base64
import collections
import hashlib
import io
import math
import random
import zlib
from pathlib import Path

import brute
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tallyframe.llm import hard_negatives, prefix_trie, warc

# 11 --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(f"<p>{rng.choice(['über', 'a', 'page', '日本'])}{rng.randrange(999)}</p>" for _ in range(n))
    shared = text(30)
    rows = [(i, f"http://e.org/{i}", text(20)) for i in range(60)]
    rows += [(100 + i, f"http://e.org/c{i}", shared) for i in range(40)]
    rows += [(200, None, None), (201, "http://e.org/\r\nX: 1 é", ""), (202, "u", "\r\n\r\nWARC/1.1\r\n"), (203, "u", warc.BREAK * 3), (None, "n", "no id"), (None, "n", "no id")]
    rows += [(204, "long", text(40_000)), (205, "twice", "twice"), (205, "twice", "twice"), (205, "again", "twice"), (150, "less", "twice")]
    extra = "payload string, digest string, uid string, n string, top string, `Check` string"
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], f"page_id bigint, url string, html string, {extra}").repartition(5)


def expected_records(rows, min_bytes=0):
    """Multiset of what each page's record says."""
    groups = collections.defaultdict(list)
    for i, html in rows:
        groups[(html or "").encode()].append(i)
    out = collections.Counter()
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids.sort(key=lambda i: -math.inf if i is None else i)
        top = ids[-1]
        single = len(payload) >= min_bytes
        for at, i in enumerate(ids):
            full = not single or at == len(ids) - 1
            out[i, len(payload), digest, "response" if full else "revisit", None if full else top] += 1
    return out


RECORD = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("options", [{}, {"most_rows": 0, "share": 20}, {"chunks": 2, "chunk_bytes": 300, "min_bytes": 8}])
def test_archive_round_trip(pages, options):
    got = warc.round_trip(pages, **options).collect()
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    assert collections.Counter(tuple(r[c] for c in RECORD) for r in got) == expected_records(rows, options.get("min_bytes", 0))
    html = {(i, (t or "").encode()) for i, t in rows}
    assert all((r["page_id"], bytes(r["payload"])) in html for r in got if r["record_type"] == "response")
    if "chunks" in options:
        assert len({r["archive"] for r in got}) > 8


def test_archive_files(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    warc.archived(pages, folder)
    got = warc.restored(spark, folder).collect()
    for path in {r["archive"] for r in got}:
        data = Path(path.removeprefix("file:")).read_bytes()
        magic, begin, end = next(warc.frames(memoryview(data)))
        assert magic == warc.DICTIONARY_FRAME and begin == 8
        shared = zstandard.ZstdCompressionDict(data[begin:end])
        whole = zstandard.ZstdDecompressor(dict_data=shared).stream_reader(io.BytesIO(data), read_across_frames=True).read()
        own = [r for r in got if r["archive"] == path]
        assert whole.count(b"WARC/1.1\r\nWARC-Type: re") == len(own)
        for r in own:  # a record is a frame that can be read alone
            one = zstandard.ZstdDecompressor(dict_data=shared).decompress(data[r["offset"] : r["offset"] + r["length"]])
            assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n")
    whole = {r["page_id"]: r["url"] for r in got}
    assert whole[200] is None and whole[201] == "http://e.org/%0D%0AX:%201%20é"
    responses = {r["page_id"] for r in got if r["record_type"] == "response"}
    assert all(r["refers_to"] in responses for r in got if r["record_type"] == "revisit" and r["refers_to"] is not None)


def test_archive_of_few_and_of_no_pages(spark, pages, tmp_path):
    few = pages.where("page_id < 3")
    assert {r["page_id"] for r in warc.round_trip(few).collect()} == {0, 1, 2}
    assert warc.round_trip(pages.where("false")).count() == 0
    strings = spark.createDataFrame([("a b\r\n%", "u", "x"), ("z", "u", "x")], "page_id string, url string, html string")
    assert {(r["page_id"], r["refers_to"]) for r in warc.round_trip(strings).collect()} == {("a b\r\n%", "z"), ("z", None)}


def test_damaged_archive_is_an_error(spark, pages, tmp_path):
    folder = tmp_path / "w"
    warc.archived(pages.where("page_id < 30"), str(folder))
    for part in folder.glob("part-*"):
        data = bytearray(part.read_bytes())
        data[-40] ^= 1
        part.write_bytes(bytes(data))
    for check in folder.glob(".*.crc"):
        check.unlink()
    with pytest.raises(Exception):
        warc.restored(spark, str(folder)).collect()


# 12 --------------------------------------------------------------------------


def expected_negatives(rows, positives=5, negatives=10):
    """Rows (id, label, components or None) as plain Python."""
    given = []
    for i, label, vector in rows:
        if i is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            given.append((i, label, [math.floor(256 * x) for x in vector]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, (i, label, v) in enumerate(given):
        if i % 100:
            continue
        others = sorted((-dot(v, w), j, m) for n, (j, m, w) in enumerate(given) if n != k)
        for p, j, _ in [x for x in others if x[2] == label][:positives]:
            fit = [x for x in others if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            out += [(i, j, r, n, -p, -s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


NEGATIVE = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(spark, rows, **options):
    names = "score string, leaf string, vec string, uid string, rank string"
    frame = spark.createDataFrame([(*r, *"abcde") for r in rows], f"id bigint, label int, vector array<double>, {names}").repartition(3)
    found = hard_negatives.hard_negatives(frame, F.col("id") % 100 == 0, **options)
    return sorted(tuple(r[c] for c in NEGATIVE) for r in found.collect())


def vectors(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(i, int(rng.integers(labels)), (centres[i % 6] + rng.normal(size=dims) * 0.5).tolist()) for i in range(n)]


@pytest.mark.parametrize("leaf_rows, fan", [(10_000, 8), (40, 4), (5, 3)])
def test_negatives_equal_brute_force(spark, leaf_rows, fan):
    rows = vectors(600, 7, 3)
    want = expected_negatives(rows)
    assert len(want) > 100 and mined(spark, rows, leaf_rows=leaf_rows, fan=fan) == want


def test_negatives_of_odd_rows(spark):
    rows = vectors(300, 5, 9, labels=2)
    rows += [(1000 + i, i % 2, rows[100][2]) for i in range(150)]  # copies of an anchor, in both labels
    rows += [(None, 1, [1.0] * 5), (2000, None, [1.0] * 5), (2100, 1, None), (2200, 1, [1.0, None, 1.0, 1.0, 1.0]), (2300, 1, [math.nan] * 5), (2400, 0, [math.inf] * 5)]
    rows += [(2500, 1, []), (2600, 0, [2.0, 1.0]), (2700, 1, [0.0] * 5), (2800, 0, [-1.0] * 5), (300, 9, [3.0] * 5), (2900, 1, [3e4] * 5)]
    rows += [(200, 0, rows[200][2]), (200, 0, rows[200][2])]  # an id three times
    assert mined(spark, rows, leaf_rows=20, fan=4) == expected_negatives(rows)


def test_negatives_of_few_and_of_no_rows(spark):
    assert mined(spark, [(100, 1, [1.0])]) == []
    assert mined(spark, [(100, 1, [1.0]), (1, 1, [1.0]), (2, 0, [0.5])]) == [(100, 1, 1, 2, 65536, 32768)]
    frame = spark.createDataFrame([], "id bigint, label int, vector array<float>")
    assert hard_negatives.hard_negatives(frame, F.col("id") % 100 == 0).count() == 0
    with pytest.raises(Exception, match="do not fit|too large"):
        mined(spark, [(100, 1, [1e9]), (1, 1, [1e9])])


def test_ranges_eliminate_only_what_lies_outside():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * (rng.normal(size=(12, 6)) * 2)[rng.integers(12, size=3000)] + 40 * rng.normal(size=(3000, 6)))
    square = np.einsum("ij,ij->i", rows, rows).max()
    tree = hard_negatives.planted(rows[:800], 6, float(square), True, 40, 6)
    leaf, steps = tree.routes(tree.lifted(rows))
    for node, _, d, near in steps:
        for j in range(d.shape[1]):
            own = d[near == j]
            if len(own):
                tree.low[node][:, j], tree.high[node][:, j] = own.min(axis=0), own.max(axis=0)
    queries = rows[:200]
    found = queries @ rows.T
    low, high = np.quantile(found, 0.97, axis=1), np.quantile(found, 0.99, axis=1)
    edge = lambda s: np.sqrt(np.maximum(np.einsum("ij,ij->i", queries, queries) + square - 2 * s, 0))
    alive, _ = tree.alive(np.column_stack([queries, np.zeros(200)]), edge(high), edge(low))
    inside = (found >= low[:, None]) & (found <= high[:, None])
    assert alive[np.nonzero(inside)[0], leaf[np.nonzero(inside)[1]]].all()
    assert alive.mean() < 0.6  # and it does eliminate


# 13 --------------------------------------------------------------------------


def rebuilt(conversations):
    own = collections.defaultdict(list)
    for c, turn, role, text in conversations:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def expected_nodes(convs):
    members = collections.defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, own in members.items():
        add = (len(own) - 1) * (len(brute.words(p[-1][1])) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += add
    sha = lambda p: brute.sha(",".join(str(c) for c in members[p] if len(convs[c]) == len(p)))
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p], leaves[p], saved[p], sha(p)) for p, m in members.items())


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes_of(frame):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in NODE) for r in frame.collect())


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(2)
    say = lambda: rng.choice(["yes", "no thanks", "", "a b c", "why ?"])
    rows = [(c, t, rng.choice(["user", "bot"]), say()) for c in range(400) for t in range(rng.randrange(1, 7))]
    rows += [(1000 + c, t, "user", "the same words") for c in range(150) for t in range(5)]
    rows += [(2000, t, "user", f"turn {t % 3}") for t in range(700)]
    rows += [(2001, None, None, None), (2001, 1, "user", None), (2001, 1, None, "user"), (2001, 1, None, "user"), (None, 1, "user", "lost"), (-7, 0, "user", "x"), (-20, 0, "user", "y")]
    rows += [(3003, 0, "user", "short"), (1007, 9, "user", "one more"), (2**40 + 1, 0, "", "")]
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("part_turns, part_members, options", [(50_000, 200_000, {}), (60, 40, {}), (9, 7, {"most_rows": 0, "share": 8})])
def test_trie_equals_brute_force(spark, conversations, part_turns, part_members, options):
    extra = "turns string, digest string, key string, name string, depth string, Words string"
    frame = spark.createDataFrame([(*r, *"abcdef") for r in conversations], f"{SCHEMA}, {extra}").repartition(4)
    turns = prefix_trie.with_heads(prefix_trie.sequences(frame))
    assert nodes_of(prefix_trie.trie(turns, part_turns, part_members, **options)) == expected_nodes(rebuilt(conversations))


def test_trie_of_few_and_of_no_rows(spark):
    make = lambda rows: prefix_trie.trie(prefix_trie.with_heads(prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA))))
    assert make([]).count() == 0 and make([(None, 1, "a", "b")]).count() == 0
    gone = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4)  # its only turn goes, and no head comes
    assert nodes_of(make([(gone, 0, "user", "a b")])) == [(gone, 0, -1, 1, 0, 1, 0, brute.sha(str(gone)))]
